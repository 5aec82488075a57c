"""Quality by nearest-neighbour voting among labelled latent-semantic vectors.

A text is a vector of terms: hashed byte trigrams (damped counts) and a few of its
form (words that repeat the one before, distinct words, marks, lines). A singular value
decomposition of a bounded labelled sample gives latent axes. The sample's vectors are
broadcast; every document's exact cosines with all of them come from one matrix product
per block, and the nearest vote with their similarity.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.training_rows import fold, sampled_ids, sampled_rows
from siltstone.llm.words import Words, blocks

TERM_BITS = 12
FORMS = 5
TERMS = (1 << TERM_BITS) + FORMS
BLOCK_BYTES = 1 << 20
FORM_WEIGHT = 1.5


def terms(raw: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A row of term weights for each row of a block; a row without words is zero."""
    rows, size = len(ends) - 1, len(raw)
    out = np.zeros((rows, TERMS), np.float32)
    if size < 3:
        return out
    wide = raw.astype(np.uint32)
    grams = (wide[:-2] * np.uint32(0x9E3779B1)) ^ (wide[1:-1] * np.uint32(0x85EBCA77)) ^ (wide[2:] * np.uint32(0xC2B2AE3D))
    grams = (grams * np.uint32(0x27D4EB2F)) >> np.uint32(32 - TERM_BITS)
    for row in range(rows):
        a, b = int(ends[row]), max(int(ends[row]), int(ends[row + 1]) - 2)
        out[row, : 1 << TERM_BITS] = np.bincount(grams[a:b], minlength=1 << TERM_BITS)
    body = out[:, : 1 << TERM_BITS]
    np.log1p(body, out=body)
    length = np.sqrt((body**2).sum(axis=1, keepdims=True))
    body /= np.maximum(length, 1e-9)
    words = Words(raw, ends, True)
    counts = np.maximum(np.diff(words.first), 1)
    same = np.zeros(len(words.hashes), np.int64)
    same[1:] = words.hashes[1:] == words.hashes[:-1]
    sums = np.concatenate([[0], np.cumsum(same)])
    marks = np.concatenate([[0], np.cumsum((raw > 0x20) & (raw < 0x30) | (raw == 0x7C))])
    capitals = np.concatenate([[0], np.cumsum((raw >= 0x41) & (raw <= 0x5A))])
    for row, (a, b) in enumerate(zip(words.first[:-1], words.first[1:], strict=True)):
        if b > a:
            out[row, -1] = len(np.unique(words.hashes[a:b])) / (b - a)
    size_of = np.maximum(np.diff(ends), 1)
    out[:, -2] = (sums[words.first[1:]] - sums[words.first[:-1]]) / counts
    out[:, -3] = np.minimum(1, 5 * (marks[ends[1:]] - marks[ends[:-1]]) / size_of)
    out[:, -4] = np.minimum(1, 2 * (capitals[ends[1:]] - capitals[ends[:-1]]) / size_of)
    out[:, -5] = np.minimum(1, counts / 50)
    out[:, -FORMS:] *= FORM_WEIGHT
    return out


@dataclass(frozen=True)
class VotingModel:
    """Latent axes, the labelled vectors on them, and their labels."""

    mean: np.ndarray
    axes: np.ndarray
    known: np.ndarray
    labels: np.ndarray
    neighbours: int

    def latent(self, rows: np.ndarray) -> np.ndarray:
        found = (rows - self.mean) @ self.axes
        return found / np.maximum(np.sqrt((found**2).sum(axis=1, keepdims=True)), 1e-9)

    def scores(self, rows: np.ndarray) -> np.ndarray:
        if not len(self.labels):
            return np.full(len(rows), 0.5)
        cosines = self.latent(rows) @ self.known.T
        k = min(self.neighbours, len(self.labels))
        nearest = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(cosines, nearest, axis=1), 1e-6).astype(np.float64) ** 4
        return (weight * self.labels[nearest]).sum(axis=1) / weight.sum(axis=1)


def fit(
    docs: DataFrame, labels: DataFrame, *, per_class: int = 1500, width: int = 48, neighbours: int = 15
) -> VotingModel:
    """Latent axes and vectors of at most ``per_class`` labelled documents of each class, whole texts.

    Rows of fold 2 of 4 (crc32 of the id as text) are never taken. The terms of the sample
    (2 * ``per_class`` rows of ``TERMS`` numbers) are all that reaches the driver.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, raw, ends in blocks(batch.column(1), BLOCK_BYTES):
                packed = [row.astype(np.float16).tobytes() for row in terms(raw, ends)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[a:b], pa.array(packed, pa.binary()), batch.column(2)[a:b]],
                    ["doc_id", "terms", "label"],
                )

    rows = sampled_rows(docs, sampled_ids(labels, "quality", 4, 2, per_class)).select("doc_id", "text", "label")
    found = rows.mapInArrow(run, "doc_id long, terms binary, label int")
    found = found.groupBy("doc_id").agg(F.min("terms").alias("terms"), F.first("label").alias("label"))
    found = found.toPandas().sort_values("doc_id")
    if found.empty:
        nothing = np.zeros((TERMS, 1), np.float32)
        return VotingModel(nothing[:, 0], nothing, np.zeros((0, 1), np.float32), np.zeros(0), neighbours)
    matrix = np.stack([np.frombuffer(x, np.float16) for x in found["terms"]]).astype(np.float32)
    mean = matrix.mean(axis=0)
    rng = np.random.default_rng(5)
    basis = rng.normal(size=(TERMS, min(width + 16, len(matrix)))).astype(np.float32)
    for _ in range(4):
        basis, _ = np.linalg.qr((matrix - mean).T @ ((matrix - mean) @ basis))
    _, _, right = np.linalg.svd((matrix - mean) @ basis, full_matrices=False)
    axes = (basis @ right[:width].T).astype(np.float32)
    labels_ = found["label"].to_numpy(np.float64)
    model = VotingModel(mean, axes, np.zeros((0, axes.shape[1]), np.float32), labels_, neighbours)
    return VotingModel(mean, axes, model.latent(matrix), labels_, neighbours)


def quality_votes(docs: DataFrame, labels: DataFrame, *, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs`` (doc_id long, text string).

    Whole texts are scored, null as empty: an empty text has no terms and is voted on by
    the vectors nearest to none. Repeated rows score alike; lang, source and other columns
    take no part; an empty table gives no rows. Without labels every score is 0.5.
    """
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, raw, ends in blocks(batch.column(1), BLOCK_BYTES):
                score = pa.array(shared.value.scores(terms(raw, ends)).astype(np.float64))
                yield pa.RecordBatch.from_arrays([batch.column(0)[a:b], score], ["doc_id", "score"])

    found = docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")
    return found.select(
        "doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )

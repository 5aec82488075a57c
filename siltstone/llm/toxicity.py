"""Toxicity by subword-bag embeddings under a linear softmax, trained jointly in numpy.

A piece of text (a word, a part of a very long one, or marks) is a bag of its character
n-grams, so a misspelt word shares most of its vectors with the word. Pieces end at white
space of any kind and length and have a greatest length, so that a window is short in
every script. A window of pieces is the mean
of its vectors; embeddings and softmax are trained together on windows of a bounded
sample of labelled documents. A document's label says only that some of its windows are
toxic: after a first epoch on all, those of a toxic document that score below its best
and below one half are left out.

A document scores as the highest of its windows. As a mean of vectors under a linear
layer is a mean of numbers, a trained model is one number per bucket: it is small, its
size does not depend on the data, and texts are scored by prefix sums.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.training_rows import fold, sampled_ids, sampled_rows
from siltstone.llm.words import blocks, gives_back

BUCKET_BITS = 17
SIZES = (3, 4, 5)
PIECES = 24
#: Longest piece; a character of three or four bytes, often a syllable or a word, counts as four.
LONGEST = 24
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E), *range(0x1C, 0x20)]] = True
#: White space beyond ASCII, in UTF-8.
_WIDE_SPACE = ["\x85\xa0", "\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200B)))]
_WIDE_SPACE = [np.array([list(x.encode()) for x in part], np.uint8) for part in _WIDE_SPACE]
#: What the byte that begins a character adds to a piece's length.
_LENGTH = np.ones(256, dtype=np.int64)
_LENGTH[0x80:0xC0] = 0
_LENGTH[0xE0:] = 4
_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(ord("a"), ord("z") + 1), *range(ord("A"), ord("Z") + 1)]] = True
_MARKS = np.zeros(256, dtype=bool)
_MARKS[[ord(x) for x in ",.;:!?)"]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)


def subwords(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of the pieces (lower case, marked ends), and each piece's offset."""
    marked = [b"\x02" + x + b"\x03" for x in pieces]
    raw = _LOWER[np.frombuffer(b"".join(marked), np.uint8)].astype(np.uint64)
    # By lengths: a text may hold the marks itself.
    sizes = np.fromiter(map(len, marked), np.int64, len(marked))
    owner = np.repeat(np.arange(len(marked)), sizes)
    last = np.cumsum(sizes)[owner]
    found, owners = [], []
    for size in SIZES:
        if len(raw) < size:
            continue
        whole = np.arange(len(raw) - size + 1) + size <= last[: len(raw) - size + 1]
        value = np.full(int(whole.sum()), size, np.uint64)
        at = np.flatnonzero(whole)
        for place in range(size):
            value = (value ^ raw[at + place]) * _MULTIPLY
            value ^= value >> np.uint64(29)
        found.append((value * _MULTIPLY) >> np.uint64(64 - BUCKET_BITS))
        owners.append(owner[at])
    buckets = np.concatenate(found) if found else np.zeros(0, np.uint64)
    owner = np.concatenate(owners) if owners else np.zeros(0, np.int64)
    order = np.argsort(owner, kind="stable")
    counts = np.bincount(owner, minlength=len(pieces))
    return buckets[order].astype(np.int64), np.concatenate([[0], np.cumsum(counts)])


def _blank(raw: np.ndarray) -> np.ndarray:
    """Whether each byte belongs to white space."""
    blank = _SPACE[raw]
    for kinds, lead in zip(_WIDE_SPACE, (raw == 0xC2, (raw >= 0xE1) & (raw <= 0xE3)), strict=True):
        width = kinds.shape[1]
        at = np.flatnonzero(lead[: max(len(raw) - width + 1, 0)])
        for kind in kinds:
            own = at[np.logical_and.reduce([raw[at + i] == kind[i] for i in range(width)])]
            for i in range(width):
                blank[own + i] = True
    return blank


def _split(raw: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes without white space, each piece's offset among them, and each row's among the pieces.

    Pieces begin at rows' starts, after white space, at marks after an ASCII letter, and
    where the piece before has the greatest length.
    """
    solid = ~_blank(raw)
    begin = solid.copy()
    begin[1:] = solid[1:] & (~solid[:-1] | (_MARKS[raw[1:]] & _LETTER[raw[:-1]]))
    edges = ends[ends < len(raw)]
    begin[edges] = solid[edges]
    kept = np.flatnonzero(solid)
    raw, begin = raw[kept], begin[kept]
    length = _LENGTH[raw]
    before = np.cumsum(length) - length
    starts = np.flatnonzero(begin)
    part = (before - np.repeat(before[starts], np.diff(np.append(starts, len(raw))))) // LONGEST
    letters = np.flatnonzero(length)
    begin[letters[1:][part[letters[1:]] != part[letters[:-1]]]] = True
    starts = np.flatnonzero(begin)
    return raw, starts, np.searchsorted(kept[starts], ends)


def _distinct(raw: np.ndarray, ends: np.ndarray) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Distinct pieces of a block, the number of each piece in order, and each row's offset among them."""
    raw, starts, first = _split(raw, ends)
    offsets = np.append(starts, len(raw)).astype(np.int32)
    data = pa.py_buffer(np.ascontiguousarray(raw))
    coded = pa.BinaryArray.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), data]).dictionary_encode()
    return coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False), first


@dataclass(frozen=True)
class ToxicityModel:
    """The logit of each bucket and the bias."""

    weights: np.ndarray
    bias: float

    def scores(self, raw: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The highest probability among each row's windows; a row without pieces has the bias's."""
        if not len(raw):
            return np.full(len(ends) - 1, 1 / (1 + np.exp(-self.bias)))
        pieces, place, first = _distinct(raw, ends)
        if not len(place):
            return np.full(len(ends) - 1, 1 / (1 + np.exp(-self.bias)))
        buckets, bounds = subwords(pieces)
        sums = np.concatenate([[0.0], np.cumsum(self.weights[buckets], dtype=np.float64)])
        weight, count = (sums[bounds[1:]] - sums[bounds[:-1]])[place], np.diff(bounds)[place]
        weight, count = np.concatenate([[0.0], np.cumsum(weight)]), np.concatenate([[0], np.cumsum(count)])
        sizes = np.diff(first)
        best = np.full(len(sizes), self.bias)
        some = sizes > 0
        row_stop = np.repeat(first[1:], sizes)
        at = np.arange(len(place))
        stop = np.minimum(at + PIECES, row_stop)
        total = (weight[stop] - weight[at]) / np.maximum(count[stop] - count[at], 1)
        whole = (stop - at == PIECES) | (at == np.repeat(first[:-1], sizes))
        best[some] += np.maximum.reduceat(np.where(whole, total, -np.inf), first[:-1][some])
        return 1 / (1 + np.exp(-best))


def train(
    texts: list[str | None], labels: list[int], *, width: int = 8, epochs: int = 6, seed: int = 1, start: float = 0.01, least: int = 3
) -> ToxicityModel:
    """Fits embeddings and softmax (its two classes' difference) by Adagrad on windows of ``PIECES`` pieces."""
    column = pa.array(texts, pa.large_string())
    windows: list[np.ndarray] = []
    owners: list[int] = []
    for a, _, raw, ends in blocks(column):
        if not len(raw):
            continue
        pieces, place, first = _distinct(raw, ends)
        if not len(place):
            continue
        buckets, bounds = subwords(pieces)
        for row in range(len(ends) - 1):
            for at in range(first[row], first[row + 1], PIECES):
                own = place[at : min(at + PIECES, first[row + 1])]
                windows.append(np.concatenate([buckets[bounds[p] : bounds[p + 1]] for p in own]).astype(np.int32))
                owners.append(a + row)
    rng = np.random.default_rng(seed)
    vectors = rng.normal(0, 0.1, (1 << BUCKET_BITS, width)).astype(np.float32)
    layer = rng.normal(0, 1, width).astype(np.float32)
    if not windows or len(set(labels)) < 2:
        return ToxicityModel(np.zeros(1 << BUCKET_BITS, np.float32), -3.0)
    owner = np.array(owners)
    truth = np.array(labels, np.float32)[owner]
    sizes = np.array([max(1, len(x)) for x in windows])
    # A large start of the squared steps keeps n-grams seen once or twice from being learnt by heart.
    grown, grown_layer, grown_bias = np.full(len(vectors), start), np.full(width, start), start
    bias, active = np.float32(-2.0), np.ones(len(windows), bool)
    # n-grams of few documents tell nothing of others: they keep a zero vector.
    seen = np.zeros(len(vectors), np.int64)
    for rows in np.split(np.arange(len(windows)), np.flatnonzero(np.diff(owner)) + 1):
        seen[np.unique(np.concatenate([windows[i] for i in rows.tolist()]))] += 1
    vectors[seen < least] = 0
    usual = (seen >= least).astype(np.float32)
    weight = np.where(truth == 1, 1 / np.bincount(owner)[owner], 1.0)

    def logits(rows: np.ndarray) -> np.ndarray:
        number = (vectors @ layer).astype(np.float64)
        return np.array([number[windows[i]].sum() / sizes[i] for i in rows.tolist()]) + bias

    for epoch in range(epochs):
        if epoch:
            # Of a toxic document's windows, the best one and those above one half count.
            score = logits(np.arange(len(windows)))
            best = np.full(len(labels), -np.inf)
            np.maximum.at(best, owner, score)
            weight = np.ones(len(windows))
            active = (truth == 0) | (score >= best[owner]) | (score > 0)
        rows = np.flatnonzero(active)
        rng.shuffle(rows)
        for start in range(0, len(rows), 256):
            batch = rows[start : start + 256]
            lengths = sizes[batch]
            flat = np.concatenate([windows[i] for i in batch.tolist()])
            lens = np.array([len(windows[i]) for i in batch.tolist()])
            inside = np.repeat(np.arange(len(batch)), lens)
            used, place = np.unique(flat, return_inverse=True)
            counts = np.zeros((len(batch), width), np.float32)
            np.add.at(counts, inside, vectors[flat])
            means = counts / lengths[:, None]
            error = (1 / (1 + np.exp(-(means @ layer + bias))) - truth[batch]) * weight[batch]
            pull = np.bincount(place, weights=(error / lengths)[inside], minlength=len(used))
            step = (pull * usual[used])[:, None] * layer[None, :]
            grown[used] += (step**2).sum(axis=1)
            vectors[used] -= (0.5 * step / np.sqrt(grown[used])[:, None]).astype(np.float32)
            push = means.T @ error
            grown_layer += push**2
            layer -= (0.5 * push / np.sqrt(grown_layer)).astype(np.float32)
            grown_bias += float(error.sum()) ** 2
            bias -= np.float32(0.2 * error.sum() / np.sqrt(grown_bias))
    return ToxicityModel((vectors @ layer).astype(np.float32), float(bias))


def calibrated(model: ToxicityModel, texts: list[str | None], labels: list[int]) -> ToxicityModel:
    """Moves the bias so that one half parts the two classes of documents that took no part in training best."""
    parts = [model.scores(raw, ends) for _, _, raw, ends in blocks(pa.array(texts, pa.large_string()))]
    truth = np.array(labels)
    if len(set(labels)) < 2:
        return model
    found = np.clip(np.concatenate(parts), 1e-12, 1 - 1e-12)
    logit = np.log(found / (1 - found))
    order = np.argsort(logit)
    logit, truth = logit[order], truth[order]
    # Errors of each class, as shares, if the cut is before each place.
    missed = np.concatenate([[0], np.cumsum(truth)]) / truth.sum()
    false = (len(truth) - truth.sum() - np.concatenate([[0], np.cumsum(1 - truth)])) / (len(truth) - truth.sum())
    errors = missed + false
    best = np.flatnonzero(errors == errors.min())
    edges = np.concatenate([[logit[0] - 2], logit, [logit[-1] + 2]])
    cut = (edges[best[0]] + edges[best[-1] + 1]) / 2
    return ToxicityModel(model.weights, float(model.bias - cut))


def fit(docs: DataFrame, labels: DataFrame, *, per_class: int = 1000, longest: int = 1 << 14) -> ToxicityModel:
    """Trains on at most ``per_class`` labelled documents of each class, none longer than ``longest`` bytes.

    These bounds hold for training alone and keep it in the driver's memory. Only rows
    outside fold 0 of 5 (crc32 of the id as text) are taken; every fourth of them sets the
    bias, the others train.
    """
    short = docs.where(F.octet_length("text") <= longest)
    rows = sampled_rows(short, sampled_ids(labels, "toxic", 5, 0, per_class))
    found = rows.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("label").alias("label"))
    found = found.toPandas().sort_values("doc_id")
    texts, truth = found["text"].tolist(), found["label"].tolist()
    held = [at for at in range(len(texts)) if at % 4 == 3]
    taken = [at for at in range(len(texts)) if at % 4 != 3]
    model = train([texts[i] for i in taken], [truth[i] for i in taken])
    return calibrated(model, [texts[i] for i in held], [truth[i] for i in held])


def scored(docs: DataFrame, model: ToxicityModel, carried: list[str], score: str = "score") -> DataFrame:
    """``carried`` columns and each row's score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @gives_back
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            last = batch.num_columns - 1
            for a, b, raw, ends in blocks(batch.column(last)):
                own = [batch.column(i)[a:b] for i in range(last)]
                yield pa.RecordBatch.from_arrays([*own, pa.array(shared.value.scores(raw, ends))], [*carried, score])

    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in carried)
    return docs.select(*carried, F.col("text").alias("_text")).mapInArrow(run, f"{kinds}, `{score}` double")


def toxicity(docs: DataFrame, labels: DataFrame, *, threshold: float = 0.5) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs`` (doc_id long, text string).

    Whole texts are scored. A null or empty text scores the bias alone, which is clean;
    repeated rows score alike; lang, source and other columns take no part; an empty
    table gives no rows. Without labels of both classes nothing is toxic.
    """
    model = fit(docs, labels)
    return scored(docs, model, ["doc_id"]).select(
        "doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def without_toxic(docs: DataFrame, model: ToxicityModel, *, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` (text string) that score below the threshold, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    @gives_back
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [shared.value.scores(raw, ends) for _, _, raw, ends in blocks(batch.column(at))]
            if scores:
                yield batch.filter(pa.array(np.concatenate(scores) < threshold))

    return docs.mapInArrow(run, docs.schema)

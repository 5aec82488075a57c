"""Quality rules by tokeniser fertility.

Two public vocabularies measure every text: characters per token and the entropy of its
tokens (byte-level BPE), and the share of tokens that are single bytes (a piece
vocabulary with byte fallback, on the same pieces of text). What is usual is learnt per
language from the whole table: the median of each measure and its distance from the
outer quantiles set a band, and a document with any measure outside is rejected. Text
that the vocabulary of its language does not fit (symbols, shouting, noise, other
scripts) or that repeats itself lies outside.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.pieces import PieceEncoder
from siltstone.llm.scratch import Scratch
from siltstone.llm.words import Words, blocks, gives_back, mixed, spans, windows

WINDOW = 5
BLOCK_BYTES = 3 << 18
_BASE = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
_MEASURES = "chars_per_token double, byte_share double, entropy double"
MEASURES = ("chars_per_token", "byte_share", "entropy")
_SYMBOL = np.zeros(256, np.int64)
_SYMBOL[[ord(x) for x in "#*$%&|<>"]] = 1


def _row_sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return sums[ends[1:]] - sums[ends[:-1]]


def _repeated(hashes: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Whether a value occurs twice or more in its row (``owner``)."""
    keys = mixed(hashes + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    ordered = np.sort(keys)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return np.zeros(len(keys), dtype=bool)
    at = np.searchsorted(twice, keys)
    return twice[np.minimum(at, len(twice) - 1)] == keys


def base_counts(raw: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of each row of a block."""
    words = Words(raw, ends, fold=False)
    counts = np.diff(words.first)
    points = (raw & 0xC0) != 0x80
    inside = np.zeros(len(raw) + 1, np.int64)
    inside[1:] = np.cumsum(points)
    chars = _row_sums(inside[words.stops] - inside[words.starts], words.first)
    symbols = _row_sums(_SYMBOL[raw], ends)
    # Words in windows that occur twice in their row.
    grams = windows(words.hashes, WINDOW)
    owner = np.repeat(np.arange(len(counts)), counts)
    whole = owner[: len(grams)] == owner[WINDOW - 1 :] if len(grams) else np.zeros(0, bool)
    at = np.flatnonzero(whole)
    at = at[_repeated(grams[at], owner[at])]
    cover = np.bincount(at, minlength=len(owner) + 1) - np.bincount(at + WINDOW, minlength=len(owner) + 1)
    repeats = _row_sums(np.cumsum(cover[:-1]) > 0, words.first)
    # Lines: from each row's start or a line break to the next line break or row's end.
    line_break = np.flatnonzero(raw == 0x0A)
    some = ends[:-1][ends[1:] > ends[:-1]]
    starts = np.unique(np.concatenate([some, line_break + 1]))
    starts = starts[starts < len(raw)]
    row = np.searchsorted(ends, starts, side="right") - 1
    stops = np.append(starts[1:], len(raw)) if len(starts) else starts
    stops = np.minimum(stops, ends[row + 1])
    closed = (stops > starts) & (raw[np.maximum(stops, 1) - 1] == 0x0A) if len(starts) else np.zeros(0, bool)
    stops = stops - closed
    filled = np.searchsorted(words.starts, stops) > np.searchsorted(words.starts, starts)
    starts, stops, row = starts[filled], stops[filled], row[filled]
    lines = spans(raw, starts, stops)
    order = np.lexsort((np.arange(len(lines)), lines, row))
    again = (lines[order][1:] == lines[order][:-1]) & (row[order][1:] == row[order][:-1])
    duplicates = np.bincount(row[order[1:]][again], minlength=len(counts)) if len(lines) else np.zeros(len(counts), np.int64)
    return [counts, chars, symbols, duplicates, repeats]


@functools.lru_cache(maxsize=1)
def _pieces(path: str) -> tuple:
    """A piece vocabulary's processor and whether each of its ids is a byte; once per worker."""
    import sentencepiece

    processor = sentencepiece.SentencePieceProcessor(model_file=path)
    return processor, np.array([processor.IsByte(i) for i in range(processor.GetPieceSize())])


class _Fertility(PieceEncoder):
    """Also counts, per piece, the tokens and the byte tokens of the piece vocabulary."""

    def __init__(self, path: str, pieces_path: str):
        self.processor, self.is_byte = _pieces(pieces_path)
        super().__init__(path)

    def _forget(self) -> None:
        super()._forget()
        self.other = np.zeros((2, 0), np.int64)

    def _add(self, pieces: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        super()._add(pieces, ids, sizes)
        coded = self.processor.encode(pieces, num_threads=1)
        lengths = np.fromiter(map(len, coded), np.int64, len(coded))
        flat = np.concatenate([np.array(x, np.int64) for x in coded]) if lengths.sum() else np.zeros(0, np.int64)
        sums = np.concatenate([[0], np.cumsum(self.is_byte[flat])])
        after = np.cumsum(lengths)
        self.other = np.hstack([self.other, [lengths, sums[after] - sums[after - lengths]]])

    def measures(self, raw: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
        """chars_per_token, byte_share and entropy (its share of the most that so many tokens can have)."""
        ids, bounds = self.encode(raw, ends)
        count = np.diff(bounds)
        chars = _row_sums((raw & 0xC0) != 0x80, ends)
        tokens, byte_tokens = (_row_sums(x, self.row_pieces) for x in self.other[:, self.number])
        keys = np.sort((np.repeat(np.arange(len(count)), count).astype(np.uint64) << np.uint64(32)) | ids)
        new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
        runs = np.diff(np.append(new, len(keys)))
        row = (keys[new] >> np.uint64(32)).astype(np.int64)
        weight = runs * np.log2(runs)
        total = np.bincount(row, weights=weight, minlength=len(count)) if len(row) else np.zeros(len(count))
        most = np.log2(np.maximum(count, 2))
        entropy = np.where(count > 1, (np.log2(np.maximum(count, 1)) - total / np.maximum(count, 1)) / most, 1.0)
        return [chars / np.maximum(count, 1), byte_tokens / np.maximum(tokens, 1), entropy]


def measured(docs: DataFrame, tokenizer: str, pieces: str, carried: list[str]) -> DataFrame:
    """``carried`` columns, then base counts and measures of each row's ``text``."""

    @gives_back
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _Fertility(tokenizer, pieces)
        for batch in batches:
            last = batch.num_columns - 1
            for a, b, raw, ends in blocks(batch.column(last), BLOCK_BYTES):
                found = [*base_counts(raw, ends), *encoder.measures(raw, ends)]
                own = [batch.column(i)[a:b] for i in range(last)]
                yield pa.RecordBatch.from_arrays([*own, *map(pa.array, found)], names)

    narrow = docs.select(*carried, F.col("text").alias("_text"))
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in carried)
    names = [*carried, *(x.split()[0] for x in f"{_BASE}, {_MEASURES}".split(", "))]
    return narrow.mapInArrow(run, f"{kinds}, {_BASE}, {_MEASURES}")


#: How far a band reaches below and above the median at least: a part of it, or a difference.
LEAST = {"chars_per_token": (0.11, 0.3, 0.0), "byte_share": (0.0, 0.0, 0.05), "entropy": (0.25, 0.25, 0.0)}


def bands(rows: DataFrame, *, width: float) -> DataFrame:
    """Per lang, the lowest and highest value of each measure that is kept.

    Half of all documents of a language lie between its quartiles; a band reaches
    ``width`` times the distance from the median to the quartile of that side further,
    and at least as far as ``LEAST`` says.
    Quartiles are taken by one pass of mergeable sketches over all rows with a word.
    """
    found = rows.where("n_words > 0").groupBy("lang").agg(
        *[F.percentile_approx(m, [0.25, 0.5, 0.75], 10_000).alias(m) for m in MEASURES]
    )
    out = [F.col("lang").alias("band_lang")]
    for m in MEASURES:
        low, mid, high = (F.element_at(m, i) for i in (1, 2, 3))
        below, above, least = LEAST[m]
        out.append((mid - F.greatest((mid - low) * width, mid * below, F.lit(least))).alias(f"{m}_low"))
        out.append((mid + F.greatest((high - mid) * width, mid * above, F.lit(least))).alias(f"{m}_high"))
    return found.select(*out)


def judged(rows: DataFrame, *, width: float = 6.0) -> DataFrame:
    """Adds base_failed, in_band and kept to measured rows that have ``lang``."""
    limits = bands(rows, width=width)
    inside = F.lit(True)
    for m in MEASURES:
        inside = inside & (F.col(m) >= F.col(f"{m}_low")) & (F.col(m) <= F.col(f"{m}_high"))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return (
        rows.join(limits, F.col("lang").eqNullSafe(F.col("band_lang")), "left")
        .withColumns({"base_failed": failed, "in_band": F.coalesce(inside, F.lit(False))})
        .withColumn("kept", ~F.col("base_failed") & F.col("in_band"))
    )


def fertility_rules(docs: DataFrame, tokenizer: str, pieces: str, *, width: float = 6.0) -> DataFrame:
    """Counts, measures and verdict of every row of ``docs`` (doc_id, text, lang).

    Returns doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, the three measures and in_band. A null text counts as empty and
    fails; a null lang is a language of its own; repeated rows are judged alike; other
    columns are ignored; an empty table gives no rows. In a language whose documents
    are all junk, junk is usual: bands compare with the language's own median.
    """
    scratch = Scratch(docs.sparkSession)
    rows = scratch.keep(measured(docs, tokenizer, pieces, ["doc_id", "lang"]), "measured")
    return judged(rows, width=width).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        *MEASURES, "in_band",
    )


def kept_documents(docs: DataFrame, tokenizer: str, pieces: str, *, width: float = 6.0) -> DataFrame:
    """The rows of ``docs`` (text, lang) whose verdict is to keep, with the columns they had."""
    own = {name: f"own_{at}" for at, name in enumerate(docs.columns)}
    carried = docs.select("text", "lang", *[F.col(a).alias(b) for a, b in own.items()])
    rows = measured(carried, tokenizer, pieces, ["lang", *own.values()])
    rows = Scratch(docs.sparkSession).keep(rows, "measured")
    return judged(rows, width=width).where("kept").select(*[F.col(b).alias(a) for a, b in own.items()])

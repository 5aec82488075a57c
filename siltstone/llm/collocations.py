"""Phrases that occur together more than their parts would, by sorting suffixes.

A suffix is the run of at most five words from one word on, within its piece of text; a
word is a 64-bit hash of itself and its language, so languages never mix. The work goes
down the levels and leaves out what cannot be frequent:

1. Words are counted. Of the frequent ones a bit field of fixed size is made.
2. Pairs of words that pass the field are counted, and make a second field.
3. A suffix ends before the first word that no frequent pair leads to. Equal suffixes of a
   task become one with a weight; those of two words or more are routed by their leading
   words: by the first, by two where the first is hot, by three where the first two are.
   A word or pair is hot with more than one in ``HOT_SHARE`` of all occurrences, so there
   are at most that many of either. A task writes one compressed block for each route.
4. A partition sorts pointers to the suffixes of its routes by multikey three-way
   quicksort: the pointers less than, equal to and greater than a pivot word; the equal
   ones go on to the next word, and their weight is how often the phrase occurs. Less
   frequent partitions are abandoned. Only a hot pair is spread over routes: its
   weight is reported by each and summed.

A field's size does not grow with the input. A field that is full lets more pass, and
the counts that follow are exact whatever it lets pass.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.llm.scratch import Scratch
from siltstone.llm.words import blocks, give_back, mixed, spans, windows

LONGEST = 5
FREQUENT = 100
TOP = 2000
FIELD_BITS = 26
BLOCK_BYTES = 1 << 22
PARTITION_ROWS = 500_000
ROUTES_A_PARTITION = 8
HELD_ROWS = 1_000_000
HOT_SHARE = 1000
TOP_PARTS = 256
#: Languages' totals are broadcast up to this number of languages, joined by shuffle beyond.
MOST_LANGUAGES = 10_000

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A") : ord("Z") + 1] += 32
_BREAK = np.zeros(256, bool)
_BREAK[[*map(ord, ".,;:!?"), *range(0x0A, 0x0E)]] = True
_GAP = _BREAK.copy()
_GAP[[0x20, 0x09]] = True
_NAMES = [f"w{i}" for i in range(1, LONGEST + 1)]


class LanguageWords:
    """The words of a block: bytes, borders, hashes with their language, and which piece each is in."""

    def __init__(self, raw: np.ndarray, ends: np.ndarray, languages: np.ndarray):
        self.raw = _FOLD[raw]
        edge = np.zeros(len(raw) + 1, bool)
        edge[ends] = True
        solid = ~_GAP[raw]
        opens, closes = solid.copy(), solid.copy()
        opens[1:] &= ~solid[:-1] | edge[1:-1]
        closes[:-1] &= ~solid[1:] | edge[1:-1]
        self.starts, self.stops = np.flatnonzero(opens), np.flatnonzero(closes) + 1
        self.row = np.searchsorted(ends, self.starts, side="right") - 1
        hashes = spans(self.raw, self.starts, self.stops) if len(self.starts) else np.zeros(0, np.uint64)
        # Zero is the end of a suffix.
        self.hashes = np.maximum(mixed(hashes ^ languages[self.row]), np.uint64(1))
        border = np.concatenate([[0], np.cumsum(_BREAK[raw] | edge[:-1])])
        self.piece = border[self.starts + 1] if len(self.starts) else np.zeros(0, np.int64)

    def pairs(self) -> np.ndarray:
        """Whether a word and the next one are in one piece."""
        return self.piece[:-1] == self.piece[1:]


def _language_hashes(languages: pa.Array) -> np.ndarray:
    coded = languages.dictionary_encode()
    names = coded.dictionary.to_pylist()
    if not names:
        return np.zeros(0, np.uint64)
    text = [np.frombuffer(x.encode() + b"\x00", np.uint8) for x in names]
    stops = np.cumsum(list(map(len, text)))
    hashes = spans(np.concatenate(text), np.concatenate([[0], stops[:-1]]), stops)
    return hashes[coded.indices.to_numpy(zero_copy_only=False)]


def _each_block(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[LanguageWords, pa.Array]]:
    """Words and languages of all blocks of (text, lang) batches."""
    for batch in batches:
        text, languages = batch.column(0), batch.column(1)
        hashes = _language_hashes(languages)
        for start, stop, raw, ends in blocks(text, BLOCK_BYTES):
            yield LanguageWords(raw, ends, hashes[start:stop]), languages.slice(start, stop - start)


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64))


def _slices(raw: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> pa.Array:
    """The strings from each start to its stop; bytes that are no UTF-8 stay as they are."""
    lengths = stops - starts
    after = np.cumsum(lengths)
    picked = raw[np.repeat(starts - (after - lengths), lengths) + np.arange(lengths.sum())]
    offsets = np.concatenate([[0], after]).astype(np.int32)
    return pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(picked.tobytes()))


def _words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for words, languages in _each_block(batches):
        hashes, first, counts = np.unique(words.hashes, return_index=True, return_counts=True)
        yield pa.RecordBatch.from_arrays(
            [
                languages.take(pa.array(words.row[first])), _signed(hashes),
                _slices(words.raw, words.starts[first], words.stops[first]), pa.array(counts, pa.int64()),
            ],
            names=["lang", "h", "word", "n"],
        )
    give_back()


def word_counts(texts: DataFrame) -> DataFrame:
    """lang, word, its hash h and how often it occurs, of (text, lang) rows."""
    counted = texts.mapInArrow(_words, "lang string, h long, word string, n long")
    return counted.groupBy("lang", "h", "word").agg(F.sum("n").alias("f"))


def bit_field(hashes: DataFrame, bits: int = FIELD_BITS) -> np.ndarray:
    """A field of 2^bits bits in which the leading bits of every hash ``h`` are set; its size is fixed."""
    # Bitmaps number their bits from 1.
    place = F.shiftrightunsigned("h", 64 - bits) + F.lit(1)
    rows = hashes.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")
    )
    field = np.zeros(1 << (bits - 3), np.uint8)
    for row in rows.collect():
        at = (row.bucket - 1) * 4096
        field[at : at + 4096] = np.frombuffer(row.bits, np.uint8)[: len(field) - at]
    return field


def passes(field: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether the bit of each hash is set."""
    place = hashes >> np.uint64(64 - (len(field) * 8).bit_length() + 1)
    return (field[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1


def frequent_pairs(texts: DataFrame, word_field: np.ndarray, least: int) -> DataFrame:
    """Hashes of the pairs of words that occur ``least`` times or more; other pairs do not matter."""
    field = texts.sparkSession.sparkContext.broadcast(word_field)

    def pairs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words, _ in _each_block(batches):
            good = passes(field.value, words.hashes)
            at = np.flatnonzero(words.pairs() & good[:-1] & good[1:]) if len(good) else np.zeros(0, np.int64)
            hashes, counts = np.unique(windows(words.hashes, 2)[at], return_counts=True)
            yield pa.RecordBatch.from_arrays([_signed(hashes), pa.array(counts, pa.int64())], names=["h", "n"])
        give_back()

    counted = texts.mapInArrow(pairs, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    return counted.filter(F.col("n") >= least)


def _hot(counts: DataFrame, count: str) -> np.ndarray:
    """The hashes ``h`` with more than one in ``HOT_SHARE`` of all occurrences: fewer than ``HOT_SHARE``."""
    total = counts.agg(F.coalesce(F.sum(count), F.lit(0))).first()[0]
    rows = counts.filter(F.col(count) * HOT_SHARE > total).select("h").collect()
    return np.array([row.h for row in rows], np.int64).view(np.uint64)


def _merged(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct columns of ``keys`` in order, and the sums of their weights."""
    order = np.lexsort(keys[::-1])
    keys, weights = keys[:, order], weights[order]
    new = np.ones(keys.shape[1], bool)
    new[1:] = (keys[:, 1:] != keys[:, :-1]).any(axis=0)
    at = np.flatnonzero(new)
    return keys[:, at], np.add.reduceat(weights, at) if len(at) else weights


def _leading(keys: np.ndarray, hot_words: np.ndarray, hot_pairs: np.ndarray) -> np.ndarray:
    """A hash of the leading words by which each suffix is routed."""
    one, two = keys[0], _run_hash(keys[:2])
    three = _run_hash(keys[:3])
    return np.where(np.isin(one, hot_words), np.where(np.isin(two, hot_pairs), three, two), mixed(one))


def _packed(keys: np.ndarray, weights: np.ndarray) -> bytes:
    """Sorted suffixes column by column, compressed."""
    data = np.vstack([keys, weights.view(np.uint64)[None]]).tobytes()
    return len(weights).to_bytes(8, "little") + pa.compress(data, "zstd", asbytes=True)


def _unpacked(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    count = int.from_bytes(blob[:8], "little")
    data = pa.decompress(blob[8:], count * 8 * (LONGEST + 1), "zstd", asbytes=True)
    both = np.frombuffer(data, np.uint64).reshape(LONGEST + 1, count)
    return both[:LONGEST], both[LONGEST].view(np.int64)


def weighted_suffixes(
    texts: DataFrame, pair_field: np.ndarray, hot_words: np.ndarray, hot_pairs: np.ndarray, routes: int
) -> DataFrame:
    """Per task and route a block of suffixes of two words or more that frequent pairs lead through, with weights."""
    field = texts.sparkSession.sparkContext.broadcast(pair_field)

    def suffixes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0

        def batch() -> pa.RecordBatch:
            keys, weights = _merged(np.hstack([k for k, _ in held]), np.concatenate([w for _, w in held]))
            route = (_leading(keys, hot_words, hot_pairs) % np.uint64(routes)).astype(np.int64)
            order = np.argsort(route, kind="stable")
            keys, weights, route = keys[:, order], weights[order], route[order]
            first = np.flatnonzero(np.diff(route, prepend=-1))
            edges = np.append(first, len(route)).tolist()
            blobs = [_packed(keys[:, x:y], weights[x:y]) for x, y in zip(edges[:-1], edges[1:], strict=True)]
            return pa.RecordBatch.from_arrays(
                [pa.array(route[first]), pa.array(blobs, pa.binary())], names=["route", "suffixes"]
            )

        for words, _ in _each_block(batches):
            count = len(words.hashes)
            if count < 2:
                continue
            linked = np.zeros(count + LONGEST, bool)
            linked[: count - 1] = words.pairs() & passes(field.value, windows(words.hashes, 2))
            at = np.flatnonzero(linked)
            padded = np.concatenate([words.hashes, np.zeros(LONGEST, np.uint64)])
            keys = np.zeros((LONGEST, len(at)), np.uint64)
            keys[0], going = padded[at], np.ones(len(at), bool)
            for place in range(1, LONGEST):
                going = going & linked[at + place - 1]
                keys[place] = np.where(going, padded[at + place], 0)
            held.append(_merged(keys, np.ones(len(at), np.int64)))
            rows += held[-1][0].shape[1]
            if rows > HELD_ROWS:
                yield batch()
                held, rows = [], 0
        if rows:
            yield batch()
        give_back()

    return texts.mapInArrow(suffixes, "route long, suffixes binary")


def multikey_quicksort(
    keys: np.ndarray, weights: np.ndarray, least: int
) -> Iterator[tuple[int, int, int]]:
    """(a pointer, depth, weight) of every phrase of two words or more with weight ``least`` at the least.

    ``keys`` has a row for each depth and a column for each suffix. A phrase is the first
    ``depth`` words of the suffix that the pointer names.
    """
    stack = [(np.arange(keys.shape[1]), 0)]
    while stack:
        pointers, depth = stack.pop()
        here = keys[depth, pointers]
        pivot = np.sort(here[[0, len(here) // 2, -1]])[1] if len(here) else np.uint64(0)
        for part, equal in (
            (pointers[here < pivot], False), (pointers[here > pivot], False), (pointers[here == pivot], True),
        ):
            weight = int(weights[part].sum())
            if weight < least:
                continue
            if not equal:
                stack.append((part, depth))
            elif pivot:
                if depth:
                    yield int(part[0]), depth + 1, weight
                if depth + 1 < len(keys):
                    stack.append((part, depth + 1))


def _phrase_rows(keys: np.ndarray, found: list[tuple[int, int, int]]) -> pa.RecordBatch:
    pointers = np.array([x[0] for x in found], np.int64)
    depths = np.array([x[1] for x in found], np.int64)
    picked = keys[:, pointers] * (np.arange(len(keys))[:, None] < depths)
    columns = [*map(_signed, picked.astype(np.uint64)), pa.array([x[2] for x in found], pa.int64())]
    return pa.RecordBatch.from_arrays(columns, names=[*_NAMES, "n"])


def _hot_pair_weights(
    keys: np.ndarray, weights: np.ndarray, hot_pairs: np.ndarray, found: list[tuple[int, int, int]]
) -> Iterator[tuple[int, int, int]]:
    """What a partition has of each hot pair, as far as the sort did not report it."""
    at = np.flatnonzero(np.isin(_run_hash(keys[:2]), hot_pairs))
    known = {keys[:2, pointer].tobytes() for pointer, depth, _ in found if depth == 2}
    _, first, place = np.unique(keys[:2, at], axis=1, return_index=True, return_inverse=True)
    sums = np.bincount(place.ravel(), weights[at], len(first)).astype(np.int64)
    for pointer, weight in zip(at[first].tolist(), sums.tolist(), strict=True):
        if keys[:2, pointer].tobytes() not in known:
            yield pointer, 2, weight


def _sorted_phrases(
    least: int, hot_pairs: np.ndarray
) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def phrases(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [_unpacked(blob.as_buffer().to_pybytes()) for batch in batches for blob in batch.column(1)]
        if not parts:
            return
        keys = np.hstack([x for x, _ in parts])
        weights = np.concatenate([x for _, x in parts])
        found = list(multikey_quicksort(keys, weights, least))
        found += _hot_pair_weights(keys, weights, hot_pairs, found)
        for start in range(0, len(found), 100_000):
            yield _phrase_rows(keys, found[start : start + 100_000])
        give_back()

    return phrases


def phrase_counts(blocks_of_suffixes: DataFrame, parts: int, least: int, hot_pairs: np.ndarray) -> DataFrame:
    """Words w1..w5 and frequency f of all phrases of 2 to 5 words that occur ``least`` times or more."""
    routed = blocks_of_suffixes.repartition(parts, "route")
    kind = ", ".join(f"{n} long" for n in [*_NAMES, "n"])
    reports = routed.mapInArrow(_sorted_phrases(least, hot_pairs), kind)
    summed = reports.groupBy(*_NAMES).agg(F.sum("n").alias("f"))
    return summed.filter(F.col("f") >= least)


def _keyed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds keys: of the phrase, of both parts of every cut, and of the shorter phrases within."""
    kind = pa.list_(pa.struct([("k", pa.int32()), ("left", pa.int64()), ("right", pa.int64())]))
    for batch in batches:
        words = np.array([batch.column(i).to_numpy(zero_copy_only=False) for i in range(LONGEST)]).view(np.uint64)
        size = (words != 0).sum(axis=0)
        run = {
            (a, n): _run_key(words[a : a + n]) for n in range(1, LONGEST + 1) for a in range(LONGEST - n + 1)
        }
        keys, cuts, inner = [], [], []
        for row, m in enumerate(size.tolist()):
            keys.append(run[0, m][row])
            cuts.append([{"k": k, "left": run[0, k][row], "right": run[k, m - k][row]} for k in range(1, m)])
            inner.append([run[a, n][row] for n in range(2, m) for a in range(m - n + 1)])
        columns = [*batch.columns, pa.array(keys, pa.int64()), pa.array(cuts, kind), pa.array(inner, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, names=[*_NAMES, "f", "p", "cuts", "inner"])


def _run_hash(words: np.ndarray) -> np.ndarray:
    """The hash of each column of words, as ``windows`` has it."""
    return windows(np.ascontiguousarray(words.T).ravel(), len(words))[:: len(words)]


def _run_key(words: np.ndarray) -> list[int]:
    """One key for each column of words; a single word is its own key."""
    if len(words) == 1:
        return words[0].view(np.int64).tolist()
    return mixed(_run_hash(words) + np.uint64(len(words))).view(np.int64).tolist()


def scored(phrases: DataFrame, words: DataFrame, totals: DataFrame) -> DataFrame:
    """lang, phrase, a, l, r, n, score of all phrases that no longer one as frequent contains."""
    counts = phrases.select("p", "f").unionAll(words.select(F.col("h").alias("p"), "f"))
    cuts = phrases.select("p", "w1", F.col("f").alias("a"), F.explode("cuts").alias("c"))
    cuts = cuts.select("p", "w1", "a", "c.k", "c.left", "c.right")
    cuts = cuts.join(counts.select(F.col("p").alias("left"), F.col("f").alias("l")), "left")
    cuts = cuts.join(counts.select(F.col("p").alias("right"), F.col("f").alias("r")), "right")
    named = words.select(F.col("h").alias("w1"), "lang").join(totals, "lang")
    cuts = cuts.join(named, "w1").withColumn("score", _score())
    best = cuts.groupBy("p").agg(F.min(F.struct("score", "k", "l", "r", "n", "a", "lang")).alias("best"))
    longer = phrases.select(F.explode("inner").alias("p"), "f").groupBy("p").agg(F.max("f").alias("longer"))
    kept = phrases.select("p", "f", *_NAMES).join(longer, "p", "left")
    kept = kept.filter(F.col("longer").isNull() | (F.col("longer") < F.col("f")))
    spelled = kept.select("p", F.posexplode(F.array(*_NAMES)).alias("place", "h")).filter("h <> 0")
    spelled = spelled.join(words.select("h", "word"), "h").groupBy("p").agg(
        F.array_sort(F.collect_list(F.struct("place", "word"))).alias("parts")
    )
    phrase = F.array_join(F.transform("parts", lambda x: x["word"]), " ")
    return spelled.select("p", phrase.alias("phrase")).join(best, "p").select(
        "best.lang", "phrase", "best.a", "best.l", "best.r", "best.n", "best.score"
    )


def _score() -> Column:
    """floor(1000 * a * n / (l * r)) in whole numbers of up to 38 digits."""
    return F.expr(
        "(cast(1000 as decimal(4,0)) * cast(a as decimal(16,0)) * cast(n as decimal(16,0)))"
        " div (cast(l as decimal(16,0)) * cast(r as decimal(16,0)))"
    )


def _top(rows: DataFrame, top: int) -> DataFrame:
    """Each language's first rows; first those of its parts, so that no task sorts a whole language."""
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    part = F.pmod(F.xxhash64("phrase"), F.lit(TOP_PARTS))
    rows = rows.withColumn("_part", part)
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order)))
    rows = rows.filter(F.col("rank") <= top)
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    return rows.filter(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )


def collocations(
    docs: DataFrame, *, text: str = "text", lang: str = "lang", least: int = FREQUENT, top: int = TOP
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first ``top`` phrases by score.

    Texts, A-Z folded, are split at ``[.,;:!?]`` and line breaks into pieces and those at
    spaces and tabs into words. A candidate is a phrase of 2 to 5 words that occurs ``a >=
    least`` times within pieces, overlaps included. Cut after its first k words, with l
    and r the frequencies of both parts and n the language's words, it scores
    floor(1000 a n / (l r)), computed exactly; its lowest cut counts, the first of equals. A candidate
    inside a longer one that is as frequent is dropped. Order: score, a, both falling,
    then the phrase by its bytes.

    A null language is ``und``, together with rows that say so; a null or empty text has
    no words; repeated rows count each time; an empty table gives an empty one. Texts are
    read whole. No other column is read, whatever its name. Words and phrases are told
    apart by 64-bit hashes.
    """
    texts = docs.select(
        F.col(f"`{text}`").cast("string").alias("text"), F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang")
    )
    scratch = Scratch(docs.sparkSession)
    counted = scratch.keep(word_counts(texts), "words")
    totals = scratch.keep(counted.groupBy("lang").agg(F.sum("f").alias("n")), "totals")
    if totals.count() <= MOST_LANGUAGES:
        totals = F.broadcast(totals)
    words = counted.filter(F.col("f") >= least)
    pairs = scratch.keep(frequent_pairs(texts, bit_field(words.select("h")), least), "pairs")
    occurrences = pairs.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    # Every suffix begins with an occurrence of a frequent pair.
    parts = max(int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-occurrences // PARTITION_ROWS))
    hot_words, hot_pairs = _hot(words, "f"), _hot(pairs, "n")
    suffixes = weighted_suffixes(
        texts, bit_field(pairs.select("h")), hot_words, hot_pairs, parts * ROUTES_A_PARTITION
    )
    found = phrase_counts(scratch.keep(suffixes, "suffixes"), parts, least, hot_pairs)
    fields = T.StructType.fromDDL(
        "p long, cuts array<struct<k:int,left:long,right:long>>, inner array<long>"
    )
    phrases = found.mapInArrow(_keyed, T.StructType(found.schema.fields + fields.fields))
    phrases = scratch.keep(phrases, "phrases")
    return _top(scored(phrases, words, totals), top)


#: The same in SQL: all phrases of one to five words, counted as text.
COLLOCATIONS_SQL = r"""
WITH pieces AS (
  SELECT lang, [x FOR x IN string_split_regex(piece, '[ \t]+') IF x <> ''] AS w FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
grams AS (
  SELECT lang, k, unnest([array_to_string(w[i:i + k - 1], ' ') FOR i IN range(1, len(w) - k + 2)]) AS phrase
  FROM pieces, (VALUES (1), (2), (3), (4), (5)) AS sizes(k) WHERE len(w) >= k),
counts AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY lang, k, phrase),
totals AS (SELECT lang, sum(f) AS n FROM counts WHERE k = 1 GROUP BY lang),
often AS (SELECT *, string_split(phrase, ' ') AS w FROM counts WHERE f >= 100),
cuts AS (SELECT *, unnest(range(1, k)) AS j FROM often WHERE k >= 2),
scores AS (
  SELECT c.lang, c.phrase, c.f AS a, x.f AS l, y.f AS r, n,
    CAST((CAST(1000 AS HUGEINT) * c.f * n) // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score, j
  FROM cuts c JOIN often x ON x.lang = c.lang AND x.k = j AND x.phrase = array_to_string(c.w[1:j], ' ')
  JOIN often y ON y.lang = c.lang AND y.k = c.k - j AND y.phrase = array_to_string(c.w[j + 1:c.k], ' ')
  JOIN totals t ON t.lang = c.lang),
lowest AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
inner_phrases AS (
  SELECT lang, f, unnest([array_to_string(w[i:i + m - 1], ' ') FOR i IN range(1, k - m + 2)]) AS phrase
  FROM often, (VALUES (2), (3), (4)) AS shorter(m) WHERE m < k),
longer AS (SELECT lang, phrase, max(f) AS f FROM inner_phrases GROUP BY lang, phrase)
SELECT s.lang, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, s.phrase) AS rank,
  s.phrase, a, l, r, CAST(n AS BIGINT) AS n, score
FROM lowest s LEFT JOIN longer b ON b.lang = s.lang AND b.phrase = s.phrase
WHERE b.f IS NULL OR b.f < a
QUALIFY rank <= 2000"""

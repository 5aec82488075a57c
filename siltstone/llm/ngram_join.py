"""N-gram Jaccard join with adaptive multi-match prefixes.

Documents are sets of word shingles; two of them link when their Jaccard similarity
reaches a bound. The join is exact (up to collisions of 64-bit hashes):

1. Documents with equal sets become one class, known by a hash of the set.
2. Shingles are dealt by hash into buckets as packed arrays; a bucket counts in how many
   classes each shingle occurs. A shingle of one class can link nothing, so only the
   others travel on. A class whose shared shingles are less than the bound's part of
   its set leaves here.
3. Shingles are ordered by that frequency. A class of n shingles is found by its first
   ``n - ceil(bound * n) + l`` ones, and two linked classes share at least
   ``min(l, l')`` of theirs. Each class chooses its own ``l``: a longer prefix reads
   more postings, yet divides the candidates (at most postings / l) that need a check.
4. First each shingle's classes are checked against one of them, that with the fewest
   unshared shingles. Only pairs that this leaves in different components are looked for
   next, by the first shingle that they share: its ranks in both orders must leave room
   for the rest that a link needs. Pairs with enough common prefix shingles are verified.
   So a group of copies costs links in
   proportion to its size, not to its square, and no component is lost.
5. Components come from stars over written link tables.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.components import components
from siltstone.llm.scratch import Scratch
from siltstone.llm.words import Words, blocks, gives_back, set_hashes, shingle_sets

CHUNK = 2_000_000
MOST_MATCHES = 16
_PACK = "part int, sets binary, sizes binary, counts binary, high binary, low binary"
_SHARED = "part int, sets binary, sizes binary, counts binary, grams binary, found binary"


def signatures(docs: DataFrame, n: int, carried: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``carried`` columns, n_shingles, set_id of every row; a null or wordless text has no shingle."""

    @gives_back
    def sign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            last = batch.num_columns - 1
            for a, b, raw, ends in blocks(batch.column(last)):
                values, bounds = shingle_sets(Words(raw, ends, True), n)
                own = [batch.column(i)[a:b] for i in range(last)]
                yield pa.RecordBatch.from_arrays(
                    [*own, pa.array(np.diff(bounds)), pa.array(set_hashes(values, bounds))],
                    [*carried, "n_shingles", "set_id"],
                )

    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in carried)
    return docs.select(*carried, "text").mapInArrow(sign, f"{kinds}, n_shingles long, set_id long")


def _grouped(batches: Iterable[pa.RecordBatch], width: int) -> Iterator[tuple[int, list[list[np.ndarray]]]]:
    """Runs of rows of equal ``part`` in sorted rows, with their binary columns as arrays of bytes."""
    part, rows = None, []
    for batch in batches:
        parts = batch.column(0).to_pylist()
        columns = [batch.column(i) for i in range(1, width)]
        for row, at in enumerate(parts):
            if at != part and rows:
                yield part, rows
                rows = []
            part = at
            rows.append([column[row].as_buffer() for column in columns])
    if rows:
        yield part, rows


def _gathered(rows: list[list], place: int, kind: type) -> np.ndarray:
    return np.concatenate([np.frombuffer(row[place], dtype=kind) for row in rows])


def _packs(docs: DataFrame, n: int, bits: int) -> DataFrame:
    """Distinct shingles of the sets of each input partition, packed by bucket: the first bits of their hash."""
    shift, width = np.uint64(bits), np.uint64(64 - bits)

    def pack(held: list) -> Iterator[pa.RecordBatch]:
        sets, sizes, values = (np.concatenate(x) for x in zip(*held, strict=True))
        owner = np.repeat(np.arange(len(sets)), sizes)
        bucket = (values >> width).astype(np.uint32) if bits else np.zeros(len(values), np.uint32)
        order = np.argsort(bucket.astype(np.uint16) if bits <= 16 else bucket, kind="stable")
        bucket, owner, rest = bucket[order], owner[order], (values[order] << shift) >> np.uint64(16)
        cuts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
        out = {key: [] for key in ("part", "sets", "sizes", "counts", "high", "low")}
        for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(bucket)], strict=True):
            own, counts = np.unique(owner[a:b], return_counts=True)
            out["part"].append(int(bucket[a]))
            out["sets"].append(sets[own].tobytes())
            out["sizes"].append(sizes[own].astype(np.uint32).tobytes())
            out["counts"].append(counts.astype(np.uint32).tobytes())
            out["high"].append((rest[a:b] >> np.uint64(16)).astype(np.uint32).tobytes())
            out["low"].append(rest[a:b].astype(np.uint16).tobytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array(out["part"], pa.int32()), *(pa.array(out[k], pa.binary()) for k in list(out)[1:])], list(out)
        )

    @gives_back
    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: set[int] = set()
        held, total = [], 0
        for batch in batches:
            for _, _, raw, ends in blocks(batch.column(0)):
                values, bounds = shingle_sets(Words(raw, ends, True), n)
                sets, sizes = set_hashes(values, bounds), np.diff(bounds)
                fresh = np.zeros(len(sets), dtype=bool)
                for row, (one, size) in enumerate(zip(sets.tolist(), sizes.tolist(), strict=True)):
                    if size and one not in known:
                        known.add(one)
                        fresh[row] = True
                if not fresh.any():
                    continue
                held.append((sets[fresh], sizes[fresh], values[np.repeat(fresh, sizes)]))
                total += int(sizes[fresh].sum())
                if total >= CHUNK:
                    yield from pack(held)
                    held, total = [], 0
        if held:
            yield from pack(held)

    return docs.select("text").mapInArrow(deal, _PACK)


def _shared(packs: DataFrame, bits: int) -> DataFrame:
    """Of each bucket, the shingles that two or more sets hold, with their count, packed by set."""
    back, under = np.uint64(64 - bits), np.uint64(bits)

    @gives_back
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, rows in _grouped(batches, 6):
            sets, sizes = _gathered(rows, 0, np.int64), _gathered(rows, 1, np.uint32)
            counts = _gathered(rows, 2, np.uint32)
            rest = (_gathered(rows, 3, np.uint32).astype(np.uint64) << np.uint64(16)) | _gathered(rows, 4, np.uint16)
            rows.clear()
            # The same set can come from several input partitions: its first arrival counts.
            parts = (sets & 0xFFFF).astype(np.uint16) % (1 << min(bits, 15))
            order = np.lexsort((sets, parts))
            first = np.ones(len(sets), dtype=bool)
            first[1:] = sets[order][1:] != sets[order][:-1]
            rank = np.full(len(sets), -1, dtype=np.int64)
            rank[order[first]] = np.arange(first.sum())
            owner = np.repeat(rank, counts)
            rest, owner = rest[owner >= 0], owner[owner >= 0]
            by = np.argsort(rest)
            rest, owner = rest[by], owner[by]
            new = np.concatenate([[True], rest[1:] != rest[:-1]])
            runs = np.diff(np.concatenate([np.flatnonzero(new), [len(rest)]]))
            found = np.repeat(runs, runs)
            keep = found > 1
            rest, owner, found = rest[keep], owner[keep], found[keep]
            if not len(rest):
                continue
            by = np.argsort(owner, kind="stable")
            rest, owner, found = rest[by], owner[by], found[by]
            grams = ((rest << np.uint64(16)) >> under) | (np.uint64(bucket) << back if bits else np.uint64(0))
            sets, sizes, parts = sets[order[first]], sizes[order[first]], parts[order[first]]
            own, counts = np.unique(owner, return_counts=True)
            ends = np.concatenate([[0], np.cumsum(counts)])
            cuts = np.flatnonzero(np.concatenate([[True], parts[own][1:] != parts[own][:-1]])).tolist()
            out = {key: [] for key in ("part", "sets", "sizes", "counts", "grams", "found")}
            for a, b in zip(cuts, [*cuts[1:], len(own)], strict=True):
                s, e = ends[a], ends[b]
                out["part"].append(int(parts[own[a]]))
                out["sets"].append(sets[own[a:b]].tobytes())
                out["sizes"].append(sizes[own[a:b]].tobytes())
                out["counts"].append(counts[a:b].astype(np.uint32).tobytes())
                out["grams"].append(grams[s:e].tobytes())
                out["found"].append(found[s:e].astype(np.uint32).tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["part"], pa.int32()), *(pa.array(out[k], pa.binary()) for k in list(out)[1:])], list(out)
            )

    return packs.repartition(1 << bits, "part").sortWithinPartitions("part").mapInArrow(count, _SHARED)


def least_shared(size: int, percent: int) -> int:
    """Shingles that a set of this size must share with any linked one."""
    return -(-size * percent // 100)


def choose_matches(found: np.ndarray, size: int, percent: int) -> tuple[int, int]:
    """(l, shared shingles in the prefix) of the cheapest prefix; ``found`` are frequencies, ascending.

    The cost of l is the postings that its prefix reads and, for each candidate that can
    have l matches among them (postings / l at most), a check in proportion to the set.
    """
    need = least_shared(size, percent)
    base = len(found) - need
    most = min(MOST_MATCHES, need)
    postings = np.cumsum(found.astype(np.int64) - 1)[base : base + most]
    matches = np.arange(1, most + 1)
    best = int(np.argmin(postings + postings / matches * (1 + size / 32)))
    return best + 1, base + best + 1


def _survivors(shared: DataFrame, bits: int, percent: int) -> DataFrame:
    """Sets that share enough shingles with others: these shingles, and their prefix."""

    @gives_back
    def select(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _grouped(batches, 6):
            sets, sizes = _gathered(rows, 0, np.int64), _gathered(rows, 1, np.uint32)
            counts, grams = _gathered(rows, 2, np.uint32), _gathered(rows, 3, np.uint64)
            found = _gathered(rows, 4, np.uint32)
            rows.clear()
            own, first, place = np.unique(sets, return_index=True, return_inverse=True)
            total = np.bincount(place, weights=counts).astype(np.int64)
            size = sizes[first].astype(np.int64)
            owner = np.repeat(place, counts)
            keep = (100 * total >= percent * size)[owner]
            owner, grams, found = owner[keep], grams[keep], found[keep]
            by = np.lexsort((grams, found, owner))
            owner, grams, found = owner[by], grams[by], found[by]
            cuts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]])).tolist() if len(owner) else []
            out: list[tuple] = []
            for a, b in zip(cuts, [*cuts[1:], len(owner)] if cuts else [], strict=True):
                one = int(owner[a])
                matches, prefix = choose_matches(found[a:b], int(size[one]), percent)
                out.append((
                    int(own[one]), int(size[one]), b - a, matches,
                    grams[a : a + prefix].view(np.int64), np.sort(grams[a:b]).tobytes(),
                ))
                if len(out) == 2000:
                    yield _survivor_batch(out)
                    out = []
            if out:
                yield _survivor_batch(out)

    schema = "set_id long, size int, shared int, matches int, prefix array<long>, grams binary"
    return shared.repartition(1 << min(bits, 15), "part").sortWithinPartitions("part").mapInArrow(select, schema)


def _survivor_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(columns[0], pa.int64()), *(pa.array(columns[i], pa.int32()) for i in (1, 2, 3)),
            pa.array(list(columns[4]), pa.list_(pa.int64())), pa.array(columns[5], pa.binary()),
        ],
        ["set_id", "size", "shared", "matches", "prefix", "grams"],
    )


def _can_link(percent: int) -> str:
    """Whether sizes and shared shingles of a and b leave room for a link."""
    return f"least(a.shared, b.shared) * {100 + percent}L >= {percent} * (a.size + b.size)"


def _early(percent: int) -> str:
    """Whether a shingle can be the first that a and b share, if they link.

    They share at most it and all that comes later in both orders.
    """
    most = "1 + least(a.size - a.rank, b.size - b.rank)"
    return f"({most}) * {100 + percent}L >= {percent} * (a.size + b.size)"


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of (a, b) that share enough prefix shingles and whose sets reach the bound."""

    def common(a: np.ndarray, b: np.ndarray) -> int:
        if len(a) > len(b):
            a, b = b, a
        at = np.searchsorted(b, a)
        return int((b[np.minimum(at, len(b) - 1)] == a).sum())

    @gives_back
    def check(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size_a, size_b, needed = (batch.column(i).to_pylist() for i in (2, 3, 4))
            grams_a, grams_b, first_a, first_b = (batch.column(i) for i in (5, 6, 7, 8))
            good = []
            for row in range(batch.num_rows):
                a, b = (np.sort(x[row].values.to_numpy()) for x in (first_a, first_b))
                if common(a, b) < needed[row]:
                    good.append(False)
                    continue
                a, b = (np.frombuffer(x[row].as_buffer(), dtype=np.uint64) for x in (grams_a, grams_b))
                both = common(a, b)
                good.append(100 * both >= percent * (size_a[row] + size_b[row] - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(good))

    left, right = (
        sets.select(F.col("set_id").alias(x), *[F.col(c).alias(f"{c}_{x}") for c in ("size", "matches", "grams", "prefix")])
        for x in ("a", "b")
    )
    loaded = pairs.join(left, "a").join(right, "b").select(
        "a", "b", "size_a", "size_b", F.least("matches_a", "matches_b"), "grams_a", "grams_b", "prefix_a", "prefix_b"
    )
    return loaded.mapInArrow(check, "a long, b long")


def link_classes(docs: DataFrame, scratch: Scratch, n: int, percent: int, bits: int | None = None) -> DataFrame:
    """(set_id, label): the linked classes, each with its component's smallest set_id."""
    if bits is None:
        bits = max(4, int(docs.rdd.getNumPartitions() - 1).bit_length())
    shared = _shared(_packs(docs, n, bits), bits)
    sets = scratch.keep(_survivors(shared, bits, percent), "sets")
    postings = sets.select(
        "set_id", "size", "shared", "matches", F.posexplode("prefix").alias("at", "gram")
    ).withColumn("rank", F.expr("size - shared + at + 1")).drop("at")
    hubs = (
        postings.groupBy("gram")
        .agg(F.min(F.struct(F.expr("size - shared").alias("rest"), "set_id", "size", "shared")).alias("hub"),
             F.count("*").alias("found"))
        .where("found > 1")
        .select("gram", "hub.set_id", "hub.size", "hub.shared")
    )
    stars = (
        postings.alias("a").join(hubs.alias("b"), "gram")
        .where(f"a.set_id <> b.set_id and {_can_link(percent)}")
        .select(F.col("a.set_id").alias("a"), F.col("b.set_id").alias("b"))
        .distinct()
    )
    links = scratch.keep(_verified(stars, sets, percent), "star-links")
    labels = components(links, scratch, "star")
    known = postings.join(labels.withColumnRenamed("id", "set_id"), "set_id", "left").withColumn(
        "label", F.coalesce("label", "set_id")
    )
    split = known.groupBy("gram").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high")
    open_ = scratch.keep(known.join(split.select("gram"), "gram", "left_semi"), "open")
    pairs = (
        open_.alias("a").join(open_.alias("b"), "gram")
        .where(f"a.set_id < b.set_id and a.label <> b.label and {_can_link(percent)} and {_early(percent)}")
        .select(F.col("a.set_id").alias("a"), F.col("b.set_id").alias("b"))
        .distinct()
    )
    rest = scratch.keep(_verified(pairs, sets, percent), "rest-links")
    return components(links.unionByName(rest), scratch, "all").withColumnRenamed("id", "set_id")


def ngram_components(docs: DataFrame, *, n: int = 5, percent: int = 75, bits: int | None = None) -> DataFrame:
    """Every row of ``docs`` (doc_id long, text string) with its shingle count and component.

    Returns doc_id, n_shingles, component_id: the smallest doc_id that links reach, the
    row's own included. Texts without words (null, empty, white space) have no shingle
    and link with nothing, not with each other. Rows with equal texts link; a row that
    repeats a doc_id stays a row of its own. A null doc_id is never a component's
    smallest one, unless it is alone. Other columns are ignored; an empty table gives an
    empty result. ``bits`` sets the number of hash buckets (2 ** bits), by default from
    the number of input partitions, so that a bucket's size does not grow with the input.
    """
    scratch = Scratch(docs.sparkSession)
    signed = scratch.keep(signatures(docs, n), "signatures")
    labels = link_classes(docs, scratch, n, percent, bits)
    classes = (
        signed.where("n_shingles > 0").groupBy("set_id", "n_shingles")
        .agg(F.min("doc_id").alias("low"), F.count("*").alias("rows"))
        .join(labels, "set_id", "left")
        .where("rows > 1 or label is not null")
        .withColumn("label", F.coalesce("label", "set_id"))
    )
    lows = classes.groupBy("label").agg(F.min("low").alias("component"))
    classes = classes.join(lows, "label").select("set_id", "n_shingles", "component")
    return (
        signed.join(classes, ["set_id", "n_shingles"], "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
    )


def one_of_each(docs: DataFrame, *, n: int = 5, percent: int = 75) -> DataFrame:
    """One row of ``docs`` (doc_id, text) of each component, with all columns.

    It is that with the smallest doc_id, a null one last; among rows of one doc_id that
    with the smallest hash of all columns, and of equal rows any. Rows whose text has no
    words are like no other: all stay.
    """
    scratch = Scratch(docs.sparkSession)
    # A key by content: it is the same however often and wherever a row is read. Its name is free.
    values = [x for c in docs.columns for x in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))]
    own = "_row"
    while own in docs.columns:
        own += "_"
    keyed = docs.withColumn(own, F.xxhash64(*values))
    narrow = keyed.select("doc_id", "text", F.col(own).alias("_row"))
    signed = scratch.keep(signatures(narrow, n, ("doc_id", "_row")), "row-signatures")
    labels = link_classes(docs, scratch, n, percent)
    first = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "_row")
    classes = (
        signed.where("n_shingles > 0").groupBy("set_id")
        .agg(F.min(first).alias("first"), F.count("*").alias("rows"))
        .join(labels, "set_id", "left")
        .where("rows > 1 or label is not null")
        .withColumn("label", F.coalesce("label", "set_id"))
    )
    stays = classes.groupBy("label").agg(F.min("first").alias("stays"))
    classes = classes.join(stays, "label").select("set_id", "stays.doc_id", "stays._row")
    same = F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("a._row") == F.col("b._row"))
    grouped = signed.where("n_shingles > 0").alias("a").join(classes.alias("b"), "set_id")
    # Keys of rows that go, and those of rows that stay once of several equal ones.
    keys = grouped.groupBy("a.doc_id", "a._row").agg(F.max(same).alias("stays"), F.count("*").alias("rows"))
    keys = scratch.keep(keys.where("not stays or rows > 1"), "row-keys")
    own_row = F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col(f"a.{own}") == F.col("b._row"))
    names = [F.col(f"`{c}`") for c in docs.columns]
    rest = keyed.alias("a").join(keys.alias("b"), own_row, "left_anti").select(*names)
    if keys.where("stays").isEmpty():
        return rest
    once = keyed.alias("a").join(keys.where("stays").alias("b"), own_row, "left_semi").select(*names).distinct()
    return rest.unionByName(once)


JOIN_SQL = r"""
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x20\x09-\x0D]+') AS w FROM documents),
grams AS (
  SELECT doc_id, CASE WHEN w IS NULL OR len(w) = 0 THEN []
         WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
         ELSE list_distinct([array_to_string(w[i : i + 4], ' ') FOR i IN range(1, len(w) - 3)]) END AS g
  FROM split),
classes AS (SELECT list_sort(g) AS g, min(doc_id) AS low, list(doc_id) AS members FROM grams WHERE len(g) > 0 GROUP BY 1),
flat AS (SELECT low, len(g) AS n, unnest(g) AS gram FROM classes),
common AS (
  SELECT a.low AS a, b.low AS b, count(*) AS c, any_value(a.n + b.n) AS n
  FROM flat a JOIN flat b ON a.gram = b.gram AND a.low < b.low AND 4 * a.n >= 3 * b.n AND 4 * b.n >= 3 * a.n
  GROUP BY 1, 2),
links AS (SELECT a, b FROM common WHERE 100 * c >= 75 * (n - c)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT low AS id, low AS seen FROM classes UNION SELECT r.id, e.b FROM reach r JOIN both_ways e ON r.seen = e.a),
lows AS (SELECT id, min(seen) AS component FROM reach GROUP BY id),
placed AS (SELECT unnest(members) AS doc_id, component FROM classes JOIN lows ON low = id)
SELECT g.doc_id, len(g.g)::BIGINT AS n_shingles, coalesce(component, g.doc_id) AS component_id
FROM grams g LEFT JOIN placed p ON g.doc_id = p.doc_id
"""

"""Approximate nearest neighbours by inner product: adaptive dimension scan of inverted lists.

Vectors are turned to the principal axes of a bounded sample, so that their first columns
hold most of a product. k-means on the sample gives the lists' centres. A query is sent to
the lists nearest to it, first to a tenth of them; the k-th best product found there is its
bar, which goes with it to the others. A list, cut into blocks of bounded size, is read
column block by column block, for all queries of the cell at once.

After each column block a hypothesis test decides whether a candidate can still reach the
bar. The squared distance, or the product, over the columns read is known, and so are
the lengths of what is left of both vectors; to reach the bar, the rests would
need a cosine of at least (bar - product so far) / (|rest of q| |rest of x|). Critical values are the cosines
that all but a share ``miss`` of true neighbours in the sample stay below; a candidate
that needs more is abandoned and its other columns are not read. At a critical value of 1 the test
is exact. What is left is scored exactly, on the original vectors in double precision.

Equal vectors are one candidate with their smallest ids, and one query: a vector that a
third of all rows share costs one scan.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm.scratch import Scratch

BLOCK_ROWS = 8192
QUERY_ROWS = 2048
COLUMN_BLOCK = 8
#: Queries of a cell that are scanned together: bounds the matrix of products.
TOGETHER = 256
#: Share of the probed lists that are read first, to set the bar.
FIRST_LISTS = 0.1
#: Below this share of pairs in play, pairs are read one by one instead of by matrix product.
SPARSE = 0.25


@dataclass(frozen=True)
class Lists:
    """The rotation and the lists' centres, in rotated columns."""

    rotation: np.ndarray
    centres: np.ndarray

    def turned(self, vectors: np.ndarray) -> np.ndarray:
        return vectors @ self.rotation

    def nearest(self, turned: np.ndarray) -> np.ndarray:
        return np.argmax(turned @ self.centres.T - (self.centres**2).sum(axis=1) / 2, axis=1)

    def probed(self, turned: np.ndarray, probes: int) -> np.ndarray:
        """The numbers of the nearest lists of each row, nearest first."""
        far = (self.centres**2).sum(axis=1) / 2 - turned @ self.centres.T
        return np.argsort(far, axis=1, kind="stable")[:, : min(probes, len(self.centres))]


def fit_lists(sample: np.ndarray, lists: int, *, rounds: int = 8, seed: int = 3) -> Lists:
    """k-means on the sample; centres that lose all their vectors start again at others."""
    rng = np.random.default_rng(seed)
    # Principal axes about the origin, as products are, the longest first.
    rotation = np.linalg.eigh(sample.T @ sample)[1][:, ::-1]
    turned = sample @ rotation
    centres = turned[rng.choice(len(turned), min(lists, len(turned)), replace=False)].copy()
    for _ in range(rounds):
        near = Lists(rotation, centres).nearest(turned)
        counts = np.bincount(near, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, near, turned)
        centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], turned[rng.integers(len(turned), size=len(centres))])
    return Lists(rotation, centres)


def fit_probes(fitted: Lists, sample: np.ndarray, k: int, share: float, *, queries: int = 256) -> int:
    """The lists to probe so that they hold ``share`` of the k nearest of the sample's first vectors in it.

    The whole table is denser than the sample, so its neighbours lie nearer.
    """
    turned = fitted.turned(sample)
    asked = turned[:queries]
    scores = asked @ turned.T
    scores[np.arange(len(asked)), np.arange(len(asked))] = -np.inf
    k = min(k, len(sample) - 1)
    if k < 1:
        return len(fitted.centres)
    near = fitted.nearest(turned)[np.argpartition(-scores, k - 1, axis=1)[:, :k]]
    far = (fitted.centres**2).sum(axis=1) / 2 - asked @ fitted.centres.T
    place = np.empty(far.shape, np.int64)
    np.put_along_axis(place, np.argsort(far, axis=1), np.arange(len(fitted.centres))[None, :].repeat(len(asked), 0), axis=1)
    needed = np.sort(np.take_along_axis(place, near, axis=1).ravel())
    return int(needed[min(len(needed) - 1, int(share * len(needed)))]) + 1


def _borders(width: int) -> list[int]:
    """Where column blocks end."""
    return [*range(COLUMN_BLOCK, width, COLUMN_BLOCK), width]


def _rests(turned: np.ndarray) -> np.ndarray:
    """The length of each vector's columns after every column block."""
    left = np.cumsum((turned**2)[:, ::-1], axis=1)[:, ::-1]
    left = np.hstack([left, np.zeros((len(turned), 1))])
    return np.sqrt(left[:, _borders(turned.shape[1])])


def fit_tests(fitted: Lists, sample: np.ndarray, k: int, miss: float, *, queries: int = 256) -> np.ndarray:
    """After each column block, the cosine of the rests that all but ``miss`` of the true neighbours need no more of."""
    turned = fitted.turned(sample)
    asked = turned[:queries]
    borders = _borders(sample.shape[1])
    k = min(k, len(sample) - 1)
    if k < 1:
        return np.ones(len(borders))
    scores = asked @ turned.T
    scores[np.arange(len(asked)), np.arange(len(asked))] = -np.inf
    near = np.argpartition(-scores, k - 1, axis=1)[:, :k]
    bar = np.take_along_axis(scores, near, axis=1).min(axis=1, keepdims=True)
    rests, own = _rests(turned), _rests(asked)
    out = []
    for block, border in enumerate(borders):
        known = np.einsum("qd,qkd->qk", asked[:, :border], turned[near][:, :, :border])
        rest = own[:, block, None] * rests[near, block]
        needed = np.divide(bar - known, rest, out=np.full_like(known, -1.0), where=rest > 0)
        out.append(min(1.0, float(np.quantile(needed, 1 - miss))))
    return np.array(out)


def scan(
    queries: np.ndarray, bars: np.ndarray, candidates: np.ndarray, tests: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, int]:
    """(query, candidate) pairs that can be among a query's k best and reach its bar; columns read in all.

    All vectors are turned, one row each. A candidate whose needed cosine is above the
    critical value after a column block is abandoned for that query.
    """
    width = queries.shape[1]
    own, rests = _rests(queries), _rests(candidates)
    products = np.zeros((len(queries), len(candidates)))
    alive = np.ones(products.shape, bool)
    rows = columns = None
    read = start = 0
    for block, stop in enumerate(_borders(width)):
        if rows is None:
            read += int(alive.sum()) * (stop - start)
            products += queries[:, start:stop] @ candidates[:, start:stop].T
            if stop < width:
                alive &= bars[:, None] - products <= tests[block] * own[:, block, None] * rests[None, :, block]
                if alive.mean() < SPARSE:
                    rows, columns = np.nonzero(alive)
                    products = products[rows, columns]
        else:
            read += len(rows) * (stop - start)
            products = products + (queries[rows, start:stop] * candidates[columns, start:stop]).sum(axis=1)
            if stop < width:
                keep = bars[rows] - products <= tests[block] * own[rows, block] * rests[columns, block]
                rows, columns, products = rows[keep], columns[keep], products[keep]
        start = stop
    # Turned products differ from the original ones by rounding.
    if rows is None:
        products[~alive] = -np.inf
        best = min(k, len(candidates))
        bars = np.maximum(bars, np.partition(products, -best, axis=1)[:, -best])
        rows, columns = np.nonzero(products >= (bars - 1e-9 * (1 + np.abs(bars)))[:, None])
        return rows, columns, read
    keep = products >= bars[rows] - 1e-9 * (1 + np.abs(bars[rows]))
    return rows[keep], columns[keep], read


def _usable(column: str, width: int | None) -> Column:
    """Non-null, with finite components, not all zero, of the wanted width."""
    vector = F.col(column)
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    good = vector.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(vector, lambda x: x != 0)
    return good if width is None else good & (F.size(vector) == width)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width).astype(np.float64)


def nearest_neighbours(
    vectors: DataFrame, *, k: int = 20, query_step: int = 20, lists: int | None = None,
    probes: int | None = None, share: float = 0.98, sample: int = 20_000, miss: float = 0.001,
) -> DataFrame:
    """The k nearest rows of each row of ``vectors`` (vec_id long, embedding array) whose id ``query_step`` divides.

    Returns query_id, rank (from 1), vec_id, score: highest inner product first, ties to
    the smaller vec_id; a query's own id is no candidate, and fewer rows come if there
    are fewer. Vectors that are null, zero, hold null or non-finite components, or have
    another length than most (ties: the longer) take no part, nor do null ids. A row that repeats an
    id and its vector counts once. Other columns are ignored; an empty table gives no rows.

    ``sample`` bounds the rows that reach the driver to fit ``lists`` centres, by default
    the root of the number of distinct vectors, at most an eighth of the sample. Without
    ``probes``, as many lists are probed as hold ``share`` of the neighbours in the sample. The
    tests abandon a share ``miss`` of those neighbours after each column block.
    """
    scratch = Scratch(vectors.sparkSession)
    narrow = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding")).where(
        F.col("vec_id").isNotNull() & _usable("embedding", None)
    )
    modal = narrow.groupBy(F.size("embedding").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).first()
    width = modal["width"] if modal else 1
    usable = narrow.where(F.size("embedding") == width).withColumns({
        "h1": F.xxhash64("embedding"), "h2": F.xxhash64(F.lit("second"), "embedding"),
    })
    # Of equal vectors, the k + 1 smallest ids can be among a query's k nearest.
    order = Window.partitionBy("h1", "h2").orderBy("vec_id")
    distinct = (
        usable.withColumn("place", F.dense_rank().over(order)).where(F.col("place") <= k + 1)
        .groupBy("h1", "h2")
        .agg(F.sort_array(F.collect_set("vec_id")).alias("ids"), F.first("embedding").alias("embedding"))
    )
    distinct = scratch.keep(distinct, "distinct")
    asking = usable.where(F.col("vec_id") % query_step == 0)
    asked = scratch.keep(asking.groupBy("h1", "h2").agg(F.first("embedding").alias("embedding")), "asked")
    count = distinct.count()
    chosen = distinct.orderBy(F.xxhash64("h2"), "h1").limit(sample).select("embedding").toArrow().column(0)
    if lists is None:
        lists = int(round(count**0.5))
    known = _matrix(chosen, width) if count else np.ones((1, width))
    fitted = fit_lists(known, max(1, min(lists, sample // 8)))
    probes = min(probes or fit_probes(fitted, known, k, share), len(fitted.centres))
    first = max(1, round(FIRST_LISTS * probes))
    tests = fit_tests(fitted, known, k, miss)
    shared = vectors.sparkSession.sparkContext.broadcast(fitted)

    def assign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                near = shared.value.nearest(shared.value.turned(_matrix(batch.column(3), width)))
                yield pa.RecordBatch.from_arrays([pa.array(near.astype(np.int32)), *batch.columns], ["list", *batch.schema.names])

    def probe(low: int, high: int):
        def send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    found = shared.value.probed(shared.value.turned(_matrix(batch.column(2), width)), high)[:, low:]
                    row = pa.array(np.repeat(np.arange(batch.num_rows), found.shape[1]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(found.ravel().astype(np.int32)), *(c.take(row) for c in batch.columns)], ["list", *batch.schema.names]
                    )

        return send

    held = distinct.select("h1", "h2", "ids", "embedding").mapInArrow(
        assign, "list int, h1 long, h2 long, ids array<long>, embedding array<double>"
    )
    held = scratch.keep(held, "lists")
    sizes = held.groupBy("list").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("blocks"))

    def search(candidates: pa.Table, queries: pa.Table) -> pa.Table:
        own = _matrix(candidates.column("embedding"), width) if candidates.num_rows else np.zeros((0, width))
        wanted = _matrix(queries.column("embedding"), width) if queries.num_rows else np.zeros((0, width))
        turned, asked_ = shared.value.turned(own), shared.value.turned(wanted)
        bars = queries.column("bar").to_numpy()
        lowest = np.array([x[0].as_py() for x in candidates.column("ids")], np.int64)
        rows, picks, scores = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
        for start in range(0, len(wanted) if len(own) else 0, TOGETHER):
            part = slice(start, start + TOGETHER)
            row, pick, _ = scan(asked_[part], bars[part], turned, tests, k + 1)
            row = row + start
            score = (own[pick] * wanted[row]).sum(axis=1)
            order = np.lexsort((lowest[pick], -score, row))
            row, pick, score = row[order], pick[order], score[order]
            # The best k + 1 of each query.
            place = np.arange(len(row)) - np.searchsorted(row, row)
            best_ = place <= k
            rows.append(row[best_])
            picks.append(pick[best_])
            scores.append(score[best_])
        at, pick = pa.array(np.concatenate(rows)), pa.array(np.concatenate(picks))
        return pa.table({
            "h1": queries.column("h1").take(at), "h2": queries.column("h2").take(at),
            "ids": candidates.column("ids").take(pick), "score": pa.array(np.concatenate(scores)),
        })

    by_score = Window.partitionBy("h1", "h2").orderBy(F.desc("score"), F.col("ids")[0])

    def searched(queries: DataFrame, low: int, high: int, name: str) -> DataFrame:
        """The best of the lists from the low-th to before the high-th nearest of each query (h1, h2, embedding, bar)."""
        sent = queries.select("h1", "h2", "embedding", "bar").mapInArrow(
            probe(low, high), "list int, h1 long, h2 long, embedding array<double>, bar double"
        )
        sent = scratch.keep(sent, f"{name}-probes")
        # Lists and the queries sent to them are cut into blocks; each block meets each.
        loads = sent.groupBy("list").agg(F.ceil(F.count("*") / QUERY_ROWS).cast("int").alias("turns"))
        cells = sizes.join(loads, "list")
        block, turn = F.pmod("h2", "blocks").cast("int"), F.pmod("h2", "turns").cast("int")
        left = held.join(cells, "list").select(
            "list", block.alias("block"), F.explode(F.sequence(F.lit(0), F.col("turns") - 1)).alias("turn"), "h1", "h2", "ids", "embedding"
        )
        right = sent.join(cells, "list").select(
            "list", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), turn.alias("turn"), "h1", "h2", "embedding", "bar"
        )
        cell = ["list", "block", "turn"]
        found = left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInArrow(
            search, "h1 long, h2 long, ids array<long>, score double"
        )
        best = found.withColumn("place", F.row_number().over(by_score)).where(F.col("place") <= k + 1)
        return scratch.keep(best.drop("place"), name)

    # The nearest lists set each query's bar: the product of the last that could be among its k + 1 best.
    nearest = searched(asked.withColumn("bar", F.lit(float("-inf"))), 0, first, "first")
    bars = nearest.groupBy("h1", "h2").agg(
        F.when(F.count("*") > k, F.min("score")).otherwise(F.lit(float("-inf"))).alias("bar")
    )
    others = asked.join(bars, ["h1", "h2"], "left").withColumn("bar", F.coalesce("bar", F.lit(float("-inf"))))
    found = nearest.unionByName(searched(others, first, probes, "rest")) if probes > first else nearest
    best = found.withColumn("place", F.row_number().over(by_score)).where(F.col("place") <= k + 1)
    ids = best.select("h1", "h2", "score", F.explode("ids").alias("vec_id"))
    by_id = Window.partitionBy("h1", "h2").orderBy(F.desc("score"), "vec_id")
    ids = ids.withColumn("place", F.row_number().over(by_id)).where(F.col("place") <= k + 1)
    answers = ids.groupBy("h1", "h2").agg(F.sort_array(F.collect_list(F.struct("place", "vec_id", "score"))).alias("near"))
    queries = asking.select(F.col("vec_id").alias("query_id"), "h1", "h2").distinct()
    without_own = F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    return queries.join(answers, ["h1", "h2"]).select("query_id", F.posexplode(without_own).alias("at", "one")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), "one.vec_id", "one.score"
    )

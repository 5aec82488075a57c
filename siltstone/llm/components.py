"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.scratch import Scratch


def _to_smallest(both: DataFrame) -> DataFrame:
    """Each vertex u with the smallest of itself and its neighbours."""
    return both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("low"))


def components(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(id, label): every linked vertex with the smallest id reachable from it.

    ``links`` has two long columns, ``a`` and ``b``. The rounds' links are written, so
    that a lost executor costs one round; rounds grow with the logarithm of the
    longest path. Only a count and a checksum of each round reach the driver.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct()
    before, turn = None, 0
    while True:
        edges = scratch.keep(edges, f"{name}-{turn}")
        state = edges.agg(F.count("*"), F.expr("sum(cast(xxhash64(u, v) as decimal(38, 0)))")).first()
        if tuple(state) == before:
            break
        before, turn = tuple(state), turn + 1
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_to_smallest(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v"))
        large = large.distinct()
        low = large.groupBy("u").agg(F.min("v").alias("low"))
        edges = (
            large.join(low, "u").where("v > low").select(F.col("v").alias("u"), F.col("low").alias("v"))
            .unionByName(low.select("u", F.col("low").alias("v")))
            .distinct()
        )
    tops = edges.select(F.col("v").alias("id"), F.col("v").alias("label")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("label")).unionByName(tops)

"""Consolidation of overlapping feeds: one row per key, from the preferred feed."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.functions.columns import source_rank


def union_feeds(feeds: Sequence[DataFrame]) -> DataFrame:
    """All rows of all feeds, matched by column name; a column a feed lacks is NULL there."""
    if not feeds:
        raise ValueError("no feeds")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), feeds)


def consolidate(
    feeds: Sequence[DataFrame],
    key: Sequence[str],
    source_column: str,
    priority: Sequence[str],
    tiebreak: Sequence[str | Column] | None,
) -> DataFrame:
    """Keep, per key, the row of the source named earliest in ``priority``.

    ``tiebreak`` orders rows of one source that share a key, so the result does not
    depend on the order of arrival: give enough columns, or None for all others by name.

    The rank filter sits directly above the window: Spark then keeps one row per key
    on each map task before the shuffle, so a key with very many copies costs its
    reducer one row per map task.
    """
    combined = union_feeds(feeds)
    if tiebreak is None:
        tiebreak = sorted(c for c in combined.columns if c not in key)
    order = [source_rank(F.col(source_column), priority), *_columns(tiebreak)]
    ranked = combined.withColumn(
        "_rank", F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    )
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def _columns(names: Sequence[str | Column]) -> list[Column]:
    return [F.col(n) if isinstance(n, str) else n for n in names]

"""Column dictionaries: provenance paths and keyword tags, as table operations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A field whose name contains one of the words carries the tag.
TAG_KEYWORDS = {
    "identifier": ("_id", "isin", "cusip", "sedol", "ticker", "figi", "lei"),
    "fixed_income": ("coupon", "maturity", "call", "put", "yield", "duration", "convexity"),
    "pricing": ("price", "px", "market_value", "nav"),
    "risk": ("var_", "cvar_", "dv01", "cr01", "delta", "gamma", "vega", "scenario_"),
    "pnl": ("pnl", "realized", "unrealized"),
}

_BLANKS = " \t\n\r\f\v"


def provenance_edges(
    df: DataFrame, path_column: str, field_column: str, domain: str | Column
) -> DataFrame:
    """One row per source of a field.

    A path column holds ``system.schema.table.column`` entries separated by ``" | "``.
    Entries with fewer than four parts are dropped; a missing path or ``derived`` gives
    one edge of its own.
    """
    path = F.col(path_column)
    derived = path.isNull() | path.isin("", "derived")
    entries = df.select(
        F.col(field_column).alias("target_field"),
        (F.lit(domain) if isinstance(domain, str) else domain).alias("domain"),
        derived.alias("_derived"),
        F.explode(F.when(derived, F.array(F.lit(""))).otherwise(F.split(path, r" \| "))).alias("_entry"),
    )
    parts = F.split(F.btrim(F.col("_entry"), F.lit(_BLANKS)), r"\.")
    split = entries.select("target_field", "domain", "_derived", parts.alias("_parts"))
    return split.filter(F.col("_derived") | (F.size("_parts") >= 4)).select(
        "target_field",
        _unless_derived(_part(0), "derived").alias("source_system"),
        _unless_derived(F.concat_ws(".", _part(1), _part(2)), "").alias("source_table"),
        _unless_derived(_part(3), "").alias("source_column"),
        "domain",
        _unless_derived(F.lit("direct_map"), "derived").alias("transformation"),
    )


def keyword_tags(
    text: Column, group: Column | None = None, tags: Mapping[str, Sequence[str]] = TAG_KEYWORDS
) -> Column:
    """Sorted set of the group and of each tag that has a keyword inside ``text``."""
    lowered = F.lower(text)
    hits = []
    if group is not None:
        hits.append(F.when(group != "", group))
    for tag, words in tags.items():
        found = lowered.contains(words[0])
        for word in words[1:]:
            found = found | lowered.contains(word)
        hits.append(F.when(found, F.lit(tag)))
    # array_except drops NULLs and duplicates and, unlike a lambda over the array, leaves
    # the expression compiled: the text is lowered once, not once per word.
    nothing = F.array(F.lit(None).cast("string"))
    return F.sort_array(F.array_except(F.array(*hits), nothing))


def with_keyword_tags(
    df: DataFrame,
    text_column: str,
    group_column: str | None = None,
    tags: Mapping[str, Sequence[str]] = TAG_KEYWORDS,
    into: str = "tags",
) -> DataFrame:
    """``df`` with a tag array for each row."""
    group = None if group_column is None else F.col(group_column)
    return df.withColumn(into, keyword_tags(F.col(text_column), group, tags))


def _part(index: int) -> Column:
    return F.get("_parts", F.lit(index))


def _unless_derived(value: Column, otherwise: str) -> Column:
    return F.when(F.col("_derived"), F.lit(otherwise)).otherwise(value)

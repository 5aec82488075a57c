"""Renames, selections and tags: each is one ``select``, so the plan stays flat."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions.columns import canonical_type


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename by map in one step; absent columns are skipped."""
    return df.select(*[F.col(c).alias(names.get(c, c)) for c in df.columns])


def select_declared(
    df: DataFrame,
    declared: Sequence[str],
    missing: str = "skip",
    types: Mapping[str, str] | None = None,
) -> DataFrame:
    """The declared columns in declared order.

    A declared column that ``df`` lacks is left out (``skip``), added as a NULL of its
    declared type (``null``) or an error (``error``).
    """
    if missing not in ("skip", "null", "error"):
        raise ValueError(f"missing must be skip, null or error, not {missing!r}")
    present = set(df.columns)
    absent = [c for c in declared if c not in present]
    if absent and missing == "error":
        raise ValueError(f"missing columns: {absent}")
    columns: list[Column] = []
    for name in declared:
        if name in present:
            columns.append(F.col(name))
        elif missing == "null":
            kind = canonical_type(types[name]) if types and name in types else "string"
            columns.append(F.lit(None).cast(kind).alias(name))
    return df.select(*columns)


def drop_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Drop the columns that are present."""
    return df.drop(*names)


def snapshot(df: DataFrame, as_of, column: str = "as_of_date") -> DataFrame:
    """Rows of one business date; the whole table when no date is given or it has none."""
    if as_of is None or column not in df.columns:
        return df
    return df.filter(F.col(column) == F.lit(as_of))

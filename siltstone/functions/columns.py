"""Cleaning expressions for single columns."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SIMPLE_TYPES = {
    "STRING": T.StringType(),
    "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampType(),
    "BOOLEAN": T.BooleanType(),
    "DOUBLE": T.DoubleType(),
    "DECIMAL": T.DecimalType(18, 2),
}


def canonical_type(name: str) -> T.DataType:
    """Spark type of a canonical type name; letter case and inner spaces do not matter."""
    text = re.sub(r"\s+", "", name).upper()
    if text in _SIMPLE_TYPES:
        return _SIMPLE_TYPES[text]
    decimal = re.fullmatch(r"DECIMAL\((\d+),(\d+)\)", text)
    if decimal:
        return T.DecimalType(int(decimal[1]), int(decimal[2]))
    raise ValueError(f"unknown canonical type: {name!r}")


def typed(column: Column, type_name: str) -> Column:
    """Cast in which a value that does not fit the type becomes NULL, ANSI mode or not."""
    return column.try_cast(canonical_type(type_name))


def upper_trim(column: Column) -> Column:
    """Upper case without surrounding spaces (only spaces: a tab stays)."""
    return F.upper(F.trim(column))


def null_outside(column: Column, low: float, high: float) -> Column:
    """The value if it lies in [low, high], else NULL."""
    return F.when(column.between(low, high), column)


def default_unless(column: Column, allowed: Sequence[str], default: str) -> Column:
    """The value if it is one of ``allowed``; the default otherwise, also for NULL."""
    return F.when(column.isin(list(allowed)), column).otherwise(F.lit(default))


def sum_if_null(column: Column, parts: Sequence[Column], type_name: str) -> Column:
    """The value, or the sum of ``parts`` where it is NULL, in the declared type."""
    total = parts[0]
    for part in parts[1:]:
        total = total + part
    return F.coalesce(column, total).try_cast(canonical_type(type_name))


def source_rank(column: Column, priority: Sequence[str]) -> Column:
    """1 for the preferred source, 2 for the next ...; unlisted sources come last."""
    if not priority:
        raise ValueError("priority must name at least one source")
    rank = F.when(column == priority[0], 1)
    for position, name in enumerate(priority[1:], start=2):
        rank = rank.when(column == name, position)
    return rank.otherwise(len(priority) + 1)

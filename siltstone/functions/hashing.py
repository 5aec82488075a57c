"""Change-detection hash over the business columns of a row."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The columns of a history table beside the business columns.
HISTORY_COLUMNS = ("_record_hash", "_effective_from", "_effective_to", "_is_current", "_batch_id")

# Fixed values of the delimited encoding.
DELIMITER = "||"
NULL_MARK = "__NULL__"


def hashed_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Columns that take part in the hash, sorted by name."""
    skip = set(exclude) | set(HISTORY_COLUMNS)
    return sorted(c for c in df.columns if c not in skip)


def record_hash(df: DataFrame, exclude: Iterable[str] = (), encoding: str = "json") -> Column:
    """MD5 over the hashed columns of ``df``.

    ``json`` names every value and leaves NULLs out, so no two rows share an encoding
    and an added column that is NULL everywhere changes no hash. ``delimited`` joins
    the values with ``||``; two different rows can then share an encoding.
    """
    names = hashed_columns(df, exclude)
    if encoding == "delimited":
        parts = [F.coalesce(F.col(c).cast("string"), F.lit(NULL_MARK)) for c in names]
        return F.md5(F.concat_ws(DELIMITER, *parts))
    if encoding == "json":
        values = [_as_text(df, c).alias(c) for c in names]
        return F.md5(F.to_json(F.struct(*values), {"ignoreNullFields": "true"}))
    raise ValueError(f"unknown hash encoding: {encoding!r}")


def _as_text(df: DataFrame, name: str) -> Column:
    """Text that depends on the value alone, not on the session (time zone, JSON format)."""
    column, kind = F.col(name), df.schema[name].dataType
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column).cast("string")
    if isinstance(kind, T.BinaryType):
        return F.hex(column)
    if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
        return column
    return column.cast("string")

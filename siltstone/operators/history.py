"""Type-2 history: every version of a record, with half-open validity [from, to).

A history table is the business columns plus ``_record_hash``, ``_effective_from``,
``_effective_to`` (NULL for the current version), ``_is_current`` and ``_batch_id``.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.functions.hashing import HISTORY_COLUMNS, record_hash

_CURRENT, _INCOMING = 0, 1


def stamp(
    incoming: DataFrame,
    at,
    batch_id: str,
    hash_exclude: Iterable[str] = (),
    hash_encoding: str = "json",
) -> DataFrame:
    """``incoming`` as versions that become current at ``at``."""
    taken = [c for c in HISTORY_COLUMNS if c in incoming.columns]
    if taken:
        raise ValueError(f"incoming rows already carry history columns: {taken}")
    return incoming.select(
        "*",
        record_hash(incoming, hash_exclude, hash_encoding).alias("_record_hash"),
        _instant(at).alias("_effective_from"),
        F.lit(None).cast("timestamp").alias("_effective_to"),
        F.lit(True).alias("_is_current"),
        F.lit(batch_id).cast("string").alias("_batch_id"),
    )


def current_rows(df: DataFrame) -> DataFrame:
    """Current versions; the whole table when it keeps no history."""
    return df.filter("_is_current") if "_is_current" in df.columns else df


def closed_rows(df: DataFrame) -> DataFrame:
    """Superseded versions. A NULL flag belongs to neither half, so it is an error."""
    flag = F.col("_is_current")
    known = F.coalesce(flag, F.raise_error(F.lit("_is_current is NULL")).cast("boolean"))
    # The first filter reaches the scan; the second only sees what it lets through.
    return df.filter((flag == False) | flag.isNull()).filter(~known)  # noqa: E712


def merge_current(
    current: DataFrame | None,
    incoming: DataFrame,
    key: Sequence[str],
    at,
    batch_id: str,
    *,
    hash_exclude: Iterable[str] = (),
    hash_encoding: str = "json",
    absent: str = "keep",
    first: bool = False,
) -> DataFrame:
    """Current versions after a batch, plus the versions this batch closes.

    New keys are inserted. A changed record closes its old version at ``at`` and
    inserts the new one. An unchanged record keeps its row untouched. A key the batch
    does not mention stays current (``absent='keep'``) or is closed (``'close'``).
    Duplicate and NULL keys are errors.

    Both sides are unioned and shuffled once on the key; a window then shows each row
    its counterpart. Keys are unique on each side, so a window group holds two rows at
    most, and no join is needed.

    ``first`` says that ``current`` has no rows, if it is given at all, and that the keys of
    ``incoming`` were found unique and without NULLs: then there is nothing to compare,
    and no row is shuffled.
    """
    if absent not in ("keep", "close"):
        raise ValueError(f"absent must be keep or close, not {absent!r}")
    _require_key(key, incoming, "incoming")
    stamped = stamp(incoming, at, batch_id, hash_exclude, hash_encoding)
    rows = stamped.withColumn("_side", F.lit(_INCOMING))
    if current is not None:
        _require_key(key, current, "current")
        _require_same_types(current, stamped)
    columns = _business_columns(current, stamped) + list(HISTORY_COLUMNS)
    if first:
        older = [F.lit(None).cast(current.schema[c].dataType).alias(c) for c in columns if c not in stamped.columns]
        return stamped.select("*", *older).select(*columns)
    if current is not None:
        rows = current.withColumn("_side", F.lit(_CURRENT)).unionByName(
            rows, allowMissingColumns=True
        )

    by_key = Window.partitionBy(*key).orderBy("_side")
    group = by_key.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    is_current = F.col("_side") == _CURRENT
    rows = rows.select(
        "*",
        F.count_if(is_current).over(group).alias("_in_current"),
        F.count_if(~is_current).over(group).alias("_in_batch"),
        F.max(F.when(is_current, F.col("_effective_from"))).over(group).alias("_since"),
        F.lag("_record_hash").over(by_key).alias("_hash_before"),
        F.lead("_record_hash").over(by_key).alias("_hash_after"),
    )

    # The guards test values computed by the window alone. Spark may move a filter that
    # a caller puts on the result next to them and reason on both together, so a guard
    # on a column the caller can see would fire on rows the caller has filtered out.
    null_key = F.lit(False)
    for name in key:
        null_key = null_key | F.col(name).isNull()
    repeated = (F.col("_in_current") > 1) | (F.col("_in_batch") > 1)
    same_as_before = F.col("_hash_before").eqNullSafe(F.col("_record_hash"))
    wanted = is_current | (F.col("_in_current") == 0) | ~same_as_before
    guarded = (
        F.when(null_key, _fail(f"NULL in key {list(key)}"))
        .when(repeated, _fail(f"duplicate key {list(key)}"))
        .otherwise(wanted)
    )
    same_as_after = F.col("_hash_after").eqNullSafe(F.col("_record_hash"))
    ends = (F.col("_in_batch") > 0) & ~same_as_after
    if absent == "close":
        ends = ends | (F.col("_in_batch") == 0)
    closes = is_current & ends
    closing_time = F.when(
        F.col("_since") > _instant(at),
        F.raise_error(F.lit("batch is older than a version it would close")).cast("timestamp"),
    ).otherwise(_instant(at))

    changed = {
        "_effective_to": F.when(closes, closing_time).otherwise(F.col("_effective_to")),
        "_is_current": ~closes,
    }
    return rows.filter(guarded).select(*[changed.get(c, F.col(c)).alias(c) for c in columns])


def scd2_merge(
    existing: DataFrame | None,
    incoming: DataFrame,
    key: Sequence[str],
    at,
    batch_id: str,
    *,
    hash_exclude: Iterable[str] = (),
    hash_encoding: str = "json",
    absent: str = "keep",
) -> DataFrame:
    """The whole history table after a batch: closed versions pass through unshuffled."""
    options = {"hash_exclude": hash_exclude, "hash_encoding": hash_encoding, "absent": absent}
    if existing is None:
        return merge_current(None, incoming, key, at, batch_id, **options)
    merged = merge_current(current_rows(existing), incoming, key, at, batch_id, **options)
    return merged.unionByName(closed_rows(existing), allowMissingColumns=True)


def scd2_merge_all(
    existing: DataFrame | None,
    deliveries: Sequence[tuple[DataFrame, object, str]],
    key: Sequence[str],
    *,
    hash_exclude: Iterable[str] = (),
    hash_encoding: str = "json",
    absent: str = "keep",
) -> DataFrame:
    """The whole history table after several batches ``(rows, at, batch_id)``, oldest first.

    The same rows as one ``scd2_merge`` after the other, but every delivery is read once
    and all of them are shuffled once: a backfill of N days costs N scans. A version
    begins where the hash differs from the key's row before it, and ends where the next
    one begins; with ``absent='close'`` also at the first batch without the key. Nothing
    but the rows of one key, one for each batch at most, meets in a window group.
    """
    if absent not in ("keep", "close"):
        raise ValueError(f"absent must be keep or close, not {absent!r}")
    if not deliveries:
        raise ValueError("no delivery to merge")
    stamped = [stamp(df, at, batch, hash_exclude, hash_encoding) for df, at, batch in deliveries]
    current = None if existing is None else current_rows(existing)
    sides = ([(_CURRENT, current)] if current is not None else []) + list(enumerate(stamped, 1))
    rows = None
    for number, frame in sides:
        _require_key(key, frame, f"delivery {number}" if number else "current")
        side = frame.withColumn("_side", F.lit(number))
        if rows is not None:
            _require_same_types(rows, side)
            side = rows.unionByName(side, allowMissingColumns=True)
        rows = side

    by_key = Window.partitionBy(*key).orderBy("_side")
    group = by_key.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.select(
        "*",
        F.lag("_side").over(by_key).alias("_side_before"),
        F.lag("_record_hash").over(by_key).alias("_hash_before"),
        F.max("_side").over(group).alias("_last_side"),
        F.max(F.when(F.col("_side") == _CURRENT, F.col("_effective_from"))).over(group).alias("_since"),
    )
    # The guards test values computed by the window alone, as in merge_current.
    null_key = F.lit(False)
    for name in key:
        null_key = null_key | F.col(name).isNull()
    begins = F.col("_side_before").isNull() | ~F.col("_hash_before").eqNullSafe(F.col("_record_hash"))
    ended_by = F.col("_side")
    if absent == "close":
        begins = begins | (F.col("_side_before") + 1 < F.col("_side"))
        ended_by = F.col("_side_before") + 1
    guarded = (
        F.when(null_key, _fail(f"NULL in key {list(key)}"))
        .when(F.col("_side_before") == F.col("_side"), _fail(f"duplicate key {list(key)}"))
        .otherwise(begins)
    )
    starts = rows.filter(guarded).withColumn("_ended_by", F.lead(ended_by).over(by_key))
    end = F.col("_ended_by")
    if absent == "close":
        gone = F.when(F.col("_last_side") < len(deliveries), F.col("_last_side") + 1)
        end = F.coalesce(end, gone)
    closed_at = F.element_at(F.array(*[_instant(at) for _, at, _ in deliveries]), end)
    late = F.raise_error(F.lit("batch is older than a version it would close")).cast("timestamp")
    began = F.when(F.col("_side") == _CURRENT, F.col("_since")).otherwise(
        F.element_at(F.array(*[_instant(at) for _, at, _ in deliveries]), F.greatest("_side", F.lit(1)))
    )
    changed = {
        "_effective_to": F.when(end.isNotNull(), F.when(began > closed_at, late).otherwise(closed_at)),
        "_is_current": end.isNull(),
    }
    names = [c for c in rows.columns if c in _all_names(sides) and c not in HISTORY_COLUMNS]
    columns = names + list(HISTORY_COLUMNS)
    merged = starts.select(*[changed.get(c, F.col(c)).alias(c) for c in columns])
    if existing is None:
        return merged
    return merged.unionByName(closed_rows(existing), allowMissingColumns=True)


def _all_names(sides: Sequence[tuple[int, DataFrame]]) -> set[str]:
    return {name for _, frame in sides for name in frame.columns}


def as_of(df: DataFrame, instant) -> DataFrame:
    """Versions valid at an instant."""
    moment = _instant(instant)
    return df.filter(
        (F.col("_effective_from") <= moment)
        & (F.col("_effective_to").isNull() | (F.col("_effective_to") > moment))
    )


def _instant(value) -> Column:
    return (value if isinstance(value, Column) else F.lit(value)).cast("timestamp")


def _fail(message: str) -> Column:
    return F.raise_error(F.lit(message)).cast("boolean")


def _business_columns(current: DataFrame | None, stamped: DataFrame) -> list[str]:
    names = [c for c in (current.columns if current is not None else [])]
    names += [c for c in stamped.columns if c not in names]
    return [c for c in names if c not in HISTORY_COLUMNS]


def _require_key(key: Sequence[str], df: DataFrame, side: str) -> None:
    missing = [c for c in key if c not in df.columns]
    if not key or missing:
        raise ValueError(f"{side} rows lack key columns: {missing or 'no key given'}")


def _require_same_types(current: DataFrame, incoming: DataFrame) -> None:
    """A silent widening in the union would rewrite and re-version rows."""
    old = {f.name: f.dataType for f in current.schema.fields}
    changed = {
        f.name: (old[f.name].simpleString(), f.dataType.simpleString())
        for f in incoming.schema.fields
        if f.name in old and old[f.name] != f.dataType
    }
    if changed:
        raise ValueError(f"column types differ from the current table: {changed}")

"""Deliveries that come late: spliced into the history as if they had come in their time.

A history tells when a record changed, not when it was merely delivered again. Both matter
to a late delivery: if X arrives for an instant between two deliveries of A, the record is
A, then X, then A again from the second delivery on. So the deliveries after the
late one say which keys they held; of their columns only the key is read.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltstone.functions.hashing import HISTORY_COLUMNS
from siltstone.operators.history import _fail, _instant, _require_key, _require_same_types, stamp

_VERSION, _SIGHTING, _LATE = 0, 1, 2


def scd2_splice(
    existing: DataFrame,
    late: DataFrame,
    key: Sequence[str],
    at,
    batch_id: str,
    later: Sequence[tuple[DataFrame, object, str]] = (),
    *,
    hash_exclude: Iterable[str] = (),
    hash_encoding: str = "json",
) -> DataFrame:
    """The whole history after a delivery whose instant lies before versions that are there.

    ``later`` are the deliveries ``(rows, at, batch_id)`` already merged whose instant is
    after ``at``. The rows are those of merging all deliveries in the order of their
    instants, keys that a delivery does not mention staying current: the version valid at
    ``at`` is split or shortened, one that said the same later on begins earlier, and
    a version that a later delivery confirmed begins again there. Its columns that take
    no part in the hash are those it had before.

    Versions, sightings and the delivery are unioned and shuffled once on the key. Keys
    that the delivery does not hold keep their versions as they are. Duplicate and NULL
    keys in the delivery, a second delivery at the same instant, and a key whose history
    has gaps (it was closed by a full delivery) are errors.
    """
    _require_key(key, existing, "existing")
    _require_key(key, late, "late")
    stamped = stamp(late, at, batch_id, hash_exclude, hash_encoding)
    _require_same_types(existing, stamped)
    columns = [c for c in existing.columns if c not in HISTORY_COLUMNS]
    columns += [c for c in stamped.columns if c not in columns and c not in HISTORY_COLUMNS]

    rows = existing.withColumn("_kind", F.lit(_VERSION)).unionByName(
        stamped.withColumn("_kind", F.lit(_LATE)), allowMissingColumns=True
    )
    for frame, seen_at, seen_by in later:
        _require_key(key, frame, f"delivery {seen_by}")
        sighting = frame.select(
            *key, F.lit(_SIGHTING).alias("_kind"), _instant(seen_at).alias("_effective_from"),
            F.lit(seen_by).cast("string").alias("_batch_id"),
        )
        rows = rows.unionByName(sighting, allowMissingColumns=True)

    kind, moment = F.col("_kind"), F.col("_effective_from")
    by_key = Window.partitionBy(*key).orderBy("_effective_from", "_kind")
    group = by_key.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    so_far = by_key.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    after = by_key.rowsBetween(1, Window.unboundedFollowing)
    is_version, is_late = kind == _VERSION, kind == _LATE
    payload = F.struct("_record_hash", *columns)
    next_version = F.min(F.when(is_version, moment)).over(after)
    rows = rows.select(
        *key, *HISTORY_COLUMNS, "_kind",
        F.when(kind == _SIGHTING, F.last(F.when(is_version, payload), True).over(so_far))
        .otherwise(payload).alias("_row"),
        F.count_if(is_late).over(group).alias("_late"),
        F.count_if(moment == _instant(at)).over(group).alias("_at_instant"),
        F.max(is_version & ~F.col("_effective_to").eqNullSafe(next_version)).over(group).alias("_gap"),
    )
    null_key = F.lit(False)
    for name in key:
        null_key = null_key | F.col(name).isNull()
    touched = F.col("_late") > 0
    # As in the merge, guards test values that the window alone computed.
    guarded = (
        F.when(touched & null_key, _fail(f"NULL in key {list(key)}"))
        .when(F.col("_late") > 1, _fail(f"duplicate key {list(key)}"))
        .when(touched & (F.col("_at_instant") > 1), _fail("a delivery of the same instant is already merged"))
        .when(touched & F.col("_gap"), _fail("late delivery for a key that was closed"))
        .otherwise(touched | (kind == _VERSION))
    )
    rows = rows.filter(guarded).withColumn("_hash_before", F.lag("_row._record_hash").over(by_key))
    begins = ~touched | ~F.col("_hash_before").eqNullSafe(F.col("_row._record_hash"))
    starts = rows.filter(begins).withColumn("_next", F.lead("_effective_from").over(by_key))
    ends = F.when(touched, F.col("_next")).otherwise(F.col("_effective_to"))
    return starts.select(
        *[F.col(f"_row.{c}").alias(c) for c in columns],
        F.col("_row._record_hash").alias("_record_hash"),
        "_effective_from",
        ends.alias("_effective_to"),
        F.when(touched, F.col("_next").isNull()).otherwise(F.col("_is_current")).alias("_is_current"),
        "_batch_id",
    )

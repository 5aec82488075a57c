"""The wide table: current rows of a base table, enriched by current rows of dimensions."""

from __future__ import annotations

from collections.abc import Collection, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.functions.hashing import HISTORY_COLUMNS
from siltstone.operators.history import current_rows


@dataclass(frozen=True)
class Dimension:
    """One enrichment: ``df`` joined on ``keys``, contributing ``columns`` (default all).

    ``fan_out`` says that one key may match so many rows of ``df`` that they do not fit
    one task: such keys are looked for and joined apart (see ``left_join_hot_keys``).
    """

    name: str
    df: DataFrame
    keys: tuple[str, ...]
    columns: tuple[str, ...] | None = None
    how: str = "left"
    fan_out: bool = False


def denormalize(
    base: DataFrame,
    dimensions: Sequence[Dimension],
    base_columns: Sequence[str] | None = None,
    run_ts=None,
) -> DataFrame:
    """Join every dimension to the current rows of ``base``.

    Each input is reduced to its current rows and declared columns before the join, so
    a base row without a match survives a left join. A dimension column whose name is
    taken becomes ``<dimension>_<column>``. ``run_ts`` adds ``_pipeline_timestamp``.

    No join carries a hint: Spark broadcasts a side only when its size is known to be
    under the session's threshold, and splits hot keys of the base side at run time.
    """
    wide = _declared(current_rows(base), base_columns)
    own_columns = wide.columns
    columns = list(own_columns)
    steps = []
    for dimension in dimensions:
        right = _aligned(dimension, columns)
        columns += [c for c in right.columns if c not in dimension.keys]
        steps.append((dimension, right))
    # Left joins on columns of the base commute: the narrowest first, so that the rows
    # the later ones shuffle are as narrow as they can be.
    if all(d.how == "left" and set(d.keys) <= set(own_columns) for d, _ in steps):
        steps.sort(key=lambda step: len(step[1].columns) - len(step[0].keys))
    for dimension, right in steps:
        on = list(dimension.keys)
        if dimension.fan_out:
            if dimension.how != "left":
                raise ValueError(f"{dimension.name}: fan_out applies to left joins")
            wide = left_join_hot_keys(wide, right, on)
        else:
            wide = wide.join(right, on, dimension.how)
    wide = wide.select(*columns)
    if run_ts is not None:
        wide = wide.withColumn("_pipeline_timestamp", F.lit(run_ts).cast("timestamp"))
    return wide


#: A sketch follows this many keys; a key below the average task's share of rows is not hot.
TRACKED_KEYS = 10_000
MOST_HOT_KEYS = 100
HOT_ROWS = 100_000


def hot_keys(df: DataFrame, keys: Sequence[str], least: int | None = None) -> list[int]:
    """The 64-bit hashes of keys with so many rows that one task should not have them all.

    A key is hot with more rows than ``least`` and than a shuffle partition has on
    average. They come from a mergeable sketch of the keys, one scan of the key columns
    without a shuffle of rows. There are fewer hot keys than shuffle partitions and at
    most ``MOST_HOT_KEYS``; what the sketch gets wrong changes the plan, never the rows.
    """
    counted = df.agg(
        F.expr(f"approx_top_k(xxhash64({', '.join(f'`{k}`' for k in keys)}), {MOST_HOT_KEYS}, {TRACKED_KEYS})").alias("top"),
        F.count(F.lit(1)).alias("rows"),
    ).first()
    share = counted.rows // int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bound = max(HOT_ROWS if least is None else least, share)
    return [x["item"] for x in counted.top or [] if x["count"] > bound]


def left_join_hot_keys(
    left: DataFrame, right: DataFrame, on: Sequence[str], least: int | None = None
) -> DataFrame:
    """A left join that splits the hot keys of the right side, and only those.

    Without a hot key this is the plain left join. Otherwise the rows of hot keys are
    joined apart by ``left_join_fan_out``, all others as before; the rows are the same.
    """
    keys = list(on)
    hot = hot_keys(right, keys, least)
    if not hot:
        return left.join(right, keys, "left")
    is_hot = F.xxhash64(*keys).isin(hot)
    usual = left.filter(~is_hot).join(right.filter(~is_hot), keys, "left")
    return usual.unionByName(left_join_fan_out(left.filter(is_hot), right.filter(is_hot), keys))


def left_join_fan_out(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """A left join in which hot keys of either side can be split at run time.

    Spark splits a hot key of a left join on its left side only, of an inner join on
    both. So: matched rows by an inner join, unmatched ones by an anti join against the
    distinct keys, rows with a NULL key unjoined. Both joins read one shuffle of the
    left side.
    """
    keys = list(on)
    has_key = F.lit(True)
    for name in keys:
        has_key = has_key & F.col(name).isNotNull()
    keyed = left.filter(has_key)
    matched = keyed.join(right, keys, "inner")
    unmatched = keyed.join(right.select(*keys).distinct(), keys, "left_anti")
    keyless = left.filter(~has_key)
    return matched.unionByName(unmatched, allowMissingColumns=True).unionByName(
        keyless, allowMissingColumns=True
    )


def _declared(df: DataFrame, columns: Sequence[str] | None) -> DataFrame:
    wanted = df.columns if columns is None else columns
    return df.select(*[c for c in wanted if c in df.columns and c not in HISTORY_COLUMNS])


def shown_as(dimension: str, column: str, taken: Collection[str]) -> str:
    """The name of a dimension's column in the wide table, of which the names ``taken`` are in use."""
    return f"{dimension}_{column}" if column in taken else column


def _aligned(dimension: Dimension, taken: Sequence[str]) -> DataFrame:
    """Keys and declared columns of a dimension, renamed where the base has the name."""
    df, keys = current_rows(dimension.df), list(dimension.keys)
    for side, columns in (("base", taken), (dimension.name, df.columns)):
        missing = [k for k in keys if k not in columns]
        if missing:
            raise ValueError(f"join {dimension.name}: {side} lacks key columns {missing}")
    columns = [c for c in _declared(df, dimension.columns).columns if c not in keys]
    used = set(taken) | set(columns)
    selected = [F.col(k) for k in keys]
    for name in columns:
        alias = shown_as(dimension.name, name, taken)
        if alias != name and alias in used:
            raise ValueError(f"join {dimension.name}: both {name} and {alias} are taken")
        selected.append(F.col(name).alias(alias))
    return df.select(*selected)

"""Every mapped column delivered, cleaned, kept and joined: the wide table in all its columns.

A position is an order, a security a part, and every third order has a risk calculation.
Each column gets values by its type and its place among the columns, so that no two are alike
and every rule of every domain meets values that it changes and values that it leaves.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from siltstone.domains import POSITIONS, RISK_ANALYTICS, SECURITY, WIDE_EXCLUDED, WIDE_JOINS, WIDE_TABLE
from siltstone.plans.daily import run_day
from siltstone.sources.store import Store, write_table
from siltstone.specs import DomainSpec
from workloads.layers import scratch
from workloads.registry import register, table

_DAY = "2026-05-26"
_AT = f"TIMESTAMP '{_DAY} 00:00:00'"
_FEEDS = (
    (POSITIONS, "accounting_system_alpha", "orders", "o_orderkey", "true"),
    (SECURITY, "security_master", "part", "p_partkey", "true"),
    (RISK_ANALYTICS, "risk_engine", "orders", "o_orderkey", "o_orderkey % 3 = 0"),
)
# Expressions valid in Spark SQL and in DuckDB; the other columns follow from their types.
_GIVEN = {
    "position_id": "concat('P', o_orderkey)",
    "book_id": "'B'",
    "as_of_date": f"DATE '{_DAY}'",
    "risk_calc_id": "concat('R', o_orderkey)",
    "position_status": "CASE o_orderkey % 3 WHEN 0 THEN ' closed' WHEN 1 THEN 'Pending ' ELSE 'odd' END",
    "total_pnl": "CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice END",
}


def _delivered(spec: DomainSpec, name: str, key: str) -> str:
    """What a feed delivers in a column."""
    if name == "security_id":
        return f"concat('S', {key if key == 'p_partkey' else f'{key} % 150'})"
    if name in _GIVEN:
        return _GIVEN[name]
    place, kind = spec.column_names.index(name), spec.types[name]
    if kind == "STRING":
        return f"concat(' v{place}-', ({key} + {place}) % 11, ' ')"
    if kind == "DATE":
        return f"DATE '2026-01-01' + CAST(({key} + {place}) % 300 AS INT)"
    if kind == "TIMESTAMP":
        return "TIMESTAMP '2026-01-05 06:00:00'"
    if kind == "BOOLEAN":
        return f"({key} + {place}) % 2 = 0"
    return f"CAST(({key} * {place + 3}) % 601 AS DOUBLE) / 4 - 60"


def _cleaned(spec: DomainSpec, name: str, key: str) -> str:
    """The same column in silver, in SQL."""
    kind = spec.types[name]
    value = f"TRY_CAST({_delivered(spec, name, key)} AS {'VARCHAR' if kind == 'STRING' else kind})"
    if name in spec.upper_trim:
        value = f"upper(trim({value}, ' '))"
    for rule in spec.defaults:
        if rule.column == name:
            allowed = ", ".join(f"'{x}'" for x in rule.allowed)
            value = f"CASE WHEN {value} IN ({allowed}) THEN {value} ELSE '{rule.value}' END"
    for rule in spec.ranges:
        if rule.column == name:
            value = f"CASE WHEN {value} BETWEEN {rule.low} AND {rule.high} THEN {value} END"
    for rule in spec.sums:
        if rule.column == name:
            parts = " + ".join(f"CAST({_delivered(spec, x, key)} AS {spec.types[x]})" for x in rule.parts)
            value = f"CAST(coalesce({value}, {parts}) AS {kind})"
    return value


def _silver(spec: DomainSpec, feed: str, source: str, key: str, where: str) -> str:
    mapped = set(spec.feed(feed).columns.values())
    columns = []
    for name in spec.column_names:
        if name in mapped:
            columns.append(f"{_cleaned(spec, name, key)} AS {name}")
        elif name == spec.source_column:
            columns.append(f"'{feed}' AS {name}")
        else:
            columns.append(f"{_AT if name in spec.stamps else f'CAST(NULL AS {spec.types[name]})'} AS {name}")
    return f"SELECT {', '.join(columns)} FROM {source} WHERE {where}"


def _wide() -> str:
    columns, taken = [f"p.{c}" for c in POSITIONS.column_names], set(POSITIONS.column_names)
    joins = ""
    specs = {spec.name: spec for spec, *_ in _FEEDS}
    for name, keys, _ in WIDE_JOINS:
        own = [c for c in specs[name].column_names if c not in {*keys, *WIDE_EXCLUDED.get(name, ())}]
        renamed = {c: f"{name}_{c}" if c in taken else c for c in own}
        columns += [f"{name}.{c} AS {x}" for c, x in renamed.items()]
        taken |= set(renamed.values())
        joins += f" LEFT JOIN ({{{name}}}) {name} ON " + " AND ".join(f"{name}.{k} = p.{k}" for k in keys)
    select = f"SELECT {', '.join(columns)}, {_AT} AS _pipeline_timestamp FROM ({{positions}}) p{joins}"
    return select.format(**{spec.name: _silver(spec, *rest) for spec, *rest in _FEEDS})


@register(_wide())
def gold_whole_width(spark: SparkSession, directory: str) -> DataFrame:
    """One day in which all three domains deliver all their columns: the 202 columns of the wide table."""
    root = scratch(spark)
    raw, store = f"{root}/raw", Store(spark, f"{root}/warehouse")
    for spec, feed, source, key, where in _FEEDS:
        names = {own: name for own, name in spec.feed(feed).columns.items()}
        rows = table(spark, directory, source).filter(where)
        delivered = rows.selectExpr(*[f"{_delivered(spec, name, key)} AS `{own}`" for own, name in names.items()])
        write_table(delivered, f"{raw}/{feed}/delivery_{_DAY.replace('-', '')}.parquet")
    run_day(spark, raw, store, _DAY)
    return store.read("gold", WIDE_TABLE)

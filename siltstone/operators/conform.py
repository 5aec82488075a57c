"""Conforming a domain: types, enumerations, ranges, defaults and derived values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions.columns import (
    default_unless,
    null_outside,
    sum_if_null,
    typed,
    upper_trim,
)
from siltstone.specs import DomainSpec


def conform(df: DataFrame, spec: DomainSpec, run_ts=None) -> DataFrame:
    """Clean ``df`` by the rules of ``spec`` and keep its declared columns.

    Order per column: cast, upper/trim, then default and range. Sums use the cleaned
    parts, so they need a second select; Spark collapses both into one projection.
    Audit timestamps the feed does not deliver get ``run_ts``.
    """
    present = set(df.columns)
    cleaned = [_clean(name, type_name, spec).alias(name)
               for name, type_name in spec.columns if name in present]
    for name in spec.stamps:
        if name not in present:
            if run_ts is None:
                raise ValueError(f"{spec.name}: {name} is not delivered, so run_ts is needed")
            cleaned.append(typed(F.lit(run_ts), spec.types[name]).alias(name))
    out = df.select(*cleaned)

    available = set(out.columns)
    derived = {
        rule.column: sum_if_null(
            F.col(rule.column), [F.col(p) for p in rule.parts], spec.types[rule.column]
        ).alias(rule.column)
        for rule in spec.sums
        if {rule.column, *rule.parts} <= available
    }
    return out.select(*[derived.get(c, F.col(c)) for c in spec.column_names if c in available])


def _clean(name: str, type_name: str, spec: DomainSpec) -> Column:
    value = typed(F.col(name), type_name)
    if name in spec.upper_trim:
        value = upper_trim(value)
    for rule in spec.defaults:
        if rule.column == name:
            value = default_unless(value, rule.allowed, rule.value)
    for rule in spec.ranges:
        if rule.column == name:
            value = null_outside(value, rule.low, rule.high)
    return value

"""Data quality checks. Every check is a one-row DataFrame; nothing runs until it is read.

Checks that are plain aggregates (cardinality, null rates, ranges) can share one scan:
build them as ``Check`` values and hand them to ``run_checks``. Uniqueness and
referential integrity read only their key columns and are scanned on their own, since
carrying other aggregates through their shuffle would widen every key.

All aggregates are counts, so they need not be taken at once: ``totals_by`` takes them for
every date, ``rolled_up`` adds the dates up, and ``checked`` makes the report rows; or an
``Observation`` takes ``aggregates`` while rows are written, and ``observed`` makes the rows.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.functions.columns import typed
from siltstone.functions.hashing import HISTORY_COLUMNS
from siltstone.operators.rejects import COPIES

# Columns the engine adds, which are not "extra" in a schema check.
INTERNAL_COLUMNS = (
    *HISTORY_COLUMNS, "_pipeline_timestamp", "_source_system", "_ingestion_timestamp",
)
REPORT_COLUMNS = ("check", "label", "passed", "message")

# The texts of report messages.
PASS_TEXT = " [PASS]"
FAIL_TEXT = " [FAIL]"
ROW_COUNT_TEXT = "Row count: "
EXPECTED_TEXT = "Expected ~{expected} rows (±{percent:.0f}%), got "
NULL_TEXT = "Null check failures: "
EMPTY_TEXT = "Empty DataFrame"
RANGE_TEXT = " out-of-range values"
ABSENT_TEXT = "Column not present"
UNBOUNDED_TEXT = "No bounds specified"
UNIQUE_TEXT = "Unique keys: "
DUPLICATES_TEXT = ", duplicates: "
ORPHAN_TEXT = "Orphan {key} values: "
SCHEMA_TEXT = "Missing columns: {missing}, extra: {extra}"


@dataclass(frozen=True)
class Check:
    """Aggregates over a table, and the result columns computed from their values.

    ``results`` gets a function from an aggregate's name to the column holding it.
    """

    name: str
    label: str
    aggregates: Mapping[str, Column]
    results: Callable[[Callable[[str], Column]], dict[str, Column]]


# --- plain aggregates -----------------------------------------------------------------


def cardinality(expected: int | None = None, tolerance: float = 0.0, label: str = "") -> Check:
    """Row count within ``expected`` ± tolerance (a share); passes when nothing is expected."""

    def results(value):
        actual = value("rows")
        if expected is None:
            passed = F.lit(True)
            message = F.concat(F.lit(ROW_COUNT_TEXT), actual.cast("string"))
        else:
            low, high = int(expected * (1 - tolerance)), int(expected * (1 + tolerance))
            passed = actual.between(low, high)
            message = F.concat(
                F.lit(EXPECTED_TEXT.format(expected=expected, percent=tolerance * 100)),
                actual.cast("string"),
                _verdict(passed),
            )
        return {
            "expected": F.lit(expected).cast("bigint"),
            "actual": actual,
            "passed": passed,
            "message": message,
        }

    return Check("cardinality", label, {"rows": F.count(F.lit(1))}, results)


def null_rate(
    columns: Sequence[str], key_columns: Sequence[str], max_null_rate: float = 0.5, label: str = ""
) -> Check:
    """A key column fails on any NULL, another column above ``max_null_rate``."""

    def results(value):
        rates, failures = [], []
        for name in columns:
            nulls = value(f"nulls {name}")
            rate = F.try_divide(nulls, value("rows"))
            rates += [F.lit(name), F.round(rate, 4)]
            percent = F.format_string("%.2f%%", rate * 100)
            if name in key_columns:
                failing, limit = nulls > 0, ")"
                text = F.concat(F.lit(f"{name} (key, null_rate="), percent, F.lit(limit))
            else:
                failing, limit = rate > max_null_rate, f" > {max_null_rate:.0%})"
                text = F.concat(F.lit(f"{name} (null_rate="), percent, F.lit(limit))
            failures.append(F.when(failing, text))
        failed = F.array_compact(F.array(*failures))
        passed = F.size(failed) == 0
        listed = F.when(passed, F.lit("none")).otherwise(
            F.concat(F.lit("['"), F.array_join(failed, "', '"), F.lit("']"))
        )
        checked = F.concat(F.lit(NULL_TEXT), listed, _verdict(passed))
        return {
            "column_null_rates": F.create_map(*rates),
            "failures": failed,
            "passed": passed,
            "message": F.when(value("rows") == 0, F.lit(EMPTY_TEXT)).otherwise(checked),
        }

    if not columns:
        raise ValueError("null_rate needs at least one column")
    return Check("null_rates", label, _null_counters(columns), results)


def value_range(
    column: str,
    low: float | None = None,
    high: float | None = None,
    label: str = "",
    present: bool = True,
    type_name: str | None = None,
) -> Check:
    """Non-NULL values below ``low`` or above ``high`` are violations.

    Passes without a look at the data when the column is absent or there are no bounds.
    With ``type_name`` the column is as delivered, and compared as that type.
    """
    checked_value = F.col(column) if type_name is None else typed(F.col(column), type_name)
    skipped = None
    if not present:
        skipped = ABSENT_TEXT
    elif low is None and high is None:
        skipped = UNBOUNDED_TEXT

    def results(value):
        if skipped:
            violations, passed, message = F.lit(None).cast("bigint"), F.lit(True), F.lit(skipped)
        else:
            violations = value("outside")
            passed = violations == 0
            message = F.concat(
                F.lit(f"{column}: "), violations.cast("string"), F.lit(RANGE_TEXT),
                _verdict(passed),
            )
        return {
            "column": F.lit(column),
            "min": F.lit(low).cast("double"),
            "max": F.lit(high).cast("double"),
            "violations": violations,
            "passed": passed,
            "message": message,
        }

    if skipped:
        return Check("range", label, {}, results)
    outside = F.lit(False)
    if low is not None:
        outside = outside | (checked_value < low)
    if high is not None:
        outside = outside | (checked_value > high)
    return Check("range", label, {"outside": F.count_if(outside)}, results)


def lost_casts(types: Mapping[str, str], columns: Sequence[str], label: str = "") -> Check:
    """Values that are there but do not fit their declared type: cleaning would make them NULL."""
    present = [c for c in columns if c in types]

    def results(value):
        lost = [F.when(value(f"lost {c}") > 0, F.struct(F.lit(c).alias("column"), value(f"lost {c}").alias("values")))
                for c in present]
        failed = F.array_compact(F.array(*lost))
        total = reduce(lambda a, b: a + b, [value(f"lost {c}") for c in present])
        passed = total == 0
        return {
            "lost_values": failed,
            "passed": passed,
            "message": F.concat(F.lit("Values lost by casts: "), total.cast("string"), _verdict(passed)),
        }

    if not present:
        raise ValueError("lost_casts needs at least one declared column")
    counters = {
        f"lost {c}": F.count_if(F.col(c).isNotNull() & typed(F.col(c), types[c]).isNull()) for c in present
    }
    return Check("lost_casts", label, counters, results)


def run_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """All given checks in one pass over ``df``, as report rows."""
    return checked(_totals(df, checks), checks)


def checked(totals: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Report rows of checks whose aggregates are the one row of ``totals``."""
    rows = [
        F.struct(*_report_columns(_result_columns(check, _reader(position))))
        for position, check in enumerate(checks)
    ]
    return totals.select(F.inline(F.array(*rows)))


def aggregates(checks: Sequence[Check]) -> dict[str, Column]:
    """The aggregates of all checks under the names that ``checked`` knows."""
    return {
        f"{position} {name}": column
        for position, check in enumerate(checks)
        for name, column in check.aggregates.items()
    }


def totals_by(df: DataFrame, checks: Sequence[Check], by: str) -> DataFrame:
    """The aggregates for every value of ``by``: a date's checks, kept and added up later."""
    return df.groupBy(by).agg(*[column.alias(name) for name, column in aggregates(checks).items()])


def rolled_up(totals: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """The aggregates of all dates together: every one is a count, so they add up."""
    return totals.agg(*[F.coalesce(F.sum(f"`{name}`"), F.lit(0)).alias(name) for name in aggregates(checks)])


def observed(spark: SparkSession, values: Mapping[str, int], checks: Sequence[Check]) -> DataFrame:
    """Report rows of checks whose aggregates were taken while their rows were written."""
    names = list(aggregates(checks))
    kinds = T.StructType([T.StructField(name, T.LongType()) for name in names])
    return checked(spark.createDataFrame([tuple(values[name] for name in names)], kinds), checks)


def check_cardinality(
    df: DataFrame, expected_count: int | None = None, tolerance_pct: float = 0.0, label: str = ""
) -> DataFrame:
    return _one(df, cardinality(expected_count, tolerance_pct, label))


def check_null_rates(
    df: DataFrame, key_columns: Sequence[str], max_null_rate: float = 0.5, label: str = ""
) -> DataFrame:
    return _one(df, null_rate(df.columns, key_columns, max_null_rate, label))


def check_range(
    df: DataFrame,
    column: str,
    min_val: float | None = None,
    max_val: float | None = None,
    label: str = "",
) -> DataFrame:
    return _one(df, value_range(column, min_val, max_val, label, column in df.columns))


def null_rates(
    df: DataFrame, key_columns: Sequence[str], max_null_rate: float = 0.5
) -> DataFrame:
    """One row per column: its NULLs, their rate, and whether that fails. One pass."""
    totals = df.agg(*[column.alias(name) for name, column in _null_counters(df.columns).items()])
    rows = []
    for name in df.columns:
        nulls = F.col(f"`nulls {name}`")
        rate = F.try_divide(nulls, F.col("rows"))
        failed = nulls > 0 if name in key_columns else rate > max_null_rate
        rows.append(
            F.struct(
                F.lit(name).alias("column_name"),
                F.col("rows").alias("total_rows"),
                nulls.alias("null_count"),
                F.round(rate, 4).alias("null_rate"),
                F.lit(name in key_columns).alias("is_key"),
                F.coalesce(failed, F.lit(False)).alias("failed"),
            )
        )
    return totals.select(F.inline(F.array(*rows)))


# --- checks with a shuffle of their own -----------------------------------------------


def check_uniqueness(df: DataFrame, key_columns: Sequence[str], label: str = "") -> DataFrame:
    """Rows minus distinct keys must be 0. NULL is a key value like any other."""
    return unique_row(df.agg(*key_counters(key_columns)), label)


def key_counters(key_columns: Sequence[str]) -> list[Column]:
    """Rows and distinct keys. By a column of the key, the counts of its values add up."""
    return [
        F.count(F.lit(1)).alias("total_rows"),
        F.count_distinct(F.struct(*key_columns)).alias("distinct_keys"),
    ]


def unique_row(counts: DataFrame, label: str = "") -> DataFrame:
    """The uniqueness check from its counters."""
    duplicates = F.col("total_rows") - F.col("distinct_keys")
    passed = duplicates == 0
    message = F.concat(
        F.lit(UNIQUE_TEXT), F.col("distinct_keys").cast("string"), F.lit("/"),
        F.col("total_rows").cast("string"), F.lit(DUPLICATES_TEXT), duplicates.cast("string"),
        _verdict(passed),
    )
    return counts.select(
        F.lit("uniqueness").alias("check"),
        F.lit(label).alias("label"),
        "total_rows",
        "distinct_keys",
        duplicates.alias("duplicates"),
        passed.alias("passed"),
        message.alias("message"),
    )


def orphan_keys(child: DataFrame, parent: DataFrame, join_key: str | Sequence[str]) -> DataFrame:
    """Distinct child keys without a parent. A key with a NULL in it has no parent.

    Both sides are reduced to distinct keys before they meet, so a key repeated a
    billion times is one row per map task in the shuffle.
    """
    keys = [join_key] if isinstance(join_key, str) else list(join_key)
    return child.select(*keys).distinct().join(parent.select(*keys).distinct(), keys, "left_anti")


def check_referential_integrity(
    child_df: DataFrame, parent_df: DataFrame, join_key: str | Sequence[str], label: str = ""
) -> DataFrame:
    orphans = orphan_keys(child_df, parent_df, join_key)
    return integrity_row(orphans.agg(F.count(F.lit(1)).alias("orphan_count")), join_key, label)


def integrity_row(counted: DataFrame, join_key: str | Sequence[str], label: str = "") -> DataFrame:
    """The check of references from the number of orphans."""
    shown = join_key if isinstance(join_key, str) else ", ".join(join_key)
    passed = F.col("orphan_count") == 0
    message = F.concat(
        F.lit(ORPHAN_TEXT.format(key=shown)), F.col("orphan_count").cast("string"), _verdict(passed)
    )
    return counted.select(
        F.lit("referential_integrity").alias("check"),
        F.lit(label).alias("label"),
        F.lit(shown).alias("join_key"),
        "orphan_count",
        passed.alias("passed"),
        message.alias("message"),
    )


# --- schema ---------------------------------------------------------------------------


def check_schema_conformance(
    df: DataFrame, canonical: T.StructType, label: str = "", check_types: bool = False
) -> DataFrame:
    """Every canonical column must exist; letter case does not matter.

    Types are compared only with ``check_types``. Reads no rows.
    """
    actual = {f.name.lower(): f.dataType for f in df.schema.fields}
    wanted = {f.name.lower(): f.dataType for f in canonical.fields}
    missing = sorted(wanted.keys() - actual.keys())
    extra = sorted(actual.keys() - wanted.keys() - set(INTERNAL_COLUMNS))
    mistyped = sorted(
        f"{name}: {actual[name].simpleString()} instead of {kind.simpleString()}"
        for name, kind in wanted.items()
        if check_types and name in actual and actual[name] != kind
    )
    passed = not missing and not mistyped
    message = (
        SCHEMA_TEXT.format(missing=missing or "none", extra=len(extra))
        + (f", mistyped: {mistyped or 'none'}" if check_types else "")
        + (PASS_TEXT if passed else FAIL_TEXT)
    )
    schema = (
        "check string, label string, missing_columns array<string>, extra_columns array<string>, "
        "mistyped_columns array<string>, passed boolean, message string"
    )
    row = ("schema_conformance", label, missing, extra, mistyped, passed, message)
    return df.sparkSession.createDataFrame([row], schema)


def missing_feed(spark: SparkSession, feed: str, label: str = "") -> DataFrame:
    """The failed check of a feed that delivered nothing."""
    row = ("delivery", label, feed, False, f"No data from {feed} [FAIL]")
    schema = "check string, label string, feed string, passed boolean, message string"
    return spark.createDataFrame([row], schema)


def check_rejects(dealt: DataFrame, delivered: int, label: str = "") -> DataFrame:
    """Fails if rows of a delivery went to the reject table; delivered = kept + rejected."""
    counted = dealt.agg(F.coalesce(F.sum(COPIES), F.lit(0)).alias("rejected"))
    passed = F.col("rejected") == 0
    message = F.concat(
        F.lit("Rejected rows: "), F.col("rejected").cast("string"), F.lit(f" of {delivered}"), _verdict(passed)
    )
    return counted.select(
        F.lit("rejects").alias("check"),
        F.lit(label).alias("label"),
        F.lit(delivered).cast("long").alias("delivered"),
        "rejected",
        passed.alias("passed"),
        message.alias("message"),
    )


# --- report ---------------------------------------------------------------------------


def report(checks: Sequence[DataFrame]) -> DataFrame:
    """Check rows of any kind under common columns; the others go into ``details`` (JSON)."""
    rows = [check.select(*_report_columns([F.col(c) for c in check.columns], check.columns))
            for check in checks]
    return reduce(lambda a, b: a.unionByName(b), rows)


def summary(report_rows: DataFrame) -> DataFrame:
    """Totals of a report; a report without checks has passed."""
    passed = F.count_if("passed")
    return report_rows.agg(
        F.count(F.lit(1)).alias("total_checks"),
        passed.alias("passed"),
        (F.count(F.lit(1)) - passed).alias("failed"),
        F.coalesce(F.bool_and("passed"), F.lit(True)).alias("all_passed"),
    )


def report_document(report_rows: DataFrame, name: str, run_ts) -> DataFrame:
    """The whole report as one row: name, time, summary and the list of checks.

    Its size is that of the list of checks, whatever the size of the checked tables.
    """
    passed = F.count_if("passed")
    return report_rows.agg(
        F.lit(name).alias("pipeline"),
        F.lit(run_ts).cast("timestamp").alias("timestamp"),
        F.struct(
            F.count(F.lit(1)).alias("total_checks"),
            passed.alias("passed"),
            (F.count(F.lit(1)) - passed).alias("failed"),
            F.coalesce(F.bool_and("passed"), F.lit(True)).alias("all_passed"),
        ).alias("summary"),
        F.array_sort(F.collect_list(F.struct(*report_rows.columns))).alias("checks"),
    )


# --- shared pieces --------------------------------------------------------------------


def _verdict(passed: Column) -> Column:
    return F.when(passed, F.lit(PASS_TEXT)).otherwise(F.lit(FAIL_TEXT))


def _null_counters(columns: Sequence[str]) -> dict[str, Column]:
    counters = {f"nulls {name}": F.count_if(F.col(f"`{name}`").isNull()) for name in columns}
    return {"rows": F.count(F.lit(1)), **counters}


def _reader(position: int) -> Callable[[str], Column]:
    return lambda name: F.col(f"`{position} {name}`")


def _totals(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    wanted = [column.alias(name) for name, column in aggregates(checks).items()]
    # Without an aggregate to compute there is still one result row to make.
    return df.agg(*wanted) if wanted else df.limit(0).agg(F.count(F.lit(1)))


def _result_columns(check: Check, value: Callable[[str], Column]) -> dict[str, Column]:
    head = {"check": F.lit(check.name), "label": F.lit(check.label)}
    return {**head, **check.results(value)}


def _one(df: DataFrame, check: Check) -> DataFrame:
    columns = _result_columns(check, _reader(0))
    return _totals(df, [check]).select(*[c.alias(name) for name, c in columns.items()])


def _report_columns(columns, names: Sequence[str] | None = None) -> list[Column]:
    named = dict(zip(names, columns)) if names is not None else dict(columns)
    details = [column.alias(name) for name, column in named.items() if name not in REPORT_COLUMNS]
    return [named[name].alias(name) for name in REPORT_COLUMNS] + [
        F.to_json(F.struct(*details)).alias("details")
    ]

from datetime import datetime

import json

import pytest
from pyspark.sql import types as T

from siltstone.operators import quality as q


def one(df):
    return df.first().asDict()


@pytest.mark.parametrize(
    ("expected", "tolerance", "passed"),
    [(None, 0.0, True), (10, 0.0, True), (11, 0.0, False), (11, 0.1, True), (9, 0.1, False), (8, 0.25, True)],
)
def test_cardinality(spark, expected, tolerance, passed):
    row = one(q.check_cardinality(spark.range(10), expected, tolerance, "t"))
    assert (row["check"], row["label"], row["expected"], row["actual"], row["passed"]) == (
        "cardinality", "t", expected, 10, passed,
    )
    if expected is None:
        assert row["message"] == "Row count: 10"
    else:
        state = "PASS" if passed else "FAIL"
        assert row["message"] == f"Expected ~{expected} rows (±{tolerance * 100:.0f}%), got 10 [{state}]"


def test_uniqueness_counts_null_as_a_value(spark):
    df = spark.createDataFrame([(1, None), (1, None), (None, None), (2, 3)], "a int, b int")
    row = one(q.check_uniqueness(df, ["a", "b"], "k"))
    assert (row["total_rows"], row["distinct_keys"], row["duplicates"], row["passed"]) == (4, 3, 1, False)
    assert row["message"] == "Unique keys: 3/4, duplicates: 1 [FAIL]"


def test_null_rates(spark):
    df = spark.createDataFrame([(1, None, None), (2, None, 1.0), (None, 3, 2.0)], "a int, b int, c double")
    row = one(q.check_null_rates(df, ["a"], 0.5, "n"))
    assert row["column_null_rates"] == {"a": 0.3333, "b": 0.6667, "c": 0.3333}
    assert row["failures"] == ["a (key, null_rate=33.33%)", "b (null_rate=66.67% > 50%)"]
    assert not row["passed"]
    assert row["message"] == (
        "Null check failures: ['a (key, null_rate=33.33%)', 'b (null_rate=66.67% > 50%)'] [FAIL]"
    )
    assert [(r.column_name, r.failed) for r in q.null_rates(df, ["a"]).collect()] == [
        ("a", True), ("b", True), ("c", False),
    ]


def test_null_rate_at_the_limit_passes(spark):
    df = spark.createDataFrame([(1,), (None,)], "a int")
    assert one(q.check_null_rates(df, [], 0.5))["passed"]
    assert not one(q.check_null_rates(df, [], 0.49))["passed"]


def test_empty_frame_passes(spark):
    row = one(q.check_null_rates(spark.createDataFrame([], "a int"), ["a"]))
    assert row["passed"] and row["message"] == "Empty DataFrame"


def test_columns_with_odd_names(spark):
    df = spark.createDataFrame([(1, None)], "`a.b` int, `c d` int")
    assert one(q.check_null_rates(df, ["a.b"]))["column_null_rates"] == {"a.b": 0.0, "c d": 1.0}


def test_referential_integrity(spark):
    child = spark.createDataFrame([(1,), (1,), (None,), (None,)], "k int")
    parent = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    row = one(q.check_referential_integrity(child, parent, "k", "fk"))
    assert (row["orphan_count"], row["passed"]) == (1, False)
    assert row["message"] == "Orphan k values: 1 [FAIL]"
    assert one(q.check_referential_integrity(parent.na.drop(), parent, ["k"]))["passed"]


@pytest.mark.parametrize(
    ("low", "high", "violations"), [(0, 100, 3), (None, 100, 2), (0, None, 1), (-5, None, 0)]
)
def test_range(spark, low, high, violations):
    df = spark.createDataFrame(
        [(-1.0,), (0.0,), (100.0,), (101.0,), (None,), (float("nan"),)], "v double"
    )
    row = one(q.check_range(df, "v", low, high))
    assert (row["violations"], row["passed"]) == (violations, violations == 0)


def test_range_that_has_nothing_to_check(spark):
    assert one(q.check_range(spark.range(1), "v", 0, 1))["message"] == "Column not present"
    assert one(q.check_range(spark.range(1), "id"))["message"] == "No bounds specified"


def test_schema_conformance(spark):
    wanted = T.StructType([T.StructField("ID", T.LongType()), T.StructField("name", T.StringType())])
    df = spark.createDataFrame([(1, 2, True)], "id int, other int, _is_current boolean")
    row = one(q.check_schema_conformance(df, wanted, "s"))
    assert row["missing_columns"] == ["name"] and row["extra_columns"] == ["other"]
    assert row["message"] == "Missing columns: ['name'], extra: 1 [FAIL]"
    typed = one(q.check_schema_conformance(df.selectExpr("id", "'x' AS name"), wanted, check_types=True))
    assert typed["mistyped_columns"] == ["id: int instead of bigint"] and not typed["passed"]
    assert one(q.check_schema_conformance(df.selectExpr("id", "'x' AS name"), wanted))["passed"]


def test_report_and_summary(spark):
    df = spark.createDataFrame([(1,), (1,)], "k int")
    rows = q.run_checks(df, [q.cardinality(2), q.null_rate(["k"], ["k"])]).unionByName(
        q.report([q.check_uniqueness(df, ["k"])])
    )
    assert one(q.summary(rows)) == {"total_checks": 3, "passed": 2, "failed": 1, "all_passed": False}
    details = {r.check: json.loads(r.details) for r in rows.collect()}
    assert details["uniqueness"] == {"total_rows": 2, "distinct_keys": 1, "duplicates": 1}
    assert details["cardinality"] == {"expected": 2, "actual": 2}
    document = q.report_document(rows, "daily", datetime(2026, 5, 26)).first()
    assert (document.pipeline, document.summary.failed, len(document.checks)) == ("daily", 1, 3)


def test_report_without_checks_has_passed(spark):
    rows = q.report([q.check_cardinality(spark.range(1))]).filter("false")
    assert one(q.summary(rows)) == {"total_checks": 0, "passed": 0, "failed": 0, "all_passed": True}
    document = q.report_document(rows, "daily", datetime(2026, 5, 26)).first()
    assert document.summary.all_passed and document.checks == []

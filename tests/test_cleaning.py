from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.domains import DOMAINS, POSITIONS, RISK_ANALYTICS, SECURITY
from siltstone.functions.columns import canonical_type, typed
from siltstone.operators.conform import conform
from siltstone.operators.evolve import added_fields, evolve, evolution_audit
from siltstone.operators.project import rename, select_declared, snapshot
from siltstone.sources.extract import extract

RUN = datetime(2026, 5, 26)


def values(df, column):
    return [r[0] for r in df.select(column).collect()]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_bad_casts_become_null(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    try:
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        df = spark.createDataFrame([("abc",), ("12.345",), ("1" * 20,), ("0.00005",)], "v string")
        out = values(df.select(typed(F.col("v"), "DECIMAL(8,4)").alias("v")), "v")
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
    assert out == [None, Decimal("12.3450"), None, Decimal("0.0001")]


def test_canonical_types():
    assert canonical_type("decimal(18, 4)") == T.DecimalType(18, 4)
    assert canonical_type("Decimal") == T.DecimalType(18, 2)
    assert canonical_type("date") == T.DateType()
    with pytest.raises(ValueError, match="unknown canonical type"):
        canonical_type("money")


def position(spark, **columns):
    rows = [tuple(v) for v in zip(*columns.values())]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return conform(spark.createDataFrame(rows, schema), POSITIONS, RUN)


def test_status_enum_and_default(spark):
    out = position(spark, position_status=[" open ", "bad", None, "\topen", "closed"])
    assert values(out, "position_status") == ["OPEN", "OPEN", "OPEN", "OPEN", "CLOSED"]


def test_total_is_derived_in_the_declared_type(spark):
    out = position(
        spark, total_pnl=[None, "9", None], unrealized_pnl=["1", "1", None], realized_pnl=["2", "2", "2"]
    )
    assert values(out, "total_pnl") == [Decimal("3.00"), Decimal("9.00"), None]
    assert out.schema["total_pnl"].dataType == T.DecimalType(18, 2)


def test_total_needs_all_three_columns(spark):
    out = position(spark, total_pnl=[None], unrealized_pnl=["1"])
    assert values(out, "total_pnl") == [None]


def test_stamps_are_the_run_time_and_need_one(spark):
    out = position(spark, position_id=["p"])
    assert values(out, "created_timestamp") == [RUN]
    with pytest.raises(ValueError, match="run_ts"):
        conform(spark.createDataFrame([("p",)], "position_id string"), POSITIONS)


def test_range_bounds_are_inclusive(spark):
    df = spark.createDataFrame(
        [("-50",), ("200",), ("-50.00001",), ("200.00001",), (None,)], "yield_to_maturity string"
    )
    out = values(conform(df, RISK_ANALYTICS), "yield_to_maturity")
    assert out == [Decimal("-50.00000"), Decimal("200.00000"), None, None, None]


def test_ratings_lose_their_case(spark):
    df = spark.createDataFrame([(" Aa1 ", "101")], "credit_rating_moody string, coupon_rate string")
    row = conform(df, SECURITY).first()
    assert (row.credit_rating_moody, row.coupon_rate) == ("AA1", None)


def test_domain_tables():
    assert {n: len(s.columns) for n, s in DOMAINS.items()} == {
        "positions": 65, "security": 85, "risk_analytics": 55,
    }
    assert [len(f.columns) for f in POSITIONS.feeds] == [62, 62]
    assert POSITIONS.feeds[0].columns.keys() != POSITIONS.feeds[1].columns.keys()
    assert set(POSITIONS.feeds[0].columns.values()) == set(POSITIONS.feeds[1].columns.values())
    assert POSITIONS.required == (
        "position_id", "book_id", "as_of_date", "security_id", "source_system",
    )
    assert SECURITY.types["coupon_rate"] == "DECIMAL(8,5)"
    for spec in DOMAINS.values():
        assert len(set(spec.column_names)) == len(spec.columns)
        assert set(spec.key) <= set(spec.column_names)
        named = {*spec.upper_trim, *spec.stamps, *(r.column for r in (*spec.ranges, *spec.defaults))}
        assert named <= set(spec.column_names)
        assert len(spec.schema().fields) == len(spec.columns)


def test_extract_tags_and_drops(spark):
    df = spark.createDataFrame([("p1", "b1", True)], "POS_ID string, BOOK_CODE string, BREAK_FLAG boolean")
    out = extract(df, POSITIONS, "accounting_system_alpha")
    assert out.columns == ["position_id", "book_id", "source_system"]
    assert out.first().source_system == "accounting_system_alpha"
    full = extract(df, POSITIONS, "accounting_system_alpha", missing="null")
    assert full.columns == list(POSITIONS.column_names)
    assert full.schema["quantity"].dataType == T.DecimalType(18, 4)
    with pytest.raises(ValueError, match="missing columns"):
        extract(df, POSITIONS, "accounting_system_alpha", missing="error")


def test_rename_does_not_chain(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert rename(df, {"a": "b", "b": "c", "x": "y"}).first().asDict() == {"b": 1, "c": 2}


def test_select_declared_rejects_unknown_mode(spark):
    with pytest.raises(ValueError, match="missing must be"):
        select_declared(spark.range(1), ["id"], "ignore")


def test_snapshot_without_date_or_column(spark):
    df = spark.range(3)
    assert snapshot(df, None).count() == 3
    assert snapshot(df, RUN).count() == 3


def test_evolution_adds_and_audits(spark):
    df = spark.createDataFrame([(1, "x")], "ID int, name string")
    target = T.StructType([
        T.StructField("id", T.IntegerType()), T.StructField("price", T.DecimalType(18, 4)),
    ])
    new = added_fields(df, target)
    assert [f.name for f in new] == ["price"]
    out = evolve(df, target)
    assert out.columns == ["ID", "name", "price"]
    assert out.schema["price"].dataType == T.DecimalType(18, 4)
    assert evolve(out, target).columns == out.columns
    assert evolution_audit(spark, "d", new, RUN).first().asDict() == {
        "domain": "d", "action": "schema_evolution", "mode": "add_only", "column_name": "price",
        "data_type": "decimal(18,4)", "evolved_at": RUN,
    }

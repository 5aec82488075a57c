from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.functions.hashing import record_hash
from siltstone.operators.evolve import evolve
from siltstone.operators.history import as_of, closed_rows, current_rows, merge_current, scd2_merge, scd2_merge_all

DAYS = [datetime(2026, 5, 26), datetime(2026, 5, 27), datetime(2026, 5, 28)]
SCHEMA = "k int, a string, b string"


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def merged(spark, deliveries, **options):
    table = None
    for i, rows in enumerate(deliveries):
        table = scd2_merge(table, frame(spark, rows), ["k"], DAYS[i], f"b{i}", **options)
    return table


def versions(table):
    names = ["k", "a", "b", "_effective_from", "_effective_to", "_is_current", "_batch_id"]
    return sorted((tuple(r) for r in table.select(*names).collect()), key=repr)


def test_insert_change_keep_absent(spark):
    table = merged(spark, [
        [(1, "x", "y"), (2, "x", "y"), (3, "x", "y")],
        [(1, "x", "y"), (2, "z", "y"), (4, "n", None)],
    ])
    assert versions(table) == sorted([
        (1, "x", "y", DAYS[0], None, True, "b0"),
        (2, "x", "y", DAYS[0], DAYS[1], False, "b0"),
        (2, "z", "y", DAYS[1], None, True, "b1"),
        (3, "x", "y", DAYS[0], None, True, "b0"),
        (4, "n", None, DAYS[1], None, True, "b1"),
    ], key=repr)


def test_key_that_returns_after_absence_is_closed_then(spark):
    table = merged(spark, [[(1, "x", "y")], [(2, "x", "y")], [(1, "z", "y")]])
    rows = [v for v in versions(table) if v[0] == 1]
    assert rows == [
        (1, "x", "y", DAYS[0], DAYS[2], False, "b0"),
        (1, "z", "y", DAYS[2], None, True, "b2"),
    ]


def test_full_delivery_closes_what_is_absent(spark):
    table = merged(spark, [[(1, "x", "y"), (2, "x", "y")], [(1, "x", "y")]], absent="close")
    assert (2, "x", "y", DAYS[0], DAYS[1], False, "b0") in versions(table)
    assert current_rows(table).count() == 1


@pytest.mark.parametrize("rows", [[(1, "a", "b"), (1, "c", "d")], [(1, "a", "b"), (1, "a", "b")]])
@pytest.mark.parametrize("existing", [None, [(1, "x", "y")], [(2, "x", "y")]])
def test_duplicate_incoming_key_is_rejected(spark, rows, existing):
    table = None
    if existing:
        table = merged(spark, [existing])
    with pytest.raises(PySparkException, match="duplicate key"):
        scd2_merge(table, frame(spark, rows), ["k"], DAYS[1], "b1").collect()


def test_null_key_is_rejected(spark):
    table = merged(spark, [[(1, "x", "y")]])
    with pytest.raises(PySparkException, match="NULL in key"):
        scd2_merge(table, frame(spark, [(None, "x", "y")]), ["k"], DAYS[1], "b1").collect()


def test_older_batch_cannot_close_a_newer_version(spark):
    table = scd2_merge(None, frame(spark, [(1, "x", "y")]), ["k"], DAYS[2], "b2")
    with pytest.raises(PySparkException, match="older than a version"):
        scd2_merge(table, frame(spark, [(1, "z", "y")]), ["k"], DAYS[0], "b0").collect()


def test_filters_on_the_result_do_not_trip_the_guards(spark):
    """A caller's filter is merged with the guards by the optimizer: values must be safe."""
    table = merged(spark, [[(1, "x", "y"), (2, "x", "y")], [(1, "z", "y"), (2, "x", "y")]])
    assert closed_rows(table).count() == 1
    assert current_rows(table).count() == 2
    assert table.filter(F.col("_effective_from") == F.lit(DAYS[2])).count() == 0
    assert table.filter("k = 1 and _is_current").count() == 1
    assert table.filter("k is null").count() == 0
    assert table.filter(F.col("_effective_to") == F.lit(DAYS[1])).count() == 1


def test_null_flag_is_an_error(spark):
    table = spark.createDataFrame([(1, None)], "k int, _is_current boolean")
    with pytest.raises(PySparkException, match="_is_current is NULL"):
        closed_rows(table).collect()


def test_type_change_and_reserved_names_are_errors(spark):
    table = merged(spark, [[(1, "x", "y")]])
    with pytest.raises(ValueError, match="types differ"):
        merge_current(table, frame(spark, [(1, 2, "y")], "k int, a int, b string"), ["k"], DAYS[1], "b")
    with pytest.raises(ValueError, match="history columns"):
        merge_current(None, table, ["k"], DAYS[1], "b")
    with pytest.raises(ValueError, match="lack key"):
        merge_current(None, frame(spark, [(1, "x", "y")]), ["missing"], DAYS[1], "b")


def test_added_null_column_versions_no_row(spark):
    rows = [(1, "x", "y"), (2, None, "y")]
    wider = T.StructType([T.StructField("c", T.DecimalType(8, 4))])
    table = merged(spark, [rows])
    after = scd2_merge(evolve(table, wider), evolve(frame(spark, rows), wider), ["k"], DAYS[1], "b1")
    assert after.filter("_batch_id = 'b1'").count() == 0
    assert "c" in after.columns


def test_column_only_the_table_has_is_null_in_new_versions(spark):
    table = merged(spark, [[(1, "x", "y")]])
    after = scd2_merge(table, frame(spark, [(1, "x")], "k int, a string"), ["k"], DAYS[1], "b1")
    assert {(r.b, r._is_current) for r in after.collect()} == {("y", False), (None, True)}


def test_excluded_columns_do_not_version(spark):
    table = merged(spark, [[(1, "x", "y")]], hash_exclude=["b"])
    after = scd2_merge(table, frame(spark, [(1, "x", "new")]), ["k"], DAYS[1], "b1", hash_exclude=["b"])
    assert versions(after) == versions(table)


def hashes(spark, rows, encoding):
    df = frame(spark, rows)
    return [r[0] for r in df.select(record_hash(df, encoding=encoding)).collect()]


def test_json_hash_tells_apart_what_the_delimited_one_confuses(spark):
    rows = [(1, "a||b", "c"), (1, "a", "b||c"), (1, "__NULL__", "x"), (1, None, "x")]
    one, two, three, four = hashes(spark, rows, "delimited")
    assert one == two and three == four
    assert len(set(hashes(spark, rows, "json"))) == 4


def test_hash_ignores_column_order_and_session_zone(spark):
    df = spark.createDataFrame([(1, datetime(2026, 1, 1, 12, 0, 0, 123456))], "k int, t timestamp")
    first = df.select(record_hash(df)).first()[0]
    flipped = df.select("t", "k")
    assert flipped.select(record_hash(flipped)).first()[0] == first
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert df.select(record_hash(df)).first()[0] == first
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    later = df.withColumn("t", F.col("t") + F.expr("INTERVAL 1 MICROSECOND"))
    assert later.select(record_hash(later)).first()[0] != first


def model(deliveries, absent):
    """The same history in plain Python."""
    table = []
    for i, rows in enumerate(deliveries):
        incoming = {r[0]: r for r in rows}
        current = {v["row"][0]: v for v in table if v["to"] is None}
        for key, version in current.items():
            if (key in incoming and incoming[key] != version["row"]) or (
                key not in incoming and absent == "close"
            ):
                version["to"] = DAYS[i]
        for key, row in incoming.items():
            if key not in current or current[key]["row"] != row:
                table.append({"row": row, "from": DAYS[i], "to": None, "batch": f"b{i}"})
    return sorted(
        ((*v["row"], v["from"], v["to"], v["to"] is None, v["batch"]) for v in table), key=repr
    )


delivery = st.dictionaries(
    st.integers(0, 4), st.tuples(st.sampled_from([None, "", "x"]), st.sampled_from([None, "y", "||"])),
    max_size=5,
).map(lambda d: [(k, *v) for k, v in d.items()])


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(delivery, min_size=1, max_size=3), st.sampled_from(["keep", "close"]))
def test_random_deliveries_match_the_model(spark, deliveries, absent):
    assert versions(merged(spark, deliveries, absent=absent)) == model(deliveries, absent)


def test_as_of_picks_half_open_intervals(spark):
    table = merged(spark, [[(1, "x", "y")], [(1, "z", "y")]])
    assert [r.a for r in as_of(table, DAYS[0]).collect()] == ["x"]
    assert [r.a for r in as_of(table, DAYS[1]).collect()] == ["z"]


_ROWS = st.lists(
    st.tuples(st.integers(1, 4), st.sampled_from(["x", "y"]), st.none()),
    unique_by=lambda row: row[0], max_size=4,
)


@pytest.mark.parametrize("absent", ["keep", "close"])
@pytest.mark.parametrize("before", [0, 1])
@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(days=st.lists(_ROWS, min_size=3, max_size=3))
def test_deliveries_merged_together_or_one_by_one(spark, days, before, absent):
    existing = merged(spark, days[:before], absent=absent)
    later = [(frame(spark, days[i]), DAYS[i], f"b{i}") for i in range(before, 3)]
    together = scd2_merge_all(existing, later, ["k"], absent=absent)
    assert versions(together) == versions(merged(spark, days, absent=absent))


@pytest.mark.parametrize("days, error", [
    ([[(1, "x", None)], [(2, "x", None), (2, "y", None)]], "duplicate key"),
    ([[(1, "x", None)], [(None, "x", None)]], "NULL in key"),
])
def test_deliveries_merged_together_guard_their_keys(spark, days, error):
    deliveries = [(frame(spark, rows), DAYS[i], f"b{i}") for i, rows in enumerate(days)]
    with pytest.raises(PySparkException, match=error):
        scd2_merge_all(None, deliveries, ["k"]).collect()


def test_deliveries_merged_together_guard_their_order(spark):
    deliveries = [(frame(spark, [(1, a, None)]), DAYS[i], f"b{i}") for i, a in ((1, "x"), (0, "y"))]
    with pytest.raises(PySparkException, match="older"):
        scd2_merge_all(None, deliveries, ["k"]).collect()


def test_five_deliveries_are_one_shuffle(spark, tmp_path):
    frame(spark, [(1, "x", "y")]).write.parquet(str(tmp_path / "t"))
    rows = spark.read.parquet(str(tmp_path / "t"))
    deliveries = [(rows, datetime(2026, 5, day), f"b{day}") for day in range(1, 6)]
    plan = scd2_merge_all(None, deliveries, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 5
    assert plan.count("Exchange hashpartitioning") == 1

"""Columns that no feed delivers: stored like the others, but carried by no shuffle and no sort."""

import re
from datetime import datetime

from pyspark.sql import functions as F

from siltstone.domains import DOMAINS, WIDE_EXCLUDED, WIDE_JOINS, WIDE_TABLE
from siltstone.operators.history import merge_current
from siltstone.plans import silver
from siltstone.plans.gold import empty_columns, wide_frame
from siltstone.plans.silver import silver_step
from siltstone.sources.store import Store, write_table
from siltstone.specs import DomainSpec
from workloads import layers

AT = [datetime(2026, 5, day) for day in (26, 27, 28)]
SPEC = DomainSpec(
    name="t", key=("k", "day"), columns=(("k", "STRING"), ("a", "STRING"), ("day", "DATE"), ("b", "STRING")),
    partition="day", rejects="quarantine",
)


def rows(spark, values, schema="k string, a string, day string"):
    return spark.createDataFrame(values, schema).withColumn("day", F.col("day").cast("date"))


def held(store, batch=None):
    columns = ["k", "a", "b", "_effective_from", "_is_current", "_record_hash"]
    return sorted(map(tuple, store.read_history("silver", "t", batch).select(*columns).collect()), key=str)


def test_a_column_delivered_later_keeps_its_values(spark, tmp_path):
    """A column is NULL only where every batch that wrote the dates says so, and is whole in every file."""
    store = Store(spark, str(tmp_path))
    d1, d2 = "2026-05-26", "2026-05-27"
    silver_step(store, rows(spark, [("x", "1", d1), ("y", "2", d1)]), SPEC, "b1", AT[0])
    assert store.empty_columns("silver", "t", "b1") == {"b"}
    with_b = rows(spark, [("x", "1", "v", d1), ("z", "3", "w", d2)], "k string, a string, b string, day string")
    silver_step(store, with_b, SPEC, "b2", AT[1])
    assert store.empty_columns("silver", "t", "b2") == set()
    second = held(store)
    silver_step(store, rows(spark, [("q", "4", d2)]), SPEC, "b3", AT[2])
    assert store.empty_columns("silver", "t", "b3") == set()
    assert [r for r in held(store) if r[0] != "q"] == second
    found = {(k, b) for k, _, b, _, current, _ in second if current}
    assert found == {("x", "v"), ("y", None), ("z", "w")}
    # An unchanged row has the hash that all columns give; no schema that is read says what files say.
    whole = rows(spark, [("y", "2", d1)]).withColumn("b", F.lit(None).cast("string"))
    assert merge_current(None, whole, SPEC.key, AT[0], "b1").first()["_record_hash"] in {r[5] for r in second}
    for batch in ("b1", "b2", "b3"):
        assert "b" in spark.read.parquet(store.path("silver", "t", batch)).columns
    assert not any(f.metadata for f in store.read_current("silver", "t").schema.fields)


def test_repeated_and_null_keys_are_still_dealt_out(spark, tmp_path):
    """The first rows of a date are not compared with others; their keys are looked at before."""
    store = Store(spark, str(tmp_path))
    came = [("x", "1", "2026-05-26"), ("x", "0", "2026-05-26"), (None, "2", "2026-05-26"), ("y", "3", "2026-05-26")]
    silver_step(store, rows(spark, came), SPEC, "b1", AT[0])
    assert [(r[0], r[1]) for r in held(store)] == [("x", "0"), ("y", "3")]
    assert store.read("rejects", "t").filter("_rejected_copies > 0").count() == 2


def test_wide_rows_are_shuffled_without_undelivered_columns(spark):
    """Of 202 wide columns the feeds deliver 30: the others join the rows when these are written."""
    store, _ = layers._two_days(spark, "/root/testdata/sf0.001")
    batch, base = "20260527", DOMAINS["positions"]
    dates = sorted(store.dates("silver", base.name, batch))
    tables = {name: store.read_current("silver", name, batch) for name in DOMAINS}
    frame = wide_frame(tables[base.name], base, tables, DOMAINS, WIDE_JOINS, WIDE_EXCLUDED, AT[1])
    empty = empty_columns(store, base, DOMAINS, WIDE_JOINS, WIDE_EXCLUDED, batch, dates)
    assert len(frame.columns) == 202 and len(empty) > 150 and empty < set(frame.columns)
    left = frame.drop(*empty)._jdf.queryExecution().sparkPlan().toString()
    assert "position_id#" in left and not re.search(r"\b(account_id|isin|duration_macaulay)#", left)
    wide = store.read("gold", WIDE_TABLE)
    assert sorted(wide.columns) == sorted(frame.columns)
    assert not any(wide.agg(*[F.count(c) for c in sorted(empty)]).first())
    assert wide.filter("security_currency IS NOT NULL AND security_created_timestamp IS NOT NULL").count() > 0


def test_rows_of_a_new_date_are_not_merged(spark, tmp_path, monkeypatch):
    """A batch that also corrects an older date merges that one; its new date has nothing to meet."""
    d1, d2 = "2026-05-26", "2026-05-27"
    first = [("x", "1", d1), ("y", "2", d1)]
    second = [("x", "9", d1), ("x", "1", d2), ("z", "3", d2), ("z", "3", d2), (None, "4", d2)]
    seen = []

    def recorded(current, incoming, *args, **options):
        days = {str(r.day) for r in incoming.select("day").distinct().collect()}
        seen.append((sorted(days), options.get("first", False)))
        return merge_current(current, incoming, *args, **options)

    monkeypatch.setattr(silver, "merge_current", recorded)
    store = Store(spark, str(tmp_path))
    silver_step(store, rows(spark, first), SPEC, "b1", AT[0])
    silver_step(store, rows(spark, second), SPEC, "b2", AT[1])
    assert seen[1:] == [([d1], False), ([d2], True)]
    versions = store.read_history("silver", "t").select("k", "day", "a", "_effective_from", "_effective_to")
    assert sorted(((k, str(d), a, f.day, t and t.day) for k, d, a, f, t in versions.collect()), key=str) == sorted([
        ("x", d1, "1", 26, 27), ("x", d1, "9", 27, None), ("y", d1, "2", 26, None),
        ("x", d2, "1", 27, None), ("z", d2, "3", 27, None),
    ], key=str)
    assert store.read_current("silver", "t").count() == 4


def test_stored_hashes_take_half_of_their_text(spark, tmp_path):
    """Files are squeezed, unless the session names a codec of its own."""
    hashes = spark.range(50_000).select(F.md5(F.col("id").cast("string")).alias("h")).coalesce(1)
    write_table(hashes, f"{tmp_path}/usual")
    (file,) = tmp_path.glob("usual/*.parquet")
    assert file.stat().st_size < 50_000 * 24
    spark.conf.set("spark.sql.parquet.compression.codec", "gzip")
    try:
        write_table(hashes, f"{tmp_path}/named")
    finally:
        spark.conf.unset("spark.sql.parquet.compression.codec")
    assert [f.name for f in tmp_path.glob("named/*.gz.parquet")]
    write_table(hashes, f"{tmp_path}/text", fmt="json")
    assert spark.read.json(f"{tmp_path}/text").count() == spark.read.parquet(f"{tmp_path}/usual").count() == 50_000

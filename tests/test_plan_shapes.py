"""Physical plans: how often data moves, what the scans read, what stays out of Python."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

import __spark_entry__  # noqa: F401  (registers the queries)
from siltstone.operators import quality
from siltstone.operators.consolidate import consolidate
from siltstone.operators.denormalize import Dimension, denormalize, hot_keys, left_join_fan_out, left_join_hot_keys
from siltstone.operators.history import merge_current, scd2_merge
from siltstone.sources.store import Store
from workloads.registry import QUERIES

TABLES = "/root/testdata/sf0.01"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def table(spark, name):
    return spark.read.parquet(f"{TABLES}/{name}.parquet")


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    store = Store(spark, str(tmp_path_factory.mktemp("store")))
    orders = table(spark, "orders")
    for batch, day in (("b1", 26), ("b2", 27)):
        at = datetime(2026, 5, day)
        current = None if batch == "b1" else store.read_current("silver", "orders")
        changed = orders.withColumn("o_custkey", F.col("o_custkey") + F.lit(int(batch == "b2")))
        rows = merge_current(current, changed, ["o_orderkey"], at, batch)
        store.write_history(rows, "silver", "orders", batch)
    return store


def test_merge_shuffles_once_and_joins_nothing(spark, stored):
    merged = merge_current(
        stored.read_current("silver", "orders"), table(spark, "orders"), ["o_orderkey"],
        datetime(2026, 5, 28), "b3",
    )
    text = plan(merged)
    assert text.count("Exchange hashpartitioning") == 1
    assert text.count("Sort [") == 1 and "Join" not in text


def test_closed_history_is_not_shuffled(spark, stored):
    existing = stored.read_history("silver", "orders")
    text = plan(scd2_merge(existing, table(spark, "orders"), ["o_orderkey"], datetime(2026, 5, 28), "b3"))
    assert text.count("Exchange hashpartitioning") == 1


def test_current_rows_read_their_own_directories(spark, stored):
    current = stored.read_current("silver", "orders")
    assert {f.split("/orders/")[1].rsplit("/", 1)[0] for f in current.inputFiles()} == {
        "_state_batch=b2/_is_current=true"
    }
    assert "ReadSchema: struct<o_orderkey:bigint>" in plan(current.select("o_orderkey"))
    assert stored.read_current("silver", "orders").count() == 15000
    assert stored.read_history("silver", "orders").count() == 30000


def test_consolidation_limits_each_key_before_the_shuffle(spark):
    lines = table(spark, "lineitem")
    out = consolidate([lines, lines], ["l_orderkey", "l_linenumber"], "l_returnflag", ["R"], ["l_partkey"])
    text = plan(out)
    assert text.count("Exchange") == 1
    before_shuffle = text[text.index("Exchange"):]
    assert "row_number(), 1, Partial" in before_shuffle


def test_wide_table_reads_declared_columns_only(spark):
    orders, customer = table(spark, "orders"), table(spark, "customer")
    wide = denormalize(
        orders, [Dimension("c", customer.withColumnRenamed("c_custkey", "o_custkey"), ("o_custkey",), ("c_name",))],
        ["o_orderkey", "o_custkey"],
    )
    text = plan(wide)
    assert "ReadSchema: struct<c_custkey:bigint,c_name:string>" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in text


def test_checks_share_one_scan_and_read_their_columns(spark):
    lines = table(spark, "lineitem")
    rows = quality.run_checks(lines, [quality.cardinality(), quality.value_range("l_tax", 0, 1),
                                      quality.null_rate(["l_tax"], [])])
    text = plan(rows)
    assert text.count("FileScan") == 1 and "ReadSchema: struct<l_tax:double>" in text
    keys = plan(quality.check_uniqueness(lines, ["l_orderkey"]))
    assert "ReadSchema: struct<l_orderkey:bigint>" in keys and "Expand" not in keys
    orphans = plan(quality.orphan_keys(table(spark, "documents"), table(spark, "labels"), "doc_id"))
    assert "ReadSchema: struct<doc_id:bigint>" in orphans


@pytest.fixture
def small_skew(spark):
    """Settings under which a test table counts as skewed, and nothing is broadcast."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    saved = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in saved.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def hot(spark, rows, column):
    """One key holds a third of the rows."""
    return spark.range(rows).repartition(8).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"),
        F.col("id").alias(column),
    )


def test_hot_dimension_key_is_split_by_the_fan_out_join(spark, small_skew):
    left = spark.range(-1, 3000).repartition(8).select(F.col("id").alias("k"), F.col("id").alias("n"))
    right = hot(spark, 60000, "v")
    joined = left_join_fan_out(left, right, ["k"])
    assert joined.count() == left.join(right, ["k"], "left").count()
    final = joined.groupBy().agg(F.sum("v"), F.sum("n"))
    final.collect()
    text = plan(final)
    assert "SortMergeJoin(skew=true)" in text and "Inner" in text


def test_both_joins_of_a_fan_out_read_one_shuffle_of_the_left_side(spark, small_skew):
    text = plan(left_join_fan_out(table(spark, "orders"), table(spark, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), "l_tax"), ["o_orderkey"]))
    collected = left_join_fan_out(table(spark, "orders"), table(spark, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), "l_tax"), ["o_orderkey"])
    collected.collect()
    assert "ReusedExchange" in text or "ReusedExchange" in plan(collected)


def test_only_hot_dimension_keys_are_joined_apart(spark, small_skew):
    left = spark.range(-1, 3000).repartition(8).select(F.col("id").alias("k"), F.col("id").alias("n"))
    left = left.unionByName(spark.sql("select cast(null as bigint) as k, -5L as n"))
    right = hot(spark, 60000, "v")
    plain = left.join(right, ["k"], "left")
    names = ["k", "n", "v"]
    joined = left_join_hot_keys(left, right, ["k"], 1000)
    assert hot_keys(right, ["k"], 1000) == [left.select(F.xxhash64(F.lit(-1).cast("long"))).first()[0]]
    assert joined.select(*names).exceptAll(plain.select(*names)).count() == 0 and joined.count() == plain.count()
    final = joined.groupBy().agg(F.sum("v"), F.sum("n"))
    final.collect()
    assert "SortMergeJoin(skew=true)" in plan(final) and "Union" in plan(final)
    # Even keys: the plain join, whatever the dimension says.
    even = right.withColumn("k", F.col("v"))
    assert hot_keys(even, ["k"], 1000) == []
    text = plan(denormalize(left, [Dimension("d", even, ("k",), fan_out=True)]))
    assert "Union" not in text.split("Exchange")[0] and text.count("SortMergeJoin") == 1
    # A small key is not hot however large its share.
    assert hot_keys(right, ["k"]) == []


def test_hot_base_key_is_split_by_a_plain_left_join(spark, small_skew):
    base = hot(spark, 60000, "n")
    dim = spark.range(-1, 3000).repartition(8).select(F.col("id").alias("k"), F.col("id").alias("v"))
    wide = denormalize(base, [Dimension("d", dim, ("k",))]).groupBy().agg(F.sum("v"), F.sum("n"))
    wide.collect()
    assert "SortMergeJoin(skew=true)" in plan(wide)


def test_no_query_leaves_the_jvm_or_pairs_everything(spark):
    for name, query in QUERIES.items():
        text = plan(query(spark, "/root/testdata/sf0.001"))
        for word in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert word not in text, f"{name}: {word}"

"""Shuffle files that go when their job ends, and rows that are stored in several turns."""

import os
import time
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from siltstone.plans import gold
from siltstone.plans.silver import silver_step
from siltstone.sources import store as store_module
from siltstone.sources import turns as turns_module
from siltstone.sources.store import Store, write_table
from siltstone.sources.turns import shuffles_released, turns
from siltstone.specs import DomainSpec

DAYS = [date(2026, 5, 26), date(2026, 5, 27)]
AT = [datetime(2026, 5, 26), datetime(2026, 5, 27)]
BASE = DomainSpec(
    name="base",
    key=("id", "day"),
    columns=(("id", "STRING"), ("day", "DATE"), ("sec", "STRING"), ("amount", "DECIMAL(18,2)"), ("note", "STRING")),
    partition="day",
    rejects="quarantine",
)
RISK = DomainSpec(
    name="risk",
    key=("calc",),
    columns=(("calc", "STRING"), ("id", "STRING"), ("day", "DATE"), ("dv01", "DECIMAL(18,2)")),
    partition="day",
    rejects="quarantine",
)
SEC = DomainSpec(name="sec", key=("sec",), columns=(("sec", "STRING"), ("label", "STRING")), rejects="quarantine")
JOINS = (("sec", ("sec",), "left"), ("risk", ("id", "day"), "left"))


@pytest.fixture()
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "warehouse"))


@pytest.fixture()
def wrote(monkeypatch):
    """For every write, whether more rows were to follow."""
    seen, write = [], store_module.write_observed

    def observed(df, path, aggregates, mode="overwrite", fmt="parquet", partition_by=(), empty=(), more=False):
        seen.append((path.split("/warehouse/")[1], more))
        return write(df, path, aggregates, mode, fmt, partition_by, empty, more)

    monkeypatch.setattr(store_module, "write_observed", observed)
    return seen


def shuffle_files(spark):
    """The shuffle files of the session's only process."""
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    tops = [str(top) for top in manager.localDirsString()]
    return {f for top in tops for _, _, names in os.walk(top) for f in names if f.startswith("shuffle_")}


def test_shuffle_files_go_with_their_job(spark, tmp_path):
    before = shuffle_files(spark)
    rows = spark.range(5000).groupBy((F.col("id") % 1000).alias("k")).count()
    assert write_table(rows, str(tmp_path / "counts")) == 1000
    until = time.time() + 20
    while (left := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.1)
    assert not left
    assert spark.read.parquet(str(tmp_path / "counts")).agg(F.sum("count")).first()[0] == 5000


def test_setting_is_taken_back(spark):
    key = turns_module._CLEANUP
    assert spark.conf.get(key, None) is None
    with shuffles_released(spark):
        with ThreadPoolExecutor(max_workers=4) as pool:
            def inside(_):
                with shuffles_released(spark):
                    time.sleep(0.01)
                    return spark.conf.get(key)
            assert set(pool.map(inside, range(20))) == {"true"}
        assert spark.conf.get(key) == "true"
    assert spark.conf.get(key, None) is None
    spark.conf.set(key, "false")
    try:
        with shuffles_released(spark):
            assert spark.conf.get(key) == "false"
        assert spark.conf.get(key) == "false"
    finally:
        spark.conf.unset(key)


def test_batch_counts_after_its_last_turn(spark, store):
    good = spark.range(10).withColumn("day", F.lit(DAYS[0]))
    bad = good.withColumn("id", F.when(F.col("id") < 99, F.raise_error(F.lit("stop")).cast("long")))
    assert store.write_dated([good, good], "gold", "t", "20260526", "day") == 20
    assert store.read("gold", "t").count() == 20
    # The list of the first run is still there; the rows are not.
    with pytest.raises(Exception, match="stop"):
        store.write_dated([good, bad], "gold", "t", "20260526", "day")
    assert store.batches("gold", "t") == []
    assert store.write_dated([good], "gold", "t", "20260526", "day") == 10
    assert store.read("gold", "t").count() == 10


def base_rows(spark, day, numbers, extra=0):
    rows = spark.createDataFrame([(i,) for i in numbers], "n long")
    return rows.select(
        F.concat(F.lit("P"), "n").alias("id"), F.lit(DAYS[day]).alias("day"),
        F.concat(F.lit("S"), F.col("n") % 7).alias("sec"), (F.col("n") + extra).alias("amount"),
    )


def two_batches(spark, store):
    """Two dates; the second batch also corrects, repeats and adds rows of the first."""
    silver_step(store, base_rows(spark, 0, range(200)), BASE, "20260526", AT[0])
    again = base_rows(spark, 0, range(50), extra=5).unionByName(base_rows(spark, 0, range(50, 80)))
    again = again.unionByName(base_rows(spark, 0, range(200, 220)))
    silver_step(store, again.unionByName(base_rows(spark, 1, range(150))), BASE, "20260527", AT[1])


def rows_of(frame):
    return sorted(map(repr, (tuple(row) for row in frame.select(*sorted(frame.columns)).collect())))


def test_history_is_merged_in_turns(spark, tmp_path, monkeypatch, wrote):
    whole, parts = Store(spark, str(tmp_path / "a/warehouse")), Store(spark, str(tmp_path / "b/warehouse"))
    two_batches(spark, whole)
    assert not any(more for _, more in wrote)
    held = whole.current_bytes("silver", "base", "20260526", DAYS[:1])
    monkeypatch.setattr(turns_module, "TURN_BYTES", held // 3 + 1)
    wrote.clear()
    two_batches(spark, parts)
    assert [more for path, more in wrote if path == "silver/base/_state_batch=20260527"] == [True, True, False]
    assert rows_of(parts.read_history("silver", "base")) == rows_of(whole.read_history("silver", "base"))
    assert whole.read_history("silver", "base").filter("NOT _is_current").count() == 50
    assert parts.read_current("silver", "base").count() == 370


def test_repeated_key_fails_in_any_turn(spark, store, monkeypatch):
    spec = DomainSpec(name="base", key=BASE.key, columns=BASE.columns, partition="day")
    silver_step(store, base_rows(spark, 0, range(50)), spec, "20260526", AT[0])
    monkeypatch.setattr(turns_module, "TURN_BYTES", store.current_bytes("silver", "base", "20260526") // 3 + 1)
    twice = base_rows(spark, 0, [*range(20), 7])
    with pytest.raises(Exception, match="duplicate key"):
        silver_step(store, twice, spec, "20260527", AT[1])
    assert store.batches("silver", "base") == ["20260526"]


def test_wide_table_is_built_in_turns(spark, store, monkeypatch, wrote):
    two_batches(spark, store)
    risk = [(f"R{i}-{day}", f"P{i}", DAYS[day], i) for day in (0, 1) for i in range(0, 200, 2)]
    risk += [("again", "P4", DAYS[0], 1), ("none", None, DAYS[0], 1)]
    risk = spark.createDataFrame(risk, "calc string, id string, day date, dv01 long")
    silver_step(store, risk, RISK, "20260527", AT[1])
    names = spark.createDataFrame([(f"S{i}", f"name {i}") for i in range(5)], "sec string, label string")
    silver_step(store, names, SEC, "20260527", AT[1])
    domains = {"base": BASE, "risk": RISK, "sec": SEC}
    dates = [str(day) for day in DAYS]

    def build(table):
        return gold.build_dates(store, BASE, domains, JOINS, {}, "20260527", AT[1], table, dates)

    assert build("whole") == 371
    sizes = [sum(store.current_bytes("silver", x, "20260527", [day]) for x in ("base", "risk")) for day in dates]
    for table, most, shares in (("by_share", min(sizes) // 2 + 1, 4), ("by_date", max(sizes), 2)):
        monkeypatch.setattr(turns_module, "TURN_BYTES", most)
        found = gold.turns_of_dates(store, BASE, domains, JOINS, "20260527", dates)
        assert [day for some, number, _ in found if number == 0 for day in some] == dates
        assert len(found) >= shares
        wrote.clear()
        assert build(table) == 371
        flags = [more for path, more in wrote if path == f"gold/{table}/_state_batch=20260527"]
        assert flags == [True] * (len(found) - 1) + [False]
        assert rows_of(store.read("gold", table)) == rows_of(store.read("gold", "whole"))
    # A right join would give a dimension's unmatched rows in every turn, so it is left whole.
    right = (("sec", ("sec",), "right"), JOINS[1])
    assert gold.turns_of_dates(store, BASE, domains, right, "20260527", dates) == [(dates, 0, 1)]


def test_number_of_turns(monkeypatch):
    monkeypatch.setattr(turns_module, "TURN_BYTES", 100)
    assert [turns(x) for x in (0, 1, 100, 101, 1000)] == [1, 1, 1, 2, 10]

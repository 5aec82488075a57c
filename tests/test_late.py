"""Late deliveries and rows as they were, against plain models."""

import itertools
import random
from datetime import datetime, timedelta

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from siltstone.operators.history import scd2_merge, scd2_merge_all
from siltstone.operators.late import scd2_splice
from siltstone.operators.moments import as_of_each, at_own_time, wide_as_of

START = datetime(2026, 5, 1)
SCHEMA = "k int, a string, b string"
COLUMNS = ["k", "a", "b", "_record_hash", "_effective_from", "_effective_to", "_is_current", "_batch_id"]


def rows(table):
    return sorted((tuple(r) for r in table.select(*COLUMNS).collect()), key=repr)


def deliveries(spark, seed, days, keys=6):
    rng = random.Random(seed)
    out = []
    for day in range(days):
        held = [(k, rng.choice("xyz"), rng.choice(["p", None])) for k in range(keys) if rng.random() < 0.6]
        out.append((spark.createDataFrame(held, SCHEMA), START + timedelta(days=day), f"b{day}"))
    return out


def in_order_of_arrival(given):
    """Merge what is newest, splice what is late."""
    table, done = None, []
    for frame, at, batch in given:
        if table is None:
            table = scd2_merge(None, frame, ["k"], at, batch)
        elif at > max(x[1] for x in done):
            table = scd2_merge(table, frame, ["k"], at, batch)
        else:
            later = [x for x in done if x[1] > at]
            table = scd2_splice(table, frame, ["k"], at, batch, later)
        done.append((frame, at, batch))
    return table


@pytest.mark.parametrize("seed", range(3))
def test_any_order_of_three_deliveries_gives_the_sorted_history(spark, seed):
    given = deliveries(spark, seed, 3)
    wanted = rows(scd2_merge_all(None, given, ["k"]))
    for order in itertools.permutations(given):
        assert rows(in_order_of_arrival(order)) == wanted


def test_a_long_shuffled_row_of_deliveries(spark, tmp_path):
    given = deliveries(spark, 17, 6, keys=25)
    wanted = rows(scd2_merge_all(None, given, ["k"]))
    for seed in (1, 2):
        order = random.Random(seed).sample(given, len(given))
        assert rows(in_order_of_arrival(order)) == wanted


def history(spark, *days):
    given = [(spark.createDataFrame(r, SCHEMA), START + timedelta(days=d), f"b{d}") for d, r in days]
    return scd2_merge_all(None, given, ["k"]), given


def test_split_shorten_begin_earlier_and_reopen(spark):
    table, given = history(spark, (0, [(1, "x", "p"), (2, "x", "p"), (3, "x", "p")]), (4, [(1, "x", "p"), (2, "z", "p"), (4, "n", "p")]))
    late = spark.createDataFrame([(1, "y", "p"), (2, "z", "p"), (4, "n", "p"), (5, "q", "p")], SCHEMA)
    out = scd2_splice(table, late, ["k"], START + timedelta(days=2), "late", given[1:])
    day = lambda d: None if d is None else START + timedelta(days=d)
    found = sorted(((r.k, r.a, r._effective_from, r._effective_to, r._batch_id) for r in out.collect()), key=repr)
    assert found == sorted([
        (1, "x", day(0), day(2), "b0"), (1, "y", day(2), day(4), "late"), (1, "x", day(4), None, "b4"),
        (2, "x", day(0), day(2), "b0"), (2, "z", day(2), None, "late"),
        (3, "x", day(0), None, "b0"),
        (4, "n", day(2), None, "late"), (5, "q", day(2), None, "late"),
    ], key=repr)


def test_older_than_everything_and_columns_that_were_added(spark):
    table, given = history(spark, (2, [(1, "x", "p")]))
    late = spark.createDataFrame([(1, "w", "p", 5), (2, "w", "p", 6)], SCHEMA + ", c int")
    out = scd2_splice(table, late, ["k"], START, "late", given)
    assert sorted((r.k, r.a, r.c, r._is_current) for r in out.collect()) == [
        (1, "w", 5, False), (1, "x", None, True), (2, "w", 6, True),
    ]


def test_late_guards(spark):
    table, given = history(spark, (0, [(1, "x", "p")]), (2, [(1, "y", "p")]))
    at = START + timedelta(days=1)

    def splice(data, instant=at, existing=table):
        scd2_splice(existing, spark.createDataFrame(data, SCHEMA), ["k"], instant, "late", given[1:]).collect()

    for data, instant, message in (
        ([(1, "a", "p"), (1, "b", "p")], at, "duplicate key"),
        ([(None, "a", "p")], at, "NULL in key"),
        ([(1, "a", "p")], START, "same instant"),
    ):
        with pytest.raises(PySparkException, match=message):
            splice(data, instant)
    closed = scd2_merge(table, spark.createDataFrame([(9, "x", "p")], SCHEMA), ["k"], START + timedelta(days=3), "b3", absent="close")
    with pytest.raises(PySparkException, match="was closed"):
        splice([(1, "a", "p")], existing=closed)
    with pytest.raises(ValueError, match="types differ"):
        scd2_splice(table, spark.createDataFrame([(1, 5)], "k int, a int"), ["k"], at, "late")


def test_splice_shuffles_once(spark):
    table, given = history(spark, (0, [(1, "x", "p")]), (2, [(1, "y", "p")]))
    stored = spark.createDataFrame(table.collect(), table.schema)
    late = spark.createDataFrame([(1, "a", "p")], SCHEMA)
    text = scd2_splice(stored, late, ["k"], START + timedelta(days=1), "l", given[1:])._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1 and "Join" not in text


def _random_versions(rng, keys, span):
    out = []
    for k in range(keys):
        cuts = sorted(rng.sample(range(span), rng.randint(1, 6)))
        for since, until in zip(cuts, [*cuts[1:], None if rng.random() < 0.7 else span + 5]):
            out.append((k, f"v{k}-{since}", START + timedelta(minutes=since), None if until is None else START + timedelta(minutes=until)))
    return out


@pytest.mark.parametrize("hours", [1, 24, 500])
def test_own_time_equals_a_plain_search(spark, hours):
    rng = random.Random(3)
    stored = _random_versions(rng, 12, 6000)
    asked = [(i, rng.choice([*range(14), None]), None if rng.random() < 0.05 else START + timedelta(minutes=rng.randint(-500, 7000)))
             for i in range(300)]
    # Instants that are exactly a beginning or an end.
    asked += [(1000 + i, k, x) for i, (k, _, a, b) in enumerate(stored) for x in (a, b) if x]
    versions = spark.createDataFrame(stored, "k int, name string, _effective_from timestamp, _effective_to timestamp")
    frame = spark.createDataFrame(asked, "id int, k int, t timestamp")
    found = sorted((tuple(r) for r in at_own_time(frame, "t", versions, ["k"], ["name"], hours=hours).collect()), key=repr)
    wanted = []
    for i, k, t in asked:
        valid = [n for kk, n, a, b in stored if kk == k and t is not None and a <= t and (b is None or b > t)]
        wanted += [(i, k, t, n) for n in valid or [None]]
    assert found == sorted(wanted, key=repr)


def test_own_time_edges(spark):
    versions = spark.createDataFrame([], "k int, name string, _effective_from timestamp, _effective_to timestamp")
    frame = spark.createDataFrame([(1, 1, START), (2, None, None)], "id int, k int, t timestamp")
    assert at_own_time(frame, "t", versions, ["k"], ["name"]).filter("name is null").count() == 2
    assert at_own_time(frame.limit(0), "t", versions, ["k"], ["name"]).count() == 0
    with pytest.raises(ValueError, match="both sides"):
        at_own_time(frame.withColumn("name", F.lit(1)), "t", versions, ["k"], ["name"])
    with pytest.raises(ValueError, match="missing"):
        at_own_time(frame, "nope", versions, ["k"], ["name"])
    with pytest.raises(ValueError, match="no instant"):
        as_of_each(versions, [])


def test_wide_rows_as_they_were(spark):
    base, _ = history(spark, (0, [(1, "x", "p"), (2, "x", "q")]), (2, [(1, "y", "p")]))
    names = [("p", "old", START, START + timedelta(days=1)), ("p", "new", START + timedelta(days=1), None)]
    dimension = spark.createDataFrame(names, "b string, a string, _effective_from timestamp, _effective_to timestamp")
    noon = [START + timedelta(days=d, hours=12) for d in (-1, 0, 1, 2)]
    wide = wide_as_of(base, ["k", "a", "b"], [("d", dimension, ["b"], ["a"])], noon)
    assert sorted((r._as_of, r.k, r.a, r.d_a) for r in wide.select("_as_of", "k", "a", F.coalesce("d_a", F.lit("-")).alias("d_a")).collect()) == [
        (noon[1], 1, "x", "old"), (noon[1], 2, "x", "-"), (noon[2], 1, "x", "new"), (noon[2], 2, "x", "-"),
        (noon[3], 1, "y", "new"), (noon[3], 2, "x", "-"),
    ]
    text = wide._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("asked", [1, 5, 70])
def test_wide_rows_at_many_instants_equal_a_plain_search(spark, asked):
    rng = random.Random(asked)
    rows = [(i, rng.choice([*range(10), None]), START + timedelta(minutes=rng.randint(0, 3000)),
             START + timedelta(minutes=rng.randint(3000, 6500)) if rng.random() < 0.5 else None) for i in range(60)]
    stored = _random_versions(rng, 8, 6000)
    # Versions that overlap, and keys and beginnings that are NULL.
    stored += [(3, "again", START, None), (None, "no key", START, None), (4, "no beginning", None, None)]
    base = spark.createDataFrame(rows, "id int, k int, _effective_from timestamp, _effective_to timestamp")
    names = spark.createDataFrame(stored, "k int, name string, _effective_from timestamp, _effective_to timestamp")
    instants = [START + timedelta(minutes=rng.randint(-100, 7000)) for _ in range(asked)]
    wide = wide_as_of(base, ["id", "k"], [("d", names, ["k"], ["name"]), ("e", names, ["k"], ["name"])], instants)
    assert wide.columns == ["_as_of", "id", "k", "name", "e_name"]

    def valid(t, since, until):
        return since is not None and since <= t and (until is None or until > t)

    wanted = []
    for t in instants:
        for i, k, since, until in rows:
            if valid(t, since, until):
                found = [n for kk, n, a, b in stored if k is not None and kk == k and valid(t, a, b)] or [None]
                wanted += [(t, i, k, n, m) for n in found for m in found]
    assert sorted((tuple(r) for r in wide.collect()), key=repr) == sorted(wanted, key=repr)


def test_rows_are_repeated_by_instant_after_the_joins(spark):
    base, _ = history(spark, (0, [(1, "x", "p"), (2, "x", "q")]))
    names = spark.createDataFrame([("p", "old", START, None)], "b string, n string, _effective_from timestamp, _effective_to timestamp")
    noon = [START + timedelta(days=d, hours=12) for d in range(3)]
    text = wide_as_of(base, ["k", "b"], [("d", names, ["b"], ["n"])], noon)._jdf.queryExecution().optimizedPlan().toString()
    assert 0 <= text.index("explode") < text.index("Join LeftOuter")

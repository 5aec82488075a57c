"""Type-2 history over three daily deliveries of the orders."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.functions.hashing import record_hash
from siltstone.operators.evolve import evolve
from siltstone.operators.history import as_of, closed_rows, current_rows, merge_current, scd2_merge, scd2_merge_all
from siltstone.operators.late import scd2_splice
from siltstone.operators.moments import at_own_time
from siltstone.operators.project import snapshot
from workloads.consolidation import ORDER_COLUMNS, order_columns
from workloads.registry import DAY1, DAY2, DAY3, register, table

KEY = ["o_orderkey"]
_BUSINESS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"

# Urgent orders are first delivered on day 2, low ones no longer from day 2 to 3; the
# price of partial orders changes on day 2, and of open ones on day 3.
_HASH = """md5(concat_ws('||', CAST(o_custkey AS VARCHAR), CAST(o_orderdate AS VARCHAR),
    CAST(o_orderkey AS VARCHAR), o_orderpriority, o_orderstatus, CAST(o_totalprice AS VARCHAR)))"""
_DAYS = f"""
base AS (SELECT {ORDER_COLUMNS} FROM orders),
d1 AS (SELECT * FROM base WHERE o_orderpriority <> '1-URGENT'),
d2 AS (SELECT o_orderkey, o_custkey, o_orderstatus,
         CAST(CASE WHEN o_orderstatus = 'P' THEN o_totalprice + 1 ELSE o_totalprice END
              AS DECIMAL(18,2)) AS o_totalprice, o_orderdate, o_orderpriority
       FROM base WHERE o_orderpriority <> '5-LOW'),
d3 AS (SELECT o_orderkey, o_custkey, o_orderstatus,
         CAST(CASE WHEN o_orderstatus = 'P' THEN o_totalprice + 1
                   WHEN o_orderstatus = 'O' THEN o_totalprice + 2 ELSE o_totalprice END
              AS DECIMAL(18,2)) AS o_totalprice, o_orderdate, o_orderpriority
       FROM base)"""
_TIME = {1: "2026-05-26", 2: "2026-05-27", 3: "2026-05-28"}


def _versions(*days: int) -> str:
    """History in SQL: a version starts where the hash differs from the last delivery's."""
    deliveries = " UNION ALL ".join(
        f"SELECT *, {_HASH} AS h, TIMESTAMP '{_TIME[d]} 00:00:00' AS seen_at, 'b{d}' AS b FROM d{d}"
        for d in days
    )
    return f"""{_DAYS},
deliveries AS ({deliveries}),
seen AS (SELECT *, lag(h) OVER (PARTITION BY o_orderkey ORDER BY seen_at) AS earlier FROM deliveries),
starts AS (SELECT * FROM seen WHERE earlier IS NULL OR earlier <> h),
versions AS (SELECT {_BUSINESS}, h AS _record_hash, seen_at AS _effective_from,
    lead(seen_at) OVER (PARTITION BY o_orderkey ORDER BY seen_at) AS _effective_to,
    lead(seen_at) OVER (PARTITION BY o_orderkey ORDER BY seen_at) IS NULL AS _is_current,
    b AS _batch_id FROM starts)"""


def delivery(orders, day: int):
    base = order_columns(orders)
    price = F.col("o_totalprice")
    if day == 1:
        return base.filter("o_orderpriority <> '1-URGENT'")
    raised = F.when(F.col("o_orderstatus") == "P", price + 1)
    if day == 3:
        raised = raised.when(F.col("o_orderstatus") == "O", price + 2)
    base = base.withColumn("o_totalprice", raised.otherwise(price).cast("decimal(18,2)"))
    return base.filter("o_orderpriority <> '5-LOW'") if day == 2 else base


_AT = {1: DAY1, 2: DAY2, 3: DAY3}


def history(orders, *days: int, **options):
    """The history table after the given days, merged together."""
    deliveries = [(delivery(orders, day), _AT[day], f"b{day}") for day in days]
    return scd2_merge_all(None, deliveries, KEY, **{"hash_encoding": "delimited", **options})


@register(f"WITH {_versions(1)} SELECT * FROM versions")
def scd2_initial(spark, directory):
    return history(table(spark, directory, "orders"), 1)


@register(f"WITH {_versions(1, 2)} SELECT * FROM versions")
def scd2_merge_orders(spark, directory):
    orders = table(spark, directory, "orders")
    return scd2_merge(
        history(orders, 1), delivery(orders, 2), KEY, DAY2, "b2", hash_encoding="delimited"
    )


@register(f"WITH {_versions(1, 2, 3)} SELECT * FROM versions")
def scd2_three_days(spark, directory):
    return history(table(spark, directory, "orders"), 1, 2, 3)


@register(f"WITH {_versions(1, 2)} SELECT * FROM versions")
def scd2_rerun(spark, directory):
    """The same delivery again, under another batch name and later: nothing changes."""
    orders = table(spark, directory, "orders")
    deliveries = [(delivery(orders, day), _AT[day], f"b{day}") for day in (1, 2)]
    deliveries.append((delivery(orders, 2), DAY3, "again"))
    return scd2_merge_all(None, deliveries, KEY, hash_encoding="delimited")


@register(f"""WITH {_versions(1, 2)}
SELECT {_BUSINESS}, _record_hash, _effective_from,
  CASE WHEN v._is_current AND o_orderkey NOT IN (SELECT o_orderkey FROM d2)
       THEN TIMESTAMP '2026-05-27 00:00:00' ELSE _effective_to END AS _effective_to,
  v._is_current AND o_orderkey IN (SELECT o_orderkey FROM d2) AS _is_current, _batch_id
FROM versions v""")
def scd2_close_absent(spark, directory):
    """A full delivery: what it does not mention is closed."""
    return history(table(spark, directory, "orders"), 1, 2, absent="close")


@register(f"WITH {_versions(1, 2, 3)} SELECT * FROM versions WHERE _is_current")
def scd2_current(spark, directory):
    return current_rows(history(table(spark, directory, "orders"), 1, 2, 3))


@register(f"WITH {_versions(1, 2, 3)} SELECT * FROM versions WHERE NOT _is_current")
def scd2_history(spark, directory):
    return closed_rows(history(table(spark, directory, "orders"), 1, 2, 3))


@register(f"""WITH {_versions(1, 2, 3)} SELECT * FROM versions
WHERE _effective_from <= TIMESTAMP '2026-05-27 12:00:00'
  AND (_effective_to IS NULL OR _effective_to > TIMESTAMP '2026-05-27 12:00:00')""")
def scd2_as_of_instant(spark, directory):
    orders = table(spark, directory, "orders")
    return as_of(history(orders, 1, 2, 3), DAY2.replace(hour=12))


@register(f"""WITH {_versions(1)}
SELECT *, CAST(NULL AS DECIMAL(12,6)) AS o_fx_rate, CAST(NULL AS VARCHAR) AS o_channel
FROM versions""")
def scd2_evolved(spark, directory):
    """Columns are added between two deliveries of the same rows: no row is re-versioned."""
    orders = table(spark, directory, "orders")
    wider = T.StructType(
        [T.StructField("o_fx_rate", T.DecimalType(12, 6)), T.StructField("o_channel", T.StringType())]
    )
    before = scd2_merge(None, delivery(orders, 1), KEY, DAY1, "b1")
    after = scd2_merge(evolve(before, wider), evolve(delivery(orders, 1), wider), KEY, DAY2, "b2")
    return after.withColumn("_record_hash", record_hash(after.select(*_BUSINESS.split(", ")),
                                                        encoding="delimited"))


@register("""
SELECT event_id, ts, user_id, event_type, md5(to_json({
  'event_id': CAST(event_id AS VARCHAR), 'event_type': event_type, 'props': props,
  'ts': CAST(ts AS VARCHAR), 'user_id': CAST(user_id AS VARCHAR),
  'value': CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR)})) AS _record_hash
FROM events""")
def record_hash_json(spark, directory):
    events = table(spark, directory, "events").withColumn(
        "value", F.col("value").cast("decimal(18,2)")
    )
    return events.select("event_id", "ts", "user_id", "event_type",
                         record_hash(events).alias("_record_hash"))


@register("""
SELECT l_orderkey, l_linenumber, l_shipdate, md5(concat_ws('||',
  coalesce(CAST(l_linenumber AS VARCHAR), '__NULL__'),
  coalesce(CAST(CASE WHEN l_linestatus = 'O' THEN l_orderkey END AS VARCHAR), '__NULL__'),
  coalesce(l_returnflag, '__NULL__'), coalesce(CAST(l_shipdate AS VARCHAR), '__NULL__')
  )) AS _record_hash
FROM lineitem""")
def record_hash_delimited(spark, directory):
    """NULLs are marked, excluded columns take no part."""
    lines = table(spark, directory, "lineitem")
    masked = lines.select(
        "l_linenumber", "l_returnflag", "l_shipdate", F.col("l_orderkey").alias("order"),
        F.when(F.col("l_linestatus") == "O", F.col("l_orderkey")).alias("l_open_order"),
    )
    hashed = record_hash(masked, exclude=["order"], encoding="delimited")
    return masked.select(F.col("order").alias("l_orderkey"), "l_linenumber", "l_shipdate",
                         hashed.alias("_record_hash"))


@register("""
SELECT * FROM orders WHERE o_orderdate = TIMESTAMP '1995-06-19 00:00:00'""")
def snapshot_as_of(spark, directory):
    """One business date; the predicate reaches the scan."""
    return snapshot(table(spark, directory, "orders"), datetime(1995, 6, 19), "o_orderdate")


@register(f"""WITH {_versions(1, 2)} SELECT * FROM versions
WHERE _is_current OR _effective_to = TIMESTAMP '2026-05-27 00:00:00'""")
def scd2_batch_output(spark, directory):
    """What one batch stores: the current versions and the ones it closed."""
    orders = table(spark, directory, "orders")
    before = current_rows(history(orders, 1))
    return merge_current(before, delivery(orders, 2), KEY, DAY2, "b2", hash_encoding="delimited")


@register(f"WITH {_versions(1, 2, 3)} SELECT * FROM versions")
def scd2_late_delivery(spark, directory):
    """Day 2 arrives after day 3: the history is that of the three days in order."""
    orders = table(spark, directory, "orders")
    late = [(delivery(orders, day), _AT[day], f"b{day}") for day in (1, 3)]
    before = scd2_merge_all(None, late, KEY, hash_encoding="delimited")
    return scd2_splice(
        before, delivery(orders, 2), KEY, DAY2, "b2", late[1:], hash_encoding="delimited"
    )


# A user's event of a type begins a version of the user; it lasts until the next such event.
_STAGES = """
SELECT user_id, event_type AS stage, value AS stage_value, ts AS _effective_from,
  lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS _effective_to
FROM events WHERE event_id % 3 = 0"""


@register(f"""
SELECT e.event_id, e.user_id, e.ts, s.stage, s.stage_value
FROM events e LEFT JOIN ({_STAGES}) s ON s.user_id = e.user_id
  AND s._effective_from <= e.ts AND (s._effective_to IS NULL OR s._effective_to > e.ts)
WHERE e.event_id % 3 <> 0""")
def versions_at_own_time(spark, directory):
    """Every other event with its user's stage at the event's own time."""
    events = table(spark, directory, "events")
    stages = spark.sql(_STAGES.replace("FROM events", "FROM {events}"), events=events)
    rows = events.filter("event_id % 3 <> 0").select("event_id", "user_id", "ts")
    return at_own_time(rows, "ts", stages, ["user_id"], ["stage", "stage_value"])

"""Consolidation: several feeds of the same records, one row per key."""

from __future__ import annotations

from pyspark.sql import functions as F

from siltstone.operators.consolidate import consolidate
from siltstone.plans.bronze import ingest, without_metadata
from workloads.registry import DAY1, register, table

ORDER_COLUMNS = (
    "o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice, "
    "o_orderdate, o_orderpriority"
)

# The desk settles its own orders and never sees partial ones; the ledger has all of
# them, at its own price.
_DESK = f"SELECT {ORDER_COLUMNS}, 'desk' AS source_system FROM orders WHERE o_orderstatus <> 'P'"
_LEDGER = """SELECT o_orderkey, o_custkey, o_orderstatus,
    CAST(CAST(o_totalprice AS DECIMAL(18,2)) + 5 AS DECIMAL(18,2)) AS o_totalprice,
    o_orderdate, o_orderpriority, 'ledger' AS source_system FROM orders"""
_ARCHIVE = f"""SELECT {ORDER_COLUMNS}, 'archive' AS source_system
    FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority = '1-URGENT'"""


def order_columns(orders):
    return orders.withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(18,2)"))


def desk_feed(orders):
    return order_columns(orders).filter("o_orderstatus <> 'P'").withColumn(
        "source_system", F.lit("desk")
    )


def ledger_feed(orders):
    raised = (F.col("o_totalprice") + 5).cast("decimal(18,2)")
    return order_columns(orders).withColumn("o_totalprice", raised).withColumn(
        "source_system", F.lit("ledger")
    )


@register(f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
       source_system
FROM (SELECT *, row_number() OVER (PARTITION BY o_orderkey
        ORDER BY CASE source_system WHEN 'desk' THEN 1 ELSE 2 END, o_totalprice) AS rn
      FROM (SELECT * FROM ({_DESK}) UNION ALL SELECT * FROM ({_LEDGER})))
WHERE rn = 1""")
def consolidate_orders(spark, directory):
    orders = table(spark, directory, "orders")
    return consolidate(
        [desk_feed(orders), ledger_feed(orders)],
        ["o_orderkey"], "source_system", ["desk", "ledger"], ["o_totalprice"],
    )


@register(f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
       source_system
FROM (SELECT *, row_number() OVER (PARTITION BY o_orderkey
        ORDER BY CASE source_system WHEN 'desk' THEN 1 ELSE 2 END, o_totalprice) AS rn
      FROM (SELECT * FROM ({_DESK})
            UNION ALL
            SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
                   NULL AS o_orderpriority, source_system FROM ({_LEDGER})))
WHERE rn = 1""")
def consolidate_missing_cols(spark, directory):
    orders = table(spark, directory, "orders")
    return consolidate(
        [desk_feed(orders), ledger_feed(orders).drop("o_orderpriority")],
        ["o_orderkey"], "source_system", ["desk", "ledger"], ["o_totalprice"],
    )


@register(f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
       source_system
FROM (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY
        CASE source_system WHEN 'archive' THEN 1 WHEN 'desk' THEN 2 ELSE 3 END, o_totalprice) AS rn
      FROM (SELECT * FROM ({_DESK}) UNION ALL SELECT * FROM ({_LEDGER})
            UNION ALL SELECT * FROM ({_ARCHIVE})))
WHERE rn = 1""")
def consolidate_three_feeds(spark, directory):
    orders = table(spark, directory, "orders")
    archive = order_columns(orders).filter(
        "o_orderstatus = 'P' AND o_orderpriority = '1-URGENT'"
    ).withColumn("source_system", F.lit("archive"))
    return consolidate(
        [desk_feed(orders), ledger_feed(orders), archive],
        ["o_orderkey"], "source_system", ["archive", "desk"], ["o_totalprice"],
    )


_TIE_COLUMNS = (
    "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
    "l_tax", "l_returnflag", "l_linestatus",
)


@register(f"""
SELECT l_orderkey, l_linenumber, {", ".join(_TIE_COLUMNS)}
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN 2 ELSE 3 END,
                 {", ".join(_TIE_COLUMNS)}) AS rn FROM lineitem)
WHERE rn = 1""")
def consolidate_ties(spark, directory):
    """Many rows per key and source: the tiebreak columns decide."""
    lines = table(spark, directory, "lineitem")
    kept = consolidate(
        [lines], ["l_orderkey", "l_linenumber"], "l_returnflag", ["R", "A"], _TIE_COLUMNS
    )
    return kept.select("l_orderkey", "l_linenumber", *_TIE_COLUMNS)


@register("""
SELECT l_returnflag, l_linestatus, l_orderkey, l_linenumber, l_shipdate, l_partkey, l_extendedprice
FROM (SELECT *, row_number() OVER (PARTITION BY l_returnflag, l_linestatus
        ORDER BY CASE l_returnflag WHEN 'R' THEN 1 ELSE 2 END, l_extendedprice DESC,
                 l_orderkey, l_linenumber, l_partkey, l_shipdate) AS rn FROM lineitem)
WHERE rn = 1""")
def consolidate_hot_keys(spark, directory):
    """Six keys for the whole table: each holds a sixth of all rows."""
    lines = table(spark, directory, "lineitem")
    kept = consolidate(
        [lines], ["l_returnflag", "l_linestatus"], "l_returnflag", ["R"],
        [F.desc("l_extendedprice"), "l_orderkey", "l_linenumber", "l_partkey", "l_shipdate"],
    )
    return kept.select("l_returnflag", "l_linestatus", "l_orderkey", "l_linenumber",
                       "l_shipdate", "l_partkey", "l_extendedprice")


@register(f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
       source_system, source_system AS _source_system,
       TIMESTAMP '2026-05-26 00:00:00' AS _ingestion_timestamp
FROM (SELECT *, row_number() OVER (PARTITION BY o_orderkey
        ORDER BY CASE source_system WHEN 'desk' THEN 1 ELSE 2 END, o_totalprice) AS rn
      FROM (SELECT * FROM ({_DESK}) UNION ALL SELECT * FROM ({_LEDGER})))
WHERE rn = 1""")
def bronze_ingest(spark, directory):
    """A feed without data is skipped; the others are consolidated by priority."""
    orders = table(spark, directory, "orders")

    def nothing():
        raise FileNotFoundError("no delivery today")

    feeds = {
        "desk": lambda: desk_feed(orders),
        "archive": nothing,
        "ledger": lambda: ledger_feed(orders),
    }
    return ingest(feeds, DAY1, key=["o_orderkey"], priority=["desk", "archive", "ledger"],
                  tiebreak=["o_totalprice"])


@register(f"""
SELECT * FROM ({_DESK}) UNION ALL SELECT * FROM ({_LEDGER})""")
def bronze_union(spark, directory):
    """Without a priority nothing is dropped."""
    orders = table(spark, directory, "orders")
    feeds = {"desk": lambda: desk_feed(orders), "ledger": lambda: ledger_feed(orders)}
    return without_metadata(ingest(feeds, DAY1))

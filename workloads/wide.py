"""The wide table: left joins that keep every base row, and their awkward cases."""

from __future__ import annotations

from pyspark.sql import functions as F

from siltstone.operators.denormalize import Dimension, denormalize, left_join_fan_out, left_join_hot_keys
from workloads.registry import DAY2, register, table

_ORDER = "o.o_orderkey, o.o_custkey, o.o_orderstatus, o.o_totalprice, o.o_orderdate, o.o_orderpriority"


@register(f"""
SELECT {_ORDER}, c.c_name, c.c_mktsegment, c.c_acctbal AS customer_o_totalprice,
       TIMESTAMP '2026-05-27 00:00:00' AS _pipeline_timestamp
FROM orders o LEFT JOIN (SELECT * FROM customer WHERE c_mktsegment <> 'MACHINERY') c
  ON o.o_custkey = c.c_custkey""")
def gold_left_single(spark, directory):
    """A dimension column named like a base column gets the dimension's prefix."""
    customers = table(spark, directory, "customer").filter("c_mktsegment <> 'MACHINERY'")
    dimension = customers.selectExpr(
        "c_custkey AS o_custkey", "c_name", "c_mktsegment", "c_acctbal AS o_totalprice",
        "c_nationkey AS undeclared",
    )
    columns = ("c_name", "c_mktsegment", "o_totalprice")
    return denormalize(
        table(spark, directory, "orders"),
        [Dimension("customer", dimension, ("o_custkey",), columns)],
        run_ts=DAY2,
    )


@register(f"""
SELECT {_ORDER}, r.score, r.risk_o_orderstatus
FROM orders o LEFT JOIN (
  SELECT o_orderkey, o_orderdate, CAST(o_totalprice * 2 AS DECIMAL(18,2)) AS score,
         o_orderstatus AS risk_o_orderstatus FROM orders WHERE o_orderpriority <> '5-LOW') r
  ON o.o_orderkey = r.o_orderkey AND o.o_orderdate = r.o_orderdate""")
def gold_left_composite(spark, directory):
    orders = table(spark, directory, "orders")
    risk = orders.filter("o_orderpriority <> '5-LOW'").selectExpr(
        "o_orderkey", "o_orderdate", "CAST(o_totalprice * 2 AS DECIMAL(18,2)) AS score",
        "o_orderstatus",
    )
    return denormalize(orders, [Dimension("risk", risk, ("o_orderkey", "o_orderdate"))])


_FAN_OUT = f"""
SELECT {_ORDER}, l.l_linenumber, l.l_quantity, l.l_shipdate
FROM orders o LEFT JOIN lineitem l ON o.o_orderkey = l.l_orderkey"""


def _lines(spark, directory):
    return table(spark, directory, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_quantity", "l_shipdate"
    )


@register(_FAN_OUT)
def gold_fanout(spark, directory):
    return denormalize(
        table(spark, directory, "orders"),
        [Dimension("lines", _lines(spark, directory), ("o_orderkey",))],
    )


@register(_FAN_OUT)
def gold_fanout_split(spark, directory):
    """The same rows by a plan in which hot keys of either side can be split."""
    return denormalize(
        table(spark, directory, "orders"),
        [Dimension("lines", _lines(spark, directory), ("o_orderkey",), fan_out=True)],
    )


_HOT_LINES = "SELECT CASE WHEN l_quantity < 17 THEN 1 ELSE l_partkey END AS p_partkey, l_orderkey, l_extendedprice FROM lineitem"


@register(f"""
SELECT p.p_partkey, p_name, l_orderkey, l_extendedprice
FROM part p LEFT JOIN ({_HOT_LINES}) l ON p.p_partkey = l.p_partkey""")
def gold_hot_keys(spark, directory):
    """One part has a third of all lines: its rows are joined apart, all others as usual."""
    lines = spark.sql(_HOT_LINES.replace("FROM lineitem", "FROM {lines}"), lines=table(spark, directory, "lineitem"))
    parts = table(spark, directory, "part").select("p_partkey", "p_name")
    return left_join_hot_keys(parts, lines, ["p_partkey"], least=1000)


@register("""
SELECT o.o_orderkey, o.o_custkey, o.o_totalprice, l.l_linenumber, l.l_quantity
FROM (SELECT CASE WHEN o_orderstatus <> 'P' THEN o_orderkey END AS o_orderkey, o_custkey,
        o_totalprice FROM orders) o
LEFT JOIN lineitem l ON o.o_orderkey = l.l_orderkey""")
def gold_fanout_null_keys(spark, directory):
    """Base rows without a key stay, unmatched."""
    orders = table(spark, directory, "orders").selectExpr(
        "CASE WHEN o_orderstatus <> 'P' THEN o_orderkey END AS o_orderkey", "o_custkey", "o_totalprice"
    )
    lines = _lines(spark, directory).drop("l_shipdate")
    return left_join_fan_out(orders, lines, ["o_orderkey"]).select(
        "o_orderkey", "o_custkey", "o_totalprice", "l_linenumber", "l_quantity"
    )


@register(f"""
SELECT {_ORDER}, c.c_mktsegment, c.c_nationkey, n.n_name, n.n_regionkey, r.r_name
FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey""")
def gold_chain(spark, directory):
    """Dimensions of dimensions, the last by an inner join."""
    customer = table(spark, directory, "customer").withColumnRenamed("c_custkey", "o_custkey")
    nation = table(spark, directory, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    region = table(spark, directory, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    return denormalize(
        table(spark, directory, "orders"),
        [
            Dimension("customer", customer, ("o_custkey",), ("c_mktsegment", "c_nationkey")),
            Dimension("nation", nation, ("c_nationkey",), ("n_name", "n_regionkey")),
            Dimension("region", region, ("n_regionkey",), how="inner"),
        ],
    )

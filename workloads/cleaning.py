"""Extracts and conforming, on tables made messy by expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from siltstone.operators.conform import conform
from siltstone.operators.project import select_declared
from siltstone.sources.extract import extract
from siltstone.specs import Default, DomainSpec, Feed, Range, SumOf
from workloads.registry import DAY1, register, table

_TEXTS = """l_orderkey, l_linenumber,
  CASE WHEN l_returnflag = 'R' THEN 'n/a' ELSE CAST(l_quantity AS VARCHAR) END AS quantity,
  l_extendedprice AS price,
  CAST(l_shipdate AS VARCHAR) AS ship_date,
  CASE WHEN l_linestatus = 'O' THEN 'true' ELSE 'perhaps' END AS is_open,
  l_tax AS tax"""

_LINE_TYPES = DomainSpec(
    name="lines",
    key=("l_orderkey", "l_linenumber"),
    columns=(
        ("l_orderkey", "STRING"), ("l_linenumber", "STRING"), ("quantity", "DECIMAL(18,4)"),
        ("price", "DECIMAL(6,2)"), ("ship_date", "DATE"), ("is_open", "BOOLEAN"),
        ("tax", "DECIMAL(3,1)"), ("never_delivered", "STRING"),
    ),
)


@register(f"""
SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_linenumber AS VARCHAR) AS l_linenumber,
  TRY_CAST(quantity AS DECIMAL(18,4)) AS quantity, TRY_CAST(price AS DECIMAL(6,2)) AS price,
  CAST(TRY_CAST(ship_date AS TIMESTAMP) AS DATE) AS ship_date, TRY_CAST(is_open AS BOOLEAN) AS is_open,
  CAST(CAST(tax AS DECIMAL(18,2)) AS DECIMAL(3,1)) AS tax
FROM (SELECT {_TEXTS} FROM lineitem)""")
def conform_cast(spark, directory):
    """Words, overflows and half-way digits: NULL, NULL, rounded half up."""
    messy = table(spark, directory, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber",
        "CASE WHEN l_returnflag = 'R' THEN 'n/a' ELSE CAST(l_quantity AS STRING) END AS quantity",
        "l_extendedprice AS price", "CAST(l_shipdate AS STRING) AS ship_date",
        "CASE WHEN l_linestatus = 'O' THEN 'true' ELSE 'perhaps' END AS is_open", "l_tax AS tax",
    )
    return conform(messy, _LINE_TYPES)


_PART_ENUMS = DomainSpec(
    name="parts",
    key=("p_partkey",),
    columns=(("p_partkey", "STRING"), ("p_type", "STRING"), ("p_brand", "STRING"),
             ("p_name", "STRING")),
    upper_trim=("p_type", "p_brand"),
)


@register("""
SELECT CAST(p_partkey AS VARCHAR) AS p_partkey,
  upper(trim(lower(concat('  ', p_type, ' ')), ' ')) AS p_type,
  upper(trim(concat(chr(9), p_brand, ' '), ' ')) AS p_brand, p_name
FROM part""")
def conform_enum(spark, directory):
    """Spaces go, a tab stays."""
    messy = table(spark, directory, "part").selectExpr(
        "p_partkey", "lower(concat('  ', p_type, ' ')) AS p_type",
        "concat('\t', p_brand, ' ') AS p_brand", "p_name",
    )
    return conform(messy, _PART_ENUMS)


_ORDER_STATUS = DomainSpec(
    name="order_status",
    key=("o_orderkey",),
    columns=(("o_orderkey", "STRING"), ("status", "STRING")),
    upper_trim=("status",),
    defaults=(Default("status", ("OPEN", "CLOSED", "PENDING"), "OPEN"),),
)


@register("""
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey,
  CASE WHEN upper(trim(status, ' ')) IN ('OPEN', 'CLOSED', 'PENDING') THEN upper(trim(status, ' '))
       ELSE 'OPEN' END AS status
FROM (SELECT o_orderkey, CASE
        WHEN o_orderpriority = '5-LOW' THEN NULL WHEN o_orderpriority = '1-URGENT' THEN 'rushed'
        WHEN o_orderstatus = 'F' THEN ' closed ' WHEN o_orderstatus = 'P' THEN 'Pending'
        ELSE 'open' END AS status FROM orders)""")
def conform_default(spark, directory):
    messy = table(spark, directory, "orders").selectExpr(
        "o_orderkey",
        """CASE WHEN o_orderpriority = '5-LOW' THEN NULL WHEN o_orderpriority = '1-URGENT'
           THEN 'rushed' WHEN o_orderstatus = 'F' THEN ' closed ' WHEN o_orderstatus = 'P'
           THEN 'Pending' ELSE 'open' END AS status""",
    )
    return conform(messy, _ORDER_STATUS)


_YIELDS = DomainSpec(
    name="yields",
    key=("l_orderkey", "l_linenumber"),
    columns=(("l_orderkey", "STRING"), ("l_linenumber", "STRING"), ("l_partkey", "STRING"),
             ("yield_percent", "DECIMAL(8,4)"), ("score", "DECIMAL(5,2)"), ("coupon", "DECIMAL(8,5)")),
    ranges=(Range("yield_percent", -50, 200), Range("score", 0, 100), Range("coupon", 0, 100)),
)


@register("""
SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_linenumber AS VARCHAR) AS l_linenumber,
  CAST(l_partkey AS VARCHAR) AS l_partkey,
  CAST(CASE WHEN y BETWEEN -50 AND 200 THEN y END AS DECIMAL(8,4)) AS yield_percent,
  CAST(CASE WHEN s BETWEEN 0 AND 100 THEN s END AS DECIMAL(5,2)) AS score,
  CAST(CASE WHEN c BETWEEN 0 AND 100 THEN c END AS DECIMAL(8,5)) AS coupon
FROM (SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_quantity * 10 - 100 AS DECIMAL(8,2)) AS y,
        CAST(l_quantity * 4 - 20 AS DECIMAL(8,2)) AS s, CAST(l_quantity * 2 + 4 AS DECIMAL(8,2)) AS c
      FROM lineitem)""")
def conform_range(spark, directory):
    """Both bounds belong to the range; outside it the value becomes NULL."""
    messy = table(spark, directory, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity * 10 - 100 AS yield_percent",
        "l_quantity * 4 - 20 AS score", "l_quantity * 2 + 4 AS coupon",
    )
    return conform(messy, _YIELDS)


_PNL = DomainSpec(
    name="pnl",
    key=("l_orderkey", "l_linenumber"),
    columns=(("l_orderkey", "STRING"), ("l_linenumber", "STRING"), ("l_suppkey", "STRING"),
             ("unrealized", "DECIMAL(18,2)"), ("realized", "DECIMAL(18,2)"),
             ("total", "DECIMAL(18,2)")),
    sums=(SumOf("total", ("unrealized", "realized")),),
)


@register("""
SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_linenumber AS VARCHAR) AS l_linenumber,
  CAST(l_suppkey AS VARCHAR) AS l_suppkey, unrealized, realized,
  CAST(coalesce(total, unrealized + realized) AS DECIMAL(18,2)) AS total
FROM (SELECT l_orderkey, l_linenumber, l_suppkey,
        CAST(CASE WHEN l_returnflag <> 'N' THEN l_extendedprice END AS DECIMAL(18,2)) AS unrealized,
        CAST(l_tax AS DECIMAL(18,2)) AS realized,
        CAST(CASE WHEN l_linestatus = 'O' THEN l_quantity END AS DECIMAL(18,2)) AS total
      FROM lineitem)""")
def conform_derive(spark, directory):
    """A missing total is the sum of its parts, NULL if a part is."""
    messy = table(spark, directory, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_suppkey",
        "CASE WHEN l_returnflag <> 'N' THEN l_extendedprice END AS unrealized",
        "l_tax AS realized", "CASE WHEN l_linestatus = 'O' THEN l_quantity END AS total",
    )
    return conform(messy, _PNL)


_CUSTOMERS = DomainSpec(
    name="customers",
    key=("customer_id",),
    columns=(("customer_id", "STRING"), ("customer_name", "STRING"), ("segment", "STRING"),
             ("balance", "DOUBLE"), ("source_system", "STRING"), ("never_delivered", "DATE")),
    feeds=(
        Feed("crm", {"c_custkey": "customer_id", "c_name": "customer_name",
                     "c_mktsegment": "segment", "c_acctbal": "balance", "c_absent": "region"}),
    ),
    source_column="source_system",
)


@register("""
SELECT c_custkey AS customer_id, c_name AS customer_name, c_mktsegment AS segment,
       c_acctbal AS balance, 'crm' AS source_system FROM customer""")
def extract_rename(spark, directory):
    return extract(table(spark, directory, "customer"), _CUSTOMERS, "crm")


@register("""
SELECT c_custkey AS customer_id, c_name AS customer_name, c_mktsegment AS segment,
       c_acctbal AS balance, 'crm' AS source_system, CAST(NULL AS DATE) AS never_delivered
FROM customer""")
def extract_padded(spark, directory):
    """Declared columns that the feed lacks, as typed NULLs."""
    return extract(table(spark, directory, "customer"), _CUSTOMERS, "crm", missing="null")


@register("SELECT p_type, p_partkey FROM part")
def select_declared_columns(spark, directory):
    """Declared order, absent columns left out; the scan reads two columns."""
    return select_declared(table(spark, directory, "part"), ["p_type", "p_missing", "p_partkey"])


_EVENTS = DomainSpec(
    name="events",
    key=("event_id",),
    columns=(("event_id", "STRING"), ("event_type", "STRING"), ("value", "DECIMAL(18,2)"),
             ("created_timestamp", "TIMESTAMP"), ("updated_timestamp", "TIMESTAMP")),
    stamps=("created_timestamp", "updated_timestamp"),
)


@register("""
SELECT CAST(event_id AS VARCHAR) AS event_id, event_type, CAST(value AS DECIMAL(18,2)) AS value,
  ts AS created_timestamp, TIMESTAMP '2026-05-26 00:00:00' AS updated_timestamp FROM events""")
def conform_stamps(spark, directory):
    """A delivered audit time stays; a missing one is the run time."""
    events = table(spark, directory, "events").withColumnRenamed("ts", "created_timestamp")
    return conform(events, _EVENTS, DAY1).withColumn(
        "created_timestamp", F.col("created_timestamp").cast("timestamp_ntz")
    )

"""Stored layers: dated snapshots, silver batches with history, the wide table, the report."""

from __future__ import annotations

import functools
import re
import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.domains import POSITIONS, RISK_ANALYTICS, SECURITY, WIDE_TABLE
from siltstone.operators.conform import conform
from siltstone.operators.rejects import rejected
from siltstone.plans.daily import run_day
from siltstone.plans.silver import silver_step
from siltstone.sources.extract import extract
from siltstone.sources.scan import list_snapshots, read_snapshot
from siltstone.sources.store import Store, read_table, table_columns, table_exists, write_table
from siltstone.specs import DomainSpec
from workloads import domain_feeds as feeds
from workloads.history import KEY
from workloads.history import delivery as order_delivery
from workloads.registry import DAY1, DAY2, register, table
from workloads.report_sql import day_report


def scratch(spark: SparkSession) -> str:
    """A new folder in the shared place the cluster names; a local one only if it names none."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/siltstone-{uuid.uuid4().hex}"
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="siltstone-")


# --- snapshots ------------------------------------------------------------------------


def _event_snapshots(spark, directory) -> str:
    """All events, one entry ``day=YYYYMMDD.parquet`` per day, from a single write."""
    events = table(spark, directory, "events")
    root = f"{scratch(spark)}/events"
    named = events.withColumn("day", F.concat(F.date_format("ts", "yyyyMMdd"), F.lit(".parquet")))
    write_table(named.hint("rebalance", "day"), root, partition_by=["day"])
    return root


@register("SELECT * FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-03'")
def dated_scan(spark, directory):
    root = _event_snapshots(spark, directory)
    schema = table(spark, directory, "events").schema
    return read_snapshot(spark, root, "2024-01-03", schema)


@register("SELECT * FROM events")
def undated_scan(spark, directory):
    """Without a date every snapshot is read."""
    root = _event_snapshots(spark, directory)
    return read_snapshot(spark, root, schema=table(spark, directory, "events").schema)


@register("SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS snapshot_date FROM events")
def snapshots_listed(spark, directory):
    return list_snapshots(spark, _event_snapshots(spark, directory))


@register("SELECT * FROM lineitem")
def table_round_trip(spark, directory):
    """A written table read back."""
    path = f"{scratch(spark)}/lines"
    write_table(table(spark, directory, "lineitem"), path)
    return read_table(spark, path)


# --- one domain at a time -------------------------------------------------------------


def _extracted(spark, directory, spec: DomainSpec, feed: str, day: int = 1) -> DataFrame:
    return extract(feeds.delivery(spark, directory, feed, day), spec, feed)


def _ntz(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("timestamp_ntz") for n in names})


@register(feeds.alpha_canonical(1))
def extract_positions_alpha(spark, directory):
    return _extracted(spark, directory, POSITIONS, "accounting_system_alpha")


@register(feeds.beta_canonical())
def extract_positions_beta(spark, directory):
    return _extracted(spark, directory, POSITIONS, "accounting_system_beta")


@register(f"""SELECT SEC_ID AS security_id, SEC_NAME AS security_name, SEC_TYPE AS security_type,
  ASSET_CLASS AS asset_class, CAST(CPN_RATE AS DOUBLE) AS coupon_rate,
  RATING_MOODY AS credit_rating_moody, PAR_VALUE AS par_value, CCY AS currency,
  CREATED_TS AS created_timestamp FROM ({feeds.security_sql(1)})""")
def extract_security(spark, directory):
    rows = _extracted(spark, directory, SECURITY, "security_master")
    return rows.withColumn("coupon_rate", F.col("coupon_rate").cast("double"))


@register(f"""SELECT CALC_ID AS risk_calc_id, SEC_ID AS security_id, POS_ID AS position_id,
  CALC_DATE AS as_of_date, PX_SOURCE AS price_source, YTM AS yield_to_maturity,
  LIQ_SCORE AS liquidity_score, DV01 AS dv01 FROM ({feeds.risk_sql(1)})""")
def extract_risk(spark, directory):
    return _extracted(spark, directory, RISK_ANALYTICS, "risk_engine")


@register(feeds.conformed_positions(feeds.beta_canonical()))
def conform_positions(spark, directory):
    rows = _extracted(spark, directory, POSITIONS, "accounting_system_beta")
    return conform(rows, POSITIONS, DAY1).select(*feeds.POSITION_COLUMNS)


@register(feeds.conformed_security(1))
def conform_security(spark, directory):
    rows = _extracted(spark, directory, SECURITY, "security_master")
    return conform(rows, SECURITY).select(*feeds.SECURITY_COLUMNS)


@register(feeds.conformed_risk(1))
def conform_risk(spark, directory):
    rows = _extracted(spark, directory, RISK_ANALYTICS, "risk_engine")
    return conform(rows, RISK_ANALYTICS).select(*feeds.RISK_COLUMNS)


_ORDERS = DomainSpec(
    name="orders",
    key=("o_orderkey",),
    columns=(("o_orderkey", "STRING"), ("o_custkey", "STRING"), ("o_orderstatus", "STRING"),
             ("o_totalprice", "DECIMAL(18,2)"), ("loaded_at", "TIMESTAMP")),
    upper_trim=("o_orderstatus",),
    stamps=("loaded_at",),
)

_SILVER = """
base AS (SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
  o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice, o_orderpriority FROM orders),
rows_of_days AS (
  SELECT *, TIMESTAMP '2026-05-26 00:00:00' AS seen_at, '20260526' AS b FROM base
    WHERE o_orderpriority <> '1-URGENT'
  UNION ALL
  SELECT o_orderkey, o_custkey, o_orderstatus,
    CAST(CASE WHEN o_orderstatus = 'P' THEN o_totalprice + 1 ELSE o_totalprice END AS DECIMAL(18,2)),
    o_orderpriority, TIMESTAMP '2026-05-27 00:00:00', '20260527' FROM base
    WHERE o_orderpriority <> '5-LOW'),
seen AS (SELECT *, lag(o_totalprice) OVER (PARTITION BY o_orderkey ORDER BY seen_at) AS earlier
  FROM rows_of_days),
starts AS (SELECT * FROM seen WHERE earlier IS NULL OR earlier <> o_totalprice),
versions AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, seen_at AS loaded_at,
  seen_at AS _effective_from, lead(seen_at) OVER (PARTITION BY o_orderkey ORDER BY seen_at) AS _effective_to,
  lead(seen_at) OVER (PARTITION BY o_orderkey ORDER BY seen_at) IS NULL AS _is_current, b AS _batch_id
  FROM starts)"""


def _silver_orders(spark, directory) -> Store:
    store = Store(spark, scratch(spark))
    orders = table(spark, directory, "orders")
    silver_step(store, order_delivery(orders, 1), _ORDERS, "20260526", DAY1)
    silver_step(store, order_delivery(orders, 2), _ORDERS, "20260527", DAY2)
    # The same batch once more replaces its own output by the same rows.
    silver_step(store, order_delivery(orders, 2), _ORDERS, "20260527", DAY2)
    return store


@register(f"WITH {_SILVER} SELECT * FROM versions")
def silver_history(spark, directory):
    """Two stored batches; load times differ from day to day and re-version nothing."""
    return _silver_orders(spark, directory).read_history("silver", "orders").drop("_record_hash")


@register(f"WITH {_SILVER} SELECT * FROM versions WHERE _is_current")
def silver_current(spark, directory):
    return _silver_orders(spark, directory).read_current("silver", "orders").drop("_record_hash")


_LINES = DomainSpec(
    name="lines",
    key=("l_orderkey", "l_linenumber"),
    columns=(("l_orderkey", "STRING"), ("l_linenumber", "STRING"), ("l_partkey", "STRING"),
             ("l_returnflag", "STRING"), ("l_linestatus", "STRING")),
    rejects="quarantine",
)
_LINE_COLUMNS = """CAST(l_orderkey AS VARCHAR) AS l_orderkey,
  CASE WHEN l_quantity < 40 THEN CAST(l_linenumber AS VARCHAR) END AS l_linenumber,
  CAST(l_partkey % 2 AS VARCHAR) AS l_partkey, l_returnflag, l_linestatus"""


@register(f"""
WITH came AS (SELECT {_LINE_COLUMNS} FROM lineitem),
ranked AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_linestatus, l_partkey, l_returnflag) AS rank FROM came)
SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag, l_linestatus, 'in the table' AS outcome, 1::BIGINT AS n
FROM ranked WHERE l_linenumber IS NOT NULL AND rank = 1
UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag, l_linestatus, 'duplicate key', count(*)
FROM ranked WHERE l_linenumber IS NOT NULL AND rank > 1 GROUP BY ALL
UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag, l_linestatus, 'NULL in l_linenumber', count(*)
FROM came WHERE l_linenumber IS NULL GROUP BY ALL""")
def silver_quarantine(spark, directory):
    """Repeated and NULL keys: what the table took and what went to the reject table, with the reason."""
    store = Store(spark, scratch(spark))
    lines = table(spark, directory, "lineitem")
    rows = lines.selectExpr(
        "l_orderkey", "CASE WHEN l_quantity < 40 THEN l_linenumber END AS l_linenumber",
        "l_partkey % 2 AS l_partkey", "l_returnflag", "l_linestatus",
    )
    silver_step(store, rows, _LINES, "20260526", DAY1)
    taken = store.read_current("silver", "lines").select(*_LINES.column_names)
    taken = taken.withColumns({"outcome": F.lit("in the table"), "n": F.lit(1).cast("long")})
    left_out = rejected(store.read("rejects", "lines"))
    return taken.unionByName(left_out.withColumnsRenamed({"_reject_reason": "outcome", "_rejected_copies": "n"}))


# --- two business days of everything --------------------------------------------------


_STORED: dict[tuple, tuple[Store, DataFrame]] = {}


def stored_once(days: Callable) -> Callable:
    """Business days that several queries of an application read: loaded by the first of them."""

    @functools.wraps(days)
    def load(spark: SparkSession, directory: str) -> tuple[Store, DataFrame]:
        place = (days.__name__, spark.sparkContext.applicationId, directory)
        if place not in _STORED:
            _STORED[place] = days(spark, directory)
        return _STORED[place]

    return load


@stored_once
def _two_days(spark, directory) -> tuple[Store, DataFrame]:
    """Day 1 with all feeds; on day 2 the beta system delivers nothing."""
    root = scratch(spark)
    raw, store = f"{root}/raw", Store(spark, f"{root}/warehouse")

    def deliver(parts: tuple[int, str, str]) -> int:
        day, compact, feed = parts
        rows = feeds.delivery(spark, directory, feed, day)
        return write_table(rows, f"{raw}/{feed}/delivery_{compact}.parquet")

    names = [f.name for spec in (POSITIONS, SECURITY, RISK_ANALYTICS) for f in spec.feeds]
    deliveries = [(1, "20260526", name) for name in names]
    deliveries += [(2, "20260527", n) for n in names if n != "accounting_system_beta"]
    with ThreadPoolExecutor(max_workers=4) as pool:
        list(pool.map(deliver, deliveries))
    run_day(spark, raw, store, "2026-05-26")
    report = run_day(spark, raw, store, "2026-05-27", report_path=f"{root}/reports")
    return store, report


_POSITIONS_NOW = feeds.conformed_positions(feeds.current_positions())
_RISK_NOW = f"{feeds.conformed_risk(1)} UNION ALL {feeds.conformed_risk(2)}"


@register(f"""
SELECT p.*, s.security_name, s.security_type, s.asset_class, s.coupon_rate, s.credit_rating_moody,
  s.par_value, s.currency AS security_currency, s.created_timestamp AS security_created_timestamp,
  r.risk_calc_id, r.price_source, r.yield_to_maturity, r.liquidity_score, r.dv01,
  TIMESTAMP '2026-05-27 00:00:00' AS _pipeline_timestamp
FROM ({_POSITIONS_NOW}) p
LEFT JOIN ({feeds.conformed_security(2)}) s ON p.security_id = s.security_id
LEFT JOIN ({_RISK_NOW}) r
  ON p.position_id = r.position_id AND p.as_of_date = r.as_of_date""")
def gold_enterprise(spark, directory):
    """The stored wide table after two days, its columns that are not NULL throughout."""
    store, _ = _two_days(spark, directory)
    wide = store.read("gold", WIDE_TABLE)
    security = [c for c in feeds.SECURITY_COLUMNS if c != "security_id"]
    renamed = {"currency": "security_currency", "created_timestamp": "security_created_timestamp"}
    risk = [c for c in feeds.RISK_COLUMNS if c not in ("security_id", "position_id", "as_of_date")]
    return wide.select(
        *feeds.POSITION_COLUMNS, *[renamed.get(c, c) for c in security], *risk, "_pipeline_timestamp"
    )


def canonical(sql: str, names: dict[str, str]) -> str:
    """A feed's rows under their canonical names, as delivered."""
    return f"SELECT {', '.join(f'{a} AS {b}' for a, b in names.items())} FROM ({sql})"


SECURITY_NAMES = {
    "SEC_ID": "security_id", "SEC_NAME": "security_name", "SEC_TYPE": "security_type",
    "ASSET_CLASS": "asset_class", "CPN_RATE": "coupon_rate", "RATING_MOODY": "credit_rating_moody",
    "PAR_VALUE": "par_value", "CCY": "currency", "CREATED_TS": "created_timestamp",
}
RISK_NAMES = {
    "CALC_ID": "risk_calc_id", "SEC_ID": "security_id", "POS_ID": "position_id", "CALC_DATE": "as_of_date",
    "PX_SOURCE": "price_source", "YTM": "yield_to_maturity", "LIQ_SCORE": "liquidity_score", "DV01": "dv01",
}


_REPORT = day_report(
    _POSITIONS_NOW, feeds.conformed_security(2), _RISK_NOW,
    {
        "positions": feeds.consolidated(feeds.alpha_canonical(2)),
        "security": canonical(feeds.security_sql(2), SECURITY_NAMES),
        "risk_analytics": canonical(feeds.risk_sql(2), RISK_NAMES),
    },
    {x: c for x, c in feeds.DELIVERED.items() if x != "accounting_system_beta"},
    {"accounting_system_beta": "positions"},
)


@register(_REPORT)
def daily_report(spark, directory):
    """The report of day 2: counts of the wide table, values as delivered, and the feed that did not come."""
    _, report = _two_days(spark, directory)
    return report


@register(f"""
SELECT '{WIDE_TABLE}' AS pipeline, TIMESTAMP '2026-05-27 00:00:00' AS run_at, "check", label, passed, message,
  details, count(*) OVER () AS total_checks, count(*) FILTER (NOT passed) OVER () AS failed
FROM ({_REPORT})""")
def report_read_back(spark, directory):
    """The report as its sink holds it: one JSON document a day, here day 2's, check by check."""
    store, _ = _two_days(spark, directory)
    document = spark.read.json(f"{store.root.rsplit('/', 1)[0]}/reports")
    rows = document.select("pipeline", "timestamp", "summary", F.explode("checks").alias("c"))
    return rows.select(
        "pipeline", F.to_timestamp("timestamp").alias("run_at"), "c.check", "c.label", "c.passed",
        "c.message", "c.details", "summary.total_checks", "summary.failed",
    )


@register("""
SELECT column_name AS name, CASE column_type WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int' WHEN 'TIMESTAMP' THEN 'timestamp_ntz'
  ELSE lower(column_type) END AS kind, true AS table_exists, false AS other_exists
FROM (DESCRIBE lineitem)""")
def stored_columns(spark, directory):
    """The columns of a table that was written, and whether it and another one exist."""
    path = f"{scratch(spark)}/lines"
    write_table(table(spark, directory, "lineitem"), path)
    there, other = table_exists(spark, path), table_exists(spark, f"{path}-of-others")
    rows = [(f.name, f.dataType.simpleString(), there, other) for f in table_columns(spark, path)]
    return spark.createDataFrame(rows, "name string, kind string, table_exists boolean, other_exists boolean")


@register(f"""
WITH d1 AS ({feeds.conformed_positions(feeds.consolidated(
    feeds.alpha_canonical(1) + " UNION ALL BY NAME " + feeds.beta_canonical()))}),
d2 AS ({feeds.conformed_positions(feeds.consolidated(feeds.alpha_canonical(2)))}),
pairs AS (SELECT d1.position_id, d1.book_id, d1.as_of_date,
    d1.notional_amount <> d2.notional_amount AS changed
  FROM d1 JOIN d2 USING (position_id, book_id, as_of_date))
SELECT d1.*, TIMESTAMP '2026-05-26 00:00:00' AS _effective_from,
  CASE WHEN changed THEN TIMESTAMP '2026-05-27 00:00:00' END AS _effective_to,
  NOT coalesce(changed, false) AS _is_current, '20260526' AS _batch_id
FROM d1 LEFT JOIN pairs USING (position_id, book_id, as_of_date)
UNION ALL
SELECT d2.*, TIMESTAMP '2026-05-27 00:00:00', NULL, true, '20260527'
FROM d2 LEFT JOIN pairs USING (position_id, book_id, as_of_date) WHERE coalesce(changed, true)""")
def silver_positions(spark, directory):
    """Every version of every position after two days."""
    store, _ = _two_days(spark, directory)
    versions = store.read_history("silver", "positions")
    history = ["_effective_from", "_effective_to", "_is_current", "_batch_id"]
    return versions.select(*feeds.POSITION_COLUMNS, *history)

"""Data quality checks."""

from __future__ import annotations

from pyspark.sql import types as T

from siltstone.operators import quality
from workloads.registry import register, table


def _line_nulls(spark, directory):
    return table(spark, directory, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "CASE WHEN l_returnflag <> 'R' THEN l_quantity END AS quantity",
        "CASE WHEN l_linestatus = 'O' AND l_returnflag = 'N' THEN l_tax END AS tax",
    )


_LINE_NULLS = """(SELECT l_orderkey, l_linenumber,
  CASE WHEN l_returnflag <> 'R' THEN l_quantity END AS quantity,
  CASE WHEN l_linestatus = 'O' AND l_returnflag = 'N' THEN l_tax END AS tax FROM lineitem)"""


@register("""
SELECT 'cardinality' AS "check", 'lines' AS label, CAST(60000 AS BIGINT) AS expected,
  count(*) AS actual, count(*) BETWEEN 54000 AND 66000 AS passed,
  concat('Expected ~60000 rows (±10%), got ', count(*),
         CASE WHEN count(*) BETWEEN 54000 AND 66000 THEN ' [PASS]' ELSE ' [FAIL]' END) AS message
FROM lineitem""")
def dq_cardinality(spark, directory):
    return quality.check_cardinality(table(spark, directory, "lineitem"), 60000, 0.1, "lines")


@register("""
SELECT 'uniqueness' AS "check", 'lines' AS label, total_rows, distinct_keys,
  total_rows - distinct_keys AS duplicates, total_rows = distinct_keys AS passed,
  concat('Unique keys: ', distinct_keys, '/', total_rows, ', duplicates: ',
         total_rows - distinct_keys,
         CASE WHEN total_rows = distinct_keys THEN ' [PASS]' ELSE ' [FAIL]' END) AS message
FROM (SELECT (SELECT count(*) FROM lineitem) AS total_rows,
  (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS distinct_keys)""")
def dq_uniqueness(spark, directory):
    return quality.check_uniqueness(
        table(spark, directory, "lineitem"), ["l_orderkey", "l_linenumber"], "lines"
    )


@register(f"""
WITH keys AS (SELECT CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_suppkey END AS a,
                CASE WHEN l_linestatus = 'F' THEN NULL ELSE l_linenumber END AS b FROM lineitem),
  totals AS (SELECT (SELECT count(*) FROM keys) AS total_rows,
                    (SELECT count(*) FROM (SELECT DISTINCT a, b FROM keys)) AS distinct_keys)
SELECT 'uniqueness' AS "check", 'null keys' AS label, total_rows, distinct_keys,
  total_rows - distinct_keys AS duplicates, total_rows = distinct_keys AS passed,
  concat('Unique keys: ', distinct_keys, '/', total_rows, ', duplicates: ',
         total_rows - distinct_keys,
         CASE WHEN total_rows = distinct_keys THEN ' [PASS]' ELSE ' [FAIL]' END) AS message
FROM totals""")
def dq_uniqueness_null_keys(spark, directory):
    """NULL counts as a key value; here it is also the hottest one."""
    keys = table(spark, directory, "lineitem").selectExpr(
        "CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_suppkey END AS a",
        "CASE WHEN l_linestatus = 'F' THEN NULL ELSE l_linenumber END AS b",
    )
    return quality.check_uniqueness(keys, ["a", "b"], "null keys")


def _null_row(column: str, key: bool) -> str:
    failed = "n > 0" if key else "n / total > 0.5"
    return f"""SELECT '{column}' AS column_name, total AS total_rows, n AS null_count,
      round(n / total, 4) AS null_rate, {str(key).lower()} AS is_key, {failed} AS failed
    FROM (SELECT count(*) AS total, count(*) - count({column}) AS n FROM {_LINE_NULLS})"""


@register(" UNION ALL ".join([
    _null_row("l_orderkey", True), _null_row("l_linenumber", False),
    _null_row("quantity", True), _null_row("tax", False),
]))
def dq_null_rates(spark, directory):
    """One row per column, all of them from one pass."""
    return quality.null_rates(_line_nulls(spark, directory), ["l_orderkey", "quantity"], 0.5)


@register("""
SELECT 'referential_integrity' AS "check", 'labels' AS label, 'doc_id' AS join_key,
  count(*) AS orphan_count, count(*) = 0 AS passed,
  concat('Orphan doc_id values: ', count(*),
         CASE WHEN count(*) = 0 THEN ' [PASS]' ELSE ' [FAIL]' END) AS message
FROM (SELECT DISTINCT doc_id FROM documents) d
WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""")
def dq_ref_integrity(spark, directory):
    return quality.check_referential_integrity(
        table(spark, directory, "documents"), table(spark, directory, "labels"), "doc_id", "labels"
    )


@register("""
WITH child AS (SELECT DISTINCT CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_custkey END AS k
               FROM orders),
  parent AS (SELECT DISTINCT CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_custkey END AS k
             FROM customer)
SELECT k AS c_custkey FROM child WHERE NOT EXISTS (SELECT 1 FROM parent WHERE parent.k = child.k)""")
def dq_orphan_keys(spark, directory):
    """The orphans themselves; a NULL child key is one, whatever the parents hold."""
    child = table(spark, directory, "orders").selectExpr(
        "CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_custkey END AS c_custkey"
    )
    parent = table(spark, directory, "customer").selectExpr(
        "CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_custkey END AS c_custkey"
    )
    return quality.orphan_keys(child, parent, "c_custkey")


_RANGE = """
SELECT 'range' AS "check", 'tax' AS label, 'tax' AS "column", CAST(0.01 AS DOUBLE) AS min,
  CAST(0.06 AS DOUBLE) AS max, n AS violations, n = 0 AS passed,
  concat('tax: ', n, ' out-of-range values', CASE WHEN n = 0 THEN ' [PASS]' ELSE ' [FAIL]' END)
    AS message
FROM (SELECT count(*) AS n FROM (SELECT {tax} AS tax FROM lineitem) WHERE tax < 0.01 OR tax > 0.06)"""


@register(_RANGE.format(tax="CASE WHEN l_returnflag <> 'R' THEN l_tax END"))
def dq_range(spark, directory):
    """NULLs are no violations, the bounds neither."""
    lines = table(spark, directory, "lineitem").selectExpr(
        "CASE WHEN l_returnflag <> 'R' THEN l_tax END AS tax"
    )
    return quality.check_range(lines, "tax", 0.01, 0.06, "tax")


_CONTRACT = T.StructType(
    [
        T.StructField("P_PARTKEY", T.LongType()),
        T.StructField("p_name", T.StringType()),
        T.StructField("p_weight", T.DoubleType()),
    ]
)


@register("""
SELECT * FROM (
SELECT 'cardinality' AS "check", 'part' AS label, true AS passed,
  concat('Row count: ', count(*)) AS message,
  concat('{"actual":', count(*), '}') AS details FROM part
UNION ALL
SELECT 'schema_conformance', 'part', false, 'Missing columns: [''p_weight''], extra: 4 [FAIL]',
  '{"missing_columns":["p_weight"],"extra_columns":["p_brand","p_retailprice","p_size","p_type"],"mistyped_columns":[]}')""")
def dq_schema(spark, directory):
    """The table's columns against a contract, beside its row count."""
    part = table(spark, directory, "part")
    return quality.report(
        [
            quality.check_cardinality(part, label="part"),
            quality.check_schema_conformance(part, _CONTRACT, "part"),
        ]
    )


def _shared_scan(spark, directory):
    lines = _line_nulls(spark, directory)
    return quality.run_checks(
        lines,
        [
            quality.cardinality(label="lines"),
            quality.null_rate(lines.columns, ["l_orderkey", "quantity"], 0.5, "lines"),
            quality.value_range("tax", 0.01, None, "tax"),
            quality.value_range("weight", 0, 1, "weight", present=False),
        ],
    )


_SHARED = f"""
nulls AS (SELECT count(*) AS total, count(*) - count(quantity) AS nq, count(*) - count(tax) AS nt,
  count(*) FILTER (WHERE tax < 0.01) AS low FROM {_LINE_NULLS}),
shared AS (
SELECT 'cardinality' AS "check", 'lines' AS label, true AS passed,
  concat('Row count: ', total) AS message FROM nulls
UNION ALL
SELECT 'null_rates', 'lines', false, concat('Null check failures: [''quantity (key, null_rate=',
  format('{{:.2f}}', nq / total * 100), '%)'', ''tax (null_rate=',
  format('{{:.2f}}', nt / total * 100), '% > 50%)''] [FAIL]') FROM nulls
UNION ALL
SELECT 'range', 'tax', low = 0, concat('tax: ', low, ' out-of-range values',
  CASE WHEN low = 0 THEN ' [PASS]' ELSE ' [FAIL]' END) FROM nulls
UNION ALL
SELECT 'range', 'weight', true, 'Column not present')"""


@register(f"WITH {_SHARED} SELECT * FROM shared")
def dq_shared_scan(spark, directory):
    """Four checks from one aggregate."""
    return _shared_scan(spark, directory).drop("details")


@register(f"""WITH {_SHARED},
orphans AS (SELECT count(*) AS n FROM (SELECT DISTINCT doc_id FROM documents
  EXCEPT SELECT doc_id FROM labels))
SELECT "check", label, passed, message FROM shared
UNION ALL SELECT 'referential_integrity', 'labels', n = 0, concat('Orphan doc_id values: ', n,
  CASE WHEN n = 0 THEN ' [PASS]' ELSE ' [FAIL]' END) FROM orphans""")
def dq_report(spark, directory):
    orphans = quality.check_referential_integrity(
        table(spark, directory, "documents"), table(spark, directory, "labels"), "doc_id", "labels"
    )
    rows = _shared_scan(spark, directory).unionByName(quality.report([orphans]))
    return rows.drop("details")


@register("""
SELECT count(*) AS total_checks, count(*) FILTER (WHERE passed) AS passed,
  count(*) FILTER (WHERE NOT passed) AS failed, bool_and(passed) AS all_passed
FROM (SELECT true AS passed UNION ALL SELECT false
  UNION ALL SELECT count(*) = 0 FROM (SELECT CASE WHEN l_linestatus = 'O' AND l_returnflag = 'N'
    THEN l_tax END AS tax FROM lineitem) WHERE tax < 0.01
  UNION ALL SELECT true)""")
def dq_summary(spark, directory):
    return quality.summary(_shared_scan(spark, directory))

"""Runs a query and its SQL on the same tables and compares types, columns and rows."""

from __future__ import annotations

import collections
import datetime as dt
import decimal
import glob
import os

import duckdb


def connect(directory: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(glob.glob(f"{directory}/*.parquet")):
        name = os.path.basename(path)[: -len(".parquet")]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _plain(value):
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, decimal.Decimal):
        return format(value, "f")
    if isinstance(value, (dict, list)):
        return repr(value)
    return value


def _family(duck_or_spark: str) -> str:
    name = duck_or_spark.lower().replace("timestamp_ntz", "timestamp").replace(" ", "")
    return {"varchar": "string", "integer": "int"}.get(name, name)


def compare(spark, connection, query, sql: str, directory: str) -> list[str]:
    """Differences found; empty when the query and its SQL agree."""
    df = query(spark, directory)
    names = sorted(df.columns)
    relation = connection.sql(sql)
    if names != sorted(relation.columns):
        return [f"columns: {names} against {sorted(relation.columns)}"]
    found = []
    spark_types = {f.name: _family(f.dataType.simpleString()) for f in df.schema.fields}
    duck_types = {n: _family(str(t)) for n, t in zip(relation.columns, relation.types)}
    for name in names:
        if spark_types[name] != duck_types[name]:
            found.append(f"type of {name}: {spark_types[name]} against {duck_types[name]}")
    ours = collections.Counter(
        tuple(_plain(row[n]) for n in names) for row in df.select(*[f"`{n}`" for n in names]).collect()
    )
    position = {n: i for i, n in enumerate(relation.columns)}
    theirs = collections.Counter(
        tuple(_plain(row[position[n]]) for n in names) for row in relation.fetchall()
    )
    if ours != theirs:
        found.append(
            f"rows: {sum(ours.values())} against {sum(theirs.values())}; "
            f"only ours {list((ours - theirs).items())[:3]}; only SQL {list((theirs - ours).items())[:3]}"
        )
    if not ours:
        found.append("no rows")
    return found

"""Run registered queries next to their SQL counterparts and compare all values exactly."""

from __future__ import annotations

import datetime as dt
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame


def plan_of(df: DataFrame) -> str:
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        connection.sql(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def _normal(value):
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def differences(df: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    relation = connection.sql(sql)
    columns = sorted(df.columns)
    if columns != sorted(relation.columns):
        return [f"columns {columns} against {sorted(relation.columns)}"]
    order = [relation.columns.index(name) for name in columns]
    expected = Counter(tuple(_normal(row[i]) for i in order) for row in relation.fetchall())
    actual = Counter(tuple(_normal(row[name]) for name in columns) for row in df.collect())
    if actual == expected:
        return []
    extra, missing = actual - expected, expected - actual
    return [
        f"{sum(actual.values())} rows against {sum(expected.values())}",
        f"only in Spark: {sum(extra.values())} {list(extra)[:3]}",
        f"only in SQL: {sum(missing.values())} {list(missing)[:3]}",
    ]

"""The tables in Spark's catalog, for use from SQL."""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..schemas import DEFAULTS, MONTH, TABLES
from .warehouse import Warehouse


def _column_ddl(table: str) -> str:
    defaults = DEFAULTS.get(table, {})
    return ", ".join(
        f"{field.name} {field.dataType.simpleString()}"
        + (f" DEFAULT {defaults[field.name]}" if field.name in defaults else "")
        for field in TABLES[table].fields
    )


def create_tables(spark: SparkSession, database: str, location: str) -> None:
    """Create the database and every table that is not there yet, with types and defaults.

    Tables are external, with their files in folders under `location`: dropping one, or the
    database, leaves its files.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for table in TABLES:
        path = f"{location.rstrip('/')}/{table}"
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{table} ({_column_ddl(table)}) USING parquet LOCATION '{path}'")


def point_tables_at(warehouse: Warehouse, database: str) -> None:
    """Let the catalog tables show what the warehouse published last.

    Call it after every run: a table goes on showing the folder it was pointed at, which the next but one
    refresh of that table writes anew. A table in month folders has the month as its partition column. The table of runs
    shows those since the log was compacted last.
    """
    spark = warehouse.spark
    create_tables(spark, database, f"{warehouse.root}/unpublished")
    for table in TABLES:
        path = warehouse.log_path if table == "pipeline_runs" else warehouse.current_path(table)
        months = None if table == "pipeline_runs" else warehouse.months(table)
        if months is not None:
            _point_at_months(spark, f"{database}.{table}", table, path, months)
        elif path is not None:
            spark.sql(f"ALTER TABLE {database}.{table} SET LOCATION '{path}'")
            spark.catalog.refreshTable(f"{database}.{table}")


def _point_at_months(spark: SparkSession, name: str, table: str, location: str, months: dict[str, str]) -> None:
    """An external table with one partition per published month. Dropping the table before it leaves the files."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    columns = f"{_column_ddl(table)}, {MONTH} string"
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY ({MONTH}) LOCATION '{location}'")
    parts = [f"PARTITION ({MONTH} = '{month}') LOCATION '{path}'" for month, path in sorted(months.items())]
    if parts:
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {' '.join(parts)}")
    spark.catalog.refreshTable(name)


def list_tables(spark: SparkSession, database: str) -> list[str]:
    return sorted(table.name for table in spark.catalog.listTables(database) if not table.isTemporary)


def add_column(spark: SparkSession, table: str, name: str, kind: str, default: str | None = None) -> bool:
    """Add a column unless the table has it; rows already there show the default. True if added."""
    if name in spark.table(table).columns:
        return False
    spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({name} {kind}" + (f" DEFAULT {default})" if default else ")"))
    return True

"""Stored tables with snapshot replacement, and the run log that publishes them."""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Collection
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import AUDIT_COLUMN, COUNTED_NULLS, MONTH, MONTH_OF, NO_MONTH, PIPELINE_RUNS, REQUIRED, STEP_OF_TABLE, TABLES
from ..session import COMPRESSION
from ..session import observed as metrics_of

# Small tables whose rows of a month are shuffled into few files.
GATHERED = {"fx_rates"}

# Log files read when a warehouse is opened; `compact_log` moves them on where there are more.
RECENT_LOG_FILES = 200


class Snapshot(NamedTuple):
    """What a step wrote: its folder, the rows of the whole table, NULLs by column, and which folder holds each month."""

    path: str | None
    rows: int
    nulls: dict[str, int] = {}
    months: dict[str, str] | None = None


def month_of(date: Column) -> Column:
    return F.coalesce(F.date_format(date, "yyyy-MM"), F.lit(NO_MONTH))


class Warehouse:
    """Parquet tables under one root folder.

    Each table has two folders, `a` and `b`. A step writes the one that is not in use, and the
    success row it then appends to the run log makes that folder current: data and log row become
    visible together, a failed write changes nothing, and a step may read the table it replaces.
    Meant for one writer at a time; a reader has until the next but one refresh to finish. The
    object knows what was published when it was made, and what it published since.

    With `by_month` the tables in MONTH_OF are stored in month folders, of which each has an `a` and a `b`: a
    step may then write some months only, and the log row links the others where they are. A table is read in the
    form in which it was published.
    """

    def __init__(self, spark: SparkSession, root: str, by_month: bool = False):
        self.spark = spark
        self.root = root.rstrip("/")
        self.by_month = by_month
        self.log_path = f"{self.root}/pipeline_runs"
        self.old_log_path = f"{self.root}/pipeline_runs_old"
        for path in (self.log_path, self.old_log_path):
            spark.createDataFrame([], PIPELINE_RUNS).write.mode("ignore").parquet(path)
        self.refresh()

    def _log(self, *paths: str) -> DataFrame:
        return self.spark.read.schema(PIPELINE_RUNS).parquet(*paths)

    def runs(self) -> DataFrame:
        """All runs. A row that a broken compaction left in both folders counts once."""
        return self._log(self.log_path, self.old_log_path).dropDuplicates(["run_id"])

    def _latest(self, log: DataFrame) -> dict[str, Snapshot]:
        last = F.max_by(F.struct("published_path", "rows_processed", "published_months"), F.struct("run_at", "run_id"))
        rows = log.where(F.col("status") == "success").groupBy("step_name").agg(last.alias("last")).select("step_name", "last.*")
        return {
            row.step_name: Snapshot(row.published_path, row.rows_processed, {}, json.loads(row.published_months or "null"))
            for row in rows.collect()
        }

    def refresh(self) -> None:
        """Look up the last successful run of each step, one row per step.

        Compaction leaves the newest success of each step among the recent rows, so older ones are read only where a step
        has none there, as after a compaction that broke off.
        """
        self._published = self._latest(self._log(self.log_path))
        if set(STEP_OF_TABLE.values()) - set(self._published):
            self._published = {**self._latest(self._log(self.old_log_path)), **self._published}

    def compact_log(self, most: int = RECENT_LOG_FILES) -> bool:
        """Move the log's rows into few older files where there are more than `most` recent ones; True if so.

        First all rows are added to the old ones, then the recent folder is replaced by the newest success of each step, at most one
        row per step. Broken off in between, rows are in both folders, and `runs` counts them once; broken off while it replaces, the
        rows are with the old ones.
        """
        recent = self._log(self.log_path)
        if len(recent.inputFiles()) <= most:
            return False
        known = self._log(self.old_log_path).select("run_id")
        recent.join(known, "run_id", "left_anti").select(*PIPELINE_RUNS.names).coalesce(1).write.mode("append").parquet(self.old_log_path)
        newest = F.max_by(F.struct(*PIPELINE_RUNS.names), F.struct("run_at", "run_id")).alias("last")
        kept = recent.where("status = 'success'").groupBy("step_name").agg(newest).select("last.*").collect()
        self.spark.createDataFrame(kept, PIPELINE_RUNS).coalesce(1).write.mode("overwrite").parquet(self.log_path)
        return True

    def _current(self, table: str) -> Snapshot:
        return self._published.get(STEP_OF_TABLE[table], Snapshot(None, 0))

    def current_path(self, table: str) -> str | None:
        return self._current(table).path

    def months(self, table: str) -> dict[str, str] | None:
        """Published months of a table in month folders and the path of each; None if it is not stored so."""
        current = self._current(table)
        if current.months is None:
            return None
        return {month: f"{current.path}/slot={slot}/{MONTH}={month}" for month, slot in current.months.items()}

    def row_count(self, table: str) -> int:
        """Rows of the published table, as counted when it was written."""
        return self._current(table).rows

    def exists(self, table: str) -> bool:
        return self.current_path(table) is not None

    def null_counts(self) -> DataFrame:
        """NULLs by table and column, as the writing tasks of each step's last success counted them."""
        tables = F.create_map(*[F.lit(text) for pair in ((step, table) for table, step in STEP_OF_TABLE.items()) for text in pair])
        last = F.max_by("null_counts", F.struct("run_at", "run_id")).alias("counts")
        rows = self.runs().where("status = 'success'").groupBy("step_name").agg(last)
        counts = F.explode(F.from_json("counts", "map<string, bigint>")).alias("column_name", "null_count")
        return rows.select(tables[F.col("step_name")].alias("table_name"), counts)

    def last_details(self) -> dict[str, dict]:
        """What each step's last successful run counted."""
        last = F.max_by("details", F.struct("run_at", "run_id")).alias("details")
        rows = self._log(self.log_path).where("status = 'success'").groupBy("step_name").agg(last).collect()
        return {row.step_name: json.loads(row.details or "{}") for row in rows}

    def rejects(self) -> DataFrame:
        """Lines left out by the published clean table, with their reason; as published with it."""
        runs = self.runs().where((F.col("step_name") == STEP_OF_TABLE["orders_clean"]) & (F.col("status") == "success"))
        last = runs.agg(F.max_by("rejects_path", F.struct("run_at", "run_id"))).first()[0]
        if last is None:
            raise LookupError(f"no rejected lines were written with the clean orders under {self.root}")
        return self.spark.read.parquet(last)

    def read(self, table: str, months: Collection[str] | None = None, with_month: bool = False) -> DataFrame:
        """The published table, or its rows of some months (`yyyy-MM`).

        Of a table in month folders only those months' files are listed and read. `with_month` adds the month as column
        `stored_month`: filters on it, and joins with a filtered table on it, prune files too.
        """
        if table == "pipeline_runs":
            return self.runs()
        path = self.current_path(table)
        if path is None:
            raise LookupError(f"table {table} has not been published under {self.root}")
        return self.read_snapshot(table, self._current(table), months, with_month)

    def read_snapshot(
        self, table: str, snapshot: Snapshot, months: Collection[str] | None = None, with_month: bool = False
    ) -> DataFrame:
        """The rows of a snapshot, published or not."""
        schema = TABLES[table]
        reader = self.spark.read
        if snapshot.months is None:
            df = reader.schema(schema).parquet(snapshot.path)
            if table not in MONTH_OF:
                return df
            month = month_of(F.col(MONTH_OF[table]))
            df = df if months is None else df.where(month.isin(list(months)))
            return df.withColumn(MONTH, month) if with_month else df
        folders = [T.StructField("slot", T.StringType()), T.StructField(MONTH, T.StringType())]
        paths = [
            f"{snapshot.path}/slot={slot}/{MONTH}={month}"
            for month, slot in sorted(snapshot.months.items())
            if months is None or month in months
        ]
        if paths:
            df = reader.schema(T.StructType([*schema.fields, *folders])).option("basePath", snapshot.path).parquet(*paths)
        else:
            df = self.spark.createDataFrame([], T.StructType([*schema.fields, *folders]))
        return df.select(*schema.names, *[MONTH] * with_month)

    def write_idle(self, table: str, df: DataFrame, keep_other_months: bool = False) -> Snapshot:
        """Write a snapshot next to the current one.

        Nothing is published yet. Rows that carry no write time get the current one. Rows, and NULLs
        by column, are counted by the writing tasks, so nothing is read back. With `keep_other_months`, for tables in month
        folders, `df` holds all rows of the months that change, and the other months stay linked where they are.
        """
        stamp = AUDIT_COLUMN[table]
        stamped = df if stamp in df.columns else df.withColumn(stamp, F.current_timestamp())
        typed = stamped.select(*[F.col(field.name).cast(field.dataType) for field in TABLES[table].fields])
        required = REQUIRED.get(table, [])
        counted = [*required, *COUNTED_NULLS.get(table, [])]
        in_months = self.by_month and table in MONTH_OF
        if in_months:
            typed = typed.withColumn(MONTH, month_of(F.col(MONTH_OF[table])))
        elif keep_other_months:
            raise ValueError(f"{table} is not stored in month folders")
        written = Observation()
        observed = typed.observe(
            written,
            F.count(F.lit(1)).alias("row_count"),
            *[F.count_if(F.col(name).isNull()).alias(f"null_{name}") for name in counted],
            *[F.collect_set(MONTH).alias("months")] * in_months,
        )
        current = self._current(table)
        if in_months:
            path, months = self._write_months(table, observed, current), dict(current.months or {}) if keep_other_months else {}
        else:
            path, months = f"{self.root}/{table}/{'b' if current.path == f'{self.root}/{table}/a' else 'a'}", None
            observed.write.mode("overwrite").parquet(path, compression=COMPRESSION)
        counts = metrics_of(written, typed)
        nulls = {name: counts.get(f"null_{name}", 0) for name in counted}
        missing = sum(nulls[name] for name in required)
        if missing:
            raise ValueError(f"{missing} values are NULL in a required column ({', '.join(required)})")
        rows = counts.get("row_count", 0)
        if in_months:
            touched = sorted(counts.get("months", []))
            if keep_other_months and months:
                before = self.read_snapshot(table, current, set(touched) & set(months)).count()  # from file footers
                rows += current.rows - before
            months.update({month: "b" if (current.months or {}).get(month) == "a" else "a" for month in touched})
        return Snapshot(path, rows, nulls, months)

    def _write_months(self, table: str, df: DataFrame, current: Snapshot) -> str:
        """Write each month's rows into that of its two folders that is not in use; other folders stay as they are.

        Whole order lines are not shuffled for it: each task writes a file per month that it has rows of, so that a month has as many
        files as tasks read its rows. Rates, few rows, are brought together by month.
        """
        path = f"{self.root}/{table}_by_month"
        in_a = [month for month, slot in (current.months or {}).items() if slot == "a"]
        slot = F.when(F.col(MONTH).isin(in_a), "b").otherwise("a") if in_a else F.lit("a")
        dealt = df.withColumn("slot", slot)
        if table in GATHERED:
            dealt = dealt.hint("rebalance", MONTH)
        writer = dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("slot", MONTH).parquet(path, compression=COMPRESSION)
        return path

    def log_run(
        self,
        step: str,
        status: str,
        rows: int,
        seconds: float,
        error: str | None = None,
        published: Snapshot | None = None,
        details: dict[str, int] | None = None,
        rejects_path: str | None = None,
    ) -> None:
        """Append one row to the run log. With status success this publishes the snapshot."""
        published = published or Snapshot(None, rows)
        row = {
            "run_id": str(uuid.uuid4()),
            "run_at": dt.datetime.now(dt.timezone.utc),
            "step_name": step,
            "status": status,
            "rows_processed": rows,
            "error_message": error,
            "duration_seconds": f"{seconds:.2f}",
            "published_path": published.path,
            "details": json.dumps(details) if details else None,
            "null_counts": json.dumps(published.nulls) if published.nulls else None,
            "rejects_path": rejects_path,
            "published_months": None if published.months is None else json.dumps(published.months),
        }
        if any(row[name] is None for name in REQUIRED["pipeline_runs"]):
            raise ValueError(f"a run needs {', '.join(REQUIRED['pipeline_runs'])}")
        columns = [F.lit(row[field.name]).cast(field.dataType).alias(field.name) for field in PIPELINE_RUNS.fields]
        self.spark.range(0, 1, 1, 1).select(*columns).write.mode("append").parquet(self.log_path)
        if status == "success":
            self._published[step] = published

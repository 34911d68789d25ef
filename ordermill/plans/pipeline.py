"""The five steps in order, each published with its run-log row."""

from __future__ import annotations

import datetime as dt
import time
import uuid
from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import unknown_keys, upsert
from ..schemas import KEYS, STEP_OF_TABLE
from ..session import observed, staged
from ..sources import Warehouse, month_of, read_fx_documents, read_order_pages, read_packed_pages
from . import cleaning, marts, quality, rates

# Tables whose key cannot repeat: keep_first, distinct dates with one source rate each, one group per country.
UNIQUE_BY_CONSTRUCTION = {"orders_clean", "fx_rates", "country_category_revenue"}


def run_step(
    warehouse: Warehouse,
    table: str,
    build: Callable[[], DataFrame],
    counters: Callable[[int], dict[str, int]] = lambda rows: {},
    keep_other_months: bool = False,
    aside: Callable[[], str | None] = lambda: None,
) -> int:
    """Build, write, check and publish one table; log the run either way and let errors through.

    `counters` is asked after the write, with the number of rows, for what the run's details hold. `aside`
    writes rejected lines before the publish and returns where: the one log row makes them and the table visible. A
    success row that cannot be written makes the step a failure.
    """
    step = STEP_OF_TABLE[table]
    started = time.monotonic()
    try:
        written = warehouse.write_idle(table, build(), keep_other_months)
        rows = written.rows
        if table in KEYS and table not in UNIQUE_BY_CONSTRUCTION:
            quality.require_unique(warehouse.read_snapshot(table, written), KEYS[table])
        rejects = aside()
        seconds = time.monotonic() - started
        warehouse.log_run(step, "success", rows, seconds, published=written, details=counters(rows), rejects_path=rejects)
    except Exception as error:
        try:
            warehouse.log_run(step, "failure", 0, time.monotonic() - started, error=str(error))
        except Exception as unlogged:
            error.add_note(f"the failure could not be logged: {unlogged}")
        raise
    return rows


def refreshed_rates(
    warehouse: Warehouse,
    source_rates: DataFrame,
    today: dt.date,
    seed: str = "required",
    dates_seen: Observation | None = None,
    rates_seen: Observation | None = None,
) -> DataFrame:
    """Stored rates with those of the current reference dates put in; older dates stay.

    In month folders: all rates of the months in which one is new or another than before.
    """
    clean = warehouse.read("orders_clean")
    rates.require_dates(clean)
    dates = rates.required_dates(clean)
    if dates_seen:
        dates = dates.observe(dates_seen, F.count(F.lit(1)).alias("required_dates"))
    batch = rates.daily_rates(dates, source_rates, today, seed=seed)
    if rates_seen:
        batch = batch.observe(rates_seen, F.count(F.lit(1)).alias("rates"), F.count_if("is_estimated").alias("estimated"))
    if not warehouse.exists("fx_rates") and not warehouse.by_month:
        return batch
    batch = staged(batch.withColumn("fetched_at", F.current_timestamp()), "rate_batch")
    if warehouse.by_month:
        return changed_months(warehouse, batch)
    return upsert(warehouse.read("fx_rates"), batch, KEYS["fx_rates"])


def _months_of(df: DataFrame, date: str) -> list[str]:
    """The months of a date column, a number set by the calendar."""
    return [row[0] for row in df.select(month_of(F.col(date))).distinct().collect()]


def changed_months(warehouse: Warehouse, batch: DataFrame) -> DataFrame:
    """All rows of those months of the rate table in which `batch` has a new rate or another one than is stored.

    Rows that say the same as the stored ones change nothing, their write time included.
    """
    stored = warehouse.read("fx_rates") if warehouse.exists("fx_rates") else batch.limit(0)
    same = [F.col(f"n.{name}").eqNullSafe(F.col(f"s.{name}")) for name in (*KEYS["fx_rates"], "rate", "is_estimated")]
    changed = batch.alias("n").join(stored.alias("s"), reduce(and_, same), "left_anti")
    changed = staged(changed, "changed_rates")
    months = _months_of(changed, "rate_date")
    if not warehouse.exists("fx_rates"):
        return changed
    return upsert(warehouse.read("fx_rates", months), changed, KEYS["fx_rates"])


def appended_orders(
    warehouse: Warehouse, clean: DataFrame, all_months: bool = False, added: Observation | None = None
) -> DataFrame:
    """The stored clean orders of the months that `clean` adds to, with its lines whose key is not stored yet.

    `clean` holds each key once. Known keys are looked up in the months of the new lines only, as a line that is landed
    again has the reference date it had; with `all_months` in all of them, at the price of reading every key. The look-up is an inner
    join of keys, so that Spark can prune the stored keys by a Bloom filter of the new ones. A first landing is written as it comes.
    """
    if not warehouse.exists("orders_clean"):
        return clean if added is None else clean.observe(added, F.count(F.lit(1)).alias("appended"))
    new = staged(clean, "new_orders")
    looked_up = None if all_months else _months_of(new, "fx_reference_date")
    stored = warehouse.read("orders_clean", looked_up)
    fresh = unknown_keys(stored, new, KEYS["orders_clean"])
    months = _months_of(fresh, "fx_reference_date") if warehouse.by_month else None
    if added is not None:
        fresh = fresh.observe(added, F.count(F.lit(1)).alias("appended"))
    return warehouse.read("orders_clean", months).unionByName(fresh.withColumn("cleaned_at", F.current_timestamp()))


def run_pipeline(
    spark: SparkSession,
    root: str,
    orders_path: str,
    fx_path: str,
    today: dt.date | None = None,
    categories: Sequence[str] = marts.REVENUE_CATEGORIES,
    threshold: float = marts.REVENUE_THRESHOLD_EUR,
    seed: str = "required",
    rejects_path: str | None = None,
    packed: bool = False,
    by_month: bool = False,
    append: bool = False,
    last: str | None = None,
    first: str | None = None,
) -> dict[str, int]:
    """Landed files to marts under `root`; returns rows per table and stops at the first failing step, or after the table `last`.

    With `first` the run begins with that table, from the published tables before it: rates are refreshed without a new landing.

    With `rejects_path` the lines cleaning leaves out are written to a new folder below it, with their reason, and published by
    the log row that publishes the clean table (`Warehouse.rejects`). `packed` landings hold one page per text line. What a step
    leaves out is counted as it writes and stored as the run's details.

    `by_month` stores clean orders and rates in month folders. With `append` the landing is added: its
    lines with a new key join the stored ones, and rates are replaced where they changed; with `by_month`, months without a
    change are not written.
    """
    today = today or dt.datetime.now(dt.timezone.utc).date()
    warehouse = Warehouse(spark, root, by_month)
    warehouse.compact_log()
    seen = {name: Observation(name) for name in ("raw", "clean", "appended", "dates", "rates", "spend", "revenue")}

    def stored() -> tuple[DataFrame, DataFrame]:
        return warehouse.read("orders_clean"), warehouse.read("fx_rates")

    def rated(name: str) -> dict:
        return {"rate_rows": warehouse.row_count("fx_rates"), "unrated": seen[name]}

    def clean() -> DataFrame:
        lines = cleaning.clean_stored_orders(warehouse.read("orders_raw"), seen["raw"]).observe(
            seen["clean"], F.count(F.lit(1)).alias("lines"), F.count_if(F.col("order_ts").isNull()).alias("unparseable_times")
        )
        return appended_orders(warehouse, lines, added=seen["appended"]) if append else lines

    def clean_counters(rows: int) -> dict[str, int]:
        left, found = observed(seen["raw"]), observed(seen["clean"])
        duplicates = left.get("raw", 0) - left.get("test", 0) - left.get("negative_qty", 0) - found.pop("lines", 0)
        return {**left, "duplicates": duplicates, **found, **({"appended": 0, **observed(seen["appended"])} if append else {})}

    def rejects() -> str | None:
        if not rejects_path:
            return None
        path = f"{rejects_path.rstrip('/')}/{uuid.uuid4().hex}"
        cleaning.quarantine(warehouse.read("orders_raw")).write.parquet(path)
        return path

    def rate_counters(rows: int) -> dict[str, int]:
        found = {**observed(seen["dates"]), **observed(seen["rates"])}
        return {**found, "dates_without_rate": found.get("required_dates", 0) - found.get("rates", 0)}

    read_pages = read_packed_pages if packed else read_order_pages
    steps: dict[str, tuple] = {
        "orders_raw": (lambda: read_pages(spark, orders_path),),
        "orders_clean": (clean, clean_counters, by_month and append, rejects),
        "fx_rates": (
            lambda: refreshed_rates(
                warehouse, read_fx_documents(spark, fx_path), today, seed, seen["dates"], seen["rates"]
            ),
            rate_counters,
            by_month,
        ),
        "customer_spend_eur": (
            lambda: marts.customer_spend(*stored(), **rated("spend")),
            lambda rows: observed(seen["spend"]),
        ),
        "country_category_revenue": (
            lambda: marts.country_revenue(*stored(), categories, threshold, **rated("revenue")),
            lambda rows: observed(seen["revenue"]),
        ),
    }
    counts = {}
    for table in list(steps)[list(steps).index(first) if first else 0 :]:
        step = steps[table]
        counts[table] = run_step(warehouse, table, *step)
        if table == last:
            break
    return counts

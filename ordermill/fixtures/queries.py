"""The registered queries: each takes a session and a folder of the test tables."""

from __future__ import annotations

import contextlib
import datetime as dt
import uuid
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import canonical_sku, line_amount, parse_order_ts
from ..operators import insert_ignore, keep_first, upsert, with_pair_rate
from ..plans import cleaning, marts, quality, rates
from ..plans.pipeline import run_pipeline, run_step
from ..schemas import FX_DOCUMENT, KEYS
from ..session import observed, scratch, staged
from ..sources import (
    Warehouse,
    add_column,
    decode_fx_documents,
    decode_pages,
    list_tables,
    point_tables_at,
    read_fx_documents,
    read_order_pages,
    read_packed_pages,
)
from .orders import TODAY, dates_of_lines, fx_documents, position_text, raw_orders, source_pages, source_rates, stored_raw_orders

EARLIER_TODAY = dt.date(2000, 6, 30)
QUARTER = (dt.date(1996, 1, 1), dt.date(1996, 3, 31))
ANOMALY_LIMIT_EUR = 4_000_000
CUTTING_THRESHOLD_EUR = 6_300_000_000


def _clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_orders(raw_orders(spark, sf_dir))


def _dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staged(rates.required_dates(_clean(spark, sf_dir)), "required_dates")


def _rates_of(dates: DataFrame) -> DataFrame:
    return rates.daily_rates(dates, source_rates(dates), TODAY)


# What the marts read of a clean line.
_AMOUNT = ("order_id", "status", "qty", "unit_price", "currency", "fx_reference_date")
_REVENUE = (*_AMOUNT, "category", "country")
_SPEND = (*_AMOUNT, "customer_id", "customer_email", "order_ts", "country")


def _stored(spark: SparkSession, sf_dir: str, *columns: str) -> tuple[DataFrame, DataFrame]:
    """Clean orders, as far as the query reads them, and their rates, written as between pipeline steps."""
    clean = staged(_clean(spark, sf_dir).select(*columns), "orders_clean")
    dates = staged(rates.required_dates(clean), "required_dates")
    return clean, staged(_rates_of(dates), "fx_rates")


def _as_double(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.col(name).cast("double") for name in names})


def _rounded_eur() -> Column:
    return F.round("eur", 6).cast("double").alias("eur")


def q_order_pages(spark, sf_dir):
    return _as_double(decode_pages(source_pages(spark, sf_dir)), "unit_price")


def _land_orders(spark, sf_dir, packed: bool = False, where: str = "true", observe: Sequence[Observation | Column] = ()) -> str:
    """A folder of landed order pages, compressed text written by Spark as a source leaves it."""
    folder = scratch(spark, "landed_orders")
    pages = source_pages(spark, sf_dir, where, *observe)
    if packed:
        record = F.concat(F.lit('{"offset":'), "page_offset", F.lit(',"lines":'), "page", F.lit("}"))
        pages.select(record.alias("value")).write.text(folder, compression="gzip")
    else:
        writer = pages.selectExpr("page_offset AS offset", "page").write.partitionBy("offset")
        # A file per page: the tasks move them into place, and not the driver one after the other.
        writer.option("mapreduce.fileoutputcommitter.algorithm.version", "2").text(folder, compression="gzip")
    return folder


def _land_rates(spark, sf_dir, where: str = "true") -> str:
    """A folder of landed rate documents for the dates of clean orders.

    An order has one reference date, so the first line of a key has the date of its other lines, and no line need be looked for.
    """
    return _land_documents(rates.required_dates(dates_of_lines(spark, sf_dir, lambda lines: cleaning.accepted(lines.where(where)))))


def _land_documents(dates: DataFrame) -> str:
    folder = scratch(dates.sparkSession, "landed_fx")
    fx_documents(source_rates(dates)).write.partitionBy("document").text(folder)
    return folder


def _land(spark, sf_dir, packed: bool = False, where: str = "true") -> tuple[str, str]:
    """Landed order pages and rate documents; the tasks that write the pages note the dates of accepted lines, a set that the calendar bounds."""
    seen = Observation()
    date = F.when(cleaning.is_accepted(), F.col("fx_reference_date"))
    orders = _land_orders(spark, sf_dir, packed, where, (seen, F.collect_set(date).alias("dates")))
    dates = [(date,) for date in observed(seen).get("dates", [])]
    return orders, _land_documents(spark.createDataFrame(dates, "rate_date date"))


def q_landed_pages(spark, sf_dir):
    return _as_double(read_order_pages(spark, _land_orders(spark, sf_dir)), "unit_price")


def q_landed_packed_pages(spark, sf_dir):
    return _as_double(read_packed_pages(spark, _land_orders(spark, sf_dir, packed=True)), "unit_price")


def q_landed_documents(spark, sf_dir):
    return _as_double(read_fx_documents(spark, _land_rates(spark, sf_dir)), "rate")


def _published(spark, sf_dir, again: bool = False, last: str | None = None, **options) -> Warehouse:
    """The tables of a run from landed files up to `last`; with `again` its rates are those of an earlier day, and refreshed by a second run."""
    root = scratch(spark, "published")
    landed = _land(spark, sf_dir, packed=True)
    run_pipeline(spark, root, *landed, today=EARLIER_TODAY if again else TODAY, packed=True, last=last, **options)
    if again:  # no order has landed since
        run_pipeline(spark, root, *landed, today=TODAY, packed=True, first="fx_rates", last=last, **options)
    return Warehouse(spark, root)


def q_published_orders(spark, sf_dir):
    orders = _published(spark, sf_dir, last="orders_clean").read("orders_clean")
    return _as_double(orders.where("cleaned_at IS NOT NULL").drop("cleaned_at"), "unit_price")


def q_published_rates(spark, sf_dir):
    rows = _published(spark, sf_dir, again=True, last="fx_rates").read("fx_rates")
    return _as_double(rows.drop("fetched_at"), "rate")


def q_monthly_rates(spark, sf_dir):
    """The second run replaces the months in which a rate is new or another, and links the others."""
    rows = _published(spark, sf_dir, again=True, last="fx_rates", by_month=True).read("fx_rates")
    return _as_double(rows.drop("fetched_at"), "rate")


def q_monthly_revenue(spark, sf_dir):
    """Revenue of the busiest quarter's months, read from their folders by way of the rates of its days."""
    warehouse = _published(spark, sf_dir, last="fx_rates", by_month=True)
    days = F.col("rate_date").between(*QUARTER)
    mart = marts.country_revenue(
        warehouse.read("orders_clean", with_month=True), warehouse.read("fx_rates").where(days), threshold=None
    )
    return _as_double(mart, "total_revenue_eur")


def q_appended_orders(spark, sf_dir):
    """Two landings: the lines of the web shop, then all lines. The second adds the keys that the first did not have."""
    root = scratch(spark, "appended")
    for where in ("channel = 'web'", "true"):
        landed = _land(spark, sf_dir, packed=True, where=where)
        run_pipeline(spark, root, *landed, today=TODAY, packed=True, by_month=True, append=True, last="orders_clean")
    return _as_double(Warehouse(spark, root).read("orders_clean").drop("cleaned_at"), "unit_price")


def q_rejected_orders(spark, sf_dir):
    """Lines left out, as published by the log row of the clean table."""
    folder = scratch(spark, "rejects")
    return _published(spark, sf_dir, last="orders_clean", rejects_path=folder).rejects().select(
        "src_ord", "order_id", "sku", "status", "qty", "reject_reason"
    )


def q_failed_step(spark, sf_dir):
    """A step that cannot be stored leaves a failure row, and the table published before stays current."""
    warehouse = Warehouse(spark, scratch(spark, "failed"))
    run_step(warehouse, "orders_raw", lambda: read_packed_pages(spark, _land_orders(spark, sf_dir, packed=True)))
    run_step(warehouse, "orders_clean", lambda: cleaning.clean_stored_orders(warehouse.read("orders_raw")))
    broken = cleaning.clean_stored_orders(warehouse.read("orders_raw")).withColumn("sku", F.when(F.col("channel") == "web", F.col("sku")))
    with contextlib.suppress(ValueError):
        run_step(warehouse, "orders_clean", lambda: broken)
    kept = warehouse.read("orders_clean").agg(F.count(F.lit(1)).alias("stored_rows"), F.count_if(F.col("sku").isNull()).alias("null_skus"))
    found = F.regexp_extract("error_message", "^([0-9]+) values are NULL", 1)
    failed = warehouse.runs().where("status = 'failure'").select("step_name", "rows_processed", found.cast("bigint").alias("null_keys"))
    names = ["step_name", "rows_processed", "null_keys", "stored_rows", "null_skus"]
    return failed.unionByName(kept, allowMissingColumns=True).agg(*[F.max(name).alias(name) for name in names])


def q_published_spend(spark, sf_dir):
    return _as_double(_published(spark, sf_dir, last="customer_spend_eur").read("customer_spend_eur").drop("computed_at"), "total_spent_eur")


def q_published_revenue(spark, sf_dir):
    mart = _published(spark, sf_dir).read("country_category_revenue")
    return _as_double(mart.drop("computed_at"), "total_revenue_eur")


def q_run_log(spark, sf_dir):
    runs = _published(spark, sf_dir).read("pipeline_runs")
    counters = ("raw", "test", "negative_qty", "duplicates", "unparseable_times", "required_dates", "estimated", "dates_without_rate", "lines_without_rate")
    found = [F.get_json_object("details", f"$.{name}").cast("long").alias(name) for name in counters]
    return runs.where("duration_seconds >= 0 AND run_id IS NOT NULL AND run_at IS NOT NULL").select(
        "step_name", "status", "rows_processed", "error_message", *found
    )


def q_catalog_counts(spark, sf_dir):
    warehouse = _published(spark, sf_dir)
    database = f"shop_{uuid.uuid4().hex}"
    point_tables_at(warehouse, database)
    add_column(spark, f"{database}.fx_rates", "checked", "boolean", "false")
    reports = [
        spark.table(f"{database}.{name}").agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name in list_tables(spark, database)
    ]
    return reduce(DataFrame.unionByName, reports)


def q_raw_orders_profile(spark, sf_dir):
    return quality.raw_profile(raw_orders(spark, sf_dir))


def q_raw_value_counts(spark, sf_dir):
    return quality.value_counts(raw_orders(spark, sf_dir))


def q_ts_format_classes(spark, sf_dir):
    return quality.ts_format_counts(raw_orders(spark, sf_dir))


def q_clean_order_ts(spark, sf_dir):
    return raw_orders(spark, sf_dir).select(
        position_text(), F.col("order_ts").alias("raw_ts"), parse_order_ts(F.col("order_ts")).alias("order_ts")
    )


def q_clean_sku(spark, sf_dir):
    return raw_orders(spark, sf_dir).select(
        position_text(), F.col("sku").alias("raw_sku"), canonical_sku(F.col("sku")).alias("sku")
    )


def q_clean_category(spark, sf_dir):
    raw = raw_orders(spark, sf_dir).withColumn("raw_category", F.col("category"))
    return cleaning.with_clean_columns(raw, "raw_category").select(
        position_text(), "sku", "raw_category", "category", "had_null_category"
    )


def q_quality_flags(spark, sf_dir):
    flags = ["had_null_customer", "had_null_category", "had_zero_price"]
    lines = cleaning.with_clean_columns(raw_orders(spark, sf_dir))
    return lines.groupBy(*flags).agg(F.count(F.lit(1)).alias("line_count"))


def q_reject_reasons(spark, sf_dir):
    reason = cleaning.reject_reason().alias("reject_reason")
    return raw_orders(spark, sf_dir).groupBy(reason).agg(F.count(F.lit(1)).alias("line_count"))


def q_quarantine(spark, sf_dir):
    return cleaning.quarantine(raw_orders(spark, sf_dir)).select(
        position_text(), "order_id", "sku", "status", "qty", "reject_reason"
    )


def q_cleaning_funnel(spark, sf_dir):
    return cleaning.cleaning_funnel(raw_orders(spark, sf_dir))


def q_dedup_orders(spark, sf_dir):
    lines = cleaning.with_clean_columns(cleaning.accepted(raw_orders(spark, sf_dir)))
    first = keep_first(lines.select("order_id", "sku", "src_ord"), KEYS["orders_clean"], "src_ord")
    return first.select("order_id", "sku", position_text())


def q_clean_orders(spark, sf_dir):
    return _as_double(_clean(spark, sf_dir), "unit_price")


def q_duplicate_pairs(spark, sf_dir):
    return quality.key_violations(raw_orders(spark, sf_dir), KEYS["orders_clean"])


def q_multi_item_orders(spark, sf_dir):
    return quality.multi_item_orders(raw_orders(spark, sf_dir))


def q_insert_ignore(spark, sf_dir):
    lines = cleaning.with_clean_columns(cleaning.accepted(raw_orders(spark, sf_dir)))
    keys = KEYS["orders_clean"]
    existing = keep_first(lines.where("channel = 'web'"), keys, "src_ord")
    return insert_ignore(existing, lines.select(*keys, "src_ord"), keys, "src_ord").select(*keys, position_text())


def q_required_fx_dates(spark, sf_dir):
    return rates.required_dates(_clean(spark, sf_dir))


def q_fx_request_range(spark, sf_dir):
    return rates.request_range(rates.required_dates(_clean(spark, sf_dir)), TODAY)


def q_fx_documents(spark, sf_dir):
    documents = fx_documents(source_rates(rates.required_dates(_clean(spark, sf_dir))))
    parsed = documents.select("document", F.from_json("content", FX_DOCUMENT, {"mode": "FAILFAST"}).alias("doc"))
    return _as_double(decode_fx_documents(parsed.select("document", "doc.*")), "rate")


def q_fx_gap_filled(spark, sf_dir):
    return _as_double(_rates_of(_dates(spark, sf_dir)), "rate")


def _refund_dates(clean: DataFrame) -> DataFrame:
    return staged(rates.required_dates(clean.where("status = 'refunded'")), "refund_dates")


def q_fx_gap_filled_asof(spark, sf_dir):
    clean = staged(_clean(spark, sf_dir).select("status", "fx_reference_date"), "clean_dates")
    offered = source_rates(rates.required_dates(clean))
    return _as_double(rates.daily_rates(_refund_dates(clean), offered, TODAY, seed="asof"), "rate")


def q_fx_upsert(spark, sf_dir):
    clean = staged(_clean(spark, sf_dir).select("status", "fx_reference_date"), "clean_dates")
    dates = staged(rates.required_dates(clean), "required_dates")
    existing = rates.daily_rates(dates, source_rates(dates, EARLIER_TODAY), EARLIER_TODAY)
    batch = rates.daily_rates(_refund_dates(clean), source_rates(dates), TODAY)
    return _as_double(upsert(staged(existing, "fx_rates"), staged(batch, "rate_batch"), KEYS["fx_rates"]), "rate")


def q_fx_coverage_gaps(spark, sf_dir):
    return rates.coverage_gaps(*_stored(spark, sf_dir, "fx_reference_date"))


def q_fx_coverage_labels(spark, sf_dir):
    dates = _dates(spark, sf_dir)
    return _as_double(rates.rate_labels(dates, _rates_of(dates), source_rates(dates)), "rate")


def q_order_lines_eur(spark, sf_dir):
    amount = line_amount(F.col("qty"), F.col("unit_price")).cast("double").alias("amount")
    return marts.order_lines_eur(*_stored(spark, sf_dir, *_AMOUNT, "sku")).select(
        "order_id", "sku", "currency", amount, F.col("rate").cast("double").alias("rate"), _rounded_eur()
    )


def q_primary_country(spark, sf_dir):
    return marts.primary_country(_clean(spark, sf_dir))


def q_multi_country_customers(spark, sf_dir):
    return marts.multi_country_customers(_clean(spark, sf_dir))


def q_latest_order_date(spark, sf_dir):
    return marts.latest_order_date(_clean(spark, sf_dir))


def q_customer_spend(spark, sf_dir):
    return _as_double(marts.by_spend(marts.customer_spend(*_stored(spark, sf_dir, *_SPEND))), "total_spent_eur")


def q_top_customers(spark, sf_dir):
    return _as_double(marts.top_customers(marts.customer_spend(*_stored(spark, sf_dir, *_SPEND))), "total_spent_eur")


def _revenue(spark, sf_dir, **options):
    mart = marts.country_revenue(*_stored(spark, sf_dir, *_REVENUE), **options)
    return _as_double(marts.by_revenue(mart), "total_revenue_eur")


def q_country_revenue(spark, sf_dir):
    return _revenue(spark, sf_dir)


def q_country_revenue_threshold(spark, sf_dir):
    return _revenue(spark, sf_dir, threshold=CUTTING_THRESHOLD_EUR)


def q_country_revenue_all(spark, sf_dir):
    return _revenue(spark, sf_dir, threshold=None)


def q_price_anomalies(spark, sf_dir):
    return quality.price_anomalies(*_stored(spark, sf_dir, *_AMOUNT, "sku"), ANOMALY_LIMIT_EUR).select(
        "order_id", "sku", F.col("unit_price").cast("double").alias("unit_price"), "qty", "currency", _rounded_eur()
    )


def _all_stored(spark, sf_dir) -> dict[str, DataFrame]:
    """Every constrained table, as far as keys and marts read it; raw lines are not written, as deriving their keys again takes less."""
    raw = raw_orders(spark, sf_dir)
    clean = staged(cleaning.clean_orders(raw).select(*dict.fromkeys((*KEYS["orders_clean"], *_SPEND, *_REVENUE))), "orders_clean")
    fx = staged(_rates_of(rates.required_dates(clean)), "fx_rates")
    return {
        "raw_orders": raw,
        "clean": clean,
        "rates": fx,
        "customer_spend": staged(marts.customer_spend(clean, fx), "customer_spend"),
        "country_revenue": staged(marts.country_revenue(clean, fx, threshold=None), "country_revenue"),
    }


CHECKED_KEYS = {
    "raw_orders": KEYS["orders_clean"],
    "clean": KEYS["orders_clean"],
    "rates": KEYS["fx_rates"],
    "customer_spend": KEYS["customer_spend_eur"],
    "country_revenue": KEYS["country_category_revenue"],
}


def q_key_violations(spark, sf_dir):
    return quality.repeated_keys({name: (df, CHECKED_KEYS[name]) for name, df in _all_stored(spark, sf_dir).items()})


def q_null_violations(spark, sf_dir):
    """NULLs as counted when the tables were written, from the run log.

    Raw lines are written once, as the table that is checked; the clean step shuffles whole lines only where a key may repeat.
    """
    warehouse = Warehouse(spark, scratch(spark, "nulls"))
    raw = stored_raw_orders(spark, sf_dir)
    run_step(warehouse, "orders_raw", lambda: raw.withColumn("src_ord", F.xxhash64("src_ord")))
    run_step(warehouse, "orders_clean", lambda: cleaning.clean_stored_orders(raw))
    clean = warehouse.read("orders_clean")
    run_step(warehouse, "fx_rates", lambda: _rates_of(rates.required_dates(clean)))
    fx = warehouse.read("fx_rates")
    run_step(warehouse, "customer_spend_eur", lambda: marts.customer_spend(clean, fx))
    run_step(warehouse, "country_category_revenue", lambda: marts.country_revenue(clean, fx, threshold=None))
    return warehouse.null_counts()


def _pair_lines(spark, sf_dir) -> DataFrame:
    """Clean lines with a second foreign currency, that of the Hungarian shop."""
    currency = F.when(F.col("country") == "HU", "HUF").otherwise(F.col("currency")).alias("currency")
    names = ("order_id", "sku", "country", "currency", "fx_reference_date")
    return staged(_clean(spark, sf_dir).select(*names).withColumn("currency", currency), "pair_lines")


def _pair_rates(pairs: DataFrame) -> DataFrame:
    """Source rates of the pairs: every business day for RON, Mondays and Thursdays for HUF."""
    ron = source_rates(pairs.where("target_currency = 'RON'"))
    huf = pairs.where("target_currency = 'HUF' AND weekday(rate_date) IN (0, 3)").where(F.col("rate_date") <= TODAY).selectExpr(
        "rate_date", "base_currency", "target_currency", "CAST(300 + day(rate_date) % 13 AS DECIMAL(12, 6)) AS rate"
    )
    return ron.unionByName(huf)


def q_fx_pairs_filled(spark, sf_dir):
    pairs = staged(rates.required_pairs(_pair_lines(spark, sf_dir)), "pairs")
    return _as_double(rates.daily_pair_rates(pairs, _pair_rates(pairs), TODAY), "rate")


def q_order_lines_by_pair(spark, sf_dir):
    lines = _pair_lines(spark, sf_dir)
    pairs = staged(rates.required_pairs(lines), "pairs")
    filled = staged(rates.daily_pair_rates(pairs, _pair_rates(pairs), TODAY), "pair_rates")
    return _as_double(with_pair_rate(lines, filled).drop("country"), "rate")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name.removeprefix("q_"): query for name, query in globals().items() if name.startswith("q_")}

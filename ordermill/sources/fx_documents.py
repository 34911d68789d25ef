"""Landed exchange-rate documents: {"base": .., "rates": {date: {currency: rate}}}."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import FX_DOCUMENT


def read_fx_documents(spark: SparkSession, path: str, base: str = "EUR", target: str = "RON") -> DataFrame:
    """Rates of one currency pair from every document under `path`.

    Documents may overlap, as daily requests for a sliding range do; the one that reaches the
    latest end date wins, then the last by name.
    """
    return decode_fx_documents(_documents(spark, path), base, target)


def read_fx_pairs(spark: SparkSession, path: str) -> DataFrame:
    """Rates of every currency pair in the documents under `path`; overlaps as in `read_fx_documents`."""
    return decode_fx_pairs(_documents(spark, path))


def _documents(spark: SparkSession, path: str) -> DataFrame:
    return (
        spark.read.schema(FX_DOCUMENT)
        .option("multiLine", True)
        .option("mode", "FAILFAST")
        .option("recursiveFileLookup", True)
        .json(path)
        .withColumn("document", F.col("_metadata.file_path"))
    )


def decode_fx_pairs(documents: DataFrame, base: str = "EUR") -> DataFrame:
    """Documents (with a `document` name) of any base, `base` where none is stated, to the rates of all their pairs.

    Of the documents that quote a pair on a date the one with the latest end date wins, then the last by name.
    """
    days = documents.select(
        F.coalesce("base", F.lit(base)).alias("base_currency"),
        F.struct("end_date", "document").alias("age"),
        F.explode("rates").alias("day", "quotes"),
    )
    quotes = days.select("base_currency", "age", F.to_date("day").alias("rate_date"), F.explode("quotes").alias("target_currency", "rate"))
    return (
        quotes.where(F.col("rate").isNotNull())
        .groupBy("rate_date", "base_currency", "target_currency")
        .agg(F.max_by("rate", "age").alias("rate"))
    )


def decode_fx_documents(documents: DataFrame, base: str = "EUR", target: str = "RON") -> DataFrame:
    """Documents (with a `document` name) to `rate_date, base_currency, target_currency, rate`.

    Dates without trading are simply absent. A date without the target currency, or a document
    with another base, stops the read.
    """
    stated_base = F.coalesce("base", F.lit(base))
    days = documents.select(
        F.when(stated_base == base, stated_base)
        .otherwise(F.raise_error(F.concat(F.lit("unexpected base currency "), stated_base)).cast("string"))
        .alias("base_currency"),
        F.struct("end_date", "document").alias("age"),
        F.explode("rates").alias("day", "quotes"),
    )
    quote = F.try_element_at("quotes", F.lit(target))
    return (
        days.select(
            F.to_date("day").alias("rate_date"),
            "base_currency",
            "age",
            F.coalesce(
                quote, F.raise_error(F.concat(F.lit(f"no {target} rate on "), F.col("day"))).cast("decimal(12,6)")
            ).alias("rate"),
        )
        .groupBy("rate_date", "base_currency")
        .agg(F.max_by("rate", "age").alias("rate"))
        .select("rate_date", "base_currency", F.lit(target).alias("target_currency"), "rate")
    )


def in_request_range(rates: DataFrame, first: dt.date | None, last: dt.date) -> DataFrame:
    """Rates the source would return for a request up to `last`, from `first` if there is one."""
    until = rates.where(F.col("rate_date") <= last)
    return until if first is None else until.where(F.col("rate_date") >= first)

"""Exchange rates for the reference dates of clean orders."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import fill_gaps, fill_pair_gaps
from ..sources.fx_documents import in_request_range


def required_dates(clean: DataFrame) -> DataFrame:
    """Distinct reference dates; each task sends a date once."""
    return (
        clean.where(F.col("fx_reference_date").isNotNull()).select(F.col("fx_reference_date").alias("rate_date")).distinct()
    )


def request_range(dates: DataFrame, today: dt.date) -> DataFrame:
    """One row: the first required date, and the last one that is not in the future."""
    return dates.agg(
        F.min("rate_date").alias("first_date"), F.least(F.max("rate_date"), F.lit(today)).alias("last_date")
    )


def daily_rates(
    dates: DataFrame,
    rates: DataFrame,
    today: dt.date,
    base: str = "EUR",
    target: str = "RON",
    seed: str = "required",
) -> DataFrame:
    """Rates for all required dates, from the source rates up to `today`.

    Rates before the first required date or after the last one change nothing, so their range
    is not looked up.
    """
    return fill_gaps(dates, in_request_range(rates, None, today), today, base, target, seed)


def required_pairs(clean: DataFrame, base: str = "EUR") -> DataFrame:
    """Distinct reference dates of each currency that is not `base`, as pairs from `base`; each task sends one once."""
    other = clean.where(F.col("fx_reference_date").isNotNull() & (F.col("currency") != base))
    return other.select(
        F.col("fx_reference_date").alias("rate_date"), F.lit(base).alias("base_currency"), F.col("currency").alias("target_currency")
    ).distinct()


def daily_pair_rates(pairs: DataFrame, rates: DataFrame, today: dt.date, seed: str = "required") -> DataFrame:
    """Rates for all required dates of all pairs, from the source rates up to `today`."""
    return fill_pair_gaps(pairs, in_request_range(rates, None, today), today, seed)


def require_dates(clean: DataFrame) -> None:
    """Error unless some clean order has a reference date."""
    if clean.where(F.col("fx_reference_date").isNotNull()).select("fx_reference_date").isEmpty():
        raise ValueError("no clean order has a reference date, so there is no range to request rates for")


def rate_labels(dates: DataFrame, rates: DataFrame, source_rates: DataFrame) -> DataFrame:
    """How each required date got its rate: real, carried, estimated or missing.

    `rates` and `source_rates` hold one currency pair.
    """
    own = source_rates.select("rate_date", F.lit(True).alias("is_own"))
    return (
        dates.join(rates.select("rate_date", "rate", "is_estimated"), "rate_date", "left")
        .join(own, "rate_date", "left")
        .select(
            "rate_date",
            "rate",
            F.when(F.col("rate").isNull(), "missing")
            .when(F.col("is_estimated"), "estimated")
            .when(F.col("is_own"), "real")
            .otherwise("carried")
            .alias("label"),
        )
    )


def coverage_gaps(clean: DataFrame, rates: DataFrame, base: str = "EUR", target: str = "RON") -> DataFrame:
    """Reference dates, NULL included, that have no rate, with the lines the marts lose for it.

    Lines are counted per date before the anti join, so the join sees one row per date.
    """
    pair = rates.where((F.col("base_currency") == base) & (F.col("target_currency") == target))
    per_date = clean.groupBy("fx_reference_date").agg(F.count(F.lit(1)).alias("lines"))
    return per_date.join(pair, F.col("fx_reference_date") == F.col("rate_date"), "left_anti")

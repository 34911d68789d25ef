"""A rate for every required date."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def fill_gaps(
    dates: DataFrame,
    rates: DataFrame,
    today: dt.date,
    base: str = "EUR",
    target: str = "RON",
    seed: str = "required",
) -> DataFrame:
    """Carry the last known rate forward over required dates that have none of their own.

    `dates` has `rate_date`; `rates` has `rate_date, base_currency, target_currency, rate`. A date
    after `today` without a rate is an estimate; a past one is not. Dates before the first known
    rate are left out. With seed="required" only rates on required dates are carried; with
    seed="asof" any earlier rate is, so a Friday rate reaches a leading weekend.

    The window runs over one row per calendar day, a size set by the calendar and not by the
    number of orders.
    """
    if seed not in ("required", "asof"):
        raise ValueError(f"seed must be 'required' or 'asof', not {seed!r}")
    known = rates.where((F.col("base_currency") == base) & (F.col("target_currency") == target)).select(
        "rate_date", F.col("rate").alias("own_rate")
    )
    required = dates.select("rate_date").distinct().withColumn("is_required", F.lit(True))
    days = required.join(known, "rate_date", "left" if seed == "required" else "full")
    so_far = Window.orderBy("rate_date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        days.withColumn("rate", F.last("own_rate", ignorenulls=True).over(so_far))
        .where(F.col("is_required") & F.col("rate").isNotNull())
        .select(
            "rate_date",
            F.lit(base).alias("base_currency"),
            F.lit(target).alias("target_currency"),
            "rate",
            (F.col("own_rate").isNull() & (F.col("rate_date") > F.lit(today))).alias("is_estimated"),
        )
    )


def fill_pair_gaps(required: DataFrame, rates: DataFrame, today: dt.date, seed: str = "required") -> DataFrame:
    """Carry the last known rate of each currency pair forward over the dates that are required of it.

    `required` and `rates` have `rate_date, base_currency, target_currency`, `rates` also `rate`. All pairs are filled in one
    pass, each as `fill_gaps` fills its own: the window is divided by pair, and a task holds one row per day of a pair.
    """
    if seed not in ("required", "asof"):
        raise ValueError(f"seed must be 'required' or 'asof', not {seed!r}")
    keys = ["rate_date", "base_currency", "target_currency"]
    known = rates.select(*keys, F.col("rate").alias("own_rate"))
    wanted = required.select(*keys).distinct().withColumn("is_required", F.lit(True))
    days = wanted.join(known, keys, "left" if seed == "required" else "full")
    pair = Window.partitionBy("base_currency", "target_currency").orderBy("rate_date")
    so_far = pair.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        days.withColumn("rate", F.last("own_rate", ignorenulls=True).over(so_far))
        .where(F.col("is_required") & F.col("rate").isNotNull())
        .select(*keys, "rate", (F.col("own_rate").isNull() & (F.col("rate_date") > F.lit(today))).alias("is_estimated"))
    )

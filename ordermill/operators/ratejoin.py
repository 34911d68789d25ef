"""Order lines joined to the rate of their reference date."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import MONTH
from ..sources.warehouse import month_of

# 200,000 daily rates are more than 500 years, about 6 MB in memory.
BROADCAST_RATE_ROWS = 200_000


def with_rate(
    lines: DataFrame,
    rates: DataFrame,
    how: str = "inner",
    base: str = "EUR",
    target: str = "RON",
    broadcast_rows: int = BROADCAST_RATE_ROWS,
    rate_rows: int | None = None,
) -> DataFrame:
    """Add `rate` by `fx_reference_date`.

    An inner join drops lines whose date is NULL or has no rate, EUR lines too. `rates` holds one
    row per date and pair. It is broadcast only up to `broadcast_rows`; `rate_rows` is how many rows it has at
    most, and where that is not known they are counted here. Beyond that Spark shuffles both sides and AQE splits the
    partitions of busy dates.

    Lines with the column of their month (`Warehouse.read(..., with_month=True)`) are joined by month and date, so that an inner
    join with the rates of some days reads those months' files only.
    """
    pair = rates.where((F.col("base_currency") == base) & (F.col("target_currency") == target)).select(
        F.col("rate_date").alias("fx_reference_date"), "rate"
    )
    if (pair.count() if rate_rows is None else rate_rows) <= broadcast_rows:
        pair = F.broadcast(pair)
    if MONTH not in lines.columns:
        return lines.join(pair, "fx_reference_date", how)
    return lines.join(pair.withColumn(MONTH, month_of(F.col("fx_reference_date"))), [MONTH, "fx_reference_date"], how)


def with_pair_rate(
    lines: DataFrame,
    rates: DataFrame,
    how: str = "inner",
    base: str = "EUR",
    broadcast_rows: int = BROADCAST_RATE_ROWS,
    rate_rows: int | None = None,
) -> DataFrame:
    """Add `rate` from `base` to each line's own `currency` on its `fx_reference_date`.

    `rates` holds one row per date and pair, of any number of pairs. Lines in `base` have the rate 1 on every
    date; an inner join drops those in other currencies without a rate of that pair and date, and those without a currency. The rates are
    broadcast as in `with_rate`.
    """
    pairs = rates.where((F.col("base_currency") == base) & (F.col("target_currency") != base)).select(
        F.col("rate_date").alias("fx_reference_date"), F.col("target_currency").alias("currency"), F.col("rate").alias("pair_rate")
    )
    if (pairs.count() if rate_rows is None else rate_rows) <= broadcast_rows:
        pairs = F.broadcast(pairs)
    own = F.when(F.col("currency") == base, F.lit(1).cast("decimal(12,6)")).otherwise(F.col("pair_rate"))
    joined = lines.join(pairs, ["fx_reference_date", "currency"], "left").withColumn("rate", own).drop("pair_rate")
    return joined if how == "left" else joined.where("rate IS NOT NULL")

"""Spend per customer and revenue per country, in EUR."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import eur_amount, line_amount, utc_date
from ..operators import with_rate

REVENUE_CATEGORIES = ("Books", "Electronics")
REVENUE_THRESHOLD_EUR = 40_000


def eur_of_line() -> Column:
    return eur_amount(line_amount(F.col("qty"), F.col("unit_price")), F.col("currency"), F.col("rate"))


def _rated(lines: DataFrame, rates: DataFrame, rate_rows: int | None, unrated: Observation | None) -> DataFrame:
    """Lines that have a rate; `unrated` observes how many have none, in the same pass."""
    if unrated is None:
        return with_rate(lines, rates, rate_rows=rate_rows)
    missing = F.count_if(F.col("rate").isNull()).alias("lines_without_rate")
    return with_rate(lines, rates, "left", rate_rows=rate_rows).observe(unrated, missing).where("rate IS NOT NULL")


def _completed(clean: DataFrame) -> DataFrame:
    return clean.where(F.col("status") == "completed")


def _completed_of_customers(clean: DataFrame) -> DataFrame:
    return _completed(clean).where(F.col("customer_id").isNotNull())


def order_lines_eur(clean: DataFrame, rates: DataFrame) -> DataFrame:
    """Completed lines that have a rate, with their EUR value."""
    return with_rate(_completed(clean), rates).withColumn("eur", eur_of_line())


def countries_of_customer(clean: DataFrame) -> DataFrame:
    """Per customer: the country with most lines, and whether there is more than one.

    A missing country can be the most frequent one but does not count as another country. Ties go
    to the first country by name. Both answers come from the same counts per customer and country.
    """
    per_country = (
        _completed_of_customers(clean).groupBy("customer_id", "country").agg(F.count(F.lit(1)).alias("lines"))
    )
    most_lines_first = F.struct((-F.col("lines")).alias("fewer"), F.col("country").isNull().alias("unknown"), "country")
    return per_country.groupBy("customer_id").agg(
        F.min(most_lines_first)["country"].alias("country"),
        (F.count("country") > 1).alias("multiple_countries_bought"),
    )


def primary_country(clean: DataFrame) -> DataFrame:
    return countries_of_customer(clean).select("customer_id", "country")


def multi_country_customers(clean: DataFrame) -> DataFrame:
    return countries_of_customer(clean).where("multiple_countries_bought").select("customer_id")


def latest_order_date(clean: DataFrame) -> DataFrame:
    """Day of the last completed order per customer; times that could not be parsed are ignored."""
    return (
        _completed_of_customers(clean)
        .groupBy("customer_id")
        .agg(F.max(utc_date(F.col("order_ts"))).alias("last_order_date"))
    )


def customer_spend(
    clean: DataFrame, rates: DataFrame, rate_rows: int | None = None, unrated: Observation | None = None
) -> DataFrame:
    """EUR spend of known customers on completed orders that have a rate.

    Order ids are counted by customer and order first, so a customer with very many lines is
    spread over tasks; the second join side is one row per customer.
    """
    spend = (
        _rated(_completed_of_customers(clean), rates, rate_rows, unrated)
        .groupBy("customer_id", "customer_email")
        .agg(
            F.count_distinct("order_id").alias("total_orders"),
            F.sum("qty").alias("total_items"),
            F.round(F.sum(eur_of_line()), 2).alias("total_spent_eur"),
            F.max(utc_date(F.col("order_ts"))).alias("last_order_date"),
        )
    )
    return spend.join(countries_of_customer(clean), "customer_id").select(
        "customer_id",
        "customer_email",
        "country",
        "total_orders",
        "total_items",
        "total_spent_eur",
        "last_order_date",
        "multiple_countries_bought",
    )


def by_spend(mart: DataFrame) -> DataFrame:
    return mart.orderBy(F.col("total_spent_eur").desc_nulls_first())


def top_customers(mart: DataFrame, n: int = 5) -> DataFrame:
    """The `n` customers with the highest spend, ties by id; sorted within tasks, never as a whole."""
    return mart.orderBy(F.col("total_spent_eur").desc_nulls_first(), "customer_id", "customer_email").limit(n)


def country_revenue(
    clean: DataFrame,
    rates: DataFrame,
    categories: Sequence[str] = REVENUE_CATEGORIES,
    threshold: int | float | Decimal | None = REVENUE_THRESHOLD_EUR,
    rate_rows: int | None = None,
    unrated: Observation | None = None,
) -> DataFrame:
    """Revenue per country over completed lines of the categories, where the rounded total is above `threshold`.

    Lines are first combined per country and order, so four countries still use every task.
    threshold=None keeps all countries.
    """
    revenue = (
        _rated(_completed(clean).where(F.col("category").isin(*categories)), rates, rate_rows, unrated)
        .groupBy("country")
        .agg(
            F.round(F.sum(eur_of_line()), 2).alias("total_revenue_eur"),
            F.count_distinct("order_id").alias("order_count"),
        )
    )
    return revenue if threshold is None else revenue.where(F.col("total_revenue_eur") > Decimal(str(threshold)))


def by_revenue(mart: DataFrame) -> DataFrame:
    return mart.orderBy(F.col("total_revenue_eur").desc_nulls_first())

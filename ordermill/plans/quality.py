"""Checks and profiles of source and stored tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import line_amount, ts_format
from ..operators import with_rate
from ..session import staged
from .marts import eur_of_line

PROFILE_COLUMNS = ("status", "channel", "category", "currency", "country")


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row; NULL keys count as equal."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).where("row_count > 1")


def repeated_keys(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """How many keys of each table (a frame and its key columns) more than one row holds: table_name, repeated_keys.

    The keys of all tables meet in one shuffle as pairs of 64-bit hashes, with NULL keys equal. Rows that
    agree in both count as one key; where rows agree in the first only, the keys behind it are compared themselves.
    """
    hashed = [
        df.select(F.lit(name).alias("table_name"), _hash(keys).alias("h1"), _hash(keys, "again").alias("h2"))
        for name, (df, keys) in tables.items()
    ]
    groups = reduce(DataFrame.unionByName, hashed).groupBy("table_name", "h1")
    counts = groups.agg(F.count(F.lit(1)).alias("n"), F.min("h2").alias("low"), F.max("h2").alias("high")).where("n > 1")
    collide = F.col("low") != F.col("high")
    found = staged(
        counts.groupBy("table_name").agg(
            F.count_if(~collide).alias("repeated_keys"), F.collect_list(F.when(collide, F.col("h1"))).alias("colliding")
        ),
        "repeated_keys",
    )
    seen = {row.table_name: row for row in found.collect()}  # one row per table
    rows = []
    for name, (df, keys) in tables.items():
        row, again = seen.get(name), 0
        if row and row.colliding:  # two of 2**64 values agree by chance: very few, whatever the table holds
            again = key_violations(df.where(_hash(keys).isin(row.colliding)), keys).count()
        count = F.lit((row.repeated_keys if row else 0) + again).cast("bigint")
        rows.append(F.struct(F.lit(name).alias("table_name"), count.alias("repeated_keys")))
    return found.sparkSession.range(0, 1, 1, 1).select(F.inline(F.array(*rows)))


def _hash(keys: Sequence[str], *salt: str) -> Column:
    return F.xxhash64(*[F.lit(text) for text in salt], *keys, *_nulls(keys))


def _nulls(keys: Sequence[str]) -> list[Column]:
    """Which keys are NULL: a NULL leaves a hash as it is, so that (a, NULL) and (NULL, a) would agree."""
    return [F.col(name).isNull() for name in keys]


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULLs per column, all counted in one pass."""
    counts = df.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in columns])
    return counts.unpivot([], list(columns), "column_name", "null_count")


def require_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Error that names one key if any key repeats."""
    repeated = key_violations(df, keys).first()
    if repeated is not None:
        raise ValueError(f"duplicate key {repeated.asDict()}")


def raw_profile(raw: DataFrame) -> DataFrame:
    """One row that sums up the source."""
    return raw.agg(
        F.count(F.lit(1)).alias("line_count"),
        F.count_distinct("customer_id").alias("customers"),
        F.count_if(F.col("status") == "test").alias("test_lines"),
        F.count_if(F.col("qty") < 0).alias("negative_qty_lines"),
        F.count_if(F.col("customer_id").isNull()).alias("null_customer_lines"),
        F.count_if(F.col("category").isNull()).alias("null_category_lines"),
        F.count_if(F.col("unit_price") == 0).alias("zero_price_lines"),
        F.min("fx_reference_date").alias("first_fx_date"),
        F.max("fx_reference_date").alias("last_fx_date"),
    )


def value_counts(raw: DataFrame, columns: Sequence[str] = PROFILE_COLUMNS) -> DataFrame:
    """How often each value occurs in each of the columns, NULL included; one scan, combined before the shuffle."""
    return (
        raw.select(*columns)
        .unpivot([], list(columns), "column_name", "column_value")
        .groupBy("column_name", "column_value")
        .agg(F.count(F.lit(1)).alias("line_count"))
    )


def ts_format_counts(raw: DataFrame) -> DataFrame:
    return raw.groupBy(ts_format(F.col("order_ts")).alias("format")).agg(F.count(F.lit(1)).alias("line_count"))


def multi_item_orders(raw: DataFrame) -> DataFrame:
    """Orders with more than one product: several lines, but no duplicates."""
    return raw.groupBy("order_id").agg(F.count_distinct("sku").alias("skus")).where("skus > 1")


def price_anomalies(clean: DataFrame, rates: DataFrame, limit_eur: int | float) -> DataFrame:
    """Lines above `limit_eur` that need a look. EUR lines are judged even on a date without a rate."""
    amount = line_amount(F.col("qty"), F.col("unit_price"))
    return with_rate(clean, rates, "left").withColumns({"amount": amount, "eur": eur_of_line()}).where(
        F.col("eur") > Decimal(str(limit_eur))
    )

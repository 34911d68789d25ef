"""Table schemas, keys and column defaults.

Identifiers and counters are bigint, and EUR totals are decimal(28,2), so that neither overflows
on large inputs; every value a narrower type could hold fits unchanged.
"""

from __future__ import annotations

from pyspark.sql import types as T

PRICE = T.DecimalType(12, 4)
RATE = T.DecimalType(12, 6)
EUR_TOTAL = T.DecimalType(28, 2)


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


# What one order line looks like at the source. order_ts stays text: its formats are mixed.
SOURCE_ORDER = _struct(
    ("order_id", T.StringType()),
    ("customer_id", T.LongType()),
    ("customer_email", T.StringType()),
    ("order_ts", T.StringType()),
    ("status", T.StringType()),
    ("channel", T.StringType()),
    ("sku", T.StringType()),
    ("product_name", T.StringType()),
    ("category", T.StringType()),
    ("qty", T.IntegerType()),
    ("unit_price", PRICE),
    ("currency", T.StringType()),
    ("country", T.StringType()),
    ("fx_reference_date", T.DateType()),
)

FX_DOCUMENT = _struct(
    ("amount", T.DoubleType()),
    ("base", T.StringType()),
    ("start_date", T.StringType()),
    ("end_date", T.StringType()),
    ("rates", T.MapType(T.StringType(), T.MapType(T.StringType(), RATE))),
)

# src_ord is the line's position at the source; it decides which duplicate is "first".
ORDERS_RAW = T.StructType(
    [T.StructField("src_ord", T.LongType())]
    + SOURCE_ORDER.fields
    + [T.StructField("ingested_at", T.TimestampType())]
)

ORDERS_CLEAN = T.StructType(
    [
        T.StructField("order_ts", T.TimestampType()) if field.name == "order_ts" else field
        for field in SOURCE_ORDER.fields
    ]
    + _struct(
        ("had_null_customer", T.BooleanType()),
        ("had_null_category", T.BooleanType()),
        ("had_zero_price", T.BooleanType()),
        ("cleaned_at", T.TimestampType()),
    ).fields
)

FX_RATES = _struct(
    ("rate_date", T.DateType()),
    ("base_currency", T.StringType()),
    ("target_currency", T.StringType()),
    ("rate", RATE),
    ("is_estimated", T.BooleanType()),
    ("fetched_at", T.TimestampType()),
)

CUSTOMER_SPEND_EUR = _struct(
    ("customer_id", T.LongType()),
    ("customer_email", T.StringType()),
    ("country", T.StringType()),
    ("total_orders", T.LongType()),
    ("total_items", T.LongType()),
    ("total_spent_eur", EUR_TOTAL),
    ("last_order_date", T.DateType()),
    ("multiple_countries_bought", T.BooleanType()),
    ("computed_at", T.TimestampType()),
)

COUNTRY_CATEGORY_REVENUE = _struct(
    ("country", T.StringType()),
    ("total_revenue_eur", EUR_TOTAL),
    ("order_count", T.LongType()),
    ("computed_at", T.TimestampType()),
)

# published_path is where a successful step left its table; it is how readers find the current one. For a table in month
# folders published_months is a JSON object of the folder that holds each month. details is one of the step's counters, and
# null_counts one of the NULLs by column. rejects_path is where the lines left out were written along with the table.
PIPELINE_RUNS = _struct(
    ("run_id", T.StringType()),
    ("run_at", T.TimestampType()),
    ("step_name", T.StringType()),
    ("status", T.StringType()),
    ("rows_processed", T.LongType()),
    ("error_message", T.StringType()),
    ("duration_seconds", T.DecimalType(10, 2)),
    ("published_path", T.StringType()),
    ("details", T.StringType()),
    ("published_months", T.StringType()),
    ("null_counts", T.StringType()),
    ("rejects_path", T.StringType()),
)

TABLES = {
    "orders_raw": ORDERS_RAW,
    "orders_clean": ORDERS_CLEAN,
    "fx_rates": FX_RATES,
    "customer_spend_eur": CUSTOMER_SPEND_EUR,
    "country_category_revenue": COUNTRY_CATEGORY_REVENUE,
    "pipeline_runs": PIPELINE_RUNS,
}

KEYS = {
    "orders_clean": ["order_id", "sku"],
    "fx_rates": ["rate_date", "base_currency", "target_currency"],
    "customer_spend_eur": ["customer_id"],
    "country_category_revenue": ["country"],
}

# Step names in the run log, by the table the step builds.
STEP_OF_TABLE = {
    "orders_raw": "ingest",
    "orders_clean": "clean",
    "fx_rates": "fx_rates",
    "customer_spend_eur": "customer_spend_eur",
    "country_category_revenue": "country_category_revenue",
}

# Columns that must not be NULL: the keys, and what the tables declare beyond them.
REQUIRED = {**KEYS, "fx_rates": KEYS["fx_rates"] + ["rate"], "pipeline_runs": ["run_id", "step_name", "status"]}

# Tables that may be stored in month folders, and the date that decides a row's month.
MONTH_OF = {"orders_clean": "fx_reference_date", "fx_rates": "rate_date"}

# Name of the month column, `yyyy-MM`, or NO_MONTH where the date is NULL.
MONTH = "stored_month"
NO_MONTH = "none"

# Columns whose NULLs are counted as a table is written, beside those that must not have any.
COUNTED_NULLS = {
    "orders_raw": ["order_id", "customer_id", "sku", "category", "fx_reference_date"],
    "orders_clean": ["order_ts", "category"],
    "customer_spend_eur": ["country", "total_spent_eur"],
    "country_category_revenue": ["total_revenue_eur"],
}

# Column defaults as SQL text, by table (fixed values of the table definitions).
DEFAULTS = {
    "orders_raw": {"ingested_at": "current_timestamp()"},
    "orders_clean": {
        "had_null_customer": "false",
        "had_null_category": "false",
        "had_zero_price": "false",
        "cleaned_at": "current_timestamp()",
    },
    "fx_rates": {"base_currency": "'EUR'", "is_estimated": "false", "fetched_at": "current_timestamp()"},
    "customer_spend_eur": {"multiple_countries_bought": "false", "computed_at": "current_timestamp()"},
    "country_category_revenue": {"computed_at": "current_timestamp()"},
    "pipeline_runs": {"run_at": "current_timestamp()"},
}

# The stamp each stored table carries, filled when it is written.
AUDIT_COLUMN = {
    "orders_raw": "ingested_at",
    "orders_clean": "cleaned_at",
    "fx_rates": "fetched_at",
    "customer_spend_eur": "computed_at",
    "country_category_revenue": "computed_at",
}

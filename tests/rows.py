"""Small inline tables."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from ordermill.plans.cleaning import CLEAN_COLUMNS
from ordermill.schemas import FX_RATES, ORDERS_CLEAN, ORDERS_RAW
from pyspark.sql import types as T

DAY = dt.date(2026, 8, 24)

RAW_DEFAULTS = dict(
    order_id="ORD1",
    customer_id=1,
    customer_email="c1@shop.example",
    order_ts="2026-01-12T10:58:06",
    status="completed",
    channel="web",
    sku="SKU-EL-001",
    product_name="Thing",
    category="Electronics",
    qty=1,
    unit_price=Decimal("10"),
    currency="EUR",
    country="RO",
    fx_reference_date=DAY,
)

_RAW = T.StructType([f for f in ORDERS_RAW.fields if f.name != "ingested_at"])
_CLEAN = T.StructType([f for f in ORDERS_CLEAN.fields if f.name in CLEAN_COLUMNS])
_RATES = T.StructType([f for f in FX_RATES.fields if f.name != "fetched_at"])


def raw(spark: SparkSession, *changes: dict) -> DataFrame:
    """One raw line per dict of changed columns; src_ord counts up unless given."""
    rows = [{"src_ord": i, **RAW_DEFAULTS, **change} for i, change in enumerate(changes)]
    return spark.createDataFrame([tuple(row[name] for name in _RAW.names) for row in rows], _RAW)


def clean(spark: SparkSession, *changes: dict) -> DataFrame:
    """One clean line per dict; every line gets its own order unless given."""
    base = {
        **RAW_DEFAULTS,
        "order_ts": dt.datetime(2026, 1, 12, 10, 58, 6, tzinfo=dt.timezone.utc),
        "had_null_customer": False,
        "had_null_category": False,
        "had_zero_price": False,
    }
    rows = [{**base, "order_id": f"ORD{i}", **change} for i, change in enumerate(changes)]
    return spark.createDataFrame([tuple(row[name] for name in _CLEAN.names) for row in rows], _CLEAN)


def rates(spark: SparkSession, values: dict[dt.date, str], estimated: bool = False) -> DataFrame:
    rows = [(day, "EUR", "RON", Decimal(value), estimated) for day, value in values.items()]
    return spark.createDataFrame(rows, _RATES)


def dates(spark: SparkSession, *days: dt.date) -> DataFrame:
    return spark.createDataFrame([(day,) for day in days], "rate_date date")

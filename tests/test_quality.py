from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest

import rows
from ordermill.plans import quality


def test_require_unique(spark):
    lines = rows.clean(spark, dict(order_id="1"), dict(order_id="2"), dict(order_id="3", sku="b"))
    quality.require_unique(lines, ["order_id", "sku"])
    with pytest.raises(ValueError, match="duplicate key {'sku': 'SKU-EL-001', 'row_count': 2}"):
        quality.require_unique(lines, ["sku"])


def test_null_counts(spark):
    lines = rows.clean(spark, dict(sku=None), dict(sku=None, category=None), {})
    found = {row.column_name: row.null_count for row in quality.null_counts(lines, ["sku", "category", "qty"]).collect()}
    assert found == {"sku": 2, "category": 1, "qty": 0}


def test_profile(spark):
    raw = rows.raw(
        spark,
        dict(status="test"),
        dict(qty=-1, customer_id=2),
        dict(customer_id=None, category=None, currency="USD"),
        dict(unit_price=Decimal(0), fx_reference_date=dt.date(2026, 9, 1)),
    )
    assert tuple(quality.raw_profile(raw).first()) == (4, 2, 1, 1, 1, 1, 1, rows.DAY, dt.date(2026, 9, 1))
    counts = {(row.column_name, row.column_value): row.line_count for row in quality.value_counts(raw).collect()}
    assert counts[("currency", "USD")] == 1 and counts[("category", None)] == 1 and counts[("country", "RO")] == 4


def test_duplicates_and_multi_item_orders(spark):
    raw = rows.raw(spark, dict(order_id="a"), dict(order_id="a"), dict(order_id="a", sku="y"), dict(order_id="b"))
    assert [tuple(row) for row in quality.key_violations(raw, ["order_id", "sku"]).collect()] == [("a", "SKU-EL-001", 2)]
    assert [tuple(row) for row in quality.multi_item_orders(raw).collect()] == [("a", 2)]


def test_price_anomalies(spark):
    clean = rows.clean(
        spark,
        dict(order_id="big", unit_price=Decimal(999999)),
        dict(order_id="big, no rate", unit_price=Decimal(999999), fx_reference_date=None),
        dict(order_id="lei", unit_price=Decimal(50000), currency="RON"),
        dict(order_id="many", unit_price=Decimal(20), qty=501),
        dict(order_id="limit", unit_price=Decimal(10000)),
    )
    found = quality.price_anomalies(clean, rows.rates(spark, {rows.DAY: "5.25"}), 10_000).collect()
    assert {row.order_id for row in found} == {"big", "big, no rate", "many"}

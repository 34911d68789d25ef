from __future__ import annotations

import datetime as dt
from decimal import Decimal

import rows
from ordermill.plans import marts, quality

DAY = rows.DAY
OTHER_DAY = dt.date(2026, 8, 23)


def _fx(spark):
    return rows.rates(spark, {DAY: "5.25"})


def _ts(text):
    return dt.datetime.fromisoformat(text).replace(tzinfo=dt.timezone.utc)


def test_customer_spend(spark):
    clean = rows.clean(
        spark,
        dict(order_id="1", qty=2, unit_price=Decimal("10"), order_ts=_ts("2026-01-01 23:59:59")),
        dict(order_id="1", sku="y", qty=1, unit_price=Decimal("100"), currency="RON", order_ts=None),
        dict(order_id="2", country="DE", order_ts=_ts("2026-01-03 00:00:00")),
        dict(order_id="3", fx_reference_date=OTHER_DAY, country="HU"),
        dict(order_id="4", status="refunded", country="BG"),
        dict(order_id="5", customer_id=None),
        dict(order_id="6", customer_id=2, unit_price=None),
        dict(order_id="7", customer_id=3, fx_reference_date=None),
    )
    mart = marts.customer_spend(clean, _fx(spark))
    found = {row.customer_id: row.asDict() for row in mart.collect()}
    assert set(found) == {1, 2}
    assert found[1] == dict(
        customer_id=1,
        customer_email="c1@shop.example",
        country="RO",
        total_orders=2,
        total_items=4,
        total_spent_eur=Decimal("49.05"),
        last_order_date=dt.date(2026, 1, 3),
        multiple_countries_bought=True,
    )
    assert found[2]["total_spent_eur"] is None
    assert [row.customer_id for row in marts.by_spend(mart).collect()] == [2, 1]  # a missing total comes first
    assert [row.customer_id for row in marts.top_customers(mart, 1).collect()] == [2]


def test_two_emails_make_two_rows_that_the_key_check_reports(spark):
    clean = rows.clean(spark, {}, dict(customer_email="other@shop.example"))
    mart = marts.customer_spend(clean, _fx(spark))
    assert mart.count() == 2
    assert [tuple(row) for row in quality.key_violations(mart, ["customer_id"]).collect()] == [(1, 2)]


def test_primary_country(spark):
    def lines(customer, *countries):
        return [dict(customer_id=customer, country=country) for country in countries]

    clean = rows.clean(
        spark,
        *lines(1, "RO", "DE", "RO"),
        *lines(2, None, None, "RO"),
        *lines(3, "RO", "DE"),
        *lines(4, None, "RO"),
        *lines(5, None),
        dict(customer_id=6, status="refunded"),
    )
    found = {row.customer_id: (row.country, row.multiple_countries_bought) for row in marts.countries_of_customer(clean).collect()}
    assert found == {1: ("RO", True), 2: (None, False), 3: ("DE", True), 4: ("RO", False), 5: (None, False)}
    assert sorted(row[0] for row in marts.multi_country_customers(clean).collect()) == [1, 3]


def test_country_revenue_threshold_is_strict_on_the_rounded_total(spark):
    clean = rows.clean(
        spark,
        dict(country="AT", unit_price=Decimal("40000.0049")),
        dict(country="AU", unit_price=Decimal("40000.0050")),
        dict(country="RO", unit_price=Decimal("30000"), category="Books", order_id="x"),
        dict(country="RO", unit_price=Decimal("30000"), customer_id=None, order_id="x"),
        dict(country="RO", unit_price=Decimal("99999"), category="Sports"),
        dict(country="RO", unit_price=Decimal("99999"), status="refunded"),
        dict(country="RO", unit_price=Decimal("99999"), fx_reference_date=OTHER_DAY),
        dict(country="DE", unit_price=Decimal("525000"), currency="RON"),
    )
    found = [tuple(row) for row in marts.by_revenue(marts.country_revenue(clean, _fx(spark))).collect()]
    assert found == [
        ("DE", Decimal("100000.00"), 1),
        ("RO", Decimal("60000.00"), 1),
        ("AU", Decimal("40000.01"), 1),
    ]
    everything = marts.country_revenue(clean, _fx(spark), threshold=None)
    assert {row.country for row in everything.collect()} == {"AT", "AU", "DE", "RO"}
    sports = marts.country_revenue(clean, _fx(spark), categories=["Sports"], threshold="99998.99")
    assert [tuple(row) for row in sports.collect()] == [("RO", Decimal("99999.00"), 1)]


def test_totals_are_exact_beyond_double_precision(spark):
    lines = spark.range(2000).selectExpr("id", "CAST(99999999.9999 AS DECIMAL(12, 4)) AS unit_price")
    base = rows.clean(spark, {}).drop("order_id", "unit_price", "qty")
    clean = base.crossJoin(lines).selectExpr("*", "concat('o', id) AS order_id", "2000000000 AS qty")  # one-row side
    total = marts.country_revenue(clean, _fx(spark)).first().total_revenue_eur
    assert total == (Decimal("99999999.9999") * 2_000_000_000 * 2000).quantize(Decimal("0.01"))


def test_one_customer_and_one_order_with_a_third_of_all_lines(spark):
    lines = spark.range(9000).selectExpr(
        "if(id % 3 = 0, 1, id) AS customer_id", "if(id % 3 = 0, 'hot', concat('o', id)) AS order_id", "concat('s', id) AS sku"
    )
    base = rows.clean(spark, {}).drop("customer_id", "order_id", "sku")
    clean = base.crossJoin(lines)  # one-row side
    found = {row.customer_id: row for row in marts.customer_spend(clean, _fx(spark)).collect()}
    assert len(found) == 6000
    assert (found[1].total_orders, found[1].total_items) == (2, 3001)
    assert marts.country_revenue(clean, _fx(spark)).first().order_count == 6001


def test_latest_order_date(spark):
    clean = rows.clean(
        spark,
        dict(order_ts=_ts("2026-02-01 10:00:00")),
        dict(order_ts=_ts("2026-03-01 00:00:00"), status="refunded"),
        dict(customer_id=2, order_ts=None),
    )
    found = {row.customer_id: row.last_order_date for row in marts.latest_order_date(clean).collect()}
    assert found == {1: dt.date(2026, 2, 1), 2: None}

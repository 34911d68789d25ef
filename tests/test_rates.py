from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest

import rows
from ordermill.operators import fill_gaps, insert_ignore, upsert, with_rate
from ordermill.plans import rates

TODAY = dt.date(2026, 8, 26)
KEY = ["rate_date", "base_currency", "target_currency"]


def day(number: int, month: int = 8) -> dt.date:
    return dt.date(2026, month, number)


REQUIRED = [day(i) for i in range(23, 32)] + [day(i, 9) for i in range(1, 4)]
KNOWN = {day(24): "5.2504", day(25): "5.2537", day(26): "5.2568"}


def _found(df):
    return [(row.rate_date, str(row.rate.normalize()), row.is_estimated) for row in df.orderBy("rate_date").collect()]


def test_worked_example(spark):
    found = _found(fill_gaps(rows.dates(spark, *REQUIRED), rows.rates(spark, KNOWN), TODAY))
    assert found == [(d, rate, False) for d, rate in KNOWN.items()] + [(d, "5.2568", True) for d in REQUIRED[4:]]
    assert len(found) == 11


def test_rates_on_dates_nobody_asked_for(spark):
    known = rows.rates(spark, {day(21): "5.25", **KNOWN})
    dates = rows.dates(spark, *REQUIRED)
    assert _found(fill_gaps(dates, known, TODAY))[0][0] == day(24)
    asof = _found(fill_gaps(dates, known, TODAY, seed="asof"))
    assert asof[0] == (day(23), "5.25", False) and len(asof) == 12
    with pytest.raises(ValueError, match="seed"):
        fill_gaps(dates, known, TODAY, seed="other")


def test_past_and_present_gaps_are_no_estimates(spark):
    dates = rows.dates(spark, day(21), day(22), day(23), day(26), day(27), day(21))
    found = _found(fill_gaps(dates, rows.rates(spark, {day(21): "5"}), TODAY))
    assert found == [
        (day(21), "5", False),
        (day(22), "5", False),
        (day(23), "5", False),
        (day(26), "5", False),
        (day(27), "5", True),
    ]


def test_only_the_asked_pair_counts(spark):
    other = rows.rates(spark, {day(24): "9"}).selectExpr(
        "rate_date", "base_currency", "'HUF' AS target_currency", "rate", "is_estimated"
    )
    known = rows.rates(spark, {day(25): "5"}).unionByName(other)
    assert _found(fill_gaps(rows.dates(spark, day(24), day(25)), known, TODAY)) == [(day(25), "5", False)]


def test_daily_rates_ask_for_the_required_range_up_to_today(spark):
    known = rows.rates(spark, {**KNOWN, day(27): "6"})
    found = _found(rates.daily_rates(rows.dates(spark, day(24), day(27), day(28)), known, TODAY))
    assert found == [(day(24), "5.2504", False), (day(27), "5.2504", True), (day(28), "5.2504", True)]


def test_no_required_date_is_an_error(spark):
    with pytest.raises(ValueError, match="reference date"):
        rates.require_dates(rows.clean(spark, dict(fx_reference_date=None)))
    rates.require_dates(rows.clean(spark, {}))


def test_required_dates_and_range(spark):
    clean = rows.clean(spark, *[dict(fx_reference_date=d) for d in (day(24), day(30), day(24), None)])
    dates = rates.required_dates(clean)
    assert sorted(row[0] for row in dates.collect()) == [day(24), day(30)]
    assert tuple(rates.request_range(dates, TODAY).first()) == (day(24), TODAY)


def test_labels_and_gaps(spark):
    dates = rows.dates(spark, day(23), day(24), day(29), day(22, 9))
    source = rows.rates(spark, {day(24): "5"})
    filled = fill_gaps(dates, source, day(30))
    labels = {row.rate_date: row.label for row in rates.rate_labels(dates, filled, source).collect()}
    assert labels == {day(23): "missing", day(24): "real", day(29): "carried", day(22, 9): "estimated"}
    clean = rows.clean(spark, *[dict(fx_reference_date=d) for d in (day(23), day(23), day(24), None)])
    gaps = {row.fx_reference_date: row.lines for row in rates.coverage_gaps(clean, filled).collect()}
    assert gaps == {day(23): 2, None: 1}


def test_upsert(spark):
    old = rows.rates(spark, {day(24): "5", day(25): "5"}, estimated=True)
    new = rows.rates(spark, {day(25): "6", day(26): "7"})
    merged = upsert(old, new, KEY)
    assert _found(merged) == [(day(24), "5", True), (day(25), "6", False), (day(26), "7", False)]
    assert _found(upsert(merged, new, KEY)) == _found(merged)


def test_insert_ignore(spark):
    existing = spark.createDataFrame([("a", "x", 0)], "order_id string, sku string, src_ord long")
    new = spark.createDataFrame([("a", "x", 1), ("a", "y", 3), ("a", "y", 2), ("b", "x", 4)], existing.schema)
    found = insert_ignore(existing, new, ["order_id", "sku"], "src_ord").collect()
    assert sorted(map(tuple, found)) == [("a", "y", 2), ("b", "x", 4)]
    tied = new.selectExpr("order_id", "sku", "1 AS src_ord", "src_ord AS part")
    found = insert_ignore(existing, tied, ["order_id", "sku"], "src_ord", "part").collect()
    assert sorted(map(tuple, found)) == [("a", "y", 1, 2), ("b", "x", 1, 4)]


@pytest.mark.parametrize("broadcast_rows", [0, 100])
def test_both_ways_to_join_rates_agree(spark, broadcast_rows):
    lines = rows.clean(spark, *[dict(fx_reference_date=d) for d in (day(23), day(24), day(24), day(25), None)])
    rated = rows.rates(spark, KNOWN)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        inner = with_rate(lines, rated, broadcast_rows=broadcast_rows)
        plan = inner._jdf.queryExecution().executedPlan().toString()
        assert ("BroadcastHashJoin" in plan) == (broadcast_rows > 0)
        assert sorted((row.order_id, row.rate) for row in inner.collect()) == [
            ("ORD1", Decimal("5.250400")),
            ("ORD2", Decimal("5.250400")),
            ("ORD3", Decimal("5.253700")),
        ]
        assert with_rate(lines, rated, "left", broadcast_rows=broadcast_rows).count() == 5
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")

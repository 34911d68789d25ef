"""Several currency pairs in one pass, and the key check of several tables in one shuffle."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import rows
from compare import plan_of
from ordermill.operators import fill_gaps, fill_pair_gaps, with_pair_rate
from ordermill.plans import quality
from ordermill.plans.rates import daily_pair_rates, required_pairs
from ordermill.sources.fx_documents import read_fx_pairs
from test_sources import write

DAYS = [dt.date(2026, 8, 20) + dt.timedelta(days=i) for i in range(10)]
TODAY = DAYS[6]


def source(spark):
    quotes = [(DAYS[0], "EUR", "RON", 5.0), (DAYS[3], "EUR", "RON", 5.1), (DAYS[2], "EUR", "HUF", 300.0), (DAYS[5], "EUR", "HUF", 310.0)]
    return spark.createDataFrame(quotes, "rate_date date, base_currency string, target_currency string, rate double").withColumn(
        "rate", F.col("rate").cast("decimal(12,6)")
    )


@pytest.mark.parametrize("seed", ["required", "asof"])
def test_pairs_in_one_pass_equal_single_calls(spark, seed):
    wanted = {"RON": DAYS[1:], "HUF": DAYS[::2]}
    required = spark.createDataFrame(
        [(day, "EUR", target) for target, days in wanted.items() for day in days], "rate_date date, base_currency string, target_currency string"
    )
    filled = fill_pair_gaps(required, source(spark), TODAY, seed)
    single = [
        row
        for target, days in wanted.items()
        for row in fill_gaps(rows.dates(spark, *days), source(spark), TODAY, target=target, seed=seed).collect()
    ]
    assert sorted(map(tuple, filled.collect())) == sorted(map(tuple, single)) and len(single) > 10
    assert "SinglePartition" not in plan_of(filled) and "hashpartitioning(base_currency" in plan_of(filled)
    with pytest.raises(ValueError, match="seed"):
        fill_pair_gaps(required, source(spark), TODAY, "none")


def test_lines_take_the_rate_of_their_own_currency(spark):
    lines = rows.clean(
        spark, dict(currency="RON", fx_reference_date=DAYS[3]), dict(currency="HUF", fx_reference_date=DAYS[3]), dict(currency="EUR", fx_reference_date=None),
        dict(currency="HUF", fx_reference_date=DAYS[0]), dict(currency=None, fx_reference_date=DAYS[3]), dict(currency="USD", fx_reference_date=DAYS[3]),
    )
    filled = daily_pair_rates(required_pairs(lines), source(spark), TODAY, seed="asof")
    expected = [("EUR", Decimal("1.000000")), ("HUF", Decimal("300.000000")), ("RON", Decimal("5.100000"))]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for limit in (100, 0):
            joined = with_pair_rate(lines, filled, broadcast_rows=limit)
            assert sorted((row.currency, row.rate) for row in joined.collect()) == expected
            assert ("BroadcastHashJoin" in plan_of(joined)) == bool(limit)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert with_pair_rate(lines, filled, "left").where("rate IS NULL").count() == 3


def test_documents_of_several_pairs(spark, tmp_path):
    write(tmp_path, "fx/1.json", {"base": "EUR", "end_date": "2026-08-20", "rates": {"2026-08-20": {"RON": 5.0, "HUF": 300.0}}})
    write(tmp_path, "fx/2.json", {"base": "EUR", "end_date": "2026-08-21", "rates": {"2026-08-20": {"RON": 5.5}, "2026-08-21": {"HUF": 301}}})
    write(tmp_path, "fx/3.json", {"base": "USD", "end_date": "2026-08-21", "rates": {"2026-08-20": {"RON": 4.5}}})
    found = sorted((row.base_currency, row.target_currency, row.rate_date.day, float(row.rate)) for row in read_fx_pairs(spark, str(tmp_path / "fx")).collect())
    assert found == [("EUR", "HUF", 20, 300.0), ("EUR", "HUF", 21, 301.0), ("EUR", "RON", 20, 5.5), ("USD", "RON", 20, 4.5)]


def tables(spark):
    pairs = spark.createDataFrame(
        [("a", None), ("a", None), (None, "a"), ("a", "b"), ("a", "b"), ("a", "b"), ("ab", "")], "x string, y string"
    )
    return {"pairs": (pairs, ["x", "y"]), "numbers": (spark.range(50), ["id"]), "none": (spark.range(0), ["id"])}


def test_repeated_keys_of_several_tables(spark):
    counts = {row.table_name: row.repeated_keys for row in quality.repeated_keys(tables(spark)).collect()}
    assert counts == {"pairs": 2, "numbers": 0, "none": 0}


@pytest.mark.parametrize("modulus", [1, 3])
def test_colliding_hashes_are_told_apart(spark, monkeypatch, modulus):
    exact = quality._hash

    def narrow(keys, *salt):
        return exact(keys, *salt) if salt else F.pmod(exact(keys), F.lit(modulus))

    monkeypatch.setattr(quality, "_hash", narrow)
    counts = {row.table_name: row.repeated_keys for row in quality.repeated_keys(tables(spark)).collect()}
    assert counts == {"pairs": 2, "numbers": 0, "none": 0}

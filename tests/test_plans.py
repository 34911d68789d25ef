"""What the physical plans must look like for large inputs."""

from __future__ import annotations

import re

import pytest

import rows
from compare import plan_of
from ordermill.plans import cleaning, marts, rates
from ordermill.session import staged


@pytest.fixture(scope="module")
def stored(spark):
    raw = staged(rows.raw(spark, {}, dict(order_id="2")), "raw")
    clean = staged(cleaning.clean_orders(raw), "clean")
    return raw, clean, staged(rows.rates(spark, {rows.DAY: "5.25"}), "rates")


def test_clean_shuffles_once_and_filters_in_the_scan(stored):
    plan = plan_of(cleaning.clean_orders(stored[0]))
    assert len(re.findall(r"Arguments: hashpartitioning", plan)) == 1
    assert "PushedFilters: [Or(IsNull(status),Not(EqualTo(status,test))), Or(IsNull(qty),GreaterThanOrEqual(qty,0))]" in plan
    assert "Python" not in plan


def test_revenue_reads_its_columns_and_broadcasts_rates(stored):
    plan = plan_of(marts.country_revenue(*stored[1:]))
    schema = re.findall(r"ReadSchema: struct<(.*)>", plan)[0]
    assert "customer" not in schema and "order_ts" not in schema and "sku" not in schema
    assert "EqualTo(status,completed), In(category, [Books,Electronics])" in plan
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    # Lines are combined per country and order before anything is gathered per country.
    assert re.search(r"hashpartitioning\(country#\d+, order_id#\d+", plan)
    assert plan.count("CASE WHEN (currency") > 0 and "Python" not in plan


def test_spend_spreads_a_busy_customer_by_order(stored):
    plan = plan_of(marts.customer_spend(*stored[1:]))
    assert re.search(r"hashpartitioning\(customer_id#\d+L, customer_email#\d+, order_id#\d+", plan)
    assert "struct<customer_id:bigint,status:string,country:string>" in plan


def test_required_dates_read_one_column(stored):
    plan = plan_of(rates.required_dates(stored[1]))
    assert "ReadSchema: struct<fx_reference_date:date>" in plan


def test_top_customers_are_not_sorted_as_a_whole(stored):
    assert "TakeOrderedAndProject" in plan_of(marts.top_customers(marts.customer_spend(*stored[1:])))

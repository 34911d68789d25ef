"""Month folders: pruned reads, appended landings, changed months of rates, and what a run publishes together."""

from __future__ import annotations

import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import rows
from compare import plan_of
from ordermill.operators import upsert, with_rate
from ordermill.plans import marts
from ordermill.plans.pipeline import appended_orders, changed_months, run_pipeline, run_step
from ordermill.schemas import KEYS, MONTH
from ordermill.sources import Warehouse, add_column, point_tables_at
from test_sources import LINE, write

JAN, FEB, MAR = dt.date(2026, 1, 15), dt.date(2026, 2, 15), dt.date(2026, 3, 15)


@pytest.fixture
def warehouse(spark, tmp_path):
    """Clean orders of two months and one without a date, and rates of two months."""
    warehouse = Warehouse(spark, str(tmp_path / "root"), by_month=True)
    lines = [dict(order_id="j", fx_reference_date=JAN), dict(order_id="f", fx_reference_date=FEB, qty=3), dict(order_id="n", fx_reference_date=None)]
    run_step(warehouse, "orders_clean", lambda: rows.clean(spark, *lines))
    run_step(warehouse, "fx_rates", lambda: rows.rates(spark, {JAN: "5", FEB: "4"}))
    return warehouse


def orders(df):
    return sorted((row.order_id, row.qty) for row in df.collect())


def files(warehouse, table, month):
    return set(warehouse.read(table, [month]).inputFiles())


def test_months_are_read_alone(spark, warehouse):
    assert orders(warehouse.read("orders_clean")) == [("f", 3), ("j", 1), ("n", 1)]
    assert sorted(warehouse.months("orders_clean")) == ["2026-01", "2026-02", "none"]
    january = warehouse.read("orders_clean", ["2026-01", "2030-12"])
    assert orders(january) == [("j", 1)]
    assert january.inputFiles() and all(f"{MONTH}=2026-01" in file for file in january.inputFiles())
    assert warehouse.read("orders_clean", ["2030-12"]).collect() == []
    assert warehouse.read("orders_clean").columns == warehouse.read("orders_clean", with_month=True).columns[:-1]
    reopened = Warehouse(spark, warehouse.root)  # a table is read as it was published
    assert orders(reopened.read("orders_clean", ["2026-02"])) == [("f", 3)]


def test_a_filter_on_rates_prunes_the_months_of_orders(warehouse):
    clean, rates = warehouse.read("orders_clean", with_month=True), warehouse.read("fx_rates")
    mart = marts.country_revenue(clean, rates.where(F.col("rate_date").between(JAN, JAN)), threshold=None)
    plan = plan_of(mart)
    assert "dynamicpruning" in plan.split("ReadSchema")[0] or f"dynamicpruningexpression({MONTH}" in plan
    assert [(row.total_revenue_eur, row.order_count) for row in mart.collect()] == [(Decimal("10.00"), 1)]
    static = plan_of(clean.where(F.col(MONTH) == "2026-02"))
    assert f"PartitionFilters: [isnotnull({MONTH}" in static and "= 2026-02)]" in static
    plain = with_rate(warehouse.read("orders_clean"), rates)
    assert orders(plain) == orders(with_rate(clean, rates)) == [("f", 3), ("j", 1)]


def test_append_adds_new_keys_and_leaves_other_months(spark, warehouse):
    before = {month: files(warehouse, "orders_clean", month) for month in warehouse.months("orders_clean")}
    landing = rows.clean(
        spark, dict(order_id="f", fx_reference_date=FEB, qty=99), dict(order_id="f2", fx_reference_date=FEB), dict(order_id="m", fx_reference_date=MAR),
        dict(order_id="j", fx_reference_date=JAN, qty=99),
    )
    assert run_step(warehouse, "orders_clean", lambda: appended_orders(warehouse, landing), keep_other_months=True) == 5
    assert orders(warehouse.read("orders_clean")) == [("f", 3), ("f2", 1), ("j", 1), ("m", 1), ("n", 1)]
    assert warehouse.row_count("orders_clean") == 5
    after = {month: files(warehouse, "orders_clean", month) for month in warehouse.months("orders_clean")}
    assert after["2026-01"] == before["2026-01"] and after["none"] == before["none"]
    assert after["2026-02"].isdisjoint(before["2026-02"]) and set(after) == {*before, "2026-03"}
    # the same landing again changes nothing
    assert run_step(warehouse, "orders_clean", lambda: appended_orders(warehouse, landing), keep_other_months=True) == 5
    assert {month: files(warehouse, "orders_clean", month) for month in after} == after


def test_a_key_in_another_month_is_found_in_all_months(spark, warehouse):
    moved = rows.clean(spark, dict(order_id="j", fx_reference_date=FEB))
    assert len(orders(appended_orders(warehouse, moved))) == 2  # looked up in February only
    assert orders(appended_orders(warehouse, moved, all_months=True)) == []


def test_the_lookup_reads_touched_months_and_filters_by_bloom(spark, warehouse):
    landing = rows.clean(spark, dict(order_id="f", fx_reference_date=FEB))
    stored = warehouse.read("orders_clean", ["2026-02"])
    limits = {
        "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1b",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    for key, value in limits.items():
        spark.conf.set(key, value)
    try:
        keys = KEYS["orders_clean"]
        landing.write.parquet(f"{warehouse.root}/landing")
        new = spark.read.parquet(f"{warehouse.root}/landing").where("qty > 0")
        known = stored.select(*keys).join(new.select(*keys), keys, "left_semi")
        assert "might_contain" in plan_of(known)
    finally:
        for key in limits:
            spark.conf.unset(key)
    assert all(f"{MONTH}=2026-02" in file for file in stored.inputFiles())
    assert appended_orders(warehouse, landing).collect() == []


def test_changed_rates_rewrite_their_months_only(spark, warehouse):
    before = {month: files(warehouse, "fx_rates", month) for month in warehouse.months("fx_rates")}
    batch = rows.rates(spark, {JAN: "5", FEB: "4.5", MAR: "6"}).withColumn("fetched_at", F.current_timestamp())
    expected = {row[:5] for row in upsert(warehouse.read("fx_rates"), batch, KEYS["fx_rates"]).collect()}
    stamps = {row.rate_date: row.fetched_at for row in warehouse.read("fx_rates").collect()}
    assert run_step(warehouse, "fx_rates", lambda: changed_months(warehouse, batch), keep_other_months=True) == 3
    stored = warehouse.read("fx_rates").collect()
    assert {row[:5] for row in stored} == expected and len(stored) == 3
    assert files(warehouse, "fx_rates", "2026-01") == before["2026-01"]
    assert files(warehouse, "fx_rates", "2026-02").isdisjoint(before["2026-02"])
    assert {row.rate_date: row.fetched_at for row in stored}[JAN] == stamps[JAN]
    assert run_step(warehouse, "fx_rates", lambda: changed_months(warehouse, batch), keep_other_months=True) == 3
    assert Warehouse(spark, warehouse.root).row_count("fx_rates") == 3


def test_a_failed_append_publishes_nothing(spark, warehouse):
    broken = rows.clean(spark, dict(order_id=None, fx_reference_date=FEB))
    with pytest.raises(ValueError, match="NULL in a required column"):
        run_step(warehouse, "orders_clean", lambda: appended_orders(warehouse, broken), keep_other_months=True)
    warehouse.refresh()
    assert orders(warehouse.read("orders_clean")) == [("f", 3), ("j", 1), ("n", 1)]
    with pytest.raises(ValueError, match="not stored in month folders"):
        Warehouse(spark, f"{warehouse.root}-flat").write_idle("orders_clean", broken, keep_other_months=True)


def test_catalog_shows_months_as_partitions(spark, warehouse):
    spark.sql("DROP DATABASE IF EXISTS months CASCADE")
    point_tables_at(warehouse, "months")
    table = spark.table("months.orders_clean")
    assert orders(table) == [("f", 3), ("j", 1), ("n", 1)]
    assert orders(table.where(f"{MONTH} = '2026-02'")) == [("f", 3)]
    assert add_column(spark, "months.orders_clean", "checked", "boolean") is True
    spark.sql("DROP DATABASE months CASCADE")
    assert len(orders(warehouse.read("orders_clean"))) == 3


def test_two_landings_through_the_pipeline(spark, tmp_path):
    def landed(name, *lines):
        write(tmp_path, f"{name}/offset=0.json", list(lines))
        write(tmp_path, "fx/1.json", {"base": "EUR", "end_date": "2026-08-26", "rates": {"2026-08-24": {"RON": 5.0}}})
        return run_pipeline(
            spark, str(tmp_path / "root"), str(tmp_path / name), str(tmp_path / "fx"), today=dt.date(2026, 8, 26),
            rejects_path=str(tmp_path / "rejects"), by_month=True, append=True, threshold=None,
        )

    assert landed("one", LINE, dict(LINE, status="test", order_id="t"))["orders_clean"] == 1
    counts = landed("two", dict(LINE, qty=99), dict(LINE, order_id="new"), dict(LINE, order_id="x", qty=-1), dict(LINE, order_id="new"))
    assert (counts["orders_raw"], counts["orders_clean"], counts["fx_rates"]) == (4, 2, 1)
    warehouse = Warehouse(spark, str(tmp_path / "root"), by_month=True)
    assert [row.reject_reason for row in warehouse.rejects().collect()] == ["negative_qty"]
    assert sorted(row.order_id for row in warehouse.read("orders_clean").collect()) == sorted([LINE["order_id"], "new"])
    details = warehouse.last_details()["clean"]
    assert details == {"raw": 4, "test": 0, "negative_qty": 1, "duplicates": 1, "unparseable_times": 0, "appended": 1}


def test_rejects_and_clean_orders_are_published_together(spark, tmp_path, monkeypatch):
    write(tmp_path, "orders/offset=0.json", [LINE, dict(LINE, order_id="t", status="test")])
    write(tmp_path, "fx/1.json", {"base": "EUR", "rates": {}})
    paths = [str(tmp_path / name) for name in ("root", "orders", "fx")]
    options = {"rejects_path": str(tmp_path / "rejects"), "last": "orders_clean"}
    assert run_pipeline(spark, *paths, **options) == {"orders_raw": 2, "orders_clean": 1}
    write(tmp_path, "orders/offset=0.json", [LINE, dict(LINE, order_id="a", qty=-1), dict(LINE, order_id="b", qty=-1)])
    log_run = Warehouse.log_run

    def broken(self, step, status, *args, **more):
        if (step, status) == ("clean", "success"):
            raise OSError("gone between write and publish")
        log_run(self, step, status, *args, **more)

    monkeypatch.setattr(Warehouse, "log_run", broken)
    with pytest.raises(OSError, match="gone"):
        run_pipeline(spark, *paths, **options)
    warehouse = Warehouse(spark, paths[0])
    assert [row.reject_reason for row in warehouse.rejects().collect()] == ["test"]  # those of the published table
    monkeypatch.undo()
    run_pipeline(spark, *paths, **options)
    assert sorted(row.order_id for row in warehouse.rejects().collect()) == ["a", "b"]


def test_a_long_log_stays_small(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    run_step(warehouse, "orders_raw", lambda: rows.raw(spark, {}))
    run_step(warehouse, "fx_rates", lambda: rows.rates(spark, {JAN: "5"}))
    for _ in range(6):
        warehouse.log_run("clean", "failure", 0, 0.1, error="no")
    assert warehouse.compact_log(most=100) is False and warehouse.compact_log(most=5) is True
    assert len(spark.read.parquet(warehouse.log_path).inputFiles()) == 1
    reopened = Warehouse(spark, str(tmp_path))
    assert reopened.runs().count() == 8 and reopened.read("orders_raw").count() == 1 and reopened.row_count("fx_rates") == 1
    reopened.log_run("clean", "failure", 0, 0.1, error="no")
    assert reopened.runs().count() == 9
    # broken off after the older rows were written: rows are in both folders
    spark.read.parquet(warehouse.log_path).write.mode("append").parquet(warehouse.old_log_path)
    assert reopened.runs().count() == 9
    # broken off while the recent folder was replaced
    spark.createDataFrame([], spark.read.parquet(warehouse.log_path).schema).write.mode("overwrite").parquet(warehouse.log_path)
    assert Warehouse(spark, str(tmp_path)).read("orders_raw").count() == 1


def test_nulls_are_counted_as_tables_are_written(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    run_step(warehouse, "orders_raw", lambda: rows.raw(spark, {}, dict(category=None), dict(category=None, customer_id=None)))
    counts = {(row.table_name, row.column_name): row.null_count for row in warehouse.null_counts().collect()}
    assert counts == {
        ("orders_raw", name): n
        for name, n in {"order_id": 0, "customer_id": 1, "sku": 0, "category": 2, "fx_reference_date": 0}.items()
    }
    assert json.loads(warehouse.runs().first().null_counts)["category"] == 2


def test_order_lines_are_not_gathered_by_month(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path), by_month=True)
    lines = rows.clean(spark, *[dict(order_id=str(n), fx_reference_date=JAN) for n in range(30)]).repartition(3)
    run_step(warehouse, "orders_clean", lambda: lines)
    assert len(files(warehouse, "orders_clean", "2026-01")) == 3 and len(orders(warehouse.read("orders_clean"))) == 30
    run_step(warehouse, "fx_rates", lambda: rows.rates(spark, {JAN: "5", JAN + dt.timedelta(1): "6"}).repartition(2))
    assert len(files(warehouse, "fx_rates", "2026-01")) == 1

from __future__ import annotations

import datetime as dt
import json
from decimal import Decimal

import pytest

import rows
from compare import plan_of
from ordermill.__main__ import main
from ordermill.plans.cleaning import cleaning_funnel
from ordermill.plans.marts import by_revenue
from ordermill.plans.pipeline import run_pipeline, run_step
from ordermill.plans.rates import coverage_gaps
from ordermill.session import input_bytes, shared_dir, shuffle_partitions_for, staged
from ordermill.sources import (
    Warehouse,
    add_column,
    create_tables,
    list_tables,
    point_tables_at,
    read_order_pages,
    read_packed_pages,
)
from test_sources import LINE, write

TODAY = dt.date(2026, 8, 26)


@pytest.fixture
def landed(tmp_path):
    def line(**changes):
        return dict(LINE, unit_price=50_000, category="Books", **changes)

    write(tmp_path, "orders/offset=0.json", [line(), line(sku="skuel001"), line(order_id="t", status="test")])
    write(
        tmp_path,
        "orders/offset=1000.json",
        [
            line(order_id="r", currency="RON", customer_id=8, fx_reference_date="2026-08-28"),
            line(order_id="n", qty=-1),
            line(order_id="g", customer_id=None, country="DE"),
        ],
    )
    write(tmp_path, "fx/1.json", {"base": "EUR", "end_date": "2026-08-26", "rates": {"2026-08-24": {"RON": 5.0}}})
    return tmp_path


def run(spark, folder, **options):
    options = {"today": TODAY, **options}
    return run_pipeline(spark, str(folder / "root"), str(folder / "orders"), str(folder / "fx"), **options)


def test_five_steps(spark, landed):
    counts = run(spark, landed, rejects_path=str(landed / "rejects"))
    assert counts == {
        "orders_raw": 6,
        "orders_clean": 3,
        "fx_rates": 2,
        "customer_spend_eur": 2,
        "country_category_revenue": 2,
    }
    warehouse = Warehouse(spark, str(landed / "root"))
    spend = {row.customer_id: row.total_spent_eur for row in warehouse.read("customer_spend_eur").collect()}
    assert spend == {7: Decimal("100000.00"), 8: Decimal("20000.00")}
    mart = by_revenue(warehouse.read("country_category_revenue"))
    revenue = [(row.country, row.total_revenue_eur, row.order_count) for row in mart.collect()]
    assert revenue == [("RO", Decimal("120000.00"), 2), ("DE", Decimal("100000.00"), 1)]
    rates = {row.rate_date: row.is_estimated for row in warehouse.read("fx_rates").collect()}
    assert rates == {dt.date(2026, 8, 24): False, dt.date(2026, 8, 28): True}
    runs = warehouse.read("pipeline_runs").orderBy("run_at").collect()
    assert [(row.step_name, row.status, row.rows_processed, row.error_message) for row in runs] == [
        ("ingest", "success", 6, None),
        ("clean", "success", 3, None),
        ("fx_rates", "success", 2, None),
        ("customer_spend_eur", "success", 2, None),
        ("country_category_revenue", "success", 2, None),
    ]
    details = {row.step_name: json.loads(row.details or "{}") for row in runs}
    assert details == {
        "ingest": {},
        "clean": {"raw": 6, "test": 1, "negative_qty": 1, "duplicates": 1, "unparseable_times": 0},
        "fx_rates": {"required_dates": 2, "rates": 2, "estimated": 1, "dates_without_rate": 0},
        "customer_spend_eur": {"lines_without_rate": 0},
        "country_category_revenue": {"lines_without_rate": 0},
    }
    funnel = {row.stage: row.removed for row in cleaning_funnel(warehouse.read("orders_raw")).collect()}
    assert [funnel[f"without_{name}"] for name in ("test", "negative_qty", "duplicates")] == [1, 1, 1]
    assert len({row.run_id for row in runs}) == 5 and all(row.duration_seconds >= 0 for row in runs)
    for table in counts:
        stamp = warehouse.read(table).columns[-1]
        assert warehouse.read(table).where(f"{stamp} IS NULL").count() == 0
    rejected = warehouse.rejects().collect()
    assert sorted((row.order_id, row.reject_reason) for row in rejected) == [("n", "negative_qty"), ("t", "test")]


def test_second_run_replaces_snapshots_and_merges_rates(spark, landed):
    run(spark, landed)
    warehouse = Warehouse(spark, str(landed / "root"))
    first = {row.rate_date: row for row in warehouse.read("fx_rates").collect()}
    assert run(spark, landed) == {
        "orders_raw": 6,
        "orders_clean": 3,
        "fx_rates": 2,
        "customer_spend_eur": 2,
        "country_category_revenue": 2,
    }
    warehouse.refresh()
    again = {row.rate_date: row for row in warehouse.read("fx_rates").collect()}
    assert [row[:5] for row in again.values()] == [row[:5] for row in first.values()]
    # Later the real rate of the 28th arrives, and no order asks for the 24th any more.
    write(landed, "orders/offset=0.json", [])
    write(landed, "orders/offset=1000.json", [dict(LINE, fx_reference_date="2026-08-28")])
    write(landed, "fx/2.json", {"base": "EUR", "end_date": "2026-08-28", "rates": {"2026-08-28": {"RON": 5.5}}})
    assert run(spark, landed, today=dt.date(2026, 8, 28), threshold=2)["orders_clean"] == 1
    warehouse.refresh()
    merged = {row.rate_date: row for row in warehouse.read("fx_rates").collect()}
    assert {d: (str(row.rate), row.is_estimated) for d, row in merged.items()} == {
        dt.date(2026, 8, 24): ("5.000000", False),
        dt.date(2026, 8, 28): ("5.500000", False),
    }
    assert merged[dt.date(2026, 8, 24)].fetched_at == again[dt.date(2026, 8, 24)].fetched_at
    assert merged[dt.date(2026, 8, 28)].fetched_at > again[dt.date(2026, 8, 28)].fetched_at


def test_failure_is_logged_stops_the_run_and_keeps_the_last_tables(spark, landed):
    run(spark, landed)
    write(landed, "orders/offset=2000.json", [dict(LINE, order_id=None)])
    with pytest.raises(ValueError, match="NULL in a required column"):
        run(spark, landed)
    warehouse = Warehouse(spark, str(landed / "root"))
    last = warehouse.read("pipeline_runs").orderBy("run_at").collect()[-1]
    assert (last.step_name, last.status, last.rows_processed, last.published_path) == ("clean", "failure", 0, None)
    assert "NULL" in last.error_message
    assert warehouse.read("orders_raw").count() == 7
    assert warehouse.read("orders_clean").count() == 3


def test_customer_with_two_emails_fails_the_spend_step(spark, landed):
    write(landed, "orders/offset=2000.json", [dict(LINE, order_id="x", customer_email="other@shop.example")])
    with pytest.raises(ValueError, match="duplicate key"):
        run(spark, landed)
    assert not Warehouse(spark, str(landed / "root")).exists("customer_spend_eur")


def test_no_orders_fail_the_rate_step(spark, tmp_path):
    write(tmp_path, "orders/offset=0.json", [])
    write(tmp_path, "fx/1.json", {"base": "EUR", "rates": {}})
    with pytest.raises(ValueError, match="reference date"):
        run(spark, tmp_path)


def test_a_failed_write_publishes_nothing(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    with pytest.raises(LookupError):
        warehouse.read("orders_raw")
    broken = rows.raw(spark, {}).selectExpr("* EXCEPT (qty)", "raise_error('gone') AS qty")
    with pytest.raises(Exception, match="gone"):
        run_step(warehouse, "orders_raw", lambda: broken)
    assert not warehouse.exists("orders_raw")
    assert run_step(warehouse, "orders_raw", lambda: rows.raw(spark, {}, {})) == 2
    # A step may read the table it replaces.
    assert run_step(warehouse, "orders_raw", lambda: warehouse.read("orders_raw").limit(1)) == 1
    assert warehouse.read("orders_raw").count() == 1


def test_catalog(spark, landed):
    run(spark, landed)
    spark.sql("DROP DATABASE IF EXISTS shop CASCADE")
    create_tables(spark, "shop", str(landed / "tables"))
    expected = ["country_category_revenue", "customer_spend_eur", "fx_rates", "orders_clean", "orders_raw", "pipeline_runs"]
    assert list_tables(spark, "shop") == expected
    spark.sql("INSERT INTO shop.fx_rates (rate_date, target_currency, rate) VALUES (DATE'2026-08-24', 'RON', 5.25)")
    row = spark.table("shop.fx_rates").first()
    assert (row.base_currency, row.is_estimated) == ("EUR", False) and row.fetched_at is not None
    create_tables(spark, "shop", str(landed / "tables"))  # again: nothing changes
    assert spark.table("shop.fx_rates").count() == 1
    assert add_column(spark, "shop.fx_rates", "checked", "boolean", "false") is True
    assert add_column(spark, "shop.fx_rates", "checked", "boolean", "false") is False
    assert spark.table("shop.fx_rates").first().checked is False
    point_tables_at(Warehouse(spark, str(landed / "root")), "shop")
    assert spark.sql("SELECT sum(total_spent_eur) FROM shop.customer_spend_eur").first()[0] == Decimal("120000.00")
    assert spark.table("shop.pipeline_runs").count() == 5
    run(spark, landed, threshold=110_000)
    point_tables_at(Warehouse(spark, str(landed / "root")), "shop")
    assert spark.table("shop.country_category_revenue").count() == 1
    spark.sql("DROP TABLE shop.orders_raw")
    spark.sql("DROP TABLE shop.pipeline_runs")
    spark.sql("DROP DATABASE shop CASCADE")
    warehouse = Warehouse(spark, str(landed / "root"))
    assert warehouse.read("pipeline_runs").count() == 10
    assert {name: warehouse.read(name).count() for name in expected if name != "pipeline_runs"} == {
        "country_category_revenue": 1,
        "customer_spend_eur": 2,
        "fx_rates": 2,
        "orders_clean": 3,
        "orders_raw": 6,
    }


def test_lines_without_a_rate_are_counted(spark, landed):
    write(landed, "orders/offset=2000.json", [dict(LINE, order_id=f"e{i}", fx_reference_date="2026-08-20", unit_price=9) for i in range(4)])
    run(spark, landed)
    warehouse = Warehouse(spark, str(landed / "root"))
    details = {row.step_name: json.loads(row.details or "{}") for row in warehouse.runs().collect()}
    gaps = coverage_gaps(warehouse.read("orders_clean"), warehouse.read("fx_rates")).collect()
    assert sum(row.lines for row in gaps) == details["customer_spend_eur"]["lines_without_rate"] == 4
    assert details["fx_rates"]["dates_without_rate"] == 1


def test_a_success_row_that_cannot_be_written_is_a_failure(spark, tmp_path, monkeypatch):
    warehouse = Warehouse(spark, str(tmp_path))
    log_run, tried = warehouse.log_run, []

    def broken(step, status, *args, **options):
        tried.append(status)
        if status == "success":
            raise OSError("log is full")
        log_run(step, status, *args, **options)

    monkeypatch.setattr(warehouse, "log_run", broken)
    with pytest.raises(OSError, match="log is full"):
        run_step(warehouse, "orders_raw", lambda: rows.raw(spark, {}))
    assert tried == ["success", "failure"]
    assert [(row.status, row.error_message) for row in warehouse.runs().collect()] == [("failure", "log is full")]
    assert not warehouse.exists("orders_raw")


def test_rejects_wait_for_their_clean_table(spark, landed):
    write(landed, "orders/offset=2000.json", [dict(LINE, order_id=None)])
    with pytest.raises(ValueError, match="NULL in a required column"):
        run(spark, landed, rejects_path=str(landed / "rejects"))
    assert not (landed / "rejects").exists()


def test_command_line_sizes_shuffles(spark, landed, capsys):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    call = [f"--orders={landed}/orders", f"--fx={landed}/fx", f"--root={landed}/root", "--today=2026-08-26"]
    try:
        main([*call, "--shuffle-partitions=3"])
        assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
        assert input_bytes(spark, f"{landed}/orders") == sum(file.stat().st_size for file in (landed / "orders").iterdir())
        main(call)
        assert spark.conf.get("spark.sql.shuffle.partitions") == str(spark.sparkContext.defaultParallelism)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert "country_category_revenue: 2 rows" in capsys.readouterr().out


def test_packed_landing_gives_the_same(spark, landed, capsys):
    pages = [(int(file.stem.split("=")[1]), file.read_text()) for file in (landed / "orders").iterdir()]
    (landed / "packed").mkdir()
    (landed / "packed/part-0").write_text("\n".join(f'{{"offset":{offset},"lines":{" ".join(page.split())}}}' for offset, page in pages))
    single = sorted(map(tuple, read_order_pages(spark, str(landed / "orders")).collect()), key=str)
    packed = read_packed_pages(spark, str(landed / "packed"))
    main(["--packed", f"--orders={landed}/packed", f"--fx={landed}/fx", f"--root={landed}/root", "--today=2026-08-26", "--shuffle-partitions=4"])
    assert "orders_clean: 3 rows (raw 6, test 1, negative_qty 1, duplicates 1" in capsys.readouterr().out
    assert single == sorted(map(tuple, packed.collect()), key=str)
    assert "wholetext" not in plan_of(packed).lower()
    (landed / "packed/part-1").write_text('{"lines":[]}')
    with pytest.raises(Exception, match="without offset"):
        read_packed_pages(spark, str(landed / "packed")).collect()


def test_a_cluster_needs_a_shared_folder():
    class Session:
        def __init__(self, master, **settings):
            self.sparkContext = type("Context", (), {"master": master})
            self.conf = type("Conf", (), {"get": staticmethod(lambda key, *default: settings.get(key, *default))})

    own, key = {"spark.sql.warehouse.dir": "file:/home/x/spark-warehouse"}, "spark.checkpoint.dir"
    assert shared_dir(Session("local[4]", **own)) == "file:/home/x/spark-warehouse/_shared"
    assert shared_dir(Session("yarn", **own, **{key: "s3a://b/shared/"})) == "s3a://b/shared"
    assert shared_dir(Session("yarn", **{"spark.sql.warehouse.dir": "s3a://b/wh"})) == "s3a://b/wh/_shared"
    for master in ("yarn", "local-cluster[2,1,1024]", "spark://host:7077"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_dir(Session(master, **own))


def test_shared_folder_and_sizes(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    stored = staged(spark.range(5), "numbers")
    assert all(f"{shared_dir(spark)}/ordermill-numbers-" in file for file in stored.inputFiles())
    assert stored.count() == 5
    assert shuffle_partitions_for(0, 8) == 8
    assert shuffle_partitions_for(100 * 1024**4, 8) == 819_200

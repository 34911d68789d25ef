"""What is shuffled and written for landings and the clean table: numbers, compressed text and lines whose key may repeat."""

from __future__ import annotations

import re
from pathlib import Path

import pytest
from compare import plan_of
from conftest import SF_DIR
from ordermill.fixtures import orders as fixture_orders
from ordermill.fixtures import queries as fixture_queries
from ordermill.fixtures.orders import dates_of_lines, order_pages, page_count, raw_orders, source_pages, source_rates
from ordermill.fixtures.queries import _all_stored, _land_orders, _land_rates, _published, q_required_fx_dates
from ordermill.operators import keyed, unknown_keys
from ordermill.plans import cleaning, rates
from ordermill.plans.pipeline import appended_orders
from ordermill.session import staged
from ordermill.sources import Warehouse, read_fx_documents, read_packed_pages
from pyspark.sql import functions as F


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_pages_are_dealt_as_numbers(spark):
    pages = source_pages(spark, SF_DIR, "channel = 'web'")
    below = _plan(pages).split("RepartitionByExpression [page_offset")[1]
    assert "ORD" not in below and "@shop.example" not in below
    assert "% 3) = 0" in below  # the filter comes before the shuffle
    lines = raw_orders(spark, SF_DIR).where("channel = 'web'")
    assert sorted(pages.collect()) == sorted(order_pages(lines, page_count(spark, SF_DIR)).collect())


def test_landed_pages_are_compressed(spark):
    for packed in (True, False):
        folder = Path(_land_orders(spark, SF_DIR, packed=packed).removeprefix("file:"))
        files = list(folder.rglob("part-*"))
        assert files and all(file.name.endswith(".gz") for file in files)


def test_landed_rates_need_no_order_pages(spark):
    folder = _land_rates(spark, SF_DIR)
    found = {row.rate_date for row in read_fx_documents(spark, folder).collect()}
    business = q_required_fx_dates(spark, SF_DIR).where("weekday(rate_date) < 5 AND rate_date <= '2001-06-30'")
    assert found == {row.rate_date for row in business.collect()}


def test_lines_with_a_key_of_their_own_are_not_shuffled(spark):
    raw = staged(raw_orders(spark, SF_DIR), "raw")
    odd = raw.limit(4)
    nulls = odd.withColumn("order_id", F.lit(None).cast("string")).unionByName(odd.withColumn("sku", F.lit(None).cast("string")))
    raw = staged(raw.unionByName(nulls).unionByName(nulls.withColumn("qty", F.lit(3))), "raw")
    clean = cleaning.clean_stored_orders(raw)
    assert clean.columns == cleaning.CLEAN_COLUMNS
    first = cleaning.clean_orders(raw.where("order_id IS NOT NULL AND sku IS NOT NULL"))
    keyed = clean.where("order_id IS NOT NULL AND sku IS NOT NULL")
    assert keyed.exceptAll(first).isEmpty() and first.exceptAll(keyed).isEmpty()
    assert clean.count() == cleaning.clean_orders(raw).count()
    marked = cleaning._repeated_keys(raw)
    lines = cleaning._with_mark(raw, marked)
    repeated = lines.where("may_repeat").count()
    per_key = lines.groupBy("order_id", cleaning.canonical_sku(F.col("sku")).alias("sku")).agg(F.count(F.lit(1)).alias("n"), F.bool_and("may_repeat").alias("m"))
    assert per_key.where("n > 1 AND NOT m").isEmpty()
    assert 0 < repeated < 0.1 * lines.count()


def test_bits_may_be_shared(spark, monkeypatch):
    monkeypatch.setattr(cleaning, "SLOTS", 64)
    raw = staged(raw_orders(spark, SF_DIR), "raw")
    clean, first = cleaning.clean_stored_orders(raw), cleaning.clean_orders(raw)
    assert clean.exceptAll(first).isEmpty() and first.exceptAll(clean).isEmpty()


def test_refreshed_rates_do_not_land_orders_again(spark):
    warehouse = _published(spark, SF_DIR, again=True, last="fx_rates")
    runs = {row.step_name: row["count"] for row in warehouse.runs().groupBy("step_name").count().collect()}
    assert runs == {"ingest": 1, "clean": 1, "fx_rates": 2}


def test_key_check_writes_no_raw_lines_and_what_is_read_of_clean_ones(spark):
    tables = _all_stored(spark, SF_DIR)
    assert {name.rpartition("/")[2] for name in tables["raw_orders"].inputFiles()} == {"lineitem.parquet", "orders.parquet"}
    assert not {"product_name", "channel", "had_zero_price"} & set(tables["clean"].columns)


def test_dates_shuffle_order_keys_only(spark):
    plan = _plan(dates_of_lines(spark, SF_DIR, lambda lines: cleaning.accepted(lines.where("channel = 'web'"))))
    keys = re.search(r"Aggregate \[(o_orderkey#\d+L)\], \[(.*)\]", plan.split("LeftSemi")[1])
    assert keys and keys[1] == keys[2]


@pytest.mark.parametrize("most", [keyed.MARKED_BLOCKS, 0])
def test_lines_are_not_shuffled_to_leave_out_known_keys(spark, monkeypatch, most):
    monkeypatch.setattr(keyed, "MARKED_BLOCKS", most)
    keys = ["order_id", "sku"]
    raw = raw_orders(spark, SF_DIR)
    new = cleaning.clean_orders(raw)
    odd = new.limit(2).withColumn("sku", F.lit(None).cast("string"))
    new = staged(new.unionByName(odd).repartition(5), "new")
    stored = staged(new.where("channel = 'web'"), "stored")
    fresh = unknown_keys(stored, new, keys)
    expected = new.join(stored.select(*keys), keys, "left_anti").select(*new.columns)
    assert fresh.columns == new.columns and expected.count() > 0
    assert fresh.exceptAll(expected).isEmpty() and expected.exceptAll(fresh).isEmpty()
    if most:
        assert "hashpartitioning" not in plan_of(fresh)


def test_first_landing_is_written_as_it_comes(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path), by_month=True)
    lines = cleaning.clean_orders(raw_orders(spark, SF_DIR))
    assert appended_orders(warehouse, lines) is lines


def test_what_follows_from_a_line_is_not_shuffled(spark):
    below = _plan(source_pages(spark, SF_DIR)).split("RepartitionByExpression [page_offset")[1]
    assert "Join Inner" in below and "Generate" not in below and not re.search(r"AS (n|copy)#", below)


def test_dates_of_landed_lines_are_noted_as_pages_are_written(spark, monkeypatch):
    where = "channel = 'web' AND customer_id % 3 = 0"
    raw = cleaning.accepted(raw_orders(spark, SF_DIR).where(where))
    wanted = {row[0] for row in source_rates(rates.required_dates(raw)).select("rate_date").collect()}
    monkeypatch.setattr(fixture_queries, "dates_of_lines", None)
    _, folder = fixture_queries._land(spark, SF_DIR, packed=True, where=where)
    assert {row.rate_date for row in read_fx_documents(spark, folder).collect()} == wanted


def test_nothing_lands_without_lines(spark):
    orders, folder = fixture_queries._land(spark, SF_DIR, packed=True, where="channel = 'none'")
    assert not [file for file in Path(folder.removeprefix("file:")).rglob("part-*") if file.stat().st_size]
    assert read_packed_pages(spark, orders).isEmpty()


def test_marks_are_rows_of_words(spark):
    raw = staged(raw_orders(spark, SF_DIR), "raw")
    marked = cleaning._repeated_keys(raw)
    assert marked.where(F.size("words") != cleaning.WORDS).isEmpty()
    slots = cleaning.accepted(raw).select(cleaning._slot().alias("slot"))
    assert slots.where(f"slot < 0 OR slot >= {1 << 40}").isEmpty()
    repeated = slots.groupBy("slot").count().where("count > 1").select(F.col("slot").bitwiseAND(F.lit(cleaning.SLOTS - 1))).distinct()
    bits = marked.select(F.explode("words").alias("word")).agg(F.sum(F.bit_count("word"))).first()[0]
    assert bits == repeated.count() > 0


def test_null_check_writes_raw_lines_once_and_numbers_in_small_files(spark, monkeypatch):
    monkeypatch.setattr(fixture_orders, "NUMBERS_PER_FILE", 1000)
    raw = fixture_orders.stored_raw_orders(spark, SF_DIR)
    assert len(raw.inputFiles()) >= 6
    lines = raw_orders(spark, SF_DIR)
    assert raw.schema == lines.schema and raw.exceptAll(lines).isEmpty() and lines.exceptAll(raw).isEmpty()
    written = []
    monkeypatch.setattr(fixture_queries, "staged", lambda df, name: written.append(name) or staged(df, name))
    counts = {tuple(row) for row in fixture_queries.q_null_violations(spark, SF_DIR).collect()}
    assert written == []
    for name in ("sku", "category", "customer_id"):
        assert ("orders_raw", name, lines.where(F.col(name).isNull()).count()) in counts
    unparsed = cleaning.clean_orders(lines).where("order_ts IS NULL").count()
    assert ("orders_clean", "order_ts", unparsed) in counts

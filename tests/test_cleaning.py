from __future__ import annotations

from decimal import Decimal

import rows
from ordermill.plans import cleaning


def _ids(df):
    return sorted((row.order_id, row.sku, row.qty) for row in df.collect())


def test_exclusion_keeps_missing_values(spark):
    raw = rows.raw(
        spark,
        dict(order_id="test", status="test"),
        dict(order_id="Test", status="Test"),
        dict(order_id="minus", qty=-1),
        dict(order_id="minus refunded", qty=-1, status="refunded"),
        dict(order_id="minus test", qty=-1, status="test"),
        dict(order_id="no qty", qty=None),
        dict(order_id="no qty no status", qty=None, status=None),
        dict(order_id="zero", qty=0),
        dict(order_id="no status", status=None),
    )
    kept = {row.order_id for row in cleaning.clean_orders(raw).collect()}
    assert kept == {"Test", "no qty", "no qty no status", "zero", "no status"}
    reasons = {row.order_id: row.reject_reason for row in cleaning.quarantine(raw).collect()}
    assert reasons == {
        "test": "test",
        "minus test": "test",
        "minus": "negative_qty",
        "minus refunded": "negative_qty",
    }


def test_first_line_per_order_and_canonical_sku(spark):
    raw = rows.raw(
        spark,
        dict(order_id="a", sku="SKU-EL-001", qty=2, src_ord=7),
        dict(order_id="a", sku="skuel001", qty=1, src_ord=3),
        dict(order_id="a", sku="SKU-EL-002", qty=3, src_ord=1),
        dict(order_id="b", qty=9, status="test", src_ord=10),
        dict(order_id="b", qty=4, src_ord=11),
        dict(order_id=None, sku=None, qty=5, src_ord=20),
        dict(order_id=None, sku=None, qty=6, src_ord=19),
    )
    found = {(row.order_id, row.sku): row.qty for row in cleaning.clean_orders(raw).collect()}
    assert found == {("a", "SKU-EL-001"): 1, ("a", "SKU-EL-002"): 3, ("b", "SKU-EL-001"): 4, (None, None): 6}


def test_result_does_not_depend_on_row_placement(spark):
    raw = rows.raw(spark, *[dict(order_id=f"o{i % 40}", sku=f"SKU-EL-00{i % 3}", qty=i) for i in range(300)])
    expected = _ids(cleaning.clean_orders(raw))
    assert expected == _ids(cleaning.clean_orders(raw.repartition(7, "qty").orderBy("qty", ascending=False)))


def test_flags_and_category(spark):
    raw = rows.raw(
        spark,
        dict(order_id="1", sku="SKUEL001", category=None),
        dict(order_id="2", sku="SKU-BE-001", category="Sports"),
        dict(order_id="3", sku="SKU-ZZ-001", category=None),
        dict(order_id="4", sku="SKU-BK-001", category=""),
        dict(order_id="5", sku=None, category=None),
        dict(order_id="6", customer_id=None, unit_price=Decimal(0)),
        dict(order_id="7", unit_price=None),
        dict(order_id="8", order_ts="garbage", unit_price=Decimal(999999)),
    )
    found = {int(row.order_id): row for row in cleaning.clean_orders(raw).collect()}
    assert [(found[i].category, found[i].had_null_category) for i in range(1, 6)] == [
        ("Electronics", True),
        ("Sports", False),
        (None, False),
        ("", False),
        (None, False),
    ]
    assert [(found[i].had_null_customer, found[i].had_zero_price) for i in (6, 7)] == [(True, True), (False, False)]
    assert found[8].order_ts is None and found[8].unit_price == Decimal(999999)


def test_cleaning_again_changes_nothing(spark):
    raw = rows.raw(
        spark,
        dict(order_id="1", sku="SKUEL001"),
        dict(order_id="1", sku="SKU-EL-001"),
        dict(order_id="2", sku="x"),
        dict(order_id="3", status="test"),
    )
    once = cleaning.clean_orders(raw)
    again = cleaning.clean_orders(
        once.selectExpr("monotonically_increasing_id() AS src_ord", "*").withColumn(
            "order_ts", once.order_ts.cast("string")
        )
    )
    assert sorted(once.collect()) == sorted(again.collect())


def test_funnel_adds_up(spark):
    raw = rows.raw(
        spark,
        dict(order_id="1"),
        dict(order_id="1", sku="skuel001"),
        dict(order_id="2", status="test"),
        dict(order_id="3", qty=-2),
        dict(order_id=None),
        dict(order_id=None),
    )
    found = cleaning.cleaning_funnel(raw).orderBy("stage_no").collect()
    assert [(row.stage, row.row_count, row.removed) for row in found] == [
        ("raw", 6, 0),
        ("without_test", 5, 1),
        ("without_negative_qty", 4, 1),
        ("without_duplicates", 2, 2),
    ]
    assert cleaning.clean_orders(raw).count() == 2


def test_a_third_of_all_lines_copies_of_one(spark):
    copies = spark.range(30_000).selectExpr("id AS src_ord", "if(id % 3 = 0, 'hot', concat('o', id)) AS order_id")
    defaults = rows.raw(spark, {}).drop("src_ord", "order_id")
    raw = copies.crossJoin(defaults)  # one-row side
    clean = cleaning.clean_orders(raw)
    assert clean.count() == 20_001
    plan = clean._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # copies are dropped before the shuffle as well

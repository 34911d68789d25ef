"""Known totals of the derived orders at sf0.01 (FIXTURES.md, part C)."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import functions as F

from ordermill.fixtures import queries as registered
from compare import plan_of
from ordermill.fixtures.orders import order_pages, page_count, raw_orders
from ordermill.plans import cleaning, marts

SF_DIR = "/root/testdata/sf0.01"


def test_a_busy_order_has_unique_positions_and_bounded_pages(spark, tmp_path):
    spark.range(3000).selectExpr(
        "1 AS l_orderkey", "id AS l_partkey", "id % 10 AS l_suppkey", "1.0D AS l_quantity", "2.5D AS l_extendedprice",
        "id % 7 AS l_linenumber",
    ).unionByName(
        spark.range(3000).selectExpr(
            "id + 2 AS l_orderkey", "id AS l_partkey", "1 AS l_suppkey", "1.0D AS l_quantity", "2.5D AS l_extendedprice",
            "1 AS l_linenumber",
        )
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(3002).selectExpr("id AS o_orderkey", "id AS o_custkey", "'1995-01-02' AS o_orderdate").write.parquet(
        f"{tmp_path}/orders.parquet"
    )
    raw = raw_orders(spark, str(tmp_path))
    assert raw.count() > 6000 and raw.select("src_ord").distinct().count() == raw.count()
    assert "Window" not in plan_of(raw)
    sizes = [
        row.lines
        for row in order_pages(raw, page_count(spark, str(tmp_path)))
        .selectExpr("json_array_length(page) AS lines")
        .collect()
    ]
    assert sum(sizes) == raw.count() and max(sizes) < 1000


def test_totals(spark):
    funnel = cleaning.cleaning_funnel(raw_orders(spark, SF_DIR)).orderBy("stage_no").collect()
    assert [row.row_count for row in funnel] == [61_172, 60_578, 59_564, 58_379]
    clean, rates = registered._stored(spark, SF_DIR, *cleaning.CLEAN_COLUMNS)
    flags = ["had_null_customer", "had_null_category", "had_zero_price"]
    counts = clean.agg(
        F.count_if(F.col("order_ts").isNull()),
        *[F.count_if(flag) for flag in flags],
        F.count_if(F.col("status") == "completed"),
    ).first()
    assert tuple(counts) == (95, 620, 1_036, 160, 55_841)
    assert (rates.count(), rates.where("is_estimated").count()) == (2_397, 32)
    spend = marts.customer_spend(clean, rates)
    assert (spend.count(), spend.where("multiple_countries_bought").count()) == (1_500, 775)
    assert {row.country: row.total_revenue_eur for row in marts.country_revenue(clean, rates).collect()} == {
        "DE": Decimal("6375009012.71"),
        "BG": Decimal("6372538550.00"),
        "HU": Decimal("6240550884.34"),
        "RO": Decimal("3725299742.81"),
    }

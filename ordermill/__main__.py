"""spark-submit entry: landed pages and rate documents to stored marts."""

from __future__ import annotations

import argparse
import datetime as dt
from collections.abc import Sequence

from .plans.marts import REVENUE_CATEGORIES, REVENUE_THRESHOLD_EUR, top_customers
from .plans.pipeline import run_pipeline
from .schemas import STEP_OF_TABLE
from .session import build_session, input_bytes, shuffle_partitions_for
from .sources import Warehouse, point_tables_at


def main(argv: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="ordermill", description=__doc__)
    parser.add_argument("--orders", required=True, help="folder of landed order pages")
    parser.add_argument("--fx", required=True, help="folder of landed exchange-rate documents")
    parser.add_argument("--root", required=True, help="folder of the stored tables")
    parser.add_argument("--today", type=dt.date.fromisoformat, help="day of the run, default the current UTC day")
    parser.add_argument("--category", action="append", help="category that counts as revenue, repeatable")
    parser.add_argument("--threshold", default=REVENUE_THRESHOLD_EUR, help="EUR revenue a country must exceed")
    parser.add_argument("--seed", choices=("required", "asof"), default="required")
    parser.add_argument("--rejects", help="folder for lines left out by cleaning")
    parser.add_argument("--packed", action="store_true", help="each text line of the landing is one page with its offset")
    parser.add_argument("--by-month", action="store_true", help="store clean orders and rates in month folders")
    parser.add_argument("--append", action="store_true", help="add the landing to the stored orders")
    parser.add_argument("--database", help="catalog database to show the tables in; name it on every run, or it goes stale")
    parser.add_argument("--shuffle-partitions", type=int, help="default: so that 128 MB of the input fall to each")
    args = parser.parse_args(argv)

    spark = build_session(shuffle_partitions=args.shuffle_partitions)
    if not args.shuffle_partitions:
        size = input_bytes(spark, args.orders)
        partitions = shuffle_partitions_for(size, spark.sparkContext.defaultParallelism)
        spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    counts = run_pipeline(
        spark,
        args.root,
        args.orders,
        args.fx,
        today=args.today,
        categories=tuple(args.category or REVENUE_CATEGORIES),
        threshold=args.threshold,
        seed=args.seed,
        rejects_path=args.rejects,
        packed=args.packed,
        by_month=args.by_month,
        append=args.append,
    )
    warehouse = Warehouse(spark, args.root, args.by_month)
    if args.database:
        point_tables_at(warehouse, args.database)
    last_run = warehouse.last_details()
    for table, rows in counts.items():
        left = ", ".join(f"{name} {count}" for name, count in last_run[STEP_OF_TABLE[table]].items())
        print(f"{table}: {rows} rows" + (f" ({left})" if left else ""))
    top_customers(warehouse.read("customer_spend_eur")).show(truncate=False)
    warehouse.read("country_category_revenue").show(truncate=False)


if __name__ == "__main__":
    main()

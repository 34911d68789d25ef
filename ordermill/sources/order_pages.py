"""Landed pages of the order source: one JSON array of order lines per file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import SOURCE_ORDER

# Where the page's offset stands in its path, as in `offset=2000.json` or `offset=2000/part-0.json`.
OFFSET_IN_PATH = "offset=([0-9]+)"


def read_order_pages(spark: SparkSession, path: str, offset_pattern: str = OFFSET_IN_PATH) -> DataFrame:
    """All order lines under `path`, with `src_ord` = page offset + position in the page.

    A page is small by the source's page limit, so one file is one input row; Spark spreads the
    files over tasks. A page that is no JSON array, does not fit the schema or has no offset in
    its path stops the read. Files without a single byte are no pages to Spark and add nothing.
    """
    offset = F.regexp_extract("_metadata.file_path", offset_pattern, 1)
    pages = (
        spark.read.text(path, wholetext=True, recursiveFileLookup=True)
        .select(
            F.when(offset != "", offset.cast("bigint"))
            .otherwise(
                F.raise_error(F.concat(F.lit("no page offset in path "), F.col("_metadata.file_path"))).cast("bigint")
            )
            .alias("page_offset"),
            F.col("value").alias("page"),
        )
    )
    return decode_pages(pages)


def read_packed_pages(spark: SparkSession, path: str) -> DataFrame:
    """All order lines under `path`, where each text line is {"offset": n, "lines": [...]}.

    Files of any size are split by Spark, and few of them need listing. A line that is no such object,
    or lacks its offset or lines, stops the read.
    """
    page = T.StructType([T.StructField("offset", T.LongType()), T.StructField("lines", T.ArrayType(SOURCE_ORDER))])
    records = spark.read.option("recursiveFileLookup", True).text(path)
    parsed = records.select(F.from_json("value", page, {"mode": "FAILFAST"}).alias("page"))
    whole = F.col("page.offset").isNotNull() & F.col("page.lines").isNotNull()
    lines = F.when(whole, F.col("page.lines")).otherwise(F.raise_error(F.lit("packed order page without offset or lines")))
    return parsed.select(F.col("page.offset").alias("page_offset"), F.posexplode(lines).alias("pos", "line")).select(
        (F.col("page_offset") + F.col("pos")).alias("src_ord"), "line.*"
    )


def decode_pages(pages: DataFrame) -> DataFrame:
    """Rows (`page_offset`, `page`) to one row per order line; absent fields become NULL."""
    lines = F.from_json("page", T.ArrayType(SOURCE_ORDER), {"mode": "FAILFAST"})
    checked = F.when(F.ltrim(F.col("page"), F.lit(" \t\r\n")).startswith("["), lines).otherwise(
        F.raise_error(F.concat(F.lit("order page is not a JSON array, offset "), F.col("page_offset")))
    )
    return pages.select("page_offset", F.posexplode(checked).alias("pos", "line")).select(
        (F.col("page_offset") + F.col("pos")).alias("src_ord"), "line.*"
    )

"""First row per key, insert-ignore and upsert."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import staged

# Blocks of marks that are broadcast, 4 KB for 32,768 rows each: 64 MB for half a billion rows.
MARKED_BLOCKS = 1 << 14


def keep_first(df: DataFrame, keys: list[str], *order: str) -> DataFrame:
    """The row that comes first by the `order` columns per key; NULL keys count as equal.

    Spark turns the rank filter into a group limit that runs before the shuffle too, so each
    task sends at most one row of a key however many copies of it exist.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def insert_ignore(existing: DataFrame, new: DataFrame, keys: list[str], *order: str) -> DataFrame:
    """Rows of `new` to append: unknown keys only, the first row where a key repeats.

    Only the key columns of `existing` are read. A NULL key never conflicts, so check for those first.
    """
    return keep_first(new, keys, *order).join(existing.select(*keys), keys, "left_anti")


def unknown_keys(existing: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of `new` whose key `existing` does not have; `new` is read from Parquet files of one folder.

    Keys are shuffled, whole rows are not: rows with a known key are found by file and position, and marked by one bit a row in blocks that
    are broadcast up to MARKED_BLOCKS. Beyond that the join with the marks shuffles the rows. A NULL key is never known.
    """
    row = {"in_file": F.col("_metadata.file_name"), "row": F.col("_metadata.row_index") + 1}
    placed = {"in_file": F.col("in_file"), "block": F.bitmap_bucket_number("row"), "place": F.bitmap_bit_position("row")}
    known = new.select(*keys, *[value.alias(name) for name, value in row.items()]).join(existing.select(*keys), keys)
    dealt = known.select(*[value.alias(name) for name, value in placed.items()]).repartition("in_file", "block")
    marks = staged(dealt.groupBy("in_file", "block").agg(F.bitmap_construct_agg("place").alias("marks")), "known_rows")
    if marks.count() <= MARKED_BLOCKS:
        marks = F.broadcast(marks)
    octet = F.conv(F.hex(F.substring("marks", (F.col("place") / 8).cast("int") + 1, 1)), 16, 10).cast("bigint")
    is_known = F.coalesce(F.getbit(octet, (F.col("place") % 8).cast("int")) == 1, F.lit(False))
    rows = new.withColumns(row).withColumns({name: value for name, value in placed.items() if name != "in_file"})
    return rows.join(marks, ["in_file", "block"], "left").where(~is_known).select(*new.columns)


def upsert(existing: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """`existing` with the rows of `new` added or put in place of those with the same key.

    `new` must hold each key once. The result is a new snapshot: write it somewhere else than
    where `existing` is read from.
    """
    return existing.join(new.select(*keys), keys, "left_anti").unionByName(new)

"""Raw order lines to clean ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import canonical_sku, inferred_category, parse_order_ts
from ..operators import keep_first
from ..schemas import KEYS, ORDERS_CLEAN
from ..session import staged

ORDER_KEY = KEYS["orders_clean"]

# Bits for keys that repeat, 32 MB of them at most, whatever the number of lines.
SLOTS = 1 << 28

# 64-bit words in a row of bits, 4,096 bits in all.
WORDS = 64

# What of a key's hash is counted, five bytes: few of a billion keys share it, and those that do are looked at whole.
COUNTED_BITS = (1 << 40) - 1

# What the clean step computes: the stored columns without the write stamp.
CLEAN_COLUMNS = [name for name in ORDERS_CLEAN.names if name != "cleaned_at"]


def reject_reason() -> Column:
    """Why a raw line is left out, or NULL. A missing status or quantity is no reason."""
    return F.when(F.col("status") == "test", "test").when(F.col("qty") < 0, "negative_qty")


def reject_counts() -> list[Column]:
    """Raw lines, and those left out for each reason."""
    reason = reject_reason()
    counts = [F.count_if(F.coalesce(reason == name, F.lit(False))).alias(name) for name in ("test", "negative_qty")]
    return [F.count(F.lit(1)).alias("raw"), *counts]


def is_accepted() -> Column:
    """Whether a raw line has no reject reason."""
    return reject_reason().isNull()


def accepted(raw: DataFrame) -> DataFrame:
    """Lines without a reject reason, spelled as comparisons that the Parquet scan can apply."""
    status, qty = F.col("status"), F.col("qty")
    return raw.where(status.isNull() | (status != "test")).where(qty.isNull() | (qty >= 0))


def quarantine(raw: DataFrame) -> DataFrame:
    """The lines cleaning leaves out, as they came, with the reason."""
    return raw.withColumn("reject_reason", reject_reason()).where(F.col("reject_reason").isNotNull())


def with_clean_columns(raw: DataFrame, *keep: str) -> DataFrame:
    """Typed time, canonical SKU, completed category and quality flags; one row per input row.

    `src_ord` and the columns named in `keep` stay as they are.
    """
    inferred = inferred_category(F.col("sku"))
    return (
        raw.withColumn("sku", canonical_sku(F.col("sku")))
        .withColumn("inferred", inferred)
        .withColumns(
            {
                "order_ts": parse_order_ts(F.col("order_ts")),
                "had_null_customer": F.col("customer_id").isNull(),
                "had_null_category": F.col("category").isNull() & F.col("inferred").isNotNull(),
                "had_zero_price": F.coalesce(F.col("unit_price") == 0, F.lit(False)),
                "category": F.coalesce("category", "inferred"),
            }
        )
        .select("src_ord", *CLEAN_COLUMNS, *keep)
    )


def clean_orders(raw: DataFrame) -> DataFrame:
    """Accepted lines, cleaned, the first one at the source per order and SKU.

    Filters and expressions run in the scan stage; the only shuffle is the one by order and SKU.
    """
    return keep_first(with_clean_columns(accepted(raw)), ORDER_KEY, "src_ord").drop("src_ord")


def clean_stored_orders(raw: DataFrame, seen: Observation | None = None) -> DataFrame:
    """What `clean_orders` gives, of a raw table that can be scanned several times; whole lines are shuffled only where a key may repeat.

    Hashes of all keys, five bytes each, are counted first. Those found twice or more are marked in SLOTS bits, which are broadcast. A line whose bit is
    not set has the only line of its key and is written by the task that reads it. All others, lines that share a bit by chance
    included, go through `keep_first`: the result is exact whatever the bits say, and many repeated keys only mean more of
    these lines. `seen` observes the rejects in the pass over whole lines.
    """
    marked = _repeated_keys(raw)
    counted = raw if seen is None else raw.observe(seen, *reject_counts())
    alone = _with_mark(counted, marked).where("NOT may_repeat")
    again = _with_mark(raw, marked).where("may_repeat")
    first = keep_first(with_clean_columns(again), ORDER_KEY, "src_ord")
    return with_clean_columns(alone).unionByName(first).drop("src_ord")


def _slot() -> Column:
    """Where the key of a raw line is marked."""
    key = [F.col("order_id"), canonical_sku(F.col("sku"))]
    return F.xxhash64(*key, *[name.isNull() for name in key]).bitwiseAND(F.lit(COUNTED_BITS))


def _place(slot: Column) -> dict[str, Column]:
    """The row of words that holds a slot's bit, the word's place in it, and the bit's place in the word."""
    within = slot.bitwiseAND(F.lit(SLOTS - 1))
    return {
        "block": F.shiftright(within, 12),
        "word": F.shiftright(within, 6).bitwiseAND(F.lit(WORDS - 1)).cast("int"),
        "bit": within.bitwiseAND(F.lit(63)).cast("int"),
    }


def _repeated_keys(raw: DataFrame) -> DataFrame:
    """Rows of WORDS words (`block`, `words`) with the bits of keys that more than one accepted line has, or that share a hash."""
    hashes = accepted(raw).select(_slot().alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("lines"))
    slots = hashes.where("lines > 1").withColumns(_place(F.col("key")))
    words = slots.groupBy("block", "word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
    found = words.groupBy("block").agg(F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("found"))
    dense = F.transform(F.sequence(F.lit(0), F.lit(WORDS - 1)), lambda word: F.coalesce(F.try_element_at("found", word), F.lit(0)))
    return staged(found.select("block", dense.cast("array<bigint>").alias("words")), "repeated_keys")


def _with_mark(raw: DataFrame, marked: DataFrame) -> DataFrame:
    """Accepted lines with `may_repeat`: whether the bit of their key is set."""
    lines = accepted(raw).withColumn("slot", _slot()).withColumns(_place(F.col("slot")))
    is_set = F.coalesce(F.getbit(F.get("words", F.col("word")), F.col("bit")) == 1, F.lit(False))
    return lines.join(F.broadcast(marked), "block", "left").withColumn("may_repeat", is_set)


def cleaning_funnel(raw: DataFrame) -> DataFrame:
    """Rows left and removed after each cleaning stage, in one pass that shuffles keys only."""
    key = F.struct("order_id", canonical_sku(F.col("sku")))
    counts = raw.withColumn("reason", reject_reason()).agg(
        F.count(F.lit(1)).alias("raw"),
        F.count_if(F.col("reason") == "test").alias("test"),
        F.count_if(F.col("reason") == "negative_qty").alias("negative"),
        F.count_distinct(F.when(F.col("reason").isNull(), key)).alias("clean"),
    )
    stages = F.expr(
        "stack(4, 1, 'raw', raw, 0L,"
        " 2, 'without_test', raw - test, test,"
        " 3, 'without_negative_qty', raw - test - negative, negative,"
        " 4, 'without_duplicates', clean, raw - test - negative - clean)"
    )
    return counts.select(stages.alias("stage_no", "stage", "row_count", "removed"))

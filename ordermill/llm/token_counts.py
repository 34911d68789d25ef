"""Token counts through two map-side tiers: a broadcast table of frequent words, and worker caches."""

from __future__ import annotations

from collections import Counter
from functools import lru_cache

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.llm.batches import fold_rows, map_rows, table
from ordermill.llm.pieces import CACHED_LENGTH, pieces
from ordermill.llm.sentencepieces import MODEL

FREQUENT = 16_384
SUMMARY = 8_192


def thin(counts: Counter, size: int) -> None:
    """Keep the `size` largest counters, each less the largest one that goes (Misra-Gries)."""
    ordered = counts.most_common(size + 1)
    if len(ordered) <= size:
        return
    cut = ordered[-1][1]
    counts.clear()
    counts.update({word: n - cut for word, n in ordered[:-1] if n > cut})


def frequent_words(docs: DataFrame, model: str, limit: int = FREQUENT, text_col: str = "text") -> list[str]:
    """At most `limit` words that occur often, from a summary of every text.

    Each task counts its words in a bounded Misra-Gries summary; only the summaries (`SUMMARY`
    counters a task at most) are added up. The table affects speed alone, never a count.
    """

    def add(counts, text):
        words = pieces(model).words(text or "")
        if words:
            counts.update(words)
            if len(counts) > 40 * SUMMARY:
                thin(counts, 4 * SUMMARY)

    def finish(counts):
        thin(counts, SUMMARY)
        kept = [(word, n) for word, n in counts.items() if word and len(word) <= CACHED_LENGTH]
        if kept:
            yield tuple(map(list, zip(*kept)))

    summaries = fold_rows(docs.select(F.col(text_col)), "word string, n long", Counter, add, finish)
    top = summaries.groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(limit)
    return [row.word for row in top.select("word").collect()]


@lru_cache(maxsize=2)
def _second_tier(model: str) -> dict[str, int]:
    return {"": 1}


def count_tokens(
    docs: DataFrame,
    model: str,
    token_limit: int = 4096,
    id_col: str = "doc_id",
    text_col: str = "text",
    frequent: int = FREQUENT,
) -> DataFrame:
    """Tokens of every whole text, without begin, end or added special tokens.

    The driver encodes the frequent words once and broadcasts their lengths (`frequent` entries at
    most); a task looks words up there, then in its worker's bounded cache, and encodes what is
    in neither. No word of the corpus is shuffled. NULL and empty texts have 0 bytes and 0 tokens;
    each input row gives one row, whatever its id. Other columns are not carried.
    """
    tool = pieces(model)
    spark = docs.sparkSession
    words = frequent_words(docs, model, frequent, text_col) if tool.by_word else []
    lengths = {word: len(ids) // 4 for word, ids in zip(words, tool.encode_words(words))}
    shared = spark.sparkContext.broadcast(lengths)

    def start():
        tool, first, second = pieces(model), shared.value, _second_tier(model)

        def row(doc_id, text, n_bytes):
            words = tool.words(text)
            if words is None:
                return doc_id, n_bytes, len(tool.library.encode(text))
            if not text:
                return doc_id, n_bytes, 0
            found = list(map(first.get, words))
            if None not in found:
                return doc_id, n_bytes, sum(found)
            rest = [word for word, n in zip(words, found) if n is None]
            total = sum(filter(None, found))
            found = list(map(second.get, rest))
            total += sum(filter(None, found))
            missing = Counter(word for word, n in zip(rest, found) if n is None)
            if missing:
                if len(second) > 300_000:
                    second.clear()
                    second[""] = 1
                fresh = dict(zip(missing, (len(ids) for ids in tool.library.encode(list(missing), num_threads=1))))
                total += sum(n * fresh[word] for word, n in missing.items())
                second.update((word, n) for word, n in fresh.items() if len(word) <= CACHED_LENGTH)
            return doc_id, n_bytes, total

        return row

    text = F.coalesce(F.col(text_col), F.lit(""))
    kept = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        text.alias("text"),
        F.octet_length(text).cast("long").alias("n_bytes"),
    )
    counted = map_rows(kept, "doc_id long, n_bytes long, n_tokens long", start)
    return counted.withColumn("over_limit", F.col("n_tokens") > token_limit)


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(MODEL))

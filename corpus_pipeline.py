"""Cleaning of the documents table in stages, each on all that the one before it kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.llm.batches import table
from ordermill.llm.decontamination import find_leaks
from ordermill.llm.languages import identify_kept, learn_profiles
from ordermill.llm.personal_data import redact_documents
from ordermill.llm.sentencepieces import MODEL, encode_documents
from ordermill.llm.simhash import keep_first
from ordermill.session import staged

#: Eight bytes each.
BROADCAST_KEYS = 1_000_000


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is in a learned language; those without a letter or near no profile go.

    NULL and empty texts go. Rows are judged one by one by their whole texts, so NULL or repeated ids do not
    matter; all columns of a kept row stay.
    """
    return identify_kept(docs, learn_profiles(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates: that with the smallest id, rows without an id last."""
    return keep_first(docs, null_ids_stay=False)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark, row by row: a row is known by its text, not by its id.

    Repeated texts stay or go together, whatever their ids; NULL and empty texts hold no passage and stay. All columns stay.
    The keys of texts to remove are counted and broadcast up to `BROADCAST_KEYS`; beyond that the join shuffles.
    """
    texts = docs.select(F.xxhash64("text").alias("text_key"), "text")
    leaks = find_leaks(texts, table(spark, sf_dir, "benchmark"), id_col="text_key")
    leaks = staged(leaks.select(F.col("doc_id").alias("leak_key")).distinct(), "leaks")
    if leaks.count() <= BROADCAST_KEYS:
        leaks = F.broadcast(leaks)
    return docs.join(leaks, F.xxhash64(docs["text"]) == leaks["leak_key"], "left_anti")


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind; n_chars follows."""
    return redact_documents(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids, source spans and decoded text of each document: rows for training.

    One row per document, with NULL and repeated ids as they are; a NULL text counts as empty. Of the columns only doc_id is
    carried, as this is the last stage.
    """
    return encode_documents(docs, public_tokenizers.path(MODEL))


#: (name, function) in order; a function takes (spark, docs, sf_dir) and returns a DataFrame.
STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("encoding", encoding),
]

#: Language profiles, latent spaces and encodings are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages on the documents table; each stage's rows are written to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs

"""The corpus pipeline: what each stage keeps, and what runs without it."""

from __future__ import annotations

import numpy as np

import __spark_entry__ as entry_points
import corpus_pipeline
from ordermill.llm.decontamination import find_leaks
from ordermill.llm.personal_data import detect
from ordermill.llm.simhash import near_duplicates

SF_DIR = "/root/testdata/sf0.01"


def test_registered():
    names = set(entry_points.queries())
    assert [sum(name.startswith(f"op{n}_") for name in names) for n in range(1, 11)] == [1] * 10
    assert "pipeline" in names
    assert not set(entry_points.oracle_sql()) & {"pipeline"}
    assert 4 <= len(corpus_pipeline.STAGES) <= 5


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    junk = [(-1, "0123 4567 89 !!", None, "s", 15), (-2, None, "en", "s", None), (-3, "", None, "s", 0), (-4, "жщ ыъ " * 20, None, "s", 120)]
    copy = docs.where("doc_id = 0").selectExpr("1000000 AS doc_id", "text", "lang", "source", "n_chars")
    docs = docs.unionByName(spark.createDataFrame(junk, docs.schema)).unionByName(copy)
    tables = [docs.cache()]
    for _, stage in corpus_pipeline.STAGES:
        tables.append(stage(spark, tables[-1], SF_DIR).cache())
    for table in tables[1:5]:
        assert table.columns == docs.columns
    ids = [{row.doc_id for row in table.select("doc_id").collect()} for table in tables]
    assert ids[0] - ids[1] == {-1, -2, -3, -4}
    groups = {row.doc_id: row.component_id for row in near_duplicates(tables[1]).collect()}
    assert ids[2] == set(groups.values()) and 1000000 not in ids[2]
    assert tables[2].count() == len(ids[2])
    leaks = {row.doc_id for row in find_leaks(tables[2], spark.read.parquet(f"{SF_DIR}/benchmark.parquet")).collect()}
    assert leaks and ids[3] == ids[2] - leaks
    assert ids[4] == ids[3] == ids[5]
    for row in tables[4].collect():
        assert not detect(row.text) and row.n_chars == len(row.text)
    texts = {row.doc_id: row.text for row in tables[4].collect()}
    for row in tables[5].collect():
        assert row.decoded == texts[row.doc_id] or "▁" in texts[row.doc_id]
        assert np.frombuffer(row.ends, "<u4")[-1] == len(texts[row.doc_id].encode())


def test_odd_tables(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(30).selectExpr("*", "1 AS fp", "'x' AS component_id", "2 AS item_id")
    for table in (docs.limit(0), docs.unionByName(docs).unionByName(docs.selectExpr("CAST(NULL AS LONG) AS doc_id", "text", "CAST(NULL AS STRING) AS lang", "CAST(NULL AS STRING) AS source", "CAST(NULL AS LONG) AS n_chars", "fp", "component_id", "item_id"))):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            table = stage(spark, table, SF_DIR).cache()
            assert table.columns == docs.columns
        assert corpus_pipeline.STAGES[-1][1](spark, table, SF_DIR).count() == table.count()


def test_contaminated_rows_take_no_clean_rows_along(spark):
    passage = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").first().text
    rows = [(None, f"before {passage} after"), (None, "a clean text without an id"), (5, passage), (5, "a clean text of the same id"), (6, passage), (7, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {(row.doc_id, row.text) for row in corpus_pipeline.decontamination(spark, docs, SF_DIR).collect()}
    assert kept == {(None, "a clean text without an id"), (5, "a clean text of the same id"), (7, None)}

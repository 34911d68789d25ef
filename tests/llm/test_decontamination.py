"""Decontamination: the subsequence by a plain table, the space by numpy, planted passages."""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from ordermill.llm.codes import word_hashes
from ordermill.llm.decontamination import PASSAGE, common, cut, find_leaks, latent_space, op4_decontamination, passages

SF_DIR = "/root/testdata/sf0.01"


def plain_lcs(own, near, weight):
    table = [[0.0] * (len(near) + 1) for _ in range(len(own) + 1)]
    for i, a in enumerate(own):
        for j, b in enumerate(near):
            table[i + 1][j + 1] = max(table[i][j + 1], table[i + 1][j], table[i][j] + weight[a] if a == b else 0)
    return table[-1][-1]


def test_subsequence():
    rng = random.Random(0)
    for _ in range(1500):
        weight = np.array([rng.choice([0.5, 1, 2]) for _ in range(5)])
        own = [rng.randrange(5) for _ in range(rng.randint(1, 8))]
        near = [rng.randrange(-1, 5) for _ in range(rng.randint(0, 12))]
        share, first, last = common(own, ([i for i, x in enumerate(near) if x >= 0], [x for x in near if x >= 0]), weight)
        best = plain_lcs(own, near, weight)
        assert abs(share * weight[own].sum() - best) < 1e-6
        if best:
            assert abs(plain_lcs(own, near[first : last + 1], weight) - best) < 1e-6


def test_passages_cover_all_words():
    words = np.arange(500, dtype=np.uint64)
    for size in (0, 1, PASSAGE, PASSAGE + 1, 499, 500):
        parts = cut(words[:size])
        assert set(np.concatenate([*parts, np.zeros(0, np.uint64)]).tolist()) == set(range(size))
        assert all(len(part) == min(size, PASSAGE) for part in parts)


def test_space_is_that_of_a_plain_decomposition(spark):
    benchmark = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    rows = passages(benchmark, "item_id", "text", None).cache()
    held = [np.array(row.words, np.int64).view(np.uint64) for row in rows.collect()]
    terms = np.unique(np.concatenate(held))
    weight = np.linspace(0.5, 3, len(terms))
    matrix = np.zeros((len(held), len(terms)))
    for i, words in enumerate(held):
        np.add.at(matrix[i], np.searchsorted(terms, words), 1)
    matrix *= weight
    own = np.linalg.svd(matrix, full_matrices=False)
    full = latent_space(rows, terms, weight, len(held))
    assert np.allclose(full.T @ full, np.eye(full.shape[1]), atol=1e-6)
    assert np.allclose(matrix @ full @ full.T, matrix, atol=1e-4)
    few = latent_space(rows, terms, weight, 8)
    assert np.linalg.norm(matrix @ few) ** 2 > 0.97 * (own[1][:8] ** 2).sum()


def test_query_finds_every_copy(spark):
    items = [(row.item_id, word_hashes(row.text)) for row in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    docs = [(row.doc_id, word_hashes(row.text)) for row in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    copies = {(d, i) for d, words in docs for i, own in items if own.tobytes() in words.tobytes()}
    found = {(row.doc_id, row.item_id): row.lcs_share for row in op4_decontamination(spark, SF_DIR).collect()}
    assert copies and copies <= set(found)
    assert all(share >= 0.6 for share in found.values())
    assert len(found) <= len(copies) + 2


def test_paraphrases_and_answers(spark):
    rng = random.Random(3)
    items = [(row.item_id, row.text) for row in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect() if len(row.text.split()) >= 15]
    prose = [row.text.split() for row in spark.read.parquet(f"{SF_DIR}/documents.parquet").orderBy(F.length("text").desc()).limit(40).collect()]
    made, expected = [], set()
    for k in range(60):
        item, text = items[k % len(items)]
        words = ["changed" if rng.random() < 0.15 else word for word in text.split()]
        at = rng.randrange(300)
        made.append((k, " ".join(prose[k % 40][:at] + words + prose[k % 40][at:600])))
        expected.add((k, item))
    docs = spark.createDataFrame(made, "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = {(row.doc_id, row.item_id) for row in find_leaks(docs, benchmark, block=9).collect()}
    assert len(found & expected) >= 54
    answered = benchmark.withColumn("answer", F.lit("an answer that is nowhere"))
    assert find_leaks(docs, answered).count() == 0
    last = benchmark.withColumn("answer", F.element_at(F.split(F.trim("text"), r"\s+"), -1))
    copies = spark.createDataFrame([(i, text) for i, text in items], "doc_id long, text string")
    assert {(row.doc_id, row.item_id) for row in find_leaks(copies, last).collect()} >= {(i, i) for i, _ in items}


def test_odd_rows(spark):
    text = "one quite particular sentence that the benchmark holds as an item of its own"
    rows = [(1, text, "a"), (1, text, "a"), (None, f"{text}!", "b"), (2, None, "c"), (3, "", "d"), (4, "something else", "e"), (5, "filler " * 70_000 + text, "f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, item_id string")
    benchmark = spark.createDataFrame([(7, text), (8, None), (9, ""), (7, text)], "item_id long, text string")
    found = sorted((row.doc_id or 0, row.item_id) for row in find_leaks(docs, benchmark).collect())
    assert found == [(0, 7), (1, 7), (5, 7)]
    assert find_leaks(docs, benchmark.limit(0)).count() == 0
    assert find_leaks(docs.limit(0), benchmark).count() == 0

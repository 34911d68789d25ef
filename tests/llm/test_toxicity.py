"""Positive-unlabelled learning: the risk's gradient, and held-out labels."""

from __future__ import annotations

from collections import Counter

import numpy as np

from ordermill.llm.codes import word_hashes
from ordermill.llm.toxicity import (
    buckets,
    dense,
    fit_nnpu,
    learn,
    level,
    op2_toxicity,
    places_of,
    score_toxicity,
    select_features,
    selected,
)


def test_words_do_not_depend_on_chunks(monkeypatch):
    text = "Ein über-langes Wort, " * 40 + "x" * 300 + " Ende"
    whole = word_hashes(text)
    monkeypatch.setattr("ordermill.llm.codes.CHUNK", 16)
    assert (word_hashes(text) == whole).all()
    assert len(set(word_hashes("a b A. b,").tolist())) == 2
    assert word_hashes("abcdefgh abcdezzz abcde", (5,)).tolist().count(word_hashes("abcdefgh", (5,))[1]) == 2


def rows_of(texts, features):
    counts = Counter((selected(text, places_of(features)), level(text)) for text in texts)
    return dense([(*key, n) for key, n in counts.items()], len(features))


def test_positives_among_the_unlabelled_are_found():
    rng = np.random.default_rng(0)
    positive = [np.array([7 << 4 | 3, 9 << 4 | 1], "<u4")] * 40
    hidden = [np.array([7 << 4 | 2], "<u4")] * 20
    clean = [np.sort(rng.choice(np.arange(20, 60), 5, replace=False)).astype("<u4") << 4 | 1 for _ in range(180)]
    features = np.array([7, 9, 25, 30])
    weights = fit_nnpu(rows_of(positive, features), rows_of([*hidden, *clean], features), 0.1)
    toxic, fine = (rows_of([text], features)[0][0] for text in (hidden[0], clean[0]))
    assert toxic @ weights > 0 > fine @ weights


def test_the_risk_stays_near_zero_or_above():
    # all unlabelled rows equal the positives: fitted as negatives they would have a large negative part
    same = rows_of([np.array([3 << 4 | 1], "<u4")] * 10, np.array([3]))
    z = same[0] @ fit_nnpu(same, same, 0.5, steps=300)
    assert np.logaddexp(0, z).mean() - 0.5 * np.logaddexp(0, z).mean() > -0.05


def test_features_are_what_positives_have_more_often():
    in_p, in_u = np.zeros(1 << 18), np.zeros(1 << 18)
    in_p[[3, 5, 8]] = 30, 40, 1
    in_u[[3, 5, 9]] = 2, 400, 50
    assert select_features(in_p, in_u, 50, 500, 10).tolist() == [3]


def test_held_out_labels(spark):
    sf_dir = "/root/testdata/sf0.1"
    labels = {row.doc_id: row.toxic for row in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    rows = [row for row in op2_toxicity(spark, sf_dir).collect() if row.held_out and row.doc_id in labels]
    assert all(0 <= row.score <= 1 and row.predicted == (row.score >= 0.5) for row in rows)
    toxic = [row for row in rows if labels[row.doc_id]]
    clean = [row for row in rows if not labels[row.doc_id]]
    assert sum(row.predicted for row in toxic) / len(toxic) > 0.85
    assert sum(row.predicted for row in clean) / len(clean) < 0.02


def test_odd_rows(spark):
    rows = [(1, "you scum", "a"), (1, "you scum", "a"), (2, None, "b"), (None, "", "c"), (3, "fine words", "d"), (4, "more fine words", "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    labels = spark.createDataFrame([(1, 1), (1, 1), (3, 0), (None, 1), (9, 1), (4, None)], "doc_id long, toxic int")
    for known in (labels, labels.limit(0)):
        scored = score_toxicity(docs, learn(docs, known)).collect()
        assert len(scored) == 6
        assert all(0 <= row.score <= 1 for row in scored)
    empty = docs.limit(0)
    assert score_toxicity(empty, learn(empty, labels)).count() == 0
    assert buckets(None).tolist() == buckets("").tolist() == []

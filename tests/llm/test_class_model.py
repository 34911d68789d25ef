"""Class model: exact unigram part, exchange clustering, probabilities that add up."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from ordermill.llm import class_model
from ordermill.llm.class_model import exchange, op10_class_model, score_documents

SF_DIR = "/root/testdata/sf0.001"


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")), ""]


def likelihood(pairs, label, classes):
    member = np.eye(classes)[label]
    between = member.T @ pairs @ member
    f = lambda x: (x * np.log(np.maximum(x, 1e-300))).sum()
    return f(between) - f(between.sum(axis=0)) - f(between.sum(axis=1))


def test_no_single_move_helps_after_exchange():
    for seed in range(3):
        pairs = np.random.default_rng(seed).integers(0, 5, (40, 40)).astype(float)
        label = exchange(pairs, 5, 100)
        assert label[0] == 0 and (label[1:] > 0).all()
        best = likelihood(pairs, label, 5)
        for unit in range(1, 40):
            for other in range(1, 5):
                moved = label.copy()
                moved[unit] = other
                assert likelihood(pairs, moved, 5) <= best + 1e-6


def test_alike_words_share_a_class():
    pairs = np.zeros((9, 9))
    for a in range(1, 5):
        for b in range(5, 9):
            pairs[a, b] = pairs[b, a] = 10
    label = exchange(pairs, 3)
    assert len(set(label[1:5])) == len(set(label[5:])) == 1 and label[1] != label[5]


def test_best_class_is_that_of_all_single_moves():
    rng = np.random.default_rng(5)
    pairs = rng.integers(0, 6, (30, 30)).astype(float)
    label = np.append(0, rng.integers(1, 5, 29))
    member = np.eye(5)[label]
    own = pairs.diagonal()
    right, left = pairs @ member - own[:, None] * member, pairs.T @ member - own[:, None] * member
    units = np.arange(1, 30)
    new = class_model.best_classes(label[units], right[units], left[units], own[units], member.T @ pairs @ member)
    for unit, chosen in zip(units, new):
        values = []
        for other in range(1, 5):
            changed = label.copy()
            changed[unit] = other
            values.append(likelihood(pairs, changed, 5))
        assert values[chosen - 1] >= max(values) - 1e-6


def learned(spark, **options):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    counts = class_model.staged(class_model.count_words(docs), "words")
    return docs, class_model.learn(counts, docs, **options)


def test_neighbours_and_classes_against_brute_force(spark):
    docs, (model, _, _) = learned(spark, rounds=2)
    texts = [row.text for row in docs.collect()]
    vocabulary = model.vocabulary
    seen = Counter()
    for text in texts:
        units = vocabulary.units(vocabulary.codes([word.encode() for word in tokens(text)])).tolist()
        seen.update(zip([0, *units[:-1]], units))
    shared = spark.sparkContext.broadcast(vocabulary)
    rows = class_model.neighbours(docs, shared, vocabulary.size).collect()
    assert len(rows) == len({row.unit for row in rows})
    found = {}
    for row in rows:
        found |= {(row.unit, beside): n for beside, n in zip(np.frombuffer(row.beside, "<i4").tolist(), np.frombuffer(row.n, "<i8").tolist())}
    size, expected = vocabulary.size, Counter()
    for (a, b), n in seen.items():
        expected.update({(a, 2 * size): n} if a == b else {(a, b): n, (b, a + size): n})
    assert found == expected
    between = np.zeros((class_model.CLASSES, class_model.CLASSES))
    for (a, b), n in seen.items():
        between[model.label[a], model.label[b]] += n
    smooth = (between + 0.5) / (between.sum(axis=1, keepdims=True) + 0.5 * class_model.CLASSES)
    assert np.allclose(model.transition, np.log10(smooth))
    assert (model.label[1:] > 0).all() and model.label[0] == 0


def test_rounds_raise_the_likelihood_over_all_words(spark):
    docs, (model, _, _) = learned(spark, rounds=0)
    assert model.vocabulary.own > class_model.SEED_WORDS
    shared = spark.sparkContext.broadcast(model.vocabulary)
    near = class_model.staged(class_model.neighbours(docs, shared, model.vocabulary.size), "near")
    values = [class_model.likelihood(class_model.cluster(near, model.vocabulary.seed, rounds)[1]) for rounds in (0, 2)]
    assert values[1] > values[0]


def test_score_against_a_brute_force_model(spark):
    docs, (model, _, _) = learned(spark)
    texts = {row.doc_id: row.text for row in docs.collect()}
    counts = Counter(token for text in texts.values() for token in tokens(text))
    vocabulary = model.vocabulary
    words = list(counts)
    class_of = dict(zip(words, model.label[vocabulary.units(vocabulary.codes([word.encode() for word in words]))].tolist()))
    size, distinct, moves = Counter(), Counter(), Counter()
    for word, n in counts.items():
        size[class_of[word]] += n
        distinct[class_of[word]] += 1
    for text in texts.values():
        path = [class_of[word] for word in tokens(text)]
        moves.update(zip([path[-1], *path[:-1]], path))
    out = Counter()
    for (a, _), n in moves.items():
        out[a] += n
    for row in score_documents(docs, docs).collect():
        own = tokens(texts[row.doc_id])
        before, score = class_of[""], 0.0
        for word in own:
            now = class_of[word]
            score += math.log10((moves[before, now] + 0.5) / (out[before] + 0.5 * class_model.CLASSES))
            score += math.log10((counts[word] + 0.5) / (size[now] + 0.5 * (distinct[now] + 1)))
            before = now
        assert abs(row.score - score) < 1e-6 * max(1, abs(score))


def check(rows, docs, training):
    counts = Counter(token for text in training for token in tokens(text))
    total, distinct = sum(counts.values()), len(counts)
    for row in rows:
        words = tokens(docs[row.doc_id])
        base = sum(math.log10((counts[word] + 0.5) / (total + 0.5 * (distinct + 1))) for word in words)
        assert abs(row.base_score - base) < 1e-6 * max(1, abs(base))
        assert (row.n_tokens, row.n_known, row.train_tokens) == (len(words), sum(counts[word] > 0 for word in words), total)
        assert row.score < 0 and math.isfinite(row.score)


def test_query(spark):
    docs = {row.doc_id: row.text for row in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = op10_class_model(spark, SF_DIR).collect()
    fold = {doc_id: zlib.crc32(str(doc_id).encode()) % 5 for doc_id in docs}
    assert all(row.held_out == (fold[row.doc_id] == 1) for row in rows)
    check(rows, docs, [text for doc_id, text in docs.items() if fold[doc_id] != 1])


def test_rows_to_learn_from_by_a_condition_or_a_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    docs = docs.unionByName(docs.limit(3).withColumn("doc_id", F.lit(None).cast("long")))
    condition = F.col("doc_id") % 3 != 0
    by_condition = sorted(map(str, score_documents(docs, condition).drop("perplexity").collect()))
    assert by_condition == sorted(map(str, score_documents(docs, docs.where(condition)).drop("perplexity").collect()))


def test_cached_codes_are_those_without_a_cache(spark, monkeypatch):
    monkeypatch.setattr(class_model, "CACHED_WORDS", 40)
    words = [f"w{i}".encode() for i in range(300)]
    known = words[:20]
    pools = np.array([class_model.pool_of(word) for word in known])
    vocabulary = class_model.Vocabulary(class_model.hashes(known), pools, np.arange(20, 0, -1))
    expected = [*range(20), *(-1 - class_model.pool_of(word) for word in words[20:])]
    for _ in range(2):
        for at in range(0, 300, 10):
            assert vocabulary.codes(words[at : at + 10]).tolist() == expected[at : at + 10]
            assert len(vocabulary.cache) <= 60


def test_words_that_are_not_frequent(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    texts = {row.doc_id: row.text for row in docs.collect()}
    few = score_documents(docs, docs, frequent=50).collect()
    check(few, texts, list(texts.values()))
    whole = {row.doc_id: row.score for row in score_documents(docs, docs).collect()}
    assert sum(row.score for row in few) < sum(whole.values()) * 0.5


def test_probabilities_add_up(spark):
    texts = ["a b a c", "b a", "c c a b"]
    docs = spark.createDataFrame([(i, text) for i, text in enumerate(texts)], "doc_id long, text string")
    counts = class_model.count_words(docs).cache()
    model, total, distinct = class_model.learn(counts, docs)
    assert (total, distinct) == (13, 4)
    assert np.allclose((10**model.transition).sum(axis=1), 1)
    path = lambda word: model.score([word, class_model.END])
    label = {word: model.label[model.vocabulary.units(model.vocabulary.codes([word]))[0]] for word in (b"a", b"b", b"c", b"")}
    for one in set(label.values()):
        own = [word for word, other in label.items() if other == one]
        emitted = sum(10 ** (model.known[model.vocabulary.codes([word])[0]] - model.divisor[one]) for word in own)
        assert abs(emitted + 0.5 / 10 ** model.divisor[one] - 1) < 1e-9
    assert path(b"a")[2] == 2 and path(b"never")[2] == 1


def test_the_model_beats_unigrams_on_held_out_texts(spark):
    rows = [row for row in op10_class_model(spark, "/root/testdata/sf0.01").collect() if row.held_out]
    assert sum(row.score for row in rows) > sum(row.base_score for row in rows)


def test_odd_rows(spark):
    rows = [(1, "a b", "x"), (1, "a b", "x"), (None, "zzz", "y"), (2, None, "z"), (3, "", "w")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, words string")
    scored = score_documents(docs, docs).collect()
    assert sorted((row.doc_id or 0, row.n_tokens, row.n_known) for row in scored) == [(0, 2, 2), (1, 3, 3), (1, 3, 3), (2, 1, 1), (3, 1, 1)]
    assert score_documents(docs.limit(0), docs).count() == 0
    unseen = score_documents(docs, docs.limit(0)).collect()
    assert len(unseen) == 5 and all(row.n_known == 0 and math.isfinite(row.score) for row in unseen)


def test_codes_come_whole_however_long(monkeypatch):
    values = [np.arange(n, dtype="<i4").tobytes() for n in (1, 5, 3, 700, 2, 1)]
    for most, parts in ((1 << 20, 1), (64, 6)):
        monkeypatch.setattr(class_model, "_CODE_BYTES", most)
        found = list(class_model._codes(class_model.pa.array(values)))
        assert len(found) == parts
        assert b"".join(codes.tobytes() for _, codes in found) == b"".join(values)


def test_very_long_text(spark):
    texts = {1: " ".join(f"w{i * i % 50021}" for i in range(400_000)), 2: "w1 w4 unseen", 3: "w9 " * 50}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    check(score_documents(docs, F.col("doc_id") != 2, frequent=2_000).collect(), texts, [texts[1], texts[3]])

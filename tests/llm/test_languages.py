"""Language identification: profiles against a plain count, and held-out accuracy."""

from __future__ import annotations

from collections import Counter

from ordermill.llm.languages import (
    Profiles,
    count_grams,
    identify,
    identify_kept,
    learn_profiles,
    op1_language_id,
)


def plain_grams(text):
    words = "".join(char.lower() if char.isalpha() else " " for char in text).split()
    counts = Counter()
    for word in words:
        padded = "\x01" + word + "\x01"
        counts.update(word)
        counts.update(padded[i : i + 2] for i in range(len(padded) - 1))
        counts.update(padded[i : i + 3] for i in range(len(padded) - 2))
    return counts


def packed(gram):
    value = 0
    for char in gram:
        value = value << 21 | ord(char)
    return value


def test_grams(monkeypatch):
    texts = ["", "a", "Ab c", " über-ALL 1x2 ", "日本語 text", "a" * 700, "x y " * 300, "\n.\n"]
    for chunk in (1 << 18, 7):
        monkeypatch.setattr("ordermill.llm.codes.CHUNK", chunk)
        for text in texts:
            keys, counts = count_grams(text)
            assert dict(zip(keys.tolist(), counts.tolist())) == {packed(g): n for g, n in plain_grams(text).items()}


def test_distance():
    rows = [("de", packed("a"), 0), ("de", packed("b"), 1), ("en", packed("b"), 0)]
    # the text's order is a, \x01a, a\x01, \x01a\x01 by the n-gram where counts are equal
    language, score = Profiles(rows, 10).best("a")
    assert language == "de"
    assert score == 1 - (0 + 3 * 10) / (4 * 10)
    assert Profiles(rows, 10).best("zz")[0] == "de"  # equally far from both
    assert Profiles(rows, 10).best("?! 12") == ("und", 0.0)
    assert Profiles([], 10).best("abc") == ("und", 0.0)


def test_profiles_count_every_text(spark):
    texts = ["one two", "two three", "drei", None, "x"]
    docs = spark.createDataFrame([(t, lang) for t, lang in zip(texts, ["en", "en", "de", "de", None])], "text string, lang string")
    learned = learn_profiles(docs, size=5)
    assert learned.languages == ["de", "en"]
    counts = plain_grams("one two") + plain_grams("two three")
    first = sorted(counts, key=lambda g: (-counts[g], packed(g)))[:5]
    column = learned.languages.index("en")
    ranks = {gram: int(rank) for gram, rank in zip(learned.grams.tolist(), learned.ranks[:-1, column]) if rank >= 0}
    assert ranks == {packed(g): i for i, g in enumerate(first)}


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    langs = {row.doc_id: row.lang for row in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    held = [row for row in op1_language_id(spark, sf_dir).collect() if row.held_out]
    assert len(held) > 100
    assert all(0 <= row.score <= 1 for row in held)
    assert sum(row.lang_pred == langs[row.doc_id] for row in held) / len(held) > 0.97


def test_odd_rows(spark):
    rows = [(1, "the same", "en", "a"), (1, "the same", "en", "a"), (None, "the", None, "b"), (2, None, "en", "c"), (3, "", "fr", "d"), (4, "12 !", None, "e"), (5, "жжж щщщ", None, "f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    learned = learn_profiles(docs)
    found = sorted((row.doc_id or 0, row.lang_pred) for row in identify(docs, learned).collect())
    assert found == [(0, "en"), (1, "en"), (1, "en"), (2, "und"), (3, "und"), (4, "und"), (5, "en")]
    kept = identify_kept(docs, learned)
    assert kept.columns == docs.columns
    assert sorted((row.doc_id or 0, row.score) for row in kept.collect()) == [(0, "b"), (1, "a"), (1, "a")]
    empty = docs.limit(0)
    assert identify(empty, learn_profiles(empty)).count() == 0
    assert {row.lang_pred for row in identify(docs, learn_profiles(empty)).collect()} == {"und"}

"""Repeated passages against a search over all windows."""

from __future__ import annotations

import random
import re
import time
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ordermill.llm import substrings
from ordermill.llm.substrings import anchors, difference_cover, remove_repeats, run_numbers, word_numbers


def brute(rows, window=20):
    """rows of (doc_id, text) with distinct ids: (doc_id, n_words, n_removed, kept)."""
    seen, out = set(), []
    for doc_id, text in sorted(rows, key=lambda row: (row[0] is None, row[0] or 0)):
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        gone = set()
        for at in range(len(words) - window + 1):
            passage = tuple(words[at : at + window])
            if passage in seen:
                gone.update(range(at, at + window))
            seen.add(passage)
        out.append((doc_id, len(words), len(gone), " ".join(w for i, w in enumerate(words) if i not in gone)))
    return sorted(out, key=repr)


def cleaned(spark, rows, **more):
    df = remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), **more)
    return sorted(((row.doc_id, row.n_words, row.n_removed, row.kept) for row in df.collect()), key=repr)


def texts(seed, count, vocabulary=400):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(vocabulary)]
    passages = [" ".join(rng.choices(words, k=rng.randint(15, 70))) for _ in range(12)]
    return [
        (i, rng.choice([" ", "\n", "\t "]).join(rng.choice([rng.choice(passages), " ".join(rng.choices(words, k=rng.randint(0, 30)))]) for _ in range(rng.randint(0, 6))))
        for i in range(count)
    ]


@pytest.mark.parametrize("period, cover", [(1, (0,)), (2, (0, 1)), (3, (0, 1)), (7, (0, 1, 3)), (13, (0, 1, 3, 9))])
def test_covers(period, cover):
    assert difference_cover(period) == cover


@settings(deadline=None, max_examples=80)
@given(st.integers(0, 60), st.integers(0, 60), st.integers(20, 45), st.sampled_from([2, 3, 7, 13]))
def test_equal_windows_share_an_aligned_anchor(before, after, size, period):
    passage = np.arange(1000, 1000 + size, dtype=np.uint64)
    shared = []
    for shift, first in ((before, 10**6), (after, 2 * 10**6)):
        text = np.concatenate([np.arange(first, first + shift, dtype=np.uint64), passage])
        runs, places = anchors(text, 20, period)
        shared.append({(int(run), int(place) - shift) for run, place in zip(runs, places) if place >= shift})
    assert shared[0] & shared[1]


@settings(deadline=None, max_examples=100)
@given(st.text(alphabet=" \n\t\x0b\x1cab  é\x00", max_size=60))
def test_words_are_numbered_as_defined(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    numbers = word_numbers(text.encode()).tolist()
    assert len(numbers) == len(words) and len(set(numbers)) == len(set(words))
    assert len(set(zip(words, numbers))) == len(set(words))


def test_pieces_do_not_change_numbers(monkeypatch):
    text = ("alpha beta " * 50 + "x" * 300 + "  " + "gamma " * 40).encode()
    words, runs = word_numbers(text), run_numbers(word_numbers(text), 5)
    for size in (1, 7, 64):
        monkeypatch.setattr(substrings, "CHUNK", size)
        assert (word_numbers(text) == words).all() and (run_numbers(words, 5) == runs).all()


@pytest.mark.parametrize("period", [2, 7, 13])
def test_equals_a_search_over_all_windows(spark, period):
    rows = texts(4, 300)
    assert cleaned(spark, rows, period=period) == brute(rows)


def test_small_buffers_change_nothing(spark):
    rows = texts(9, 200, vocabulary=30)
    assert cleaned(spark, rows, buffer=50) == brute(rows)


def test_overlapping_repeats_within_a_text(spark):
    rows = [(1, "a " * 100), (2, "b " + "a " * 60 + "c"), (3, " ".join(["x", "y", "z"] * 20))]
    assert cleaned(spark, rows) == brute(rows)


def test_odd_rows(spark):
    passage = " ".join(f"p{i}" for i in range(30))
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, passage), (None, passage + " end"), (5, "q" * 200_000 + " " + passage), (6, "short text")]
    assert cleaned(spark, rows) == brute(rows)
    twice = cleaned(spark, [(7, passage), (7, passage), (8, passage)])
    assert [row[2] for row in twice] == [0, 0, 30]  # equal rows are one document
    assert remove_repeats(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_very_long_text_and_clashing_columns(spark):
    rng = random.Random(1)
    long = " ".join(rng.choices([f"w{i}" for i in range(5000)], k=150_000))
    rows = [(1, long), (2, "start " + long[: len(long) // 3])]
    df = spark.createDataFrame([(*row, 1, "x", "y") for row in rows], "doc_id long, text string, mark int, places string, f_id string")
    got = sorted((row.doc_id, row.n_words, row.n_removed, row.kept) for row in remove_repeats(df).collect())
    assert got == brute(rows)
    spans = {row.doc_id: row.spans for row in remove_repeats(df).collect()}
    assert spans[1] == [] and len(spans[2]) == 1 and spans[2][0].first == 1


@settings(deadline=None, max_examples=100)
@given(st.lists(st.one_of(st.integers(0, 5), st.integers(0, 2**32 - 1)), max_size=40))
def test_numbers_that_come_twice(numbers):
    counts = Counter(numbers)
    assert substrings._twice(np.array(numbers, np.uint32)).tolist() == [counts[x] > 1 for x in numbers]


@settings(deadline=None, max_examples=100)
@given(st.lists(st.tuples(st.booleans(), st.one_of(st.integers(0, 300), st.integers(-(2**63), 2**63 - 1)), st.integers(-(2**63), 2**63 - 1)), min_size=1, max_size=20), st.sampled_from([1, 70_000]))
def test_documents_come_back_from_their_bytes(docs, step):
    rows, used = np.array(docs, substrings.DOC), np.arange(len(docs)) * step
    data = substrings._packed_docs(used, rows)
    numbers, got = substrings._unpacked_docs(data, len(docs))
    assert numbers.tolist() == used.tolist() and got.tolist() == rows.tolist()


def test_documents_with_near_ids_take_few_bytes():
    """A window's document is named in each bucket, so with many buckets names were half of what windows shuffled."""
    rows = np.array([(False, 10**12 + 900 * i, 0x7EDCBA9876543210 - i) for i in range(1000)], substrings.DOC)
    assert len(substrings._packed_docs(np.arange(1000), rows)) < 12.2 * 1000


def test_a_bucket_is_sorted_once_however_many_segments_send_to_it():
    """Each segment's runs were once looked up by a sort of the whole bucket's: time as the square of the input."""
    rng = np.random.default_rng(2)
    sent = [rng.integers(0, 1 << 32, 200).astype("<u4") for _ in range(2000)]
    for one, other in zip(sent[::2], sent[1::2]):
        one[:150] = other[:150]
    counted, place = sent[0][150:160], np.arange(200)
    rows = [{"n": 200, "h1": h1.tobytes(), "doc": substrings._packed(place + i), "place": substrings._packed(place)} for i, h1 in enumerate(sent)]
    counts = Counter(np.concatenate([*sent, counted]).tolist())
    began = time.process_time()
    found = {int(doc[0] - at[0]): at.tolist() for _, doc, at in substrings._anchors_twice(rows, counted)}
    assert time.process_time() - began < 2
    wanted = {i: [j for j, x in enumerate(h1.tolist()) if counts[x] > 1] for i, h1 in enumerate(sent)}
    assert found == {i: places for i, places in wanted.items() if places}

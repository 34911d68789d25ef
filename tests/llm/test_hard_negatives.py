"""Hard negatives against a search over all rows."""

from __future__ import annotations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ordermill.llm import hard_negatives
from ordermill.llm.hard_negatives import bounds, hilbert_keys, mine, products


def brute(rows, every, k=5):
    """rows of (id, label, vector); results as `mine` gives them, by definition."""
    rows = [(i, label, [int(np.floor(256 * x)) for x in v]) for i, label, v in rows if None not in (i, label, v)]
    out = []
    for at, (i, label, v) in enumerate(rows):
        if i % every:
            continue
        width = lambda w: list(w) + [0] * (8 - len(w))
        score = lambda w: sum(a * b for a, b in zip(width(v), width(w)))
        others = sorted((-score(w), j, m) for n, (j, m, w) in enumerate(rows) if n != at)
        for s, j, _ in [x for x in others if x[2] == label][:k]:
            inside = [(t, n) for t, n, m in others if m != label and 80 * -s <= 100 * -t <= 100 * -s]
            out += [(i, j, r, n, -s, -t) for r, (t, n) in enumerate(inside[:k], 1)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")


def found(df):
    return sorted(tuple(row) for row in df.collect())


@pytest.mark.parametrize("dims, bits", [(2, 3), (3, 3), (5, 2)])
def test_neighbours_on_the_curve_are_neighbours_in_space(dims, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims), axis=-1).reshape(-1, dims)
    keys = [key.tobytes() for key in hilbert_keys(cells, bits)]
    assert len(set(keys)) == len(cells)
    walk = cells[np.argsort(np.array(keys, object))]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


@settings(deadline=None, max_examples=60)
@given(st.integers(0, 2**32 - 1))
def test_products_lie_within_the_bounds_of_their_block(seed):
    rng = np.random.default_rng(seed)
    vectors, anchors = rng.integers(-300, 300, (20, 6)), rng.integers(-300, 300, (7, 6))
    low, high = bounds(anchors, vectors.min(axis=0)[None], vectors.max(axis=0)[None])
    scores = products(anchors, vectors)
    assert (low <= scores).all() and (scores <= high).all()


def test_products_are_exact_beyond_floating_point():
    big = np.array([[(1 << 27) + 1, 3]])
    assert products(big, big)[0, 0] == ((1 << 27) + 1) ** 2 + 9


@pytest.mark.parametrize("kind", ["spread", "clusters", "copies", "ties"])
def test_equals_a_search_over_all_rows(spark, kind):
    rng = np.random.default_rng(3)
    vectors = rng.normal(0, 0.3, (400, 8))
    if kind == "clusters":
        vectors = rng.normal(0, 1, (6, 8))[rng.integers(0, 6, 400)] + rng.normal(0, 0.05, (400, 8))
    if kind == "copies":
        vectors[::2] = vectors[0]
    if kind == "ties":
        vectors = rng.integers(-1, 2, (400, 8)) / 2
    rows = [(i, int(label), [float(np.float32(x)) for x in v]) for i, label, v in zip(range(400), rng.integers(0, 4, 400), vectors)]
    assert found(mine(frame(spark, rows), F.col("vec_id") % 20 == 0, block_rows=16)) == brute(rows, 20)


def test_distant_blocks_are_not_read(spark, monkeypatch):
    """With clusters, anchors read only some of the blocks."""
    rng = np.random.default_rng(5)
    vectors = rng.normal(0, 1, (40, 8))[np.arange(2000) // 50] + rng.normal(0, 0.01, (2000, 8))
    rows = [(i, i % 2, [float(x) for x in v]) for i, v in enumerate(vectors)]
    read = []
    kept = hard_negatives._read

    def counting(chunks, blocks, parts, wanted, evaluate, schema):
        zones = hard_negatives.Zones([row.asDict() for row in blocks.collect()])
        for row in chunks.collect():
            read.append(wanted(hard_negatives.Anchors(row.asDict()), zones).mean())
        return kept(chunks, blocks, parts, wanted, evaluate, schema)

    monkeypatch.setattr(hard_negatives, "_read", counting)
    assert found(mine(frame(spark, rows), F.col("vec_id") % 100 == 0, block_rows=25)) == brute(rows, 100)
    assert max(read) < 0.25


def test_odd_rows(spark):
    rows = [
        (0, 1, [1.0, 0.0]), (0, 1, [1.0, 0.0]), (1, 1, [0.9, 0.1]), (2, 2, [0.9]), (3, None, [1.0, 0.0]), (4, 2, None), (None, 2, [0.9, 0.0]),
        (5, 2, [0.9, 0.0]), (5, 2, [0.9, 0.0]), (6, 1, []),
    ]
    bad = [(7, 2, [0.95, None]), (8, 2, [float("nan"), 0.0]), (9, 2, [float("inf"), 0.0])]
    docs = frame(spark, rows + bad).withColumn("block", F.lit("x")).withColumn("score", F.lit(1))
    assert found(mine(docs, F.col("vec_id") % 10 == 0)) == brute(rows, 10)


def test_empty_table_and_large_components(spark):
    empty = mine(frame(spark, []), F.col("vec_id") % 10 == 0)
    assert empty.collect() == [] and empty.columns == [x.split()[0] for x in hard_negatives.RESULT.split(", ")]
    assert mine(frame(spark, [(0, None, [1.0])]), F.col("vec_id") % 10 == 0).collect() == []
    with pytest.raises(ValueError, match="55 bits"):
        mine(frame(spark, [(0, 1, [1e30])]), F.col("vec_id") % 10 == 0)


def test_anchors_are_not_broadcast(spark, monkeypatch):
    """Anchors times partitions once went through the driver, as Spark took them for the few bytes of their file."""
    rng = np.random.default_rng(7)
    rows = [(i, i % 3, [float(x) for x in v]) for i, v in enumerate(rng.normal(0, 0.3, (300, 8)))]
    plans, kept = [], hard_negatives.staged
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(hard_negatives, "staged", lambda df, name: (plans.append(plan(df)), kept(df, name))[1])
    result = mine(frame(spark, rows), F.col("vec_id") % 20 == 0, block_rows=16)
    assert len(plans) == 4 and not [x for x in (*plans, plan(result)) if "Broadcast" in x]
    assert found(result) == brute(rows, 20)


def test_many_parts_answer_once_each(spark):
    """Of parts that share their blocks out, each sends an anchor's first rows, not every block's."""
    rng = np.random.default_rng(11)
    vectors = rng.integers(-2, 3, (600, 8)) / 4
    vectors[::3] = vectors[0]
    rows = [(i, int(label), [float(x) for x in v]) for i, label, v in zip(range(600), rng.integers(0, 3, 600), vectors)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "48")
    try:
        assert found(mine(frame(spark, rows), F.col("vec_id") % 20 == 0, block_rows=4)) == brute(rows, 20)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.mark.parametrize("scale", [1, 1 << 13, 1 << 24])
def test_products_of_blocks_are_exact_in_any_type(scale):
    rng = np.random.default_rng(scale)
    vectors = rng.integers(-scale, scale + 1, (40, 6))
    zone = {"low": vectors.min(axis=0).astype("<i4").tobytes(), "high": vectors.max(axis=0).astype("<i4").tobytes()}
    zone |= {"block": 1, "n": 40, "first_id": 0, "last_id": 39, "label_low": 0, "label_high": 0}
    longs = {name: np.arange(40).astype("<i8").tobytes() for name in ("ids", "labels")}
    part = hard_negatives.Part([zone | longs | {"vectors": hard_negatives._packed(vectors)}])
    for anchors in (vectors[:7] * 0, vectors[:7], vectors[:7] * 3):  # none of them spoils the rows for the next
        ((columns, scores),) = part.tiles(anchors, np.array([0]))
        assert (scores.astype(np.int64) == anchors @ vectors[columns].T).all()


def test_large_negative_components_are_an_error(spark):
    with pytest.raises(ValueError, match="55 bits"):
        mine(frame(spark, [(0, 1, [-1e30])]), F.col("vec_id") % 10 == 0)

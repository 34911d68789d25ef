"""The manifest against a tree built by definition."""

from __future__ import annotations

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from ordermill.llm import merkle
from ordermill.llm.merkle import Ladder, folded, leaf_digest, manifest, op12_merkle_manifest, proof_digest

SF_DIR = "/root/testdata/sf0.001"


def h(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def leaf_of(*values):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(nodes):
    """Root, and for each node the siblings of its way up as (before, after)."""
    paths, place = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, at in enumerate(place):
            start = at // 3 * 3
            paths[i].append(("".join(nodes[start:at]), "".join(nodes[at + 1 : start + 3])))
            place[i] = at // 3
        nodes = [h(*nodes[a : a + 3]) for a in range(0, len(nodes), 3)]
    return nodes[0], paths


def brute(rows):
    """rows of (source, doc_id, leaf): (doc_id, leaf, subroot, root, proof, fold) of each."""
    key = lambda v: (v is not None, v.encode() if isinstance(v, str) else v or 0)
    sources = sorted({row[0] for row in rows}, key=key)
    trees = {}
    for source in sources:
        own = sorted((row for row in rows if row[0] == source), key=lambda row: (key(row[1]), row[2]))
        trees[source] = own, *climb([row[2] for row in own])
    root, upper = climb([trees[source][1] for source in sources])
    out = []
    for source, above in zip(sources, upper):
        own, subroot, paths = trees[source]
        for (_, doc_id, leaf), path in zip(own, paths):
            node = leaf
            for before, after in path + above:
                node = h(before, node, after)
            assert node == root
            out.append((doc_id, leaf, subroot, root, h(*(a + b for a, b in path + above))))
    return sorted(out, key=repr)


def proved(spark, rows, levels=merkle.LEVELS):
    df = manifest(spark.createDataFrame(rows, "source string, doc_id long, leaf string"), levels)
    root = folded(F.col("leaf"), F.col("left"), F.col("right"))
    got = df.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("left"), F.col("right")), root.alias("fold")).collect()
    assert all(row.fold == row.root for row in got)
    return sorted((tuple(row)[:5] for row in got), key=repr)


@pytest.mark.parametrize("levels", [2, merkle.LEVELS])
def test_sources_of_any_size(spark, levels):
    sizes = [1, 2, 3, 4, 8, 9, 10, 27, 28, 80, 81, 82, 729, 730]
    rows = [(f"s{size}", i, h(str(size), str(i))) for size in sizes for i in range(size)]
    assert proved(spark, rows, levels) == brute(rows)


@pytest.mark.parametrize("count", [1, 3, 10])
def test_one_source(spark, count):
    rows = [(None, i, h(str(i))) for i in range(count)]
    assert proved(spark, rows) == brute(rows)


def test_many_sources_in_byte_order(spark):
    names = [None, "", "Z", "a", "é", "\U0001f600", "￿", *(f"s{i}" for i in range(800))]
    rows = [(name, i, h(str(name), str(i))) for name in names for i in range(2)]
    assert proved(spark, rows) == brute(rows)


def test_repeated_rows_and_null_ids(spark):
    rows = [("a", 1, h("x")), ("a", 1, h("x")), ("a", 1, h("y")), ("a", None, h("x")), ("a", None, h("x")), (None, None, h("z"))]
    assert proved(spark, rows) == brute(rows)


def test_intervals_of_a_ladder():
    ladder = Ladder(list(range(10)), list(range(10)), [h(str(i)) for i in range(10)], 0)
    assert [(low.tolist(), high.tolist()) for low, high, _ in ladder.levels[1:]] == [
        ([0, 3, 6, 9], [2, 5, 8, 9]), ([0, 9], [8, 9]), ([0], [9]),
    ]


def test_leaf_digest_counts_bytes(spark):
    rows = [(1, "ä\n", None), (2, "", "x"), (3, None, "y" * 200_000)]
    df = spark.createDataFrame(rows, "a long, b string, c string")
    got = {row.a: row.h for row in df.select("a", leaf_digest(F.col("a"), F.col("b"), F.col("c")).alias("h")).collect()}
    assert got == {row[0]: leaf_of(*row) for row in rows}


def test_empty_table_and_other_columns(spark):
    empty = manifest(spark.createDataFrame([], "source string, doc_id long, leaf string"))
    assert empty.collect() == []
    df = spark.createDataFrame([("s", "id-1", h("x"), 7, "p")], "source string, doc_id string, leaf string, rank int, part string")
    row = manifest(df).first()
    assert (row.doc_id, row.rank, row.part, row.root) == ("id-1", 7, "p", h("x"))


def test_query_finds_exactly_the_tampered(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    got = {row.doc_id: row for row in op12_merkle_manifest(spark, SF_DIR).collect()}
    assert len(got) == len(docs)
    for doc in docs:
        cut = zlib.crc32(str(doc.doc_id).encode()) % 2 == 0 and "\n" in (doc.text or "")
        assert got[doc.doc_id].verified == (not cut)
        assert got[doc.doc_id].leaf == leaf_of(doc.doc_id, doc.source, doc.lang, doc.n_chars, doc.text)
    assert {row.verified for row in got.values()} == {True, False}

"""SimHash near duplicates: fingerprints, vantage-point shards, connected components.

Distances between fingerprints are Hamming distances, a metric. A vantage-point tree halves a set by
its members' distance to one of them; by the triangle bound a partner within `reach` bits of a
fingerprint whose distance to the vantage point is d lies between d - reach and d + reach, so a
side that has no such distance is skipped. The upper levels deal fingerprints to shards; a fingerprint
near a boundary is a visitor in the shards beyond it as well. Each shard builds the lower levels
of its own residents and looks up residents and visitors there, which finds every pair.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.llm.batches import map_rows, table
from ordermill.session import staged

WORDS = 3
REACH = 3
SHARD = 8_192
SAMPLE = 65_536
LEAF = 96
SEED = 42


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """64-bit SimHash as a signed integer; 0 if the text has no word."""
    found = (text or "").encode().lower().split()  # both treat ASCII alone, as the definition does
    if not found:
        return 0
    joined = b" ".join(found)
    ends = np.cumsum([len(word) + 1 for word in found]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    if len(found) > words:
        starts, ends = starts[: len(found) - words + 1], ends[words - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_digest
    ones = np.zeros(64, np.int64)
    for at in range(0, len(starts), 32_768):
        pairs = zip(starts[at : at + 32_768].tolist(), ends[at : at + 32_768].tolist())
        hashes = b"".join([digest(joined[a:b], SEED) for a, b in pairs])
        bits = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int32)
    value = np.packbits(2 * ones > len(starts)).tobytes()
    return int.from_bytes(value, "big", signed=True)


def fingerprints(docs: DataFrame, words: int = WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    kept = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return map_rows(kept, "doc_id long, fp long", lambda: lambda doc_id, text: (doc_id, fingerprint(text, words)))


def distances(values: np.ndarray, point: np.uint64) -> np.ndarray:
    return np.bitwise_count(values ^ point)


def grow(values: np.ndarray, depth: int, leaf: int) -> tuple | None:
    """Vantage-point tree as nested (point, radius, near side, far side); None is a leaf."""
    if depth == 0 or len(values) <= leaf:
        return None
    point = values[len(values) // 2]
    d = distances(values, point)
    radius = int(np.partition(d, len(d) // 2)[len(d) // 2])
    if radius == d.max():
        radius -= 1
    if radius < d.min():
        return None
    near = d <= radius
    return point, radius, grow(values[near], depth - 1, leaf), grow(values[~near], depth - 1, leaf)


def leaves(tree: tuple | None) -> int:
    return 1 if tree is None else leaves(tree[2]) + leaves(tree[3])


def deal(tree: tuple | None, values: np.ndarray, reach: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Shard number, the positions of its residents, and of its visitors.

    Of two linked fingerprints the one whose home has the lower number visits the other's home.
    """

    def walk(node, first, home, guests):
        if node is None:
            yield first, home, guests
            return
        point, radius, near, far = node
        beyond = first + leaves(near)
        d_home, d_guests = distances(values[home], point), distances(values[guests], point)
        inside = home[d_home <= radius]
        yield from walk(near, first, inside, guests[d_guests <= radius + reach])
        crossing = inside[distances(values[inside], point) > radius - reach]
        guests = np.concatenate([guests[d_guests > radius - reach], crossing])
        yield from walk(far, beyond, home[d_home > radius], guests)

    yield from walk(tree, 0, np.arange(len(values)), np.zeros(0, np.int64))


def links(residents: np.ndarray, guests: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions (in residents, then guests) whose links join the same sets as all pairs do.

    At each leaf a searcher is joined to the first resident that it reaches, and that resident to the
    others that a searcher reaches along with it: linear in searchers, whatever the leaf holds.
    """
    values = np.concatenate([residents, guests])
    found: list[tuple[np.ndarray, np.ndarray]] = []

    def walk(own: np.ndarray, searching: np.ndarray) -> None:
        if not len(own) or not len(searching):
            return
        node = grow(values[own], 1, LEAF)
        if node is None:
            for at in range(0, len(own), LEAF):  # fingerprints that no radius divides
                match(own[at : at + LEAF], searching)
            return
        point, radius = node[:2]
        d_own, d = distances(values[own], point), distances(values[searching], point)
        walk(own[d_own <= radius], searching[d <= radius + reach])
        walk(own[d_own > radius], searching[d > radius - reach])

    def match(own: np.ndarray, searching: np.ndarray) -> None:
        for at in range(0, len(searching), 16_384):
            some = searching[at : at + 16_384]
            near = np.bitwise_count(values[some][:, None] ^ values[own][None, :]) <= reach
            near &= some[:, None] != own[None, :]
            hits = np.flatnonzero(near.any(axis=1))
            if not len(hits):
                continue
            near = near[hits]
            first = near.argmax(axis=1)
            found.append((some[hits], own[first]))
            many = np.flatnonzero(near.sum(axis=1) > 1)
            row, other = np.nonzero(near[many])
            pairs = np.unique(first[many][row] * len(own) + other)
            found.append((own[pairs // len(own)], own[pairs % len(own)]))

    walk(np.arange(len(residents)), np.arange(len(values)))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(side) for side in zip(*found))


def sets(size: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Smallest position reachable from each position."""
    label = np.arange(size)
    while True:
        low = np.minimum(label[left], label[right])
        new = label.copy()
        for side in (left, right):
            np.minimum.at(new, side, low)
            np.minimum.at(new, label[side], low)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def shard_edges(nodes: DataFrame, reach: int = REACH, shard: int = SHARD, sample: int = SAMPLE) -> DataFrame:
    """Edges (a, b) between distinct fingerprints `fp`, with the components that all links give.

    The upper tree is fitted on at most `sample` fingerprints, those with the smallest hashes; every
    fingerprint is then dealt. Each shard returns at most one edge per fingerprint in it.
    """
    spark = nodes.sparkSession
    total = nodes.count()
    depth = max(0, math.ceil(math.log2(max(1, total / shard))))
    chosen = nodes.orderBy(F.xxhash64("fp")).limit(sample).toArrow()["fp"].to_numpy() if depth else np.zeros(0, np.int64)
    shared = spark.sparkContext.broadcast(grow(chosen.view(np.uint64), depth, 2))

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy()
            for number, home, guests in deal(shared.value, values.view(np.uint64), reach):
                size = len(home) + len(guests)
                if size:
                    yield pa.record_batch(
                        {
                            "shard": np.full(size, number, np.int32),
                            "fp": values[np.concatenate([home, guests])],
                            "resident": np.arange(size) < len(home),
                        }
                    )

    def joined(group: pa.Table) -> pa.Table:
        resident = group["resident"].to_numpy(zero_copy_only=False)
        fp = group["fp"].to_numpy()
        values = np.concatenate([fp[resident], fp[~resident]])
        left, right = links(values[: resident.sum()].view(np.uint64), values[resident.sum() :].view(np.uint64), reach)
        label = sets(len(values), left, right)
        linked = np.flatnonzero(label != np.arange(len(values)))
        return pa.table({"a": values[linked], "b": values[label[linked]]})

    return (
        nodes.select("fp")
        .mapInArrow(dealt, "shard int, fp long, resident boolean")
        .groupBy("shard")
        .applyInArrow(joined, "a long, b long")
    )


def connected(edges: DataFrame) -> DataFrame:
    """(node, root): every node that has an edge, and the smallest node of its component.

    Alternates large-star and small-star rounds until nothing changes. Each round is a table in the
    shared folder, so that a lost executor costs one round and the plan does not grow.
    """

    def lowered(pairs: DataFrame) -> DataFrame:
        return pairs.groupBy("u").agg(F.min("v").alias("low")).withColumn("low", F.least("u", "low"))

    def state(pairs: DataFrame) -> tuple:
        return tuple(pairs.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())

    pairs = staged(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    seen = state(pairs)
    while seen[0]:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(lowered(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v"))
        large = staged(large.distinct(), "large")
        low = lowered(large)
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v")).where("u != v")
        pairs = staged(small.unionByName(low.select("u", F.col("low").alias("v"))).distinct(), "small")
        now = state(pairs)
        if now == seen:
            break
        seen = now
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("root"))


def components(marked: DataFrame, reach: int = REACH, shard: int = SHARD) -> DataFrame:
    """(fp, first, root): each distinct fingerprint, its smallest id, and the smallest fingerprint of its component."""
    nodes = staged(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "nodes")
    stars = connected(shard_edges(nodes, reach, shard))
    return nodes.join(stars, nodes.fp == stars.node, "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))


def near_duplicates(
    docs: DataFrame,
    words: int = WORDS,
    reach: int = REACH,
    shard: int = SHARD,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Fingerprint and component of every document; one row per input row.

    Returns doc_id, `fingerprint` (16 hex digits) and `component_id`, the smallest id that is
    reachable over links of `reach` bits or fewer. NULL, empty and blank texts have fingerprint zero and
    are linked like any other; of a very long one all shingles count. Rows with a NULL id take part, but do not name a component: one whose
    ids are all NULL has a NULL component. Rows of the same id and text are equal and stay.
    """
    marked = staged(fingerprints(docs, words, id_col, text_col), "fingerprints")
    rooted = components(marked, reach, shard)
    names = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(names, "root").select("fp", "component_id")
    return marked.join(named, "fp").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def keep_first(
    docs: DataFrame,
    words: int = WORDS,
    reach: int = REACH,
    id_col: str = "doc_id",
    text_col: str = "text",
    null_ids_stay: bool = True,
) -> DataFrame:
    """One row of each group of near duplicates, with all its columns.

    That with the smallest id stays; of rows that share the id, the one whose text has the smallest
    SHA-256, and of equal texts one by a hash of all columns but maps. Rows without an id all stay, unless
    `null_ids_stay` is False: then they come after all others of their group, of which one row stays in any case.
    """
    own_id, mark = F.col(id_col).cast("long"), F.sha2(F.col(text_col).cast("binary"), 256)
    key = F.concat_ws(":", F.coalesce(own_id.cast("string"), F.lit("-")), F.coalesce(mark, F.lit("-")))
    texts = docs.select(own_id.alias("doc_id"), F.col(text_col).alias("text"), key.alias("key"))
    own = map_rows(
        texts, "doc_id long, fp long, key string", lambda: lambda doc_id, text, key: (doc_id, fingerprint(text, words), key)
    )
    marked = staged(own, "fingerprints")
    ranked = marked.where("doc_id IS NOT NULL") if null_ids_stay else marked
    roots = components(marked, reach).select("fp", "root")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "key")).alias("best")
    first = ranked.join(roots, "fp").groupBy("root").agg(best).select("best.key")
    # equal rows are combined before the one shuffle of whole rows, which the aggregate and the join share
    columns = {name: F.col(f"`{name}`") for name in docs.columns}
    hashed = [columns[field.name] for field in docs.schema if "map<" not in field.dataType.simpleString()]
    named = docs.where(own_id.isNotNull()) if null_ids_stay else docs
    rows = named.groupBy(key.alias("key")).agg(F.min_by(F.struct(*columns.values()), F.xxhash64(*hashed)).alias("row"))
    kept = rows.join(first, "key", "left_semi").select("row.*")
    return kept.unionByName(docs.where(own_id.isNull())) if null_ids_stay else kept


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))

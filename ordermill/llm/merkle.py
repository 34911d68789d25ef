"""Merkle manifest of a dataset: a tree of digests per source, and one over the sources.

Every node is labelled with the interval of leaf ranks that it covers. Leaves are packed in buckets of
ARITY**levels ranks, the nodes above them in buckets of as many nodes, and so on: a node's ancestors in its own bucket are the nodes whose
interval contains its own, and those further up come by a join on the bucket of the next band, with the same
containment as its condition. What is left of the parent's interval without the node's own are its siblings.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ordermill.llm.batches import map_rows, rows_of, table
from ordermill.session import staged

ARITY = 3
LEVELS = 6
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*texts: str) -> str:
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def leaf_digest(*values: Column) -> Column:
    """SHA-256 of the values, each as byte count, colon and text; NULL is a dash."""
    parts = [
        F.when(value.isNull(), "-").otherwise(
            F.concat(F.octet_length(value.cast("string")).cast("string"), F.lit(":"), value.cast("string"))
        )
        for value in values
    ]
    return F.sha2(F.concat(*parts).cast("binary"), 256)


class Ladder:
    """The levels above some neighbouring nodes: per level the nodes' intervals and digests.

    `index` is the number of their bucket in the group. In the only bucket of a group the levels end at a single node; where there
    are several, as the first one shows by being full, all `levels` of a bucket are built.
    """

    def __init__(self, lows: list[int], highs: list[int], digests: list[str], index: int, levels: int = LEVELS):
        whole = index > 0 or len(digests) == ARITY**levels
        self.levels = [(np.array(lows), np.array(highs), digests)]
        while len(self.levels) <= levels and (whole or len(self.levels[-1][2]) > 1):
            low, high, below = self.levels[-1]
            starts = range(0, len(below), ARITY)
            self.levels.append(
                (low[::ARITY], high[[min(at + ARITY, len(below)) - 1 for at in starts]], [digest(*below[at : at + ARITY]) for at in starts])
            )

    @property
    def top(self) -> str:
        return self.levels[-1][2][0]

    def paths(self) -> Iterator[tuple[list[str], list[str]]]:
        """For each of the lowest nodes: its siblings' digests before and after it, level by level."""
        steps = []
        for (low, high, digests), (over_low, over_high, _) in zip(self.levels, self.levels[1:]):
            parent = np.searchsorted(over_low, low, "right") - 1  # the one whose interval contains the node's
            first = np.searchsorted(low, over_low[parent], "left")
            last = np.searchsorted(high, over_high[parent], "right")
            before = ["".join(digests[a:i]) for i, a in enumerate(first.tolist())]
            after = ["".join(digests[i + 1 : b]) for i, b in enumerate(last.tolist())]
            steps.append((before, after, parent.tolist()))
        for node in range(len(self.levels[0][2])):
            left, right = [], []
            for before, after, parent in steps:
                left.append(before[node])
                right.append(after[node])
                node = parent[node]
            yield left, right


def ranked(rows: DataFrame, group: str, *order: str) -> DataFrame:
    """Adds `rank`, from 0 within each group by `order`.

    Rows are dealt by range, so a group may span partitions; tasks number their own rows, and what lies before a part is
    added for its first group, from a table of one row per part.
    """
    count = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    schema = T.StructType([*rows.schema.fields, T.StructField("part", T.IntegerType()), T.StructField("row", T.LongType())])
    fields, at = to_arrow_schema(schema), rows.columns.index(group)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, current, row = TaskContext.get().partitionId(), object(), 0
        for batch in batches:
            numbers = []
            for value in batch.column(at).to_pylist():
                if value != current:
                    current, row = value, 0
                numbers.append(row)
                row += 1
            yield pa.record_batch([*batch.columns, pa.array([part] * len(numbers), pa.int32()), pa.array(numbers, pa.int64())], schema=fields)

    dealt = rows.repartitionByRange(count, group, *order).sortWithinPartitions(group, *order)
    own = staged(dealt.mapInArrow(run, schema), "numbered")
    counts = own.groupBy(F.col(group).alias("b_group"), F.col("part").alias("b_part")).agg(F.count("*").alias("n"))
    so_far = Window.partitionBy("b_group").orderBy("b_part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.withColumn("before", F.sum("n").over(so_far)).where("before > 0").drop("n")
    joined = own.join(F.broadcast(before), F.col(group).eqNullSafe(F.col("b_group")) & (F.col("part") == F.col("b_part")), "left")
    return joined.select(*rows.columns, (F.col("row") + F.coalesce("before", F.lit(0))).alias("rank"))


def _climb(nodes: DataFrame, levels: int) -> DataFrame:
    """(grp, index, low, high, left, right, root) of nodes (grp, index, low, high, digest): their siblings on the way up.

    One band of levels after another; each band has 1 / ARITY**levels of the nodes of the one below.
    """

    def band(grp, up, items):
        ladder = Ladder([x["low"] for x in items], [x["high"] for x in items], [x["digest"] for x in items], up, levels)
        return grp, up, items[0]["low"], items[-1]["high"], ladder.top, [
            {"index": x["index"], "low": x["low"], "high": x["high"], "left": left, "right": right}
            for x, (left, right) in zip(items, ladder.paths())
        ]

    schema = (
        "grp string, index long, low long, high long, digest string, "
        "items array<struct<index long, low long, high long, left array<string>, right array<string>>>"
    )
    bands, current = [], nodes
    while current.agg(F.max("index")).first()[0]:
        item = F.sort_array(F.collect_list(F.struct("index", "low", "high", "digest"))).alias("items")
        groups = current.groupBy("grp", F.expr(f"index div {ARITY**levels}").alias("up")).agg(item)
        bands.append(staged(map_rows(groups, schema, lambda: band), "band"))
        current = bands[-1].select("grp", "index", "low", "high", "digest")
    none = F.array().cast("array<string>")
    found = current.select("grp", "index", "low", "high", none.alias("left"), none.alias("right"), F.col("digest").alias("root"))
    for below in reversed(bands):
        over = found.select(*[F.col(name).alias(f"o_{name}") for name in found.columns])
        child = below.select(F.col("grp"), F.col("index").alias("up"), F.explode("items").alias("c")).select("grp", "up", "c.*")
        inside = F.col("low").between(F.col("o_low"), F.col("o_high"))
        found = child.join(over, F.col("grp").eqNullSafe(F.col("o_grp")) & (F.col("up") == F.col("o_index")) & inside).select(
            "grp", "index", "low", "high",
            F.concat("left", "o_left").alias("left"), F.concat("right", "o_right").alias("right"), F.col("o_root").alias("root"),
        )
    return found


def _packed(rows: DataFrame, item: Column, levels: int) -> DataFrame:
    """Ranked rows in buckets of ARITY**levels ranks: (grp, index, items), the items by rank."""
    bucket = F.expr(f"rank div {ARITY**levels}").alias("index")
    return staged(rows.groupBy("grp", bucket).agg(F.sort_array(F.collect_list(item)).alias("items")), "buckets")


def _tops(packs: DataFrame, levels: int) -> DataFrame:
    def top(grp, index, digests):
        low = index * ARITY**levels
        ranks = list(range(low, low + len(digests)))
        return grp, index, low, ranks[-1], Ladder(ranks, ranks, digests, index, levels).top

    kept = packs.select("grp", "index", F.transform("items", lambda x: x["leaf"]).alias("digests"))
    return staged(map_rows(kept, "grp string, index long, low long, high long, digest string", lambda: top), "tops")


def manifest(leaves: DataFrame, levels: int = LEVELS) -> DataFrame:
    """Proofs of all rows: the columns of `leaves`, `subroot`, `root`, and `left`, `right`, arrays of text.

    `leaves` has doc_id, source, leaf and any other columns that can be ordered, not named like the added ones. Per source the leaves ascend by doc_id, NULL first, equal ids
    by leaf and then by the other columns; repeated rows are leaves of their own. A run of ARITY neighbours becomes the digest of
    their digests, until one is left, and the sources' subroots, NULL first, likewise. `left` and `right` hold for each level what stands
    before and after the node there: folding a leaf with them gives `root`. Rows without a source form a group like any other. An
    empty table has no root and gives no rows.
    """
    names = [name for name in leaves.columns if name not in ("doc_id", "source", "leaf")]
    more = F.struct(F.lit(True).alias("_"), *[F.col(f"`{name}`") for name in names]).alias("more")
    kept = leaves.select(F.col("source").cast("string").alias("grp"), "doc_id", "leaf", more)
    rows = ranked(staged(kept, "leaves"), "grp", "doc_id", "leaf", "more")
    packs = _packed(rows, F.struct("rank", "doc_id", "leaf", "more"), levels)
    up = staged(_climb(_tops(packs, levels), levels), "climbed")

    sources = up.where("index = 0").select(F.lit("").alias("grp"), F.col("grp").alias("source"), F.col("root").alias("leaf"))
    spread = _packed(ranked(staged(sources, "subroots"), "grp", "source"), F.struct("rank", "source", "leaf"), levels)
    over = _join_packs(spread, _climb(_tops(spread, levels), levels), ["source"], None, levels)
    over = over.select(*[F.col(name).alias(f"s_{name}") for name in ("source", "left", "right", "root")])
    whole = up.join(over, F.col("grp").eqNullSafe(F.col("s_source"))).select(
        "grp", "index", "low", "high", F.concat("left", "s_left").alias("left"), F.concat("right", "s_right").alias("right"),
        F.col("root").alias("subroot"), F.col("s_root").alias("root"),
    )
    proved = _join_packs(packs, whole, ["doc_id", "leaf", "more"], "source", levels)
    own = ["source", "doc_id", "leaf", "subroot", "root", "left", "right"]
    return proved.select(*own, *[F.col("more").getField(name).alias(name) for name in names])


def _join_packs(packs: DataFrame, up: DataFrame, names: list[str], group: str | None, levels: int) -> DataFrame:
    """One row per packed row, with its siblings in the bucket and those that `up` has for the bucket."""
    extra = [name for name in ("subroot", "root") if name in up.columns]
    above = up.select(*[F.col(name).alias(f"u_{name}") for name in ("grp", "index", "left", "right", *extra)])
    joined = packs.join(above, F.col("grp").eqNullSafe(F.col("u_grp")) & (F.col("index") == F.col("u_index")))
    joined = joined.select("grp", "index", "items", "u_left", "u_right", *[f"u_{name}" for name in extra])
    item = packs.schema["items"].dataType.elementType
    schema = T.StructType(
        ([T.StructField(group, T.StringType())] if group else [])
        + [item[name] for name in names]
        + [T.StructField(name, T.StringType()) for name in extra]
        + [T.StructField(name, T.ArrayType(T.StringType())) for name in ("left", "right")]
    )
    fields = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):  # a bucket at a time
                for grp, index, items, above_left, above_right, *roots in rows_of(batch.slice(i, 1)):
                    ranks = [x["rank"] for x in items]
                    ladder = Ladder(ranks, ranks, [x["leaf"] for x in items], index, levels)
                    out = [
                        ((grp,) if group else ()) + tuple(x[name] for name in names) + (*roots, left + above_left, right + above_right)
                        for x, (left, right) in zip(items, ladder.paths())
                    ]
                    yield pa.record_batch([pa.array(list(c), f.type) for c, f in zip(zip(*out), fields)], schema=fields)

    return joined.mapInArrow(run, schema)


def folded(leaf: Column, left: Column, right: Column) -> Column:
    """The root that a leaf and its siblings give."""
    steps = F.arrays_zip(left.alias("left"), right.alias("right"))
    return F.aggregate(steps, leaf, lambda node, step: F.sha2(F.concat(step["left"], node, step["right"]).cast("binary"), 256))


def proof_digest(left: Column, right: Column) -> Column:
    """Digest of all siblings, level by level, left to right."""
    return F.sha2(F.concat_ws("", F.zip_with(left, right, lambda a, b: F.concat(a, b))).cast("binary"), 256)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*LEAF_COLUMNS)
    columns = {name: F.col(name) for name in LEAF_COLUMNS}
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    cut = F.when(even & F.contains("text", F.lit("\n")), leaf_digest(*(columns | {"text": F.replace("text", F.lit("\n"), F.lit(""))}).values()))
    leaves = docs.select("doc_id", "source", leaf_digest(*columns.values()).alias("leaf"), cut.alias("tampered"))
    proved = manifest(leaves)
    root = folded(F.coalesce("tampered", "leaf"), F.col("left"), F.col("right"))
    return proved.select(
        "doc_id", "leaf", "subroot", "root", proof_digest(F.col("left"), F.col("right")).alias("proof_sha256"), root.alias("folded_root")
    ).withColumn("verified", F.col("folded_root") == F.col("root"))



def _tree_sql(name: str, source: str, columns: str) -> str:
    """CTEs `<name>_nodes`, `<name>_runs` and `<name>_paths` over `source` (grp, idx, n, digest, and the given columns)."""
    return f"""
{name}_nodes AS (
  SELECT grp, 0 AS level, idx, n, digest FROM {source}
  UNION ALL
  SELECT grp, level + 1, idx // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY idx))
  FROM {name}_nodes WHERE n > 1 GROUP BY grp, level, idx // 3, n),
{name}_runs AS (
  SELECT grp, level, idx // 3 AS run, list(digest ORDER BY idx) AS digests FROM {name}_nodes WHERE n > 1 GROUP BY ALL),
{name}_paths AS (
  SELECT {columns}, list({{'l': array_to_string(digests[:place - 1], ''), 'r': array_to_string(digests[place + 1:], ''), 'd': ''}}
    ORDER BY level) FILTER (level IS NOT NULL) AS path
  FROM (
    SELECT {source}.*, level, digests, {source}.idx // CAST(power(3, level) AS BIGINT) % 3 + 1 AS place
    FROM {source} LEFT JOIN {name}_runs
      ON {source}.grp IS NOT DISTINCT FROM {name}_runs.grp AND {source}.idx // CAST(power(3, level + 1) AS BIGINT) = run)
  GROUP BY ALL)"""


def _leaf_sql(text: str) -> str:
    values = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text]
    return "sha256(" + " || ".join(f"coalesce(octet_length(encode({v})) || ':' || {v}, '-')" for v in values) + ")"


# 3988292384 is the reversed polynomial of CRC-32; the last step of the checksum flips its lowest bit.
OP12_SQL = f"""
WITH RECURSIVE
steps AS (
  SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) ORDER BY i) AS t
  FROM range(256) AS r(i)),
marked AS (
  SELECT source, doc_id, {_leaf_sql("text")} AS leaf,
    CASE WHEN list_reduce([CAST(ascii(x) AS BIGINT) FOR x IN string_split(CAST(doc_id AS VARCHAR), '')],
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295) & 1 = 1
      THEN {_leaf_sql("replace(text, chr(10), '')")} END AS tampered
  FROM documents, steps),
leaves AS (
  SELECT source AS grp, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
    count(*) OVER (PARTITION BY source) AS n, leaf AS digest, doc_id, tampered
  FROM marked),
{_tree_sql("leaf", "leaves", "grp, idx, digest, doc_id, tampered")},
subroots AS (
  SELECT 0 AS grp, row_number() OVER (ORDER BY grp NULLS FIRST) - 1 AS idx, count(*) OVER () AS n, digest, grp AS source
  FROM leaf_nodes WHERE n = 1),
{_tree_sql("sub", "subroots", "digest, source")},
proofs AS (
  SELECT doc_id, leaf_paths.digest AS leaf, tampered, sub_paths.digest AS subroot,
    list_concat(coalesce(leaf_paths.path, []), coalesce(sub_paths.path, [])) AS path
  FROM leaf_paths JOIN sub_paths ON grp IS NOT DISTINCT FROM source),
folded AS (
  SELECT *, list_reduce(path, lambda a, s: {{'l': '', 'r': '', 'd': sha256(s.l || a.d || s.r)}},
    {{'l': '', 'r': '', 'd': coalesce(tampered, leaf)}}).d AS folded_root
  FROM proofs)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string([s.l || s.r FOR s IN path], '')) AS proof_sha256, folded_root,
  folded_root = root AS verified
FROM folded, (SELECT digest AS root FROM sub_nodes WHERE n = 1)
"""

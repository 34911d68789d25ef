"""Hard negatives: score windows over Hilbert-ordered blocks with zone maps.

Vectors are dealt by label and place on a Hilbert curve and cut into blocks, one Parquet row each, whose
zone map holds the least and greatest value of each dimension, id and label. Interval arithmetic gives the
range of inner products that an anchor can have with a block. Only blocks whose range meets what the anchor
looks for are multiplied; their products are exact integers.

Chunks of anchors meet parts, which are some hundred neighbouring blocks. A chunk is sent once to each part whose zone map it
needs, and there compares those of the blocks, so an anchor's work is that of the blocks it must read plus one bound per block.
Only the parts' zone maps pass through the driver, one for each shuffle partition at most. A part answers with the first rows it has.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ordermill.llm.batches import map_rows, table
from ordermill.session import staged

BLOCK_ROWS = 256
CHUNK_ROWS = 64
TILE_BLOCKS = 64
BITS = 4
LEAST = np.iinfo(np.int64).min
MOST = np.iinfo(np.int64).max

_BLOCKS = (
    "part int, block long, n int, n_anchors int, first_id long, last_id long, label_low long, label_high long, "
    "low binary, high binary, ids binary, labels binary, vectors binary, anchors binary"
)
_CHUNKS = "chunk long, keys binary, a_ids binary, a_labels binary, a_vectors binary, floors binary, floor_ids binary"
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def hilbert_keys(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place on the Hilbert curve of each row of `cells` (0 to 2**bits - 1 in each dimension), as big-endian bytes.

    Reflections and exchanges from the highest bit down, then Gray code, then bit planes one after another.
    """
    x = cells.T.astype(np.uint32)
    mask = 1 << bits - 1
    while mask > 1:
        low = np.uint32(mask - 1)
        for i in range(len(x)):
            turned = (x[i] & mask) != 0
            change = np.where(turned, low, (x[0] ^ x[i]) & low)
            x[i] ^= np.where(turned, np.uint32(0), change)
            x[0] ^= change
        mask >>= 1
    x = np.bitwise_xor.accumulate(x, axis=0)
    flip = np.zeros(x.shape[1], np.uint32)
    mask = 1 << bits - 1
    while mask > 1:
        flip ^= np.where(x[-1] & mask, np.uint32(mask - 1), np.uint32(0))
        mask >>= 1
    x ^= flip
    planes = [(x >> np.uint32(bit)) & np.uint32(1) for bit in reversed(range(bits))]
    return np.packbits(np.concatenate(planes).T.astype(np.uint8), axis=1)


def _exact(left: int, right: int, dims: int) -> type:
    """The narrowest type in which all sums of products of components up to `left` and `right` are exact."""
    largest = max(left, 1) * max(right, 1) * dims
    return np.float32 if largest < 1 << 24 else np.float64 if largest < 1 << 53 else np.int64


def _most(values: np.ndarray) -> int:
    return max(int(values.max(initial=0)), -int(values.min(initial=0)))


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows; in floating point where all sums are exact there."""
    kind = _exact(_most(left), _most(right), left.shape[1])
    return (left.astype(kind) @ right.T.astype(kind)).astype(np.int64)


def bounds(anchors: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest product of each anchor with any vector between `low` and `high` of each block."""
    up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
    return products(up, low) + products(down, high), products(up, high) + products(down, low)


def _packed(matrix: np.ndarray) -> bytes:
    """Integers with as few bytes each as all of them take; the first byte tells how many."""
    size = next(size for size in (1, 2, 4) if _most(matrix) < 1 << 8 * size - 1)
    return bytes([size]) + matrix.astype(f"<i{size}").tobytes()


def _matrix(data: bytes, rows: int) -> np.ndarray:
    return np.frombuffer(data, f"<i{data[0]}", offset=1).reshape(rows, -1)


def _longs(data: bytes) -> np.ndarray:
    return np.frombuffer(data, "<i8")


def _best(scores: np.ndarray, allowed: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each row with an allowed column: the first `k` of them by score, ties by column."""
    rows = np.flatnonzero(allowed.any(axis=1))
    order = np.argsort(np.where(allowed[rows], -scores[rows], MOST), axis=1, kind="stable")[:, :k]
    for row, columns in zip(rows.tolist(), order):
        yield row, columns[allowed[row, columns]]


def _curve_rows(rows: DataFrame, scale: int, dims: int, largest: int, bits: int) -> DataFrame:
    """Rows with their scaled vector as bytes, missing components 0, and their place on the curve."""
    kind = "<i2" if largest < 1 << 15 else "<i4"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = batch.column("vec")
            sizes = np.diff(vectors.offsets.to_numpy())
            matrix = np.zeros((batch.num_rows, dims), np.int64)
            matrix[np.arange(dims) < sizes[:, None]] = np.floor(scale * vectors.flatten().to_numpy())
            keys = hilbert_keys((matrix + largest) * (1 << bits) // (2 * largest + 1), bits)
            yield pa.record_batch(
                {
                    "vec_id": batch.column("vec_id"),
                    "label": batch.column("label"),
                    "is_anchor": batch.column("is_anchor"),
                    "curve": pa.array([key.tobytes() for key in keys], pa.binary()),
                    "vec": pa.array([row.tobytes() for row in matrix.astype(kind)], pa.binary()),
                }
            )

    return rows.mapInArrow(run, "vec_id long, label long, is_anchor boolean, curve binary, vec binary")


def build_blocks(rows: DataFrame, dims: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Rows in curve order, cut into blocks; equal vectors are in the order of their ids, and so are a block's rows."""
    count = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    order = ["label", "curve", "vec_id"]

    def block(part: int, number: int, held: pa.Table) -> tuple:
        held = held.sort_by("vec_id")
        ids, labels = (held[name].to_numpy().astype("<i8") for name in ("vec_id", "label"))
        anchors = held["is_anchor"].to_numpy(zero_copy_only=False)
        data = b"".join(held["vec"].to_pylist())
        vectors = np.frombuffer(data, f"<i{len(data) // (len(ids) * dims)}").reshape(len(ids), dims)
        return (
            part, part << 24 | number, len(ids), int(anchors.sum()), int(ids[0]), int(ids[-1]), int(labels.min()), int(labels.max()),
            vectors.min(axis=0).astype("<i4").tobytes(), vectors.max(axis=0).astype("<i4").tobytes(),
            ids.tobytes(), labels.tobytes(), _packed(vectors), anchors.astype(np.uint8).tobytes(),
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number, rest = TaskContext.get().partitionId(), 0, None
        for batch in batches:
            held = pa.Table.from_batches([batch])
            held = held if rest is None else pa.concat_tables([rest, held])
            whole = held.num_rows // block_rows * block_rows
            for at in range(0, whole, block_rows):
                yield _one(block(part, number, held.slice(at, block_rows)))
                number += 1
            rest = held.slice(whole)
        if rest is not None and rest.num_rows:
            yield _one(block(part, number, rest))

    names, kinds = zip(*(field.split() for field in _BLOCKS.split(", ")))
    arrow = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    fields = pa.schema([(name, arrow[kind]) for name, kind in zip(names, kinds)])

    def _one(values: tuple) -> pa.RecordBatch:
        return pa.record_batch([pa.array([value], field.type) for value, field in zip(values, fields)], schema=fields)

    return rows.repartitionByRange(count, *order).sortWithinPartitions(*order).mapInArrow(run, _BLOCKS)


def build_chunks(blocks: DataFrame, positives: int, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Anchors of neighbouring blocks together. A floor is what the last positive scores at least, as its own block shows."""
    columns = ["block", "ids", "labels", "vectors", "anchors"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                ids, labels = _longs(row["ids"]), _longs(row["labels"])
                vectors = _matrix(row["vectors"], len(ids))
                slots = np.flatnonzero(np.frombuffer(row["anchors"], np.uint8))
                scores = products(vectors[slots], vectors)
                allowed = labels[slots][:, None] == labels[None, :]
                allowed[np.arange(len(slots)), slots] = False
                floors = dict(_best(scores, allowed, positives))
                for i, slot in enumerate(slots.tolist()):
                    best = floors.get(i, ())
                    full = len(best) == positives
                    floor = (int(scores[i, best[-1]]), int(ids[best[-1]])) if full else (LEAST, MOST)
                    held.append((row["block"] << 16 | slot, int(ids[slot]), int(labels[slot]), vectors[slot], *floor))
                while len(held) >= chunk_rows:
                    yield chunk(held[:chunk_rows])
                    held = held[chunk_rows:]
        if held:
            yield chunk(held)

    def chunk(held: list[tuple]) -> pa.RecordBatch:
        keys, ids, labels, vectors, floors, floor_ids = zip(*held)
        longs = [np.array(values, "<i8").tobytes() for values in (keys, ids, labels)]
        ends = [np.array(values, "<i8").tobytes() for values in (floors, floor_ids)]
        values = [keys[0], *longs, _packed(np.stack(vectors)), *ends]
        names = [field.split()[0] for field in _CHUNKS.split(", ")]
        return pa.record_batch({name: [value] for name, value in zip(names, values)})

    return blocks.where("n_anchors > 0").select(*columns).mapInArrow(run, _CHUNKS)


def _places(blocks: DataFrame, width: int) -> Zones:
    """One zone map for every `width` parts, of all blocks that they have. They are few, as parts are, and are all that the driver gets."""
    names = ["block", "n", "first_id", "last_id", "label_low", "label_high", "low", "high"]

    def merge(pages: pa.Table) -> pa.Table:
        zones = Zones(pages.to_pylist())
        return pa.table(
            {
                "block": pages["place"].slice(0, 1).cast(pa.int64()), "n": [int(zones.n.sum())],
                "first_id": [int(zones.first_id.min())], "last_id": [int(zones.last_id.max())],
                "label_low": [int(zones.label_low.min())], "label_high": [int(zones.label_high.max())],
                "low": [zones.low.min(axis=0).astype("<i4").tobytes()], "high": [zones.high.max(axis=0).astype("<i4").tobytes()],
            }
        )

    placed = blocks.select(F.expr(f"part div {width}").alias("place"), *names).groupBy("place")
    merged = placed.applyInArrow(
        merge, "block long, n long, first_id long, last_id long, label_low long, label_high long, low binary, high binary"
    )
    return Zones(sorted((row.asDict() for row in merged.collect()), key=lambda row: row["block"]))


def _read(chunks: DataFrame, blocks: DataFrame, parts: int, wanted, evaluate, schema: str) -> DataFrame:
    """Send chunks of anchors to the parts that they need, choose blocks there by their zone maps, and give both to `evaluate`.

    `wanted(anchors, zones)` marks which anchor (row) must read which block (column). A place is `width` neighbouring parts; its blocks
    are sent `width` times, for as many shares of the chunks: so there are as many tasks as parts, and a chunk is sent to fewer places. About
    a hundredth of the rows are anchors, each sent with what it found, hence the 20.
    """
    names = [name for name in chunks.columns if name != "chunk"]
    width = max(1, round(math.sqrt(parts / 20)))
    tasks = 2 * math.ceil(parts / width) * width
    places = _places(blocks, width)
    sent = "place long, chunk long, " + ", ".join(f"{name} {kind}" for name, kind in chunks.dtypes if name != "chunk")
    fields = pa.schema([(field.split()[0], pa.int64()) for field in schema.split(", ")])

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                anchors = Anchors(row)
                marks = wanted(anchors, places)
                for columns in itertools.batched(np.flatnonzero(marks.any(axis=0)).tolist(), 64):
                    values = [anchors.part(np.flatnonzero(marks[:, column])) for column in columns]
                    yield pa.record_batch(
                        {"place": places.blocks[list(columns)], "chunk": [row["chunk"]] * len(columns)}
                        | {name: [value[name] for value in values] for name in names}
                    )

    def meet(stored: pa.Table, asked: pa.Table) -> pa.Table:
        found = []
        if stored.num_rows and asked.num_rows:
            part = Part(stored.to_pylist())
            for i in range(asked.num_rows):
                row = asked.slice(i, 1).to_pylist()[0]
                anchors = Anchors(row)
                found.append(evaluate(anchors, row["chunk"], part, wanted(anchors, part.zones)))
        return pa.concat_tables([fields.empty_table(), *(pa.table(one, schema=fields) for one in found)])

    share = F.pmod(F.xxhash64("chunk"), F.lit(width))
    asked = chunks.mapInArrow(choose, sent).withColumn("share", share).repartition(tasks, "place", "share")
    stored = blocks.drop("anchors", "n_anchors").withColumn("place", F.expr(f"part div {width}"))
    stored = stored.withColumn("share", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(width - 1).cast("long"))))
    stored = stored.repartition(tasks, "place", "share")
    return stored.groupBy("place", "share").cogroup(asked.groupBy("place", "share")).applyInArrow(meet, schema)


class Zones:
    """Zone maps of some blocks as arrays, one row per block."""

    def __init__(self, zones: list[dict]):
        self.blocks, self.n, self.first_id, self.last_id, self.label_low, self.label_high = (
            np.array([zone[name] for zone in zones], np.int64)
            for name in ("block", "n", "first_id", "last_id", "label_low", "label_high")
        )
        self.low, self.high = (
            np.stack([np.frombuffer(zone[name], "<i4") for zone in zones]).astype(np.int64) for name in ("low", "high")
        )


class Part:
    """Rows of neighbouring blocks, in the order of their blocks, and the blocks' zone maps."""

    def __init__(self, rows: list[dict]):
        rows.sort(key=lambda row: row["block"])
        self.zones = Zones(rows)
        self.ids, self.labels = (np.concatenate([_longs(row[name]) for row in rows]) for name in ("ids", "labels"))
        self.vectors = np.concatenate([_matrix(row["vectors"], row["n"]) for row in rows])
        self.starts = np.concatenate([[0], np.cumsum(self.zones.n)])
        self.most = _most(self.vectors)

    def own(self, anchors: Anchors) -> np.ndarray:
        """Each anchor's own row, -1 where it is not here."""
        block, slot = anchors.keys >> 16, anchors.keys & 0xFFFF
        at = np.minimum(np.searchsorted(self.zones.blocks, block), len(self.zones.blocks) - 1)
        return np.where(self.zones.blocks[at] == block, self.starts[at] + slot, -1)

    def tiles(self, vectors: np.ndarray, blocks: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Rows of the given blocks and their exact products with `vectors`: one block first, then four times as many at a time."""
        kind = _exact(_most(vectors), self.most, vectors.shape[1])
        if self.vectors.dtype != kind:
            self.vectors = self.vectors.astype(kind)
        left, at, size = vectors.astype(kind), 0, 1
        while at < len(blocks):
            some = blocks[at : at + size]
            at, size = at + size, min(4 * size, TILE_BLOCKS)
            ranges = [np.arange(self.starts[block], self.starts[block + 1]) for block in some.tolist()]
            rows = np.concatenate(ranges)
            whole = len(rows) == rows[-1] - rows[0] + 1
            yield rows, left @ (self.vectors[rows[0] : rows[-1] + 1] if whole else self.vectors[rows]).T


class Anchors:
    """A chunk's anchors as arrays; `windows` holds the scores and ids of each one's positives, best first."""

    def __init__(self, row: dict):
        self.keys, self.ids, self.labels, self.floors, self.floor_ids = (
            _longs(row[name]) for name in ("keys", "a_ids", "a_labels", "floors", "floor_ids")
        )
        self.vectors = _matrix(row["a_vectors"], len(self.ids)).astype(np.int64)
        if "p_scores" in row:
            self.p_scores, self.p_ids = (_longs(row[name]).reshape(len(self.ids), -1) for name in ("p_scores", "p_ids"))

    def part(self, rows: np.ndarray) -> dict[str, bytes]:
        out = {
            "keys": self.keys, "a_ids": self.ids, "a_labels": self.labels, "floors": self.floors, "floor_ids": self.floor_ids,
        }
        if hasattr(self, "p_scores"):
            out |= {"p_scores": self.p_scores, "p_ids": self.p_ids}
        return {name: values[rows].tobytes() for name, values in out.items()} | {
            "a_vectors": _packed(self.vectors[rows])
        }


def _reached(least: np.ndarray, greatest: np.ndarray, sure: np.ndarray, zones: Zones) -> np.ndarray:
    """Blocks that may hold one of the first rows, given that each `sure` block holds enough rows itself.

    A sure block's rows score its least product at least and have its last id at most; a block that can at best equal
    the best of these with larger ids only is not read.
    """
    floor = np.where(sure, least, LEAST).max(axis=1, keepdims=True)
    ids = np.where(sure & (least == floor), zones.last_id, MOST).min(axis=1, keepdims=True)
    return (greatest > floor) | (greatest == floor) & (zones.first_id <= ids)


def _first(
    anchors: Anchors, part: Part, marks: np.ndarray, same: bool, low: np.ndarray, high: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray]:
    """Scores and ids of the first `k` rows of a part for each anchor and window, LEAST where there are no more.

    `low` and `high` are the windows' least and greatest scores, one row per anchor; rows are other ones of the anchor's label (`same`), or of
    other labels. What was found so far bounds what a further tile must show.
    """
    windows = low.shape[1]
    scores, ids = np.full((low.size, k), LEAST), np.full((low.size, k), MOST)
    own = part.own(anchors)
    for rows, found in part.tiles(anchors.vectors, np.flatnonzero(marks.any(axis=0))):
        last, last_id = scores[:, -1].reshape(low.shape), ids[:, -1].reshape(low.shape)
        least = np.maximum(low, last).min(axis=1)
        flat = np.flatnonzero(found >= least[:, None].astype(found.dtype))
        i, j = np.divmod(flat, len(rows))
        row = rows[j]
        kept = ((part.labels[row] == anchors.labels[i]) == same) & (row != own[i])
        i, row, score = i[kept], row[kept], found.ravel()[flat[kept]].astype(np.int64)[:, None]
        row_id = part.ids[row][:, None]
        better = (score > last[i]) | (score == last[i]) & (row_id < last_id[i])
        at, window = np.nonzero((low[i] <= score) & (score <= high[i]) & better)
        if not len(at):
            continue
        lists = i[at] * windows + window
        changed = np.unique(lists)
        lists = np.concatenate([lists, np.repeat(changed, k)])
        score = np.concatenate([score[at, 0], scores[changed].ravel()])
        row_id = np.concatenate([row_id[at, 0], ids[changed].ravel()])
        order = np.lexsort((row_id, ~score, lists))
        lists = lists[order]
        start = np.flatnonzero(np.diff(lists, prepend=-1))
        rank = np.arange(len(lists)) - np.repeat(start, np.diff(start, append=len(lists)))
        put = rank < k
        scores[lists[put], rank[put]], ids[lists[put], rank[put]] = score[order][put], row_id[order][put]
    return scores.reshape(*low.shape, k), ids.reshape(*low.shape, k)


def _positives(chunks: DataFrame, blocks: DataFrame, parts: int, k: int) -> DataFrame:
    """(chunk, key, rank, id, score): the first `k` other rows of each anchor's label."""

    def wanted(anchors: Anchors, zones: Zones) -> np.ndarray:
        least, greatest = bounds(anchors.vectors, zones.low, zones.high)
        label = anchors.labels[:, None]
        some = (zones.label_low <= label) & (label <= zones.label_high)
        own = (zones.label_low == label) & (zones.label_high == label) & (zones.n > k)
        floor, ids = anchors.floors[:, None], anchors.floor_ids[:, None]
        better = (greatest > floor) | (greatest == floor) & (zones.first_id <= ids)
        return some & better & _reached(least, greatest, own, zones)

    def evaluate(anchors: Anchors, chunk: int, part: Part, marks: np.ndarray) -> dict[str, np.ndarray]:
        floors = anchors.floors[:, None]
        scores, ids = _first(anchors, part, marks, True, floors, np.full_like(floors, MOST), k)
        at = np.nonzero(scores != LEAST)
        return {"chunk": np.full(len(at[0]), chunk), "key": anchors.keys[at[0]], "id": ids[at], "score": scores[at]}

    found = _read(chunks, blocks, parts, wanted, evaluate, "chunk long, key long, id long, score long")
    first = Window.partitionBy("chunk", "key").orderBy(F.col("score").desc(), "id")
    return found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k)


def _with_windows(chunks: DataFrame, positives: DataFrame, k: int) -> DataFrame:
    """Chunks with each anchor's positives; where there are fewer than `k`, a score of LEAST closes the list."""
    listed = positives.groupBy("chunk").agg(F.collect_list(F.struct("key", "rank", "id", "score")).alias("found"))
    names = chunks.columns

    def put(*values) -> tuple:
        row, found = dict(zip(names, values)), values[-1]
        place = {key: i for i, key in enumerate(_longs(row["keys"]).tolist())}
        scores, ids = np.full((len(place), k), LEAST, "<i8"), np.zeros((len(place), k), "<i8")
        for one in found:
            at = place[one["key"]], one["rank"] - 1
            scores[at], ids[at] = one["score"], one["id"]
        return *values[:-1], scores.tobytes(), ids.tobytes()

    joined = chunks.hint("merge").join(listed, "chunk")  # or small files of many anchors are sent through the driver
    return map_rows(joined.select(*names, "found"), f"{_CHUNKS}, p_scores binary, p_ids binary", lambda: put)


def _negatives(chunks: DataFrame, blocks: DataFrame, parts: int, k: int, low: int, high: int) -> DataFrame:
    """The first `k` rows of other labels in each window of each anchor."""

    def inside(scores: np.ndarray, p: np.ndarray) -> np.ndarray:
        return (p != LEAST) & (low * np.where(p == LEAST, 0, p) <= 100 * scores) & (100 * scores <= high * np.where(p == LEAST, 0, p))

    def wanted(anchors: Anchors, zones: Zones) -> np.ndarray:
        least, greatest = bounds(anchors.vectors, zones.low, zones.high)
        label = anchors.labels[:, None]
        pure = zones.label_low == zones.label_high
        other = ~(pure & (zones.label_low == label))
        sure = pure & other & (zones.n >= k)
        marks = np.zeros(least.shape, bool)
        for w in range(anchors.p_scores.shape[1]):
            p = anchors.p_scores[:, w : w + 1]
            known = np.where(p == LEAST, 0, p)
            meets = (p != LEAST) & (100 * greatest >= low * known) & (100 * least <= high * known)
            whole = sure & inside(least, p) & inside(greatest, p)
            marks |= meets & _reached(least, greatest, whole, zones)
        return marks & other

    def evaluate(anchors: Anchors, chunk: int, part: Part, marks: np.ndarray) -> dict[str, np.ndarray]:
        p = anchors.p_scores
        known = np.where(p == LEAST, 0, p)
        least, greatest = np.where(p == LEAST, MOST, -(-low * known // 100)), np.where(p == LEAST, LEAST, high * known // 100)
        scores, ids = _first(anchors, part, marks, False, least, greatest, k)
        at = i, w, _ = np.nonzero(scores != LEAST)
        return {
            "key": anchors.keys[i], "w": w, "anchor_id": anchors.ids[i], "positive_id": anchors.p_ids[i, w],
            "positive_score": p[i, w], "negative_id": ids[at], "negative_score": scores[at],
        }

    schema = "key long, w long, anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"
    found = _read(chunks, blocks, parts, wanted, evaluate, schema)
    first = Window.partitionBy("key", "w").orderBy(F.col("negative_score").desc(), "negative_id")
    ranked = found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k)
    return ranked.select(*[field.split()[0] for field in RESULT.split(", ")])


def mine(
    vectors: DataFrame,
    anchor: Column,
    label: Column | None = None,
    scale: int = 256,
    positives: int = 5,
    negatives: int = 5,
    low: int = 80,
    high: int = 100,
    block_rows: int = BLOCK_ROWS,
    bits: int = BITS,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """Hard negatives of the rows that `anchor` marks: for each of an anchor's positives, rows of other labels that score
    `low` to `high` percent of it.

    Components become floor(scale * x); a score is the integer inner product. Positives are the first `positives` other
    rows of the same label by score, ties by id; from each one's window the first `negatives` rows return, with `rank`.

    Rows with a NULL id, label or vector, or a NULL or non-finite component take no part. A shorter vector counts
    as ended by zeros. Repeated rows are rows of their own: each is an anchor, a positive or a negative by itself, so
    equal result rows come as often. Anchors without a positive or without a row in any window are absent; an empty table
    gives no rows. Only the three named columns are read, whatever others there are. Components beyond 31 bits, or
    scores beyond 55, are an error.
    """
    spark = vectors.sparkSession
    vec = F.col(vec_col)
    whole = ~F.exists(vec, F.isnull) & F.coalesce((F.array_max(vec) < float("inf")) & (F.array_min(vec) > -float("inf")), F.lit(True))
    kept = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"),
        (F.col(label_col) if label is None else label).cast("long").alias("label"),
        F.coalesce(anchor, F.lit(False)).alias("is_anchor"),
        F.when(whole, vec.cast("array<double>")).alias("vec"),
    ).where("vec_id IS NOT NULL AND label IS NOT NULL AND vec IS NOT NULL")
    ends = (F.coalesce(F.floor(F.lit(scale) * end("vec")), F.lit(0)) for end in (F.array_max, F.array_min))
    dims, *ends = kept.agg(F.max(F.size("vec")), *(end(x) for end, x in zip((F.max, F.min), ends))).first()
    if dims is None:
        return spark.createDataFrame([], RESULT)
    largest = max(ends[0], -ends[1])
    if largest >= 1 << 31 or dims * largest * largest >= 1 << 55:
        raise ValueError(f"components up to {largest} in {dims} dimensions give scores beyond 55 bits")
    rows = staged(_curve_rows(kept, scale, max(dims, 1), largest, bits), "vectors")
    blocks = staged(build_blocks(rows, max(dims, 1), block_rows), "blocks")
    parts = 1 + (blocks.agg(F.max("part")).first()[0] or 0)
    chunks = staged(build_chunks(blocks, positives), "anchors")
    found = staged(_positives(chunks, blocks, parts, positives), "positives")
    return _negatives(_with_windows(chunks, found, positives), blocks, parts, negatives, low, high)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(table(spark, sf_dir, "embeddings"), anchor=F.col("vec_id") % 100 == 0, label=moved)


OP11_SQL = """
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
anchors AS (SELECT * FROM rows WHERE vec_id % 100 = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS other_id, a.label = r.label AS same,
    CAST(list_dot_product(a.v, r.v) AS BIGINT) AS score
  FROM anchors a JOIN rows r ON a.vec_id <> r.vec_id),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, positive_id,
  CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank,
  other_id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scored s ON p.anchor_id = s.anchor_id AND NOT same
  AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5
"""

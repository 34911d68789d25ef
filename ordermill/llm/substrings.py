"""Repeated passages: word windows that also start earlier, found over difference-cover anchors.

Positions whose remainder by PERIOD lies in a difference cover are anchors: for any two positions there is an offset below
PERIOD that brings both onto the cover. So two equal windows of `window` words share an aligned run of
`window - PERIOD + 1` words that starts on the cover in both. Only such runs are hashed and shuffled (3 of 7 positions). Where a run
occurs twice, each occurrence is extended to the windows around it, and windows are told apart by 96 bits of hashes.

Both exchanges send packed arrays. A task settles repeats among its own occurrences first and sends a hash once, so a
passage that is everywhere comes to its bucket once per task and buffer.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.llm.batches import map_rows, rows_of, table

WINDOW = 20
PERIOD = 7
BUFFER = 1 << 20
CHUNK = 1 << 16

# Odd multipliers of the polynomials over bytes and over words, and of the mixing steps: arbitrary, but fixed.
_BYTES, _WORDS, _WORDS_2 = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xA0761D6478BD642F
_MIX, _MIX_2 = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xFF51AFD7ED558CCD)

DOC = np.dtype([("none", "u1"), ("id", "<i8"), ("mark", "<i8")])
SENT = "bucket int, kind int, segment binary, docs binary, n int, doc binary, place binary, h1 binary, h2 binary"
DIRECTORY, CONTESTED, SURE, COUNTED = range(4)


@lru_cache
def difference_cover(period: int) -> tuple[int, ...]:
    """The first of the smallest sets of remainders whose differences are all remainders."""
    for size in range(1, period + 1):
        for rest in itertools.combinations(range(1, period), size - 1):
            cover = (0, *rest)
            if len({(a - b) % period for a in cover for b in cover}) == period:
                return cover
    raise ValueError(f"a period is 1 at least, not {period}")


@lru_cache
def _powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for number in (base, pow(base, -1, 1 << 64)):
        factors = np.full(size, number, np.uint64)
        factors[0] = 1
        out.append(np.cumprod(factors))
    return tuple(out)


def _runs(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Mixed polynomial of `values` between each start and end; it depends on the run alone, not on its place."""
    size = 2 * CHUNK
    while size < len(values):
        size *= 2
    up, down = _powers(base, size)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * up[: len(values)])])
    h = (sums[ends] - sums[starts]) * down[starts]
    h = (h ^ (h >> np.uint64(32))) * _MIX
    return h ^ (h >> np.uint64(29))


_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True


def word_numbers(data: bytes) -> np.ndarray:
    """One 64-bit number per word of UTF-8 text; words end at ASCII blanks only."""
    out, at = [np.zeros(0, np.uint64)], 0
    while at < len(data):
        end = at + CHUNK
        if end < len(data):  # back to the last blank, or on to the next one
            part = _SPACE[np.frombuffer(data, np.uint8, end - at, at)]
            blanks = np.flatnonzero(part)
            while not len(blanks) and end < len(data):
                more = min(CHUNK, len(data) - end)
                blanks = np.flatnonzero(_SPACE[np.frombuffer(data, np.uint8, more, end)]) + (end - at)
                blanks, end = blanks[:1], end + more
            end = at + int(blanks[-1]) + 1 if len(blanks) else len(data)
        end = min(end, len(data))
        codes = np.frombuffer(data, np.uint8, end - at, at)
        edges = np.flatnonzero(np.diff(~_SPACE[codes], prepend=False, append=False))
        out.append(_runs(codes.astype(np.uint64) + np.uint64(1), edges[::2], edges[1::2], _BYTES))
        at = end
    return np.concatenate(out)


def run_numbers(words: np.ndarray, size: int, base: int = _WORDS) -> np.ndarray:
    """One number per run of `size` words."""
    out = [np.zeros(0, np.uint64)]
    for at in range(0, len(words) - size + 1, CHUNK):
        part = words[at : at + CHUNK + size - 1]
        starts = np.arange(len(part) - size + 1)
        out.append(_runs(part, starts, starts + size, base))
    return np.concatenate(out)


def anchors(words: np.ndarray, window: int, period: int) -> tuple[np.ndarray, np.ndarray]:
    """Cover positions of a text that has a window, and the numbers of the runs that start there."""
    if len(words) < window:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint32)
    runs = run_numbers(words, window - period + 1)
    on = np.zeros(period, bool)
    on[list(difference_cover(period))] = True
    places = np.flatnonzero(np.resize(on, len(runs)))
    return runs[places], places.astype(np.uint32)


def _packed(numbers: np.ndarray) -> bytes:
    """Small numbers in two bytes each, where all fit, else in four."""
    return numbers.astype("<u2" if int(numbers.max(initial=0)) < 1 << 16 else "<u4").tobytes()


def _unpacked(data: bytes, count: int) -> np.ndarray:
    return np.frombuffer(data, "<u2" if len(data) == 2 * count else "<u4").astype(np.int64)


def _packed_docs(used: np.ndarray, docs: np.ndarray) -> bytes:
    """Document numbers and what their order follows from; of ids the steps from one to the next, as they mostly ascend."""
    ids = docs["id"].astype(np.uint64)
    steps = np.diff(ids)
    most = int(steps.max(initial=0))
    size = next(size for size in (1, 2, 4, 8) if most < 1 << 8 * size)
    columns = (_packed(used), np.packbits(docs["none"]).tobytes(), ids[:1].tobytes(), steps.astype(f"<u{size}").tobytes())
    return bytes([size]) + b"".join(columns) + docs["mark"].tobytes()


def _unpacked_docs(data: bytes, count: int) -> tuple[np.ndarray, np.ndarray]:
    size, bits = data[0], (count + 7) // 8
    marks = len(data) - 8 * count
    steps = marks - size * (count - 1)
    first = steps - 8
    docs = np.empty(count, DOC)
    docs["none"] = np.unpackbits(np.frombuffer(data, np.uint8, bits, first - bits), count=count)
    ids = np.concatenate([np.frombuffer(data, "<u8", 1, first), np.frombuffer(data, f"<u{size}", count - 1, steps)])
    docs["id"] = np.cumsum(ids, dtype=np.uint64).view(np.int64)
    docs["mark"] = np.frombuffer(data, "<i8", count, marks)
    return _unpacked(data[1 : first - bits], count), docs


def _bucket(numbers: np.ndarray, buckets: int) -> np.ndarray:
    return ((numbers >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)


class Buffer:
    """Occurrences of hashes in a task's documents, sent as one segment when there are `most` of them.

    An occurrence is known by its segment, its document's number there and its place. What is sent to a bucket of hashes has these, and
    the hashes; the documents themselves are sent once, as the segment's directory, unless `ordered`: then a bucket gets
    those it needs to put occurrences in order. A segment is named by its directory, so that a task that is run again on other
    rows cannot be taken for the first run.
    """

    def __init__(self, buckets: int, most: int, settle, ordered: bool):
        self.buckets, self.most, self.settle, self.ordered = buckets, most, settle, ordered
        self.clear()

    def clear(self) -> None:
        self.docs: list[tuple] = []
        self.columns: list[list[np.ndarray]] = [[], [], [], []]
        self.size = 0

    def add(self, doc_id: int | None, mark: int, place: np.ndarray, h1: np.ndarray, h2: np.ndarray) -> Iterator[tuple]:
        if len(place):
            doc = np.full(len(place), len(self.docs), np.uint32)
            self.docs.append((doc_id is None, doc_id or 0, mark))
            for column, values in zip(self.columns, (doc, place, h1, h2)):
                column.append(values)
            self.size += len(place)
        if self.size >= self.most:
            yield from self.flush()

    def flush(self) -> Iterator[tuple]:
        if not self.size:
            return
        docs = np.array(self.docs, DOC)
        doc, place, h1, h2 = (np.concatenate(column) for column in self.columns)
        self.clear()
        segment = hashlib.blake2b(docs.tobytes(), digest_size=16).digest()
        home = int.from_bytes(segment[:4], "little") % self.buckets
        contested, sure, counted = self.settle(docs, doc, place, h1, h2)
        yield home, DIRECTORY, segment, docs.tobytes(), len(docs), b"", b"", b"", b""
        if len(sure):
            yield home, SURE, segment, b"", len(sure), _packed(doc[sure]), _packed(place[sure]), b"", b""
        for kind, rows in ((CONTESTED, contested), (COUNTED, counted)):
            bucket = _bucket(h1[rows], self.buckets)
            order = np.argsort(bucket, kind="stable")
            for some in np.split(rows[order], np.flatnonzero(np.diff(bucket[order])) + 1):
                if not len(some):
                    continue
                number = int(_bucket(h1[some[:1]], self.buckets)[0])
                if kind == COUNTED:
                    yield number, kind, segment, b"", len(some), b"", b"", _short(h1[some]), b""
                elif self.ordered:
                    some = np.sort(some)
                    used, own = np.unique(doc[some], return_inverse=True)
                    names = _packed_docs(used, docs[used])
                    yield number, kind, segment, names, len(some), _packed(own), _packed(place[some]), h1[some].tobytes(), _short(h2[some])
                else:
                    yield number, kind, segment, b"", len(some), _packed(doc[some]), _packed(place[some]), _short(h1[some]), b""


def _short(hashes: np.ndarray) -> bytes:
    """The lower half of each hash; the upper half chose the bucket."""
    return hashes.astype("<u4").tobytes()


def _ship(df: DataFrame, buckets: int, most: int, settle, occurrences, ordered: bool) -> DataFrame:
    """Packed rows of what `occurrences(*values)` finds in each row: (place, h1, h2) arrays of a document."""
    names, kinds = zip(*(field.split() for field in SENT.split(", ")))
    fields = pa.schema([(name, pa.binary() if kind == "binary" else pa.int32()) for name, kind in zip(names, kinds)])

    def packed(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
        for some in itertools.batched(rows, 64):
            yield pa.record_batch([pa.array(list(c), f.type) for c, f in zip(zip(*some), fields)], schema=fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buffer = Buffer(buckets, most, settle, ordered)
        for batch in batches:
            for doc_id, mark, *values in rows_of(batch):
                yield from packed(buffer.add(doc_id, mark, *occurrences(*values)))
        yield from packed(buffer.flush())

    return df.mapInArrow(run, SENT)


def _decide(sent: DataFrame, choose) -> DataFrame:
    """(doc_id, mark, places) of the sure occurrences, and of those contested ones that `choose` marks in each bucket.

    Buckets answer with document numbers and places, which meet the directory of their segment afterwards.
    """
    answer = pa.schema([("segment", pa.binary()), ("docs", pa.binary()), ("n", pa.int32()), ("doc", pa.binary()), ("place", pa.binary())])
    result = pa.schema([("doc_id", pa.int64()), ("mark", pa.int64()), ("places", pa.list_(pa.int32()))])

    def decide(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        out = [(row["segment"], row["docs"], row["n"], row["doc"], row["place"]) for row in rows if row["kind"] in (DIRECTORY, SURE)]
        contested = [row for row in rows if row["kind"] == CONTESTED]
        if contested:
            counted = np.concatenate([np.zeros(0, "<u4"), *(np.frombuffer(row["h1"], "<u4") for row in rows if row["kind"] == COUNTED)])
            for row, doc, place in choose(contested, counted):
                if len(doc):
                    out.append((row["segment"], b"", len(doc), _packed(doc), _packed(place)))
        if not out:
            return answer.empty_table()
        return pa.Table.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*out), answer)], schema=answer)

    def resolve(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        names = next((row["docs"] for row in rows if row["docs"]), None)
        if names is None:
            raise RuntimeError("a task was run again on rows in another order, so its segment has no directory; run the query again")
        found = [row for row in rows if not row["docs"]]
        doc, place = (
            np.concatenate([np.zeros(0, np.int64), *(_unpacked(row[name], row["n"]) for row in found)]) for name in ("doc", "place")
        )
        own, doc = np.unique(doc, return_inverse=True)
        docs = np.frombuffer(names, DOC)[own]
        order = np.lexsort((place, doc))
        offsets = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=len(docs)))])
        places = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(place[order].astype(np.int32)))
        ids = pa.array(docs["id"], pa.int64(), mask=docs["none"].astype(bool))
        return pa.Table.from_arrays([ids, pa.array(docs["mark"], pa.int64()), places], schema=result)

    answers = sent.groupBy("bucket").applyInArrow(decide, "segment binary, docs binary, n int, doc binary, place binary")
    parts = answers.groupBy("segment").applyInArrow(resolve, "doc_id long, mark long, places array<int>")
    return parts.groupBy("doc_id", "mark").agg(F.array_distinct(F.flatten(F.collect_list("places"))).alias("places"))


def _anchors_at_home(docs, doc, place, h1, h2):
    """Runs that a task has twice are repeated for sure; others know of them by one number."""
    _, first, own, counts = np.unique(h1, return_index=True, return_inverse=True, return_counts=True)
    many = counts[own] > 1
    return np.flatnonzero(~many), np.flatnonzero(many), first[counts > 1]


def _twice(numbers: np.ndarray) -> np.ndarray:
    """Which 32-bit numbers come twice or more; one sort, with each number's place in the lower half."""
    keyed = numbers.astype(np.uint64) << np.uint64(32) | np.arange(len(numbers), dtype=np.uint64)
    keyed.sort()
    same = np.zeros(len(keyed) + 1, bool)
    same[1:-1] = keyed[1:] >> np.uint64(32) == keyed[:-1] >> np.uint64(32)
    out = np.empty(len(keyed), bool)
    out[(keyed & np.uint64(0xFFFFFFFF)).astype(np.int64)] = same[1:] | same[:-1]
    return out


def _anchors_twice(rows: list[dict], counted: np.ndarray) -> Iterator[tuple]:
    """Occurrences of runs that come twice. Half a hash may say so of two runs that differ: their windows then do too."""
    twice = _twice(np.concatenate([*(np.frombuffer(row["h1"], "<u4") for row in rows), counted]))
    at = 0
    for row in rows:
        hit = twice[at : at + row["n"]]
        at += row["n"]
        if hit.any():
            yield row, _unpacked(row["doc"], row["n"])[hit], _unpacked(row["place"], row["n"])[hit]


def _later(rank, place, h1, h2) -> tuple[np.ndarray, np.ndarray]:
    """Rows that come first among equal windows, and rows that come later; equal rows of one document are neither."""
    order = np.lexsort((place, rank, h2, h1))
    a, b = h1[order], h2[order]
    new = np.ones(len(order), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    first = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
    later = (rank[order] != rank[first]) | (place[order] != place[first])
    return order[new], order[later]


def _windows_at_home(docs, doc, place, h1, h2):
    first, later = _later(np.unique(docs, return_inverse=True)[1][doc], place, h1, h2 & np.uint64(0xFFFFFFFF))
    return first, later, np.zeros(0, np.int64)


def _windows_later(rows: list[dict], counted: np.ndarray) -> Iterator[tuple]:
    names, known, doc, place, h1, h2 = [], [], [], [], [], []
    before = 0
    for row in rows:
        own = _unpacked(row["doc"], row["n"])
        count = int(own.max()) + 1
        used, some = _unpacked_docs(row["docs"], count)
        doc.append(own + before)
        names.append(some)
        before += count
        known.append(used[own])
        place.append(_unpacked(row["place"], row["n"]))
        h1.append(np.frombuffer(row["h1"], "<u8"))
        h2.append(np.frombuffer(row["h2"], "<u4"))
    rank = np.unique(np.concatenate(names), return_inverse=True)[1][np.concatenate(doc)]
    hit = np.zeros(len(rank), bool)
    hit[_later(rank, np.concatenate(place), np.concatenate(h1), np.concatenate(h2))[1]] = True
    for row, own, at, chosen in zip(rows, known, place, np.split(hit, np.cumsum([len(x) for x in place])[:-1])):
        yield row, own[chosen], at[chosen]


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(text_col)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("mark"), text.alias("text"))


def repeated_windows(
    docs: DataFrame,
    window: int = WINDOW,
    period: int = PERIOD,
    buffer: int = BUFFER,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, mark, places): where in each document a window starts that also starts earlier; documents without one are absent.

    `mark` is the 64-bit hash of the text: rows of the same id and text are one document. Earlier is a smaller id, NULL last, then a smaller
    mark, then an earlier start.
    """
    if period < 1 or window < period:
        raise ValueError("a window has as many words as the period at least")
    rows = _keyed(docs, id_col, text_col)
    buckets = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    none = np.zeros(0, np.uint64)

    def cover(text: str | None):
        runs, places = anchors(word_numbers((text or "").encode()), window, period)
        return places, runs, none

    def extend(text: str, places: list[int]):
        words = word_numbers(text.encode())
        wanted = np.zeros(len(words) - window + 1, bool)
        at = np.array(places)
        for back in range(period):
            starts = at - back
            wanted[starts[(starts >= 0) & (starts < len(wanted))]] = True
        starts = np.flatnonzero(wanted)
        other = (words ^ (words >> np.uint64(31))) * _MIX_2
        return starts.astype(np.uint32), run_numbers(words, window)[starts], run_numbers(other, window, _WORDS_2)[starts]

    found = _decide(_ship(rows, buckets, buffer, _anchors_at_home, cover, False), _anchors_twice)
    own = found.select(F.col("doc_id").alias("f_id"), F.col("mark").alias("f_mark"), "places")
    hit = rows.join(own, F.col("doc_id").eqNullSafe(F.col("f_id")) & (F.col("mark") == F.col("f_mark")))
    return _decide(_ship(hit.select("doc_id", "mark", "text", "places"), buckets, buffer, _windows_at_home, extend, True), _windows_later)


def remove_repeats(
    docs: DataFrame,
    window: int = WINDOW,
    period: int = PERIOD,
    buffer: int = BUFFER,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Every document without the words of windows that also start earlier: doc_id, n_words, n_removed, spans, kept.

    `spans` are the removed runs of words (first, one past the last); `kept` are the other words, joined by blanks. One row
    per input row. Words are runs without ASCII blanks. NULL, empty and blank texts have no words and an empty `kept`; texts shorter than
    a window stay whole, apart from their blanks. Texts of any length are taken whole, in pieces of 64 K.
    Rows of the same id and text are one document: their results are equal, and none is a repeat of the other. Ids must be
    numbers; rows without one come after all others, by the hash of their text. Only the two named columns are read.
    """
    rows = _keyed(docs, id_col, text_col)
    later = repeated_windows(docs, window, period, buffer, id_col, text_col)
    later = later.select(F.col("doc_id").alias("f_id"), F.col("mark").alias("f_mark"), "places")
    joined = rows.join(later, F.col("doc_id").eqNullSafe(F.col("f_id")) & (F.col("mark") == F.col("f_mark")), "left")

    def cut(doc_id, text, places):
        words = (text or "").encode().split()
        if not places:
            return doc_id, len(words), 0, [], b" ".join(words).decode()
        edges = np.zeros(len(words) + 1, np.int64)
        np.add.at(edges, places, 1)
        np.add.at(edges, np.array(places) + window, -1)
        kept = np.cumsum(edges[:-1]) == 0
        turns = np.flatnonzero(np.diff(~kept, prepend=False, append=False))
        spans = [{"first": a, "last": b} for a, b in turns.reshape(-1, 2).tolist()]
        return doc_id, len(words), int((~kept).sum()), spans, b" ".join(itertools.compress(words, kept.tolist())).decode()

    schema = "doc_id long, n_words long, n_removed long, spans array<struct<first int, last int>>, kept string"
    return map_rows(joined.select("doc_id", "text", "places"), schema, lambda: cut)


def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = remove_repeats(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


OP13_SQL = """
WITH split AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words FROM documents),
windows AS (
  SELECT doc_id, pos, array_to_string(words[pos:pos + 19], ' ') AS passage
  FROM (SELECT *, unnest(range(1, len(words) - 18)) AS pos FROM split)),
later AS (
  SELECT doc_id, pos FROM windows QUALIFY row_number() OVER (PARTITION BY passage ORDER BY doc_id, pos) > 1),
removed AS (SELECT DISTINCT doc_id, unnest(range(pos, pos + 20)) AS place FROM later),
places AS (SELECT doc_id, list(place) AS gone FROM removed GROUP BY doc_id),
kept AS (
  SELECT doc_id, len(words) AS n_words, coalesce(len(gone), 0) AS n_removed,
    CASE WHEN gone IS NULL THEN words ELSE list_filter(words, lambda w, i: NOT list_contains(gone, i)) END AS words
  FROM split LEFT JOIN places USING (doc_id))
SELECT doc_id, n_words, n_removed, sha256(array_to_string(words, ' ')) AS kept_sha256 FROM kept
"""

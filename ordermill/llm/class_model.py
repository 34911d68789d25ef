"""Scores of a class-based bigram language model, with classes from exchange clustering.

Words seen often enough are units of their own; all other words share a unit by their last three bytes.
Exchange clustering assigns the units, and so every word, to classes: first the most frequent units one by
one, then all units in rounds over a staged table of their neighbours, where each unit whose turn it is
goes to the class that raises the likelihood most. A text's probability is the product of class
transitions and of word emissions within their classes.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.llm.batches import ROWS, fold_of, fold_rows, map_rows, table
from ordermill.session import staged

FREQUENT = 65_536
LEAST = 2  # a word seen less often shares a unit
SEED_WORDS = 767
POOLS = 256
CLASSES = 48
ROUNDS = 6
SPARK_ROUNDS = 6
SEED = 42
END = b""  # the end token; no word is empty
CACHED_WORDS = 250_000
_FLUSH_WORDS = 300_000
_FLUSH_TOKENS = 1 << 21
_UNITS_AT_ONCE = 64
_CODE_BYTES = 16 << 20


def tokens(text: str | None) -> list[bytes]:
    """Words with A-Z in lower case, then the end. Bytes are split and lowered as ASCII alone."""
    return [*(text or "").encode().lower().split(), END]


def pool_of(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word[-3:], SEED) % POOLS


def hashes(words: list[bytes]) -> np.ndarray:
    """What stands for a word in tables: 64 bits, signed."""
    return np.frombuffer(b"".join([xxhash.xxh64_digest(word, SEED) for word in words]), ">i8").astype(np.int64)


class Vocabulary:
    """Frequent words with their counts and units, and the units of all others: the end, own words, pools."""

    def __init__(self, words: np.ndarray, pools: np.ndarray, counts: np.ndarray, least: int = LEAST):
        """Hashes, pools and counts of the frequent words, most frequent first; words seen `least` times are units."""
        self.words, self.counts, self.pools = words, counts, pools.astype(np.int64)
        end = hashes([END])[0]
        own = np.flatnonzero((words != end) & (counts >= least))
        self.own = len(own)
        self.size = 1 + self.own + POOLS
        self.unit = 1 + self.own + self.pools
        seeds = min(self.own, SEED_WORDS)
        #: What each unit counts as among the seeds: itself, or the pool of its ending.
        self.seed = np.concatenate([np.arange(1 + seeds), 1 + seeds + pools[own[seeds:]], 1 + seeds + np.arange(POOLS)])
        self.unit[own] = 1 + np.arange(self.own)
        self.unit[words == end] = 0

    def __getstate__(self):
        return {name: self.__dict__[name] for name in ("words", "counts", "unit", "own")}

    def codes(self, words: list[bytes]) -> np.ndarray:
        """Rank of each frequent word, -1 - pool of each other."""
        if "cache" not in self.__dict__:  # once per worker
            self.ranks = dict(zip(self.words.tolist(), range(len(self.words))))
            self.cache: dict[bytes, int] = {}
        cache = self.cache
        found = list(map(cache.get, words))
        if None in found:
            missing = list({word for word, code in zip(words, found) if code is None})
            ranks = map(self.ranks.get, hashes(missing).tolist())
            fresh = {word: -1 - pool_of(word) if rank is None else rank for word, rank in zip(missing, ranks)}
            found = [fresh[word] if code is None else code for word, code in zip(words, found)]
            if len(cache) > max(CACHED_WORDS, 2 * len(self.words)):
                often = {word: code for word, code in cache.items() if code >= 0}
                cache.clear()
                cache.update(often)
            cache.update(fresh)
        return np.array(found, np.int64)

    def units(self, codes: np.ndarray) -> np.ndarray:
        """0 is the end, then the words with a unit of their own, then the pools."""
        if not len(self.unit):
            return self.own - codes
        return np.where(codes < 0, self.own - codes, self.unit[np.maximum(codes, 0)])


def count_words(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(word, pool, n): occurrences of every token in all texts, the end's among them.

    Tasks add up their own counts before the shuffle, so a frequent word is a few rows.
    """

    def flush(counts):
        words = list(counts)
        columns = hashes(words), [pool_of(word) for word in words], list(counts.values())
        counts.clear()
        return columns

    def add(counts, text):
        counts.update(tokens(text))
        if len(counts) > _FLUSH_WORDS:
            yield flush(counts)

    def finish(counts):
        if counts:
            yield flush(counts)

    rows = fold_rows(docs.select(text_col), "word long, pool int, n long", Counter, add, finish)
    return rows.groupBy("word", "pool").agg(F.sum("n").alias("n"))


def encoded(docs: DataFrame, vocabulary) -> DataFrame:
    """Each text of `docs` (doc_id, text, learn) as `Vocabulary.codes`, packed, with hashes and numbers of its words that are not frequent.

    `row` is a number for each row, good once this is written. `vocabulary` is a broadcast one.
    """

    def start():
        part = TaskContext.get().partitionId()
        row = 0

        def one(doc_id, text, learn):
            nonlocal row
            row += 1
            words = tokens(text)
            codes = vocabulary.value.codes(words)
            rare = Counter([words[i] for i in np.flatnonzero(codes < 0)])
            return part << 40 | row, doc_id, learn, len(words), codes.astype("<i4").tobytes(), hashes(list(rare)), list(rare.values())

        return one

    schema = "row long, doc_id long, learn boolean, n_tokens long, codes binary, words array<long>, times array<int>"
    return map_rows(docs.select("doc_id", "text", "learn"), schema, start)


def _codes(column: pa.Array) -> Iterator[tuple[slice, np.ndarray]]:
    """Which rows, and their codes, one text after the other: `ROWS` at a time, or one where texts are very long."""
    for first in range(0, len(column), ROWS):
        step = ROWS if column[first : first + ROWS].nbytes < _CODE_BYTES else 1
        for at in range(first, min(first + ROWS, len(column)), step):
            rows = slice(at, at + step)
            yield rows, np.frombuffer(b"".join(column[rows].to_pylist()), "<i4")


def neighbours(docs: DataFrame, vocabulary, size: int, text_col: str = "text") -> DataFrame:
    """As `neighbours_of`, for texts."""

    def start():
        return lambda text: (vocabulary.value.codes(tokens(text)).astype("<i4").tobytes(),)

    return neighbours_of(map_rows(docs.select(text_col), "codes binary", start), vocabulary, size)


def neighbours_of(texts: DataFrame, vocabulary, size: int) -> DataFrame:
    """(unit, beside, n): one row for each unit, what stands beside it in any text and how often, as packed numbers.

    `texts` has the column `codes` of `encoded`. What follows a unit is in `beside` by its number, what precedes it by that
    plus `size`, and the unit itself as twice `size`. A text starts after an end. Tasks and then a shuffle by both units
    sum up first; only then do the rows of a unit, two for each other unit at most, come together.
    `vocabulary` is a broadcast one of `size` units.
    """

    width = 2 * size + 1

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush():
            keys = np.sort(np.concatenate(waiting))
            waiting.clear()
            starts = np.flatnonzero(np.diff(keys, prepend=-1))
            return pa.record_batch({"pair": keys[starts], "n": np.diff(starts, append=len(keys))})

        waiting: list[np.ndarray] = []
        held = 0
        for batch in batches:
            for _, codes in _codes(batch.column(0)):
                units = vocabulary.value.units(codes).astype(np.int64)
                # every text ends with an end, so the one before starts the next
                waiting.append(np.concatenate([units[-1:], units[:-1]]) * size + units)
                held += len(units)
                if held > _FLUSH_TOKENS:
                    yield flush()
                    held = 0
        if waiting:
            yield flush()

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row():
            beside, n = (np.concatenate(side).astype(form).tobytes() for side, form in zip(zip(*held), ("<i4", "<i8")))
            return last, beside, n

        def batch_of(rows):
            return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.binary(), pa.binary()))], names=["unit", "beside", "n"])

        last, held = None, []
        for batch in batches:
            entry, n = (column.to_numpy() for column in batch.columns)
            unit, beside = entry // width, entry % width
            starts = np.flatnonzero(np.diff(unit, prepend=-1))
            done = []
            for start, end in zip(starts, [*starts[1:], len(unit)]):
                if unit[start] != last:
                    if held:
                        done.append(row())
                    last, held = int(unit[start]), []
                held.append((beside[start:end], n[start:end]))
            if done:
                yield batch_of(done)
        if held:
            yield batch_of([row()])

    rows = texts.select("codes").mapInArrow(counted, "pair long, n long")
    sums = rows.groupBy("pair").agg(F.sum("n").alias("n"))
    left, right = F.expr(f"pair div {size}"), F.col("pair") % size
    both = F.array(left * width + right, right * width + left + size)
    entries = F.when(left == right, F.array(left * width + 2 * size)).otherwise(both)
    flat = sums.select(F.explode(entries).alias("entry"), "n")
    flat = flat.repartition(F.expr(f"entry div {width}")).sortWithinPartitions("entry")
    return flat.mapInArrow(packed, "unit int, beside binary, n binary")


def _unpacked(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    for unit, beside, n in zip(*batch.columns):
        yield unit.as_py(), np.frombuffer(beside.as_buffer(), "<i4"), np.frombuffer(n.as_buffer(), "<i8")


def _summed(rows: DataFrame, size: int) -> np.ndarray:
    """A matrix from the tasks' (pair, n); the driver gets one sum per pair at most."""
    sums = rows.groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(size * size)
    out[sums["pair"].to_numpy()] = sums["n"].to_numpy()
    return out.reshape(size, size)


def seed_pairs(near: DataFrame, seed: np.ndarray) -> np.ndarray:
    """How often each seed (column) follows each seed (row), over all texts."""
    shared = near.sparkSession.sparkContext.broadcast(seed)
    units, size = len(seed), int(seed.max()) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            for unit, beside, n in _unpacked(batch):
                after = beside < units
                row = total[shared.value[unit]]
                row += np.bincount(shared.value[beside[after]], n[after], size)
                row[shared.value[unit]] += n[beside == 2 * units].sum()
        found = np.flatnonzero(total)
        yield pa.record_batch({"pair": found, "n": total.ravel()[found].astype(np.int64)})

    return _summed(near.mapInArrow(run, "pair long, n long"), size)


def exchange(pairs: np.ndarray, classes: int = CLASSES, rounds: int = ROUNDS) -> np.ndarray:
    """Class of each unit: units move, one at a time, to the class that raises the likelihood most.

    Unit 0 keeps class 0 to itself. Stops after a round without a move, or after `rounds`.
    """
    size = len(pairs)
    use = pairs.sum(axis=0) + pairs.sum(axis=1)
    order = np.argsort(-use, kind="stable")
    order = order[(order != 0) & (use[order] > 0)]
    label = np.ones(size, np.int64)
    label[0] = 0
    label[order] = 1 + np.arange(len(order)) % (classes - 1)
    member = np.zeros((size, classes))
    member[np.arange(size), label] = 1
    between = member.T @ pairs @ member
    after, before = pairs @ member, pairs.T @ member  # by class: what follows a unit, what precedes it

    f, diagonal = _xlogx, np.arange(classes)
    for _ in range(rounds):
        moves = 0
        for unit in order:
            old = label[unit]
            own = pairs[unit, unit]
            right, left = after[unit].copy(), before[unit].copy()
            right[old] -= own
            left[old] -= own
            between[old] -= right
            between[:, old] -= left
            between[old, old] -= own
            grown_row, grown_column = f(between + right[None, :]) - f(between), f(between + left[:, None]) - f(between)
            corner = between[diagonal, diagonal]
            gain = grown_row.sum(axis=1) - grown_row[diagonal, diagonal] + grown_column.sum(axis=0) - grown_column[diagonal, diagonal]
            gain += f(corner + right + left + own) - f(corner)
            rows, columns = between.sum(axis=1) + left, between.sum(axis=0) + right
            gain -= f(rows + right.sum() + own) - f(rows) + f(columns + left.sum() + own) - f(columns)
            gain[0] = -np.inf
            new = int(gain.argmax())
            if gain[new] <= gain[old] + 1e-9:
                new = old
            between[new] += right
            between[:, new] += left
            between[new, new] += own
            if new != old:
                moves += 1
                label[unit] = new
                after[:, old] -= pairs[:, unit]
                after[:, new] += pairs[:, unit]
                before[:, old] -= pairs[unit]
                before[:, new] += pairs[unit]
        if not moves:
            break
    return label


def likelihood(between: np.ndarray) -> float:
    """What of the training texts' log likelihood depends on the classes."""
    return float(_xlogx(between).sum() - _xlogx(between.sum(axis=0)).sum() - _xlogx(between.sum(axis=1)).sum())


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def best_classes(old: np.ndarray, right: np.ndarray, left: np.ndarray, own: np.ndarray, between: np.ndarray) -> np.ndarray:
    """For each of some units, the class that raises the likelihood most if that unit alone moves.

    `right` and `left` count by class what follows and precedes each unit, itself (`own`) left out.
    """
    f, rows, classes = _xlogx, np.arange(len(old)), len(between)
    rest = np.repeat(between[None], len(old), axis=0)  # without the unit
    rest[rows, old] -= right
    rest[rows, :, old] -= left
    rest[rows, old, old] -= own
    diagonal = np.arange(classes)
    without = f(rest)
    grown_row, grown_column = f(rest + right[:, None, :]) - without, f(rest + left[:, :, None]) - without
    corner = rest[:, diagonal, diagonal]
    gain = grown_row.sum(axis=2) - grown_row[:, diagonal, diagonal] + grown_column.sum(axis=1) - grown_column[:, diagonal, diagonal]
    gain += f(corner + right + left + own[:, None]) - f(corner)
    out, into = rest.sum(axis=2) + left, rest.sum(axis=1) + right
    gain -= f(out + (right.sum(axis=1) + own)[:, None]) - f(out) + f(into + (left.sum(axis=1) + own)[:, None]) - f(into)
    gain[:, 0] = -np.inf  # the end's
    new = gain.argmax(axis=1)
    return np.where(gain[rows, new] > gain[rows, old] + 1e-9, new, old)


def class_counts(near: DataFrame, label: np.ndarray, classes: int) -> DataFrame:
    """(unit, counts): what follows each unit by class, what precedes it by class, and the unit itself, as packed numbers."""
    shared = near.sparkSession.sparkContext.broadcast(np.concatenate([label, classes + label, [2 * classes]]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(unit, np.bincount(shared.value[beside], n, 2 * classes + 1)) for unit, beside, n in _unpacked(batch)]
            counts = [counts.astype("<f8").tobytes() for _, counts in rows]
            yield pa.record_batch([pa.array([unit for unit, _ in rows], pa.int32()), pa.array(counts, pa.binary())], names=["unit", "counts"])

    return near.mapInArrow(run, "unit int, counts binary")


def _dense(batch: pa.RecordBatch, classes: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for start in range(0, batch.num_rows, _UNITS_AT_ONCE):
        part = batch.slice(start, _UNITS_AT_ONCE)
        counts = np.frombuffer(b"".join(part.column(1).to_pylist()), "<f8")
        yield part.column(0).to_numpy(), counts.reshape(-1, 2 * classes + 1)


def class_pairs(counts: DataFrame, label: np.ndarray, classes: int) -> np.ndarray:
    """How often each class (column) follows each class (row), from `class_counts`."""
    shared = counts.sparkSession.sparkContext.broadcast(label)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((classes, classes))
        for batch in batches:
            for unit, dense in _dense(batch, classes):
                own = shared.value[unit]
                np.add.at(total, own, dense[:, :classes])
                np.add.at(total, (own, own), dense[:, -1])
        found = np.flatnonzero(total)
        yield pa.record_batch({"pair": found, "n": total.ravel()[found].astype(np.int64)})

    return _summed(counts.mapInArrow(run, "pair long, n long"), classes)


def moved(counts: DataFrame, label: np.ndarray, between: np.ndarray, turn: int, share: int) -> np.ndarray:
    """Classes after one in `share` units, by turns, has gone to its best class, all others being as before."""
    shared = counts.sparkSession.sparkContext.broadcast((label, between))
    classes = len(between)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        label, between = shared.value
        for batch in batches:
            for unit, dense in _dense(batch, classes):
                new = best_classes(label[unit], dense[:, :classes], dense[:, classes:-1], dense[:, -1], between)
                yield pa.record_batch({"unit": unit, "label": new.astype(np.int32)})

    units = counts.where((F.col("unit") > 0) & (F.pmod(F.xxhash64("unit"), F.lit(share)) == turn % share))
    found = units.mapInArrow(run, "unit int, label int").toArrow()
    out = label.copy()
    out[found["unit"].to_numpy()] = found["label"].to_numpy()
    return out


def cluster(near: DataFrame, seed: np.ndarray, rounds: int = SPARK_ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Class of each unit, and how often each class follows each.

    Starts from the classes of the seeds. In a round every second unit moves by its own gain, whatever the
    others of the round do. A round that lowers the likelihood is undone, and half as many
    units move in those after it. What the driver holds is a class per unit.
    """

    def measured(label):
        counts = staged(class_counts(near, label, CLASSES), "classes")
        between = class_pairs(counts, label, CLASSES)
        return likelihood(between), label, between, counts

    best, share = measured(exchange(seed_pairs(near, seed))[seed]), 2
    for turn in range(rounds):
        _, label, between, counts = best
        found = measured(moved(counts, label, between, turn, share))
        if found[0] > best[0]:
            best = found
        else:
            share *= 2
    return best[1], best[2]


class Model:
    """Everything of bounded size that a task needs to score a text."""

    def __init__(self, vocabulary: Vocabulary, label: np.ndarray, moves: np.ndarray, tokens_in: np.ndarray, words_in: np.ndarray):
        """`moves`: classes after classes; `tokens_in`, `words_in`: tokens and distinct words of each unit in the training texts."""
        classes = len(moves)
        self.vocabulary, self.label = vocabulary, label
        self.transition = np.log10((moves + 0.5) / (moves.sum(axis=1, keepdims=True) + 0.5 * classes))
        #: Log10 of what an emission's count + 0.5 is divided by; a class has one unseen word.
        tokens_in, words_in = (np.bincount(label, has, classes) for has in (tokens_in, words_in))
        self.divisor = np.log10(tokens_in + 0.5 * (words_in + 1))
        self.known = np.log10(vocabulary.counts + 0.5)

    def sums(self, codes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For texts that begin at `starts`: the sum of log10 transitions over divisors, that of log10(count + 0.5) of frequent words, and how many these are."""
        label = self.label[self.vocabulary.units(codes)]
        path = self.transition[np.concatenate([label[-1:], label[:-1]]), label] - self.divisor[label]
        frequent = codes >= 0
        known = np.zeros(len(codes))
        known[frequent] = self.known[codes[frequent]]
        return np.add.reduceat(path, starts), np.add.reduceat(known, starts), np.add.reduceat(frequent.astype(np.int64), starts)

    def score(self, words: list[bytes]) -> tuple[float, float, int]:
        """`sums` of one text."""
        path, known, n_frequent = self.sums(self.vocabulary.codes(words), np.zeros(1, np.int64))
        return float(path[0]), float(known[0]), int(n_frequent[0])


def frequent_words(counts: DataFrame, frequent: int = FREQUENT, least: int = LEAST) -> Vocabulary:
    """The `frequent` words that `count_words` found most often; those seen `least` times or more are units of their own."""
    top = counts.orderBy(F.desc("n"), "word").limit(frequent).toArrow()
    return Vocabulary(*(top[name].to_numpy() for name in ("word", "pool", "n")), least)


def fitted(counts: DataFrame, vocabulary: Vocabulary, near: DataFrame, rounds: int = SPARK_ROUNDS) -> tuple[Model, int, int]:
    """Model, tokens N and distinct words V of the training texts, from their counts and `neighbours`."""
    total = counts.agg(F.sum("n"), F.count("*")).first()
    first_pool = 1 + vocabulary.own
    tokens_in, words_in = np.zeros(vocabulary.size), np.zeros(vocabulary.size)
    for pool, n, distinct in counts.groupBy("pool").agg(F.sum("n"), F.count("*")).collect():
        tokens_in[first_pool + pool], words_in[first_pool + pool] = n, distinct
    own = vocabulary.unit < first_pool  # counted with their pool so far
    pools = first_pool + vocabulary.pools
    np.subtract.at(tokens_in, pools[own], vocabulary.counts[own])
    np.subtract.at(words_in, pools[own], 1)
    np.add.at(tokens_in, vocabulary.unit[own], vocabulary.counts[own])
    np.add.at(words_in, vocabulary.unit[own], 1)
    label, moves = cluster(near, vocabulary.seed, rounds)
    return Model(vocabulary, label, moves, tokens_in, words_in), int(total[0] or 0), int(total[1])


def learn(
    counts: DataFrame,
    training: DataFrame,
    frequent: int = FREQUENT,
    text_col: str = "text",
    least: int = LEAST,
    rounds: int = SPARK_ROUNDS,
) -> tuple[Model, int, int]:
    """Model, tokens N and distinct words V of the training texts; `counts` as `count_words` gives them.

    Of the `frequent` words those seen `least` times or more are clustered one by one, all others by their
    ending. Broadcast are `frequent` words at most, the classes of their units and the transitions.
    """
    vocabulary = frequent_words(counts, frequent, least)
    shared = counts.sparkSession.sparkContext.broadcast(vocabulary)
    near = staged(neighbours(training, shared, vocabulary.size, text_col), "neighbours")
    return fitted(counts, vocabulary, near, rounds)


def score_documents(
    docs: DataFrame, training: DataFrame | Column, frequent: int = FREQUENT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Log10 probability of every whole text, learned from all texts of `training`, or from the rows of `docs` where that is true.

    Returns doc_id, n_tokens, n_known, train_tokens, base_score (smoothed unigrams), score (the class model)
    and perplexity (10 ** (-score / n_tokens)). A NULL or empty text is an end alone; a very long one is scored whole. Rows with NULL or repeated
    ids are scored one by one; other columns are not carried. Without training texts every word is unseen.

    Texts are resolved to frequent words once, and neighbours and scores come from the written codes. Each other word of a
    text is one row that meets its count by a join on the word; no such word is frequent, so no key is hot. Words stand as 64-bit
    hashes: with 10 million distinct ones, two share a hash with a chance of 3 in a million.
    """
    spark = docs.sparkSession
    among = isinstance(training, Column)
    learned = F.coalesce(training, F.lit(False)) if among else F.lit(False)
    counts = staged(count_words(docs.where(learned) if among else training, text_col), "words")
    vocabulary = frequent_words(counts, frequent)
    words = spark.sparkContext.broadcast(vocabulary)
    kept = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), learned.alias("learn"))
    texts = staged(encoded(kept, words), "encoded")
    near = neighbours_of(texts.where("learn"), words, vocabulary.size) if among else neighbours(training, words, vocabulary.size, text_col)
    model, total, distinct = fitted(counts, vocabulary, staged(near, "neighbours"))
    shared = spark.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["row", "doc_id", "n_tokens", "n_frequent", "path", "known"]
        for batch in batches:
            for rows, codes in _codes(batch.column(3)):
                row, doc_id, n = (column[rows] for column in batch.columns[:3])
                ends = np.cumsum(n.to_numpy())
                path, known, n_frequent = shared.value.sums(codes, np.append(0, ends[:-1]))
                yield pa.record_batch([row, doc_id, n, pa.array(n_frequent), pa.array(path), pa.array(known)], names=names)

    schema = "row long, doc_id long, n_tokens long, n_frequent long, path double, known double"
    partial = texts.select("row", "doc_id", "n_tokens", "codes").mapInArrow(scored, schema)
    rare = texts.select("row", F.inline(F.arrays_zip("words", "times")).alias("word", "times"))
    count = F.coalesce("n", F.lit(0))
    met = rare.join(counts.select("word", "n"), "word", "left")
    sums = met.groupBy("row").agg(
        F.sum(F.col("times") * F.log10(count + 0.5)).alias("rest"),
        F.sum(F.when(count > 0, F.col("times")).otherwise(0)).alias("rest_known"),
    )
    found = F.col("known") + F.coalesce("rest", F.lit(0.0))
    base = found - F.col("n_tokens") * float(np.log10(total + 0.5 * (distinct + 1)))
    score = found + F.col("path")
    return partial.join(sums, "row", "left").select(
        "doc_id",
        "n_tokens",
        (F.col("n_frequent") + F.coalesce("rest_known", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        base.alias("base_score"),
        score.alias("score"),
        F.pow(F.lit(10.0), -score / F.col("n_tokens")).alias("perplexity"),
    )


def op10_class_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fold = fold_of(F.col("doc_id"))
    scored = score_documents(docs, fold != 1)
    columns = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"]
    return scored.withColumn("held_out", fold.eqNullSafe(1)).select(columns)

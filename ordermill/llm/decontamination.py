"""Benchmark decontamination by latent semantic retrieval.

Benchmark texts are cut into passages. A randomised SVD of their TF-IDF matrix gives a latent space; its
sums are made by Spark over the passages, and document frequencies come from all documents. Windows
of every document are projected into the space and compared with all passages, in blocks. A window near a
passage is then checked word by word: the longest common subsequence has to hold most of the passage's weight
within a stretch hardly longer than the passage, and the answer, where the item has one.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.llm.batches import fold_rows, map_rows, table
from ordermill.llm.codes import word_hashes
from ordermill.session import staged

PASSAGE = 48
STEP = 32  # a window is two steps long, so it holds five sixths of any passage at least
RANK = 224
OVERSAMPLE = 16
POWER = 2
BLOCK = 256
COSINE_SHARE = 0.4
LCS_SHARE = 0.6
STRETCH = 1.6
SEED = 11
_SKETCH = 256
_WORDS_AT_ONCE = 1 << 16


def cut(words: np.ndarray, size: int = PASSAGE) -> list[np.ndarray]:
    """Passages of `size` words at most that cover all words; the last one ends with the text."""
    if len(words) <= size:
        return [words] if len(words) else []
    starts = list(range(0, len(words) - size, size // 2)) + [len(words) - size]
    return [words[at : at + size] for at in starts]


def passages(benchmark: DataFrame, id_col: str, text_col: str, answer_col: str | None) -> DataFrame:
    """One row per passage: item_id, passage, words (64-bit hashes in order), answer (likewise)."""

    def add(state, item_id, text, answer):
        parts = cut(word_hashes(text or ""))
        if parts:
            expected = word_hashes(answer or "").view(np.int64)
            yield [item_id] * len(parts), list(range(len(parts))), [part.view(np.int64) for part in parts], [expected] * len(parts)

    answer = F.col(answer_col) if answer_col and answer_col in benchmark.columns else F.lit(None).cast("string")
    rows = benchmark.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).alias("text"), answer.alias("answer"))
    schema = "item_id long, passage int, words array<long>, answer array<long>"
    return fold_rows(rows, schema, lambda: None, add, lambda _: iter(()))


class Terms:
    """Ascending hashes of the passages' words; a table of their first 16 bits rules most others out."""

    def __init__(self, values: np.ndarray):
        self.values = values
        self.first = np.zeros(1 << 16, bool)
        self.first[values >> np.uint64(48)] = True

    def places(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which words are terms, and the number of each."""
        maybe = np.flatnonzero(self.first[words >> np.uint64(48)])
        at = np.minimum(np.searchsorted(self.values, words[maybe]), len(self.values) - 1)
        hit = self.values[at] == words[maybe]
        return maybe[hit], at[hit]


def document_frequency(docs: DataFrame, terms: np.ndarray, text_col: str) -> tuple[np.ndarray, int]:
    """In how many documents each of `terms` (ascending hashes) occurs, and the number of documents."""
    shared = docs.sparkSession.sparkContext.broadcast(Terms(terms))

    def start():
        return np.zeros(len(shared.value.values) + 1, np.int64)

    def add(counts, text):
        places = shared.value.places(word_hashes(text or ""))[1]
        seen = np.zeros(len(counts), bool)
        seen[places] = True
        seen[-1] = True
        counts += seen

    def finish(counts):
        found = np.flatnonzero(counts)
        yield found, counts[found]

    rows = fold_rows(docs.select(text_col), "term int, n long", start, add, finish)
    sums = rows.groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(len(terms) + 1, np.int64)
    out[sums["term"].to_numpy()] = sums["n"].to_numpy()
    return out[:-1], int(out[-1])


def latent_space(rows: DataFrame, terms: np.ndarray, idf: np.ndarray, rank: int = RANK) -> np.ndarray:
    """Right singular vectors (terms x rank) of the passages' TF-IDF matrix, by a randomised SVD.

    Each step is a product of the matrix with a thin one, summed over the passages by Spark; a
    task sends its sum once, as one row per group of terms. What the driver holds is terms x rank.
    """
    spark = rows.sparkSession
    width = min(rank + OVERSAMPLE, len(terms))
    q = np.linalg.qr(np.random.default_rng(SEED).standard_normal((len(terms), width)))[0]

    def product(q: np.ndarray, small: bool) -> np.ndarray:
        """A'(A q), or the small (A q)'(A q)."""
        shared = spark.sparkContext.broadcast((terms, idf, q))
        height = q.shape[1] if small else len(terms)

        def add(total, words):
            known, weight, basis = shared.value
            at, tf = np.unique(np.searchsorted(known, np.array(words, np.int64).view(np.uint64)), return_counts=True)
            a = tf * weight[at]
            y = a @ basis[at]
            if small:
                total += np.outer(y, y)
            else:
                total[at] += np.outer(a, y)

        def finish(total):
            for first in range(0, height, _SKETCH):
                part = total[first : first + _SKETCH]
                yield [first // _SKETCH], [part.ravel()]

        def summed(group):
            import pyarrow as pa

            total = sum(np.array(values) for values in group["values"].to_pylist())
            return pa.table({"part": group["part"][:1], "values": pa.array([total], pa.list_(pa.float64()))})

        sums = fold_rows(rows.select("words"), "part int, values array<double>", lambda: np.zeros((height, q.shape[1])), add, finish)
        sums = sums.groupBy("part").applyInArrow(summed, "part int, values array<double>").orderBy("part").toArrow()
        return np.concatenate([np.array(v) for v in sums["values"].to_pylist()]).reshape(height, q.shape[1])

    for _ in range(POWER):
        q = np.linalg.qr(product(q, False))[0]
    values, vectors = np.linalg.eigh(product(q, True))
    return q @ vectors[:, np.argsort(-values)[:rank]]


class Index:
    """A block of passages in the latent space, and what a task needs to check windows against them."""

    def __init__(self, terms: np.ndarray, idf: np.ndarray, space: np.ndarray, block: list[dict], share: float):
        self.terms, self.idf = Terms(terms), idf
        self.project = (space * idf[:, None]).astype(np.float32)
        self.item = [row["item_id"] for row in block]
        self.words = [np.searchsorted(terms, np.array(row["words"], np.int64).view(np.uint64)).tolist() for row in block]
        self.weight = [float(idf[words].sum()) for words in self.words]
        self.bag = [[(word, n * idf[word], n) for word, n in Counter(words).items()] for words in self.words]
        self.answer = [np.array(row["answer"], np.int64).view(np.uint64) for row in block]
        latent = np.array([self.project[words].sum(axis=0) for words in self.words], np.float32)
        #: A window with all of a passage has the product 1 with it, one with half of its weight 1/2.
        self.query = (latent / np.maximum((latent**2).sum(axis=1), 1e-12)[:, None]).T.copy()
        self.share = share

    def candidates(self, size: int, inside: np.ndarray, terms: np.ndarray) -> Iterator[tuple[int, int]]:
        """Step number and passage, for windows of two steps that may hold the passage.

        `inside` are the places, of `size`, with a term. The cosine of a window w and a passage q is to be
        `share` times |q| / |w| or more, that is, the projections' product is `share` times |q|**2.
        """
        steps = -(-size // STEP)
        if not len(inside):
            return
        sums = np.zeros((steps + 1, self.project.shape[1]), np.float32)
        step = inside // STEP
        first = np.flatnonzero(np.diff(step, prepend=-1))
        for a in range(0, len(first), 256):
            b = min(a + 256, len(first))
            stop = first[b] if b < len(first) else len(inside)
            rows = self.project[terms[first[a] : stop]]
            sums[step[first[a:b]]] = np.add.reduceat(rows, first[a:b] - first[a], axis=0)
        for a in range(0, steps, 1024):
            windows = sums[a : min(a + 1024, steps)] + sums[a + 1 : min(a + 1024, steps) + 1]
            at, passage = np.nonzero(windows @ self.query >= self.share)
            yield from zip((at + a).tolist(), passage.tolist())

    def find(self, words: np.ndarray, lcs_share: float, found: dict) -> None:
        """Adds to `found` the items in a text, with the best share of their passages."""
        inside, terms = self.terms.places(words)
        near_step, near, counts = -1, ([], []), Counter()
        for step, passage in self.candidates(len(words), inside, terms):
            item = self.item[passage]
            if found.get(item, 0) > 0.999:
                continue
            if step != near_step:
                low, high = np.searchsorted(inside, (step * STEP - PASSAGE, (step + 2) * STEP + PASSAGE))
                near_step, near = step, (inside[low:high].tolist(), terms[low:high].tolist())
                counts = Counter(near[1])
            # the words in common, in any order, weigh as much as a common subsequence at least
            shared = sum(min(counts[word], n) * (weight / n) for word, weight, n in self.bag[passage] if word in counts)
            if shared < lcs_share * self.weight[passage]:
                continue
            share, first, last = common(self.words[passage], near, self.idf)
            if share < lcs_share or last - first + 1 > STRETCH * len(self.words[passage]) + 2:
                continue
            answer = self.answer[passage]
            if len(answer):
                around = words[max(0, first - 2 * PASSAGE) : last + 2 * PASSAGE]
                if not any(np.array_equal(around[i : i + len(answer)], answer) for i in np.flatnonzero(around == answer[0])):
                    continue
            found[item] = max(share, found.get(item, 0.0))


def common(own: list[int], near: tuple[list[int], list[int]], weight: np.ndarray) -> tuple[float, int, int]:
    """Weighted longest common subsequence: its share of `own`, and its first and last place.

    `near` has places, ascending, and the term at each. Pairs of equal words are taken in the order of `own`; a
    tree of prefix maxima over the places gives the best subsequence that each pair goes on from. Of
    equal ones, that which begins last counts.
    """
    places, terms = near
    where: dict[int, list[int]] = {}
    for i, term in enumerate(terms, 1):
        where.setdefault(term, []).append(i)
    size = len(terms)
    tree: list[tuple[float, int]] = [(0.0, -1)] * (size + 1)
    best = (0.0, -1, -1)
    for word in own:
        value = float(weight[word])
        for i in reversed(where.get(word, ())):
            top, j = (0.0, -1), i - 1
            while j:
                top = max(top, tree[j])
                j &= j - 1
            entry = (round(top[0] + value, 9), top[1] if top[1] >= 0 else i - 1)
            if (entry[0], entry[1] - i) > (best[0], best[1] - best[2]):
                best = (entry[0], entry[1], i)
            j = i
            while j <= size:
                tree[j] = max(tree[j], entry)
                j += j & -j
    if best[1] < 0:
        return 0.0, 0, 0
    return best[0] / max(float(sum(weight[word] for word in own)), 1e-12), places[best[1]], places[best[2] - 1]


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    answer_col: str | None = "answer",
    block: int = BLOCK,
    cosine_share: float = COSINE_SHARE,
    lcs_share: float = LCS_SHARE,
    rank: int = RANK,
) -> DataFrame:
    """(doc_id, item_id, lcs_share): which documents hold which benchmark items, once per pair.

    All documents and all passages are searched; passages are the stated query set, taken in blocks of about
    `block`, each with a latent space of its own and one pass over the documents. Whole texts are searched. NULL and empty
    texts hold nothing; items without words are found nowhere; items whose `answer_col` is
    there and has words are found only near their answer. Repeated rows are found once; rows with a
    NULL doc_id or item_id have a NULL there. Without benchmark items the result is empty.
    """
    spark = docs.sparkSession
    rows = staged(passages(benchmark, item_col, item_text_col, answer_col), "passages")
    schema = "doc_id long, item_id long, lcs_share double"
    terms = rows.select(F.explode("words").alias("term")).distinct().toArrow()["term"].to_numpy().view(np.uint64)
    terms = np.sort(terms)
    if not len(terms):
        return spark.createDataFrame([], schema)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    counts, total = document_frequency(texts, terms, "text")
    idf = np.log((1 + total) / (1 + counts)) + 0.05
    blocks = math.ceil(rows.count() / block)
    number = F.pmod(F.xxhash64("item_id", "passage", "words"), F.lit(blocks))
    found = []
    for part in range(blocks):
        own = rows.where(number == part) if blocks > 1 else rows
        held = own.orderBy("item_id", "passage").toArrow().to_pylist()
        if not held:
            continue
        known = np.unique(np.concatenate([row["words"] for row in held]).astype(np.int64).view(np.uint64))
        weight = idf[np.searchsorted(terms, known)]
        space = latent_space(own, known, weight, rank)
        found.append(_search(texts, Index(known, weight, space, held, cosine_share), lcs_share, schema))
    out = reduce(DataFrame.unionByName, found)
    return out.groupBy("doc_id", "item_id").agg(F.max("lcs_share").alias("lcs_share"))


def _search(texts: DataFrame, index: Index, lcs_share: float, schema: str) -> DataFrame:
    shared = texts.sparkSession.sparkContext.broadcast(index)

    def add(state, doc_id, text):
        words = word_hashes(text or "")
        found: dict[int | None, float] = {}
        for first in range(0, len(words), _WORDS_AT_ONCE):
            # pieces of a very long text overlap, so that no passage is cut
            shared.value.find(words[max(0, first - 4 * PASSAGE) : first + _WORDS_AT_ONCE], lcs_share, found)
        if found:
            yield [doc_id] * len(found), list(found), list(found.values())

    return fold_rows(texts, schema, lambda: None, add, lambda _: iter(()))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))

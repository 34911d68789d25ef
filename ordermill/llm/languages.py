"""Language identification by rank-order profiles of letter n-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ordermill.llm.batches import fold_of, fold_rows, map_rows, table
from ordermill.llm.codes import folded

PROFILE = 400
DOCUMENT = 300
LANGUAGES = 2_000
LEAST_SCORE = 0.3
EDGE = 1  # stands for a word's edge in an n-gram; no letter has this code point
_FLUSH = 1 << 20
_GRAMS = 400_000


def count_grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of one to three letters, ascending, and their counts.

    An n-gram is packed at 21 bits a code point. Words are runs of letters, between edges.
    """
    tail = np.full(1, EDGE, np.int64)
    keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for codes in _closed(text):
        codes = np.concatenate([tail, np.where(codes == 0, EDGE, codes).astype(np.int64)])
        kept = codes != EDGE
        kept[1:] |= codes[:-1] != EDGE
        kept[: len(tail)] = True
        codes, start = codes[kept], len(tail)
        if len(codes) == start:
            continue
        single = codes[start:]
        double = codes[start - 1 : -1] << 21 | single
        first = max(start, 2)
        middle = codes[first - 1 : -1]
        triple = (codes[first - 2 : -2] << 42 | middle << 21 | codes[first:])[middle != EDGE]
        new, n = np.unique(np.concatenate([single[single != EDGE], double, triple]), return_counts=True)
        keys, counts = (new, n) if not len(keys) else add_counts([keys, new], [counts, n])
        tail = codes[-2:]
    return keys, counts


def _closed(text: str) -> Iterator[np.ndarray]:
    yield from folded(text, False)
    yield np.zeros(1, np.uint32)


def add_counts(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    found, where = np.unique(np.concatenate(keys), return_inverse=True)
    return found, np.bincount(where, np.concatenate(counts), len(found)).astype(np.int64)


def ranked(keys: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """The most frequent n-grams, most frequent first; ties by the n-gram."""
    return keys[np.argsort(-counts, kind="stable")[:size]]


class Profiles:
    """Ranks of n-grams by language, for out-of-place distances."""

    def __init__(self, rows: list[tuple[str, int, int]], size: int):
        self.size = size
        self.languages = sorted({language for language, _, _ in rows})
        self.grams = np.unique(np.array([gram for _, gram, _ in rows], np.int64))
        column = {language: i for i, language in enumerate(self.languages)}
        self.ranks = np.full((len(self.grams) + 1, len(self.languages)), -1, np.int32)
        for language, gram, rank in rows:
            self.ranks[np.searchsorted(self.grams, gram), column[language]] = rank

    def best(self, text: str | None) -> tuple[str, float]:
        """Nearest language and 1 - distance / largest distance; ties by the language's name."""
        keys, counts = count_grams(text or "")
        if not len(keys) or not self.languages:
            return "und", 0.0
        top = ranked(keys, counts, DOCUMENT)
        at = np.searchsorted(self.grams, top)
        at[at == len(self.grams)] = 0
        ranks = self.ranks[np.where(self.grams[at] == top, at, len(self.grams))]
        places = np.arange(len(top))[:, None]
        distance = np.where(ranks < 0, self.size, np.abs(ranks - places)).sum(axis=0)
        best = int(distance.argmin())
        return self.languages[best], 1 - float(distance[best]) / (len(top) * self.size)


def learn_profiles(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", size: int = PROFILE, languages: int = LANGUAGES
) -> Profiles:
    """Profiles from every row that has a text and a language.

    Tasks count their own n-grams before the shuffle, so a language with most of the rows is
    no hot key. The driver gets `size` n-grams a language, for `languages` languages at most.
    """

    def flush(counted, language) -> tuple[list, ...]:
        keys, counts = counted.pop(language)
        return [language] * len(keys), keys, counts

    def add(state, language, text):
        waiting, counted = state
        texts = waiting.setdefault(language, [])
        texts.append(text)
        if sum(map(len, texts)) >= _FLUSH or len(texts) >= 4096:
            yield from settle(state, language)

    def settle(state, language):
        waiting, counted = state
        new = count_grams("\n".join(waiting.pop(language)))
        old = counted.get(language)
        counted[language] = add_counts([old[0], new[0]], [old[1], new[1]]) if old else new
        if len(counted[language][0]) > _GRAMS or len(counted) > 64:
            yield flush(counted, language)

    def finish(state):
        for language in list(state[0]):
            yield from settle(state, language)
        for language in list(state[1]):
            yield flush(state[1], language)

    known = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(lang_col, text_col)
    counts = fold_rows(known, "lang string, gram long, n long", lambda: ({}, {}), add, finish)
    total = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    top = total.withColumn("place", place).where(F.col("place") <= size)
    rows = top.limit(size * languages + 1).toArrow().to_pylist()
    if len(rows) > size * languages:
        raise ValueError(f"profiles are broadcast for at most {languages} languages")
    return Profiles([(row["lang"], row["gram"], row["place"] - 1) for row in rows], size)


def identify(docs: DataFrame, profiles: Profiles, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred and score (0 to 1) of every row, from its whole text alone.

    A NULL text, or one without a letter, is `und` with score 0; so is every text if no language was
    learned. A very long text is counted whole. Rows with NULL or repeated ids are kept one by one; other columns are not carried.
    """
    shared = docs.sparkSession.sparkContext.broadcast(profiles)
    kept = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return map_rows(
        kept,
        "doc_id long, lang_pred string, score double",
        lambda: lambda doc_id, text: (doc_id, *shared.value.best(text)),
    )


def identify_kept(docs: DataFrame, profiles: Profiles, text_col: str = "text", least: float = LEAST_SCORE) -> DataFrame:
    """The rows whose text is in a learned language, with all their columns.

    Rejected are texts that `identify` calls `und`, and those with a score below `least`: their n-grams are
    mostly in no profile. So are NULL and empty texts.
    """
    shared = docs.sparkSession.sparkContext.broadcast(profiles)
    place = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            texts = batch.column(place)
            keep = []
            for i in range(batch.num_rows):
                language, score = shared.value.best(texts[i].as_py())
                if language != "und" and score >= least:
                    keep.append(i)
            yield batch.take(pa.array(keep, pa.int64()))

    return docs.mapInArrow(run, docs.schema)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    profiles = learn_profiles(docs.where(fold_of(F.col("doc_id")) != 0))
    held_out = fold_of(F.col("doc_id")).eqNullSafe(0)
    return identify(docs, profiles).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")

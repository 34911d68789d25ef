"""Quality rules: statistics of every text, and an isolation forest over them."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
import pyarrow as pa

from ordermill.llm.batches import map_rows, table
from ordermill.session import staged

TREES = 128
SUBSAMPLE = 256
FIT_ROWS = 16_384
FALSE_REJECTS = 0.02
BINS = 4_096

SPACES = " \t\n\v\f\r"
SYMBOLS = "#*$%&|<>"
UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
RULES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = (
    "length",
    "word_length",
    "symbols_per_word",
    "duplicate_lines",
    "repeated_words",
    "upper_share",
    "exclamations_per_word",
    "digit_share",
    "words_per_line",
    "distinct_words",
)
_COLUMNS = "doc_id long, " + ", ".join(f"{name} long" for name in RULES) + ", " + ", ".join(f"{name} double" for name in FEATURES)


def repeated_words(words: list[bytes]) -> tuple[int, int]:
    """Words that lie in a 3-word window found twice or more; distinct words."""
    numbers: dict[bytes, int] = {}
    ids = np.array([numbers.setdefault(word, len(numbers)) for word in words], np.int64)
    if len(ids) < 4:
        return 0, len(numbers)
    _, pairs = np.unique(ids[:-2] * len(numbers) + ids[1:-1], return_inverse=True)
    _, window, count = np.unique(pairs * len(numbers) + ids[2:], return_inverse=True, return_counts=True)
    again = count[window] > 1
    inside = np.zeros(len(ids), bool)
    for shift in range(3):
        inside[shift : len(again) + shift] |= again
    return int(inside.sum()), len(numbers)


def rule_statistics(text: str | None) -> tuple:
    """The counts `RULES` and the ratios `FEATURES` of a whole text."""
    text = text or ""
    data = text.encode()
    words = data.split()  # of bytes, so at the six ASCII spaces only
    n = len(words)
    word_chars = len(text) - sum(map(text.count, SPACES))
    symbols = sum(map(text.count, SYMBOLS))
    seen: set[bytes] = set()
    lines = duplicates = 0
    for line in data.split(b"\n"):
        if line.strip():
            lines += 1
            duplicates += line in seen
            seen.add(line)
    repeated, distinct = repeated_words(words)
    letters = max(1, word_chars)
    return (
        *(n, word_chars, symbols, duplicates, repeated),
        float(np.log1p(n)),
        word_chars / max(1, n),
        symbols / max(1, n),
        duplicates / max(1, lines),
        repeated / max(1, n),
        (len(data) - len(data.translate(None, UPPER))) / letters,
        text.count("!") / max(1, n),
        (len(data) - len(data.translate(None, b"0123456789"))) / letters,
        float(np.log1p(n / max(1, lines))),
        distinct / max(1, n),
    )


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    kept = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return map_rows(kept, _COLUMNS, lambda: lambda doc_id, text: (doc_id, *rule_statistics(text)))


def expected_path(size: np.ndarray | int) -> np.ndarray:
    """Mean path length of an unsuccessful search among `size` points."""
    size = np.asarray(size, np.float64)
    harmonic = np.log(np.maximum(size - 1, 1)) + np.euler_gamma
    return np.where(size > 2, 2 * harmonic - 2 * (size - 1) / np.maximum(size, 1), np.where(size == 2, 1.0, 0.0))


class IsolationForest:
    """Trees of random splits as arrays: feature (-1 at a leaf), threshold, right child, path length."""

    def __init__(self, rows: np.ndarray, trees: int = TREES, subsample: int = SUBSAMPLE, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.size = min(subsample, len(rows))
        self.limit = max(1, int(np.ceil(np.log2(max(2, self.size)))))
        self.trees = [self._grow(rows[rng.choice(len(rows), self.size, replace=False)], rng) for _ in range(trees if len(rows) > 1 else 0)]

    def _grow(self, rows: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, ...]:
        feature, threshold, right, path = [], [], [], []

        def node(own: np.ndarray, depth: int) -> None:
            at = len(feature)
            feature.append(-1)
            threshold.append(0.0)
            right.append(0)
            path.append(depth + float(expected_path(len(own))))
            low, high = own.min(axis=0), own.max(axis=0)
            spread = np.flatnonzero(high > low)
            if depth == self.limit or not len(spread):
                return
            feature[at] = int(rng.choice(spread))
            threshold[at] = float(rng.uniform(low[feature[at]], high[feature[at]]))
            below = own[:, feature[at]] <= threshold[at]
            node(own[below], depth + 1)
            right[at] = len(feature)
            node(own[~below], depth + 1)

        node(rows, 0)
        return np.array(feature), np.array(threshold), np.array(right), np.array(path)

    def anomaly(self, rows: np.ndarray) -> np.ndarray:
        """2 ** (-mean path length / expected one): near 1 for rows that few splits isolate."""
        if not self.trees:
            return np.zeros(len(rows))
        total = np.zeros(len(rows))
        each = np.arange(len(rows))
        for feature, threshold, right, path in self.trees:
            at = np.zeros(len(rows), np.int64)
            for _ in range(self.limit):
                inner = feature[at] >= 0
                above = rows[each, np.maximum(feature[at], 0)] > threshold[at]
                at = np.where(inner, np.where(above, right[at], at + 1), at)
            total += path[at]
        return 2.0 ** (-total / len(self.trees) / max(float(expected_path(self.size)), 1e-9))


def fit_forest(stats: DataFrame, rows: int = FIT_ROWS) -> IsolationForest:
    """A forest over at most `rows` rows, those with the smallest hashes of their ids; of equal ids, by those of the statistics."""
    sample = stats.orderBy(F.xxhash64("doc_id"), F.xxhash64(*FEATURES), *FEATURES).select(*FEATURES).limit(rows).toArrow()
    return IsolationForest(np.column_stack([sample[name].to_numpy() for name in FEATURES]))


def anomalies(stats: DataFrame, forest: IsolationForest) -> DataFrame:
    """The rule counts of every row and its anomaly score."""
    shared = stats.sparkSession.sparkContext.broadcast(forest)
    schema = "doc_id long, " + ", ".join(f"{name} long" for name in RULES) + ", anomaly double"
    fields = to_arrow_schema(T.StructType.fromDDL(schema))

    def run(batches):
        for batch in batches:
            rows = np.column_stack([batch[name].to_numpy() for name in FEATURES])
            yield pa.record_batch([*(batch[name] for name in ("doc_id", *RULES)), pa.array(shared.value.anomaly(rows))], schema=fields)

    return stats.mapInArrow(run, schema)


def calibrate(scored: DataFrame, labels: DataFrame, false_rejects: float = FALSE_REJECTS) -> float:
    """Largest anomaly that is kept: at most `false_rejects` of the good labelled rows lie above it.

    Within that, the threshold that best parts good rows from bad ones. From counts of all labelled
    rows in `BINS` bins; without good labelled rows nothing is rejected.
    """
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    binned = scored.join(known, "doc_id").groupBy("quality", F.floor(F.col("anomaly") * BINS).alias("bin")).count()
    good, bad = np.zeros(BINS + 1), np.zeros(BINS + 1)
    for quality, place, n in binned.collect():
        (good if quality else bad)[place] += n
    if not good.sum():
        return 1.0
    share = lambda counts: 1 - np.cumsum(counts) / max(counts.sum(), 1)  # noqa: E731  above the bin
    allowed = share(good) <= false_rejects
    gain = np.where(allowed, share(bad) - share(good), -1)
    return float((int(gain.argmax()) + 1) / BINS)


def judge(
    docs: DataFrame,
    labels: DataFrame,
    fit_rows: int = FIT_ROWS,
    false_rejects: float = FALSE_REJECTS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Rule counts, `base_failed`, `anomaly` and `kept` of every document.

    NULL and empty texts have no words, so they fail the base rules; a very long text is counted whole, in one task. A row is kept if it passes these and
    its anomaly is not above the calibrated threshold. The forest is fitted on at most `fit_rows` rows;
    statistics, scores and calibration cover all. Rows with NULL or repeated ids are kept one by one, but
    NULL ids have no labels; a repeated label counts as its best one. Other columns are not carried.
    """
    stats = staged(statistics(docs, id_col, text_col), "statistics")
    scored = staged(anomalies(stats, fit_forest(stats, fit_rows)), "anomalies")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    limit = calibrate(scored.where(~failed), labels, false_rejects)
    return scored.select(
        "doc_id",
        *RULES,
        failed.alias("base_failed"),
        (~failed & (F.col("anomaly") <= limit)).alias("kept"),
        "anomaly",
    )


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))

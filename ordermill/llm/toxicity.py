"""Toxicity by non-negative positive-unlabelled learning."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.llm.batches import fold_of, fold_rows, map_rows, table
from ordermill.llm.codes import word_hashes
from ordermill.session import staged

BITS = 18
POSITIVES = 8_192
UNLABELLED = 16_384
FEATURES = 384
PREFIXES = (5, 7)
STEPS = 1_500

Model = tuple[np.ndarray, np.ndarray, tuple[float, float]]


def buckets(text: str | None) -> np.ndarray:
    """Hashed words and word beginnings of a whole text, ascending; their counts, up to 15, in the low 4 bits."""
    found, counts = np.unique(word_hashes(text or "", PREFIXES) >> np.uint64(64 - BITS), return_counts=True)
    return (found << np.uint64(4) | np.minimum(counts, 15).astype(np.uint64)).astype("<u4")


def strength(counts: np.ndarray) -> np.ndarray:
    """What a count weighs: one stray word and several differ, many and very many do not."""
    return np.minimum(counts, 6).astype(np.float64)


def level(row: np.ndarray) -> int:
    """How long a text is, in doublings: a few stray words count for less in a long one."""
    return len(row).bit_length()


def select_features(in_p: np.ndarray, in_u: np.ndarray, n_p: int, n_u: int, size: int) -> np.ndarray:
    """Buckets that positive texts have more often than others, by the z score of the shares.

    `in_p` and `in_u` count the texts, of `n_p` and `n_u`, that have each bucket.
    """
    share_p, share_u = (in_p + 0.5) / (n_p + 1), (in_u + 0.5) / (n_u + 1)
    z = (share_p - share_u) / np.sqrt(share_u * (1 - share_u) / n_p)
    z[in_p < 2] = 0
    order = np.argsort(-z, kind="stable")[:size]
    return np.sort(order[z[order] > 3])


def places_of(features: np.ndarray) -> np.ndarray:
    place = np.full(1 << BITS, -1, np.int64)
    place[features] = np.arange(len(features))
    return place


def selected(row: np.ndarray, place: np.ndarray) -> bytes:
    """What a text has of the features: place of each and, in the low 4 bits, its count."""
    at = place[row >> 4]
    return (at << 4 | row & 15)[at >= 0].astype("<u4").tobytes()


def dense(rows: list[tuple[bytes, int, int]], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows over `size` features, the level and a constant 1, and the share of texts equal to each.

    `rows` has what a text has of the features, its level, and how many texts are so.
    """
    out = np.zeros((len(rows), size + 2))
    for i, (key, doublings, _) in enumerate(rows):
        row = np.frombuffer(key, "<u4")
        out[i, row >> 4] = strength(row & 15)
        out[i, -2:] = doublings, 1
    counts = np.array([count for _, _, count in rows], np.float64)
    return out, counts / counts.sum()


def fit_nnpu(
    positive: tuple[np.ndarray, np.ndarray],
    unlabelled: tuple[np.ndarray, np.ndarray],
    prior: float,
    steps: int = STEPS,
    l2: float = 1e-4,
    rate: float = 0.05,
) -> np.ndarray:
    """Weights (the last is the bias) of a logistic classifier by the non-negative risk estimator.

    Both sets come as rows and their shares. The risk is prior * E_p[loss(+)] + max(0, E_u[loss(-)] -
    prior * E_p[loss(-)]). Where the second term is negative, a step raises it instead, so that the
    classifier does not fit unlabelled rows as negatives beyond what the class prior allows.
    """
    (rows_p, share_p), (rows_u, share_u) = positive, unlabelled
    weights = np.zeros(rows_p.shape[1])
    weights[-1] = np.log(prior / (1 - prior))
    first, second = np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, steps + 1):
        z_p, z_u = rows_p @ weights, rows_u @ weights
        toxic_p, toxic_u = (1 / (1 + np.exp(-np.clip(z, -30, 30))) for z in (z_p, z_u))
        pull = prior * ((toxic_p - 1) * share_p) @ rows_p
        push = (toxic_u * share_u) @ rows_u - prior * (toxic_p * share_p) @ rows_p
        negative_risk = share_u @ np.logaddexp(0, z_u) - prior * share_p @ np.logaddexp(0, z_p)
        gradient = pull + push if negative_risk >= 0 else -push
        gradient = gradient + l2 * np.append(weights[:-1], 0)
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        weights -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return weights


def learn(
    docs: DataFrame,
    labels: DataFrame,
    positives: int = POSITIVES,
    unlabelled: int = UNLABELLED,
    features: int = FEATURES,
) -> Model:
    """Features, weights, and weight of the level and bias from confirmed toxic rows and unlabelled text.

    `docs` (doc_id, text) and `labels` (doc_id, toxic) hold the rows to learn from. The classifier is
    fitted on a bounded sample: at most `positives` toxic ids and `unlabelled` ids of any
    documents, those with the smallest hashes. The class prior is the toxic share of all labelled rows.
    Without toxic rows or texts there are no features and the bias is -4.
    """
    spark = docs.sparkSession
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL")
    prior = known.agg(F.avg((F.col("toxic") == 1).cast("double"))).first()[0] or 0.0

    def some(ids: DataFrame, size: int) -> DataFrame:
        return ids.where("doc_id IS NOT NULL").select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(size)

    chosen = some(known.where("toxic = 1"), positives).withColumn("toxic", F.lit(1))
    chosen = chosen.unionByName(some(docs, unlabelled).withColumn("toxic", F.lit(0)))
    picked = chosen.groupBy("doc_id").agg(F.max("toxic").alias("p"), F.min("toxic").alias("u")).collect()
    wanted = spark.sparkContext.broadcast({row.doc_id: (row.p, 1 - row.u) for row in picked})

    def marked(state, doc_id, text):
        sides = wanted.value.get(doc_id)
        if sides:
            yield [doc_id], [sides[0]], [sides[1]], [buckets(text).tobytes()]

    schema = "doc_id long, p int, u int, words binary"
    rows = fold_rows(docs.select("doc_id", "text"), schema, lambda: None, marked, lambda _: iter(()))
    rows = rows.groupBy("doc_id", "p", "u").agg(F.min("words").alias("words"))  # a repeated id counts once
    rows = staged(rows.select("p", "u", "words"), "toxicity_sample")

    # what comes to the driver is bounded by the buckets and then by the sample, however long its texts are
    in_p, in_u = count_buckets(rows)
    if not in_p[-1] or not in_u[-1] or not 0 < prior < 1:
        return np.zeros(0, np.int64), np.zeros(0), (0.0, -4.0)
    chosen_features = select_features(in_p[:-1], in_u[:-1], in_p[-1], in_u[-1], features)
    place = spark.sparkContext.broadcast(places_of(chosen_features))

    def narrow(p, u, words):
        row = np.frombuffer(words, "<u4")
        return p, u, selected(row, place.value), level(row)

    alike = map_rows(rows, "p int, u int, has binary, level int", lambda: narrow).groupBy("p", "u", "has", "level").count().collect()
    sides = [[(row.has, row.level, row["count"]) for row in alike if row[side]] for side in ("p", "u")]
    weights = fit_nnpu(*(dense(side, len(chosen_features)) for side in sides), prior)
    return chosen_features, weights[:-2], (float(weights[-2]), float(weights[-1]))


def count_buckets(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Texts of each side that have each bucket; the last entry counts the texts."""

    def add(state, p, u, words):
        at = np.append(np.frombuffer(words, "<u4") >> 4, 1 << BITS)
        state[0][at] += p
        state[1][at] += u

    def finish(state):
        found = np.flatnonzero(state[0] + state[1])
        yield found, state[0][found], state[1][found]

    start = lambda: (np.zeros((1 << BITS) + 1, np.int64), np.zeros((1 << BITS) + 1, np.int64))
    sums = fold_rows(rows, "bucket int, p long, u long", start, add, finish).groupBy("bucket").agg(F.sum("p").alias("p"), F.sum("u").alias("u")).toArrow()
    out = start()
    for side, name in zip(out, ("p", "u")):
        side[sums["bucket"].to_numpy()] = sums[name].to_numpy()
    return out


def score_toxicity(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score (0 to 1) and predicted (1 if score >= 0.5) of every row, from its whole text.

    A NULL or empty text has the score of a text without any known word; of a very long one all words count. Rows with NULL or repeated
    ids are kept one by one; other columns are not carried.
    """
    features, weights, (by_level, bias) = model
    values = np.zeros(1 << BITS, np.float32)
    values[features] = weights
    shared = docs.sparkSession.sparkContext.broadcast(values)

    def row(doc_id, text):
        found = buckets(text)
        logit = bias + by_level * level(found) + float(shared.value[found >> 4] @ strength(found & 15))
        score = float(1 / (1 + np.exp(-np.clip(logit, -30, 30))))
        return doc_id, score, int(score >= 0.5)

    kept = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return map_rows(kept, "doc_id long, score double, predicted int", lambda: row)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    training = fold_of(F.col("doc_id")) != 0
    model = learn(docs.where(training), labels.where(training))
    held_out = fold_of(F.col("doc_id")).eqNullSafe(0)
    return score_toxicity(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")

"""Operator 2: toxicity of restored text.

The character model counts the trigrams of all documents: every task adds up one table of fixed size (28 cubed), so
the counts grow with the input and what is shuffled does not. Words of a text are restored by Viterbi decoding
(``channel``). Weights of words and word beginnings are smoothed log odds learned from labelled rows outside the
held-out fifth, at most ``sample`` of them in the order of a hash of their id; a logistic regression on the strongest
weights of a document turns them into a score. Every document is scored over its whole text.

Null and empty texts get the score of a text without any weighted word. Repeated documents get a row each; a null id
is never held out and never learned from; an id with several labels is learned once per label. Without labelled rows
of both kinds every score is 0.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arrears.llm import channel, common

FOLDS = 5
#: Bound of the labelled rows the classifier is fitted on, and of the weights it keeps.
SAMPLE, WEIGHTS = 20_000, 8_000
LEAST_ROWS, LEAST_WEIGHT = 5, 2.0
BEGINNINGS = range(3, 7)


def held_out(id_col: str) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % FOLDS == 0, F.lit(False))


def features(word: str) -> list[str]:
    """The word itself, and its beginnings marked with a star."""
    return [word, *(word[:k] + "*" for k in BEGINNINGS if len(word) > k)]


def character_model(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Trigram model over the whole texts of all documents."""

    def factory():
        total = np.zeros(channel.SYMBOLS ** 3, np.int64)

        def add(texts: list) -> None:
            nonlocal total
            total += channel.trigram_counts([t for t in texts if t])

        return add, lambda: [(int(k), int(total[k])) for k in np.flatnonzero(total)]

    counts = np.zeros(channel.SYMBOLS ** 3)
    for r in common.summarise(docs, text, "k int, n long", factory).groupBy("k").agg(F.sum("n").alias("n")).collect():
        counts[r.k] = r.n
    return channel.log_model(counts)


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str, text: str, label: str, sample: int) -> DataFrame:
    """At most ``sample`` labelled rows outside the held-out fold, written once so that every step sees the same."""
    marked = labels.select(F.col(id_col).alias("id"), F.col(label).cast("int").alias("y")).where("y in (0, 1)").distinct()
    # Ids are chosen before texts are read: the order of the hash only needs the id. At most ``sample`` short rows are
    # broadcast, so texts of other documents are never moved.
    chosen = marked.where(~held_out("id")).orderBy(F.xxhash64(F.col("id")), "id", "y").limit(sample)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text).alias("t")).join(F.broadcast(chosen), "id")
    return common.written(rows.dropDuplicates(["id", "y"]).select("y", "t"), "toxicity-train")


def word_weights(train: DataFrame, model) -> dict[str, float]:
    """Log odds of the words and beginnings that mark label 1, at most ``WEIGHTS`` of them."""
    label_rows = {r.y: r["count"] for r in train.groupBy("y").count().collect()}
    if not (label_rows.get(0) and label_rows.get(1)):
        return {}

    def factory():
        restorer = channel.Restorer(model.value)
        return lambda texts: [
            (sorted(set(chain.from_iterable(map(features, restorer.words(t))))),) for t in texts]

    seen = common.map_rows(train, "t", ["y"], "f array<string>", factory).select("y", F.explode("f").alias("f"))
    sums = seen.groupBy("f").agg(
        F.sum("y").alias("pos"), F.sum(1 - F.col("y")).alias("neg")).where(F.col("pos") >= LEAST_ROWS)
    weight = (F.log((F.col("pos") + 0.5) / (label_rows[1] + 1)) - F.log((F.col("neg") + 0.5) / (label_rows[0] + 1)))
    top = sums.withColumn("w", weight).where(F.col("w") >= LEAST_WEIGHT).orderBy(
        F.desc(F.col("w") * F.sqrt("pos")), "f").limit(WEIGHTS)
    return {r.f: r.w for r in top.select("f", "w").collect()}


def weight_of(weights: dict[str, float]):
    """A word's largest weight, or None without any; most words are told by their first letters alone."""
    starts = {f[:BEGINNINGS[0]] for f in weights}

    def weight(word: str) -> float | None:
        if word[:BEGINNINGS[0]] not in starts:
            return None
        return max((weights[f] for f in features(word) if f in weights), default=None)

    return weight


def evidence(found: dict[str, float]) -> list[float]:
    """Strongest weights of a text: the largest, the second, and the square root of the sum."""
    top = sorted(found.values(), reverse=True)
    return [top[0] if top else 0.0, top[1] if len(top) > 1 else 0.0, sum(top) ** 0.5]


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "toxic",
             keep: list[str] | None = None, sample: int = SAMPLE) -> DataFrame:
    """Per row: id (and ``keep``), held_out, score, predicted."""
    context = docs.sparkSession.sparkContext
    keep = list(dict.fromkeys([id_col, *(keep or [])]))
    model = context.broadcast(character_model(docs, text))
    train = training_rows(docs, labels, id_col, text, label, sample)
    weights = context.broadcast(word_weights(train, model))

    def factory():
        restorer = channel.Restorer(model.value, weight_of(weights.value))
        return lambda texts: [(evidence(restorer.words(t)),) for t in texts]

    if weights.value:
        fitted = LogisticRegression(featuresCol="x", labelCol="y", regParam=0.001).fit(common.written(
            common.map_rows(train, "t", ["y"], "e array<double>", factory), "toxicity-fit").select(
                "y", array_to_vector("e").alias("x")))
        slopes, offset = [float(c) for c in fitted.coefficients], float(fitted.intercept)
    else:
        slopes, offset = [0.0] * 3, -1e9

    def scorer():
        restorer = channel.Restorer(model.value, weight_of(weights.value))

        def work(texts: list) -> list[tuple]:
            scores = [channel.chance(offset + float(np.dot(slopes, evidence(restorer.words(t))))) for t in texts]
            return [(s, int(s >= 0.5)) for s in scores]

        return work

    scored = common.map_rows(docs, text, keep, "score double, predicted int", scorer)
    return scored.select(*keep, held_out(id_col).alias("held_out"), "score", "predicted")


def op2_noisy_channel(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity(common.table(spark, folder, "documents"), common.table(spark, folder, "labels"))

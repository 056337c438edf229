"""Operator 12: quality by hashed word n-grams and logistic regression, learned by follow-the-regularised-leader.

A text's words are its stretches of letters, of digits and of other signs, as written. Its features are the buckets of
its words and of its pairs of neighbouring words, each once; the vector has length 1, so long texts weigh no more than
short ones. A score is one sparse dot product.

The learner keeps two numbers per bucket (the leader's sum and the squared gradients), so the model has a fixed size.
Each pass sends the labelled rows, in shards of ``SHARD_ROWS``, through one learner per shard, all of which begin with
the same state; the next pass begins with the mean of their states. A shard is streamed row by row in the order of a
hash of its ids. At most ``sample`` labelled rows are learned from, chosen by that hash. The mean of the shards' states
is taken in ``PARTS`` ranges of buckets by as many tasks, so one state of 2 MB a pass comes to the driver. Every document is scored over its whole text; a very long text
needs memory in proportion to its own words.

Null and empty texts have no features and get the score of the offset. A null id is never held out and never learned
from. An id with several labels is learned once per label; one with several texts by the least of their feature lists.
Repeated documents get a row each. Without labelled rows every score is 0.5. An empty table gives no rows; other
columns are ignored and cannot clash.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arrears.llm import common

FOLDS, HELD_FOLD = 4, 2
THRESHOLD = 0.7
WORD = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+")
#: Buckets of features; the first one is the offset.
BUCKETS = 1 << 17
#: Bound of the labelled rows that are learned from, and rows of one shard.
SAMPLE, SHARD_ROWS = 20_000, 1_000
#: Ranges of buckets whose mean states are taken apart.
PARTS = 8
PASSES = 6
#: Learning rate and its damping, and the two penalties.
RATE, DAMPING, SPARSE, SMOOTH = 2.0, 1.0, 0.02, 0.05
_FACTOR, _SPREAD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def held_out(id_col: str) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS == HELD_FOLD, F.lit(False))


def buckets(text: str | None) -> np.ndarray:
    """The distinct buckets of a text's words and word pairs, in rising order."""
    words = WORD.findall(text) if text else []
    h = np.fromiter(map(crc32, map(str.encode, words)), np.uint64, len(words)) * _FACTOR
    grams = np.concatenate((h, (h[:-1] ^ (h[1:] >> np.uint64(7))) * _SPREAD))
    return np.unique((grams >> np.uint64(32)) % np.uint64(BUCKETS - 1)).astype(np.int32) + 1


class Learner:
    """Follow-the-regularised-leader (proximal) for logistic loss, with a learning rate per bucket."""

    def __init__(self, leader: np.ndarray | None = None, squares: np.ndarray | None = None):
        self.leader = np.zeros(BUCKETS) if leader is None else leader.copy()
        self.squares = np.zeros(BUCKETS) if squares is None else squares.copy()

    def weights(self, at: np.ndarray | None = None) -> np.ndarray:
        """Closed form of the leader; small sums give exact zeros. The offset (bucket 0) has no sparse penalty."""
        at = np.arange(BUCKETS) if at is None else at
        z, bar = self.leader[at], np.where(at == 0, 0.0, SPARSE)
        return np.where(np.abs(z) <= bar, 0.0, (np.sign(z) * bar - z) / (
            (DAMPING + np.sqrt(self.squares[at])) / RATE + SMOOTH))

    def learn(self, found: np.ndarray, label: int) -> None:
        at = np.concatenate((np.zeros(1, found.dtype), found))
        values, w, n = vector(found), self.weights(at), self.squares[at]
        slope = (chance(float(w @ values)) - label) * values
        grown = n + slope * slope
        self.leader[at] += slope - (np.sqrt(grown) - np.sqrt(n)) / RATE * w
        self.squares[at] = grown


def vector(found: np.ndarray) -> np.ndarray:
    """Values of the offset and of a text's buckets."""
    values = np.full(len(found) + 1, 1 / np.sqrt(max(1, len(found))))
    values[0] = 1.0
    return values


def chance(margin: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(margin, -500, 500))))


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str, text: str, label: str, sample: int) -> DataFrame:
    """Shard, order, label and buckets of at most ``sample`` labelled rows outside the held-out fold; written once."""
    marked = labels.select(F.col(id_col).alias("id"), F.col(label).cast("int").alias("y")).where(
        F.col("y").isin(0, 1) & F.col("id").isNotNull()).distinct()
    # Ids are chosen before any text is read; at most ``sample`` short rows are broadcast.
    chosen = marked.where(~held_out("id")).withColumn("place", F.xxhash64("id")).orderBy("place", "id", "y").limit(sample)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text).alias("t")).join(F.broadcast(chosen), "id")
    found = common.map_rows(rows, "t", ["id", "y", "place"], "found binary",
                            lambda: lambda texts: [(buckets(t).tobytes(),) for t in texts])
    found = found.groupBy("place", "id", "y").agg(F.min("found").alias("found"))
    return common.written(found, "quality-train")


STATE_SCHEMA = "part int, leader binary, squares binary"


def mean_states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The mean of the states of each part, added up in the order of their shards."""
    found: dict[int, list] = {}
    for batch in batches:
        for part, _, *state in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            known = found.setdefault(part, [0, 0.0, 0.0])
            known[0] += 1
            known[1:] = [total + np.frombuffer(one) for total, one in zip(known[1:], state, strict=True)]
    for part, (n, *totals) in found.items():
        leader, squares = ((total / n).tobytes() for total in totals)
        yield pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int32()), pa.array([leader], pa.binary()), pa.array([squares], pa.binary())],
            names=["part", "leader", "squares"])


def learn(rows: DataFrame, passes: int = PASSES) -> np.ndarray:
    """Weights of all buckets."""
    context, size = rows.sparkSession.sparkContext, rows.count()
    if not size:
        return np.zeros(BUCKETS)
    shards = -(-size // SHARD_ROWS)
    # Dealt once and kept; what a lost executor held is dealt again from the written rows. A shard lies in one partition.
    dealt = rows.select(F.pmod(F.xxhash64("place", "id"), F.lit(shards)).alias("shard"), "place", "y", "found").repartition(
        shards, "shard").sortWithinPartitions("shard", "place", "y", "found").select("shard", "y", "found").persist(
        StorageLevel.MEMORY_AND_DISK)
    state = Learner()
    for _ in range(passes):
        sent = context.broadcast((state.leader, state.squares))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            shard, learner = None, None

            def out() -> pa.RecordBatch:
                return pa.RecordBatch.from_arrays(
                    [pa.array(range(PARTS), pa.int32()), pa.array([shard] * PARTS, pa.int64()),
                     pa.array([part.tobytes() for part in np.split(learner.leader, PARTS)], pa.binary()),
                     pa.array([part.tobytes() for part in np.split(learner.squares, PARTS)], pa.binary())],
                    names=["part", "shard", "leader", "squares"])

            for batch in batches:
                for key, y, found in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if learner is None or key != shard:
                        if learner is not None:
                            yield out()
                        shard, learner = key, Learner(*sent.value)
                    learner.learn(np.frombuffer(found, np.int32), y)
            if learner is not None:
                yield out()

        states = dealt.mapInArrow(run, "part int, shard long, leader binary, squares binary").repartitionById(
            PARTS, "part").sortWithinPartitions("part", "shard").mapInArrow(mean_states, STATE_SCHEMA).collect()
        states.sort(key=lambda r: r.part)
        state = Learner(np.concatenate([np.frombuffer(r.leader) for r in states]),
                        np.concatenate([np.frombuffer(r.squares) for r in states]))
        sent.unpersist()
    dealt.unpersist()
    return state.weights()


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "quality",
            keep: list[str] | None = None, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """Per row: id (and ``keep``), held_out, score, predicted."""
    keep = list(dict.fromkeys([id_col, *(keep or [])]))
    weights = docs.sparkSession.sparkContext.broadcast(
        learn(training_rows(docs, labels, id_col, text, label, sample)))

    def scorer():
        w = weights.value

        def work(texts: list) -> list[tuple]:
            scores = []
            for t in texts:
                found = buckets(t)
                scores.append(chance(w[0] + float(w[found].sum()) / max(1, len(found)) ** 0.5))
            return [(s, int(s >= threshold)) for s in scores]

        return work

    source = docs.select(*keep, F.col(text).alias("_text"))
    scored = common.map_rows(source, "_text", keep, "_score double, _predicted int", scorer)
    return scored.select(*keep, held_out(id_col).alias("held_out"), F.col("_score").alias("score"),
                         F.col("_predicted").alias("predicted"))


def op12_leader_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality(common.table(spark, folder, "documents"), common.table(spark, folder, "labels"))

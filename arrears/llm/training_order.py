"""Operator 6: token ids in training order, in shards of fixed stride.

Pass one encodes every document once; each task cuts its stream of ids (documents one after the other, each with its
end id) into sequences of ``size`` ids and writes them numbered inside the task; its last sequence is padded. The
tasks' counts give by prefix sum a global number for every sequence. A keyed Feistel network over the next even power
of two, walked until it falls inside the number of sequences, permutes the numbers: slot = place in training order.
Pass two deals the sequences by ranges of shards, sorts by slot and writes one record per shard: ``data`` holds the
shard's sequences, each ``size * width`` bytes, so that slot s lies in shard ``s // per_shard`` at byte
``s % per_shard * size * width``. A reader resumes at any slot with one filtered read.

No table of the permutation is kept: it is computed from the key, and so is its inverse (``sequence_of``). Null texts
are a single end id; repeated rows and null ids are encoded like any other; no documents give no shard.
"""

from __future__ import annotations

import sys
from array import array
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrears.llm import common, tokens

END_ID, PAD_ID, ROUNDS = 1, 0, 6


def _round(half: np.ndarray, key: int, number: int, bits: int) -> np.ndarray:
    x = half + np.uint64((key * 0x9E3779B97F4A7C15 + number * 0xD1B54A32D192ED03) % (1 << 64))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return (x ^ (x >> np.uint64(31))) & np.uint64((1 << bits) - 1)


def permute(numbers: np.ndarray, n: int, key: int, inverse: bool = False) -> np.ndarray:
    """Slots of sequence numbers below ``n`` (or numbers of slots), by a Feistel network with cycle-walking."""
    bits = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    out, mask = np.array(numbers, np.uint64), np.uint64((1 << bits) - 1)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> np.uint64(bits), out[todo] & mask
        for k in reversed(range(ROUNDS)) if inverse else range(ROUNDS):
            if inverse:
                left, right = right ^ _round(left, key, k, bits), left
            else:
                left, right = right, left ^ _round(right, key, k, bits)
        out[todo] = (left << np.uint64(bits)) | right
        todo = todo[out[todo] >= np.uint64(n)]
    return out.astype(np.int64)


def sequence_of(slots: np.ndarray, n: int, key: int) -> np.ndarray:
    return permute(slots, n, key, inverse=True)


def _bytes(ids: list[int], end_id: int, width: int) -> bytes:
    """The ids and the end id as little-endian integers."""
    got = array({1: "B", 2: "H", 4: "I", 8: "Q"}[width], ids)
    got.append(end_id)
    if sys.byteorder == "big":
        got.byteswap()
    return got.tobytes()


def sequences(docs: DataFrame, text: str, path: str, size: int, end_id: int, width: int) -> DataFrame:
    """Written table: part, k (number inside the task), ids (size * width bytes)."""
    kind, ranked = f"<u{width}", tokens.by_rank(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, k, stride = TaskContext.get().partitionId(), 0, size * width
        encoder, rest = tokens.Encoder(path, ranked), b""

        def batch(rows: list[bytes]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([part] * len(rows), pa.int32()), pa.array(range(k, k + len(rows)), pa.int64()),
                 pa.array(rows, pa.binary())], names=["part", "k", "ids"])

        for whole in batches:
            for at in range(0, whole.num_rows, common.ROWS_AT_ONCE):
                texts = whole.slice(at, common.ROWS_AT_ONCE).column(0).to_pylist()
                rest = b"".join([rest, *(_bytes(encoder.ids(t) if t else [], end_id, width) for t in texts)])
                whole_ones = len(rest) // stride
                if whole_ones:
                    yield batch([rest[i * stride:(i + 1) * stride] for i in range(whole_ones)])
                    k, rest = k + whole_ones, rest[whole_ones * stride:]
        if rest:
            yield batch([rest + np.full((stride - len(rest)) // width, PAD_ID, kind).tobytes()])

    return common.written(docs.select(text).mapInArrow(run, "part int, k long, ids binary"), "order-sequences")


def materialise(docs: DataFrame, text: str = "text", path: str | None = None, size: int = 2048, key: int = 20_240_501,
                per_shard: int = 256, end_id: int = END_ID, width: int = 2) -> DataFrame:
    """The written shards: shard, first_slot, n, data. ``width`` is the bytes of an id."""
    path, spark = path or tokens.vocabulary(), docs.sparkSession
    if tokens.library(path).get_vocab_size() > 1 << (8 * width):
        raise ValueError("an id does not fit its width")
    cut = sequences(docs, text, path, size, end_id, width)
    # One number per task that has written sequences.
    counts = cut.groupBy("part").agg(F.count("*").alias("n")).orderBy("part").collect()
    total = sum(r.n for r in counts)
    base = spark.sparkContext.broadcast(dict(zip(
        [r.part for r in counts], accumulate([0, *(r.n for r in counts)]), strict=False)))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            numbers = [base.value[p] + k for p, k in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)]
            slots = permute(np.array(numbers, np.int64), total, key)
            yield pa.RecordBatch.from_arrays(
                [pa.array(slots // per_shard), pa.array(slots), b.column(2)], names=["shard", "slot", "ids"])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, first, rows = None, 0, []

        def record() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int64()), pa.array([first], pa.int64()), pa.array([len(rows)], pa.int64()),
                 pa.array([b"".join(rows)], pa.binary())], names=["shard", "first_slot", "n", "data"])

        for b in batches:
            for s, slot, ids in zip(*(b.column(c).to_pylist() for c in range(3)), strict=True):
                if s != shard:
                    if rows:
                        yield record()
                    shard, first, rows = s, slot, []
                rows.append(ids)
        if rows:
            yield record()

    placed = cut.select("part", "k", "ids").mapInArrow(place, "shard long, slot long, ids binary")
    return common.written(
        placed.repartitionByRange("shard").sortWithinPartitions("slot").mapInArrow(
            write, "shard long, first_slot long, n long, data binary"), "order-shards")


def read_from(shards: DataFrame, slot: int = 0, size: int = 2048, per_shard: int = 256, width: int = 2) -> DataFrame:
    """slot, shard, byte_offset, ids of all sequences from ``slot`` on; earlier shards are not read."""
    stride = size * width
    # The shard's bytes are bound once, as an array of one: a column read inside the inner lambda is copied for each slot.
    slots = F.transform(F.array("data"), lambda data: F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("n") - 1), lambda k: F.struct(
            (F.col("first_slot") + k).alias("slot"), (k * stride).alias("byte_offset"),
            F.substring(data, (k * stride + 1).cast("int"), F.lit(stride)).alias("ids"))))
    rows = shards.where(F.col("shard") >= slot // per_shard).select("shard", F.explode(F.get(slots, F.lit(0))).alias("s"))
    return rows.select("s.slot", "shard", "s.byte_offset", "s.ids").where(F.col("slot") >= slot)


def op6_training_order(spark: SparkSession, folder: str) -> DataFrame:
    return read_from(materialise(common.table(spark, folder, "documents"))).select(
        "slot", "shard", "byte_offset", F.crc32("ids").alias("ids_crc32"))

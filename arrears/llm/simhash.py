"""Operator 7: SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints are bit-wise majorities of the XXH64 values of a document's word shingles. Equal fingerprints are one
class, whatever the number of documents behind them. Classes are searched as follows:

1. Bits that tend to agree (correlation of the bits over all classes) are put into the same group, so that groups
   are as independent of one another as possible.
2. Group i gets a threshold t_i of at least -1 (not probed) with sum(t_i + 1) = distance + 1: two fingerprints within
   the distance then differ by at most t_i bits in some group. Dynamic programming picks the widths and thresholds
   with the least estimated work: probes plus candidate pairs, both estimated from counts over all classes.
3. Each class is probed by every value within t_i bits of its own in group i; candidates are verified on all 64 bits
   inside the join, so only true links leave it.

A row with null text has no words and fingerprint zero, linked like any other; repeated rows and equal texts share a
class; a null id is a row of its own class but never names a component unless the whole component has null ids.
"""

from __future__ import annotations

import re
from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrears.llm import common
from arrears.llm.components import components

WORDS = re.compile(r"[^ \t-\r]+")
SEED, SHINGLE, DISTANCE, BITS = 42, 3, 2, 64
LOWER = str.maketrans({c: chr(c + 32) for c in range(65, 91)})
#: Hashes counted at once; a long text is added up in blocks of this size.
BLOCK = 1 << 14
#: Cost of one probe row in candidate pairs: a probe is shuffled, a candidate only compared.
PROBE_COST = 20.0


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint as a signed long; zero for a text without words."""
    words = WORDS.findall(text.translate(LOWER)) if text else []
    if not words:
        return 0
    if len(words) < shingle:
        hashes = iter([xxhash.xxh64_intdigest(" ".join(words), SEED)])
        n = 1
    else:
        hashes = map(xxhash.xxh64_intdigest, map(" ".join, zip(*(words[k:] for k in range(shingle)), strict=False)),
                     iter(lambda: SEED, None))
        n = len(words) - shingle + 1
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, BLOCK):
        block = np.fromiter(hashes, "<u8", min(BLOCK, n - at))
        ones += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<i8")[0])


def bit_agreement(classes: DataFrame) -> tuple[int, np.ndarray]:
    """Number of classes, and how many of them have bits i and j both set, over all classes (64 x 64 counts)."""

    def run(batches):
        import pyarrow as pa

        total, n = np.zeros((BITS, BITS)), 0
        for b in batches:
            values = b.column(0).to_numpy(zero_copy_only=False).astype("<i8")
            for at in range(0, len(values), BLOCK):
                bits = np.unpackbits(values[at:at + BLOCK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                total += bits.T.astype(np.float64) @ bits
                n += len(bits)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(BITS * BITS + 1), pa.int32()), pa.array([*total.ravel(), n], pa.float64())], ["k", "n"])

    rows = classes.select("fp").mapInArrow(run, "k int, n double").groupBy("k").agg(F.sum("n").alias("n")).collect()
    flat = np.zeros(BITS * BITS + 1)
    for r in rows:
        flat[r.k] = r.n
    return int(flat[-1]), flat[:-1].reshape(BITS, BITS)


def order_bits(n: int, both: np.ndarray) -> tuple[list[int], np.ndarray]:
    """Bits chained so that each stands beside the one it is most correlated with, and their chance to agree."""
    p = np.diag(both) / max(n, 1)
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    corr = np.abs((both / max(n, 1) - np.outer(p, p)) / np.outer(sd, sd))
    left, chain = set(range(1, BITS)), [0]
    while left:
        chain.append(max(left, key=lambda b: (corr[chain[-1], b], -b)))
        left.remove(chain[-1])
    return chain, (p * p + (1 - p) * (1 - p))[chain]


def allocate(n: int, agree: np.ndarray, distance: int = DISTANCE) -> list[tuple[int, int, int]]:
    """Groups (first bit, end, threshold) in chain order with the least estimated cost; thresholds from -1."""

    def cost(a: int, b: int, t: int) -> float:
        if t < 0:
            return 0.0
        same = np.prod(agree[a:b])
        ratio = np.array([1.0, *np.zeros(t)])
        for q in agree[a:b]:  # chance of k differing bits, relative to none
            ratio[1:] += ratio[:-1] * (1 - q) / max(q, 1e-9)
        probes = sum(len(list(combinations(range(b - a), k))) if k < 3 else np.inf for k in range(t + 1))
        return probes * n * PROBE_COST + same * ratio.sum() * n * n / 2

    budget, steps = distance + 1, range(0, BITS + 1, 4)
    best: dict[tuple[int, int], tuple[float, list]] = {(0, 0): (0.0, [])}
    for b in steps[1:]:
        for used in range(budget + 1):
            options = [
                (best[a, used - t - 1][0] + cost(a, b, t), [*best[a, used - t - 1][1], (a, b, t)])
                for a in range(0, b, 4) for t in range(-1, min(used, 3))
                if (a, used - t - 1) in best and (t < 0 or b - a >= 8)]
            if options:
                best[b, used] = min(options, key=lambda o: o[0])
    return [g for g in best[BITS, budget][1] if g[2] >= 0]


def links(classes: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """All pairs of classes (columns fp, node) whose fingerprints differ in at most ``distance`` bits: u, v."""
    n, both = bit_agreement(classes)
    chain, agree = order_bits(n, both)
    probes, stored = [], []
    for k, (a, b, t) in enumerate(allocate(n, agree, distance)):
        mask = sum(1 << bit for bit in chain[a:b])
        flips = [sum(1 << bit for bit in flip) for size in range(t + 1) for flip in combinations(chain[a:b], size)]
        signed = [f - (1 << 64) if f >> 63 else f for f in (mask, *flips)]
        key = F.col("fp").bitwiseAND(F.lit(signed[0]))
        stored.append(classes.select(F.lit(k).alias("g"), key.alias("key"), "fp", "node"))
        probes.append(classes.select(
            F.lit(k).alias("g"), "fp", "node", F.explode(F.array(*map(F.lit, signed[1:]))).alias("flip"))
            .select("g", key.bitwiseXOR(F.col("flip")).alias("key"), F.col("fp").alias("fp2"), F.col("node").alias("node2")))
    left, right = stored[0], probes[0]
    for x, y in zip(stored[1:], probes[1:], strict=True):
        left, right = left.union(x), right.union(y)
    near = (F.col("node") < F.col("node2")) & (F.bit_count(F.col("fp").bitwiseXOR(F.col("fp2"))) <= distance)
    return left.join(right, (left.g == right.g) & (left.key == right.key) & near).select(
        F.col("node").alias("u"), F.col("node2").alias("v")).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                    distance: int = DISTANCE, keep: list[str] | None = None) -> DataFrame:
    """Per row: id (and the columns ``keep``), fingerprint (16 hex digits), component_id, rid."""
    keep = list(dict.fromkeys([id_col, *(keep or [])]))
    if not 0 <= distance <= 2:
        raise ValueError("distance must be 0, 1 or 2")

    def factory():
        return lambda texts: [(fingerprint(t, shingle),) for t in texts]

    rows = common.written(
        common.map_rows(docs, text, keep, "fp long", factory, number=True).drop("part"), "simhash-rows")
    classes = common.written(
        rows.groupBy("fp").agg(F.min(id_col).alias("least"), F.min("rid").alias("node")), "simhash-classes")
    found = components(links(classes.select("fp", "node"), distance))
    roots = classes.join(found, "node", "left").withColumn("root", F.coalesce("root", "node"))
    names = roots.groupBy("root").agg(F.min("least").alias("component_id"))
    named = roots.select("fp", "root").join(names, "root").select("fp", "component_id", F.col("root"))
    return rows.join(named, "fp").select(
        *keep, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "rid", "root")


def op7_simhash_pigeonhole(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(common.table(spark, folder, "documents")).select("doc_id", "fingerprint", "component_id")

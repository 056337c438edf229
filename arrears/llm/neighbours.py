"""Operator 8: approximate nearest neighbours by low-dimensional stable projections in kd-trees.

Vectors are projected to ``dims`` dimensions by Gaussian (2-stable) directions: the squared projected distance of a
pair, divided by its squared distance, follows a chi-square law. Rows are dealt by hash into blocks, each block holds
a kd-tree over its projections, and a query visits leaves in the order of projected distance, verifies the vectors
there in double precision, and stops when the chi-square test says that a point not yet visited beats the k-th best
found with a chance below ``1 - sure``. Equal vectors of a block are one point of its tree, with all their ids, and the
test allows for the rounding of the projections, so that copies at one distance are found together and the smallest
ids among them are kept.

Queries are sent in blocks of at most ``query_block`` rows, so a broadcast is bounded; every block of rows is read
once per block of queries, and each pair of blocks gives k rows per query. Vectors that are null, zero, or hold nulls
or non-finite components take no part. Vectors of another length than the query's are not its candidates. A null id
takes no part. Repeated rows are candidates each; a query's own id never is. An empty table gives no row.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from arrears.llm import common

DIMS, LEAF, SURE, SEED = 8, 32, 0.98, 11


def chi_square_cdf(x: float, dims: int) -> float:
    """Chance that a chi-square variable of an even number of degrees is at most ``x``."""
    half, term, total = x / 2, 1.0, 0.0
    for k in range(dims // 2):
        total += term
        term *= half / (k + 1)
    return 1 - float(np.exp(-half)) * total


def chi_square_quantile(p: float, dims: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square_cdf(mid, dims) < p else (low, mid)
    return high


class KdTree:
    """Median splits on the widest axis down to leaves; ``visit`` yields leaves by distance of their boxes."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.points, self.nodes = points, []
        stack = [(np.arange(len(points)), None)]
        while stack:
            rows, parent = stack.pop()
            low, high = points[rows].min(0), points[rows].max(0)
            me = len(self.nodes)
            self.nodes.append([low, high, [], rows])
            if parent is not None:
                self.nodes[parent][2].append(me)
            axis = int(np.argmax(high - low))
            if len(rows) > leaf and high[axis] > low[axis]:
                order = rows[np.argsort(points[rows, axis], kind="stable")]
                stack += [(order[:len(rows) // 2], me), (order[len(rows) // 2:], me)]
                self.nodes[me][3] = None

    def visit(self, q: np.ndarray) -> Iterator[tuple[float, np.ndarray]]:
        def gap(k: int) -> float:
            low, high = self.nodes[k][0], self.nodes[k][1]
            d = np.maximum(np.maximum(low - q, q - high), 0)
            return float(d @ d)

        heap = [(gap(0), 0)]
        while heap:
            dist, k = heapq.heappop(heap)
            if self.nodes[k][3] is not None:
                yield dist, self.nodes[k][3]
            else:
                for child in self.nodes[k][2]:
                    heapq.heappush(heap, (gap(child), child))


def distinct_points(ids: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, list[list[int]]]:
    """The distinct vectors, and for each the ids of its rows in ascending order."""
    _, first, point = np.unique(vectors + 0.0, axis=0, return_index=True, return_inverse=True)
    point = point.reshape(-1)
    order = np.lexsort((ids, point))
    members = np.split(ids[order], np.flatnonzero(np.diff(point[order])) + 1)
    return vectors[first], [m.tolist() for m in members]


def rounding(q: np.ndarray, dims: int) -> float:
    """Most by which rounding moves the squared projected distance of two equal vectors."""
    return 4 * dims * len(q) ** 3 * float(np.finfo(float).eps) ** 2 * float(q @ q)


def search(members: list[list[int]], vectors: np.ndarray, tree: KdTree, own: int, q: np.ndarray,
           projected: np.ndarray, k: int, limit: float) -> list[tuple[float, int]]:
    """The k nearest found, as (distance, id). ``limit`` is the chi-square quantile of the stopping test."""
    best: list[tuple[float, int]] = []
    slack = rounding(q, len(projected))
    for gap, points in tree.visit(projected):
        if len(best) == k and gap > limit * best[-1][0] ** 2 + slack:
            break
        d = np.sqrt(((vectors[points] - q) ** 2).sum(1))
        if len(best) == k:
            near = d <= best[-1][0]
            points, d = points[near], d[near]
        for p, distance in zip(points.tolist(), d.tolist(), strict=True):
            best += [(distance, i) for i in islice((i for i in members[p] if i != own), k)]
        best = sorted(best)[:k]
    return best


def usable(df: DataFrame, id_col: str, vector: str) -> DataFrame:
    good = F.col(id_col).isNotNull() & F.col(vector).isNotNull() & F.coalesce(F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
    return df.select(F.col(id_col).alias("vec_id"), F.col(vector).cast("array<double>").alias("v")).where(
        good & F.exists("v", lambda x: x != 0))


def block_search(sent, k: int, dims: int, limit: float):
    """The search of one block of rows for all queries that were sent."""

    def search_block(frame: pd.DataFrame) -> pd.DataFrame:
        vectors, members = distinct_points(frame["vec_id"].to_numpy(), np.stack(frame["v"].to_list()))
        directions = np.random.default_rng(SEED).standard_normal((vectors.shape[1], dims))
        tree, out = KdTree(vectors @ directions), []
        for own, q in sent.value:
            if len(q) == vectors.shape[1]:
                found = search(members, vectors, tree, own, q, q @ directions, k, limit)
                out += [(own, i, d) for d, i in found]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    return search_block


def nearest(rows: DataFrame, queries: DataFrame, id_col: str = "vec_id", vector: str = "embedding", k: int = 10,
            dims: int = DIMS, sure: float = SURE, block_rows: int = 4096, query_block: int = 4096) -> DataFrame:
    """query_id, rank, vec_id, score (Euclidean distance), for every usable row of ``queries``."""
    spark = rows.sparkSession
    rows = common.written(usable(rows, id_col, vector).withColumn("size", F.size("v")), "neighbours-rows")
    asked = common.written(usable(queries, id_col, vector).withColumn("size", F.size("v")).distinct(),
                           "neighbours-queries")
    limit = chi_square_quantile(sure, dims)
    blocks = max(1, -(-rows.count() // block_rows))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.lit(blocks)))
    dealt = common.written(dealt.repartition(blocks, "block", "size"), "neighbours-blocks") if blocks > 1 else dealt
    parts = max(1, -(-asked.count() // query_block))
    found = None
    for part in range(parts):
        mine = asked.where(F.pmod(F.xxhash64("vec_id", "v"), F.lit(parts)) == part).collect()
        sent = spark.sparkContext.broadcast([(r.vec_id, np.array(r.v)) for r in mine])

        got = common.written(dealt.groupBy("block", "size").applyInPandas(
            block_search(sent, k, dims, limit), "query_id long, vec_id long, score double"), "neighbours-found")
        found = got if found is None else found.union(got)
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def op8_stable_projections(spark: SparkSession, folder: str) -> DataFrame:
    rows = common.table(spark, folder, "embeddings")
    return nearest(rows, rows.where("vec_id % 100 = 0"))

"""Operator 3: concatenate and cut.

Pass one encodes every document once and writes ids with each row's running start inside its task. The tasks' totals
(one number per task) give by prefix sum the global start of each task. Pass two cuts the stream into windows of
``size`` ids: a document that crosses a boundary yields a record on each side of it. No row is moved between tasks.

Null and empty texts are one end id. Repeated rows and null document ids are packed like any other row. The last
sequence alone can be short; ``pad_to`` gives its stored length.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arrears.llm import common, tokens

END_ID = 1


def encoded(docs: DataFrame, id_col: str = "doc_id", text: str = "text", path: str | None = None,
            end_id: int = END_ID) -> DataFrame:
    """Written table: id, ids (binary, 4 bytes each, end id last), n, part, rid, local (ids before it in its task)."""
    path = path or tokens.vocabulary()
    ranked = tokens.by_rank(path)

    def factory():
        encoder, at = tokens.Encoder(path, ranked), 0

        def work(texts: list) -> list[tuple]:
            nonlocal at
            rows = []
            for t in texts:
                ids = tokens.packed([*(encoder.ids(t) if t else ()), end_id])
                rows.append((ids, len(ids) // 4, at))
                at += len(ids) // 4
            return rows

        return work

    return common.written(
        common.map_rows(docs, text, [id_col], "ids binary, n long, local long", factory, number=True), "packing-ids")


def global_starts(ids: DataFrame) -> DataFrame:
    """``ids`` with ``begin``, the global position of each row's first id."""
    totals = ids.groupBy("part").agg(F.max(F.col("local") + F.col("n")).alias("total")).orderBy("part").collect()
    before = [0, *accumulate(r.total for r in totals)]
    starts = ids.sparkSession.createDataFrame(
        [(r.part, b) for r, b in zip(totals, before, strict=False)], "part int, base long")
    # One row per task that has written ids, whatever the number of documents.
    return ids.join(F.broadcast(starts), "part").withColumn("begin", F.col("base") + F.col("local")).drop("base")


def cut(placed: DataFrame, id_col: str, size: int, with_ids: bool = False) -> DataFrame:
    """One row per piece. ``ids`` stays whole until its pieces have been cut in place."""
    first, last = F.floor(F.col("begin") / size), F.floor((F.col("begin") + F.col("n") - 1) / size)

    def piece(k: Column) -> Column:
        start = F.greatest(F.col("begin"), k * size)
        end = F.least(F.col("begin") + F.col("n"), (k + 1) * size)
        ids = F.substring(F.col("ids"), ((start - F.col("begin")) * 4 + 1).cast("int"), ((end - start) * 4).cast("int"))
        return F.struct(
            (start - F.col("begin")).alias("start"), (end - start).alias("length"), F.crc32(ids).alias("ids_crc32"),
            F.col("n").alias("doc_tokens"), k.alias("sequence_id"), (start - k * size).alias("offset"),
            *([ids.alias("piece_ids")] if with_ids else []))

    return placed.select(id_col, F.explode(F.transform(F.sequence(first, last), piece)).alias("p")).select(
        id_col, "p.*")


def pack(docs: DataFrame, id_col: str = "doc_id", text: str = "text", path: str | None = None, size: int = 2048,
         end_id: int = END_ID) -> DataFrame:
    """Per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    return cut(global_starts(encoded(docs, id_col, text, path, end_id)), id_col, size)


def pad_to(length: int, size: int = 2048) -> int:
    """Stored length of a sequence: a power of two stays as it is, any other is padded to ``size``."""
    return length if length & (length - 1) == 0 else size


def op3_concat_cut(spark: SparkSession, folder: str) -> DataFrame:
    return pack(common.table(spark, folder, "documents"))

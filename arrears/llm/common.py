"""Shared helpers: whole texts through Arrow batches, and written intermediate tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from arrears.shared import shared_dir

#: Rows handled at once inside an Arrow batch; bounds what a worker holds beside the batch itself.
ROWS_AT_ONCE = 512


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str, free: bool = False) -> DataFrame:
    """``df`` written to the shared folder (zstd) and read back; cuts lineage and fixes row order and task ids.

    With ``free`` Spark removes the shuffle files of the write at its end, not when the driver next collects garbage.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(FREE_SHUFFLES, "false")
    spark.conf.set(FREE_SHUFFLES, "true" if free else before)
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(FREE_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)


def map_rows(
    df: DataFrame, text: str, keep: list[str], out: str, factory: Callable[[], Callable[[list], list[tuple]]],
    number: bool = False,
) -> DataFrame:
    """Columns ``keep`` of ``df`` and the columns ``out`` (DDL) that the function made by ``factory`` gives per text.

    ``factory`` is called once per task. With ``number`` the rows also get ``part`` (task number) and ``rid`` (unique
    in the whole result); write the result before using them, as a retried task may number its rows anew.
    """
    made = T._parse_datatype_string(out)
    extra = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("rid", T.LongType())] if number else [])
    source = df.select(*dict.fromkeys([*keep, text]))
    schema = T.StructType([*(source.schema[c] for c in keep), *made.fields, *extra.fields])
    made_types = [f.type for f in to_arrow_schema(made)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work, part, seen = factory(), TaskContext.get().partitionId(), 0
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(at, ROWS_AT_ONCE)
                n = batch.num_rows
                rows = work(batch.column(batch.schema.get_field_index(text)).to_pylist())
                columns = list(zip(*rows, strict=True))
                arrays = [batch.column(batch.schema.get_field_index(c)) for c in keep]
                arrays += [pa.array(c, type=t) for c, t in zip(columns, made_types, strict=True)]
                if number:
                    arrays += [pa.array([part] * n, pa.int32()),
                               pa.array(range((part << 33) + seen, (part << 33) + seen + n), pa.int64())]
                seen += n
                yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return source.mapInArrow(run, schema)


def summarise(df: DataFrame, text: str, out: str, factory: Callable[[], tuple[Callable, Callable]]) -> DataFrame:
    """Rows (``out``, DDL) that each task gives once, at its end: ``factory`` makes (add texts, rows at the end)."""
    schema = T._parse_datatype_string(out)
    types = [f.type for f in to_arrow_schema(schema)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        add, end = factory()
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_AT_ONCE):
                add(whole.slice(at, ROWS_AT_ONCE).column(0).to_pylist())
        rows = end()
        if rows:
            arrays = [pa.array(c, type=t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return df.select(text).mapInArrow(run, schema)

"""Written intermediate tables in the folder the cluster shares.

``settle`` is the one way this package cuts lineage. It writes a DataFrame as Parquet under
``spark.checkpoint.dir`` and reads it back, which gives three things at once:

* a lost executor costs only the tasks it ran, never a replay of the whole plan;
* a table used by several later steps is computed once, and each step reads only its columns;
* the planner knows the true size of the table, so a join broadcasts it when it is below
  ``spark.sql.autoBroadcastJoinThreshold`` and sort-merges otherwise. No broadcast is forced by a hint.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

OPEN_FILES = 8  # of a task; a task with more values sorts its remaining rows

_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder for written intermediate tables: ``spark.checkpoint.dir``, or a scratch folder in local mode."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        context = spark.sparkContext
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        app = context.applicationId
        if app not in _local_dirs:
            _local_dirs[app] = tempfile.mkdtemp(prefix="arrears-")
        named = _local_dirs[app]
    return f"{named.rstrip('/')}/arrears-{spark.sparkContext.applicationId}"


@contextmanager
def _open_files(spark: SparkSession) -> Iterator[None]:
    """A partitioned write keeps a file open for each of a few values, instead of sorting all rows by them."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, max(int(before), OPEN_FILES))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def settle(df: DataFrame, name: str = "step", partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and return the written table."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if partition_by:
        with _open_files(spark):
            df.write.partitionBy(*partition_by).parquet(path)
    else:
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)

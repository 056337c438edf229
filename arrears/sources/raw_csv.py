"""Loan records from CSV: every field is text, short rows are padded, long rows are rejected and counted."""

from __future__ import annotations

import csv

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arrears.shared import settle
from arrears.sources.tables import replace_table

MAX_BAD_RECORDS = 1000
_EXTRA, _RAW = "__extra", "_corrupt_record"


class TooManyBadRecords(ValueError):
    """More rejected rows than the load tolerates."""


def header_names(spark: SparkSession, path: str) -> list[str]:
    """Trimmed column names from the first line."""
    first = spark.read.text(path).first()
    return [name.strip() for name in next(csv.reader([first[0]]))] if first else []


def read_raw_csv(spark: SparkSession, path: str, quoted_newlines: bool = True) -> DataFrame:
    """Rows of the file as text columns plus ``is_bad`` for rows with more fields than the header.

    The parser is given one column more than the header. A row that fits, or is short, then leaves that column empty
    and is reported as incomplete; a long row fills it or is complete. With ``quoted_newlines`` a file cannot be
    split between tasks, so a large load should arrive as many files.
    """
    names = header_names(spark, path)
    schema = T.StructType([T.StructField(name, T.StringType()) for name in [*names, _EXTRA, _RAW]])
    parsed = (
        spark.read.schema(schema)
        .option("header", True).option("multiLine", quoted_newlines).option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", _RAW).option("columnPruning", False)
        .option("escape", '"')
        .csv(path)
    )
    fits = F.col(_EXTRA).isNull() & F.col(_RAW).isNotNull()
    return parsed.select(*names, (~fits).alias("is_bad"))


def load_raw_csv(
    spark: SparkSession, path: str, target: str, max_bad_records: int = MAX_BAD_RECORDS, quoted_newlines: bool = True,
) -> DataFrame:
    """Replace the raw table with the accepted rows; leave it untouched when too many rows are rejected.

    The rejects are counted while the rows are written, so the file is read once.
    """
    counted = Observation("raw csv")
    parsed = read_raw_csv(spark, path, quoted_newlines).observe(counted, F.count_if(F.col("is_bad")).alias("bad"))
    accepted = settle(parsed.where(~F.col("is_bad")).drop("is_bad"), "raw-csv")
    bad = counted.get["bad"]
    if bad > max_bad_records:
        raise TooManyBadRecords(f"{bad} rows have more fields than the header (limit {max_bad_records})")
    return replace_table(accepted, target)


def read_csv_split(spark: SparkSession, path: str, split: str) -> DataFrame:
    """CSV rows as text, filtered by ``split`` only when the file has that column."""
    rows = read_raw_csv(spark, path).where(~F.col("is_bad")).drop("is_bad")
    return rows.where(F.col("split") == split) if "split" in rows.columns else rows

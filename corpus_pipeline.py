"""From raw documents to packed training sequences, stage by stage; each stage's result is written as Parquet.

Rows travel through the operators as one column ``row`` (a struct of all columns), so that columns of the documents
never clash with those an operator makes.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arrears.llm import common, decontaminate, packing, pii, simhash
from arrears.llm import toxicity as toxic
from arrears.shared import shared_dir


def _packed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", F.struct(*docs.columns).alias("row"))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go."""
    scored = toxic.toxicity(_packed(docs), common.table(spark, sf_dir, "labels"), keep=["row"])
    return scored.where("predicted = 0").select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component the row with the least id stays (a null id comes last; among equals the first row read)."""
    found = simhash.near_duplicates(_packed(docs), keep=["row"])
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("rid"))
    stays = found.groupBy("root").agg(F.min(order).getField("rid").alias("rid"))
    return found.join(stays.select("rid"), "rid", "left_semi").select("row.*")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go; others stay as they are."""
    found = decontaminate.contamination(_packed(docs), common.table(spark, sf_dir, "benchmark"), keep=["row"])
    return found.where("not contaminated").select("row.*")


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every span of personal data becomes its kind in angle brackets; no document goes."""
    found = pii.extract(_packed(docs), keep=["row"])
    spans = F.array_sort(F.transform(F.concat("base", "added"), lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    return found.withColumn("text", _redacted(F.col("row.text"), spans)).select(
        *[F.col("text") if c == "text" else F.col("row")[c].alias(c) for c in docs.columns])


def _redacted(text: Column, spans: Column) -> Column:
    """Text before each stretch of spans, its kind, and the text behind the last; overlapping spans are one stretch."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))

    def step(done: Column, s: Column) -> Column:
        before = F.substring(text, (done["at"] + 1).cast("int"), (s["start"] - done["at"]).cast("int"))
        new = F.concat(done["out"], before, F.lit("<"), s["kind"], F.lit(">"))
        return F.struct(F.when(s["start"] >= done["at"], new).otherwise(done["out"]).alias("out"),
                        F.greatest(done["at"], s["end"]).alias("at"))

    rest = F.aggregate(spans, start, step, lambda done: F.concat(
        done["out"], F.substring(text, (done["at"] + 1).cast("int"), F.length(text))))
    return F.when(F.size(spans) == 0, text).otherwise(rest)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs.select("doc_id", "text"))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("pii", redact_personal_data),
    ("packing", pack_sequences),
]

#: Fitted scores, XXH64 and the tokeniser have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs

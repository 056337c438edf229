"""Operator 10: benchmark decontamination by a generalised suffix automaton.

The automaton of the normalised benchmark items is built from their words, broadcast, and fed the words of every
document; no document is shuffled. Its size is proportional to the benchmark, which is counted first: beyond
``SHARD_WORDS`` words the items are split by hash into shards, documents pass one shard after the other, and spans
and items found are united.

Null texts have no words. Repeated documents, and null document ids, give a row each. Items without words match
nothing; items that share an id count once; an item without an id counts under the empty id. An empty benchmark hits
nothing.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arrears.llm import common
from arrears.llm.automaton import WindowMatcher

WINDOW = 13
WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({c: chr(c + 32) for c in range(65, 91)})
#: Words of benchmark items in one automaton; about 100 MB in a worker.
SHARD_WORDS = 100_000


def words_of(text: str | None) -> list[str]:
    return WORDS.findall(text.translate(LOWER)) if text else []


def find_windows(docs: DataFrame, items: DataFrame, keep: list[str], text: str = "text", item_id: str = "item_id",
                 window: int = WINDOW, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``keep``, n_words, spans (hit words, merged within a shard, end exclusive), items (ids as text, sorted)."""
    spark = docs.sparkSession
    named = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("id"), F.col(text).alias("words"))
    total = common.summarise(named, "words", "n long", _word_total).agg(F.sum("n")).first()[0] or 0
    shards = -(-total // shard_words) or 1
    found = docs.withColumns({"__spans": F.expr("cast(array() as array<struct<start: long, end: long>>)"),
                              "__items": F.expr("cast(array() as array<string>)")})
    keep = list(dict.fromkeys(keep))
    for k in range(shards):
        part = named.where(F.pmod(F.xxhash64("id", "words"), F.lit(shards)) == k).distinct().collect()
        sent = spark.sparkContext.broadcast([(r.id, words_of(r.words)) for r in part])

        def factory(sent=sent):
            matcher = WindowMatcher(sent.value, window)

            def work(texts: list) -> list[tuple]:
                rows = [words_of(t) for t in texts]
                return [(len(r), [{"start": a, "end": b} for a, b in spans], ids)
                        for r, (spans, ids) in zip(rows, matcher.match(rows), strict=True)]

            return work

        found = common.map_rows(
            found, text, [*keep, *([text] if shards > 1 and text not in keep else []), "__spans", "__items"],
            "n_words long, spans array<struct<start: long, end: long>>, items array<string>", factory)
        found = found.withColumns({
            "__spans": F.concat("__spans", "spans"), "__items": F.array_distinct(F.concat("__items", "items"))})
        if shards > 1:
            found = common.written(found, "decontaminate-shard")
        found = found.drop("spans", "items")
        if k < shards - 1:
            found = found.drop("n_words")
    return found.select(*keep, "n_words", F.col("__spans").alias("spans"),
                        F.array_sort("__items").alias("items"))


def _word_total():
    total = 0

    def add(texts: list) -> None:
        nonlocal total
        total += sum(len(words_of(t)) for t in texts)

    return add, lambda: [(total,)]


def n_hit() -> Column:
    """Number of words in the spans; spans of different shards may overlap."""
    return F.size(F.array_distinct(F.flatten(F.transform(
        "spans", lambda s: F.sequence(s["start"], s["end"] - 1))))).cast("long")


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text: str = "text",
                  item_id: str = "item_id", keep: list[str] | None = None, min_share: int = 20,
                  shard_words: int = SHARD_WORDS) -> DataFrame:
    """Per row: id (and ``keep``), n_words, n_hit, n_items, items_sha256, contaminated, spans.

    ``contaminated`` holds if at least one word in ``min_share`` is hit.
    """
    keep = list(dict.fromkeys([id_col, *(keep or [])]))
    found = find_windows(docs, items, keep, text, item_id, shard_words=shard_words).withColumn("n_hit", n_hit())
    return found.select(
        *keep, "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (min_share * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"), "spans")


def op10_suffix_automaton(spark: SparkSession, folder: str) -> DataFrame:
    return contamination(
        common.table(spark, folder, "documents"), common.table(spark, folder, "benchmark")).drop("spans")

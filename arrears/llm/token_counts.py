"""Operator 5: token counts by a map-side two-tier lookup.

Tier one is a hash table of the lengths of the most frequent units, broadcast; its size is bounded by ``table_size``
and ``longest`` whatever the input. Every task summarises the units of its own documents (all of them) and hands on
its ``per_task`` most frequent ones, so what is shuffled is a few thousand rows per task and never the units
themselves. Tier two, for misses, is a bounded cache in each worker before the library itself. The table only saves
time: counts are those of the library whatever it holds.

Null texts count as empty (0 bytes, 0 tokens); repeated rows and null ids give a row each; empty tables no row.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrears.llm import common, tokens

#: A task's counter is cut back to its commoner half beyond this many entries.
COUNTER_SIZE = 100_000


def frequent_units(docs: DataFrame, text: str = "text", table_size: int = 32_768, per_task: int = 2048,
                   longest: int = 32) -> list[str]:
    """The most frequent units of all documents by summaries of each task; at most ``table_size`` short strings."""

    def factory():
        seen: Counter = Counter()

        def add(texts: list) -> None:
            nonlocal seen
            for t in texts:
                seen.update(tokens.UNITS.findall(t) if t else ())
            if len(seen) > COUNTER_SIZE:
                seen = Counter(dict(short(COUNTER_SIZE // 2)))

        def short(most: int) -> list[tuple[str, int]]:
            return Counter({u: n for u, n in seen.items() if len(u) <= longest}).most_common(most)

        return add, lambda: short(per_task)

    summary = common.summarise(docs, text, "unit string, n long", factory)
    top = summary.groupBy("unit").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "unit").limit(table_size)
    return [r.unit for r in top.select("unit").collect()]


def token_counts(docs: DataFrame, id_col: str = "doc_id", text: str = "text", path: str | None = None,
                 limit: int = 512, table_size: int = 32_768) -> DataFrame:
    """Per row: id, n_bytes, n_tokens, over_limit."""
    path = path or tokens.vocabulary()
    ranked = tokens.by_rank(path)
    encoder = tokens.Encoder(path, ranked)
    frequent = {u: len(encoder.ids(u)) for u in frequent_units(docs, text, table_size) if not encoder.whole.search(u)}
    table = docs.sparkSession.sparkContext.broadcast(frequent)

    def factory():
        units = tokens.Units(path, ranked, table.value)
        return lambda texts: [
            (len((t or "").encode()), n, n > limit) for t in texts for n in [units.count(t or "")]]

    return common.map_rows(docs, text, [id_col], "n_bytes long, n_tokens long, over_limit boolean", factory)


def op5_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts(common.table(spark, folder, "documents"))

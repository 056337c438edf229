"""Connected components of a link table by alternating star steps, each written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrears.llm import common


def _stars(links: DataFrame, small: bool) -> DataFrame:
    """Large star: larger neighbours of ``u`` move to the least; small star: smaller neighbours do."""
    if not small:
        links = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = links.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    moved = links.join(least, "u")
    out = moved.where("v != m" if small else "v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    if small:
        out = out.union(least.select("u", F.col("m").alias("v")))
    return out.where("u != v").distinct()


def components(links: DataFrame) -> DataFrame:
    """``links`` has columns u, v (long). Gives (node, root): the least node reachable, for every linked node.

    Links are kept as (larger, smaller). Both star steps keep components and end in stars, after which nothing
    changes. Only a row count and a checksum of the links reach the driver.
    """
    links = common.written(
        links.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())

    before, now = None, mark(links)
    while before != now:
        links = common.written(_stars(_stars(links, False), True), "links")
        before, now = now, mark(links)
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())

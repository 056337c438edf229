"""Ranks, quantiles and running totals over groups of any size.

A rank depends on a row only through its value, so most ranks are computed on a histogram: one row per distinct value,
pre-aggregated before it is shuffled, however many rows share the value. A histogram that is too long for one task is
cut into value ranges; each range is summed on its own and shifted by the total of the ranges before it.

Where the order of single rows matters, ``number_rows`` range-partitions the rows by their full sort key and turns
Spark's per-partition row counter into a global position. No group is ever collected into one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arrears.shared import settle

ROWS_PER_TASK = 2_000_000
_COUNTER_BITS = 33  # monotonically_increasing_id keeps the row number within its partition in the low 33 bits


def histogram(df: DataFrame, groups: list[str], value: str, sums: list[str] | None = None) -> DataFrame:
    """Distinct values per group with their row count ``n`` and the sums of other columns, as a written table."""
    totals = [F.sum(name).alias(name) for name in sums or []]
    return settle(df.groupBy(*groups, value).agg(F.count(F.lit(1)).alias("n"), *totals), "histogram")


def _same(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    match = F.lit(True)
    for key in keys:
        match = match & left[key].eqNullSafe(right[key])
    return match


def cumulate(
    hist: DataFrame, groups: list[str], value: str, sums: list[str], descending: bool = False,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Add ``before_<s>`` (total of the values ahead) and ``total_<s>`` (total of the group) for each of ``sums``.

    ``hist`` must be a written table with one row per group and value.
    """
    order = F.desc(value) if descending else F.asc(value)
    everyone = Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(0))
    slices = -(-hist.count() // rows_per_task)
    if slices <= 1:
        ahead = everyone.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return hist.select(
            "*",
            *[F.coalesce(F.sum(s).over(ahead), F.lit(0)).alias(f"before_{s}") for s in sums],
            *[F.sum(s).over(everyone).alias(f"total_{s}") for s in sums])

    ranged = hist.repartitionByRange(slices, *groups, order).withColumn("_slice", F.spark_partition_id())
    ranged = settle(ranged, "ranges")
    parts = ranged.groupBy(*groups, "_slice").agg(*[F.sum(s).alias(f"_part_{s}") for s in sums])
    earlier = everyone.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    parts = settle(parts.select(
        *groups, "_slice",
        *[F.coalesce(F.sum(f"_part_{s}").over(earlier), F.lit(0)).alias(f"_ahead_{s}") for s in sums],
        *[F.sum(f"_part_{s}").over(everyone).alias(f"total_{s}") for s in sums]), "range-totals")
    inside = Window.partitionBy(*groups, "_slice").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.select("*", *[F.coalesce(F.sum(s).over(inside), F.lit(0)).alias(f"_in_{s}") for s in sums])
    joined = local.join(parts, _same(local, parts, [*groups, "_slice"]))
    return joined.select(
        *[local[name] for name in hist.columns],
        *[(F.col(f"_in_{s}") + F.col(f"_ahead_{s}")).alias(f"before_{s}") for s in sums],
        *[F.col(f"total_{s}") for s in sums])


def number_rows(df: DataFrame, groups: list[str], order: list[Column], name: str = "position") -> DataFrame:
    """Add the position of each row in its group (1 = first) and the group size ``<name>_of``.

    ``order`` must end in a unique column. The rows are shuffled once, by range, and written with their counter.
    """
    keys = [*[F.col(g) for g in groups], *order]
    ordered = settle(
        df.repartitionByRange(*keys).sortWithinPartitions(*keys)
        .withColumn("_at", F.monotonically_increasing_id()), "ordered")
    task = F.shiftright("_at", _COUNTER_BITS).alias("_task")
    everyone = Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(0))
    earlier = everyone.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    parts = ordered.groupBy(*groups, task).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    parts = settle(parts.select(
        *groups, "_task", "_first",
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_ahead"),
        F.sum("_rows").over(everyone).alias(f"{name}_of")), "task-totals")
    rows = ordered.withColumn("_task", F.shiftright("_at", _COUNTER_BITS))
    position = F.col("_at") - F.col("_first") + F.col("_ahead") + 1
    return rows.join(parts, _same(rows, parts, [*groups, "_task"])).select(
        *[rows[column] for column in df.columns], position.alias(name), F.col(f"{name}_of"))


def value_at(value: str, rank: Column) -> Column:
    """Value holding the 1-based ``rank``, picked while the cumulated histogram is aggregated by group."""
    return F.max(F.when((F.col("before_n") < rank) & (rank <= F.col("before_n") + F.col("n")), F.col(value)))


def discrete_quantiles(
    df: DataFrame, groups: list[str], value: str, shares: dict[str, float], rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Exact quantiles that are values of the data: ``{column name: share}``, one row per group."""
    cumulated = cumulate(histogram(df, groups, value), groups, value, ["n"], rows_per_task=rows_per_task)
    size = F.col("total_n")
    rank = {name: F.greatest(F.lit(1), size - F.floor(size - size * F.lit(q))) for name, q in shares.items()}
    return cumulated.groupBy(*groups).agg(*[value_at(value, rank[name]).alias(name) for name in shares])


def interpolated_quantiles(
    df: DataFrame, groups: list[str], value: str, shares: dict[str, float], rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Exact quantiles with linear interpolation between neighbours: ``{column name: share}``, one row per group."""
    cumulated = cumulate(histogram(df, groups, value), groups, value, ["n"], rows_per_task=rows_per_task)
    spot = {name: (F.col("total_n") - 1) * F.lit(q) for name, q in shares.items()}
    picked = cumulated.groupBy(*groups).agg(
        *[value_at(value, F.floor(at) + 1).alias(f"_lo_{name}") for name, at in spot.items()],
        *[value_at(value, F.ceil(at) + 1).alias(f"_hi_{name}") for name, at in spot.items()],
        *[F.max(at - F.floor(at)).alias(f"_t_{name}") for name, at in spot.items()])
    between = {
        name: F.col(f"_lo_{name}") + (F.col(f"_hi_{name}") - F.col(f"_lo_{name}")) * F.col(f"_t_{name}")
        for name in shares}
    return picked.select(*groups, *[column.alias(name) for name, column in between.items()])


def percent_rank_from(cumulated: DataFrame, name: str = "pct_rank") -> DataFrame:
    """Add the percent rank of each value: rows ahead over group size less one, 0 for a group of one."""
    others = F.col("total_n") - 1
    return cumulated.withColumn(name, F.coalesce(F.try_divide(F.col("before_n"), others), F.lit(0.0)))


def band_of(position: Column, size: Column, bands: int) -> Column:
    """Band of a row when ``size`` rows are dealt into ``bands`` equal runs, the first runs taking the remainder."""
    base, larger = F.floor(size / bands), size % bands
    in_larger = larger * (base + 1)
    return F.when(position <= in_larger, F.ceil(position / (base + 1))).otherwise(
        larger + F.ceil(F.try_divide(position - in_larger, base))).cast("bigint")


def spearman(df: DataFrame, groups: list[str], x: str, y: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Rank correlation of two columns with ties at their average rank, one row per group.

    Works on the joint histogram: rows that agree on both values count as one weighted point. Also returns the number
    of rows and of distinct values on each side.
    """
    joint = settle(df.groupBy(*groups, x, y).agg(F.count(F.lit(1)).alias("w")), "joint")

    def average_rank(value: str, out: str) -> DataFrame:
        margin = settle(joint.groupBy(*groups, value).agg(F.sum("w").alias("n")), "margin")
        ranked = cumulate(margin, groups, value, ["n"], rows_per_task=rows_per_task)
        # Centred on the middle rank, which keeps the sums of products small.
        rank = F.col("before_n") + (F.col("n") + 1) / 2 - (F.col("total_n") + 1) / 2
        return settle(ranked.select(*groups, value, rank.alias(out)), "average-rank")

    rank_x, rank_y = average_rank(x, "_rx"), average_rank(y, "_ry")
    w, rx, ry = F.col("w"), F.col("_rx"), F.col("_ry")
    sums = joint.join(rank_x, [*groups, x]).join(rank_y, [*groups, y]).groupBy(*groups).agg(
        F.sum("w").alias("rows"),
        F.try_divide(F.sum(w * rx * ry), F.sqrt(F.sum(w * rx * rx) * F.sum(w * ry * ry))).alias("rho"))
    distinct_x = rank_x.groupBy(*groups).agg(F.count(F.lit(1)).alias("distinct_x"))
    distinct_y = rank_y.groupBy(*groups).agg(F.count(F.lit(1)).alias("distinct_y"))
    return sums.join(distinct_x, groups).join(distinct_y, groups)

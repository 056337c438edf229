"""Run-stamped tables: latest run, newest model, upsert."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arrears.shared import settle


def latest_run(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of the newest run per key set. All rows of a run share one ``ts``.

    The newest timestamps are one row per key set. They are written first, so the join below broadcasts them at their
    true size. Their days, at most one per key set, are a literal filter, so that a table partitioned by ``run_date``
    opens only the days that hold a newest run.
    """
    newest = df.groupBy(*keys).agg(F.max("ts").alias("ts"))
    if "run_date" not in df.columns:
        newest = settle(newest, "newest-runs")
        return df.join(newest, newest.columns).select(*df.columns)
    newest = settle(newest.withColumn("run_date", F.to_date("ts")), "newest-runs")
    days = [r.run_date for r in newest.where("run_date IS NOT NULL").select("run_date").distinct().collect()]
    return df.where(F.col("run_date").isin(days)).join(newest, newest.columns).select(*df.columns)


def newest_model(df: DataFrame) -> Column:
    """Model version of the newest row, as a scalar usable in filters on other tables."""
    return df.agg(F.max_by("model_version", F.struct("ts", "model_version"))).scalar()


def newest_per_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """The newest row of each key; rows of equal age are settled by their content."""
    rest = [F.desc(name) for name in df.columns if name not in keys and name != "ts"]
    order = Window.partitionBy(*keys).orderBy(F.desc("ts"), *rest)
    return df.withColumn("_nth", F.row_number().over(order)).where("_nth = 1").drop("_nth")


def upsert(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """New snapshot of ``target``: rows matched by key are replaced, new rows added, all other rows kept.

    A key that occurs twice in ``source`` is an error. NULL keys match nothing.
    """
    source = settle(source, "upsert-source")
    repeated = source.dropna(subset=keys).groupBy(*keys).count().where("count > 1").limit(1).collect()
    if repeated:
        raise ValueError(f"more than one source row for {repeated[0].asDict()}")
    return target.join(source, keys, "left_anti").unionByName(source.select(*target.columns))

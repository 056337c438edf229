"""Threshold alerts on month-over-month changes of the stored drift tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arrears.constants import (
    ALERTS_SCHEMA, CATEGORICAL_SHARE_LIMITS, NUMERIC_MEAN_LIMITS, SCORE_P90_LIMITS, SCORED_SPLITS)
from arrears.functions.text import fixed, sentence
from arrears.operators.history import newest_model, newest_per_key
from arrears.operators.metrics import run_time

DIGITS = 6


def _current(drift: DataFrame, keys: list[str], model_version) -> DataFrame:
    """Newest row per month of the chosen model, monitored splits only."""
    version = newest_model(drift) if model_version is None else model_version
    rows = drift.where((F.col("model_version") == version) & F.col("split").isin(*SCORED_SPLITS))
    return newest_per_key(rows, keys)


def _raise(changes: DataFrame, run_ts: str, kind: str, entity: Column, value: Column,
           limits: tuple[float, float], details: Column) -> DataFrame:
    """Alert rows for changes at or above the warning limit."""
    warn, critical = limits
    severe = F.col("value") >= F.lit(critical)
    rows = changes.withColumn("value", value).withColumn("details", details).where(F.col("value") >= F.lit(warn))
    return rows.select(
        run_time(run_ts).alias("ts"), "model_version", "split", "issue_month", F.lit(kind).alias("alert_type"),
        entity.alias("entity"), "value",
        F.when(severe, F.lit(critical)).otherwise(F.lit(warn)).alias("threshold"),
        F.when(severe, F.lit("CRITICAL")).otherwise(F.lit("WARN")).alias("severity"),
        "details").select(*ALERTS_SCHEMA.names)


def alert_score_p90(
    score_drift: DataFrame, run_ts: str, model_version=None, limits: tuple[float, float] = SCORE_P90_LIMITS,
) -> DataFrame:
    """Absolute change of the 90th score percentile against the month before."""
    months = _current(score_drift, ["model_version", "split", "issue_month"], model_version)
    series = Window.partitionBy("model_version", "split").orderBy("issue_month")
    changes = months.withColumn("before", F.lag("p90").over(series))
    p90, before = F.col("p90"), F.col("before")
    return _raise(
        changes, run_ts, "score_drift_p90", F.lit("p90"), F.abs(p90 - before), limits,
        sentence("p90 moved from ", fixed(before, DIGITS), " to ", fixed(p90, DIGITS)))


def alert_numeric_mean(
    feature_drift: DataFrame, run_ts: str, model_version=None, limits: tuple[float, float] = NUMERIC_MEAN_LIMITS,
) -> DataFrame:
    """Change of a numeric input's mean relative to the month before; a month after a zero mean is not judged."""
    rows = feature_drift.where("feature_type = 'numeric'")
    months = _current(rows, ["model_version", "split", "issue_month", "feature_name"],
                      newest_model(feature_drift) if model_version is None else model_version)
    series = Window.partitionBy("model_version", "split", "feature_name").orderBy("issue_month")
    changes = months.withColumn("before", F.lag("mean").over(series))
    mean, before = F.col("mean"), F.col("before")
    moved = F.abs(mean - before)
    return _raise(
        changes, run_ts, "numeric_mean_drift", F.col("feature_name"), F.try_divide(moved, F.abs(before)), limits,
        sentence("mean moved from ", fixed(before, DIGITS), " to ", fixed(mean, DIGITS),
                 " (abs_delta=", fixed(moved, DIGITS), ")"))


def alert_categorical_share(
    feature_drift: DataFrame, run_ts: str, model_version=None, limits: tuple[float, float] = CATEGORICAL_SHARE_LIMITS,
) -> DataFrame:
    """Absolute change of the most common value's share against the month before."""
    rows = feature_drift.where("feature_type = 'categorical'")
    months = _current(rows, ["model_version", "split", "issue_month", "feature_name"],
                      newest_model(feature_drift) if model_version is None else model_version)
    series = Window.partitionBy("model_version", "split", "feature_name").orderBy("issue_month")
    changes = months.withColumns({
        "before": F.lag("top_category_share").over(series), "old_top": F.lag("top_category").over(series)})
    share, before = F.col("top_category_share"), F.col("before")
    return _raise(
        changes, run_ts, "categorical_share_drift", F.col("feature_name"), F.abs(share - before), limits,
        sentence("top_share moved from ", fixed(before, DIGITS), " to ", fixed(share, DIGITS), "; top_cat ",
                 F.coalesce(F.col("old_top"), F.lit("NULL")), " -> ", F.coalesce(F.col("top_category"), F.lit("NULL"))))

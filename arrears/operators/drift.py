"""Monthly drift of scores and model inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrears.constants import DRIFT_CATEGORICAL, DRIFT_NUMERIC, FEATURE_DRIFT_SCHEMA, SCORED_SPLITS
from arrears.functions.parse import month_key
from arrears.operators.history import latest_run, newest_model
from arrears.operators.metrics import RUN_KEYS, run_time
from arrears.operators.ranks import ROWS_PER_TASK, value_at, cumulate, histogram
from arrears.shared import settle

MONTH_KEYS = ["model_version", "split", "issue_month"]


def score_drift(
    predictions: DataFrame, run_ts: str, accuracy: int | None = None, rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Score distribution per month of the latest run: count, mean and the 50th, 90th and 99th percentile.

    Percentiles are exact by default, taken from the histogram of scores. ``accuracy`` switches to a mergeable sketch
    with rank error ``1 / accuracy``, one small shuffle even when nearly every score is distinct.
    """
    latest = latest_run(predictions, RUN_KEYS).where("issue_date IS NOT NULL AND p_default IS NOT NULL")
    monthly = latest.select("model_version", "split", month_key(F.col("issue_date")).alias("issue_month"), "p_default")
    shares = {"p50": 0.50, "p90": 0.90, "p99": 0.99}
    if accuracy:
        stats = monthly.groupBy(*MONTH_KEYS).agg(
            F.count(F.lit(1)).alias("n"), F.avg("p_default").alias("avg_pd"),
            *[F.percentile_approx("p_default", q, accuracy).alias(name) for name, q in shares.items()])
    else:
        ranked = cumulate(histogram(monthly, MONTH_KEYS, "p_default"), MONTH_KEYS, "p_default", ["n"],
                          rows_per_task=rows_per_task)
        size = F.col("total_n")
        stats = ranked.groupBy(*MONTH_KEYS).agg(
            F.sum("n").alias("n"), (F.sum(F.col("p_default") * F.col("n")) / F.sum("n")).alias("avg_pd"),
            *[value_at("p_default", F.greatest(F.lit(1), size - F.floor(size - size * F.lit(q)))).alias(name)
              for name, q in shares.items()])
    return stats.select(run_time(run_ts).alias("ts"), *MONTH_KEYS, "n", "avg_pd", "p50", "p90", "p99")


def drift_base(predictions: DataFrame, features: DataFrame, model_version=None) -> DataFrame:
    """Monitored inputs of every loan the model ever scored, one row per loan and split.

    The scoring runs are reduced to one row per loan, which keeps the loans hashed the way the join needs them; a loan
    is in one or two splits, so the set of its splits stays tiny. Loans issued before the first or after the last scored
    day cannot match and are left out before the join.
    """
    version = newest_model(predictions) if model_version is None else F.lit(model_version)
    scored = predictions.where((F.col("model_version") == version) & F.col("split").isin(*SCORED_SPLITS)).where(
        "loan_id IS NOT NULL AND issue_date IS NOT NULL")
    cohort = scored.groupBy("loan_id", "issue_date").agg(
        F.collect_set("split").alias("splits"), F.first("model_version").alias("model_version"))
    first, last = scored.agg(F.min("issue_date"), F.max("issue_date")).first()
    inputs = features.where(F.col("issue_date").between(F.lit(first), F.lit(last))).select(
        "loan_id", "issue_date", *DRIFT_NUMERIC, *DRIFT_CATEGORICAL)
    return cohort.join(inputs, ["loan_id", "issue_date"]).select(
        "model_version", F.explode("splits").alias("split"), month_key(F.col("issue_date")).alias("issue_month"),
        *DRIFT_NUMERIC, *DRIFT_CATEGORICAL)


def numeric_drift(base: DataFrame, include_nulls: bool = True, names: list[str] | None = None) -> DataFrame:
    """Count, null rate, mean, deviation, minimum and maximum per month and numeric input.

    All inputs are aggregated side by side in one pass and only the few result rows are turned into long form.
    With ``include_nulls=False`` missing values are left out before counting, so the null rate is 0 and ``n`` counts
    values.
    """
    names = names or DRIFT_NUMERIC
    stats = []
    for name in names:
        value = F.col(name).cast("double")
        stats.append(F.struct(
            (F.count(F.lit(1)) if include_nulls else F.count(value)).alias("n"),
            (F.avg(value.isNull().cast("double")) if include_nulls else F.lit(0.0)).alias("null_rate"),
            F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"),
            F.min(value).alias("min"), F.max(value).alias("max")).alias(name))
    wide = base.groupBy(*MONTH_KEYS).agg(*stats)
    long = wide.unpivot(MONTH_KEYS, names, "feature_name", "stat")
    return long.where("stat.n > 0").select(
        *MONTH_KEYS, "feature_name", F.lit("numeric").alias("feature_type"), "stat.*")


def categorical_drift(base: DataFrame, include_nulls: bool = True, names: list[str] | None = None) -> DataFrame:
    """Count, null rate, most common value with its share, and entropy per month and categorical input.

    One frequency table, pre-aggregated before its shuffle, gives every figure in a second small aggregation. Share and
    entropy are over the values present. Equal counts are settled by the larger value.
    """
    names = names or DRIFT_CATEGORICAL
    long = base.unpivot(MONTH_KEYS, names, "feature_name", "value")
    if not include_nulls:
        long = long.where("value IS NOT NULL")
    counts = long.groupBy(*MONTH_KEYS, "feature_name", "value").agg(F.count(F.lit(1)).alias("cnt"))
    seen = F.when(F.col("value").isNotNull(), F.col("cnt"))
    stats = counts.groupBy(*MONTH_KEYS, "feature_name").agg(
        F.sum("cnt").alias("n"),
        (F.sum(F.when(F.col("value").isNull(), F.col("cnt")).otherwise(0)) / F.sum("cnt")).alias("null_rate"),
        F.max_by("value", F.when(F.col("value").isNotNull(), F.struct("cnt", "value"))).alias("top_category"),
        F.max(seen).alias("_top"), F.sum(seen).alias("_seen"), F.sum(seen * F.ln(seen)).alias("_log"))
    share = F.try_divide(F.col("_top"), F.col("_seen"))
    return stats.select(
        *MONTH_KEYS, "feature_name", F.lit("categorical").alias("feature_type"), "n", "null_rate", "top_category",
        share.alias("top_category_share"),
        (F.ln("_seen") - F.try_divide(F.col("_log"), F.col("_seen"))).alias("entropy"))


def feature_drift(
    predictions: DataFrame, features: DataFrame, run_ts: str, model_version=None, include_nulls: bool = True,
) -> DataFrame:
    """Numeric and categorical drift in one table layout; the columns of the other kind are NULL."""
    base = settle(drift_base(predictions, features, model_version), "drift-base")
    both = numeric_drift(base, include_nulls).unionByName(categorical_drift(base, include_nulls), allowMissingColumns=True)
    return both.withColumn("ts", run_time(run_ts)).select(
        *[F.col(f.name).cast(f.dataType) for f in FEATURE_DRIFT_SCHEMA.fields])

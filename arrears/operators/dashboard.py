"""Presentation tables for the current model: the model version of the newest ranking rollup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from arrears.constants import (
    CATEGORICAL_SHARE_LIMITS, FEATURE_LABELS, NUMERIC_MEAN_LIMITS)
from arrears.functions.parse import month_key, month_start
from arrears.functions.text import fixed, percent, sentence
from arrears.operators.history import latest_run, newest_model, newest_per_key
from arrears.operators.ranks import band_of, number_rows

BANDS = 100


def feature_labels(spark: SparkSession) -> DataFrame:
    """Plain names of the monitored inputs, a fixed table of twelve rows."""
    rows = [F.struct(*[F.lit(text).alias(name) for name, text in
                       zip(("feature_name", "feature_label", "feature_group"), row)]) for row in FEATURE_LABELS]
    return spark.range(1).select(F.inline(F.array(*rows)))


def _label_columns() -> tuple[Column, Column]:
    """Label and group of a feature, looked up in the fixed table without a join."""
    label = F.create_map(*[F.lit(x) for name, text, _ in FEATURE_LABELS for x in (name, text)])
    group = F.create_map(*[F.lit(x) for name, _, text in FEATURE_LABELS for x in (name, text)])
    return label, group


def scored_loans(predictions: DataFrame, features: DataFrame, rollups: DataFrame) -> DataFrame:
    """Latest scoring run of the current model with outcome and term, one row per loan."""
    current = predictions.where(F.col("model_version") == newest_model(rollups))
    latest = latest_run(current, ["model_version", "split"]).where("p_default IS NOT NULL")
    outcome = features.where("label IS NOT NULL").select("loan_id", "term_months", "label")
    return latest.select("model_version", "split", "loan_id", "issue_date", "p_default").join(outcome, "loan_id").select(
        "model_version", "split", "loan_id", month_key(F.col("issue_date")).alias("issue_month"),
        "term_months", "p_default", "label")


def risk_bands(scored: DataFrame) -> DataFrame:
    """Loans per split cut into 100 equal bands by risk (1 = riskiest), then counted by band and term.

    Bands run over all terms; the loan id settles ties.
    """
    placed = number_rows(
        scored.select("model_version", "split", "loan_id", "term_months", "p_default", "label"),
        ["split"], [F.desc("p_default"), F.col("loan_id")])
    banded = placed.withColumn("risk_band", band_of(F.col("position"), F.col("position_of"), BANDS))
    return banded.groupBy("model_version", "split", "risk_band", "term_months").agg(
        F.count(F.lit(1)).alias("loans"), F.sum("label").alias("defaults"),
        (F.count(F.lit(1)) - F.sum("label")).alias("repaid"), F.sum("p_default").alias("predicted_defaults"),
        F.min("p_default").alias("min_pd"), F.max("p_default").alias("max_pd"),
    ).select(
        "model_version", "split", "risk_band",
        sentence(F.col("term_months").cast("string"), " months").alias("loan_term"),
        "loans", "defaults", "repaid", "predicted_defaults", "min_pd", "max_pd")


def cutoff_what_if(bands: DataFrame, loan_term: str | None = None) -> DataFrame:
    """Effect of declining the riskiest 1..100%: one row per split and cut-off, optionally for one term."""
    rows = bands if loan_term is None else bands.where(F.col("loan_term") == loan_term)
    per_band = rows.groupBy("model_version", "split", "risk_band").agg(
        F.sum("loans").alias("loans"), F.sum("defaults").alias("defaults"))
    split = Window.partitionBy("model_version", "split")
    below = split.orderBy("risk_band")
    loans, defaults = F.col("all_loans"), F.col("all_defaults")
    declined, avoided = F.col("declined_loans"), F.col("defaults_avoided")
    return per_band.select(
        "model_version", "split", F.col("risk_band").alias("decline_pct"),
        F.sum("loans").over(below).alias("declined_loans"), F.sum("defaults").over(below).alias("defaults_avoided"),
        F.sum("loans").over(split).alias("all_loans"), F.sum("defaults").over(split).alias("all_defaults"),
        (F.col("defaults") / F.col("loans")).alias("band_default_rate"),
    ).select(
        "model_version", "split", "decline_pct", "declined_loans", "defaults_avoided",
        (declined - avoided).alias("good_turned_away"),
        ((loans - declined) / loans).alias("approval_rate"),
        F.try_divide(defaults - avoided, loans - declined).alias("approved_default_rate"),
        F.try_divide(avoided, defaults).alias("share_of_defaults_caught"),
        "band_default_rate")


def score_trend(scored: DataFrame, score_drift: DataFrame) -> DataFrame:
    """Predicted against actual default rate by month, with the score percentiles of the drift table."""
    keys = ["model_version", "split", "issue_month"]
    actuals = scored.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("loans"), F.avg("p_default").alias("predicted_default_rate"),
        F.avg("label").alias("actual_default_rate"))
    marks = latest_run(score_drift, ["model_version", "split"]).select(
        *keys, F.col("p50").alias("median_pd"), F.col("p90").alias("p90_pd"))
    return actuals.join(marks, keys, "left").select(
        "model_version", "split", month_start(F.col("issue_month")).alias("month_start"), "issue_month", "loans",
        "predicted_default_rate", "actual_default_rate", "median_pd", "p90_pd")


def _status(change: Column, limits: tuple[float, float]) -> Column:
    warn, critical = limits
    return F.when(change >= critical, "Critical").when(change >= warn, "Warning").otherwise("Stable")


def feature_drift_view(feature_drift: DataFrame, rollups: DataFrame) -> DataFrame:
    """Change of each monitored input against the previous and the first month, with the status the alerts would give."""
    latest = latest_run(feature_drift.where(F.col("model_version") == newest_model(rollups)), ["model_version", "split"])
    series = Window.partitionBy("split", "feature_name").orderBy("issue_month")
    numeric = F.col("feature_type") == "numeric"
    measure = F.when(numeric, F.col("mean")).when(F.col("feature_type") == "categorical", F.col("top_category_share"))
    rows = latest.withColumn("_now", measure).withColumns({
        "_before": F.lag("_now").over(series), "_first": F.first("_now").over(series)})
    now, before, first = F.col("_now"), F.col("_before"), F.col("_first")
    rows = rows.withColumns({
        "change_vs_prev_month": F.when(numeric, F.try_divide(F.abs(now - before), F.abs(before)))
        .otherwise(F.abs(now - before)),
        "change_vs_first_month": F.when(numeric, F.try_divide(now - first, F.abs(first))).otherwise(now - first)})
    change = F.col("change_vs_prev_month")
    labels, groups = _label_columns()
    name, top = F.col("feature_name"), F.col("top_category")
    listing = name == "initial_list_status"
    return rows.select(
        "model_version", "split", month_start(F.col("issue_month")).alias("month_start"), "issue_month", "feature_name",
        F.coalesce(F.try_element_at(labels, name), name).alias("feature_label"),
        F.coalesce(F.try_element_at(groups, name), F.lit("Other")).alias("feature_group"),
        "feature_type", F.col("n").alias("loans"), "null_rate", "mean",
        F.when(listing & (top == "w"), "Whole loan").when(listing & (top == "f"), "Fractional").otherwise(top)
        .alias("top_category"),
        "top_category_share", "change_vs_prev_month", "change_vs_first_month",
        F.when(numeric, "% change in average")
        .when(F.col("feature_type") == "categorical", "change in share of most common value").alias("change_measure"),
        F.when(change.isNull(), "Baseline").when(numeric, _status(change, NUMERIC_MEAN_LIMITS))
        .otherwise(_status(change, CATEGORICAL_SHARE_LIMITS)).alias("status"))


def alert_view(alerts: DataFrame, rollups: DataFrame) -> DataFrame:
    """Alerts of the newest run of each check for the current model, in plain words.

    A check that finds nothing writes no row, so its last alerts stay until it fires again or the model changes.
    """
    own = alerts.where((F.col("model_version") == newest_model(rollups)) & ~F.col("alert_type").like("demo%"))
    latest = latest_run(own, ["alert_type"])
    labels, _ = _label_columns()
    kind, level, value, limit = F.col("alert_type"), F.upper("severity"), F.col("value") * 100, F.col("threshold") * 100
    label = F.coalesce(F.try_element_at(labels, F.col("entity")), F.col("entity"))
    # --- Fixed values: message wordings ---
    message = (
        F.when(kind == "score_drift_p90", sentence(
            "Predicted risk for the riskiest 10% of loans moved ", fixed(value, 1),
            " points from the previous month (limit ", fixed(limit, 0), ")."))
        .when(kind == "numeric_mean_drift", sentence(
            "Average ", F.lower(label), " changed ", fixed(value, 0), "% from the previous month (limit ",
            fixed(limit, 0), "%)."))
        .when(kind == "categorical_share_drift", sentence(
            "Mix of ", F.lower(label), " shifted: the most common value's share moved ", fixed(value, 0),
            " points from the previous month (limit ", fixed(limit, 0), ")."))
        .otherwise(F.col("details")))
    return latest.select(
        F.col("ts").alias("checked_at"), "model_version", "split",
        F.when(F.col("split") == "test", "Monitored period").otherwise("Validation period").alias("period"),
        month_start(F.col("issue_month")).alias("month_start"), "issue_month", "alert_type",
        F.when(level == "CRITICAL", "Critical").when(level == "WARN", "Warning").otherwise("Info").alias("severity"),
        F.when(level == "CRITICAL", 1).when(level == "WARN", 2).otherwise(3).cast("bigint").alias("severity_rank"),
        F.when(kind == "score_drift_p90", "Risk scores").otherwise(label).alias("what_changed"),
        message.alias("message"), "value", "threshold", F.col("details").alias("technical_details"))


def summary(
    rollups: DataFrame, metrics: DataFrame, scored: DataFrame, alerts_in_words: DataFrame,
) -> DataFrame:
    """One row per split of the current model: quality, calibration, open alerts, status and headline."""
    current = newest_model(rollups)
    base = latest_run(rollups.where(F.col("model_version") == current), ["model_version", "split"])
    quality = newest_per_key(metrics.where(F.col("model_version") == current), ["split"]).select(
        "split", "roc_auc", "pr_auc", "brier")
    predicted = scored.groupBy("split").agg(F.avg("p_default").alias("predicted_default_rate"))
    open_alerts = alerts_in_words.groupBy("split").agg(
        F.count_if(F.col("severity") == "Critical").alias("critical_alerts"),
        F.count_if(F.col("severity") == "Warning").alias("warning_alerts"))
    critical, warnings = F.coalesce("critical_alerts", F.lit(0)), F.coalesce("warning_alerts", F.lit(0))
    rows = base.join(quality, "split", "left").join(predicted, "split", "left").join(open_alerts, "split", "left").select(
        "model_version", "split", F.col("ts").alias("refreshed_at"), F.col("n").alias("loans"),
        F.col("base_rate").alias("actual_default_rate"), "predicted_default_rate", "top_5pct_default_rate",
        "lift_at_1pct", "lift_at_5pct", "lift_at_10pct", "recall_at_1pct", "recall_at_5pct", "recall_at_10pct",
        "roc_auc", "pr_auc", "brier",
        critical.cast("bigint").alias("critical_alerts"), warnings.cast("bigint").alias("warning_alerts"))
    critical, warnings = F.col("critical_alerts"), F.col("warning_alerts")
    # --- Fixed values: status and headline wordings ---
    return rows.select(
        "*",
        F.when(critical > 0, "Action needed").when(warnings > 0, "Watch").otherwise("Healthy").alias("status"),
        F.when(critical > 0, sentence(
            critical.cast("string"), " critical data ", F.when(critical == 1, "change").otherwise("changes"),
            " found. Review the alerts before relying on scores for the affected months."))
        .when(warnings > 0, sentence(
            "The model is ranking risk well, but ", warnings.cast("string"), " ",
            F.when(warnings == 1, "input").otherwise("inputs"), " changed more than usual. Worth watching."))
        .otherwise("The model is ranking risk well and no unusual data changes were found.").alias("headline"),
        sentence("The riskiest 5% of loans default at ", fixed(F.col("lift_at_5pct"), 1), "× the normal rate.")
        .alias("tile_lift"),
        sentence("The riskiest 10% of loans hold ", percent(F.col("recall_at_10pct"), 0), " of all defaults.")
        .alias("tile_capture"),
        sentence("Predicted ", percent(F.col("predicted_default_rate"), 1), " default rate vs ",
                 percent(F.col("actual_default_rate"), 1), " actual.").alias("tile_calibration"))

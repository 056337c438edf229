"""The monitoring refresh: score, update drift and rollups, check alerts, export the dashboard tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from arrears.constants import (
    ALERTS_SCHEMA, FEATURE_DRIFT_SCHEMA, METRICS_SCHEMA, PREDICTIONS_SCHEMA, ROLLUPS_SCHEMA, SCORE_DRIFT_SCHEMA,
    SCORED_SPLITS)
from arrears.operators import alerts as checks
from arrears.operators import dashboard
from arrears.operators.drift import MONTH_KEYS, feature_drift, score_drift
from arrears.operators.history import latest_run, upsert
from arrears.operators.metrics import RUN_KEYS, ranking_rollups
from arrears.shared import settle
from arrears.sources.tables import append_rows, ensure_table, read_table, replace_table

# --- Fixed values: sort order of the exported tables ---------------------------------------------
EXPORT_ORDER = {
    "dash_summary": ["split"],
    "dash_risk_bands": ["split", "risk_band", "loan_term"],
    "dash_score_trend": ["split", "issue_month"],
    "dash_feature_drift": ["split", "feature_name", "issue_month"],
    "dash_alerts": ["severity_rank", "split", "issue_month"],
}


@dataclass
class Store:
    """Folders of the stored tables."""

    spark: SparkSession
    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def create(self) -> None:
        for name, schema in LOGS.items():
            ensure_table(self.spark, self.path(name), schema)
        for name, schema in SNAPSHOTS.items():
            self.spark.createDataFrame([], schema).write.mode("ignore").parquet(self.path(name))

    def read(self, name: str) -> DataFrame:
        if name in LOGS:
            return read_table(self.spark, self.path(name), LOGS[name])
        return self.spark.read.schema(SNAPSHOTS[name]).parquet(self.path(name))

    def append(self, name: str, rows: DataFrame) -> None:
        append_rows(rows, self.path(name), LOGS[name], CLUSTERED[name])

    def merge(self, name: str, rows: DataFrame, keys: list[str]) -> None:
        replace_table(upsert(self.read(name), rows, keys), self.path(name))


# Event logs grow by run and are partitioned by run day; snapshots are merged and rewritten.
LOGS = {"predictions": PREDICTIONS_SCHEMA, "feature_drift": FEATURE_DRIFT_SCHEMA,
        "monitoring_alerts": ALERTS_SCHEMA, "model_metrics": METRICS_SCHEMA}
SNAPSHOTS = {"score_drift": SCORE_DRIFT_SCHEMA, "monitoring_rollups": ROLLUPS_SCHEMA}
CLUSTERED = {"predictions": ["model_version", "split"], "feature_drift": ["model_version", "split", "feature_name"],
             "monitoring_alerts": ["alert_type", "severity"], "model_metrics": ["model_version", "split"]}


def labelled_latest(predictions: DataFrame, features: DataFrame) -> DataFrame:
    """Latest run of every model and split with the known outcomes."""
    outcome = features.where("label IS NOT NULL").select("loan_id", "label")
    return latest_run(predictions, RUN_KEYS).where("p_default IS NOT NULL").select(
        *RUN_KEYS, "loan_id", "p_default").join(outcome, "loan_id")


def dashboards(
    predictions: DataFrame, features: DataFrame, score_drift_table: DataFrame, feature_drift_table: DataFrame,
    rollups: DataFrame, alert_log: DataFrame, metrics: DataFrame,
) -> dict[str, DataFrame]:
    """All exported presentation tables. The scored loans behind three of them are written once."""
    scored = settle(dashboard.scored_loans(predictions, features, rollups), "dash-scored")
    alerts_in_words = dashboard.alert_view(alert_log, rollups)
    return {
        "dash_summary": dashboard.summary(rollups, metrics, scored, alerts_in_words),
        "dash_risk_bands": dashboard.risk_bands(scored),
        "dash_score_trend": dashboard.score_trend(scored, score_drift_table),
        "dash_feature_drift": dashboard.feature_drift_view(feature_drift_table, rollups),
        "dash_alerts": alerts_in_words,
    }


def export_views(views: dict[str, DataFrame], folder: str) -> None:
    """Write each presentation table as one sorted CSV file; these are small summaries without loan rows."""
    for name, view in views.items():
        ordered = view.orderBy(*EXPORT_ORDER[name])
        ordered.coalesce(1).write.mode("overwrite").option("header", True).option(
            "timestampFormat", "yyyy-MM-dd HH:mm:ss").csv(f"{folder.rstrip('/')}/{name}")


def monitoring_refresh(
    store: Store, features: DataFrame, score_split: Callable[[str, str], DataFrame], run_ts: str,
    export_to: str | None = None,
) -> dict[str, DataFrame]:
    """One refresh. ``score_split(split, run_ts)`` returns prediction rows; every table of the run shares ``run_ts``."""
    store.create()
    for split in SCORED_SPLITS:
        store.append("predictions", score_split(split, run_ts))
    predictions = store.read("predictions")
    store.merge("score_drift", score_drift(predictions, run_ts), MONTH_KEYS)
    store.merge("monitoring_rollups", ranking_rollups(labelled_latest(predictions, features), run_ts), RUN_KEYS)
    store.append("feature_drift", feature_drift(predictions, features, run_ts))
    scores, inputs = store.read("score_drift"), store.read("feature_drift").drop("run_date")
    found = checks.alert_score_p90(scores, run_ts).unionByName(checks.alert_numeric_mean(inputs, run_ts)).unionByName(
        checks.alert_categorical_share(inputs, run_ts))
    store.append("monitoring_alerts", found)
    views = dashboards(
        predictions, features, scores, store.read("feature_drift"), store.read("monitoring_rollups"),
        store.read("monitoring_alerts"), store.read("model_metrics"))
    if export_to:
        export_views(views, export_to)
    return views

"""A worked loan book over the given order tables: every stored table of the engine, derived from the data.

Scores need no model here. They are a fixed function of the loan number with many ties, scored in several runs by two
model versions, so that latest-run rules, stale months and drift between runs all have something to act on.
"""

from __future__ import annotations

from functools import cache, cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arrears.constants import SCORED_SPLITS
from arrears.operators import alerts, dashboard, features
from arrears.operators.contributions import LinearModel, fold_contributions
from arrears.operators.drift import MONTH_KEYS, feature_drift, score_drift
from arrears.operators.history import upsert
from arrears.operators.metrics import RUN_KEYS, binary_metrics, metrics_row, ranking_rollups, run_time
from arrears.operators.reasons import explain_declines, with_decision
from arrears.plans.monitoring import dashboards, labelled_latest
from arrears.shared import settle
from arrears.sources.order_book import MATURITY_GUARD, raw_loans

# Run times: the old model, then two runs of the new model.
V1_RUN = {"valid": "2001-07-01 00:00:00", "test": "2001-07-01 00:05:00"}
V2_RUN_1 = {"valid": "2001-08-01 00:00:00", "test": "2001-08-01 00:05:00"}
V2_RUN_2 = {"valid": "2001-08-02 00:00:00", "test": "2001-08-02 00:05:00"}
DRIFT_1, DRIFT_2 = "2001-08-01 01:00:00", "2001-08-02 01:00:00"

# Weights of the linear explanation model, in log-odds.
INTERCEPT = -1.2
NUMERIC_WEIGHTS = {
    "loan_amount": 0.00002, "term_months": 0.35 / 24, "annual_income": -0.00001, "dti": 0.02, "fico_low": -0.0125,
    "fico_high": -0.0125, "pub_rec": 0.05, "delinq_2yrs": 0.04, "inq_last_6mths": 0.15, "revol_util": 0.01,
    "credit_history_years": -0.01,
}
HOUSING_WEIGHTS = {"home_ownership": {
    "AUTOMOBILE": 0.10, "BUILDING": -0.05, "FURNITURE": 0.05, "HOUSEHOLD": -0.10, "MACHINERY": 0.0}}
LISTING_WEIGHTS = {"initial_list_status": {"f": 0.05, "w": -0.05}}
GRADE_WEIGHTS = {"grade": {"A": -0.6, "B": -0.4, "C": -0.2, "D": 0.0, "E": 0.2, "F": 0.4, "G": 0.6}}
FEATURE_SET_WEIGHTS = {
    "no_lc_strict": HOUSING_WEIGHTS | LISTING_WEIGHTS,
    "full": HOUSING_WEIGHTS | LISTING_WEIGHTS | GRADE_WEIGHTS,
}

_books: dict[tuple[str, str], "Book"] = {}


def book(spark: SparkSession, folder: str) -> "Book":
    """The book over ``folder``; its tables are written once per application."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _books:
        _books[key] = Book(spark, folder)
    return _books[key]


def fixed_score(loan_id: str = "loan_id") -> Column:
    """One of 200 scores, fixed by the loan number."""
    return ((37 * F.col(loan_id).cast("bigint")) % 200) / 400


class Book:
    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder

    @cached_property
    def raw(self) -> DataFrame:
        return settle(raw_loans(self.spark, self.folder), "loans-raw")

    @property
    def staged(self) -> DataFrame:
        return features.stage_loans(self.raw)

    @property
    def labelled(self) -> DataFrame:
        return features.label_loans(self.staged)

    @cached_property
    def features(self) -> DataFrame:
        return settle(features.build_features(self.raw, MATURITY_GUARD), "features", ["split"])

    @cached_property
    def predictions(self) -> DataFrame:
        """Three scoring runs.

        The second run of the new model scores later months higher, has not received the newest month yet, skips loans
        without revolving data, and could not score or date a few loans.
        """
        loans = self.features.where(F.col("split").isin(*SCORED_SPLITS))
        score = fixed_score()
        late = F.col("issue_date") >= F.lit("2001-03-01").cast("date")

        def run(version: str, times: dict[str, str], rows: DataFrame, p: Column, day: Column) -> DataFrame:
            ts = F.when(F.col("split") == "valid", run_time(times["valid"])).otherwise(run_time(times["test"]))
            return rows.select(
                ts.alias("ts"), F.lit(version).alias("model_version"), "split", "loan_id", day.alias("issue_date"),
                p.alias("p_default"))

        day = F.col("issue_date")
        second = loans.where("revol_util IS NOT NULL AND issue_date < DATE'2001-06-01'")
        runs = run("v1", V1_RUN, loans, score, day).unionByName(run("v2", V2_RUN_1, loans, score, day)).unionByName(
            run("v2", V2_RUN_2, second,
                F.when(F.col("annual_income") <= 99_000, score + F.when(late, 0.06).otherwise(0.0)),
                F.when(F.col("dti") >= 1, day)))
        return settle(runs.withColumn("run_date", F.to_date("ts")), "predictions", ["run_date"])

    @property
    def before_second_run(self) -> DataFrame:
        """The prediction log before the last scoring run."""
        return self.predictions.where(F.col("ts") < run_time(V2_RUN_2["valid"]))

    @cached_property
    def score_drift(self) -> DataFrame:
        """Drift after both runs: months the second run did not score keep their older row."""
        first = score_drift(self.before_second_run, DRIFT_1)
        return settle(upsert(first, score_drift(self.predictions, DRIFT_2), MONTH_KEYS), "score-drift")

    @cached_property
    def feature_drift(self) -> DataFrame:
        old = feature_drift(self.predictions, self.features, DRIFT_1, "v1")
        return settle(old.unionByName(feature_drift(self.predictions, self.features, DRIFT_2, "v2")), "feature-drift")

    @cached_property
    def labelled_scores(self) -> DataFrame:
        return settle(labelled_latest(self.predictions, self.features), "labelled-scores")

    @cached_property
    def rollups(self) -> DataFrame:
        current = ranking_rollups(self.labelled_scores, DRIFT_2)
        # The old model's rollup dates from its own run.
        ts = F.when(F.col("model_version") == "v1", run_time(DRIFT_1)).otherwise(F.col("ts"))
        return settle(current.withColumn("ts", ts), "rollups")

    @cached_property
    def metrics(self) -> DataFrame:
        """Two rows per split, the newer one valid."""
        row = metrics_row(binary_metrics(self.labelled_scores, RUN_KEYS), DRIFT_2)
        older = row.withColumn("ts", run_time(DRIFT_1)).withColumn("roc_auc", F.lit(0.5))
        return settle(row.unionByName(older), "metrics")

    @cached_property
    def alert_log(self) -> DataFrame:
        """Alerts of both models plus rows the dashboard must treat specially: demo rows and a manual review."""
        new = [alerts.alert_score_p90(self.score_drift, DRIFT_2), alerts.alert_numeric_mean(self.feature_drift, DRIFT_2),
               alerts.alert_categorical_share(self.feature_drift, DRIFT_2)]
        old = alerts.alert_numeric_mean(self.feature_drift, DRIFT_1, "v1")
        demo = new[0].withColumn("alert_type", F.lit("demo_score"))
        review = self.feature_drift.where("null_rate > 0.02").select(
            run_time(DRIFT_2).alias("ts"), "model_version", "split", "issue_month",
            F.lit("manual_review").alias("alert_type"), F.col("feature_name").alias("entity"),
            F.col("null_rate").alias("value"), F.lit(0.02).alias("threshold"), F.lit("info").alias("severity"),
            F.lit("more than 2% missing").alias("details"))
        rows = old.unionByName(demo).unionByName(review)
        for part in new:
            rows = rows.unionByName(part)
        return settle(rows, "alerts")

    @cached_property
    def dash_scored(self) -> DataFrame:
        return settle(dashboard.scored_loans(self.predictions, self.features, self.rollups), "dash-scored")

    @cached_property
    def risk_bands(self) -> DataFrame:
        return settle(dashboard.risk_bands(self.dash_scored), "risk-bands")

    def dashboards(self) -> dict[str, DataFrame]:
        return dashboards(self.predictions, self.features, self.score_drift, self.feature_drift, self.rollups,
                          self.alert_log, self.metrics)

    @cache
    def linear_model(self, feature_set: str = "no_lc_strict") -> LinearModel:
        model = LinearModel(NUMERIC_WEIGHTS, FEATURE_SET_WEIGHTS[feature_set], INTERCEPT)
        return model.fit(self.features.where("split = 'train'"))

    @cache
    def explained(self, feature_set: str = "no_lc_strict") -> DataFrame:
        """Validation and test loans explained by the linear model, with the decision."""
        model = self.linear_model(feature_set)
        loans = self.features.where(F.col("split").isin(*SCORED_SPLITS))
        scored = settle(model.score(model.contributions(loans)), "explained")
        return fold_contributions(with_decision(scored), model.owners)

    def declines(self, feature_set: str = "no_lc_strict") -> DataFrame:
        model = self.linear_model(feature_set)
        return explain_declines(self.explained(feature_set), [*model.numeric, *model.categorical], rescore=model.score)

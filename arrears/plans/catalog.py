"""Every registered query: one callable per operator over the loan book of a data folder.

Doubles are rounded here, and only here, so that results can be compared across engines that add in another order.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrears.constants import (
    CATEGORICAL_FEATURES, NUMERIC_FEATURES, PREDICTIONS_SCHEMA, SCORED_SPLITS)
from arrears.operators import alerts, dashboard, features, quality, rates, reasons
from arrears.operators.drift import MONTH_KEYS, categorical_drift, drift_base, feature_drift, numeric_drift, score_drift
from arrears.operators.history import latest_run, newest_model, upsert
from arrears.operators.metrics import (
    RUN_KEYS, binary_metrics, brier_skill, exact_topk, metrics_row, ranking_rollups, reliability_curve, run_time)
from arrears.operators.model import DefaultModel, ablation, evaluate_splits, score_split, train_model
from arrears.operators.ranks import (
    cumulate, discrete_quantiles, histogram, interpolated_quantiles, percent_rank_from, spearman)
from arrears.plans.book import DRIFT_1, DRIFT_2, FEATURE_SET_WEIGHTS, NUMERIC_WEIGHTS, V2_RUN_2, book, fixed_score
from arrears.plans.explaining import explanation_run
from arrears.plans.monitoring import Store, export_views, monitoring_refresh
from arrears.plans.training import training_run
from arrears.shared import settle, shared_dir
from arrears.sources.order_book import MATURITY_GUARD
from arrears.sources.raw_csv import load_raw_csv, read_csv_split
from arrears.sources.tables import append_rows, ensure_table, read_split, read_table

Query = Callable[[SparkSession, str], DataFrame]
RATE = 9  # digits kept of shares and rates: more than a tie needs, fewer than the order of addition disturbs
_catalog: dict[str, Query] = {}


def rounded(df: DataFrame, digits: int = 6, **special: int) -> DataFrame:
    """Doubles rounded for comparison; adding zero turns -0.0 into 0.0."""
    return df.select(*[
        (F.round(name, special.get(name, digits)) + F.lit(0.0)).alias(name) if kind == "double" else F.col(name)
        for name, kind in df.dtypes])


def rounded_drift(df: DataFrame, n: str = "n", **digits: int) -> DataFrame:
    """Drift figures for comparison. A mean of amounts in cents can end in a 5 just where it is rounded, so it is taken
    back to its total, whose cents are certain, and divided again."""
    values = F.round(F.col(n) * (1 - F.col("null_rate")))
    mean = F.try_divide(F.round(F.col("mean") * values, 5), values).alias("mean")
    return df.select(*[
        mean if name == "mean"
        else (F.round(name, digits.get(name, RATE)) + F.lit(0.0)).alias(name) if kind == "double" else F.col(name)
        for name, kind in df.dtypes])


def query(build: Query) -> Query:
    _catalog[build.__name__] = build
    return build


def catalog() -> dict[str, Query]:
    return dict(_catalog)


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


# --- Sources and the feature build ------------------------------------------------------------------------------------


@query
def ingest_raw_strings(spark, sf):
    csv, table = _scratch(spark, "csv"), _scratch(spark, "raw-table")
    book(spark, sf).raw.write.option("header", True).option("ignoreLeadingWhiteSpace", False).option(
        "escape", '"').csv(csv)
    loaded = load_raw_csv(spark, csv, table)
    return loaded.select(
        "id", "loan_amnt", "term", "int_rate", "issue_d", "earliest_cr_line", "emp_length", "revol_util", "loan_status")


@query
def read_csv_by_split(spark, sf):
    csv = _scratch(spark, "features-csv")
    book(spark, sf).features.select("loan_id", "issue_date", "label", "split").write.option("header", True).csv(csv)
    return read_csv_split(spark, csv, "valid")


@query
def read_one_split(spark, sf):
    return rounded(read_split(book(spark, sf).features, "test", ["loan_id", "issue_date", "dti", "term_months", "grade"]))


@query
def stage_loans(spark, sf):
    return rounded(book(spark, sf).staged)


@query
def label_loans(spark, sf):
    return book(spark, sf).labelled.select("loan_id", "issue_date", "loan_status", "label")


@query
def dedupe_loans(spark, sf):
    return rounded(features.dedupe_loans(book(spark, sf).labelled).select(
        "loan_id", "issue_date", "loan_status", "loan_amount", "label"))


@query
def clean_loans(spark, sf):
    return rounded(features.clean_loans(book(spark, sf).staged, MATURITY_GUARD))


@query
def cut_dates(spark, sf):
    return features.cut_dates(book(spark, sf).features)


@query
def time_split(spark, sf):
    split = features.time_split(book(spark, sf).features.drop("split"))
    return rounded(split.groupBy("split").agg(
        F.count(F.lit(1)).alias("loans"), F.min("issue_date").alias("first_date"), F.max("issue_date").alias("last_date"),
        F.avg("label").alias("default_rate")), RATE)


@query
def build_features(spark, sf):
    return rounded(features.build_features(book(spark, sf).raw, MATURITY_GUARD))


@query
def build_features_with_line_date(spark, sf):
    built = features.build_features(book(spark, sf).raw, MATURITY_GUARD, keep_earliest_line=True)
    return built.select("loan_id", "issue_date", "earliest_cr_line_date", "credit_history_years", "split")


@query
def monthly_default_rate(spark, sf):
    months = book(spark, sf).features.groupBy("split", F.date_format("issue_date", "yyyy-MM").alias("issue_month"))
    return rounded(months.agg(F.count(F.lit(1)).alias("loans"), F.avg("label").alias("default_rate")), RATE)


@query
def reconcile_features(spark, sf):
    whole = book(spark, sf).features
    earlier = features.build_features(book(spark, sf).raw, "2001-03-01")
    return features.reconcile(whole, earlier, "loan_id", ["issue_date", "label", "loan_amount", "split"])


# --- Data tests and validation ----------------------------------------------------------------------------------------


@query
def test_unique(spark, sf):
    return quality.failing_unique(book(spark, sf).staged, "loan_id")


@query
def test_not_null(spark, sf):
    return quality.failing_not_null(book(spark, sf).labelled, ["loan_id", "issue_date", "label", "loan_amount", "revol_util"])


@query
def test_accepted_values(spark, sf):
    return quality.failing_accepted_values(book(spark, sf).features, "grade", ["A", "B", "C", "D"])


@query
def test_split_order(spark, sf):
    return quality.split_order(book(spark, sf).features, only_failures=False)


@query
def test_maturity(spark, sf):
    return quality.failing_maturity(book(spark, sf).staged, MATURITY_GUARD)


@query
def test_fico_range(spark, sf):
    return rounded(quality.failing_fico_range(book(spark, sf).features))


@query
def data_tests(spark, sf):
    return quality.data_tests(book(spark, sf).features, MATURITY_GUARD)


@query
def validation_report(spark, sf):
    return rounded(quality.validate_splits(
        book(spark, sf).features, NUMERIC_FEATURES, CATEGORICAL_FEATURES, True, MATURITY_GUARD), RATE)


@query
def validation_full_size(spark, sf):
    """Without the trial-run switch the training split must reach its full size."""
    return rounded(quality.validate_splits(
        book(spark, sf).features, NUMERIC_FEATURES, CATEGORICAL_FEATURES, False, MATURITY_GUARD), RATE)


@query
def validation_broken_splits(spark, sf):
    """Splits that overlap, lack labels and break the maturity guard, with an input that is mostly missing."""
    raw = features.label_loans(book(spark, sf).staged).drop("loan_status", "earliest_cr_line_date").withColumn(
        "credit_history_years", F.when(F.col("grade") == "A", 5).cast("bigint"))
    good = book(spark, sf).features
    parts = {"train": raw, "valid": good.where("split = 'valid'"), "test": good.where("split <> 'train'")}
    return rounded(quality.validate_splits(parts, NUMERIC_FEATURES, CATEGORICAL_FEATURES, True, MATURITY_GUARD), RATE)


@query
def validation_unexpected_terms(spark, sf):
    """Terms outside the allowed list, one row per value."""
    odd = book(spark, sf).features.withColumn(
        "term_months", F.when(F.col("grade") == "G", F.col("term_months") + 12).otherwise(F.col("term_months")))
    report = quality.validate_splits(odd, NUMERIC_FEATURES, CATEGORICAL_FEATURES, True, MATURITY_GUARD)
    return report.where("check = 'allowed'")


# --- Run history and drift --------------------------------------------------------------------------------------------


@query
def latest_predictions(spark, sf):
    return rounded(latest_run(book(spark, sf).predictions, RUN_KEYS).drop("run_date"))


@query
def latest_alert_run(spark, sf):
    latest = latest_run(book(spark, sf).alert_log, ["alert_type"])
    return latest.groupBy("ts", "alert_type", "model_version").agg(F.count(F.lit(1)).alias("alerts"))


@query
def current_model(spark, sf):
    rollups = book(spark, sf).rollups
    return rollups.where(F.col("model_version") == newest_model(rollups)).select("model_version", "split", "n")


@query
def upsert_score_drift(spark, sf):
    new = score_drift(book(spark, sf).predictions, DRIFT_2)
    old = score_drift(book(spark, sf).before_second_run, DRIFT_1)
    return upsert(old, new, MONTH_KEYS).select(*MONTH_KEYS, "ts", "n")


@query
def append_positional(spark, sf):
    """Two batches with their columns in different order, appended and read back."""
    path, rows = _scratch(spark, "predictions"), book(spark, sf).predictions.drop("run_date")
    ensure_table(spark, path, PREDICTIONS_SCHEMA)
    append_rows(rows.where("model_version = 'v1'"), path, PREDICTIONS_SCHEMA, RUN_KEYS)
    append_rows(rows.where("model_version = 'v2'").select(*reversed(rows.columns)), path, PREDICTIONS_SCHEMA, RUN_KEYS)
    stored = read_table(spark, path, PREDICTIONS_SCHEMA)
    return rounded(stored.groupBy("run_date", "model_version", "split").agg(
        F.count(F.lit(1)).alias("loans"), F.count("p_default").alias("scored"), F.count("issue_date").alias("dated"),
        F.avg("p_default").alias("avg_pd")), RATE)


@query
def score_drift_months(spark, sf):
    return rounded(score_drift(book(spark, sf).predictions, DRIFT_2), RATE)


@query
def score_drift_table(spark, sf):
    return rounded(book(spark, sf).score_drift, RATE)


@query
def numeric_drift_stats(spark, sf):
    base = drift_base(book(spark, sf).predictions, book(spark, sf).features, "v2")
    return rounded_drift(numeric_drift(base), std=3, min=3, max=3)


@query
def categorical_drift_stats(spark, sf):
    return rounded(categorical_drift(drift_base(book(spark, sf).predictions, book(spark, sf).features, "v2")), RATE)


@query
def feature_drift_table(spark, sf):
    return rounded_drift(book(spark, sf).feature_drift, std=3, min=3, max=3)


@query
def feature_drift_values_only(spark, sf):
    """Missing values left out before counting."""
    rows = feature_drift(book(spark, sf).predictions, book(spark, sf).features, DRIFT_2, include_nulls=False)
    return rounded_drift(rows, std=3, min=3, max=3)


# --- Ranking quality and calibration ----------------------------------------------------------------------------------


@query
def percent_ranks(spark, sf):
    hist = histogram(book(spark, sf).labelled_scores, RUN_KEYS, "p_default")
    ranked = percent_rank_from(cumulate(hist, RUN_KEYS, "p_default", ["n"], descending=True))
    return rounded(ranked.select(*RUN_KEYS, "p_default", "n", "pct_rank"), RATE)


@query
def ranking_rollup(spark, sf):
    return rounded(ranking_rollups(book(spark, sf).labelled_scores, DRIFT_2), RATE)


@query
def binary_metrics_by_run(spark, sf):
    return rounded(binary_metrics(book(spark, sf).labelled_scores, RUN_KEYS), RATE)


@query
def exact_top_k(spark, sf):
    return exact_topk(book(spark, sf).labelled_scores, RUN_KEYS)


@query
def metrics_rows(spark, sf):
    row = metrics_row(binary_metrics(book(spark, sf).labelled_scores, RUN_KEYS), DRIFT_2)
    in_json = F.get_json_object("metrics_json", "$.lift_at_5pct").cast("double").alias("json_lift_at_5pct")
    return rounded(row.select("*", in_json).drop("metrics_json"), RATE)


@query
def rank_documents(spark, sf):
    """The ranking metrics on another table: does text length predict the quality label?"""
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang", F.col("n_chars").cast("double").alias("score"))
    rated = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", F.col("quality").cast("bigint").alias("label"))
    rows = settle(rated.where("label IS NOT NULL").join(docs, "doc_id"), "rated")
    return rounded(binary_metrics(rows, ["lang"], "score", "label", "doc_id").drop("brier"), RATE)


@query
def reliability_bins(spark, sf):
    return rounded(reliability_curve(book(spark, sf).labelled_scores, RUN_KEYS), RATE)


@query
def brier_skill_by_run(spark, sf):
    return rounded(brier_skill(book(spark, sf).labelled_scores, RUN_KEYS), RATE)


@query
def income_quantiles(spark, sf):
    rows = book(spark, sf).features
    shares = {"p10": 0.1, "median": 0.5, "p95": 0.95}
    return rounded(interpolated_quantiles(rows, ["grade"], "annual_income", shares), 4)


@query
def income_quantiles_discrete(spark, sf):
    return rounded(discrete_quantiles(book(spark, sf).features, ["grade"], "annual_income", {"p50": 0.5, "p90": 0.9}))


@query
def rank_correlation(spark, sf):
    rows = book(spark, sf).features.where("open_acc IS NOT NULL AND total_acc IS NOT NULL")
    return rounded(spearman(rows, ["split"], "open_acc", "total_acc").select("split", "rows", "distinct_x", "distinct_y", "rho"), RATE)


# --- Alerts and dashboards --------------------------------------------------------------------------------------------


@query
def alert_score_p90(spark, sf):
    return rounded(alerts.alert_score_p90(book(spark, sf).score_drift, DRIFT_2), RATE)


@query
def alert_numeric_mean(spark, sf):
    return rounded(alerts.alert_numeric_mean(book(spark, sf).feature_drift, DRIFT_2), RATE)


@query
def alert_categorical_share(spark, sf):
    return rounded(alerts.alert_categorical_share(book(spark, sf).feature_drift, DRIFT_2), RATE)


@query
def feature_labels(spark, sf):
    """Dashboard names of the inputs in the drift table."""
    seen = book(spark, sf).feature_drift.groupBy("feature_name").agg(F.sum("n").alias("values_seen"))
    return dashboard.feature_labels(spark).join(seen, "feature_name", "left")


@query
def dash_scored(spark, sf):
    b = book(spark, sf)
    return rounded(dashboard.scored_loans(b.predictions, b.features, b.rollups))


@query
def dash_risk_bands(spark, sf):
    return rounded(dashboard.risk_bands(book(spark, sf).dash_scored))


@query
def dash_score_trend(spark, sf):
    return rounded(dashboard.score_trend(book(spark, sf).dash_scored, book(spark, sf).score_drift), RATE)


@query
def dash_feature_drift(spark, sf):
    return rounded_drift(dashboard.feature_drift_view(book(spark, sf).feature_drift, book(spark, sf).rollups), "loans")


@query
def dash_alerts(spark, sf):
    return rounded(dashboard.alert_view(book(spark, sf).alert_log, book(spark, sf).rollups), RATE)


@query
def dash_summary(spark, sf):
    b = book(spark, sf)
    words = dashboard.alert_view(b.alert_log, b.rollups)
    return rounded(dashboard.summary(b.rollups, b.metrics, b.dash_scored, words), RATE)


@query
def cutoff_what_if(spark, sf):
    return rounded(dashboard.cutoff_what_if(book(spark, sf).risk_bands), RATE)


@query
def cutoff_what_if_long_term(spark, sf):
    return rounded(dashboard.cutoff_what_if(book(spark, sf).risk_bands, "60 months"), RATE)


@query
def export_score_trend(spark, sf):
    """The exported CSV, read back."""
    folder, b = _scratch(spark, "export"), book(spark, sf)
    export_views({"dash_score_trend": rounded(dashboard.score_trend(b.dash_scored, b.score_drift), RATE)}, folder)
    schema = ("model_version string, split string, month_start date, issue_month string, loans bigint, "
              "predicted_default_rate double, actual_default_rate double, median_pd double, p90_pd double")
    return spark.read.schema(schema).option("header", True).csv(f"{folder}/dash_score_trend")


@query
def refresh_monitoring(spark, sf):
    """A whole refresh on fixed scores: score, drift, rollups, alerts, export. Returns the stored score drift."""
    b, root = book(spark, sf), _scratch(spark, "store")

    def score(split: str, run_ts: str) -> DataFrame:
        return read_split(b.features, split, ["loan_id", "issue_date"]).select(
            run_time(run_ts).alias("ts"), F.lit("v3").alias("model_version"), F.lit(split).alias("split"), "loan_id",
            "issue_date", fixed_score().alias("p_default"))

    store = Store(spark, root)
    monitoring_refresh(store, b.features, score, V2_RUN_2["valid"], f"{root}/extracts")
    return rounded(store.read("score_drift"), RATE)


# --- Implied rate -----------------------------------------------------------------------------------------------------


@query
def implied_rate(spark, sf):
    return rounded(rates.implied_rates(book(spark, sf).features).select("loan_id", "implied_rate", "abs_error"), 4)


@query
def implied_rate_report(spark, sf):
    return rates.implied_rate_report(book(spark, sf).features)[0]


@query
def implied_rate_by_grade(spark, sf):
    return rates.implied_rate_report(book(spark, sf).features)[1]


# --- Reason codes -----------------------------------------------------------------------------------------------------


@query
def decline_rule(spark, sf):
    rows = book(spark, sf).explained()
    return rounded(rows.where("declined").select("loan_id", "p_default", "cutoff"))


@query
def linear_contributions(spark, sf):
    model = book(spark, sf).linear_model("full")
    rows = model.contributions(book(spark, sf).features.where(F.col("split").isin(*SCORED_SPLITS)))
    return rounded(rows.select(
        "loan_id", "bias", "margin", *[F.get("phi", F.lit(i)).alias(f"slot_{i}") for i in range(len(model.owners))]))


@query
def folded_contributions(spark, sf):
    rows = book(spark, sf).explained("full")
    return rounded(rows.select("loan_id", *[f"phi_{c}" for c in [*NUMERIC_WEIGHTS, *FEATURE_SET_WEIGHTS["full"]]]))


@query
def grouped_contributions(spark, sf):
    grouped = reasons.group_contributions(
        book(spark, sf).explained("full"), [*NUMERIC_WEIGHTS, *FEATURE_SET_WEIGHTS["full"]])
    return rounded(grouped.select("loan_id", *sorted(c for c in grouped.columns if c.startswith("grp_"))))


@query
def top_reasons(spark, sf):
    return rounded(reasons.reason_table(book(spark, sf).declines()).drop(
        "term_logodds", "term_note", "p_default_36m", "qualifies_at_36m"), 4)


@query
def top_reasons_full(spark, sf):
    """Reasons from the model that also sees the lender's own grade; the grade is never reported."""
    return rounded(reasons.reason_table(book(spark, sf).declines("full")).select(
        "loan_id", "n_reasons", "reason_1_code", "reason_2_code", "reason_3_code", "reason_4_code", "term_note"), 4)


@query
def term_counter_offer(spark, sf):
    return rounded(reasons.reason_table(book(spark, sf).declines()).select(
        "loan_id", "term_months", "term_logodds", "term_note", "p_default_36m", "qualifies_at_36m"), 4)


@query
def direction_check(spark, sf):
    return rounded(reasons.direction_check(book(spark, sf).explained()))


@query
def reason_summary(spark, sf):
    declines = settle(book(spark, sf).declines(), "declines")
    rows = reasons.reason_summary(book(spark, sf).explained(), declines)
    return rounded(rows.where("measure <> 'additivity_max_error'"), 3)


# --- Fitted models ----------------------------------------------------------------------------------------------------


def _fits(spark: SparkSession, sf: str) -> str:
    """Folder with one round log per feature set, so that queries of an application share a fit of the same rows."""
    return f"{shared_dir(spark)}/fits-{hashlib.sha256(sf.rstrip('/').encode()).hexdigest()[:16]}"


def _fitted(spark: SparkSession, sf: str, feature_set: str = "full") -> DefaultModel:
    return train_model(book(spark, sf).features, "trees", feature_set, log=f"{_fits(spark, sf)}/{feature_set}")


@query
def train_and_score(spark, sf):
    """Boosted trees, calibrated, applied to the test split."""
    b = book(spark, sf)
    model = _fitted(spark, sf)
    return score_split(model, b.features, "test", DRIFT_2)


@query
def calibration_skill(spark, sf):
    """Brier skill of the raw and the calibrated scores on the test split."""
    b = book(spark, sf)
    model = _fitted(spark, sf)
    scored = model.score(read_split(b.features, "test"), "calibrated", raw_out="raw")
    long = settle(scored.unpivot(["label"], ["raw", "calibrated"], "score", "p_default"), "raw-calibrated")
    return brier_skill(long, ["score"])


@query
def evaluate_model(spark, sf):
    return evaluate_splits(_fitted(spark, sf), book(spark, sf).features)


@query
def ablation_table(spark, sf):
    return ablation(book(spark, sf).features, "trees", log=_fits(spark, sf))


@query
def training(spark, sf):
    """A training run on the lender-independent inputs; returns the stored metrics."""
    store = Store(spark, _scratch(spark, "training"))
    training_run(store, book(spark, sf).features, "trees", DRIFT_2, "no_lc", skip_validation=True,
                 save_to=store.path("model"), log=f"{_fits(spark, sf)}/no_lc")
    return store.read("model_metrics").drop("run_date")


@query
def tree_reasons(spark, sf):
    """Reason codes of the declined test loans from exact contributions of boosted trees."""
    b = book(spark, sf)
    model = _fitted(spark, sf, "no_lc_strict")
    return explanation_run(model, read_split(b.features, "test"), _scratch(spark, "reasons"))[0]

"""Drift, alerts and dashboards: limits, NULLs, wording and stale rows."""

import datetime

import pytest
from pyspark.sql import functions as F

from arrears.constants import ALERTS_SCHEMA, FEATURE_DRIFT_SCHEMA, ROLLUPS_SCHEMA, SCORE_DRIFT_SCHEMA
from arrears.operators import alerts, dashboard, drift

TS = "2020-02-01 00:00:00"
DAY = datetime.datetime(2020, 1, 31)


def scores(spark, p90s, ts=DAY):
    rows = [(ts, "m", "test", f"2019-{i + 1:02d}", 10, 0.1, 0.1, p90, 0.9) for i, p90 in enumerate(p90s)]
    return spark.createDataFrame(rows, SCORE_DRIFT_SCHEMA)


def inputs(spark, kind, values, name="x", tops=None):
    rows = [(DAY, "m", "test", f"2019-{i + 1:02d}", name, kind, 10, 0.0, v if kind == "numeric" else None, None, None,
             None, (tops or ["t"] * len(values))[i] if kind == "categorical" else None,
             v if kind == "categorical" else None, None) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, FEATURE_DRIFT_SCHEMA)


def rollup(spark, version="m"):
    return spark.createDataFrame([(DAY, version, "test", 10, 0.2, *[0.5] * 9)], ROLLUPS_SCHEMA)


def test_score_alert_limits(spark):
    got = alerts.alert_score_p90(scores(spark, [0.40, 0.42, 0.46, 0.40]), TS).orderBy("issue_month").collect()
    assert [(r.issue_month, r.severity, r.threshold) for r in got] == [("2019-03", "WARN", 0.03), ("2019-04", "CRITICAL", 0.05)]
    assert got[0].details == "p90 moved from 0.420000 to 0.460000"


def test_alert_uses_newest_row_of_each_month(spark):
    both = scores(spark, [0.40, 0.60]).union(scores(spark, [0.40, 0.41], datetime.datetime(2020, 2, 1)))
    assert alerts.alert_score_p90(both, TS).count() == 0


def test_numeric_alert_skips_a_zero_mean(spark):
    got = alerts.alert_numeric_mean(inputs(spark, "numeric", [100.0, 110.0, 88.0, 0.0, 50.0]), TS).orderBy("issue_month")
    assert [(r.issue_month, r.severity) for r in got.collect()] == [
        ("2019-02", "WARN"), ("2019-03", "CRITICAL"), ("2019-04", "CRITICAL")]


def test_categorical_alert_names_both_values(spark):
    got = alerts.alert_categorical_share(inputs(spark, "categorical", [0.76, 0.64], tops=["w", "f"]), TS).first()
    assert got.severity == "CRITICAL" and got.details.endswith("top_cat w -> f")


@pytest.mark.parametrize("include, n, null_rate", [(True, 4, 0.25), (False, 3, 0.0)])
def test_drift_counts_missing_values(spark, include, n, null_rate):
    base = spark.createDataFrame(
        [("m", "test", "2019-01", 1.0, "a"), ("m", "test", "2019-01", 3.0, "b"), ("m", "test", "2019-01", 8.0, "b"),
         ("m", "test", "2019-01", None, None)], "model_version string, split string, issue_month string, x double, c string")
    row = drift.numeric_drift(base, include, ["x"]).first()
    assert (row.n, row.null_rate, row["mean"], row["min"], row["max"]) == (n, null_rate, 4.0, 1.0, 8.0)
    row = drift.categorical_drift(base, include, ["c"]).first()
    assert (row.n, row.null_rate, row.top_category) == (n, null_rate, "b")
    assert row.top_category_share == pytest.approx(2 / 3)
    assert row.entropy == pytest.approx(0.6365141682948128)


def test_drift_of_an_all_missing_input(spark):
    base = spark.createDataFrame([("m", "test", "2019-01", None, None)],
                                 "model_version string, split string, issue_month string, x double, c string")
    assert drift.numeric_drift(base, True, ["x"]).first().null_rate == 1.0
    assert drift.numeric_drift(base, False, ["x"]).count() == 0
    assert drift.categorical_drift(base, True, ["c"]).first().top_category is None


def test_single_row_month_has_no_deviation(spark):
    base = spark.createDataFrame([("m", "test", "2019-01", 2.0)], "model_version string, split string, issue_month string, x double")
    assert drift.numeric_drift(base, True, ["x"]).first()["std"] is None


def alert_rows(spark, rows):
    return spark.createDataFrame([(ts, "m", "valid", "2016-09", kind, entity, value, limit, severity, "text")
                                  for ts, kind, entity, value, limit, severity in rows], ALERTS_SCHEMA)


def test_alert_wording(spark):
    log = alert_rows(spark, [
        (DAY, "categorical_share_drift", "initial_list_status", 0.11763905172289013, 0.08, "CRITICAL"),
        (DAY - datetime.timedelta(days=1), "categorical_share_drift", "grade", 0.2, 0.08, "CRITICAL"),
        (DAY, "score_drift_p90", "p90", 0.0625, 0.05, "CRITICAL"), (DAY, "numeric_mean_drift", "dti", 0.125, 0.1, "WARN"),
        (DAY, "demo_score", "p90", 1.0, 0.05, "CRITICAL"), (DAY, "review", "odd", 1.0, 0.05, "other")])
    got = {r.alert_type: r for r in dashboard.alert_view(log, rollup(spark)).collect()}
    assert set(got) == {"categorical_share_drift", "score_drift_p90", "numeric_mean_drift", "review"}
    assert got["categorical_share_drift"].message == (
        "Mix of listing type (whole/fractional) shifted: the most common value's share moved 12 points from the "
        "previous month (limit 8).")
    assert got["score_drift_p90"].message == (
        "Predicted risk for the riskiest 10% of loans moved 6.2 points from the previous month (limit 5).")
    assert got["numeric_mean_drift"].message == "Average debt-to-income ratio changed 12% from the previous month (limit 10%)."
    assert (got["review"].message, got["review"].severity, got["review"].what_changed) == ("text", "Info", "odd")


@pytest.mark.parametrize("critical, warnings, status, words", [
    (1, 0, "Action needed", "1 critical data change found."), (2, 1, "Action needed", "2 critical data changes found."),
    (0, 1, "Watch", "but 1 input changed"), (0, 3, "Watch", "but 3 inputs changed"), (0, 0, "Healthy", "no unusual data")])
def test_summary_status(spark, critical, warnings, status, words):
    metrics = spark.createDataFrame([(DAY, "m", "test", 0.7, 0.4, 0.2)],
                                    "ts timestamp, model_version string, split string, roc_auc double, pr_auc double, brier double")
    scored = spark.createDataFrame([("test", 0.25467), ("test", 0.25467)], "split string, p_default double")
    rows = [("test", "Critical")] * critical + [("test", "Warning")] * warnings
    opened = spark.createDataFrame(rows, "split string, severity string")
    row = dashboard.summary(rollup(spark), metrics, scored, opened).first()
    assert row.status == status and words in row.headline
    assert row.tile_lift == "The riskiest 5% of loans default at 0.5× the normal rate."
    assert row.tile_capture == "The riskiest 10% of loans hold 50% of all defaults."
    assert row.tile_calibration == "Predicted 25.5% default rate vs 20.0% actual."


def test_feature_view_baseline(spark):
    rows = inputs(spark, "numeric", [0.0, 5.0, 5.2], name="dti").union(inputs(spark, "numeric", [1.0], name="unknown"))
    got = {(r.feature_name, r.issue_month): r for r in dashboard.feature_drift_view(rows, rollup(spark)).collect()}
    assert [got["dti", f"2019-0{i}"].status for i in (1, 2, 3)] == ["Baseline", "Baseline", "Stable"]
    assert (got["unknown", "2019-01"].feature_label, got["unknown", "2019-01"].feature_group) == ("unknown", "Other")


def test_cutoff_table(spark):
    bands = spark.createDataFrame(
        [("m", "t", 1, "36 months", 10, 8), ("m", "t", 1, "60 months", 10, 4), ("m", "t", 2, "36 months", 20, 2)],
        "model_version string, split string, risk_band long, loan_term string, loans long, defaults long")
    rows = dashboard.cutoff_what_if(bands).orderBy("decline_pct").collect()
    assert (rows[0].declined_loans, rows[0].defaults_avoided, rows[0].good_turned_away) == (20, 12, 8)
    assert rows[0].approval_rate == 0.5 and rows[0].approved_default_rate == 0.1
    assert rows[1].approved_default_rate is None and rows[1].share_of_defaults_caught == 1.0
    assert dashboard.cutoff_what_if(bands, "60 months").count() == 1


def test_approximate_percentiles_agree(spark):
    rows = spark.range(2000).select(
        F.lit(TS).cast("timestamp").alias("ts"), F.lit("m").alias("model_version"), F.lit("test").alias("split"),
        F.col("id").cast("string").alias("loan_id"), F.lit("2019-01-01").cast("date").alias("issue_date"),
        (F.col("id") / 2000).alias("p_default"))
    exact, sketch = drift.score_drift(rows, TS).first(), drift.score_drift(rows, TS, accuracy=1000).first()
    assert exact.p50 == pytest.approx(sketch.p50, abs=0.002) and exact.p99 == pytest.approx(sketch.p99, abs=0.002)
    assert (exact.p50, exact.p90, exact.p99) == (999 / 2000, 1799 / 2000, 1979 / 2000)


def test_drift_joins_only_days_that_were_scored(spark):
    days = [datetime.date(2020, month, 1) for month in range(1, 7)]
    kinds = {c: "double" for c in drift.DRIFT_NUMERIC} | {c: "string" for c in drift.DRIFT_CATEGORICAL}
    schema = "loan_id string, issue_date date, " + ", ".join(f"{c} {kind}" for c, kind in kinds.items())
    loans = spark.createDataFrame([(str(i), day, *[None] * len(kinds)) for i, day in enumerate(days)], schema)
    runs = spark.createDataFrame(
        [("m", "valid", "2", days[2]), ("m", "test", "3", days[3]), ("m", "test", "5", days[0]), ("m", "test", "4", None)],
        "model_version string, split string, loan_id string, issue_date date")
    base = drift.drift_base(runs, loans, "m")
    assert sorted((r.split, r.issue_month) for r in base.collect()) == [("test", "2020-04"), ("valid", "2020-03")]
    assert "<= 2020-04-01" in base._jdf.queryExecution().optimizedPlan().toString()
    assert drift.drift_base(runs.where("false"), loans, "m").count() == 0

"""One DuckDB statement per registered query."""

from __future__ import annotations

from arrears.plans.book import FEATURE_SET_WEIGHTS, INTERCEPT, NUMERIC_WEIGHTS
from oracles.tables import (
    ALERTS, BOOK, DASH, FEATURE_DRIFT, LABELS, METRICS, MODEL_NUMERIC, MODEL_TEXT, MONTH,
    NUMBERS, PREDICTIONS, ROLLUPS, SCORE_DRIFT, STAGED, TEXTS, metrics_ctes, rounded, with_tables)
from oracles.validation import report

DOUBLES = [c for c, _ in NUMBERS]
CLEAN_OTHER = ["loan_id", "issue_date", "term_months", *TEXTS, "label", "credit_history_years"]
SCORES = (BOOK, PREDICTIONS)
DRIFTS = (*SCORES, SCORE_DRIFT, FEATURE_DRIFT)
EVERYTHING = (*DRIFTS, ROLLUPS, METRICS, LABELS, ALERTS, DASH)
ROLLUP_FIGURES = ["base_rate", *[f"{kind}_{k}" if kind != "top" else f"top_{k}_default_rate"
                                 for kind in ("top", "lift_at", "recall_at") for k in ("1pct", "5pct", "10pct")]]
METRIC_FIGURES = ["roc_auc", "pr_auc", "brier", "base_rate", *ROLLUP_FIGURES[1:]]


def _mean(n: str = "n") -> str:
    values = f"round({n} * (1 - null_rate))"
    return f"round(mean * {values}, 5) / nullif({values}, 0) AS mean"


TREND = ["predicted_default_rate", "actual_default_rate", "median_pd", "p90_pd"]

DRIFT_FIGURES = (f"{rounded(['null_rate', 'top_category_share', 'entropy'], 9)}, {_mean()}, "
                 f"{rounded(['std', 'min', 'max'], 3)}")

_out: dict[str, str] = {}


def _add(name: str, tables: tuple[str, ...], select: str) -> None:
    _out[name] = f"{with_tables(*tables)}\n{select}"


# --- Sources and the feature build ------------------------------------------------------------------------------------

_add("ingest_raw_strings", (BOOK,), """SELECT id, loan_amnt, term, int_rate, issue_d, earliest_cr_line, emp_length,
  revol_util, loan_status FROM raw""")
_add("read_csv_by_split", (BOOK,), """SELECT loan_id, CAST(issue_date AS VARCHAR) AS issue_date,
  CAST(label AS VARCHAR) AS label, split FROM features WHERE split = 'valid'""")
_add("read_one_split", (BOOK,), f"SELECT loan_id, issue_date, {rounded(['dti'])}, term_months, grade "
     "FROM features WHERE split = 'test'")
_add("stage_loans", (BOOK,),
     f"SELECT {', '.join(c for c in STAGED if c not in DOUBLES)}, {rounded(DOUBLES)} FROM staged")
_add("label_loans", (BOOK,), "SELECT loan_id, issue_date, loan_status, label FROM labelled")
_add("dedupe_loans", (BOOK,), f"SELECT loan_id, issue_date, loan_status, label, {rounded(['loan_amount'])} FROM dedup")
_add("clean_loans", (BOOK,), f"SELECT {', '.join(CLEAN_OTHER)}, {rounded(DOUBLES)} FROM clean")
_add("cut_dates", (BOOK,), "SELECT valid_from, test_from FROM cuts")
_add("time_split", (BOOK,), """SELECT split, count(*) AS loans, min(issue_date) AS first_date,
  max(issue_date) AS last_date, round(avg(label), 9) + 0.0 AS default_rate FROM features GROUP BY split""")
_add("build_features", (BOOK,), f"SELECT {', '.join(CLEAN_OTHER)}, split, {rounded(DOUBLES)} FROM features")
_add("build_features_with_line_date", (BOOK,), """SELECT f.loan_id, f.issue_date, d.earliest_cr_line_date,
  f.credit_history_years, f.split FROM features f JOIN dedup d USING (loan_id)""")
_add("monthly_default_rate", (BOOK,), """SELECT split, strftime(issue_date, '%Y-%m') AS issue_month, count(*) AS loans,
  round(avg(label), 9) + 0.0 AS default_rate FROM features GROUP BY ALL""")
_add("reconcile_features", (BOOK, """
clean_b AS (SELECT * FROM clean WHERE issue_date <= DATE '2001-03-01'),
cuts_b AS (SELECT quantile_disc(issue_date, 0.8) AS a, quantile_disc(issue_date, 0.9) AS b FROM clean_b),
features_b AS (SELECT clean_b.*, CASE WHEN issue_date < a THEN 'train' WHEN issue_date < b THEN 'valid' ELSE 'test' END
  AS split FROM clean_b, cuts_b),
pair AS (SELECT l, r FROM features l FULL JOIN features_b r ON l.loan_id = r.loan_id)"""), """
SELECT 'rows_left' AS measure, (SELECT count(*) FROM features) AS loans
UNION ALL SELECT 'rows_right', (SELECT count(*) FROM features_b)
UNION ALL SELECT 'only_left', count(*) FROM features WHERE loan_id NOT IN (SELECT loan_id FROM features_b)
UNION ALL SELECT 'only_right', count(*) FROM features_b WHERE loan_id NOT IN (SELECT loan_id FROM features)
UNION ALL SELECT 'repeated_keys', count(*) FROM (SELECT loan_id FROM features GROUP BY loan_id HAVING count(*) > 1)
""" + "".join(f"""UNION ALL SELECT 'mismatch_{c}', count(*) FROM features a JOIN features_b b USING (loan_id)
WHERE a.{c} IS DISTINCT FROM b.{c}
""" for c in ("issue_date", "label", "loan_amount", "split")))

# --- Data tests and validation ----------------------------------------------------------------------------------------

_add("test_unique", (BOOK,), "SELECT loan_id, count(*) AS n_records FROM staged GROUP BY loan_id HAVING count(*) > 1")
_add("test_not_null", (BOOK,), " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) AS n_records FROM labelled WHERE {c} IS NULL HAVING count(*) > 0"
    for c in ("loan_id", "issue_date", "label", "loan_amount", "revol_util")))
_add("test_accepted_values", (BOOK,), """SELECT grade, count(*) AS n_records FROM features
  WHERE grade NOT IN ('A', 'B', 'C', 'D') GROUP BY grade""")
_add("test_split_order", (BOOK, """
bounds AS (SELECT split, min(issue_date) AS first_date, max(issue_date) AS last_date FROM features GROUP BY split)"""),
     """SELECT a.split AS earlier_split, b.split AS later_split, a.last_date, b.first_date,
  a.last_date >= b.first_date AS broken
  FROM bounds a JOIN bounds b ON (a.split = 'train' AND b.split = 'valid') OR (a.split = 'valid' AND b.split = 'test')""")
_add("test_maturity", (BOOK,), "SELECT loan_id, issue_date FROM staged WHERE issue_date > DATE '2001-06-01'")
_add("test_fico_range", (BOOK,), f"""SELECT loan_id, {rounded(['fico_low', 'fico_high'])} FROM features
  WHERE fico_low NOT BETWEEN 300 AND 850 OR fico_high NOT BETWEEN 300 AND 850""")
_add("data_tests", (BOOK, """
bounds AS (SELECT split, min(issue_date) AS first_date, max(issue_date) AS last_date FROM features GROUP BY split)"""),
     " UNION ALL ".join([
         *[f"SELECT 'not_null' AS test, '{c}' AS subject, count(*) AS failures FROM features WHERE {c} IS NULL"
           for c in ("loan_id", "issue_date", "label", "split")],
         *[f"SELECT 'accepted_values', '{c}', count(*) FROM features WHERE {c} NOT IN ({v})"
           for c, v in (("label", "0, 1"), ("term_months", "36, 60"), ("split", "'train', 'valid', 'test'"))],
         "SELECT 'maturity_guard', 'issue_date', count(*) FROM features WHERE issue_date > DATE '2001-06-01'",
         "SELECT 'fico_range', 'fico', count(*) FROM features WHERE fico_low NOT BETWEEN 300 AND 850 "
         "OR fico_high NOT BETWEEN 300 AND 850",
         "SELECT 'unique', 'loan_id', count(*) FROM (SELECT loan_id FROM features GROUP BY loan_id HAVING count(*) > 1)",
         "SELECT 'split_order', 'issue_date', count(*) FROM bounds a JOIN bounds b ON ((a.split = 'train' AND "
         "b.split = 'valid') OR (a.split = 'valid' AND b.split = 'test')) AND a.last_date >= b.first_date",
     ]))

_REPORT = 'SELECT "check", severity, subject, round(value, 9) + 0.0 AS value, message FROM v_report'
_add("validation_report", (BOOK, report("SELECT * FROM features", True)), _REPORT)
_add("validation_full_size", (BOOK, report("SELECT * FROM features", False)), _REPORT)
_columns = ", ".join(["loan_id", "issue_date", "label",
                      *[c for c in MODEL_NUMERIC if c != "credit_history_years"], *MODEL_TEXT])
_add("validation_broken_splits", (BOOK, report(f"""
  SELECT 'train' AS split, {_columns}, CASE WHEN grade = 'A' THEN 5 END AS credit_history_years FROM labelled
  UNION ALL SELECT split, {_columns}, credit_history_years FROM features WHERE split = 'valid'
  UNION ALL SELECT 'test', {_columns}, credit_history_years FROM features WHERE split <> 'train'""", True)), _REPORT)
_add("validation_unexpected_terms", (BOOK, report("""
  SELECT * REPLACE (CASE WHEN grade = 'G' THEN term_months + 12 ELSE term_months END AS term_months) FROM features""",
                                                  True)), _REPORT + " WHERE \"check\" = 'allowed'")

# --- Run history and drift --------------------------------------------------------------------------------------------

_add("latest_predictions", SCORES,
     f"SELECT ts, model_version, split, loan_id, issue_date, {rounded(['p_default'])} FROM latest")
_add("latest_alert_run", (*DRIFTS, ALERTS), """SELECT ts, alert_type, model_version, count(*) AS alerts
  FROM (SELECT * FROM alert_log QUALIFY ts = max(ts) OVER (PARTITION BY alert_type)) GROUP BY ALL""")
_add("current_model", (*SCORES, ROLLUPS), """SELECT model_version, split, n FROM rollups
  WHERE model_version = (SELECT model_version FROM rollups ORDER BY ts DESC, model_version DESC LIMIT 1)""")
_add("upsert_score_drift", (*SCORES, SCORE_DRIFT), f"SELECT {MONTH}, ts, n FROM score_drift")
_add("append_positional", SCORES, """SELECT CAST(ts AS DATE) AS run_date, model_version, split, count(*) AS loans,
  count(p_default) AS scored, count(issue_date) AS dated, round(avg(p_default), 9) + 0.0 AS avg_pd
  FROM predictions GROUP BY ALL""")
_add("score_drift_months", (*SCORES, SCORE_DRIFT),
     f"SELECT ts, {MONTH}, n, {rounded(['avg_pd', 'p50', 'p90', 'p99'], 9)} FROM drift_new")
_add("score_drift_table", (*SCORES, SCORE_DRIFT),
     f"SELECT ts, {MONTH}, n, {rounded(['avg_pd', 'p50', 'p90', 'p99'], 9)} FROM score_drift")
_add("numeric_drift_stats", DRIFTS, f"""SELECT {MONTH}, feature_name, feature_type, n, {rounded(['null_rate'], 9)},
  {_mean()}, {rounded(['std', 'min', 'max'], 3)} FROM num_drift WHERE model_version = 'v2'""")
_add("categorical_drift_stats", DRIFTS, f"""SELECT {MONTH}, feature_name, feature_type, n, top_category,
  {rounded(['null_rate', 'top_category_share', 'entropy'], 9)} FROM cat_drift WHERE model_version = 'v2'""")
_add("feature_drift_table", DRIFTS,
     f"SELECT ts, {MONTH}, feature_name, feature_type, n, top_category, {DRIFT_FIGURES} FROM feature_drift")
_add("feature_drift_values_only", DRIFTS, f"""
SELECT TIMESTAMP '2001-08-02 01:00:00' AS ts, {MONTH}, feature_name, 'numeric' AS feature_type, count(v) AS n,
  0.0::DOUBLE AS null_rate, round(avg(v) * count(v), 5) / count(v) AS mean, round(stddev_samp(v), 3) + 0.0 AS std,
  round(min(v), 3) + 0.0 AS min, round(max(v), 3) + 0.0 AS max, NULL::VARCHAR AS top_category,
  NULL::DOUBLE AS top_category_share, NULL::DOUBLE AS entropy
FROM num_long WHERE model_version = 'v2' AND v IS NOT NULL GROUP BY {MONTH}, feature_name
UNION ALL
SELECT TIMESTAMP '2001-08-02 01:00:00', {MONTH}, feature_name, feature_type, CAST(seen AS BIGINT), 0.0, NULL, NULL, NULL,
  NULL, top_category, round(top_category_share, 9) + 0.0, round(entropy, 9) + 0.0
FROM cat_drift JOIN cat_totals USING ({MONTH}, feature_name) WHERE model_version = 'v2' AND seen > 0""")

# --- Ranking quality and calibration ----------------------------------------------------------------------------------

_add("percent_ranks", (*SCORES, ROLLUPS), """SELECT model_version, split, round(p_default, 9) + 0.0 AS p_default,
  count(*) AS n, round(max(pr), 9) + 0.0 AS pct_rank FROM ranked GROUP BY model_version, split, ranked.p_default""")
_add("ranking_rollup", (*SCORES, ROLLUPS), f"""SELECT TIMESTAMP '2001-08-02 01:00:00' AS ts, model_version, split, n,
  {rounded(ROLLUP_FIGURES, 9)} FROM rollups""")
_add("binary_metrics_by_run", (*SCORES, METRICS),
     f"SELECT model_version, split, n, {rounded(METRIC_FIGURES, 9)} FROM metrics_figures")
_add("exact_top_k", (*SCORES, METRICS), """SELECT model_version, split, k_1pct, k_5pct, k_10pct, top_1pct_defaults,
  top_5pct_defaults, top_10pct_defaults FROM metrics""")
_add("metrics_rows", (*SCORES, METRICS), """SELECT TIMESTAMP '2001-08-02 01:00:00' AS ts, model_version, split,
  round(roc_auc, 9) + 0.0 AS roc_auc, round(pr_auc, 9) + 0.0 AS pr_auc, round(brier, 9) + 0.0 AS brier,
  round(lift_at_5pct, 9) + 0.0 AS json_lift_at_5pct, """ + ", ".join(
      f"round(top_{k}_default_rate, 9) + 0.0 AS top_{k}_precision, round(recall_at_{k}, 9) + 0.0 AS top_{k}_recall"
      for k in ("1pct", "5pct", "10pct")) + " FROM metrics_figures")
_add("rank_documents", ("""
rated AS (SELECT doc_id, lang, CAST(n_chars AS DOUBLE) AS score, CAST(quality AS BIGINT) AS label
  FROM labels JOIN documents USING (doc_id) WHERE quality IS NOT NULL)""",
                        metrics_ctes("rated", "lang", "score", "doc_id", "dm")),
     "SELECT lang, n, round(roc_auc, 9) + 0.0 AS roc_auc, round(pr_auc, 9) + 0.0 AS pr_auc, "
     "round(base_rate, 9) + 0.0 AS base_rate, " + ", ".join(
         f"round(top_{k}_defaults / k_{k}, 9) + 0.0 AS top_{k}_default_rate, "
         f"round(coalesce((top_{k}_defaults / k_{k}) / nullif(base_rate, 0), 0), 9) + 0.0 AS lift_at_{k}, "
         f"round(top_{k}_defaults / greatest(1, pos), 9) + 0.0 AS recall_at_{k}" for k in ("1pct", "5pct", "10pct"))
     + " FROM dm")
_edges = ", ".join(f"quantile_cont(p_default, {i / 10}) AS e{i}" for i in range(1, 10))
_bin = " + ".join(f"CASE WHEN e{i} < p_default THEN 1 ELSE 0 END" for i in range(1, 10))
_add("reliability_bins", (*SCORES, f"""
edges AS (SELECT model_version, split, {_edges} FROM scored GROUP BY model_version, split)"""),
     f"""SELECT model_version, split, CAST({_bin} AS BIGINT) AS bin, count(*) AS loans,
  round(avg(p_default), 9) + 0.0 AS mean_predicted, round(avg(label), 9) + 0.0 AS observed_rate
  FROM scored JOIN edges USING (model_version, split) GROUP BY ALL""")
_add("brier_skill_by_run", (*SCORES, """
skill AS (SELECT model_version, split, avg(label) AS base_rate, avg(pow(p_default - label, 2)) AS brier
  FROM scored GROUP BY model_version, split)"""), """SELECT model_version, split, round(base_rate, 9) + 0.0 AS base_rate,
  round(brier, 9) + 0.0 AS brier, round(base_rate * (1 - base_rate), 9) + 0.0 AS brier_ceiling,
  round(1 - brier / nullif(base_rate * (1 - base_rate), 0), 9) + 0.0 AS brier_skill FROM skill""")
_add("income_quantiles", (BOOK,), "SELECT grade, " + ", ".join(
    f"round(quantile_cont(annual_income, {q}), 4) + 0.0 AS {n}" for n, q in (("p10", 0.1), ("median", 0.5), ("p95", 0.95)))
     + " FROM features GROUP BY grade")
_add("income_quantiles_discrete", (BOOK,), """SELECT grade, round(quantile_disc(annual_income, 0.5), 6) + 0.0 AS p50,
  round(quantile_disc(annual_income, 0.9), 6) + 0.0 AS p90 FROM features GROUP BY grade""")
_add("rank_correlation", (BOOK, """
r AS (SELECT split, open_acc AS x, total_acc AS y,
  rank() OVER (PARTITION BY split ORDER BY open_acc) + (count(*) OVER (PARTITION BY split, open_acc) - 1) / 2 AS rx,
  rank() OVER (PARTITION BY split ORDER BY total_acc) + (count(*) OVER (PARTITION BY split, total_acc) - 1) / 2 AS ry
  FROM features WHERE open_acc IS NOT NULL AND total_acc IS NOT NULL)"""),
     """SELECT split, count(*) AS rows, count(DISTINCT x) AS distinct_x, count(DISTINCT y) AS distinct_y,
  round(corr(rx, ry), 9) + 0.0 AS rho FROM r GROUP BY split""")

# --- Alerts and dashboards --------------------------------------------------------------------------------------------

for _name, _table in (("alert_score_p90", "alert_p90"), ("alert_numeric_mean", "alert_mean"),
                      ("alert_categorical_share", "alert_share")):
    _add(_name, (*DRIFTS, ALERTS), f"""SELECT ts, model_version, split, issue_month, alert_type, entity,
  {rounded(['value', 'threshold'], 9)}, severity, details FROM {_table}""")
_add("feature_labels", (*DRIFTS, LABELS), """SELECT feature_name, feature_label, feature_group,
  CAST(sum(n) AS BIGINT) AS values_seen FROM labels_table LEFT JOIN feature_drift USING (feature_name) GROUP BY ALL""")
_add("dash_scored", EVERYTHING, f"""SELECT model_version, split, loan_id, issue_month, term_months,
  {rounded(['p_default'])}, label FROM dash_scored""")
_add("dash_risk_bands", EVERYTHING, f"""SELECT model_version, split, risk_band, loan_term, loans, defaults, repaid,
  {rounded(['predicted_defaults', 'min_pd', 'max_pd'])} FROM risk_bands""")
_add("dash_score_trend", EVERYTHING,
     f"SELECT model_version, split, month_start, issue_month, loans, {rounded(TREND, 9)} FROM score_trend")
_out["export_score_trend"] = _out["dash_score_trend"]
_add("dash_feature_drift", EVERYTHING, f"""SELECT model_version, split, month_start, issue_month, feature_name,
  feature_label, feature_group, feature_type, loans, {rounded(['null_rate'], 9)}, {_mean('loans')}, top_category,
  {rounded(['top_category_share', 'change_vs_prev_month', 'change_vs_first_month'], 9)}, change_measure, status
  FROM drift_view""")
_add("dash_alerts", EVERYTHING, f"""SELECT checked_at, model_version, split, period, month_start, issue_month, alert_type,
  severity, severity_rank, what_changed, message, {rounded(['value', 'threshold'], 9)}, technical_details FROM alert_words""")
_add("dash_summary", EVERYTHING, f"""SELECT model_version, split, refreshed_at, loans, {rounded([
    'actual_default_rate', 'predicted_default_rate', 'top_5pct_default_rate', 'lift_at_1pct', 'lift_at_5pct',
    'lift_at_10pct', 'recall_at_1pct', 'recall_at_5pct', 'recall_at_10pct', 'roc_auc', 'pr_auc', 'brier'], 9)},
  critical_alerts, warning_alerts, status, headline, tile_lift, tile_capture, tile_calibration FROM summary_words""")


def _what_if(where: str) -> str:
    return f"""
per_band AS (SELECT model_version, split, risk_band, sum(loans) AS loans, sum(defaults) AS defaults FROM risk_bands
  {where} GROUP BY ALL),
what_if AS (SELECT model_version, split, risk_band AS decline_pct, sum(loans) OVER b AS declined,
  sum(defaults) OVER b AS avoided, sum(loans) OVER s AS loans, sum(defaults) OVER s AS defaults,
  defaults / loans AS band_default_rate FROM per_band
  WINDOW s AS (PARTITION BY model_version, split), b AS (PARTITION BY model_version, split ORDER BY risk_band))"""


_WHAT_IF = """SELECT model_version, split, decline_pct, CAST(declined AS BIGINT) AS declined_loans,
  CAST(avoided AS BIGINT) AS defaults_avoided, CAST(declined - avoided AS BIGINT) AS good_turned_away,
  round((loans - declined) / loans, 9) + 0.0 AS approval_rate,
  round((defaults - avoided) / nullif(loans - declined, 0), 9) + 0.0 AS approved_default_rate,
  round(avoided / nullif(defaults, 0), 9) + 0.0 AS share_of_defaults_caught,
  round(band_default_rate, 9) + 0.0 AS band_default_rate FROM what_if"""
_add("cutoff_what_if", (*EVERYTHING, _what_if("")), _WHAT_IF)
_add("cutoff_what_if_long_term", (*EVERYTHING, _what_if("WHERE loan_term = '60 months'")), _WHAT_IF)
_add("refresh_monitoring", (BOOK,), """
SELECT TIMESTAMP '2001-08-02 00:00:00' AS ts, 'v3' AS model_version, split, strftime(issue_date, '%Y-%m') AS issue_month,
  count(*) AS n, round(avg(p), 9) + 0.0 AS avg_pd, round(quantile_disc(p, 0.5), 9) + 0.0 AS p50,
  round(quantile_disc(p, 0.9), 9) + 0.0 AS p90, round(quantile_disc(p, 0.99), 9) + 0.0 AS p99
FROM (SELECT split, issue_date, CAST((37 * CAST(loan_id AS BIGINT)) % 200 AS DOUBLE) / 400 AS p FROM features
      WHERE split IN ('valid', 'test')) GROUP BY split, issue_month""")

# --- Implied rate -----------------------------------------------------------------------------------------------------

_RATES = """
bisect(i, loan_id, a, p, n, stated, grade, lo, hi) AS (
  SELECT 0, loan_id, loan_amount, installment, CAST(term_months AS DOUBLE), interest_rate, grade,
         CAST(1e-9 AS DOUBLE), CAST(0.2 AS DOUBLE) FROM features
  UNION ALL
  SELECT i + 1, loan_id, a, p, n, stated, grade,
    CASE WHEN a * ((lo + hi) / 2) / (1 - pow(1 + (lo + hi) / 2, -n)) > p THEN lo ELSE (lo + hi) / 2 END,
    CASE WHEN a * ((lo + hi) / 2) / (1 - pow(1 + (lo + hi) / 2, -n)) > p THEN (lo + hi) / 2 ELSE hi END
  FROM bisect WHERE i < 80
),
solved AS (
  SELECT loan_id, grade, stated, CASE WHEN p > a / n AND n > 0 THEN (lo + hi) / 2 * 1200 END AS implied
  FROM bisect WHERE i = 80
),
checked AS (SELECT *, abs(implied - stated) AS err FROM solved)"""
_add("implied_rate", (BOOK, _RATES), """SELECT loan_id, round(implied, 4) + 0.0 AS implied_rate,
  round(err, 4) + 0.0 AS abs_error FROM checked""")
_add("implied_rate_report", (BOOK, _RATES), """SELECT count(*) AS rows, count(err) AS rows_solved,
  round_even(corr(implied, stated) FILTER (err IS NOT NULL), 4) AS pearson_implied_vs_actual,
  round_even(quantile_cont(err, 0.5), 4) AS median_abs_error_pct_points,
  round_even(quantile_cont(err, 0.95), 4) AS p95_abs_error_pct_points,
  round_even(avg(CASE WHEN err <= 0.1 THEN 1.0 ELSE 0.0 END) FILTER (err IS NOT NULL), 4) AS share_within_0_1_pct_points
  FROM checked""")
_add("implied_rate_by_grade", (BOOK, _RATES), """SELECT grade, round_even(avg(implied), 2) AS mean_implied_rate FROM checked
  WHERE err IS NOT NULL AND grade IS NOT NULL GROUP BY grade""")

# --- Reason codes -----------------------------------------------------------------------------------------------------

GROUPS = {
    "credit_score": ("R01", ["fico_low", "fico_high"]), "debt_to_income": ("R02", ["dti"]),
    "loan_vs_income": ("R03", ["loan_amount", "annual_income"]), "revolving_use": ("R04", ["revol_util"]),
    "recent_inquiries": ("R05", ["inq_last_6mths"]), "delinquency": ("R06", ["delinq_2yrs"]),
    "public_records": ("R07", ["pub_rec"]), "history_length": ("R08", ["credit_history_years"]),
    "housing": ("R14", ["home_ownership"])}
TEXT_OF = {
    "R01": "Credit score is lower than for approved applicants",
    "R02": "Existing debt payments are high relative to income",
    "R03": "Requested loan or monthly payment is high relative to income",
    "R04": "High balances or utilisation on revolving credit", "R05": "Several recent applications for credit",
    "R06": "Recent history of late payments", "R07": "Public record on credit file",
    "R08": "Limited length of credit history", "R14": "Housing status"}


def _linear(feature_set: str) -> str:
    """Slots, folded and grouped contributions of the linear model."""
    levels = [(c, level, w) for c, ws in FEATURE_SET_WEIGHTS[feature_set].items() for level, w in ws.items()]
    flag = {i: f"(CASE WHEN {c} = '{level}' THEN 1.0::DOUBLE ELSE 0 END)" for i, (c, level, _) in enumerate(levels)}
    means = [f"avg(CAST({c} AS DOUBLE)) AS m_{c}" for c in NUMERIC_WEIGHTS] + [f"avg({flag[i]}) AS l_{i}" for i in flag]
    slots = [f"(coalesce(CAST({c} AS DOUBLE), m_{c}) - m_{c}) * ({w!r}::DOUBLE) AS slot_{i}"
             for i, (c, w) in enumerate(NUMERIC_WEIGHTS.items())]
    first = len(slots)
    slots += [f"({flag[i]} - l_{i}) * ({w!r}::DOUBLE) AS slot_{first + i}" for i, (_, _, w) in enumerate(levels)]
    parts = [f"coalesce(CAST({c} AS DOUBLE), m_{c}) * ({w!r}::DOUBLE)" for c, w in NUMERIC_WEIGHTS.items()]
    parts += [f"{flag[i]} * ({w!r}::DOUBLE)" for i, (_, _, w) in enumerate(levels)]
    bias = [f"m_{c} * ({w!r}::DOUBLE)" for c, w in NUMERIC_WEIGHTS.items()]
    bias += [f"l_{i} * ({w!r}::DOUBLE)" for i, (_, _, w) in enumerate(levels)]
    folded = [f"slot_{i} AS phi_{c}" for i, c in enumerate(NUMERIC_WEIGHTS)]
    for c in FEATURE_SET_WEIGHTS[feature_set]:
        folded.append(" + ".join(f"slot_{first + i}" for i, (o, _, _) in enumerate(levels) if o == c) + f" AS phi_{c}")
    groups = [f"{' + '.join('phi_' + c for c in inputs)} AS grp_{g}" for g, (_, inputs) in GROUPS.items()]
    groups += ["phi_term_months AS grp_loan_term", "phi_initial_list_status AS grp_listing_type"]
    if "grade" in FEATURE_SET_WEIGHTS[feature_set]:
        groups.append("phi_grade AS grp_lc_assessment")
    return f"""
lin_means AS (SELECT {", ".join(means)} FROM features WHERE split = 'train'),
lin_slots AS (
  SELECT f.*, {", ".join(slots)}, ({INTERCEPT}::DOUBLE) + {" + ".join(parts)} AS margin,
         ({INTERCEPT}::DOUBLE) + {" + ".join(bias)} AS bias
  FROM features f, lin_means WHERE split IN ('valid', 'test')
),
lin AS (SELECT *, 1 / (1 + exp(-margin)) AS p_default, {", ".join(folded)} FROM lin_slots),
lin_cut AS (SELECT quantile_cont(p_default, 0.9) AS cutoff FROM lin),
lin_groups AS (SELECT *, p_default >= cutoff AS declined, {", ".join(groups)} FROM lin, lin_cut),
declines AS (SELECT * FROM lin_groups WHERE declined),
reasons_long AS (
  SELECT loan_id, code, v, row_number() OVER (PARTITION BY loan_id ORDER BY v DESC, code) AS nth FROM (
    {" UNION ALL ".join(f"SELECT loan_id, '{code}' AS code, grp_{g} AS v FROM declines" for g, (code, _) in GROUPS.items())}
  ) WHERE v > 0.02
),
reasons_wide AS (
  SELECT loan_id, least(count(*), 4) AS n_reasons, {", ".join(
      f"max(code) FILTER (nth = {i}) AS reason_{i}_code, max(round_even(v, 4)) FILTER (nth = {i}) AS reason_{i}_logodds"
      for i in range(1, 5))}
  FROM reasons_long GROUP BY loan_id
),
offers AS (
  SELECT *, 1 / (1 + exp(-(margin - ({NUMERIC_WEIGHTS['term_months']!r}::DOUBLE) * (term_months - 36)))) AS p_short
  FROM declines
),
offered AS (
  SELECT loan_id, term_months, round_even(grp_loan_term, 4) AS term_logodds, grp_loan_term > 0.02 AS noted,
         CASE WHEN term_months > 36 THEN round_even(p_short, 4) END AS p_default_36m,
         term_months > 36 AND p_short < cutoff AS qualifies_at_36m
  FROM offers
)"""


STRICT, FULL = _linear("no_lc_strict"), _linear("full")
_n_slots = len(NUMERIC_WEIGHTS) + sum(len(v) for v in FEATURE_SET_WEIGHTS["full"].values())
_text = " ".join(f"WHEN '{code}' THEN '{text}'" for code, text in TEXT_OF.items())
_add("decline_rule", (BOOK, STRICT), f"SELECT loan_id, {rounded(['p_default', 'cutoff'])} FROM declines")
_add("linear_contributions", (BOOK, FULL),
     f"SELECT loan_id, {rounded(['bias', 'margin', *[f'slot_{i}' for i in range(_n_slots)]])} FROM lin")
_add("folded_contributions", (BOOK, FULL),
     f"SELECT loan_id, {rounded([f'phi_{c}' for c in [*NUMERIC_WEIGHTS, *FEATURE_SET_WEIGHTS['full']]])} FROM lin")
_add("grouped_contributions", (BOOK, FULL), f"""SELECT loan_id, {rounded([
    f'grp_{g}' for g in [*GROUPS, 'loan_term', 'listing_type', 'lc_assessment']])} FROM lin_groups""")
_add("top_reasons", (BOOK, STRICT), """SELECT loan_id, issue_date, term_months,
  round(round_even(p_default, 4), 4) + 0.0 AS p_default, coalesce(n_reasons, 0) AS n_reasons, """ + ", ".join(
      f"reason_{i}_code, CASE reason_{i}_code {_text} END AS reason_{i}_text, reason_{i}_logodds + 0.0 AS reason_{i}_logodds"
      for i in range(1, 5)) + " FROM declines LEFT JOIN reasons_wide USING (loan_id)")
_add("top_reasons_full", (BOOK, FULL), """SELECT loan_id, coalesce(n_reasons, 0) AS n_reasons, reason_1_code,
  reason_2_code, reason_3_code, reason_4_code,
  CASE WHEN grp_loan_term > 0.02 THEN 'Longer repayment term increased risk' ELSE '' END AS term_note
  FROM declines LEFT JOIN reasons_wide USING (loan_id)""")
_add("term_counter_offer", (BOOK, STRICT), """SELECT loan_id, term_months, term_logodds + 0.0 AS term_logodds,
  CASE WHEN qualifies_at_36m THEN 'Counter-offer: would qualify on a 36-month term'
       WHEN noted THEN 'Longer repayment term increased risk' ELSE '' END AS term_note,
  p_default_36m + 0.0 AS p_default_36m, qualifies_at_36m FROM offered""")
_signs = {"fico_low": -1, "fico_high": -1, "dti": 1, "annual_income": -1, "loan_amount": 1, "revol_util": 1,
          "inq_last_6mths": 1, "delinq_2yrs": 1, "pub_rec": 1, "credit_history_years": -1, "term_months": 1}
_add("direction_check", (BOOK, STRICT, f"""
pairs AS ({" UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST({sign} AS BIGINT) AS expected_sign, CAST({c} AS DOUBLE) AS x, phi_{c} AS y FROM lin "
    f"WHERE {c} IS NOT NULL" for c, sign in _signs.items())}),
pair_ranks AS (SELECT *,
  rank() OVER (PARTITION BY feature ORDER BY x) + (count(*) OVER (PARTITION BY feature, x) - 1) / 2 AS rx,
  rank() OVER (PARTITION BY feature ORDER BY y) + (count(*) OVER (PARTITION BY feature, y) - 1) / 2 AS ry FROM pairs),
rho AS (SELECT feature, expected_sign, corr(rx, ry) AS rho FROM pair_ranks GROUP BY ALL
  HAVING count(*) >= 50 AND count(DISTINCT x) >= 3 AND count(DISTINCT y) >= 2)"""),
     """SELECT feature, round_even(rho, 3) + 0.0 AS spearman_value_vs_phi, expected_sign,
  sign(rho) = expected_sign AS consistent FROM rho""")


def _measure(name: str, value: str, source: str, digits: int) -> str:
    return (f"SELECT '{name}' AS measure, 'all' AS subject, round(round_even(CAST({value} AS DOUBLE), {digits}), 3) + 0.0 "
            f"AS value FROM {source}")


_every = " + ".join(f"abs(grp_{g})" for g in [*GROUPS, "loan_term", "listing_type"])
_rated = "(SELECT * FROM declines LEFT JOIN reasons_wide USING (loan_id))"
_add("reason_summary", (BOOK, STRICT), " UNION ALL ".join([
    _measure("rows_scored", "count(*)", "lin_groups", 4),
    _measure("pd_cutoff", "max(cutoff)", "lin_groups", 4),
    _measure("declined", "count(*)", "declines", 4),
    _measure("decline_rate", "avg(CASE WHEN declined THEN 1.0 ELSE 0 END)", "lin_groups", 4),
    _measure("declined_default_rate", "avg(label)", "declines", 4),
    _measure("share_all_on_longer_term", "avg(CASE WHEN term_months > 36 THEN 1.0 ELSE 0 END)", "lin_groups", 4),
    _measure("share_declined_with_no_reportable_reason", "avg(CASE WHEN n_reasons IS NULL THEN 1.0 ELSE 0 END)", _rated, 4),
    _measure("mean_reasons_per_decline", "avg(coalesce(n_reasons, 0))", _rated, 2),
    _measure("nonreportable_share_of_explanation", f"avg(abs(grp_listing_type) / nullif({_every}, 0))", "declines", 4),
    _measure("share_declined_on_longer_term", "avg(CASE WHEN term_months > 36 THEN 1.0 ELSE 0 END)", "declines", 4),
    _measure("share_declined_with_term_note", "avg(CASE WHEN noted THEN 1.0 ELSE 0 END)", "offered", 4),
    _measure("share_declined_qualifying_at_36m", "avg(CASE WHEN qualifies_at_36m THEN 1.0 ELSE 0 END)", "offered", 4),
    """SELECT 'reason_1_frequency', code, round(round_even(count(*) / (SELECT count(*) FROM reasons_wide), 3), 3) + 0.0
  FROM reasons_long WHERE nth = 1 GROUP BY code HAVING round_even(count(*) / (SELECT count(*) FROM reasons_wide), 3) > 0""",
    """SELECT 'reason_in_top_k_frequency', code, round(round_even(count(*) / (SELECT count(*) FROM declines), 3), 3) + 0.0
  FROM reasons_long WHERE nth <= 4 GROUP BY code""",
]))


def statements() -> dict[str, str]:
    return dict(_out)

"""Common table expressions: the stored tables of the loan book, written as SQL on the given tables."""

from __future__ import annotations

NUMBERS = [
    ("loan_amount", "loan_amnt"), ("interest_rate", "int_rate"), ("installment", "installment"),
    ("annual_income", "annual_inc"), ("dti", "dti"), ("fico_low", "fico_range_low"), ("fico_high", "fico_range_high"),
    ("open_acc", "open_acc"), ("total_acc", "total_acc"), ("pub_rec", "pub_rec"), ("delinq_2yrs", "delinq_2yrs"),
    ("inq_last_6mths", "inq_last_6mths"), ("revol_bal", "revol_bal"), ("revol_util", "revol_util"),
]
TEXTS = ["emp_length", "home_ownership", "verification_status", "purpose", "grade", "initial_list_status"]
STAGED = [
    "loan_id", "issue_date", "loan_status", "loan_amount", "interest_rate", "installment", "term_months",
    "annual_income", "dti", "emp_length", "home_ownership", "verification_status", "purpose", "fico_low", "fico_high",
    "open_acc", "total_acc", "pub_rec", "earliest_cr_line_date", "delinq_2yrs", "inq_last_6mths", "revol_bal",
    "revol_util", "grade", "initial_list_status",
]
TIE_BREAK = ", ".join(f"{c} NULLS FIRST" for c in STAGED[2:])
MODEL_NUMERIC = [
    "loan_amount", "interest_rate", "installment", "term_months", "annual_income", "dti", "fico_low", "fico_high",
    "open_acc", "total_acc", "pub_rec", "delinq_2yrs", "inq_last_6mths", "revol_bal", "revol_util",
    "credit_history_years"]
MODEL_TEXT = ["home_ownership", "grade", "purpose", "verification_status", "initial_list_status", "emp_length"]
DRIFT_NUMERIC = ["loan_amount", "interest_rate", "annual_income", "dti", "revol_bal", "revol_util", "total_acc"]
DRIFT_TEXT = ["home_ownership", "grade", "purpose", "verification_status", "initial_list_status"]
MONTH = "model_version, split, issue_month"

BOOK = f"""
lines AS (
  SELECT l_orderkey, count(*) AS lines, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity,
         CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS price_cents,
         CAST(sum(CAST(round(l_discount * 100) AS BIGINT)) AS BIGINT) AS discount_points
  FROM lineitem GROUP BY l_orderkey
),
book AS (
  SELECT o_orderkey AS k, o_custkey AS c, copy, o_orderstatus AS os, o_orderpriority AS priority, c_mktsegment, n_name,
         c_acctbal, lines, quantity, price_cents, discount_points,
         CASE WHEN o_orderkey % 4 = 0 THEN 60 ELSE 36 END AS months,
         round(o_totalprice / 12.5, 2) AS amount,
         5 + CAST(o_orderkey % 2600 AS DOUBLE) / 100 AS rate,
         CAST(date_trunc('month', o_orderdate) AS DATE) AS opened
  FROM orders
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN lines ON o_orderkey = l_orderkey
  CROSS JOIN (VALUES (0), (1), (2)) AS copies(copy)
  WHERE copy = 0 OR (copy = 1 AND o_orderkey % 97 = 0) OR (copy = 2 AND o_orderkey % 1009 = 0)
),
raw AS (
  SELECT CAST(k AS VARCHAR) AS id,
    CASE WHEN k % 89 = 0 THEN 'n/a' ELSE printf('%.2f', amount) END AS loan_amnt,
    ' ' || months || ' months' AS term,
    printf('%.2f', rate) AS int_rate,
    printf('%.2f', round(amount * (rate / 1200) / (1 - pow(1 + rate / 1200, -months)), 2)) AS installment,
    substr('ABCDEFG', CAST(1 + k % 7 AS INTEGER), 1) AS grade,
    CASE WHEN copy = 2 THEN 'unknown'
         WHEN copy = 1 THEN strftime(opened + INTERVAL 1 MONTH, '%b-%Y') ELSE strftime(opened, '%b-%Y') END AS issue_d,
    CASE WHEN k % 11 <> 0 THEN (k % 11) || ' years' END AS emp_length,
    c_mktsegment AS home_ownership,
    printf('%.2f', round(c_acctbal * 10, 2)) AS annual_inc,
    priority AS verification_status,
    n_name AS purpose,
    CASE WHEN k % 3 = 0 THEN 'f' ELSE 'w' END AS initial_list_status,
    CAST(620 + 5 * (k % 47) AS VARCHAR) AS fico_range_low,
    CAST(624 + 5 * (k % 47) AS VARCHAR) AS fico_range_high,
    CAST(lines AS VARCHAR) AS open_acc, CAST(quantity AS VARCHAR) AS total_acc, CAST(k % 3 AS VARCHAR) AS pub_rec,
    strftime(opened - to_months(CAST(12 * (2 + k % 30) AS INTEGER)), '%b-%Y') AS earliest_cr_line,
    CAST(k % 5 AS VARCHAR) AS delinq_2yrs, CAST(k % 7 AS VARCHAR) AS inq_last_6mths,
    CASE WHEN lines IS NOT NULL THEN printf('%.2f', price_cents / 100) END AS revol_bal,
    CASE WHEN lines IS NOT NULL THEN printf('%.4f', round(discount_points * 10 / lines, 4)) END AS revol_util,
    printf('%.2f', CAST((7 * c + k) % 11000 AS DOUBLE) / 100) AS dti,
    CASE WHEN os = 'O' THEN 'Current' WHEN os = 'P' AND priority = '1-URGENT' THEN 'Charged Off'
         WHEN os = 'P' AND priority = '2-HIGH' THEN 'Late (16-30 days)' ELSE 'Fully Paid' END AS loan_status
  FROM book
),
staged AS (
  SELECT id AS loan_id, CAST(try_strptime(issue_d, '%b-%Y') AS DATE) AS issue_date, loan_status,
    {", ".join(f"TRY_CAST({source} AS DOUBLE) AS {target}" for target, source in NUMBERS)},
    TRY_CAST(regexp_extract(term, '(\\d+)', 1) AS BIGINT) AS term_months,
    CAST(try_strptime(earliest_cr_line, '%b-%Y') AS DATE) AS earliest_cr_line_date,
    {", ".join(TEXTS)}
  FROM raw
),
labelled AS (
  SELECT *, CAST(CASE WHEN loan_status IN ('Charged Off', 'Default', 'Late (31-120 days)', 'Late (16-30 days)') THEN 1
                      WHEN loan_status = 'Fully Paid' THEN 0 END AS BIGINT) AS label
  FROM staged
),
dedup AS (
  SELECT * FROM labelled
  QUALIFY row_number() OVER (PARTITION BY loan_id ORDER BY issue_date NULLS FIRST, {TIE_BREAK}) = 1
),
clean AS (
  SELECT * EXCLUDE (loan_status, earliest_cr_line_date),
         year(issue_date) - year(earliest_cr_line_date) AS credit_history_years
  FROM dedup
  WHERE issue_date IS NOT NULL AND label IS NOT NULL AND term_months IS NOT NULL
    AND issue_date <= DATE '2001-06-01' AND annual_income > 0 AND dti BETWEEN 0 AND 100
),
cuts AS (SELECT quantile_disc(issue_date, 0.8) AS valid_from, quantile_disc(issue_date, 0.9) AS test_from FROM clean),
features AS (
  SELECT clean.*, CASE WHEN issue_date < valid_from THEN 'train' WHEN issue_date < test_from THEN 'valid'
                       ELSE 'test' END AS split
  FROM clean, cuts
)"""


def _run(version: str, valid: str, test: str, where: str, score: str, day: str) -> str:
    return f"""
  SELECT CASE WHEN split = 'valid' THEN TIMESTAMP '{valid}' ELSE TIMESTAMP '{test}' END AS ts,
         '{version}' AS model_version, split, loan_id, {day} AS issue_date, {score} AS p_default
  FROM features WHERE split IN ('valid', 'test'){where}"""


_SCORE = "CAST((37 * CAST(loan_id AS BIGINT)) % 200 AS DOUBLE) / 400"
PREDICTIONS = f"""
predictions AS ({_run("v1", "2001-07-01 00:00:00", "2001-07-01 00:05:00", "", _SCORE, "issue_date")}
  UNION ALL {_run("v2", "2001-08-01 00:00:00", "2001-08-01 00:05:00", "", _SCORE, "issue_date")}
  UNION ALL {_run(
      "v2", "2001-08-02 00:00:00", "2001-08-02 00:05:00",
      " AND revol_util IS NOT NULL AND issue_date < DATE '2001-06-01'",
      f"CASE WHEN annual_income <= 99000 THEN {_SCORE} + CASE WHEN issue_date >= DATE '2001-03-01' "
      "THEN CAST(0.06 AS DOUBLE) ELSE 0 END END",
      "CASE WHEN dti >= 1 THEN issue_date END")}
),
latest AS (
  SELECT * FROM predictions QUALIFY ts = max(ts) OVER (PARTITION BY model_version, split)
),
first_latest AS (
  SELECT * FROM predictions WHERE ts < TIMESTAMP '2001-08-02 00:00:00'
  QUALIFY ts = max(ts) OVER (PARTITION BY model_version, split)
),
scored AS (
  SELECT p.model_version, p.split, p.loan_id, p.p_default, f.label
  FROM latest p JOIN features f ON p.loan_id = f.loan_id
  WHERE p.p_default IS NOT NULL AND f.label IS NOT NULL
)"""


def _monthly(source: str, ts: str) -> str:
    return f"""SELECT TIMESTAMP '{ts}' AS ts, model_version, split, strftime(issue_date, '%Y-%m') AS issue_month,
    count(*) AS n, avg(p_default) AS avg_pd, quantile_disc(p_default, 0.5) AS p50,
    quantile_disc(p_default, 0.9) AS p90, quantile_disc(p_default, 0.99) AS p99
  FROM {source} WHERE issue_date IS NOT NULL AND p_default IS NOT NULL
  GROUP BY model_version, split, issue_month"""


SCORE_DRIFT = f"""
drift_new AS ({_monthly("latest", "2001-08-02 01:00:00")}),
drift_old AS ({_monthly("first_latest", "2001-08-01 01:00:00")}),
score_drift AS (
  SELECT * FROM drift_new
  UNION ALL SELECT * FROM drift_old o WHERE NOT EXISTS (
    SELECT 1 FROM drift_new n WHERE n.model_version = o.model_version AND n.split = o.split
      AND n.issue_month = o.issue_month)
)"""

FEATURE_DRIFT = f"""
cohort AS (
  SELECT DISTINCT model_version, split, loan_id, issue_date FROM predictions WHERE split IN ('valid', 'test')
),
drift_base AS (
  SELECT c.model_version, c.split, strftime(c.issue_date, '%Y-%m') AS issue_month,
         {", ".join("f." + c for c in DRIFT_NUMERIC + DRIFT_TEXT)}
  FROM cohort c JOIN features f ON c.loan_id = f.loan_id AND c.issue_date = f.issue_date
),
num_long AS ({" UNION ALL ".join(
    f"SELECT {MONTH}, '{c}' AS feature_name, {c} AS v FROM drift_base" for c in DRIFT_NUMERIC)}),
num_drift AS (
  SELECT {MONTH}, feature_name, 'numeric' AS feature_type, count(*) AS n,
         avg(CASE WHEN v IS NULL THEN 1.0 ELSE 0.0 END) AS null_rate, avg(v) AS mean, stddev_samp(v) AS std,
         min(v) AS min, max(v) AS max
  FROM num_long GROUP BY {MONTH}, feature_name
),
cat_long AS ({" UNION ALL ".join(
    f"SELECT {MONTH}, '{c}' AS feature_name, {c} AS v FROM drift_base" for c in DRIFT_TEXT)}),
cat_counts AS (SELECT {MONTH}, feature_name, v, count(*) AS cnt FROM cat_long GROUP BY ALL),
cat_totals AS (
  SELECT {MONTH}, feature_name, sum(cnt) AS n, coalesce(sum(cnt) FILTER (v IS NULL), 0) AS nulls,
         sum(cnt) FILTER (v IS NOT NULL) AS seen
  FROM cat_counts GROUP BY {MONTH}, feature_name
),
cat_entropy AS (
  SELECT {MONTH}, feature_name, -sum((cnt / seen) * ln(cnt / seen)) AS entropy
  FROM cat_counts JOIN cat_totals USING ({MONTH}, feature_name) WHERE v IS NOT NULL GROUP BY {MONTH}, feature_name
),
cat_top AS (
  SELECT {MONTH}, feature_name, v AS top_category, cnt AS top_cnt FROM cat_counts WHERE v IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY {MONTH}, feature_name ORDER BY cnt DESC, v DESC) = 1
),
cat_drift AS (
  SELECT {MONTH}, feature_name, 'categorical' AS feature_type, CAST(n AS BIGINT) AS n, nulls / n AS null_rate,
         top_category, top_cnt / seen AS top_category_share, entropy
  FROM cat_totals LEFT JOIN cat_top USING ({MONTH}, feature_name) LEFT JOIN cat_entropy USING ({MONTH}, feature_name)
),
feature_drift AS (
  SELECT CASE WHEN model_version = 'v1' THEN TIMESTAMP '2001-08-01 01:00:00'
              ELSE TIMESTAMP '2001-08-02 01:00:00' END AS ts, *
  FROM (SELECT * FROM num_drift UNION ALL BY NAME SELECT * FROM cat_drift)
)"""

_PCT = [("1pct", "0.01"), ("5pct", "0.05"), ("10pct", "0.10")]
ROLLUPS = f"""
ranked AS (
  SELECT *, percent_rank() OVER (PARTITION BY model_version, split ORDER BY p_default DESC) AS pr FROM scored
),
rollup_counts AS (
  SELECT model_version, split, count(*) AS n, avg(label) AS base_rate, sum(label) AS pos,
         {", ".join(f"count(*) FILTER (pr <= CAST({f} AS DOUBLE)) AS n_{s}, "
                    f"sum(label) FILTER (pr <= CAST({f} AS DOUBLE)) AS pos_{s}" for s, f in _PCT)}
  FROM ranked GROUP BY model_version, split
),
rollups AS (
  SELECT CASE WHEN model_version = 'v1' THEN TIMESTAMP '2001-08-01 01:00:00'
              ELSE TIMESTAMP '2001-08-02 01:00:00' END AS ts, model_version, split, n, base_rate,
         {", ".join(f"pos_{s} / nullif(n_{s}, 0) AS top_{s}_default_rate" for s, _ in _PCT)},
         {", ".join(f"(pos_{s} / nullif(n_{s}, 0)) / nullif(base_rate, 0) AS lift_at_{s}" for s, _ in _PCT)},
         {", ".join(f"pos_{s} / nullif(pos, 0) AS recall_at_{s}" for s, _ in _PCT)}
  FROM rollup_counts
)"""


def metrics_ctes(source: str, keys: str, score: str = "p_default", unique: str = "loan_id", name: str = "metrics") -> str:
    """Ranking metrics of ``source`` by plain window functions over single rows."""
    return f"""
{name}_rows AS (
  SELECT *, count(*) OVER g AS total_n, sum(label) OVER g AS total_pos,
    rank() OVER (PARTITION BY {keys} ORDER BY {score}) + (count(*) OVER (PARTITION BY {keys}, {score}) - 1) / 2 AS r,
    row_number() OVER (PARTITION BY {keys} ORDER BY {score} DESC, {unique}) AS rn,
    sum(label) OVER (PARTITION BY {keys} ORDER BY {score} DESC)
      / count(*) OVER (PARTITION BY {keys} ORDER BY {score} DESC) AS precision_here
  FROM {source} WINDOW g AS (PARTITION BY {keys})
),
{name} AS (
  SELECT {keys}, count(*) AS n, CAST(sum(label) AS BIGINT) AS pos,
    (sum(r) FILTER (label = 1) - sum(label) * (sum(label) + 1) / 2)
      / nullif(sum(label) * (count(*) - sum(label)), 0) AS roc_auc,
    sum(precision_here) FILTER (label = 1) / nullif(sum(label), 0) AS pr_auc,
    avg(pow({score} - label, 2)) AS brier, avg(label) AS base_rate,
    {", ".join(
        f"CAST(greatest(1, floor(max(total_n) * CAST({f} AS DOUBLE))) AS BIGINT) AS k_{s}, "
        f"CAST(coalesce(sum(label) FILTER (rn <= greatest(1, floor(total_n * CAST({f} AS DOUBLE)))), 0) AS BIGINT) "
        f"AS top_{s}_defaults" for s, f in _PCT)}
  FROM {name}_rows GROUP BY {keys}
)"""


METRICS = metrics_ctes("scored", "model_version, split") + f""",
metrics_figures AS (
  SELECT *, {", ".join(
      f"top_{s}_defaults / k_{s} AS top_{s}_default_rate, "
      f"coalesce((top_{s}_defaults / k_{s}) / nullif(base_rate, 0), 0) AS lift_at_{s}, "
      f"top_{s}_defaults / greatest(1, pos) AS recall_at_{s}" for s, _ in _PCT)}
  FROM metrics
)"""

_V2_P90 = """SELECT *, lag(p90) OVER (PARTITION BY model_version, split ORDER BY issue_month) AS before
  FROM score_drift WHERE model_version = 'v2' AND split IN ('valid', 'test')"""


def _feature_changes(version: str, kind: str, value: str) -> str:
    return f"""SELECT *, lag({value}) OVER w AS before, lag(top_category) OVER w AS old_top
  FROM feature_drift WHERE model_version = '{version}' AND feature_type = '{kind}'
  WINDOW w AS (PARTITION BY model_version, split, feature_name ORDER BY issue_month)"""


def _alert(source: str, ts: str, kind: str, entity: str, value: str, warn: str, critical: str, details: str) -> str:
    return f"""SELECT TIMESTAMP '{ts}' AS ts, model_version, split, issue_month, '{kind}' AS alert_type,
    {entity} AS entity, {value} AS value,
    CAST(CASE WHEN {value} >= CAST({critical} AS DOUBLE) THEN {critical} ELSE {warn} END AS DOUBLE) AS threshold,
    CASE WHEN {value} >= CAST({critical} AS DOUBLE) THEN 'CRITICAL' ELSE 'WARN' END AS severity, {details} AS details
  FROM ({source}) WHERE {value} >= CAST({warn} AS DOUBLE)"""


def _six(column: str) -> str:
    return f"printf('%.6f', round_even({column}, 6))"


def _numeric_alert(version: str, ts: str) -> str:
    return _alert(
        _feature_changes(version, "numeric", "mean"), ts, "numeric_mean_drift", "feature_name",
        "(abs(mean - before) / nullif(abs(before), 0))", "0.10", "0.20",
        f"'mean moved from ' || {_six('before')} || ' to ' || {_six('mean')} || ' (abs_delta=' || "
        f"{_six('abs(mean - before)')} || ')'")


ALERTS = f"""
alert_p90 AS ({_alert(
    _V2_P90, "2001-08-02 01:00:00", "score_drift_p90", "'p90'", "abs(p90 - before)", "0.03", "0.05",
    f"'p90 moved from ' || {_six('before')} || ' to ' || {_six('p90')}")}),
alert_mean AS ({_numeric_alert("v2", "2001-08-02 01:00:00")}),
alert_share AS ({_alert(
    _feature_changes("v2", "categorical", "top_category_share"), "2001-08-02 01:00:00", "categorical_share_drift",
    "feature_name", "abs(top_category_share - before)", "0.05", "0.08",
    f"'top_share moved from ' || {_six('before')} || ' to ' || {_six('top_category_share')} || '; top_cat ' || "
    "coalesce(old_top, 'NULL') || ' -> ' || coalesce(top_category, 'NULL')")}),
alert_log AS (
  SELECT * FROM alert_p90 UNION ALL SELECT * FROM alert_mean UNION ALL SELECT * FROM alert_share
  UNION ALL {_numeric_alert("v1", "2001-08-01 01:00:00")}
  UNION ALL SELECT * REPLACE ('demo_score' AS alert_type) FROM alert_p90
  UNION ALL SELECT TIMESTAMP '2001-08-02 01:00:00', model_version, split, issue_month, 'manual_review', feature_name,
    null_rate, CAST(0.02 AS DOUBLE), 'info', 'more than 2% missing' FROM feature_drift WHERE null_rate > CAST(0.02 AS DOUBLE)
)"""

LABELS = """
labels_table(feature_name, feature_label, feature_group) AS (VALUES
  ('loan_amount', 'Loan amount', 'Loan'), ('interest_rate', 'Interest rate', 'Loan'),
  ('grade', 'Lending Club grade', 'Loan'), ('purpose', 'Loan purpose', 'Loan'),
  ('initial_list_status', 'Listing type (whole/fractional)', 'Loan'), ('annual_income', 'Annual income', 'Borrower'),
  ('dti', 'Debt-to-income ratio', 'Borrower'), ('home_ownership', 'Home ownership', 'Borrower'),
  ('verification_status', 'Income verification', 'Borrower'), ('revol_bal', 'Credit card balance', 'Credit history'),
  ('revol_util', 'Credit card utilisation', 'Credit history'),
  ('total_acc', 'Number of credit accounts', 'Credit history'))"""

DASH = f"""
dash_scored AS (
  SELECT l.model_version, l.split, l.loan_id, strftime(l.issue_date, '%Y-%m') AS issue_month, f.term_months, l.p_default,
         f.label
  FROM latest l JOIN features f ON l.loan_id = f.loan_id
  WHERE l.model_version = 'v2' AND l.p_default IS NOT NULL AND f.label IS NOT NULL
),
risk_bands AS (
  SELECT model_version, split, risk_band, term_months || ' months' AS loan_term, count(*) AS loans,
         CAST(sum(label) AS BIGINT) AS defaults, CAST(count(*) - sum(label) AS BIGINT) AS repaid,
         sum(p_default) AS predicted_defaults, min(p_default) AS min_pd, max(p_default) AS max_pd
  FROM (SELECT *, ntile(100) OVER (PARTITION BY split ORDER BY p_default DESC, loan_id) AS risk_band FROM dash_scored)
  GROUP BY model_version, split, risk_band, term_months
),
score_trend AS (
  SELECT a.*, CAST(strptime(a.issue_month || '-01', '%Y-%m-%d') AS DATE) AS month_start, s.p50 AS median_pd,
         s.p90 AS p90_pd
  FROM (SELECT {MONTH}, count(*) AS loans, avg(p_default) AS predicted_default_rate, avg(label) AS actual_default_rate
        FROM dash_scored GROUP BY {MONTH}) a
  LEFT JOIN (SELECT * FROM score_drift QUALIFY ts = max(ts) OVER (PARTITION BY model_version, split)) s
    ON a.model_version = s.model_version AND a.split = s.split AND a.issue_month = s.issue_month
),
changes AS (
  SELECT *, CASE WHEN feature_type = 'numeric' THEN mean ELSE top_category_share END AS cur,
         lag(CASE WHEN feature_type = 'numeric' THEN mean ELSE top_category_share END) OVER w AS before,
         first_value(CASE WHEN feature_type = 'numeric' THEN mean ELSE top_category_share END) OVER w AS first
  FROM feature_drift WHERE model_version = 'v2'
  WINDOW w AS (PARTITION BY split, feature_name ORDER BY issue_month)
),
drift_view AS (
  SELECT model_version, split, CAST(strptime(issue_month || '-01', '%Y-%m-%d') AS DATE) AS month_start, issue_month,
    feature_name, coalesce(feature_label, feature_name) AS feature_label, coalesce(feature_group, 'Other') AS feature_group,
    feature_type, n AS loans, null_rate, mean,
    CASE WHEN feature_name = 'initial_list_status' AND top_category = 'w' THEN 'Whole loan'
         WHEN feature_name = 'initial_list_status' AND top_category = 'f' THEN 'Fractional'
         ELSE top_category END AS top_category,
    top_category_share, vs_prev AS change_vs_prev_month, vs_first AS change_vs_first_month,
    CASE feature_type WHEN 'numeric' THEN '% change in average'
         ELSE 'change in share of most common value' END AS change_measure,
    CASE WHEN vs_prev IS NULL THEN 'Baseline'
         WHEN vs_prev >= CASE feature_type WHEN 'numeric' THEN CAST(0.20 AS DOUBLE) ELSE CAST(0.08 AS DOUBLE) END
           THEN 'Critical'
         WHEN vs_prev >= CASE feature_type WHEN 'numeric' THEN CAST(0.10 AS DOUBLE) ELSE CAST(0.05 AS DOUBLE) END
           THEN 'Warning'
         ELSE 'Stable' END AS status
  FROM (SELECT *, CASE feature_type WHEN 'numeric' THEN abs(cur - before) / nullif(abs(before), 0)
                       ELSE abs(cur - before) END AS vs_prev,
                  CASE feature_type WHEN 'numeric' THEN (cur - first) / nullif(abs(first), 0)
                       ELSE cur - first END AS vs_first FROM changes)
  LEFT JOIN labels_table USING (feature_name)
),
alert_words AS (
  SELECT ts AS checked_at, model_version, split,
    CASE split WHEN 'test' THEN 'Monitored period' ELSE 'Validation period' END AS period,
    CAST(strptime(issue_month || '-01', '%Y-%m-%d') AS DATE) AS month_start, issue_month, alert_type,
    CASE upper(severity) WHEN 'CRITICAL' THEN 'Critical' WHEN 'WARN' THEN 'Warning' ELSE 'Info' END AS severity,
    CAST(CASE upper(severity) WHEN 'CRITICAL' THEN 1 WHEN 'WARN' THEN 2 ELSE 3 END AS BIGINT) AS severity_rank,
    CASE alert_type WHEN 'score_drift_p90' THEN 'Risk scores' ELSE label END AS what_changed,
    CASE alert_type
      WHEN 'score_drift_p90' THEN 'Predicted risk for the riskiest 10% of loans moved '
        || printf('%.1f', round_even(value * 100, 1)) || ' points from the previous month (limit '
        || printf('%.0f', round_even(threshold * 100, 0)) || ').'
      WHEN 'numeric_mean_drift' THEN 'Average ' || lower(label) || ' changed '
        || printf('%.0f', round_even(value * 100, 0)) || '% from the previous month (limit '
        || printf('%.0f', round_even(threshold * 100, 0)) || '%).'
      WHEN 'categorical_share_drift' THEN 'Mix of ' || lower(label)
        || ' shifted: the most common value''s share moved ' || printf('%.0f', round_even(value * 100, 0))
        || ' points from the previous month (limit ' || printf('%.0f', round_even(threshold * 100, 0)) || ').'
      ELSE details END AS message,
    value, threshold, details AS technical_details
  FROM (SELECT a.*, coalesce(l.feature_label, a.entity) AS label
        FROM alert_log a LEFT JOIN labels_table l ON a.entity = l.feature_name
        WHERE model_version = 'v2' AND alert_type NOT LIKE 'demo%'
        QUALIFY ts = max(ts) OVER (PARTITION BY alert_type))
),
summary AS (
  SELECT r.model_version, split, r.ts AS refreshed_at, r.n AS loans, r.base_rate AS actual_default_rate,
    predicted_default_rate, r.top_5pct_default_rate, r.lift_at_1pct, r.lift_at_5pct, r.lift_at_10pct, r.recall_at_1pct,
    r.recall_at_5pct, r.recall_at_10pct, m.roc_auc, m.pr_auc, m.brier,
    CAST(coalesce(critical_alerts, 0) AS BIGINT) AS critical_alerts,
    CAST(coalesce(warning_alerts, 0) AS BIGINT) AS warning_alerts
  FROM (SELECT * FROM rollups WHERE model_version = 'v2') r
  LEFT JOIN (SELECT * FROM metrics WHERE model_version = 'v2') m USING (split)
  LEFT JOIN (SELECT split, avg(p_default) AS predicted_default_rate FROM dash_scored GROUP BY split) USING (split)
  LEFT JOIN (SELECT split, count(*) FILTER (severity = 'Critical') AS critical_alerts,
                    count(*) FILTER (severity = 'Warning') AS warning_alerts FROM alert_words GROUP BY split) USING (split)
),
summary_words AS (
  SELECT *, CASE WHEN critical_alerts > 0 THEN 'Action needed' WHEN warning_alerts > 0 THEN 'Watch' ELSE 'Healthy' END
      AS status,
    CASE WHEN critical_alerts > 0 THEN critical_alerts || ' critical data '
           || CASE WHEN critical_alerts = 1 THEN 'change' ELSE 'changes' END
           || ' found. Review the alerts before relying on scores for the affected months.'
         WHEN warning_alerts > 0 THEN 'The model is ranking risk well, but ' || warning_alerts || ' '
           || CASE WHEN warning_alerts = 1 THEN 'input' ELSE 'inputs' END || ' changed more than usual. Worth watching.'
         ELSE 'The model is ranking risk well and no unusual data changes were found.' END AS headline,
    'The riskiest 5% of loans default at ' || printf('%.1f', round_even(lift_at_5pct, 1)) || '× the normal rate.'
      AS tile_lift,
    'The riskiest 10% of loans hold ' || printf('%.0f', round_even(recall_at_10pct * 100, 0)) || '% of all defaults.'
      AS tile_capture,
    'Predicted ' || printf('%.1f', round_even(predicted_default_rate * 100, 1)) || '% default rate vs '
      || printf('%.1f', round_even(actual_default_rate * 100, 1)) || '% actual.' AS tile_calibration
  FROM summary
)"""


def with_tables(*parts: str) -> str:
    return "WITH RECURSIVE " + ",".join(parts)


def rounded(columns: list[str], digits: int = 6) -> str:
    """Rounded doubles; adding zero turns -0.0 into 0.0."""
    return ", ".join(f"round({c}, {digits}) + 0.0 AS {c}" for c in columns)

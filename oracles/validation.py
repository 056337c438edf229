"""SQL of the validation report over any ``v_rows`` table."""

from __future__ import annotations

from oracles.tables import MODEL_NUMERIC, MODEL_TEXT

SPLITS = ["train", "valid", "test"]
RANGES = {
    "loan_amount": (500, 50_000), "interest_rate": (1, 40), "installment": (1, 2_000),
    "annual_income": (1, 100_000_000), "dti": (0, 100), "fico_low": (300, 850), "fico_high": (300, 850),
    "open_acc": (0, 200), "total_acc": (0, 300), "pub_rec": (0, 100), "delinq_2yrs": (0, 100),
    "inq_last_6mths": (0, 50), "revol_bal": (0, 100_000_000), "revol_util": (0, 1_000),
    "credit_history_years": (0, 90)}


def _note(check: str, severity: str, subject: str, value: str, message: str, source: str, when: str) -> str:
    return (f"SELECT '{check}' AS \"check\", {severity} AS severity, {subject} AS subject, CAST({value} AS DOUBLE) AS value, "
            f"CAST({message} AS VARCHAR) AS message FROM {source}, v_state WHERE ({when})")


def _pct(share: str, digits: int) -> str:
    return f"printf('%.{digits}f', round_even({share} * 100, {digits})) || '%'"


def report(rows: str, limited: bool) -> str:
    """CTEs up to ``v_report``; ``rows`` is the body of ``v_rows`` with a ``split`` column."""
    few = "FALSE" if limited else "coalesce((SELECT n FROM v_all WHERE split = 'train'), 0) < 100000"
    ok = "NOT broken AND "
    notes = [
        _note("structure", "'FAIL'", "split", "n", "split || ' split is empty'", "v_all",
              "n = 0 AND split IN ('train', 'valid')"),
        _note("structure", "'FAIL'", "split", "n", "'train has ' || format('{:,}', n) || ' rows (< 100,000)'", "v_all",
              f"split = 'train' AND {few}"),
        _note("labels", "'FAIL'", "split", "nolabel", "split || ': ' || nolabel || ' missing labels'", "v_all",
              ok + "nolabel > 0"),
        _note("labels", "'FAIL'", "split", "badlabel", "split || ': label has values other than 0/1'", "v_all",
              ok + "badlabel > 0"),
        _note("labels", "'INFO'", "split || '_rows'", "n", "NULL", "v_all", ok + "n > 0"),
        _note("labels", "'INFO'", "split || '_default_rate'", "round_even(rate, 4)", "NULL", "v_all", ok + "n > 0"),
        _note("labels", "'FAIL'", "split", "rate",
              "split || ': default rate ' || printf('%.3f', round_even(rate, 3)) || ' outside (0.05, 0.6)'", "v_all",
              ok + "rate NOT BETWEEN 0.05 AND 0.60"),
        _note("labels", "'WARN'", "a.split", "round_even(a.rate, 4)",
              "a.split || ' default rate ' || printf('%.4f', round_even(a.rate, 4)) || ' differs from train ' || "
              "printf('%.4f', round_even(b.rate, 4)) || ' by more than 0.1'", "v_all a, v_all b",
              ok + "b.split = 'train' AND a.split <> 'train' AND abs(round_even(a.rate, 4) - round_even(b.rate, 4)) > 0.10"),
        _note("time_order", "'FAIL'", "'maturity'", "day - DATE '2001-06-01'",
              "'loans issued after the maturity guard (' || day || ' > 2001-06-01)'",
              "(SELECT max(last) AS day FROM v_all)", ok + "day > DATE '2001-06-01'"),
        _note("overlap", "'FAIL'", "split", "repeats", "split || ': ' || repeats || ' duplicate loan_ids'",
              "(SELECT split, CAST(sum(n - 1) AS BIGINT) AS repeats FROM v_ids GROUP BY split)", ok + "repeats > 0"),
    ]
    for a, b in (("train", "valid"), ("valid", "test")):
        notes.append(_note(
            "time_order", "'FAIL'", f"'{a}/{b}'", "x.last - y.first",
            f"'time split broken: latest {a} date ' || x.last || ' >= earliest {b} date ' || y.first",
            "v_all x, v_all y", ok + f"x.split = '{a}' AND y.split = '{b}' AND x.last >= y.first"))
    for a, b in (("train", "valid"), ("train", "test"), ("valid", "test")):
        notes.append(_note(
            "overlap", "'FAIL'", f"'{a}/{b}'", "shared", f"shared || ' loan_ids appear in both {a} and {b}'",
            f"(SELECT count(*) AS shared FROM v_ids x JOIN v_ids y ON x.loan_id = y.loan_id WHERE x.split = '{a}' "
            f"AND y.split = '{b}')", ok + "shared > 0"))
    for c in MODEL_NUMERIC + MODEL_TEXT:
        notes.append(_note(
            "missing", "CASE WHEN share > 0.5 THEN 'FAIL' ELSE 'WARN' END", f"'{c}'", "share",
            f"'train.{c}: ' || {_pct('share', 1)} || ' missing'",
            f"(SELECT avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) AS share FROM v_rows WHERE split = 'train')",
            ok + "share > 0.05"))
    for c, (lo, hi) in RANGES.items():
        notes.append(_note(
            "ranges", "CASE WHEN share > 0.01 THEN 'FAIL' ELSE 'WARN' END", f"'{c}'", "share",
            f"'{c}: ' || CASE WHEN share > 0.01 THEN {_pct('share', 2)} ELSE {_pct('share', 3)} END "
            f"|| ' of values outside [{lo}, {hi}]'",
            f"(SELECT avg(CASE WHEN {c} BETWEEN {lo} AND {hi} THEN 0.0 ELSE 1.0 END) FILTER ({c} IS NOT NULL) AS share "
            "FROM v_rows)", ok + "share > 0"))
    notes.append(_note(
        "allowed", "'FAIL'", "'term_months'", "v", "'term_months: unexpected values [' || v || ']'",
        "(SELECT DISTINCT term_months AS v FROM v_rows WHERE term_months NOT IN (36, 60))", ok + "TRUE"))
    for check in ("labels", "time_order", "overlap", "missing", "ranges", "allowed"):
        notes.append(_note(check, "'SKIPPED'", "'all'", "NULL", "'structure is broken'", "(SELECT 1)", "broken"))
    return f"""
v_rows AS ({rows}),
v_split AS (
  SELECT split, count(*) AS n, count(*) FILTER (label IS NULL) AS nolabel,
         count(*) FILTER (label NOT IN (0, 1)) AS badlabel, avg(label) AS rate, min(issue_date) AS first,
         max(issue_date) AS last
  FROM v_rows GROUP BY split
),
v_all AS (
  SELECT s.split, coalesce(n, 0) AS n, nolabel, badlabel, rate, first, last
  FROM (VALUES ('train'), ('valid'), ('test')) AS s(split) LEFT JOIN v_split USING (split)
),
v_ids AS (SELECT split, loan_id, count(*) AS n FROM v_rows GROUP BY split, loan_id),
v_state AS (
  SELECT (SELECT count(*) FROM v_all WHERE n = 0 AND split IN ('train', 'valid')) > 0 OR {few} AS broken
),
v_report AS ({" UNION ALL ".join(notes)})"""

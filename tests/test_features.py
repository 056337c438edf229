"""Parsing, dedupe order, split and reconciliation on small hand-made records."""

import datetime

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from arrears import shared
from arrears.constants import RAW_SCHEMA
from arrears.functions import parse
from arrears.functions.text import fixed
from arrears.operators import features


def record(**fields):
    base = {"id": "1", "loan_amnt": "1000", "term": " 36 months", "int_rate": "10", "installment": "30",
            "issue_d": "Jan-2015", "annual_inc": "50000", "dti": "10", "earliest_cr_line": "Dec-2000",
            "loan_status": "Fully Paid"}
    base |= fields
    return tuple(base.get(name) for name in RAW_SCHEMA.names)


@pytest.mark.parametrize("text, value", [
    ("12.5", 12.5), (" 7 ", 7.0), ("-3", -3.0), ("1e3", 1000.0), (".5", 0.5), ("n/a", None), ("", None), (None, None),
    ("NaN", None), ("inf", None), ("Infinity", None), ("1.5d", None), ("1.5F", None), ("1e400", None), ("1.2.3", None)])
def test_number(spark, text, value):
    assert spark.createDataFrame([(text,)], "t string").select(parse.number(F.col("t"))).first()[0] == value


def test_month_and_integer(spark):
    rows = spark.createDataFrame([("Dec-2017", " 60 months"), ("unknown", "none")], "m string, t string")
    got = rows.select(parse.month(F.col("m")), parse.first_integer(F.col("t"))).collect()
    assert [tuple(r) for r in got] == [(datetime.date(2017, 12, 1), 60), (None, None)]


def test_fixed_rounds_ties_to_even_and_keeps_null(spark):
    rows = spark.createDataFrame([(0.25,), (2.5,), (None,)], "x double")
    assert [r[0] for r in rows.select(fixed(F.col("x"), 1)).collect()] == ["0.2", "2.5", None]
    assert [r[0] for r in rows.select(fixed(F.col("x"), 0)).collect()] == ["0", "2", None]


def test_dedupe_comes_before_the_filters(spark):
    raw = spark.createDataFrame([
        record(id="a", issue_d="Mar-2015"), record(id="a", issue_d="Jan-2015", loan_status="Charged Off"),
        record(id="b", issue_d="unknown"), record(id="b"),          # the undated record is earliest, so the loan is lost
        record(id="c", loan_status="Current"),
        record(id="d", annual_inc="0"), record(id="e", dti="100.5"), record(id="f", issue_d="Jan-2018"),
        record(id="g", term="soon"),
    ], RAW_SCHEMA)
    rows = features.clean_loans(features.stage_loans(raw)).collect()
    assert [(r.loan_id, r.label, r.issue_date, r.credit_history_years) for r in rows] == [
        ("a", 1, datetime.date(2015, 1, 1), 15)]


def test_dedupe_is_deterministic_on_equal_dates(spark):
    rows = [record(id="a", loan_amnt=str(1000 + i)) for i in range(50)]
    for order in (rows, rows[::-1]):
        kept = features.dedupe_loans(features.stage_loans(spark.createDataFrame(order, RAW_SCHEMA).repartition(5))).collect()
        assert [r.loan_amount for r in kept] == [1000.0]


def test_dedupe_ranks_before_the_shuffle(spark):
    plan = features.dedupe_loans(features.stage_loans(spark.createDataFrame([record()], RAW_SCHEMA)))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("WindowGroupLimit") == 2


def test_dedupe_sorts_only_repeated_ids(spark, monkeypatch):
    written = {}

    def settle(df, name, *of):
        written[name] = shared.settle(df, name, *of)
        return written[name]

    monkeypatch.setattr(features, "settle", settle)
    rows = [record(id=str(i), issue_d="Mar-2015", loan_amnt=str(i)) for i in range(40)] + [
        record(id="7", issue_d="Jan-2015", loan_amnt="99"), record(id=None, loan_amnt="5"),
        record(id=None, loan_amnt="4")]
    staged = features.stage_loans(spark.createDataFrame(rows, RAW_SCHEMA))
    whole = {r.loan_id: r.loan_amount for r in features.dedupe_loans(staged).collect()}
    monkeypatch.setattr(features, "SORT_ROWS", 0)
    monkeypatch.setattr(features, "SORT_ALL", 0.2)
    kept = {r.loan_id: r.loan_amount for r in features.dedupe_loans(staged).collect()}
    assert kept == whole == {str(i): float(i) for i in range(40)} | {"7": 99.0, None: 4.0}
    assert sorted(r.loan_id or "" for r in written["records"].where("_repeated").collect()) == ["", "", "7", "7"]
    monkeypatch.setattr(features, "SORT_ALL", 0.01)
    assert {r.loan_id: r.loan_amount for r in features.dedupe_loans(staged).collect()} == kept
    few = features.dedupe_loans(staged, F.col("loan_amount") < 5)
    assert sorted(r.loan_id or "" for r in few.collect()) == ["", "0", "1", "2", "3", "4"]


def test_partitioned_tables_are_written_without_a_sort(spark, monkeypatch):
    seen, name, write = [], "spark.sql.maxConcurrentOutputFileWriters", DataFrameWriter.parquet
    before = spark.conf.get(name)
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda *of: (seen.append(int(spark.conf.get(name))), write(*of)))
    rows = shared.settle(spark.range(10).selectExpr("id", "id % 3 AS part"), "parts", ["part"])
    assert seen == [shared.OPEN_FILES] and spark.conf.get(name) == before
    assert sorted(tuple(r) for r in rows.collect()) == [(i, i % 3) for i in range(10)]


def test_split_moves_whole_months(spark):
    months = ["Jan-2015"] * 7 + ["Feb-2015"] * 2 + ["Mar-2015"]
    raw = spark.createDataFrame([record(id=str(i), issue_d=m) for i, m in enumerate(months)], RAW_SCHEMA)
    got = features.build_features(raw).groupBy("split").count().collect()
    assert {r.split: r["count"] for r in got} == {"train": 7, "test": 3}


def test_reconcile(spark):
    left = spark.createDataFrame([("a", 1, None), ("b", 2, "x"), ("c", 3, "y")], "k string, v long, w string")
    right = spark.createDataFrame([("a", 1, None), ("b", 5, "x"), ("d", 4, "y"), ("d", 4, "y")], left.schema)
    got = {r.measure: r.loans for r in features.reconcile(left, right, "k", ["v", "w"]).collect()}
    assert got == {"rows_left": 3, "rows_right": 4, "only_left": 1, "only_right": 1, "repeated_keys": 1,
                   "mismatch_v": 1, "mismatch_w": 0}


def test_numbers_reach_the_range_of_a_double(spark):
    from arrears.functions.parse import number

    texts = ["1e305", " -1.5E300 ", "1e999", "-1e400", "NaN", "Infinity", "1.5d", "", None, "7"]
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string")
    got = [r.v for r in rows.select("k", number(rows.t).alias("v")).orderBy("k").collect()]
    assert got == [1e305, -1.5e300, None, None, None, None, None, None, None, 7.0]

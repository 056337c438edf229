"""CSV loading, stored tables, upsert and run history."""

import datetime
import re

import pytest
from pyspark.sql import functions as F

from arrears.constants import PREDICTIONS_SCHEMA
from arrears.operators.history import latest_run, newest_model, upsert
from arrears.sources.raw_csv import TooManyBadRecords, load_raw_csv, read_csv_split, read_raw_csv
from arrears.sources.tables import append_rows, ensure_table, read_split, read_table, replace_table

CSV = '''id, term ,title
1," 36 months",plain
2,60,"two
lines, one field"
3,36
4
5,36,x,too long
6,36,x,
7,36,"said ""yes"""
'''


@pytest.fixture
def csv_file(tmp_path):
    (tmp_path / "loans.csv").write_text(CSV)
    return str(tmp_path / "loans.csv")


def test_csv_rows(spark, csv_file):
    rows = {r.id: r for r in read_raw_csv(spark, csv_file).collect()}
    assert rows["1"].term == " 36 months" and not rows["1"].is_bad
    assert rows["2"].title == "two\nlines, one field"
    assert rows["3"].title is None and not rows["3"].is_bad
    assert rows["4"].term is None and not rows["4"].is_bad
    assert rows["5"].is_bad and rows["6"].is_bad
    assert rows["7"].title == 'said "yes"'


def test_load_counts_rejects_and_keeps_target(spark, csv_file, tmp_path):
    target = str(tmp_path / "raw")
    assert load_raw_csv(spark, csv_file, target, max_bad_records=2).count() == 5
    with pytest.raises(TooManyBadRecords):
        load_raw_csv(spark, csv_file, target, max_bad_records=1)
    assert spark.read.parquet(target).count() == 5


def test_csv_split_filter_only_when_present(spark, tmp_path):
    (tmp_path / "a.csv").write_text("loan_id,split\n1,valid\n2,test\n")
    (tmp_path / "b.csv").write_text("loan_id,x\n1,valid\n2,test\n")
    assert read_csv_split(spark, str(tmp_path / "a.csv"), "test").count() == 1
    assert read_csv_split(spark, str(tmp_path / "b.csv"), "test").count() == 2


def predictions(spark, rows):
    typed = [(datetime.datetime(2020, 1, day), model, split, loan, datetime.date(2019, 1, 1), p)
             for day, model, split, loan, p in rows]
    return spark.createDataFrame(typed, PREDICTIONS_SCHEMA)


def test_append_matches_by_name_and_prunes_by_day(spark, tmp_path):
    path = str(tmp_path / "predictions")
    assert ensure_table(spark, path, PREDICTIONS_SCHEMA).count() == 0
    first = predictions(spark, [(1, "m", "test", "a", 0.1), (1, "m", "test", "b", 0.2)])
    append_rows(first, path, PREDICTIONS_SCHEMA, ["model_version"])
    append_rows(predictions(spark, [(2, "m", "test", "a", 0.3)]).select(*reversed(PREDICTIONS_SCHEMA.names)), path,
                PREDICTIONS_SCHEMA)
    ensure_table(spark, path, PREDICTIONS_SCHEMA)
    stored = read_table(spark, path, PREDICTIONS_SCHEMA)
    assert stored.count() == 3
    latest = latest_run(stored, ["model_version", "split"])
    assert [(r.loan_id, r.p_default) for r in latest.collect()] == [("a", 0.3)]
    # Of the two stored days, only the newest run's is opened.
    plan = latest._jdf.queryExecution().executedPlan().toString()
    pruned = re.search(r"PartitionFilters: \[([^]]*)\]", plan).group(1)
    assert "2020-01-02" in pruned and "2020-01-01" not in pruned, plan
    with pytest.raises(ValueError):
        append_rows(first.drop("p_default"), path, PREDICTIONS_SCHEMA)
    with pytest.raises(ValueError):
        append_rows(first.withColumn("extra", F.lit(1)), path, PREDICTIONS_SCHEMA)


def test_replace_may_read_what_it_replaces(spark, tmp_path):
    path = str(tmp_path / "t")
    replace_table(spark.range(5), path)
    table = spark.read.parquet(path)
    assert replace_table(table.where("id > 1"), path).count() == 3


def test_upsert(spark):
    target = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, v long")
    source = spark.createDataFrame([("b", 20), ("c", 30), (None, 40)], "k string, v long")
    got = sorted((str(r.k), r.v) for r in upsert(target, source, ["k"]).collect())
    assert got == [("None", 3), ("None", 40), ("a", 1), ("b", 20), ("c", 30)]
    with pytest.raises(ValueError):
        upsert(target, source.union(source), ["k"])


def test_latest_run_is_per_key_and_newest_model_by_time(spark):
    rows = predictions(spark, [(1, "m1", "test", "a", 0.1), (2, "m1", "valid", "a", 0.1), (3, "m2", "test", "a", 0.1),
                               (2, "m1", "test", "a", 0.2)])
    latest = latest_run(rows, ["model_version", "split"])
    assert sorted((r.model_version, r.split, r.ts.day) for r in latest.collect()) == [
        ("m1", "test", 2), ("m1", "valid", 2), ("m2", "test", 3)]
    assert rows.where(F.col("model_version") == newest_model(rows)).count() == 1


def test_read_split(spark):
    rows = spark.createDataFrame([("a", "test"), ("b", "test"), ("c", "valid")], "loan_id string, split string")
    assert read_split(rows, "test", ["loan_id"]).columns == ["loan_id"]
    assert read_split(rows, "test", limit=1).count() == 1

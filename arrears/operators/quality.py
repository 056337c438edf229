"""Data tests on the feature table and validation of the splits before training."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from arrears.constants import (
    ALLOWED_VALUES, LABEL_RATE_RANGE, LABEL_SHIFT_WARN, MATURITY_GUARD, MIN_TRAIN_ROWS, NULL_FAIL, NULL_WARN,
    PLAUSIBLE_RANGES, RANGE_FAIL, RANGE_WARN, SPLITS)
from arrears.functions.text import sentence
from arrears.shared import settle

# --- Data tests: each returns the failing rows or values --------------------------------------------------------------


def failing_unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with their count."""
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n_records")).where(
        "n_records > 1")


def failing_not_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """NULL count of each column that has any; all columns are counted in one pass."""
    counts = df.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in columns])
    return counts.unpivot([], columns, "column_name", "n_records").where("n_records > 0")


def failing_accepted_values(df: DataFrame, column: str, accepted: list) -> DataFrame:
    """Values outside the accepted list, with their count. NULL passes."""
    return df.where(~F.col(column).isin(*accepted)).groupBy(column).agg(F.count(F.lit(1)).alias("n_records"))


def split_order(df: DataFrame, only_failures: bool = True) -> DataFrame:
    """Neighbouring splits in time order; a failure is a split that reaches into the next one."""
    bounds = {name: F.when(F.col("split") == name, F.col("issue_date")) for name in SPLITS}
    wide = df.agg(
        *[F.min(day).alias(f"first_{name}") for name, day in bounds.items()],
        *[F.max(day).alias(f"last_{name}") for name, day in bounds.items()])
    pairs = [F.struct(F.lit(a).alias("earlier_split"), F.lit(b).alias("later_split"),
                      F.col(f"last_{a}").alias("last_date"), F.col(f"first_{b}").alias("first_date"))
             for a, b in zip(SPLITS, SPLITS[1:])]
    rows = wide.select(F.inline(F.array(*pairs))).where("last_date IS NOT NULL AND first_date IS NOT NULL")
    broken = F.col("last_date") >= F.col("first_date")
    return rows.where(broken) if only_failures else rows.withColumn("broken", broken)


def failing_maturity(df: DataFrame, maturity_guard: str = MATURITY_GUARD) -> DataFrame:
    """Loans issued after the guard date."""
    return df.where(F.col("issue_date") > F.lit(maturity_guard).cast("date")).select("loan_id", "issue_date")


def failing_fico_range(df: DataFrame) -> DataFrame:
    """Loans with a credit score outside 300 to 850. NULL passes."""
    return df.where(~F.col("fico_low").between(300, 850) | ~F.col("fico_high").between(300, 850)).select(
        "loan_id", "fico_low", "fico_high")


def data_tests(features: DataFrame, maturity_guard: str = MATURITY_GUARD) -> DataFrame:
    """All data tests of the feature table: one row per test with its number of failures."""
    def failures(test: str, subject: str, failing: DataFrame, count: Column | None = None) -> DataFrame:
        total = F.count(F.lit(1)) if count is None else count
        return failing.agg(F.coalesce(total, F.lit(0)).cast("bigint").alias("failures")).select(
            F.lit(test).alias("test"), F.lit(subject).alias("subject"), "failures")

    required = ["loan_id", "issue_date", "label", "split"]
    accepted = {"label": [0, 1], "term_months": [36, 60], "split": list(SPLITS)}
    # Row-wise tests share one scan; the tests that need groups run on their own.
    row_tests = {
        **{("not_null", name): F.count_if(F.col(name).isNull()) for name in required},
        **{("accepted_values", name): F.count_if(~F.col(name).isin(*values)) for name, values in accepted.items()},
        ("maturity_guard", "issue_date"): F.count_if(F.col("issue_date") > F.lit(maturity_guard).cast("date")),
        ("fico_range", "fico"): F.count_if(
            ~F.col("fico_low").between(300, 850) | ~F.col("fico_high").between(300, 850)),
    }
    named = {f"t{i}": key for i, key in enumerate(row_tests)}
    counted = features.agg(*[row_tests[key].alias(name) for name, key in named.items()])
    rows = counted.select(F.inline(F.array(*[
        F.struct(F.lit(test).alias("test"), F.lit(subject).alias("subject"), F.col(name).alias("failures"))
        for name, (test, subject) in named.items()])))
    return rows.unionByName(failures("unique", "loan_id", failing_unique(features, "loan_id"))).unionByName(
        failures("split_order", "issue_date", split_order(features)))


# --- Validation of the splits -----------------------------------------------------------------------------------------


class ValidationError(ValueError):
    """At least one check failed."""


def _stack(data: DataFrame | Mapping[str, DataFrame], columns: list[str]) -> tuple[DataFrame, dict[str, list[str]]]:
    """One DataFrame with a ``split`` column, and the columns each split lacks."""
    if isinstance(data, DataFrame):
        lacking = [name for name in columns if name not in data.columns]
        return data, {name: lacking for name in SPLITS if lacking}
    missing = {split: [c for c in columns if c not in df.columns] for split, df in data.items()}
    parts = [df.withColumn("split", F.lit(split)) for split, df in data.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts), {k: v for k, v in missing.items() if v}


def _number(name: str) -> Column:
    value = F.col(name).try_cast("double")
    return F.when(~F.isnan(value), value)


def _is_missing(df: DataFrame, name: str) -> Column:
    kind = dict(df.dtypes)[name]
    return F.col(name).isNull() | F.isnan(name) if kind in ("double", "float") else F.col(name).isNull()


REPORT_SCHEMA = "check string, severity string, subject string, value double, message string"


def _figures(rows: DataFrame, features: list[str], ranged: list[str]) -> Row:
    """Every row-wise figure of the report, from one pass over the rows."""
    split, label, day = F.col("split"), F.col("label"), F.to_date("issue_date")
    figures: list[Column] = []
    for name in SPLITS:
        here = split == name
        figures += [
            F.count_if(here).alias(f"rows_{name}"),
            F.count_if(here & label.isNull()).alias(f"nolabel_{name}"),
            F.count_if(here & ~label.isin(0, 1)).alias(f"badlabel_{name}"),
            F.avg(F.when(here, label.cast("double"))).alias(f"rate_{name}"),
            F.min(F.when(here, day)).alias(f"first_{name}"),
            F.max(F.when(here, day)).alias(f"last_{name}"),
        ]
    in_train = split == "train"
    figures += [F.avg(F.when(in_train, _is_missing(rows, c).cast("double"))).alias(f"missing_{c}") for c in features]
    for c in ranged:
        lowest, highest = PLAUSIBLE_RANGES[c]
        figures.append(F.avg((~_number(c).between(lowest, highest)).cast("double")).alias(f"outside_{c}"))
    return rows.agg(*figures).first()


def _id_figures(rows: DataFrame) -> Row:
    """Repeated ids per split and ids shared between splits; ids are grouped once, with map-side combine."""
    ids = rows.groupBy(F.coalesce(F.col("loan_id").cast("string"), F.lit("None")).alias("loan_id")).agg(
        *[F.count_if(F.col("split") == name).alias(name) for name in SPLITS])
    return ids.agg(
        *[F.coalesce(F.sum(F.greatest(F.col(name) - 1, F.lit(0))), F.lit(0)).alias(f"repeats_{name}") for name in SPLITS],
        *[F.count_if((F.col(a) > 0) & (F.col(b) > 0)).alias(f"shared_{a}_{b}")
          for i, b in enumerate(SPLITS) for a in SPLITS[:i]]).first()


def validate_splits(
    data: DataFrame | Mapping[str, DataFrame], numeric: list[str], categorical: list[str], limited: bool = False,
    maturity_guard: str = MATURITY_GUARD,
) -> DataFrame:
    """Check the splits and return the report: ``check, severity, subject, value, message``.

    ``FAIL`` stops training, ``WARN`` does not, ``INFO`` carries the row counts and default rates. When the structure is
    broken the later checks are listed as ``SKIPPED``. The data is reduced to one row of figures whose width depends on
    the columns only; the wording is added to that row. Unexpected values stay distributed, one report row each.
    """
    spark = (data if isinstance(data, DataFrame) else next(iter(data.values()))).sparkSession
    features = [*numeric, *categorical]
    needed = [*features, "label", "loan_id", "issue_date"]
    rows, lacking = _stack(data, needed)
    rows = rows.withColumns({name: F.lit(None).cast("string") for name in needed if name not in rows.columns})
    rows = rows.select("split", *needed).where(F.col("split").isin(*SPLITS))
    ranged = [name for name in PLAUSIBLE_RANGES if name in numeric]
    figure = _figures(rows, features, ranged)
    total = {name: figure[f"rows_{name}"] for name in SPLITS}
    notes: list[tuple] = []

    def note(check: str, severity: str, subject: str, value, message: str | None) -> None:
        notes.append((check, severity, subject, None if value is None else float(value), message))

    def report() -> DataFrame:
        return spark.createDataFrame(notes, REPORT_SCHEMA)

    # Structure
    for name in ("train", "valid"):
        if not total[name]:
            note("structure", "FAIL", name, 0, f"{name} split is empty")
    if not limited and total["train"] < MIN_TRAIN_ROWS:
        note("structure", "FAIL", "train", total["train"], f"train has {total['train']:,} rows (< {MIN_TRAIN_ROWS:,})")
    for name, names in lacking.items():
        note("structure", "FAIL", name, len(names), f"{name}: missing columns {names}")
    if notes:
        for check in ("labels", "time_order", "overlap", "missing", "ranges", "allowed"):
            note(check, "SKIPPED", "all", None, "structure is broken")
        return report()

    # Labels
    present = [name for name in SPLITS if total[name]]
    rate = {name: figure[f"rate_{name}"] for name in present}
    lowest, highest = LABEL_RATE_RANGE
    for name in present:
        if figure[f"nolabel_{name}"]:
            note("labels", "FAIL", name, figure[f"nolabel_{name}"], f"{name}: {figure[f'nolabel_{name}']} missing labels")
        if figure[f"badlabel_{name}"]:
            note("labels", "FAIL", name, figure[f"badlabel_{name}"], f"{name}: label has values other than 0/1")
        note("labels", "INFO", f"{name}_rows", total[name], None)
        if rate[name] is None:
            continue
        note("labels", "INFO", f"{name}_default_rate", round(rate[name], 4), None)
        if not lowest <= rate[name] <= highest:
            note("labels", "FAIL", name, rate[name], f"{name}: default rate {rate[name]:.3f} outside {LABEL_RATE_RANGE}")
    known = {name: round(value, 4) for name, value in rate.items() if value is not None}
    for name in ("valid", "test"):
        if {"train", name} <= set(known) and abs(known[name] - known["train"]) > LABEL_SHIFT_WARN:
            note("labels", "WARN", name, known[name], f"{name} default rate {known[name]:.4f} differs from train "
                 f"{known['train']:.4f} by more than {LABEL_SHIFT_WARN}")

    # Time order and maturity
    first, last = ({name: figure[f"{end}_{name}"] for name in present if figure[f"{end}_{name}"]} for end in ("first", "last"))
    dated = [name for name in SPLITS if name in last]
    for a, b in zip(dated, dated[1:]):
        if last[a] >= first[b]:
            note("time_order", "FAIL", f"{a}/{b}", (last[a] - first[b]).days,
                 f"time split broken: latest {a} date {last[a]} >= earliest {b} date {first[b]}")
    guard = date.fromisoformat(maturity_guard)
    if dated and max(last.values()) > guard:
        note("time_order", "FAIL", "maturity", (max(last.values()) - guard).days,
             f"loans issued after the maturity guard ({max(last.values())} > {guard})")

    # Repeated and shared ids
    ids = _id_figures(rows)
    for i, name in enumerate(SPLITS):
        if ids[f"repeats_{name}"]:
            note("overlap", "FAIL", name, ids[f"repeats_{name}"], f"{name}: {ids[f'repeats_{name}']} duplicate loan_ids")
        for other in SPLITS[:i]:
            shared = ids[f"shared_{other}_{name}"]
            if shared:
                note("overlap", "FAIL", f"{other}/{name}", shared, f"{shared} loan_ids appear in both {other} and {name}")

    # Missing values in train, implausible values anywhere
    for c in features:
        share = figure[f"missing_{c}"] or 0.0
        if share > NULL_WARN:
            note("missing", "FAIL" if share > NULL_FAIL else "WARN", c, share, f"train.{c}: {share:.1%} missing")
    for c in ranged:
        share, (lowest, highest) = figure[f"outside_{c}"] or 0.0, PLAUSIBLE_RANGES[c]
        if share > RANGE_WARN:
            severe = share > RANGE_FAIL
            shown = f"{share:.2%}" if severe else f"{share:.3%}"
            note("ranges", "FAIL" if severe else "WARN", c, share, f"{c}: {shown} of values outside [{lowest}, {highest}]")

    # Unexpected values
    found = report()
    for c, allowed in ALLOWED_VALUES.items():
        if c in numeric:
            value = _number(c).cast("bigint")
            odd = rows.where(~value.isin(*allowed)).select(value.alias("value")).distinct()
            found = found.unionByName(odd.select(
                F.lit("allowed").alias("check"), F.lit("FAIL").alias("severity"), F.lit(c).alias("subject"),
                F.col("value").cast("double").alias("value"),
                sentence(f"{c}: unexpected values [", F.col("value").cast("string"), "]").alias("message")))
    return found


def enforce(report: DataFrame, path: str | None = None) -> DataFrame:
    """Store the report as JSON when a path is given, and raise when it holds a failure."""
    report = settle(report, "validation")
    if path:
        report.write.mode("overwrite").json(path)
    failed = report.where("severity = 'FAIL'").agg(
        F.count(F.lit(1)).alias("n"), F.min("message").alias("example")).first()
    if failed.n:
        raise ValidationError(f"{failed.n} validation problem(s), among them: {failed.example}")
    return report

"""Check whether the interest rate can be recovered from amount, installment and term."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrears.functions.finance import implied_rate
from arrears.operators.ranks import ROWS_PER_TASK, interpolated_quantiles
from arrears.shared import settle


def implied_rates(loans: DataFrame) -> DataFrame:
    """Loans with their implied yearly rate and its absolute error against the stated rate."""
    solved = loans.withColumn(
        "implied_rate", implied_rate(F.col("loan_amount"), F.col("installment"), F.col("term_months")))
    stated = F.col("interest_rate").try_cast("double")
    stated = F.when(F.abs(stated) < F.lit(float("inf")), stated)
    return solved.withColumn("abs_error", F.abs(F.col("implied_rate") - stated))


def implied_rate_report(loans: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> tuple[DataFrame, DataFrame]:
    """Two tables: one row of agreement figures, and the mean implied rate by grade."""
    columns = [name for name in ("interest_rate", "implied_rate", "abs_error", "grade")
               if name in loans.columns or name in ("implied_rate", "abs_error")]
    rates = settle(implied_rates(loans).select(*columns), "implied-rates")
    solved = rates.where("abs_error IS NOT NULL")
    spread = interpolated_quantiles(
        solved.withColumn("all", F.lit(1)), ["all"], "abs_error", {"median": 0.5, "p95": 0.95}, rows_per_task)
    spread = spread.select(F.struct(F.bround("median", 4).alias("median"), F.bround("p95", 4).alias("p95"))).scalar()
    found = F.col("abs_error").isNotNull()
    stated = F.col("interest_rate").try_cast("double")
    report = rates.agg(
        F.count(F.lit(1)).alias("rows"), F.count("abs_error").alias("rows_solved"),
        F.bround(F.corr(F.when(found, F.col("implied_rate")), F.when(found, stated)), 4)
        .alias("pearson_implied_vs_actual"),
        F.bround(F.avg(F.when(found, (F.col("abs_error") <= 0.1).cast("double"))), 4)
        .alias("share_within_0_1_pct_points"),
    ).select(
        "rows", "rows_solved", "pearson_implied_vs_actual",
        spread.getField("median").alias("median_abs_error_pct_points"),
        spread.getField("p95").alias("p95_abs_error_pct_points"), "share_within_0_1_pct_points")
    if "grade" not in rates.columns:
        return report, rates.limit(0).select(F.lit("").alias("grade"), F.col("implied_rate").alias("mean_implied_rate"))
    by_grade = solved.where("grade IS NOT NULL").groupBy("grade").agg(
        F.bround(F.avg("implied_rate"), 2).alias("mean_implied_rate"))
    return report, by_grade

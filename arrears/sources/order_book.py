"""Raw loans derived from the order tables: one loan record per order, every field text.

The given tables hold no loans, so each order becomes one raw loan record with deterministic fields. Late
duplicates and records with an unreadable month are added on top; no order is left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arrears.constants import RAW_COLUMNS
from arrears.functions.finance import payment

MATURITY_GUARD = "2001-06-01"


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _decimal(value: Column, digits: int = 2) -> Column:
    return value.cast(f"decimal(20,{digits})").cast("string")


def raw_loans(spark: SparkSession, folder: str) -> DataFrame:
    """Orders joined with their customer, nation and line totals, laid out as the raw loan table."""
    # Sums run over whole cents, so the totals do not depend on the order of addition.
    lines = (
        _table(spark, folder, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(
            F.count(F.lit(1)).alias("lines"),
            F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"),
            F.sum(F.round(F.col("l_extendedprice") * 100).cast("bigint")).alias("price_cents"),
            F.sum(F.round(F.col("l_discount") * 100).cast("bigint")).alias("discount_points"),
        )
    )
    nations = _table(spark, folder, "nation").select("n_nationkey", "n_name")
    customers = _table(spark, folder, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    orders = _table(spark, folder, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey"))
    book = orders.join(lines, "o_orderkey", "left")

    k, c = F.col("o_orderkey"), F.col("c_custkey")
    months = F.when(k % 4 == 0, F.lit(60)).otherwise(F.lit(36))
    amount = F.round(F.col("o_totalprice") / 12.5, 2)
    rate = 5 + (k % 2600) / 100
    opened = F.trunc("o_orderdate", "MM")
    # Copy 0 is the loan itself, copy 1 a late duplicate, copy 2 a record whose month cannot be read.
    copies = F.concat(
        F.array(F.lit(0)),
        F.when(k % 97 == 0, F.array(F.lit(1))).otherwise(F.array().cast("array<int>")),
        F.when(k % 1009 == 0, F.array(F.lit(2))).otherwise(F.array().cast("array<int>")),
    )
    copy = F.col("copy")
    issued = F.when(copy == 1, F.add_months(opened, 1)).otherwise(opened)
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    fields = {
        "id": k.cast("string"),
        "member_id": c.cast("string"),
        "loan_amnt": F.when(k % 89 == 0, F.lit("n/a")).otherwise(_decimal(amount)),
        "term": F.concat(F.lit(" "), months.cast("string"), F.lit(" months")),
        "int_rate": _decimal(rate),
        "installment": _decimal(F.round(payment(amount, rate / 1200, months), 2)),
        "grade": F.substring(F.lit("ABCDEFG"), (1 + k % 7).cast("int"), F.lit(1)),
        "issue_d": F.when(copy == 2, F.lit("unknown")).otherwise(F.date_format(issued, "MMM-yyyy")),
        "emp_length": F.when(k % 11 != 0, F.concat((k % 11).cast("string"), F.lit(" years"))),
        "home_ownership": F.col("c_mktsegment"),
        "annual_inc": _decimal(F.round(F.col("c_acctbal") * 10, 2)),
        "verification_status": priority,
        "purpose": F.col("n_name"),
        "initial_list_status": F.when(k % 3 == 0, F.lit("f")).otherwise(F.lit("w")),
        "fico_range_low": (620 + 5 * (k % 47)).cast("string"),
        "fico_range_high": (624 + 5 * (k % 47)).cast("string"),
        "open_acc": F.col("lines").cast("string"),
        "total_acc": F.col("quantity").cast("string"),
        "pub_rec": (k % 3).cast("string"),
        "earliest_cr_line": F.date_format(F.add_months(opened, (-12 * (2 + k % 30)).cast("int")), "MMM-yyyy"),
        "delinq_2yrs": (k % 5).cast("string"),
        "inq_last_6mths": (k % 7).cast("string"),
        "revol_bal": _decimal(F.col("price_cents") / 100),
        "revol_util": _decimal(F.round(F.col("discount_points") * 10 / F.col("lines"), 4), 4),
        "dti": _decimal(((7 * c + k) % 11000) / 100),
        "loan_status": F.when(status == "O", F.lit("Current"))
        .when((status == "P") & (priority == "1-URGENT"), F.lit("Charged Off"))
        .when((status == "P") & (priority == "2-HIGH"), F.lit("Late (16-30 days)"))
        .otherwise(F.lit("Fully Paid")),
    }
    blank = F.lit(None).cast("string")
    return book.withColumn("copy", F.explode(copies)).select(
        *[fields.get(name, blank).alias(name) for name in RAW_COLUMNS])

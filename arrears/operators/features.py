"""Raw text records to the model-ready feature table, and comparison of two builds of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arrears.constants import DEFAULT_STATUSES, MATURITY_GUARD, PAID_STATUS
from arrears.functions.parse import first_integer, month, number
from arrears.operators.ranks import discrete_quantiles
from arrears.shared import settle

SORT_ROWS = 1 << 18  # records up to which dedupe sorts all; row draws of a fit follow the order it leaves
SORT_ALL = 0.1  # records that share their loan id, of all records, above which dedupe sorts all

# Target column, raw column, parser (None keeps the text). Ordered as the staged table lists them.
STAGED = [
    ("loan_id", "id", None),
    ("issue_date", "issue_d", month),
    ("loan_status", "loan_status", None),
    ("loan_amount", "loan_amnt", number),
    ("interest_rate", "int_rate", number),
    ("installment", "installment", number),
    ("term_months", "term", first_integer),
    ("annual_income", "annual_inc", number),
    ("dti", "dti", number),
    ("emp_length", "emp_length", None),
    ("home_ownership", "home_ownership", None),
    ("verification_status", "verification_status", None),
    ("purpose", "purpose", None),
    ("fico_low", "fico_range_low", number),
    ("fico_high", "fico_range_high", number),
    ("open_acc", "open_acc", number),
    ("total_acc", "total_acc", number),
    ("pub_rec", "pub_rec", number),
    ("earliest_cr_line_date", "earliest_cr_line", month),
    ("delinq_2yrs", "delinq_2yrs", number),
    ("inq_last_6mths", "inq_last_6mths", number),
    ("revol_bal", "revol_bal", number),
    ("revol_util", "revol_util", number),
    ("grade", "grade", None),
    ("initial_list_status", "initial_list_status", None),
]


def stage_loans(raw: DataFrame) -> DataFrame:
    """Typed and renamed columns, one output row per raw record, nothing filtered."""
    return raw.select(*[
        (parser(F.col(source)) if parser else F.col(source)).alias(target) for target, source, parser in STAGED
    ])


def label_loans(staged: DataFrame) -> DataFrame:
    """Add the outcome: 1 for a default, 0 for a repaid loan, NULL while it is unknown."""
    status = F.col("loan_status")
    outcome = F.when(status.isin(*DEFAULT_STATUSES), 1).when(status == PAID_STATUS, 0)
    return staged.withColumn("label", outcome.cast("bigint"))


def _earliest(labelled: DataFrame) -> DataFrame:
    """The earliest record of each loan, from a sort of all records."""
    rest = [name for name in labelled.columns if name not in ("loan_id", "issue_date")]
    order = Window.partitionBy("loan_id").orderBy("issue_date", *rest)
    return labelled.withColumn("_nth", F.row_number().over(order)).where("_nth = 1").drop("_nth")


def dedupe_loans(labelled: DataFrame, usable: Column | None = None) -> DataFrame:
    """Keep the earliest record of each loan; a record without a date counts as earliest. ``usable`` names the kept
    records that are returned; the others still count as the earliest.

    Equal dates are settled by the remaining columns, so the same input always keeps the same row. Of more than
    ``SORT_ROWS`` records, the ids alone are shuffled to find those with several records, and only their records are
    sorted, unless these are more than a share of ``SORT_ALL``; the others are a written table. The rank filter runs
    before the shuffle as well as after it, so a loan id shared by very many records leaves each map task once.
    """
    usable = F.lit(True) if usable is None else usable
    records = labelled.count()
    if records <= SORT_ROWS:
        return _earliest(labelled).where(usable)
    repeated = settle(labelled.groupBy(F.col("loan_id").alias("_id")).agg(F.count(F.lit(1)).alias("_records")).where(
        "_records > 1"), "repeated-loans")
    several = repeated.agg(F.coalesce(F.sum("_records"), F.lit(0))).first()[0]
    if several > SORT_ALL * records:
        return settle(_earliest(labelled).where(usable), "earliest")
    marked = labelled.join(repeated, F.col("loan_id").eqNullSafe(F.col("_id")), "left").select(
        *labelled.columns, F.col("_records").isNotNull().alias("_repeated"))
    kept = settle(marked.where(F.col("_repeated") | usable), "records", ["_repeated"])
    first = _earliest(kept.where("_repeated").drop("_repeated")).where(usable)
    return kept.where("NOT _repeated").drop("_repeated").unionByName(first)


def clean_loans(
    staged: DataFrame, maturity_guard: str = MATURITY_GUARD, keep_earliest_line: bool = False,
) -> DataFrame:
    """Label, dedupe, then drop unusable or immature loans, in that order, and add the credit history length.

    The quality filters must stay behind the dedupe: a loan whose earliest record is unusable is dropped whole.
    """
    usable = (
        F.col("issue_date").isNotNull() & F.col("label").isNotNull() & F.col("term_months").isNotNull()
        & (F.col("issue_date") <= F.lit(maturity_guard).cast("date"))
        & (F.col("annual_income") > 0)
        & F.col("dti").between(0, 100)
    )
    history = (F.year("issue_date") - F.year("earliest_cr_line_date")).cast("bigint")
    kept = dedupe_loans(label_loans(staged), usable).withColumn("credit_history_years", history)
    return kept.drop("loan_status") if keep_earliest_line else kept.drop("loan_status", "earliest_cr_line_date")


def cut_dates(clean: DataFrame, train_share: float = 0.8, valid_share: float = 0.9) -> DataFrame:
    """One row with the dates at which the validation and the test period start."""
    return discrete_quantiles(
        clean, [], "issue_date", {"valid_from": train_share, "test_from": valid_share})


def time_split(clean: DataFrame, train_share: float = 0.8, valid_share: float = 0.9) -> DataFrame:
    """Add ``split``: whole months before the first cut date are train, before the second valid, the rest test."""
    cuts = cut_dates(clean, train_share, valid_share).select(F.struct("valid_from", "test_from")).scalar()
    day = F.col("issue_date")
    return clean.withColumn(
        "split",
        F.when(day < cuts.getField("valid_from"), "train").when(day < cuts.getField("test_from"), "valid")
        .otherwise("test"),
    )


def build_features(
    raw: DataFrame, maturity_guard: str = MATURITY_GUARD, train_share: float = 0.8, valid_share: float = 0.9,
    keep_earliest_line: bool = False,
) -> DataFrame:
    """Raw records to the feature table. The cleaned loans are written once, then read for the dates and the rows."""
    clean = clean_loans(stage_loans(raw), maturity_guard, keep_earliest_line)
    if raw.count() <= SORT_ROWS:  # more are written by the dedupe
        clean = settle(clean, "clean")
    return time_split(clean, train_share, valid_share)


def reconcile(left: DataFrame, right: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Compare two builds loan by loan: one row per measure.

    Both builds are stacked and grouped by key, one shuffle with map-side combine, instead of an outer join in which
    a repeated key would multiply. Values are compared for keys found on both sides; repeated keys are counted apart.
    """
    def side(df: DataFrame, is_left: bool) -> DataFrame:
        return df.select(F.col(key), F.lit(is_left).alias("_left"), F.struct(*columns).alias("_row"))

    both = side(left, True).unionByName(side(right, False))
    on_left, on_right = F.col("_left"), ~F.col("_left")
    keyed = both.groupBy(key).agg(
        F.count_if(on_left).alias("_n_left"), F.count_if(on_right).alias("_n_right"),
        F.min(F.when(on_left, F.col("_row"))).alias("_l"), F.min(F.when(on_right, F.col("_row"))).alias("_r"),
    )
    matched = (F.col("_n_left") > 0) & (F.col("_n_right") > 0)
    measures = {
        "rows_left": F.sum("_n_left"),
        "rows_right": F.sum("_n_right"),
        "only_left": F.count_if(F.col("_n_right") == 0),
        "only_right": F.count_if(F.col("_n_left") == 0),
        "repeated_keys": F.count_if((F.col("_n_left") > 1) | (F.col("_n_right") > 1)),
        **{f"mismatch_{name}": F.count_if(matched & ~F.col(f"_l.{name}").eqNullSafe(F.col(f"_r.{name}")))
           for name in columns},
    }
    wide = keyed.agg(*[F.coalesce(value, F.lit(0)).cast("bigint").alias(name) for name, value in measures.items()])
    return wide.unpivot([], list(measures), "measure", "loans")

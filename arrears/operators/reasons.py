"""Reason codes for declined applicants, and checks on the explanations."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrears.constants import (
    COUNTER_OFFER_NOTE, DECLINE_RATE, EXPECTED_SIGNS, MIN_LOGODDS, NON_REPORTABLE_GROUPS, REASON_GROUPS, REASON_TEXTS,
    SHORT_TERM, TERM_DEPENDENT, TERM_GROUP, TERM_NOTE, TOP_REASONS)
from arrears.operators.ranks import ROWS_PER_TASK, interpolated_quantiles, spearman
from arrears.shared import settle


def decline_cutoff(scored: DataFrame, decline_rate: float = DECLINE_RATE, rows_per_task: int = ROWS_PER_TASK) -> Column:
    """Score at which the riskiest share begins, interpolated, as a scalar usable in filters."""
    every = scored.select(F.lit(1).alias("all"), "p_default")
    return settle(interpolated_quantiles(every, ["all"], "p_default", {"cutoff": 1 - decline_rate}, rows_per_task),
                  "cutoff").select("cutoff").scalar()


def with_decision(scored: DataFrame, cutoff: float | None = None, decline_rate: float = DECLINE_RATE) -> DataFrame:
    """Add ``cutoff`` and ``declined``; a score equal to the cutoff is declined."""
    limit = F.lit(cutoff) if cutoff is not None else decline_cutoff(scored, decline_rate)
    return scored.withColumn("cutoff", limit).withColumn("declined", F.col("p_default") >= F.col("cutoff"))


def group_contributions(folded: DataFrame, features: list[str]) -> DataFrame:
    """Sum ``phi_<input>`` into ``grp_<group>``; an input without a group belongs to ``other``."""
    groups = defaultdict(list)
    for name in features:
        groups[REASON_GROUPS.get(name, "other")].append(F.col(f"phi_{name}"))
    return folded.withColumns({f"grp_{group}": sum(parts[1:], parts[0]) for group, parts in groups.items()})


def _groups(df: DataFrame) -> list[str]:
    return [name.removeprefix("grp_") for name in df.columns if name.startswith("grp_")]


def top_reasons(
    grouped: DataFrame, k: int = TOP_REASONS, min_logodds: float = MIN_LOGODDS, separate_term: bool = True,
) -> DataFrame:
    """Add ``n_reasons`` and the ``k`` strongest reportable reasons above the floor, strongest first.

    The handful of groups is sorted inside the row. Equal strengths are settled by the code. Loans with fewer reasons
    have NULL in the remaining columns.
    """
    hidden = {*NON_REPORTABLE_GROUPS, *([TERM_GROUP] if separate_term else [])}
    reportable = [g for g in _groups(grouped) if g in REASON_TEXTS and g not in hidden]
    candidates = F.array(*[
        F.struct((-F.col(f"grp_{g}")).alias("weakness"), F.lit(REASON_TEXTS[g][0]).alias("code"),
                 F.lit(REASON_TEXTS[g][1]).alias("text")) for g in reportable])
    strong = F.filter(candidates, lambda reason: reason["weakness"] < -min_logodds)
    ranked = grouped.withColumn("_reasons", F.slice(F.sort_array(strong), 1, k))
    wide = {"n_reasons": F.size("_reasons").cast("bigint")}
    for i in range(k):
        reason = F.get("_reasons", F.lit(i))
        wide[f"reason_{i + 1}_code"] = reason["code"]
        wide[f"reason_{i + 1}_text"] = reason["text"]
        wide[f"reason_{i + 1}_logodds"] = F.bround(-reason["weakness"], 4)
    return ranked.withColumns(wide).drop("_reasons")


def term_counter_offer(
    declined: DataFrame, features: list[str], rescore: Callable[[DataFrame, str], DataFrame] | None = None,
    min_logodds: float = MIN_LOGODDS,
) -> DataFrame:
    """Add the note on the loan term and, where possible, whether a 36-month loan would be approved.

    ``rescore(loans, column)`` adds the model's score. It is used only when no input of the model depends on the term
    itself; otherwise the counter-offer columns stay NULL.
    """
    # A model that does not use the term at all has nothing to note.
    term = F.col(f"grp_{TERM_GROUP}") if TERM_GROUP in _groups(declined) else F.lit(None).cast("double")
    noted = F.coalesce(term > min_logodds, F.lit(False))
    rows = declined.withColumns({
        "term_logodds": F.bround(term, 4), "_noted": noted,
        "p_default_36m": F.lit(None).cast("double"), "qualifies_at_36m": F.lit(None).cast("boolean")})
    if can_rescore(features) and rescore is not None:
        columns = rows.columns
        short = rows.withColumnRenamed("term_months", "_asked").withColumn("term_months", F.lit(SHORT_TERM).cast("bigint"))
        rows = rescore(short, "_short").drop("term_months").withColumnRenamed("_asked", "term_months")
        longer = F.coalesce(F.col("term_months") > SHORT_TERM, F.lit(False))
        rows = rows.withColumns({
            "p_default_36m": F.when(longer, F.bround("_short", 4)),
            "qualifies_at_36m": longer & (F.col("_short") < F.col("cutoff"))}).select(*columns)
    note = F.when(F.col("qualifies_at_36m"), COUNTER_OFFER_NOTE).when(F.col("_noted"), TERM_NOTE).otherwise("")
    return rows.withColumn("term_note", note).withColumnRenamed("_noted", "term_noted")


def can_rescore(features: list[str]) -> bool:
    """Whether the term can be changed without recomputing another input of the model."""
    return "term_months" in features and not set(TERM_DEPENDENT) & set(features)


def explain_declines(
    explained: DataFrame, features: list[str], k: int = TOP_REASONS, min_logodds: float = MIN_LOGODDS,
    separate_term: bool = True, rescore: Callable[[DataFrame, str], DataFrame] | None = None,
) -> DataFrame:
    """Declined loans with their reasons and term note; ``explained`` carries decision and folded contributions."""
    grouped = group_contributions(explained.where("declined"), features)
    reasons = top_reasons(grouped, k, min_logodds, separate_term)
    return term_counter_offer(reasons, features, rescore, min_logodds) if separate_term else reasons


def reason_table(declines: DataFrame, k: int = TOP_REASONS) -> DataFrame:
    """The stored form: one row per declined loan."""
    reasons = [f"reason_{i}_{part}" for i in range(1, k + 1) for part in ("code", "text", "logodds")]
    term = [c for c in ("term_logodds", "term_note", "p_default_36m", "qualifies_at_36m") if c in declines.columns]
    known = [c for c in ("issue_date", "term_months") if c in declines.columns]  # an applicant has no issue date yet
    return declines.select(
        "loan_id", *known, F.bround("p_default", 4).alias("p_default"), "n_reasons", *reasons, *term)


def direction_check(explained: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Does each input push risk in the expected direction? Rank correlation of value and contribution.

    Inputs with under 50 values, under 3 distinct values or a constant contribution are left out.
    """
    checked = [name for name in EXPECTED_SIGNS if f"phi_{name}" in explained.columns and name in explained.columns]
    pairs = [F.struct(F.lit(name).alias("feature"), F.col(name).try_cast("double").alias("x"),
                      F.col(f"phi_{name}").alias("phi_value")) for name in checked]
    long = explained.select(F.inline(F.array(*pairs))).where("x IS NOT NULL")
    signs = F.create_map(*[F.lit(item) for name in checked for item in (name, EXPECTED_SIGNS[name])])
    rho = spearman(long, ["feature"], "x", "phi_value", rows_per_task)
    return rho.where("rows >= 50 AND distinct_x >= 3 AND distinct_y >= 2").select(
        "feature", F.bround("rho", 3).alias("spearman_value_vs_phi"),
        F.element_at(signs, F.col("feature")).cast("bigint").alias("expected_sign"),
        (F.signum("rho") == F.element_at(signs, F.col("feature"))).alias("consistent"))


def reason_summary(
    explained: DataFrame, declines: DataFrame, k: int = TOP_REASONS, separate_term: bool = True,
) -> DataFrame:
    """Diagnostics of an explanation run in long form: ``measure, subject, value``."""
    total = F.aggregate("phi", F.lit(0.0), lambda acc, value: acc + value)
    declined = F.col("declined")
    overall = {
        "rows_scored": F.count(F.lit(1)).cast("double"),
        "pd_cutoff": F.bround(F.max("cutoff"), 4),
        "declined": F.count_if(declined).cast("double"),
        "decline_rate": F.bround(F.avg(declined.cast("double")), 4),
        "additivity_max_error": F.max(F.abs(total + F.col("bias") - F.col("margin"))),
    }
    longer = F.bround(F.avg((F.col("term_months") > SHORT_TERM).cast("double")), 4)
    # Applicants have no outcome, and may come without a term.
    if "label" in explained.columns:
        overall["declined_default_rate"] = F.bround(F.avg(F.when(declined, F.col("label"))), 4)
    if "term_months" in explained.columns:
        overall["share_all_on_longer_term"] = longer
    groups = _groups(declines)
    every = sum([F.abs(f"grp_{g}") for g in groups[1:]], F.abs(f"grp_{groups[0]}"))
    hidden = [F.abs(f"grp_{g}") for g in groups if g in NON_REPORTABLE_GROUPS]
    hidden_share = F.avg(F.try_divide(sum(hidden[1:], hidden[0]), every)) if hidden else F.lit(0.0)
    among = {
        "share_declined_with_no_reportable_reason": F.bround(F.avg((F.col("n_reasons") == 0).cast("double")), 4),
        "mean_reasons_per_decline": F.bround(F.avg("n_reasons"), 2),
        "nonreportable_share_of_explanation": F.bround(hidden_share, 4),
    }
    if "term_months" in declines.columns:
        among["share_declined_on_longer_term"] = longer
    if separate_term:
        among["share_declined_with_term_note"] = F.bround(F.avg(F.col("term_noted").cast("double")), 4)
        among["share_declined_qualifying_at_36m"] = F.bround(F.avg(F.col("qualifies_at_36m").cast("double")), 4)

    def long(df: DataFrame, figures: dict[str, Column]) -> DataFrame:
        wide = df.agg(*[value.alias(name) for name, value in figures.items()])
        return wide.unpivot([], list(figures), "measure", "value").select(
            "measure", F.lit("all").alias("subject"), "value")

    # Codes are few, so both frequency tables come from one small aggregation of the reason columns.
    codes = F.array(*[F.struct(F.lit(i == 1).alias("first"), F.col(f"reason_{i}_code").alias("subject"))
                      for i in range(1, k + 1)])
    counted = declines.select(F.inline(codes)).where("subject IS NOT NULL").groupBy("subject").agg(
        F.count_if("first").alias("first"), F.count(F.lit(1)).alias("any"))
    size = declines.agg(
        F.count(F.lit(1)).alias("declined"), F.count("reason_1_code").alias("with_first"))
    size = settle(size, "decline-count").select(F.struct("declined", "with_first")).scalar()
    frequency = counted.select(F.inline(F.array(
        F.struct(F.lit("reason_1_frequency").alias("measure"), F.col("subject"),
                 F.bround(F.try_divide(F.col("first"), size.getField("with_first")), 3).alias("value")),
        F.struct(F.lit("reason_in_top_k_frequency").alias("measure"), F.col("subject"),
                 F.bround(F.try_divide(F.col("any"), size.getField("declined")), 3).alias("value")),
    ))).where("measure <> 'reason_1_frequency' OR value > 0")
    return long(explained, overall).unionByName(long(declines, among)).where("value IS NOT NULL").unionByName(frequency)

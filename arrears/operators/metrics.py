"""Ranking quality and calibration of scored loans, computed on the score histogram."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrears.constants import TOP_FRACTIONS
from arrears.operators.ranks import (
    ROWS_PER_TASK, cumulate, histogram, interpolated_quantiles, number_rows, percent_rank_from)
from arrears.shared import settle

RUN_KEYS = ["model_version", "split"]


def _pct(fraction: float) -> str:
    return f"{round(fraction * 100)}pct"


def run_time(run_ts: str) -> Column:
    """The one timestamp that marks every row of a run."""
    return F.lit(run_ts).cast("timestamp")


def score_histogram(scored: DataFrame, groups: list[str], score: str, label: str) -> DataFrame:
    """Loans ``n`` and defaults ``pos`` per distinct score."""
    return histogram(scored.withColumn("pos", F.col(label).cast("bigint")), groups, score, ["pos"])


def ranking_rollups(
    scored: DataFrame, run_ts: str, groups: list[str] = RUN_KEYS, score: str = "p_default", label: str = "label",
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Default rate, lift and recall of the riskiest 1, 5 and 10% by percent rank, ties included."""
    scored = scored.where(F.col(score).isNotNull() & F.col(label).isNotNull())
    hist = score_histogram(scored, groups, score, label)
    ranked = percent_rank_from(cumulate(hist, groups, score, ["n", "pos"], True, rows_per_task))
    inside = {f: F.col("pct_rank") <= F.lit(f) for f in TOP_FRACTIONS}
    totals = ranked.groupBy(*groups).agg(
        F.sum("n").alias("n"), F.sum("pos").alias("pos"),
        *[F.sum(F.when(inside[f], F.col("n"))).alias(f"_n_{_pct(f)}") for f in TOP_FRACTIONS],
        *[F.sum(F.when(inside[f], F.col("pos"))).alias(f"_pos_{_pct(f)}") for f in TOP_FRACTIONS])
    base = F.try_divide(F.col("pos"), F.col("n"))
    rate = {f: F.try_divide(F.col(f"_pos_{_pct(f)}"), F.col(f"_n_{_pct(f)}")) for f in TOP_FRACTIONS}
    return totals.select(
        run_time(run_ts).alias("ts"), *groups, "n", base.alias("base_rate"),
        *[rate[f].alias(f"top_{_pct(f)}_default_rate") for f in TOP_FRACTIONS],
        *[F.try_divide(rate[f], base).alias(f"lift_at_{_pct(f)}") for f in TOP_FRACTIONS],
        *[F.try_divide(F.col(f"_pos_{_pct(f)}"), F.col("pos")).alias(f"recall_at_{_pct(f)}") for f in TOP_FRACTIONS])


def _exact_top(scored: DataFrame, ranked: DataFrame, groups: list[str], score: str, label: str, unique: str) -> DataFrame:
    """Defaults among exactly the ``k`` highest scores, per group and fraction.

    Whole scores above the cut come from the histogram. Only the loans that share the score at the cut are put in
    order, by their id, to pick the few that still fit.
    """
    k = {f: F.greatest(F.lit(1), F.floor(F.col("total_n") * F.lit(f))) for f in TOP_FRACTIONS}
    end = F.col("before_n") + F.col("n")
    room = {f: F.when((F.col("before_n") < k[f]) & (k[f] < end), k[f] - F.col("before_n")) for f in TOP_FRACTIONS}
    whole = ranked.groupBy(*groups).agg(
        *[F.max(k[f]).alias(f"k_{_pct(f)}") for f in TOP_FRACTIONS],
        *[F.sum(F.when(end <= k[f], F.col("pos")).otherwise(0)).alias(f"_whole_{_pct(f)}") for f in TOP_FRACTIONS])
    cuts = ranked.select(*groups, score, *[room[f].alias(f"_room_{_pct(f)}") for f in TOP_FRACTIONS])
    cuts = settle(cuts.where(F.coalesce(*[F.col(f"_room_{_pct(f)}") for f in TOP_FRACTIONS]).isNotNull()), "cuts")
    tied = scored.select(*groups, score, label, unique).join(cuts, [*groups, score])
    placed = number_rows(tied, [*groups, score], [F.col(unique)])
    partial = placed.groupBy(*groups).agg(*[
        F.sum(F.when(F.col("position") <= F.col(f"_room_{_pct(f)}"), F.col(label)).otherwise(0)).alias(f"_tied_{_pct(f)}")
        for f in TOP_FRACTIONS])
    return whole.join(partial, groups, "left").select(
        *groups, *[F.col(f"k_{_pct(f)}") for f in TOP_FRACTIONS],
        *[(F.col(f"_whole_{_pct(f)}") + F.coalesce(F.col(f"_tied_{_pct(f)}"), F.lit(0))).alias(f"top_{_pct(f)}_defaults")
          for f in TOP_FRACTIONS])


def exact_topk(
    scored: DataFrame, groups: list[str], score: str = "p_default", label: str = "label", unique: str = "loan_id",
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Size and number of defaults of the top 1, 5 and 10%, cut at an exact number of loans."""
    hist = score_histogram(scored, groups, score, label)
    ranked = settle(cumulate(hist, groups, score, ["n", "pos"], True, rows_per_task), "ranked")
    return _exact_top(scored, ranked, groups, score, label, unique)


def binary_metrics(
    scored: DataFrame, groups: list[str], score: str = "p_default", label: str = "label", unique: str = "loan_id",
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """ROC-AUC, average precision, Brier score, base rate and exact top-K figures, one row per group.

    ``scored`` is read twice and should be a written table.
    """
    hist = score_histogram(scored, groups, score, label)
    ranked = settle(cumulate(hist, groups, score, ["n", "pos"], True, rows_per_task), "ranked")
    p, n, pos = F.col(score), F.col("n").cast("double"), F.col("pos").cast("double")
    bad, good = F.col("total_pos").cast("double"), (F.col("total_n") - F.col("total_pos")).cast("double")
    good_here = n - pos
    good_below = good - (F.col("before_n") - F.col("before_pos")) - good_here
    precision = (F.col("before_pos") + pos) / (F.col("before_n") + n)
    summary = ranked.groupBy(*groups).agg(
        F.sum("n").alias("n"),
        F.sum("pos").alias("defaults"),
        F.try_divide(F.sum(pos * (good_below + good_here / 2)), F.max(bad * good)).alias("roc_auc"),
        F.try_divide(F.sum(pos * precision), F.max(bad)).alias("pr_auc"),
        (F.sum(pos * F.pow(p - 1, F.lit(2.0)) + good_here * F.pow(p, F.lit(2.0))) / F.sum(n)).alias("brier"),
        (F.sum(pos) / F.sum(n)).alias("base_rate"))
    top = _exact_top(scored, ranked, groups, score, label, unique)
    rate = {f: F.col(f"top_{_pct(f)}_defaults") / F.col(f"k_{_pct(f)}") for f in TOP_FRACTIONS}
    lift = {f: F.coalesce(F.try_divide(rate[f], F.col("base_rate")), F.lit(0.0)) for f in TOP_FRACTIONS}
    found = {f: F.col(f"top_{_pct(f)}_defaults") / F.greatest(F.lit(1), F.col("defaults")) for f in TOP_FRACTIONS}
    figures = []
    for f in TOP_FRACTIONS:
        figures += [rate[f].alias(f"top_{_pct(f)}_default_rate"), lift[f].alias(f"lift_at_{_pct(f)}"),
                    found[f].alias(f"recall_at_{_pct(f)}")]
    return summary.join(top, groups).select(
        *groups, "n", "roc_auc", "pr_auc", "brier", "base_rate", *figures)


def metrics_row(metrics: DataFrame, run_ts: str) -> DataFrame:
    """Stored form of the metrics: headline columns under their historical names plus the full set as JSON.

    The columns named ``*_precision`` hold the default rate of the top K.
    """
    names = ["roc_auc", "pr_auc", "brier", "base_rate"]
    for f in TOP_FRACTIONS:
        names += [f"top_{_pct(f)}_default_rate", f"lift_at_{_pct(f)}", f"recall_at_{_pct(f)}"]
    legacy = []
    for f in TOP_FRACTIONS:
        legacy += [F.col(f"top_{_pct(f)}_default_rate").alias(f"top_{_pct(f)}_precision"),
                   F.col(f"recall_at_{_pct(f)}").alias(f"top_{_pct(f)}_recall")]
    return metrics.select(
        run_time(run_ts).alias("ts"), "model_version", "split", F.to_json(F.struct(*names)).alias("metrics_json"),
        "roc_auc", "pr_auc", "brier", *legacy)


def reliability_curve(
    scored: DataFrame, groups: list[str], score: str = "p_default", label: str = "label", bins: int = 10,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Mean predicted against observed default rate in bins of equal count; a bin that ties leave empty is absent."""
    names = {f"_edge_{i}": i / bins for i in range(1, bins)}
    edges = settle(interpolated_quantiles(scored, groups, score, names, rows_per_task), "edges")
    hist = score_histogram(scored, groups, score, label)
    passed = [F.when(F.col(edge) < F.col(score), 1).otherwise(0) for edge in names]
    place = passed[0]
    for one in passed[1:]:
        place = place + one
    n = F.sum("n")
    return hist.join(edges, groups).withColumn("bin", place.cast("bigint")).groupBy(*groups, "bin").agg(
        n.alias("loans"),
        (F.sum(F.col(score) * F.col("n")) / n).alias("mean_predicted"),
        (F.sum("pos") / n).alias("observed_rate"))


def brier_skill(scored: DataFrame, groups: list[str], score: str = "p_default", label: str = "label") -> DataFrame:
    """Brier score against that of always predicting the base rate."""
    base = F.avg(label)
    summary = scored.groupBy(*groups).agg(
        base.alias("base_rate"), F.avg(F.pow(F.col(score) - F.col(label), F.lit(2.0))).alias("brier"))
    ceiling = F.col("base_rate") * (1 - F.col("base_rate"))
    return summary.withColumn("brier_ceiling", ceiling).withColumn(
        "brier_skill", 1 - F.try_divide(F.col("brier"), F.col("brier_ceiling")))

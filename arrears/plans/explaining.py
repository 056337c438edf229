"""The explanation run: decide, explain, store the reason codes and the diagnostics."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame

from arrears.constants import DECLINE_RATE, MIN_LOGODDS, TOP_REASONS
from arrears.operators.contributions import fold_contributions, tree_contributions
from arrears.operators.model import DefaultModel
from arrears.operators.reasons import direction_check, explain_declines, reason_summary, reason_table, with_decision
from arrears.shared import settle

ADDITIVITY_LIMIT = 1e-3


def explanation_run(
    model: DefaultModel, loans: DataFrame, folder: str, cutoff: float | None = None, decline_rate: float = DECLINE_RATE,
    top_k: int = TOP_REASONS, min_logodds: float = MIN_LOGODDS, separate_term: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """Explain all ``loans``, report the declined ones. Writes the reason table as Parquet and CSV, and the summary and
    the direction check as JSON; returns the table and the summary."""
    scored = settle(model.score(tree_contributions(model, loans), margin="margin"), "explained")
    explained = fold_contributions(with_decision(scored, cutoff, decline_rate), model.owners)
    inputs = [*model.numeric, *model.categorical]
    declines = settle(explain_declines(explained, inputs, top_k, min_logodds, separate_term, model.score), "declines")
    table = reason_table(declines, top_k)
    summary = settle(reason_summary(explained, declines, top_k, separate_term), "reason-summary")
    folder = folder.rstrip("/")
    table.write.mode("overwrite").parquet(f"{folder}/reason_codes")
    table.write.mode("overwrite").option("header", True).csv(f"{folder}/reason_codes_csv")
    summary.write.mode("overwrite").json(f"{folder}/summary")
    direction_check(explained).write.mode("overwrite").json(f"{folder}/direction_check")
    error = summary.where("measure = 'additivity_max_error'").first()
    if error and error.value > ADDITIVITY_LIMIT:
        warnings.warn(f"contributions do not add up to the margin: error {error.value}", stacklevel=2)
    return loans.sparkSession.read.schema(table.schema).parquet(f"{folder}/reason_codes"), summary

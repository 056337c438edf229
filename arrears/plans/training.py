"""The training run: validate, fit, evaluate, store the metrics, save the model."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame

from arrears.constants import MATURITY_GUARD, SCORED_SPLITS
from arrears.operators.metrics import metrics_row
from arrears.operators.model import ROUNDS, DefaultModel, evaluate_splits, feature_columns, train_model
from arrears.operators.quality import enforce, validate_splits
from arrears.plans.monitoring import Store
from arrears.shared import settle


def training_run(
    store: Store, features: DataFrame, version: str, run_ts: str, feature_set: str = "full", rounds: int = ROUNDS,
    calibrate: bool = True, limit: int | None = None, maturity_guard: str = MATURITY_GUARD, skip_validation: bool = False,
    skip_metrics: bool = False, save_to: str | None = None, report_to: str | None = None, log: str | None = None,
) -> tuple[DefaultModel, DataFrame]:
    """One run; returns the model and its metrics on the validation and test split.

    A failed validation stops the run before any time is spent on fitting. A failed write of the metrics is only a
    warning: it must not lose a fitted model. ``limit`` rows per split make a trial run, which need not be full size.
    A run that is repeated with the same ``log`` folder continues the fit of the broken one.
    """
    store.create()
    if not skip_validation:
        numeric, categorical = feature_columns(feature_set)
        enforce(validate_splits(features, numeric, categorical, limit is not None, maturity_guard), report_to)
    model = train_model(features, version, feature_set, rounds, calibrate, limit, log=log)
    metrics = settle(evaluate_splits(model, features, SCORED_SPLITS), "metrics")
    if not skip_metrics:
        try:
            store.append("model_metrics", metrics_row(metrics, run_ts))
        except Exception as error:  # noqa: BLE001
            warnings.warn(f"the metrics of {version} were not stored: {error}", stacklevel=2)
    if save_to:
        model.save(save_to)
    return model, metrics

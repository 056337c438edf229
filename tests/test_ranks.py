"""Ranks against plain NumPy, with one task and with many value ranges."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from arrears.operators import metrics, ranks
from arrears.shared import settle


@pytest.fixture(scope="module")
def scores():
    """Two groups; a third of the larger one shares a single score."""
    r = np.random.default_rng(5)
    n = 3000
    p = np.round(r.random(n), 3)
    p[: n // 3] = 0.25
    return pd.DataFrame({
        "model_version": np.where(r.random(n) < 0.8, "a", "b"), "split": "test", "loan_id": [f"{i:05d}" for i in r.permutation(n)],
        "p_default": p, "label": (r.random(n) < p).astype("int64")})


@pytest.fixture(scope="module")
def scored(spark, scores):
    return settle(spark.createDataFrame(scores), "test-scores")


@pytest.mark.parametrize("rows_per_task", [ranks.ROWS_PER_TASK, 40])
def test_percent_rank(scored, scores, rows_per_task):
    hist = ranks.histogram(scored, metrics.RUN_KEYS, "p_default")
    got = ranks.percent_rank_from(
        ranks.cumulate(hist, metrics.RUN_KEYS, "p_default", ["n"], True, rows_per_task)).toPandas()
    for version, group in scores.groupby("model_version"):
        rank = group.p_default.rank(method="min", ascending=False)
        want = dict(zip(group.p_default, (rank - 1) / (len(group) - 1)))
        mine = got[got.model_version == version]
        assert len(mine) == group.p_default.nunique()
        assert np.allclose(mine.pct_rank, mine.p_default.map(want))


@pytest.mark.parametrize("rows_per_task", [ranks.ROWS_PER_TASK, 40])
def test_quantiles(scored, scores, rows_per_task):
    shares = {"a": 0.0, "b": 0.1, "c": 0.5, "d": 0.973, "e": 1.0}
    got = ranks.interpolated_quantiles(scored, ["model_version"], "p_default", shares, rows_per_task).toPandas()
    for row in got.itertuples():
        values = scores[scores.model_version == row.model_version].p_default
        assert np.allclose([getattr(row, k) for k in shares], np.quantile(values, list(shares.values())))
    got = ranks.discrete_quantiles(scored, ["model_version"], "p_default", shares, rows_per_task).toPandas()
    for row in got.itertuples():
        values = scores[scores.model_version == row.model_version].p_default
        want = np.quantile(values, list(shares.values()), method="inverted_cdf")
        assert np.allclose([getattr(row, k) for k in shares], want)


@pytest.mark.parametrize("partitions", [1, 7])
def test_number_rows(spark, scored, scores, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    coalesce = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        got = ranks.number_rows(scored, ["model_version"], [F.desc("p_default"), F.col("loan_id")]).toPandas()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
    assert len(got) == len(scores)
    for version, group in scores.groupby("model_version"):
        order = group.sort_values(["p_default", "loan_id"], ascending=[False, True]).loan_id.tolist()
        mine = got[got.model_version == version]
        assert mine.sort_values("position").loan_id.tolist() == order
        assert set(mine.position_of) == {len(group)}


@pytest.mark.parametrize("size", [1, 99, 100, 101, 250, 1234])
def test_band_of(spark, size):
    rows = spark.range(1, size + 1).select(ranks.band_of(F.col("id"), F.lit(size), 100).alias("band")).toPandas()
    base, larger = divmod(size, 100)
    want = [i + 1 for i in range(100) for _ in range(base + (i < larger))]
    assert rows.band.tolist() == want


@pytest.mark.parametrize("rows_per_task", [ranks.ROWS_PER_TASK, 40])
def test_binary_metrics(scored, scores, rows_per_task):
    got = metrics.binary_metrics(scored, metrics.RUN_KEYS, rows_per_task=rows_per_task).toPandas().set_index("model_version")
    for version, group in scores.groupby("model_version"):
        row, y, p = got.loc[version], group.label.to_numpy(), group.p_default.to_numpy()
        wins = (p[y == 1][:, None] > p[y == 0][None, :]).mean() + (p[y == 1][:, None] == p[y == 0][None, :]).mean() / 2
        steps = [((p >= s) & (y == 1)).sum() / (p >= s).sum() * ((p == s) & (y == 1)).sum() for s in np.unique(p)]
        assert row.roc_auc == pytest.approx(wins)
        assert row.pr_auc == pytest.approx(sum(steps) / y.sum())
        assert row.brier == pytest.approx(((p - y) ** 2).mean())
        ordered = group.sort_values(["p_default", "loan_id"], ascending=[False, True]).label.to_numpy()
        for f, name in ((0.01, "1pct"), (0.05, "5pct"), (0.10, "10pct")):
            top = ordered[: max(1, int(len(y) * f))]
            assert row[f"top_{name}_default_rate"] == pytest.approx(top.mean())
            assert row[f"recall_at_{name}"] == pytest.approx(top.sum() / y.sum())


def test_single_class_has_no_auc(spark):
    rows = spark.createDataFrame([("a", "t", str(i), i / 10, 0) for i in range(5)],
                                 "model_version string, split string, loan_id string, p_default double, label long")
    row = metrics.binary_metrics(settle(rows), metrics.RUN_KEYS).first()
    assert row.roc_auc is None and row.pr_auc is None and row.lift_at_1pct == 0


@pytest.mark.parametrize("rows_per_task", [ranks.ROWS_PER_TASK, 40])
def test_spearman(spark, rows_per_task):
    r = np.random.default_rng(9)
    x = r.integers(0, 60, 2000)
    data = pd.DataFrame({"g": "all", "x": x.astype(float), "y": np.round(x + r.normal(0, 30, 2000))})
    got = ranks.spearman(spark.createDataFrame(data), ["g"], "x", "y", rows_per_task).first()
    assert got.rho == pytest.approx(data.x.rank().corr(data.y.rank()))
    assert (got.distinct_x, got.distinct_y) == (data.x.nunique(), data.y.nunique())


def test_reliability_bins_cover_all_rows(scored, scores):
    got = metrics.reliability_curve(scored, metrics.RUN_KEYS, rows_per_task=40).toPandas()
    for version, group in scores.groupby("model_version"):
        edges = np.percentile(group.p_default, np.arange(10, 100, 10))
        want = np.bincount(np.searchsorted(edges, group.p_default), minlength=10)
        mine = got[got.model_version == version].set_index("bin").loans
        assert {i: n for i, n in enumerate(want) if n} == mine.to_dict()

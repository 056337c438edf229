"""Additive contributions of each input to a loan's log-odds: exact for linear models and for boosted trees.

Both producers add ``phi`` (one value per encoded slot), ``bias`` and ``margin`` with ``sum(phi) + bias = margin``.
A loan's contributions stay in its own row; folding and ranking them needs no shuffle.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import factorial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrears.operators.boosting import DEPTH, INNER, Forest, Tree, goes_left
from arrears.operators.model import DefaultModel


@dataclass
class LinearModel:
    """Linear log-odds model: weights of numeric inputs and of categories, centred on the means of a background."""

    numeric: dict[str, float]
    categorical: dict[str, dict[str, float]]
    intercept: float
    means: list[float] = field(default_factory=list)

    def _slots(self) -> list[tuple[str, str | None, float]]:
        return [(c, None, w) for c, w in self.numeric.items()] + [
            (c, level, w) for c, levels in self.categorical.items() for level, w in levels.items()]

    @property
    def owners(self) -> list[str]:
        """Original input of each slot."""
        return [c for c, _, _ in self._slots()]

    def _value(self, name: str, level: str | None) -> Column:
        if level is None:
            return F.col(name).cast("double")
        return F.coalesce(F.col(name) == level, F.lit(False)).cast("double")

    def fit(self, background: DataFrame) -> LinearModel:
        """Set the means. They are parameters of the model, one number per slot, fetched in one row."""
        row = background.agg(*[F.avg(self._value(c, level)).alias(f"m{i}")
                               for i, (c, level, _) in enumerate(self._slots())]).first()
        self.means = [float(m) for m in row]
        return self

    def margin(self) -> Column:
        """Log-odds; a missing number counts as the mean."""
        total = F.lit(self.intercept)
        for (c, level, weight), mean in zip(self._slots(), self.means):
            total = total + F.coalesce(self._value(c, level), F.lit(mean)) * weight
        return total

    def score(self, loans: DataFrame, out: str = "p_default") -> DataFrame:
        return loans.withColumn(out, F.lit(1.0) / (1 + F.exp(-self.margin())))

    def contributions(self, loans: DataFrame) -> DataFrame:
        """Weight times distance from the mean for each slot."""
        slots = list(zip(self._slots(), self.means))
        phi = [(F.coalesce(self._value(c, level), F.lit(mean)) - mean) * weight for (c, level, weight), mean in slots]
        bias = self.intercept + sum(weight * mean for (_, _, weight), mean in slots)
        return loans.withColumns({"phi": F.array(*phi), "bias": F.lit(bias), "margin": self.margin()})


def _path_tables(tree: Tree) -> tuple[np.ndarray, float]:
    """For each leaf, answer pattern and level of its path: the contribution of that level's slot. And the mean margin.

    A leaf is a small game: the slots on its path are the players, each either sends the loan towards the leaf or leaves
    it at the share of training weight that went there. A slot asked twice is one player, at the place of its first
    question; the other place is a player without influence. Weights of the players' orders come from the coefficients
    of a product of one linear term per other player.
    """
    leaf, cover = np.arange(INNER + 1), np.array(tree.cover)
    node = np.stack([(leaf + INNER + 1 >> DEPTH - level) - 1 for level in range(DEPTH + 1)], 1)
    slot, inner = np.array(tree.slot), node[:, :-1]
    asked, weight = slot[inner], np.maximum(cover[inner], 1e-300)
    share = np.where(asked < 0, node[:, 1:] % 2 == 1, cover[node[:, 1:]] / weight)
    first = np.argmax(asked[:, :, None] == asked[:, None, :], axis=2)
    absent = np.ones((len(leaf), DEPTH))
    present = np.ones((len(leaf), 2 ** DEPTH, DEPTH))
    pattern = np.arange(2 ** DEPTH)
    for level in range(DEPTH):
        absent[leaf, first[:, level]] *= share[:, level]
        present[leaf[:, None], pattern[None, :], first[:, level][:, None]] *= pattern >> level & 1
    value = np.array(tree.leaf)
    table = np.zeros_like(present)
    for player in range(DEPTH):
        others = [p for p in range(DEPTH) if p != player]
        terms = [np.ones(present.shape[:2])]  # by number of players known
        for other in others:
            unknown, known = absent[:, None, other], present[:, :, other]
            terms = [sum(parts) for parts in zip([t * unknown for t in terms] + [0.0], [0.0] + [t * known for t in terms])]
        orders = sum(t * factorial(n) * factorial(DEPTH - n - 1) for n, t in enumerate(terms)) / factorial(DEPTH)
        table[:, :, player] = value[:, None] * (present[:, :, player] - absent[:, None, player]) * orders
    return table, float((value * absent.prod(axis=1)).sum())


def _half_tables(tree: Tree) -> list[tuple[list[int], list[int], np.ndarray]]:
    """For each half of a tree below its root: the nodes on the paths to its leaves, the slots they ask, and by slot and
    pattern of the nodes' answers (the first node in the lowest bit, set for left) the contribution of all its leaves."""
    table, halves = _path_tables(tree)[0], []
    for leaves in np.split(np.arange(INNER + 1), 2):
        paths = [[(int(leaf) + INNER + 1 >> DEPTH - level) - 1 for level in range(DEPTH + 1)] for leaf in leaves]
        nodes = sorted({node for path in paths for node in path[:-1]})
        slots = sorted({tree.slot[node] for node in nodes} - {-1})
        every = np.arange(2 ** len(nodes))
        values = np.zeros((len(slots), len(every)))
        for leaf, path in zip(leaves, paths):
            pattern = sum(((every >> nodes.index(node) & 1) == after % 2).astype(np.int64) << level
                          for level, (node, after) in enumerate(zip(path, path[1:])))
            for level, node in enumerate(path[:-1]):
                if tree.slot[node] >= 0:
                    values[slots.index(tree.slot[node])] += table[leaf, pattern, level]
        halves.append((nodes, slots, values))
    return halves


def _explained(forest: Forest, tables: list[list[tuple[list[int], list[int], np.ndarray]]], codes: np.ndarray) -> np.ndarray:
    """Contributions by slot and loan."""
    phi = np.zeros((len(forest.inputs.owners), codes.shape[1]))
    missing = forest.inputs.missing
    for tree, halves in zip(forest.trees, tables):
        answers = [goes_left(tree, node, codes, missing) for node in range(INNER)]
        for nodes, slots, values in halves:
            pattern = np.zeros(codes.shape[1], np.intp)
            for place, node in enumerate(nodes):
                pattern |= answers[node].astype(np.intp) << place
            for slot, value in zip(slots, values):
                phi[slot] += value[pattern]
    return phi


def tree_contributions(model: DefaultModel, loans: DataFrame) -> DataFrame:
    """Exact path-dependent Shapley values of the boosted trees, in log-odds, for every loan.

    Tables of the half trees are built in the tasks, once each. Loans stream through as Arrow batches; all arithmetic on
    them is vectorised. A row with missing inputs is explained like any other.
    """
    forest = model.forest
    bias = forest.base + sum(_path_tables(tree)[1] for tree in forest.trees)
    shared = loans.sparkSession.sparkContext.broadcast(forest)  # its size follows from the trees

    @F.pandas_udf("array<double>")
    def explain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        known = shared.value
        tables = [_half_tables(tree) for tree in known.trees]
        for batch in batches:
            yield pd.Series(list(np.ascontiguousarray(_explained(known, tables, known.inputs.codes(batch)).T)))

    return model.with_margin(loans).withColumns({
        "phi": explain(F.struct(*forest.inputs.select(loans))), "bias": F.lit(bias)})


def fold_contributions(explained: DataFrame, owners: list[str]) -> DataFrame:
    """Sum the encoded slots of each original input into ``phi_<input>``."""
    slots = defaultdict(list)
    for i, owner in enumerate(owners):
        slots[owner].append(F.get("phi", F.lit(i)))
    return explained.withColumns({f"phi_{owner}": sum(values[1:], values[0]) for owner, values in slots.items()})

"""Annuity arithmetic as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values: monthly rates the solver may return ------------------------------------------
LOWEST_RATE, HIGHEST_RATE = 1e-9, 0.20
NEWTON_STEPS = 8


def payment(amount: Column, monthly_rate: Column, months: Column) -> Column:
    """Monthly payment of a fixed-rate loan."""
    return amount * monthly_rate / (1 - F.pow(1 + monthly_rate, -months))


def implied_rate(amount: Column, installment: Column, months: Column) -> Column:
    """Yearly rate in percent that makes ``installment`` repay ``amount`` in ``months`` payments.

    The rate is the positive root of ``amount * r - installment * (1 - (1 + r) ** -months)``, a convex function. It is
    below ``installment / amount`` and below the rate at which the tangent of the payment at zero reaches the
    installment, and Newton steps from the smaller bound fall monotonically onto it: five reach double precision for
    terms of up to 480 months, so eight are taken. The steps fold over a short array and not over nested columns, so the
    expression stays small even when a filter on the result is pushed down. A rate outside the allowed range is reported
    as the nearer bound; NULL where no positive rate fits or an input is missing.
    """
    a, p, n = (column.cast("double") for column in (amount, installment, months))
    finite = F.abs(a + p + n) < F.lit(float("inf"))
    solvable = finite & (n > 0) & (p > F.try_divide(a, n))
    start = F.greatest(F.least(p / a, 2 * (p * n - a) / (a * (n + 1)), F.lit(HIGHEST_RATE)), F.lit(LOWEST_RATE))

    def step(rate: Column, _: Column) -> Column:
        excess = a * rate - p * (1 - F.pow(1 + rate, -n))
        slope = a - p * n * F.pow(1 + rate, -n - 1)
        return F.greatest(rate - F.when(slope > 0, excess / slope).otherwise(0.0), F.lit(LOWEST_RATE))

    root = F.least(F.aggregate(F.array(*[F.lit(i) for i in range(NEWTON_STEPS)]), start, step), F.lit(HIGHEST_RATE))
    # An amount that is not positive has no finite root.
    return F.when(solvable, F.when(a > 0, root).otherwise(F.lit(HIGHEST_RATE)) * 12 * 100)

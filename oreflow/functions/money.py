"""Money arithmetic whose result does not depend on the order of the rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


#: Amounts below this are added as decimals, so that their sum does not depend on order.
_DECIMAL_BELOW = 1e18


def _finite(amount: Column) -> Column:
    """The amount as a double; null when it is no number, undefined or infinite."""
    value = amount.try_cast("double")
    return F.when(F.abs(value) < float("inf"), value)


def exact_sum(amount: Column) -> Column:
    """Sum of all finite amounts of a column, a double at the end.

    Amounts are added as decimals with nine places, unrounded below that; the few that are too
    large for it, beyond any price, are added as doubles. Infinite and undefined ones count nowhere.
    """
    value = _finite(amount)
    near = F.abs(value) < _DECIMAL_BELOW
    decimals = F.sum(F.when(near, value).try_cast("decimal(28,9)")).cast("double")
    rest = F.sum(F.when(~near, value))
    return F.when(rest.isNull(), decimals).otherwise(F.coalesce(decimals, F.lit(0.0)) + rest)


def exact_mean(amount: Column, digits: int = 2) -> Column:
    """Mean of the amounts that :func:`exact_sum` adds, rounded."""
    return F.round(exact_sum(amount) / F.count(_finite(amount)), digits)


def quality_pct(bad: Column, total: Column) -> Column:
    """Share of good rows in per cent, one decimal; 100 for an empty day."""
    return F.round((1 - bad / F.greatest(total, F.lit(1))) * 100, 1)


def bad_pct(bad: Column, total: Column) -> Column:
    """Share of bad rows in per cent, one decimal; 0 for no rows."""
    return F.round(bad / F.greatest(total, F.lit(1)) * 100, 1)

"""Numeric expressions (NUM1, NUM2, NUM5-NUM7) and small helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clip(c: str | Column, lo: float, hi: float) -> Column:
    """NULL-preserving clip (``greatest``/``least`` skip NULLs, so guard explicitly)."""
    c = _c(c)
    return F.when(c.isNull(), F.lit(None)).otherwise(F.greatest(F.least(c, F.lit(hi)), F.lit(lo)))


def change_normalised(change_percent: str | Column) -> Column:
    """NUM1: clip(change%, -10, 10) / 10."""
    return clip(change_percent, -10.0, 10.0) / F.lit(10.0)


def combined_sentiment(vader: str | Column, change_percent: str | Column | None) -> Column:
    """NUM2: (vader + normalised change) / 2; a NULL change leaves vader (D9)."""
    if change_percent is None:
        return _c(vader)
    ch = _c(change_percent)
    return F.when(ch.isNull(), _c(vader)).otherwise((_c(vader) + change_normalised(ch)) / F.lit(2.0))


def similarity(distance: str | Column) -> Column:
    """NUM5: 1 / (1 + distance)."""
    return F.lit(1.0) / (F.lit(1.0) + _c(distance))


def zscore(c: str | Column, mean: str | Column, std: str | Column) -> Column:
    """(x - mean) / std, 0 when std is 0 or NULL (AGG19 convention)."""
    std = _c(std)
    return F.when(std.isNull() | (std == 0), F.lit(0.0)).otherwise((_c(c) - _c(mean)) / std)


def residual(actual: str | Column, predicted: str | Column) -> Column:
    """NUM7: actual - prediction."""
    return _c(actual) - _c(predicted)


def r6(c: str | Column) -> Column:
    """Round to 6 digits for result comparison; ``+ 0.0`` turns a -0.0 into 0.0."""
    return F.round(_c(c), 6) + F.lit(0.0)

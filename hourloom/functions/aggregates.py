"""Aggregate expressions over truth and prediction columns; each works with any grouping."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def mae(y: Column, p: Column) -> Column:
    return F.avg(F.abs(y - p))


def mse(y: Column, p: Column) -> Column:
    return F.avg((y - p) * (y - p))


def rmse(y: Column, p: Column) -> Column:
    return F.sqrt(mse(y, p))


def r2(y: Column, p: Column) -> Column:
    """Share of variance explained; for a constant truth 1 if every prediction is exact, else 0."""
    missed = F.sum((y - p) * (y - p))
    return (
        F.when(F.min(y) != F.max(y), 1 - missed / (F.var_pop(y) * F.count(y)))
        .when(missed == 0, 1.0)
        .when(missed > 0, 0.0)
    )


def spread(x: Column) -> Column:
    return F.max(x) - F.min(x)


def extreme_threshold(x: Column) -> Column:
    """Mean plus one sample standard deviation."""
    return F.avg(x) + F.stddev_samp(x)

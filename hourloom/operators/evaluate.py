"""Error metrics and checks of predictions; each is one aggregate, overall or per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from hourloom.functions import aggregates as A

Y, P = "y_true", "y_pred"


def align(
    truth: DataFrame, predictions: DataFrame, row_id: str = "row_id", by: Sequence[str] = ()
) -> DataFrame:
    """Pair truth and prediction by position; positions only one side has are cut off."""
    return truth.join(predictions, [*by, row_id], "inner")


def _metrics(y: Column, p: Column) -> list[Column]:
    return [
        A.mae(y, p).alias("mae"),
        A.mse(y, p).alias("mse"),
        A.rmse(y, p).alias("rmse"),
        A.r2(y, p).alias("r2"),
    ]


def regression_metrics(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    y, p = F.col(Y), F.col(P)
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), *_metrics(y, p))


def residual_profile(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean and population deviation of truth minus prediction; biased above a tenth of it."""
    profile = df.groupBy(*by).agg(*_residuals(F.col(Y), F.col(P)))
    return profile.withColumn("biased", _biased())


def _residuals(y: Column, p: Column) -> list[Column]:
    return [
        F.avg(y - p).alias("residual_mean"),
        F.stddev_pop(y - p).alias("residual_std"),
    ]


def _biased() -> Column:
    return F.abs("residual_mean") > F.lit(0.1) * F.col("residual_std")


def range_check(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Range of the predictions against that of the truth."""
    ranges = df.groupBy(*by).agg(*_ranges(F.col(Y), F.col(P)))
    return ranges.withColumns({"too_wide": _too_wide(), "too_narrow": _too_narrow()})


def _ranges(y: Column, p: Column) -> list[Column]:
    return [A.spread(p).alias("pred_range"), A.spread(y).alias("true_range")]


def _too_wide() -> Column:
    return F.col("pred_range") > 2 * F.col("true_range")


def _too_narrow() -> Column:
    return ~_too_wide() & (F.col("pred_range") < F.lit(0.5) * F.col("true_range"))


def issue_counts(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """NaN, infinite and negative predictions."""
    return df.groupBy(*by).agg(*_issue_counts(F.col(P)))


def _issue_counts(p: Column) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.isnan(p)).alias("nan_count"),
        F.count_if(F.abs(p) == float("inf")).alias("inf_count"),
        F.count_if(p < 0).alias("negative_count"),
    ]


def usable_metrics(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """rows and metrics; no metrics where there is no row, or a value is missing or not finite."""
    checked = df.groupBy(*by).agg(*check_columns(F.col(Y), F.col(P)))
    usable = (F.col("rows") > 0) & (F.col("unusable_count") == 0)
    return checked.select(*by, "rows", *[F.when(usable, F.col(m)).alias(m) for m in ("mae", "mse", "rmse", "r2")])


def check_columns(y: Column, p: Column) -> list[Column]:
    """Every aggregate the validation needs, for one pass over the predictions."""
    unusable = y.isNull() | p.isNull() | F.isnan(y) | F.isnan(p)
    unusable = unusable | (F.abs(y) == float("inf")) | (F.abs(p) == float("inf"))
    return [
        *_issue_counts(p),
        F.count_if(unusable).alias("unusable_count"),
        *_metrics(y, p),
        *_ranges(y, p),
        *_residuals(y, p),
    ]


def repeatability(
    runs: DataFrame,
    row_id: str = "row_id",
    by: Sequence[str] = (),
    tolerance: float = 0.001,
    series: Sequence[str] = (),
) -> DataFrame:
    """Largest population deviation of one row's prediction over repeated runs.

    A row is known by ``row_id`` within its ``series``, whether or not those are grouped by.
    """
    per_row = runs.groupBy(*by, *[c for c in series if c not in by], row_id).agg(F.stddev_pop(P).alias("_std"))
    worst = per_row.groupBy(*by).agg(F.max("_std").alias("max_std"))
    return worst.withColumn("inconsistent", F.col("max_std") > tolerance)


def stack_runs(runs: Sequence[DataFrame]) -> DataFrame:
    """Predictions of repeated runs in one table, told apart by ``run``."""
    stacked = runs[0].withColumn("run", F.lit(0))
    for number, frame in enumerate(runs[1:], start=1):
        stacked = stacked.unionByName(frame.withColumn("run", F.lit(number)))
    return stacked

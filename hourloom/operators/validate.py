"""Go / no-go verdict on the predictions of a model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from hourloom.functions.scalar import fixed4, metric_in_name
from hourloom.operators import evaluate as E
from hourloom.operators.evaluate import check_columns
from hourloom.operators.lookup import join_same, lookup

# Verdicts and issue texts.
SAFE = "SAFE FOR PRODUCTION"
CAUTION = "USE WITH CAUTION"
UNKNOWN = "UNKNOWN"
NAN_ISSUE = "NaN values in predictions"
INF_ISSUE = "Infinite values in predictions"
WIDE_ISSUE = "Prediction range much larger than true range"
NARROW_ISSUE = "Prediction range much smaller than true range"

MAE_TOLERANCE = 0.01


def _issues() -> Column:
    negative = F.concat(
        F.lit("Negative predictions ("), F.col("negative_count").cast("string"),
        F.lit("/"), F.col("rows").cast("string"), F.lit(")"),
    )
    bias = F.concat(
        F.lit("Systematic bias detected (mean residual: "), fixed4(F.col("residual_mean")), F.lit(")")
    )
    return F.array_compact(
        F.array(
            F.when(F.col("nan_count") > 0, NAN_ISSUE),
            F.when(F.col("inf_count") > 0, INF_ISSUE),
            F.when(F.col("negative_count") > 0, negative),
            F.when(E._too_wide(), WIDE_ISSUE).when(E._too_narrow(), NARROW_ISSUE),
            F.when(E._biased(), bias),
        )
    )


def _claims(model_ids: DataFrame, by: Sequence[str]) -> DataFrame:
    """The metric that the only model id of each group claims."""
    claimed = metric_in_name(F.col("model_id"))
    if "expected_mae" in model_ids.columns:
        claimed = F.coalesce(claimed, F.col("expected_mae"))
    one = F.when(F.count(F.lit(1)) > 1, F.raise_error(F.lit("several model ids for one group")).cast("double"))
    return model_ids.groupBy(*by).agg(one.otherwise(F.max(claimed)).alias("expected_mae"))


def validation_gate(
    predictions: DataFrame,
    model_ids: DataFrame | None = None,
    by: Sequence[str] = (),
    runs: DataFrame | None = None,
    series: Sequence[str] = (),
) -> DataFrame:
    """One verdict per group from one pass over its predictions.

    ``model_ids`` (``by`` columns and ``model_id``) supplies the MAE each id
    claims. An absent or zero claim never matches. If a value is missing or not
    finite there are no metrics, no success and no verdict. ``runs`` adds the
    spread over repeated runs, which does not change the verdict; its rows are
    told apart by ``series`` too. ``model_ids`` may hold ``expected_mae`` for ids
    that name no metric. Two ids for one group are an error.
    """
    checked = predictions.groupBy(*by).agg(*check_columns(F.col(E.Y), F.col(E.P)))
    if model_ids is None:
        named = checked.withColumn("expected_mae", F.lit(None).cast("double"))
    else:
        claims = _claims(model_ids, by)
        named = (
            join_same(checked, claims, by, "left")
            if by
            else checked.withColumn("expected_mae", claims.select("expected_mae").scalar())
        )
    if runs is not None:
        spread = E.repeatability(runs, by=by, series=series)
        named = (
            lookup(named, spread, by)
            if by
            else named.withColumn("_s", spread.select(F.struct("max_std", "inconsistent")).scalar())
            .select("*", "_s.*")
            .drop("_s")
        )
    success = (F.col("rows") > 0) & (F.col("unusable_count") == 0)
    matches = (F.col("expected_mae") != 0) & (F.abs(F.col("mae") - F.col("expected_mae")) < MAE_TOLERANCE)
    no_issues = F.array().cast("array<string>")
    verdict = F.when(F.size("issues") == 0, SAFE).otherwise(CAUTION)
    extra = ["max_std", "inconsistent"] if runs is not None else []
    return (
        named.withColumn("success", success)
        .withColumn("issues", F.when(F.col("success"), _issues()).otherwise(no_issues))
        .select(
            *by,
            "success",
            *[F.when(F.col("success"), F.col(m)).alias(m) for m in ("mae", "mse", "rmse", "r2")],
            "expected_mae",
            F.coalesce(F.col("success") & matches, F.lit(False)).alias("mae_matches"),
            "issues",
            F.when(F.col("success"), verdict).otherwise(UNKNOWN).alias("recommendation"),
            *extra,
        )
    )

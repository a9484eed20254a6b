"""Datasets, trials, scalers and models as tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F

from hourloom.functions import scalar as S
from hourloom.operators.lookup import lookup
from hourloom.sources.published import versions
from hourloom.sources.schemas import JOB_CONFIG
from hourloom.sources.writers import DATASET_KEY, dataset_log, model_log

COMPLETED = "completed"
PRUNED = "pruned"
ERROR = "error"

# A trial is given up beyond this mean squared error.
MAX_MSE = 100.0


def list_datasets(spark: SparkSession, out: str) -> DataFrame:
    """Published datasets with their key, from their descriptions; no data file is opened."""
    known = dataset_log(out).read(spark).select(*DATASET_KEY).distinct()
    key = S.dataset_key(F.col("horizon"), F.col("target"), F.col("dataset"))
    return known.withColumn("dataset_key", key)


# Fixed value: how the log words a trial with a too large error.
TOO_HIGH = "MSE value too high: "


def trial_status(
    mse: Column, finite: Column, max_mse: float | None = MAX_MSE, rows: Column | None = None
) -> tuple[Column, Column]:
    """Status and reason of a scored trial: no rows, not finite or a too large error means pruned."""
    empty = F.lit(False) if rows is None else rows == 0
    too_high = F.lit(False) if max_mse is None else F.coalesce(mse > max_mse, F.lit(False))
    status = F.when(empty | ~finite | too_high, PRUNED).otherwise(COMPLETED)
    message = F.concat(F.lit(TOO_HIGH), mse.cast("string"))
    return status, F.when(empty, "no rows to score").when(~finite, "not finite").when(too_high, message)


def best_trial(
    trials: DataFrame,
    by: Sequence[str] = ("model", "dataset"),
    metric: str = "mae",
    order: Sequence[str] = ("trial_num", "run_id"),
    keep: Sequence[str] = (),
) -> DataFrame:
    """The completed trial with the smallest metric in each group; ties go to the earliest.

    A minimum of structs is combined before the shuffle, so a group of any size
    sends one row per task. Groups without a completed trial keep a row with
    ``completed_trials`` 0 and no values.
    """
    done = (F.col("status") == COMPLETED) & F.col(metric).isNotNull()
    named = list(dict.fromkeys([metric, *order, *keep]))
    least = F.min(F.when(done, F.struct(*named)))
    best = trials.groupBy(*by).agg(least.alias("_best"), F.count_if(done).alias("completed_trials"))
    return best.select(*by, "completed_trials", *[F.col(f"_best.`{c}`").alias(c) for c in named])


def dataset_catalog(trials: DataFrame) -> DataFrame:
    """Trial counts and statuses of every dataset."""
    status = F.col("status")
    return trials.groupBy(*DATASET_KEY).agg(
        F.count(F.lit(1)).alias("trials"),
        F.count_if(status == COMPLETED).alias("completed"),
        F.count_if(status == PRUNED).alias("pruned"),
    )


def choose_scaler(scalers: DataFrame, by: Sequence[str] = ("dataset",), name: str = "scaler") -> DataFrame:
    """One scaler per dataset: a target scaler, else one named after the dataset, else the first by name."""
    text = F.col(name)
    rank = (
        F.when(F.lower(text).contains("target"), 0)
        .when(F.contains(text, F.col("dataset")), 1)
        .otherwise(2)
    )
    rest = [c for c in scalers.columns if c not in by and c != name]
    first = F.min(F.struct(rank.alias("_rank"), text, *rest)).alias("_first")
    return scalers.groupBy(*by).agg(first).select(*by, f"_first.`{name}`", *[f"_first.`{c}`" for c in rest])


def registered(spark: SparkSession, out: str) -> DataFrame:
    """One row per model id, the latest, with its dataset, features and error."""
    return model_log(out).read(spark)


def locate_datasets(models: DataFrame, datasets: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Attach the dataset of each model id, by exact horizon, target and dataset.

    ``known`` (``registered``) says where a model belongs; an id that it does not
    hold is read by its parts. Both sides are looked up, so an id or a dataset
    that most rows name is not joined in one task.
    """
    model_id = F.col("model_id")
    parts = {
        "horizon": S.horizon_in_name(model_id),
        "target": S.target_in_name(model_id),
        "dataset": S.dataset_in_name(model_id),
    }
    if known is not None:
        own = known.select(F.col("run_id").alias("model_id"), F.struct(*DATASET_KEY).alias("_known"))
        models = lookup(models, own, ["model_id"])
        parts = {name: F.coalesce(F.col(f"_known.{name}"), part) for name, part in parts.items()}
    keyed = models.withColumns(parts).drop("_known")
    return lookup(keyed, datasets, list(DATASET_KEY))


def dataset_info(spark: SparkSession, out: str, target: str, horizon: int, dataset: str) -> Row:
    """The description of one dataset as last published: its feature order is the contract for scoring.

    ``config`` holds the job configuration, parsed with its schema.
    """
    key = dict(zip(DATASET_KEY, (target, horizon, dataset), strict=True))
    rows = (
        versions(spark, dataset_log(out), key)
        .withColumn("config", F.from_json("config_json", JOB_CONFIG, {"mode": "FAILFAST"}))
        .orderBy(F.desc("version"))
        .take(1)
    )
    if not rows:
        raise ValueError(f"no dataset {horizon}hours_{target}/{dataset}")
    if not rows[0]["feature_order"]:
        raise ValueError("the dataset description has no feature order")
    return rows[0]

"""Sinks. Every table is Parquet; datasets and predictions are published in versions, logs grow by batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, types as T

from hourloom.sources.logs import Log
from hourloom.sources.published import Release, manifest, published_rows, retire
from hourloom.sources.schemas import DATASET_INFO, EVALUATIONS, MODELS, TRIALS

DATASET_KEY = ("target", "horizon", "dataset")
DATASET_FIELDS = [T.StructField("target", T.StringType()), T.StructField("horizon", T.IntegerType()), T.StructField("dataset", T.StringType())]
PREDICTION_FIELDS = [T.StructField("run_id", T.StringType()), T.StructField("split", T.StringType())]

#: Batches of a log beyond which a job folds it.
BATCHES = 64


def dataset_log(out: str) -> Log:
    """The published datasets with their descriptions."""
    return manifest(f"{out}/dataset_info", DATASET_FIELDS, DATASET_INFO)


def prediction_log(out: str) -> Log:
    return manifest(f"{out}/prediction_info", PREDICTION_FIELDS)


def trial_log(out: str) -> Log:
    """Trials by search and number: a search that is repeated writes the same trials again."""
    return Log(f"{out}/trials", TRIALS, ("search_id", "trial_num"))


def model_log(out: str) -> Log:
    return Log(f"{out}/models_table", MODELS, ("run_id",))


def evaluation_log(out: str) -> Log:
    return Log(f"{out}/evaluations", EVALUATIONS, ("run_id", "split"))


def publish_predictions(
    df: DataFrame, out: str, run_id: str, split: str, keys: Sequence[str] = ("row_id",)
) -> None:
    """``<keys>, y_true, y_pred`` of one run and split; publishing them again replaces them."""
    spark, key, log = df.sparkSession, {"run_id": run_id, "split": split}, prediction_log(out)
    release = Release(spark, out, key)
    release.write(df.select(*keys, "y_true", "y_pred"), "predictions")
    release.commit(log)
    retire(spark, out, log, key)


def read_predictions(spark: SparkSession, out: str) -> DataFrame:
    """The published predictions of all runs and splits."""
    return published_rows(spark, out, prediction_log(out), "predictions")

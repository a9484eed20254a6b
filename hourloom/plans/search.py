"""Model search, evaluation and validation over prepared datasets."""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from hourloom.functions.scalar import grid_run_id
from hourloom.operators import evaluate
from hourloom.operators.catalog import ERROR, registered, trial_status
from hourloom.operators.clean import guard_finite
from hourloom.operators.forecast import model_pipeline, predict, score
from hourloom.operators.validate import validation_gate
from hourloom.plans.prepare import Dataset, published_dataset
from hourloom.session import materialise, scratch
from hourloom.sources import schemas as N
from hourloom.sources.schemas import MODELS, TRIALS
from hourloom.sources.writers import BATCHES, DATASET_KEY, evaluation_log, model_log, publish_predictions, trial_log


VALIDATION = "validation"


def split_predictions(dataset: Dataset, model, split: str = "test") -> DataFrame:
    """Truth and prediction of one split in the label's units."""
    return _predictions(dataset, dataset.split(split), model)


def _predictions(dataset: Dataset, rows: DataFrame, model) -> DataFrame:
    scored = predict(rows, model, dataset.params, dataset.label, dataset.keys)
    return scored.select(
        *dataset.keys,
        F.col("idx").alias("row_id"),
        F.col(dataset.label).cast("double").alias("y_true"),
        "y_pred",
    )


def search(
    dataset: Dataset,
    key: tuple[str, int, str],
    family: str,
    grid: Sequence[Mapping],
    out: str,
    select_on: str = "test",
    max_mse: float | None = None,
    at_once: int = 1,
) -> DataFrame:
    """Fit every parameter map on train and validation rows; write predictions, model and trial row.

    The grid is short; each fit and each scoring is a distributed job, and only
    one row of metrics comes back. ``at_once`` trials run side by side, each in
    a scheduler pool of its own, over the same two written tables: the small
    jobs of one fill the cluster while another waits for its last task. The
    number of a trial is its place in the grid, whatever ends first.

    ``select_on="val"`` fits on the train rows alone and scores the validation
    rows; otherwise the validation rows end boosting early. A failing fit, or a
    model that cannot be saved, is logged with status ``error`` and the whole
    reason, and the others go on; no rows, predictions that are not finite, or
    an error above ``max_mse``, make a trial ``pruned``. Every saved model is
    registered with its dataset, so that its id can be resolved.

    The same search made again writes the same entries of the log again, not more.
    """
    spark = dataset.rows.sparkSession
    if at_once < 1:
        raise ValueError("at least one trial at a time")
    fitted_on = ("train",) if select_on == "val" else ("train", "val")
    held = (F.col("split") == "val").alias(VALIDATION)
    search_id = _search_id(key, family, grid, select_on, max_mse)
    with scratch(spark):
        # Both are read by every trial: written once.
        # Dealt by position and sorted, so that the draws of a fit do not depend on how the dataset's files lie.
        place, tasks = [*dataset.keys, "idx"], int(spark.conf.get("spark.sql.shuffle.partitions"))
        train = dataset.split(*fitted_on).repartition(tasks, *place).sortWithinPartitions(*place)
        train = materialise(train.select(held, *[c for c in train.columns if c.endswith("_scaled")]))
        judged = materialise(dataset.split(select_on))
        watch = VALIDATION if select_on != "val" and not train.where(VALIDATION).isEmpty() else None

        def trial(number: int, params: Mapping) -> None:
            # A property of the thread's own jobs; with the fair scheduler pools share the cluster evenly.
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"trial-{number % at_once}")
            _run_trial(spark, dataset, key, family, number, params, train, judged, watch, out, select_on, max_mse, search_id)

        with ThreadPoolExecutor(at_once) as threads:
            # Each thread carries the session's properties; an error that is not a trial's own ends the search.
            for done in [threads.submit(inheritable_thread_target(spark)(trial), n, p) for n, p in enumerate(grid)]:
                done.result()
    trial_log(out).compact(spark, BATCHES)
    model_log(out).compact(spark, BATCHES)
    return trial_log(out).read(spark)


def _search_id(key: tuple[str, int, str], family: str, grid: Sequence[Mapping], select_on: str, max_mse: float | None) -> str:
    """A search is what it is asked for: dataset, family, grid and the way it selects."""
    told = [list(key), family, [{k: str(v) for k, v in p.items()} for p in grid], select_on, max_mse]
    return hashlib.sha256(json.dumps(told, sort_keys=True).encode()).hexdigest()[:16]


def _run_trial(
    spark, dataset, key, family, number, params, train, judged, watch, out, select_on, max_mse, search_id
) -> None:
    started = time.time()
    row = dict(zip(DATASET_KEY, key, strict=True)) | {
        "search_id": search_id,
        "model": family,
        "trial_num": number,
        "params": {k: str(v) for k, v in params.items()},
    }
    try:
        model = model_pipeline(family, params, dataset.features, dataset.label, watch).fit(train)
        predictions = materialise(_predictions(dataset, judged, model))
        metrics = trial_metrics(predictions, max_mse)
        run_id = _run_id(spark, family, params, metrics["mae"], key[2], started)
        # The model comes first: a run whose model cannot be saved leaves nothing under its id.
        path = f"{out}/models/{run_id}"
        model.write().overwrite().save(path)
        publish_predictions(predictions, out, run_id, select_on, [*dataset.keys, "row_id"])
        row |= {m: metrics[m] for m in ("mae", "mse", "rmse", "r2", "status", "reason")}
        row["run_id"] = run_id
        known = row | {"created_at": datetime.now(timezone.utc), "feature_order": dataset.features, "path": path}
        model_log(out).append(_one_row(spark, known, MODELS))
    except Exception as failure:
        row |= {"status": ERROR, "reason": str(failure)}
    row["runtime_minutes"] = (time.time() - started) / 60
    trial_log(out).append(_one_row(spark, row, TRIALS))


def trial_metrics(predictions: DataFrame, max_mse: float | None = None) -> dict:
    """rows, metrics, status and reason of a trial; its metrics are null unless all values are finite."""
    checked = predictions.agg(*evaluate.check_columns(F.col("y_true"), F.col("y_pred")))
    usable = (F.col("rows") > 0) & (F.col("unusable_count") == 0)
    names = ("mae", "mse", "rmse", "r2")
    checked = checked.select("rows", "unusable_count", *[F.when(usable, F.col(m)).alias(m) for m in names])
    verdict = trial_status(F.col("mse"), F.col("unusable_count") == 0, max_mse, F.col("rows"))
    status, reason = (c.alias(n) for c, n in zip(verdict, ("status", "reason"), strict=True))
    return checked.select("rows", *names, status, reason).first().asDict()


def _run_id(spark, family: str, params: Mapping, mae: float | None, dataset: str, started: float) -> str:
    stamp = datetime.fromtimestamp(started, timezone.utc).replace(tzinfo=None).isoformat(sep=" ")
    parts = [(name, F.lit(str(value))) for name, value in params.items()]
    when = F.lit(stamp).cast("timestamp_ntz")
    run_id = grid_run_id(when, F.lit(mae).cast("double"), family, parts, F.lit(dataset))
    return spark.range(1).select(run_id).first()[0]


def _one_row(spark: SparkSession, row: Mapping, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([tuple(row.get(f.name) for f in schema.fields)], schema)


def evaluation_report(
    predictions: DataFrame, test_rows: int, labels: Mapping[str, str], out: str | None = None
) -> DataFrame:
    """One row of metrics with the names of model and dataset and the sizes of both sides.

    There are no metrics unless all values are finite. ``out`` logs the row with the evaluations.
    """
    report = evaluate.usable_metrics(predictions).withColumnRenamed("rows", "predictions_count")
    report = report.withColumns(
        {**{k: F.lit(v) for k, v in labels.items()}, "test_set_size": F.lit(test_rows).cast("long")}
    )
    if out:
        evaluation_log(out).append(report)
    return report


def validate_model(
    dataset: Dataset,
    model,
    model_id: str,
    split: str = "test",
    repeats: int = 5,
    by_series: bool = False,
    out: str | None = None,
) -> DataFrame:
    """Score a split ``repeats`` times and judge the first run; ``run`` spreads are reported aside.

    One verdict over all rows, or one for each series of the dataset. Rows of
    different series are never taken for repetitions of each other. ``out``
    supplies the error that the search registered for an id that names none;
    it is the error over all rows. The runs are written once: both the verdict
    and the spread read them.
    """
    spark = dataset.rows.sparkSession
    scored = [split_predictions(dataset, model, split) for _ in range(repeats)]
    runs = materialise(evaluate.stack_runs(scored))
    by = dataset.keys if by_series else ()
    claimed = spark.range(1).select(F.lit(model_id).alias("model_id"))
    if out:
        known = registered(spark, out).where(F.col("run_id") == model_id)
        claimed = claimed.withColumn("expected_mae", known.agg(F.max("mae")).scalar())
    if by:
        claimed = runs.select(*by).distinct().withColumns({c: claimed.select(c).scalar() for c in claimed.columns})
    return validation_gate(runs.where("run = 0"), claimed, by, runs, dataset.keys)


def evaluate_run(dataset: Dataset, model, run_id: str, out: str, split: str = "test") -> DataFrame:
    """Score a split, publish its predictions and log one row with the evaluations; made again, it replaces both."""
    spark = dataset.rows.sparkSession
    labels = {"run_id": run_id, "split": split}
    with scratch(spark):
        predictions = materialise(split_predictions(dataset, model, split))
        publish_predictions(predictions, out, run_id, split, [*dataset.keys, "row_id"])
        rows = dataset.split(split).count()
        report = evaluation_report(predictions, rows, labels, out)
        row = tuple(report.first())
    evaluation_log(out).compact(spark, BATCHES)
    return spark.createDataFrame([row], report.schema)


def score_table(
    df: DataFrame,
    out: str,
    key: tuple[str, int, str],
    model,
    carry: Sequence[str] = (),
    keys: Sequence[str] = (),
) -> DataFrame:
    """Score raw feature rows with what the preparation recorded: feature order and parameters.

    A prediction that is not finite is an error.
    """
    release, info = published_dataset(df.sparkSession, out, key)
    params = release.read("scalers").select(*keys, *[f.name for f in N.SCALER_PARAMS.fields])
    scored = score(df, model, info["feature_order"], info["target_column"], params, carry, keys)
    return guard_finite(scored, ["y_pred"])

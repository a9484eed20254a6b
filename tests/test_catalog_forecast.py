from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from hourloom.operators import catalog, evaluate, forecast, scaling
from hourloom.plans.prepare import scaled_dataset
from hourloom.plans.search import evaluation_report, search, split_predictions, validate_model
from hourloom.sources.published import Release
from hourloom.sources.writers import dataset_log, read_predictions
from tests.helpers import rows


def test_best_trial_breaks_ties_by_the_earliest(spark):
    trials = spark.createDataFrame(
        [("RF", "d1", 3, "r3", "completed", 2.0), ("RF", "d1", 1, "r1", "completed", 2.0),
         ("RF", "d1", 0, "r0", "pruned", 1.0), ("RF", "d1", 5, "r5", "completed", None),
         ("GBT", "d1", 0, "g0", "error", None)],
        "model string, dataset string, trial_num long, run_id string, status string, mae double",
    )
    assert rows(catalog.best_trial(trials), "model") == [
        ("GBT", "d1", 0, None, None, None), ("RF", "d1", 2, 2.0, 1, "r1")
    ]


def test_scaler_preference(spark):
    scalers = spark.createDataFrame(
        [("dataset1", "feature_scaler_dataset1.pkl"), ("dataset1", "Target_scaler.pkl"),
         ("dataset2", "a_scaler.pkl"), ("dataset2", "scaler_dataset2.pkl"), ("dataset3", "z.pkl"), ("dataset3", "b.pkl")],
        "dataset string, scaler string",
    )
    assert rows(catalog.choose_scaler(scalers), "dataset") == [
        ("dataset1", "Target_scaler.pkl"), ("dataset2", "scaler_dataset2.pkl"), ("dataset3", "b.pkl")
    ]


def test_locating_is_exact(spark):
    models = spark.createDataFrame(
        [("reg_T_6hours_boarding_count_dataset15_trial1_mae1.0",), ("reg_T_6hours_boarding_count_dataset1_trial1_mae1.0",)],
        "model_id string",
    )
    datasets = spark.createDataFrame(
        [("boarding_count", 6, "dataset1", "here")], "target string, horizon int, dataset string, place string"
    )
    got = catalog.locate_datasets(models, datasets)
    assert rows(got.select("dataset", "place"), "dataset") == [("dataset1", "here"), ("dataset15", None)]


def test_listing_datasets(spark, tmp_path):
    for number in ("dataset1", "dataset15", "dataset1"):
        release = Release(spark, str(tmp_path / "d"), {"target": "a", "horizon": 6, "dataset": number})
        release.commit(dataset_log(str(tmp_path / "d")))
    got = catalog.list_datasets(spark, str(tmp_path / "d"))
    assert rows(got.select("dataset_key"), "dataset_key") == [("6hours_a_dataset1",), ("6hours_a_dataset15",)]


def test_trial_status_and_report(spark):
    df = spark.createDataFrame([(1.5, True), (100.5, True), (1.0, False)], "mse double, finite boolean")
    status, reason = catalog.trial_status(F.col("mse"), F.col("finite"))
    assert [tuple(r) for r in df.select(status, reason).collect()] == [
        ("completed", None), ("pruned", "MSE value too high: 100.5"), ("pruned", "not finite")
    ]


def test_grid_sizes():
    full = 1
    for values in forecast.FOREST_AXES.values():
        full *= len(values)
    assert full == 15_552
    assert len(forecast.expand_grid(forecast.FOREST_AXES)) == 9_720
    assert set(p["max_depth"] for p in forecast.expand_grid(forecast.spark_axes("RF"))) == {20, 30, 40}
    assert len(forecast.expand_grid(forecast.spark_axes("GBT"))) == 128
    assert not forecast.is_valid({"bootstrap": False, "max_samples": 0.7})
    assert not forecast.is_valid({"bootstrap": False, "oob_score": True})


@pytest.mark.parametrize("family", ["RF", "GBT"])
@pytest.mark.parametrize("count", [1, 8, 60])
def test_a_sampled_grid_holds_every_value(family, count):
    axes = forecast.spark_axes(family)
    maps = forecast.sample_grid(axes, count)
    assert maps == forecast.sample_grid(axes, count)
    assert len({str(m) for m in maps}) == len(maps) >= count and all(map(forecast.is_valid, maps))
    for name, values in axes.items():
        assert {m[name] for m in maps} == set(values), name
    assert len(forecast.sample_grid(axes, 60)) == 60


def test_parameters_reach_the_trees():
    rf = forecast.forest(forecast.expand_grid(forecast.spark_axes("RF"))[0])
    assert (rf.getNumTrees(), rf.getMaxDepth(), rf.getFeatureSubsetStrategy(), rf.getSeed()) == (200, 20, "all", 42)
    gbt = forecast.boosted(forecast.expand_grid(forecast.spark_axes("GBT"))[0])
    assert (gbt.getMaxIter(), gbt.getStepSize(), gbt.getFeatureSubsetStrategy()) == (100, 0.01, "0.3")


@pytest.fixture(scope="module")
def dataset(spark):
    df = spark.range(400).select(
        F.col("id").alias("idx"),
        F.when(F.col("id") < 280, "train").when(F.col("id") < 340, "val").otherwise("test").alias("split"),
        (F.col("id") % 24).cast("double").alias("hour"),
        (F.col("id") % 2).alias("odd"),
        (F.abs(F.col("id") % 24 - 12) * 3 + F.col("id") % 2).cast("double").alias("label"),
    )
    return scaled_dataset(df, ["hour", "odd"], "label")


SMALL = {"n_estimators": 8, "max_depth": 5}


@pytest.mark.parametrize("family", ["RF", "GBT"])
def test_models_beat_the_mean_and_repeat(dataset, family):
    train = dataset.split("train")
    fits = [forecast.model_pipeline(family, SMALL, dataset.features, dataset.label).fit(train) for _ in range(2)]
    first, second = (split_predictions(dataset, m) for m in fits)
    assert rows(first, "row_id") == rows(second, "row_id")
    assert evaluate.regression_metrics(split_predictions(dataset, fits[0], "train")).first().r2 > 0.5


def test_scoring_raw_rows_equals_scoring_the_dataset(spark, dataset, tmp_path):
    model = forecast.model_pipeline("RF", SMALL, dataset.features, dataset.label).fit(dataset.split("train"))
    model.write().overwrite().save(str(tmp_path / "m"))
    raw = dataset.split("test").select("idx", *dataset.features)
    scored = forecast.score(
        raw, forecast.load_model(str(tmp_path / "m")), dataset.features, dataset.label, dataset.params, ["idx"]
    )
    assert scored.columns == ["idx", "hour", "odd", "y_pred"]
    expected = [r[2] for r in rows(split_predictions(dataset, model), "row_id")]
    assert np.allclose([r.y_pred for r in scored.orderBy("idx").collect()], expected)
    plain = forecast.score(raw, model, dataset.features, dataset.label, None, ["idx"])
    assert plain.count() == 60


def test_search_logs_every_trial(spark, dataset, tmp_path):
    out = str(tmp_path)
    key = ("label", 6, "dataset1")
    grid = [SMALL, {"n_estimators": 8, "max_depth": 99}, {"n_estimators": 2, "max_depth": 1}]
    trials = search(dataset, key, "RF", grid, out)
    got = rows(trials.select("trial_num", "status", "dataset", "horizon"), "trial_num")
    assert got == [
        (0, "completed", "dataset1", 6), (1, "error", "dataset1", 6), (2, "completed", "dataset1", 6)
    ]
    best = catalog.best_trial(trials).first()
    assert (best.trial_num, best.completed_trials) == (0, 2)
    assert "RF_n_estimators_8_max_depth_5_dataset1" in best.run_id
    saved = read_predictions(spark, out).where(F.col("run_id") == best.run_id)
    assert evaluate.regression_metrics(saved).first().mae == pytest.approx(best.mae)

    model = forecast.load_model(f"{out}/models/{best.run_id}")
    verdict = validate_model(dataset, model, f"reg_RF_mae{best.mae:.4f}").first()
    assert verdict.success and verdict.mae_matches and verdict.max_std == 0.0
    # A grid id names no metric; the search registered it.
    assert not validate_model(dataset, model, best.run_id).first().mae_matches
    assert validate_model(dataset, model, best.run_id, out=out).first().mae_matches
    known = catalog.registered(spark, out).where(F.col("run_id") == best.run_id)
    assert tuple(known.select("target", "horizon", "dataset", "feature_order").first()) == (*key, dataset.features)
    assert len(trials.where("trial_num = 1").first().reason) > 0
    report = evaluation_report(saved, 60, {"model": "RF"}, out).first()
    assert (report.predictions_count, report.test_set_size, report.model) == (60, 60, "RF")


def test_trials_side_by_side_log_what_they_log_one_by_one(spark, dataset, tmp_path):
    grid = [{"n_estimators": n, "max_depth": 99 if n == 3 else 2} for n in range(1, 9)]
    key = ("label", 6, "dataset1")
    told = ["trial_num", "status", "params", "mae", "mse", "rmse", "r2", "search_id"]
    logs = [
        [r.asDict() for r in search(dataset, key, "RF", grid, str(tmp_path / str(n)), at_once=n).orderBy("trial_num").collect()]
        for n in (1, 4)
    ]
    one, four = [[{c: r[c] for c in told} for r in rows] for rows in logs]
    assert one == four and [r["trial_num"] for r in four] == list(range(8))
    assert [r["status"] for r in four] == ["completed"] * 2 + ["error"] + ["completed"] * 5
    # The same search again writes the same entries; another grid adds its own.
    again = search(dataset, key, "RF", grid, str(tmp_path / "4"), at_once=4)
    assert again.count() == 8 and again.select("run_id").where("run_id IS NOT NULL").distinct().count() == 7
    assert search(dataset, key, "RF", grid[:1], str(tmp_path / "4")).count() == 9
    with pytest.raises(ValueError, match="at least one"):
        search(dataset, key, "RF", grid, str(tmp_path / "4"), at_once=0)


def test_search_prunes_large_errors(dataset, tmp_path):
    trials = search(dataset, ("label", 6, "d"), "RF", [SMALL], str(tmp_path), max_mse=1e-9)
    row = trials.first()
    assert row.status == "pruned" and row.reason.startswith("MSE value too high") and row.mae > 0


def test_search_can_select_on_validation_rows(dataset, tmp_path):
    trials = search(dataset, ("label", 6, "d"), "GBT", [{"n_estimators": 2, "max_depth": 2}], str(tmp_path), "val")
    row = trials.first()
    assert row.status == "completed" and row.params == {"n_estimators": "2", "max_depth": "2"}

"""The whole preparation from CSV files, against the same steps in pandas."""

from __future__ import annotations

import dataclasses
from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from hourloom.operators.catalog import dataset_info, list_datasets
from hourloom.plans import standins as V
from hourloom.operators.forecast import load_model
from hourloom.plans.prepare import Dataset, clean_inputs, learning_table, load_dataset, merged_table, prepare
from hourloom.plans.search import evaluate_run, score_table, search, validate_model
from hourloom.session import scratch_root
from hourloom.sources import schemas as N
from hourloom.sources.config import JobConfig, config_from_row
from hourloom.sources.published import published_rows
from hourloom.sources.readers import read_inputs
from hourloom.sources.writers import dataset_log, read_predictions

CONFIG = JobConfig(
    dataset_number="dataset2",
    features=tuple(V.FEATURES),
    target_feature="total_patient_count",
    future_hours=3,
    lag_features={"total_patient_count": 4, "UED_Hospital_Census": 2},
    exclude=True,
    exclude_from="2019-01-05",
    exclude_to="2019-01-07",
)


def source_frames():
    rng = np.random.default_rng(3)
    hours = pd.date_range("2018-12-31 06:00", periods=360, freq="h")
    doubles = [f.name for f in N.PATIENTS.fields if f.dataType.simpleString() == "double"]
    patients = pd.DataFrame({N.HOUR: hours, **{c: rng.integers(0, 80, 360) / 2 for c in doubles}})
    patients["weather_main"] = rng.choice(["Clouds", "Mist", "Rain", "Clear", "Thunderstorm", "Fog"], 360)
    patients["weather_description"] = "text"
    patients.loc[100, "temp"] = np.nan
    census = pd.DataFrame({"DateTime": hours, "UED Hospital Census": rng.integers(0, 50, 360) / 2})
    treatment = pd.DataFrame(
        {N.HOUR: hours, "treatment_count": rng.integers(0, 9, 360) / 2,
         "average_waiting_times_treatment_minute": rng.integers(0, 99, 360) / 4,
         "patient_ids": "1", "patient_visit_ids": "2"}
    ).drop(index=[20, 21])
    boarding = pd.DataFrame(
        {"DateTime": hours, "boarding_count": rng.integers(0, 9, 360) / 2,
         "average_boarding_times_minute": rng.integers(0, 99, 360) / 2, "patient_ids": "1", "patient_visit_ids": "2"}
    )
    home = pd.DataFrame({N.HOUR: hours[[30, 200]], N.HOME_GAME_FLAG: 1})
    away = pd.DataFrame({N.HOUR: hours[[31]], N.AWAY_GAME_FLAG: 1})
    holidays = pd.DataFrame({N.HOUR: ["2019-01-01", "2019-01-11"], N.HOLIDAY_FLAG: 1})
    return {"patients": patients, "census": census, "treatment": treatment, "boarding": boarding,
            "home_games": home, "away_games": away, "holidays": holidays}


def expected_table(frames):
    f = {k: v.copy() for k, v in frames.items()}
    f["census"] = f["census"].rename(columns=N.CENSUS_RENAMES)
    f["boarding"] = f["boarding"].rename(columns=N.BOARDING_RENAMES)
    for name, df in f.items():
        df[N.HOUR] = pd.to_datetime(df[N.HOUR])
        df = df[df[N.HOUR] >= "2018-12-31 12:00"].drop(columns=["patient_ids", "patient_visit_ids"], errors="ignore")
        numbers = df.select_dtypes(include=["float"]).columns
        f[name] = df if name == "treatment" else df.assign(**{c: df[c].round() for c in numbers})
    m = f["census"].merge(f["patients"], on=N.HOUR).merge(f["boarding"], on=N.HOUR).merge(f["treatment"], on=N.HOUR)
    for flag, hits in ((N.HOME_GAME_FLAG, f["home_games"]), (N.AWAY_GAME_FLAG, f["away_games"])):
        m[flag] = m[N.HOUR].isin(hits[N.HOUR]).astype(int)
    m[N.HOLIDAY_FLAG] = m[N.HOUR].dt.normalize().isin(f["holidays"][N.HOUR]).astype(int)
    kinds = m["weather_main"].replace({"Mist": "Clouds", "Fog": "Others"})
    for kind in ("Clear", "Clouds", "Others", "Rain", "Thunderstorm"):
        m[f"weather_{kind}"] = (kinds == kind).astype(int)
    t = m[N.HOUR].dt
    m = m.assign(year=t.year, month=t.month, day_of_month=t.day, hour=t.hour, day_of_week=t.weekday)
    m = m[~((m[N.HOUR] >= "2019-01-05") & (m[N.HOUR] <= "2019-01-07"))]
    target = m["total_patient_count"]
    m["extreme_indicator"] = (target >= target.mean() + target.std()).astype(int)
    x = m[[N.HOUR, *CONFIG.features]].copy()
    for c, n in CONFIG.lag_features.items():
        for i in range(1, n + 1):
            x[f"lag_{i}_{c}"] = x[c].shift(i)
    for i in range(1, 4):
        x[f"future_{i}_total_patient_count"] = x["total_patient_count"].shift(-i)
    return x.dropna().drop(columns=["future_1_total_patient_count", "future_2_total_patient_count"])


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("inputs")
    frames = source_frames()
    paths = {}
    for name, df in frames.items():
        paths[name] = str(folder / f"{name}.csv")
        df.to_csv(paths[name], index=name in ("home_games",))
    return frames, paths


def test_prepared_dataset_equals_pandas(spark, written, tmp_path):
    frames, paths = written
    out = str(tmp_path / "out")
    dataset = prepare(spark, CONFIG, paths, out)
    expected = expected_table(frames)
    got = dataset.rows.orderBy("idx").toPandas()
    names = list(expected.columns[1:-1])
    assert dataset.features == names and dataset.label == expected.columns[-1] == CONFIG.target_column
    assert list(got[N.HOUR]) == list(expected[N.HOUR])
    for c in [*names, dataset.label]:
        assert np.allclose(got[c].astype(float), expected[c].astype(float)), c

    n, a, b = len(expected), int(len(expected) * 0.7), int(len(expected) * 0.15)
    assert list(got["split"]) == ["train"] * a + ["val"] * b + ["test"] * (n - a - b)
    train = expected.iloc[:a]
    scaled = [c for c in names if train[c].nunique(dropna=False) > 2]
    assert {r.column for r in dataset.params.where("role = 'feature'").collect()} == set(scaled)
    for c in [*names, dataset.label]:
        x = expected[c].astype(float)
        if c in scaled or c == dataset.label:
            x = (x - train[c].mean()) / train[c].std(ddof=0)
        assert np.allclose(got[c + "_scaled"], x), c

    info = dataset_info(spark, out, "total_patient_count", 3, "dataset2")
    assert list(info.feature_order) == names and list(info.scaled_features) == scaled
    assert (info.total_samples, info.train_rows, info.val_rows, info.test_rows) == (n, a, b, n - a - b)
    assert (info.original_features, info.lag_features, info.excluded_from) == (29, 6, "2019-01-05")
    assert config_from_row(info.config) == CONFIG
    assert list(info.tensor_shape) == [len(names), 1] and info.lag_features_config == CONFIG.lag_features
    assert list_datasets(spark, out).first().dataset_key == "3hours_total_patient_count_dataset2"
    tensors = published_rows(spark, out, dataset_log(out), "tensors").where("split = 'test'").orderBy("idx").toPandas()
    assert np.allclose(np.stack(tensors["x"]), got[got["split"] == "test"][[c + "_scaled" for c in names]], atol=1e-5)
    key = ("total_patient_count", 3, "dataset2")
    loaded = load_dataset(spark, out, key)
    assert loaded.features == names and loaded.split("val").count() == b
    grid = [{"n_estimators": 3, "max_depth": 3}]
    run = search(loaded, key, "RF", grid, out).first().run_id
    model = load_model(f"{out}/models/{run}")
    report = evaluate_run(loaded, model, "again", out).first()
    assert (report.test_set_size, report.predictions_count) == (n - a - b, n - a - b)
    saved = read_predictions(spark, out)
    assert saved.where("run_id = 'again'").count() == n - a - b
    scored = score_table(loaded.split("test").select("idx", *names), out, key, model, ["idx"])
    both = scored.join(saved.where("run_id = 'again'"), scored.idx == saved.row_id)
    assert both.where(F.abs(scored.y_pred - saved.y_pred) > 1e-9).count() == 0
    assert both.count() == n - a - b

    merged = published_rows(spark, out, dataset_log(out), "merged")
    assert N.HOUR in merged.columns and "weather_type" not in merged.columns
    with pytest.raises(ValueError, match="no dataset"):
        dataset_info(spark, out, "total_patient_count", 3, "dataset1")


def test_threshold_and_grid_options(spark, written):
    _, paths = written
    cleaned = clean_inputs(read_inputs(spark, paths, N.INPUTS))
    train_only = merged_table(cleaned, CONFIG, fit_scope="train")
    pdf = train_only.orderBy(N.HOUR).toPandas()
    # The last train row of the learning table ends the rows that the threshold may see.
    kept = expected_table(written[0])[N.HOUR]
    first = pdf[pdf[N.HOUR] <= kept.iloc[int(len(kept) * 0.7) - 1]]["total_patient_count"]
    limit = first.mean() + first.std()
    assert list(pdf["extreme_indicator"]) == list((pdf["total_patient_count"] >= limit).astype(int))
    # On a regular grid a lag is an hour, so hours next to a gap lose their lags.
    positional = learning_table(train_only, CONFIG)
    regular = learning_table(train_only, CONFIG, regular=True)
    assert regular.count() < positional.count()
    behind = regular.join(
        train_only.select(
            (F.col(N.HOUR) + F.expr("INTERVAL 1 HOUR")).alias(N.HOUR), F.col("total_patient_count").alias("before")
        ),
        N.HOUR,
    )
    assert behind.count() == regular.count()
    assert behind.where("before <> lag_1_total_patient_count").count() == 0


def test_two_sites_in_one_job_equal_two_jobs(spark, written, tmp_path):
    frames, _ = written
    paths = {}
    for name, df in frames.items():
        paths[name] = str(tmp_path / f"{name}.csv")
        if name in ("patients", "census", "boarding", "treatment"):
            north, south = df.assign(site="north"), df.iloc[:200].assign(site="south")
            df = pd.concat([north, south])
        df.to_csv(paths[name], index=False)
    out = str(tmp_path / "out")
    whole = prepare(spark, CONFIG, paths, out, keys=["site"], whole_hours=True)
    expected = expected_table(frames)
    north = whole.rows.where("site = 'north'").orderBy("idx").toPandas()
    assert list(north[N.HOUR]) == list(expected[N.HOUR])
    for c in whole.features:
        assert np.allclose(north[c].astype(float), expected[c].astype(float)), c
    south = expected_table(
        {k: (v.iloc[:200] if k in ("patients", "census", "boarding", "treatment") else v) for k, v in frames.items()}
    )
    got = whole.rows.where("site = 'south'").orderBy("idx").toPandas()
    assert list(got["extreme_indicator"]) == list(south["extreme_indicator"])
    train = south.iloc[: int(len(south) * 0.7)]["temp"]
    assert np.allclose(got["temp_scaled"], (south["temp"] - train.mean()) / train.std(ddof=0))

    order = ["site", "idx"]
    names = [*order, "split", *[c + "_scaled" for c in whole.features]]
    left = whole.rows.select(names).orderBy(*order).toPandas()
    bucketed = prepare(spark, CONFIG, paths, out, keys=["site"])
    right = bucketed.rows.select(names).orderBy(*order).toPandas()
    pd.testing.assert_frame_equal(left, right)
    # the second run replaced the first
    assert published_rows(spark, out, dataset_log(out), "datasets").count() == len(left)


def test_repeated_hours_are_refused_unless_their_rows_are_ordered(spark, written):
    _, paths = written
    cleaned = clean_inputs(read_inputs(spark, paths, N.INPUTS))
    both = [cleaned["census"].withColumn("entry", F.lit(i)) for i in (1, 2)]
    cleaned["census"] = both[0].unionByName(both[1])
    with pytest.raises(ValueError, match="duplicate key"):
        merged_table(cleaned, CONFIG)
    frames = [
        learning_table(merged_table({**cleaned, "census": cleaned["census"].repartition(n)}, CONFIG, tie_breaker=["entry"]), CONFIG, tie_breaker=["entry"])
        for n in (1, 5)
    ]
    left, right = (f.orderBy("idx").toPandas() for f in frames)
    pd.testing.assert_frame_equal(left, right)


def test_times_between_hours_do_not_bound_a_series(spark, written):
    _, paths = written
    cleaned = clean_inputs(read_inputs(spark, paths, N.INPUTS))
    for name in ("census", "patients", "boarding", "treatment"):
        cleaned[name] = cleaned[name].withColumn(N.HOUR, F.col(N.HOUR) + F.expr("INTERVAL 1 MINUTE"))
    assert merged_table(cleaned, CONFIG).count() > 0
    with pytest.raises(ValueError, match="not a whole hour"):
        merged_table(cleaned, CONFIG, series_bound=1_000)


def test_jobs_leave_no_intermediate_tables(spark, written, tmp_path):
    _, paths = written
    tables = Path(scratch_root(spark).removeprefix("file:")) / "tables"
    before = set(tables.iterdir()) if tables.exists() else set()
    out = str(tmp_path / "out")
    dataset = prepare(spark, CONFIG, paths, out)
    key = ("total_patient_count", 3, "dataset2")
    run = search(dataset, key, "RF", [{"n_estimators": 2, "max_depth": 2}], out).first().run_id
    model = load_model(f"{out}/models/{run}")
    for split in ("test", "test", "val"):
        evaluate_run(dataset, model, run, out, split)
    assert set(tables.iterdir()) == before
    saved = read_predictions(spark, out).where(F.col("run_id") == run)
    info = dataset_info(spark, out, *key)
    assert {r.split: r["count"] for r in saved.groupBy("split").count().collect()} == {
        "test": info.test_rows, "val": info.val_rows
    }
    # Prepared again without validation rows, none of them is left.
    prepare(spark, dataclasses.replace(CONFIG, validation_fraction=0.0), paths, out)
    again = published_rows(spark, out, dataset_log(out), "datasets")
    assert again.count() == info.total_samples and again.where("split = 'val'").count() == 0


def test_runs_of_several_sites_are_not_mixed(spark):
    data = [(s, i, "test", float(v * 1000 + i), 0.0) for v, s in enumerate(("north", "south")) for i in range(40)]
    rows = spark.createDataFrame(data, "site string, idx long, split string, label double, label_scaled double")

    class Exact:
        def transform(self, df):
            return df.withColumn("prediction", F.col("label") + 1)

    dataset = Dataset(rows, None, [], "label", ("site",))
    whole = validate_model(dataset, Exact(), "m_mae1.0000").collect()
    assert [(r.mae, r.max_std, r.inconsistent, r.mae_matches) for r in whole] == [(1.0, 0.0, False, True)]
    each = validate_model(dataset, Exact(), "m_mae1.0000", by_series=True).collect()
    assert {(r.site, r.mae, r.max_std, r.mae_matches) for r in each} == {(s, 1.0, 0.0, True) for s in ("north", "south")}

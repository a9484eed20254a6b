from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F, types as T

from hourloom.sources import logs, published, readers, schemas, writers
from hourloom.sources.config import read_config

BASE = {
    "dataset_number": "dataset15",
    "features": ["a", "b"],
    "target_feature": "a",
    "future_hours": 6,
    "covid_filter_start": "2020-04-01",
    "covid_filter_end": "2020-07-01",
    "lag_features_config": {"a": 24, "b": 12},
    "window_size": 4,
    "train_fraction": 0.8,
    "validation_fraction": 0.1,
}


def write_config(tmp_path, **changes):
    config = {k: v for k, v in {**BASE, **changes}.items() if v is not None}
    path = tmp_path / "config.json"
    path.write_text(json.dumps(config, indent=2))
    return str(path)


def test_config_is_read_as_given(spark, tmp_path):
    config = read_config(spark, write_config(tmp_path, covid_deletion=True))
    assert config.features == ("a", "b")
    assert list(config.lag_features.items()) == [("a", 24), ("b", 12)]
    assert (config.exclude, config.exclude_from, config.exclude_to) == (True, "2020-04-01", "2020-07-01")
    assert (config.window_size, config.train_fraction, config.validation_fraction) == (4, 0.8, 0.1)
    assert config.target_column == "future_6_a"
    again = tmp_path / "again.json"
    again.write_text(config.as_json())
    assert read_config(spark, str(again)) == config


def test_config_defaults(spark, tmp_path):
    absent = dict.fromkeys(
        ["lag_features_config", "window_size", "train_fraction", "validation_fraction"]
    )
    config = read_config(spark, write_config(tmp_path, **absent))
    assert config.lag_features == {"a": 24}
    assert (config.exclude, config.window_size, config.train_fraction, config.validation_fraction) == (
        False, 0, 0.7, 0.15
    )
    assert read_config(spark, write_config(tmp_path, lag_features_config={}, lag_N=3)).lag_features == {"a": 3}


@pytest.mark.parametrize(
    "change, message",
    [({"target_feature": "c"}, "is not among the features"), ({"future_hours": None}, "no 'future_hours'"),
     ({"covid_deletion": True, "covid_filter_end": None}, "no 'covid_filter_end'")],
)
def test_config_errors(spark, tmp_path, change, message):
    with pytest.raises(ValueError, match=message):
        read_config(spark, write_config(tmp_path, **change))


def test_delimited_scan_reads_by_name(spark, tmp_path):
    path = tmp_path / "games.csv"
    path.write_text(
        f",{schemas.HOME_GAME_FLAG},hourly_range\n0,1,2019-01-01 12:00:00\n1,1,2019-08-31\n"
    )
    df = readers.read_delimited(spark, str(path), schemas.HOME_GAMES)
    assert df.schema == T.StructType(
        [T.StructField("hourly_range", T.TimestampNTZType()), T.StructField(schemas.HOME_GAME_FLAG, T.IntegerType())]
    )
    assert [str(r[0]) for r in df.orderBy("hourly_range").collect()] == [
        "2019-01-01 12:00:00", "2019-08-31 00:00:00"
    ]
    with pytest.raises(ValueError, match="missing columns"):
        readers.read_delimited(spark, str(path), schemas.HOLIDAYS)


def test_unreadable_values_fail_the_load(spark, tmp_path):
    path = tmp_path / "holidays.csv"
    path.write_text("hourly_range,Federal_Holiday\nsoon,1\n")
    with pytest.raises(Exception, match="cannot read as"):
        readers.read_delimited(spark, str(path), schemas.HOLIDAYS).collect()


def test_inputs_are_all_or_nothing(spark, tmp_path):
    path = tmp_path / "holidays.csv"
    path.write_text("hourly_range,Federal_Holiday\n2019-01-01,1\n")
    wanted = {"holidays": schemas.HOLIDAYS, "home_games": schemas.HOME_GAMES}
    with pytest.raises(ValueError, match="home_games"):
        readers.read_inputs(spark, {"holidays": str(path)}, wanted)
    with pytest.raises(Exception, match="not.*exist|PATH_NOT_FOUND"):
        readers.read_inputs(spark, {"holidays": str(path), "home_games": str(tmp_path / "no.csv")}, wanted)


def test_parquet_scan_turns_nan_into_null(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    spark.createDataFrame([(1.0, float("nan"))], "a double, b double").write.parquet(path)
    schema = T.StructType([T.StructField("b", T.DoubleType())])
    assert readers.read_columnar(spark, path, schema).first().b is None


def published_counts(spark, root, log):
    rows = published.published_rows(spark, root, log, "datasets").groupBy("target", "split").count().collect()
    return {(r.target, r.split): r["count"] for r in rows}


def test_published_datasets_change_whole_and_splits_are_pruned(spark, tmp_path):
    root, log = str(tmp_path), writers.dataset_log(str(tmp_path))
    split = F.when(F.col("id") < 14, "train").when(F.col("id") < 17, "val").otherwise("test")
    df = spark.range(20).select(F.col("id").alias("idx"), split.alias("split"))
    keys = [dict(zip(writers.DATASET_KEY, k)) for k in (("a b/c", 6, "dataset1"), ("a", 6, "dataset1"))]

    def publish(key, rows, second=None):
        release = published.Release(spark, root, key)
        release.write(rows, "datasets", ("split",))
        release.write(second if second is not None else rows.groupBy("split").count(), "counts")
        release.commit(log)
        return release

    assert published.published(spark, root, log, keys[0]) is None
    first = publish(keys[0], df)
    publish(keys[1], df)
    val = first.read("datasets").where("split = 'val'")
    plan = val._jdf.queryExecution().executedPlan().toString()
    assert val.count() == 3 and "split" in plan.split("PartitionFilters")[1]
    both = readers.train_and_validation(first.read("datasets"))
    assert [r.idx for r in both.orderBy("idx").collect()] == list(range(17))

    # A job that fails between two tables leaves the version before it, whole.
    two = df.withColumn("split", F.when(F.col("split") == "val", "test").otherwise(F.col("split")))
    with pytest.raises(Exception, match="lost"):
        publish(keys[0], two, two.select(F.raise_error(F.lit("lost")).cast("int").alias("x")))
    before = {(t, s): n for t in ("a b/c", "a") for s, n in (("train", 14), ("val", 3), ("test", 3))}
    assert published_counts(spark, root, log) == before
    # The next one that ends replaces it whole, and other datasets stay.
    publish(keys[0], two)
    after = {k: n for k, n in before.items() if k != ("a b/c", "val")} | {("a b/c", "test"): 6}
    assert published_counts(spark, root, log) == after
    found, row = published.published(spark, root, log, keys[0])
    assert found.version == row.version != first.version and row.tables == ["datasets", "counts"]
    assert first.read("datasets").count() == 20  # who reads the old one still can

    third = publish(keys[0], two)
    gone = published.retire(spark, root, log, keys[0], keep=2)
    assert first.version in gone and len(gone) == 2  # the first and the one that failed
    assert published_counts(spark, root, log) == after and found.read("datasets").count() == 20
    assert published.retire(spark, root, log, keys[1]) == [] and third.read("counts").count() == 2
    with pytest.raises(ValueError, match="at least one"):
        published.retire(spark, root, log, keys[0], keep=0)


LOGGED = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType()), T.StructField("c", T.LongType())])


def test_log_entries_are_their_latest_attempts(spark, tmp_path):
    log = logs.Log(str(tmp_path / "log"), LOGGED, ("a", "b"))
    assert log.read(spark).count() == 0
    log.compact(spark)
    log.append(spark.createDataFrame([(1, "x", 1), (1, None, 2), (2, "x", 3)], "a long, b string, c long"))
    log.append(spark.range(1).select(F.lit(1).alias("a"), F.lit(9).alias("c")))  # b is null
    expected = [(1, None, 9), (1, "x", 1), (2, "x", 3)]
    for _ in range(3):
        assert sorted(map(tuple, log.read(spark).collect()), key=repr) == sorted(expected, key=repr)
        log.compact(spark)


def test_a_thousand_trials_logged_twice_are_a_thousand_rows_in_few_files(spark, tmp_path):
    log = logs.Log(str(tmp_path / "log"), LOGGED, ("a",))
    trials = spark.range(1_000).select(F.col("id").alias("a"), F.lit("t").alias("b"), F.col("id").alias("c"))
    for attempt in range(2):
        for part in range(4):
            log.append(trials.where(F.col("a") % 4 == part).withColumn("c", F.col("c") + attempt).repartition(5))
        log.compact(spark, beyond=2)
    log.compact(spark)
    assert log.read(spark).agg(F.count("a"), F.sum("c")).first() == (1_000, 499_500 + 1_000)
    log.append(trials.limit(1).withColumn("c", F.lit(0)))
    log.compact(spark)
    log.append(trials.limit(1).withColumn("c", F.lit(0)))
    log.compact(spark)  # by now the batches of the earlier tables are gone
    assert len(list((tmp_path / "log").rglob("part-*.parquet"))) < 20
    assert log.read(spark).count() == 1_000


def test_an_interrupted_compaction_loses_and_doubles_nothing(spark, tmp_path):
    log = logs.Log(str(tmp_path / "log"), LOGGED, ("a",))
    log.append(spark.createDataFrame([(1, "x", 1)], LOGGED))
    log.append(spark.createDataFrame([(2, "x", 2)], LOGGED))
    # One that died behind its list of names, and one that died before it deleted anything.
    spark.createDataFrame([("lost",)], "name string").write.parquet(f"{log.path}/folded/20200101T000000000000-x/names")
    log.compact(spark)
    assert sorted(r.a for r in log.read(spark).collect()) == [1, 2]
    log.append(spark.createDataFrame([(2, "y", 5), (3, "x", 3)], LOGGED))
    log.compact(spark)
    assert sorted(map(tuple, log.read(spark).collect())) == [(1, "x", 1), (2, "y", 5), (3, "x", 3)]


def test_predictions_of_a_run_and_split_are_replaced(spark, tmp_path):
    out = str(tmp_path)
    for run, split, y_pred in (("r1", "test", 2.0), ("r2", "test", 3.0), ("r2", "val", 4.0), ("r2", "test", 5.0)):
        df = spark.createDataFrame([(0, 1.0, y_pred)], "row_id long, y_true double, y_pred double")
        writers.publish_predictions(df, out, run, split)
    got = sorted((r.run_id, r.split, r.y_pred) for r in writers.read_predictions(spark, out).collect())
    assert got == [("r1", "test", 2.0), ("r2", "test", 5.0), ("r2", "val", 4.0)]


def test_formats_are_named_and_folders_are_read(spark, tmp_path):
    path = str(tmp_path / "holidays.data")
    df = spark.sql("SELECT TIMESTAMP_NTZ '2019-01-01 00:00:00' AS hourly_range, 1 AS Federal_Holiday")
    df.write.option("header", True).csv(path)
    df.write.parquet(path + ".csv")
    wanted = {"holidays": schemas.HOLIDAYS}
    for formats, place in (("csv", path), ({"holidays": "parquet"}, path + ".csv")):
        assert readers.read_inputs(spark, {"holidays": place}, wanted, formats)["holidays"].first().Federal_Holiday == 1
    with pytest.raises(ValueError, match="unknown formats"):
        readers.read_inputs(spark, {"holidays": path}, wanted, "xls")

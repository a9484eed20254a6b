"""Bucketed joins, wide windows, monthly moments, dictionaries and covering grids."""

from __future__ import annotations

import random
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F, types as T

from hourloom.operators import categories, enrich, lagging, moments, scaling
from hourloom.operators.forecast import FOREST_AXES, covering_grid, expand_grid, is_valid, sample_grid, spark_axes
from hourloom.sources import bucketed
from tests.helpers import rows


def test_bucketed_tables_join_without_an_exchange(spark, tmp_path):
    hours = spark.range(500).select(
        F.concat(F.lit("s"), F.col("id") % 3).alias("site"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(hours="id")).alias("hour"),
        "id",
    )
    tables = {n: hours.where(F.col("id") % k != 1).withColumnRenamed("id", n) for n, k in (("a", 5), ("b", 7), ("c", 11))}
    key = ["site", "hour"]
    bucketed.bucket_tables(tables, str(tmp_path), key, buckets=4)
    expected = rows(enrich.merge_hourly(list(tables.values()), key), *key)
    for attached in (True, False):
        if not attached:  # as another session finds them: by the files and their layout
            for name in tables:
                spark.sql(f"DROP TABLE {bucketed._name(f'{tmp_path}/{name}')}")
        found = bucketed.bucketed_tables(spark, str(tmp_path), list(tables))
        threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            merged = enrich.merge_hourly(list(found.values()), key)
            plan = merged._jdf.queryExecution().executedPlan().toString()
            assert "Exchange" not in plan and plan.count("SortMergeJoin") == 2
            assert rows(merged, *key) == expected
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


@pytest.mark.parametrize("size, bucket", [(1, 4), (5, 4), (37, 4), (400, 16)])
def test_wide_windows_equal_plain_means(spark, size, bucket):
    r = random.Random(size)
    data = [(s, i, r.choice([None, float("nan"), *[r.randint(-999, 999) / 8] * 40])) for s in ("x", "y") for i in range(450 if s == "x" else 3)]
    r.shuffle(data)
    df = spark.createDataFrame(data, "s string, t long, v double")
    got = rows(lagging.wide_rolling_mean(df, "v", ["t"], size, ["s"], bucket_rows=bucket), "s", "t")
    series = {}
    for s, _, v in sorted(data, key=lambda d: d[:2]):
        series.setdefault(s, []).append(None if v is None or np.isnan(v) else v)
    for s, t, _, mean in got:
        window = series[s][max(0, t - size + 1) : t + 1]
        full = len(window) == size and None not in window
        assert mean == (pytest.approx(sum(window) / size, abs=1e-9) if full else None)
    assert len(got) == len(data)


def test_wide_windows_take_the_place_of_buckets(spark, monkeypatch):
    df = spark.range(300).select(F.col("id").alias("t"), (F.col("id") % 17).cast("double").alias("v"))
    plain = lagging.shifted_frame(df, "v", ["t"], lags=2, leads=1, window_size=50)
    expected, columns = rows(plain, "t"), plain.columns
    monkeypatch.setattr(lagging, "WIDE_WINDOW", 10)
    wide = lagging.shifted_frame(df, "v", ["t"], lags=2, leads=1, window_size=50)
    assert wide.columns == columns and rows(wide, "t") == expected
    with pytest.raises(ValueError, match="at least one"):
        lagging.wide_rolling_mean(df, "v", ["t"], 0)


def test_moments_of_months_give_the_parameters_of_all_rows(spark, tmp_path):
    rng = np.random.default_rng(4)
    data = [
        (s, f"2024-{1 + i % 5:02d}-{1 + i % 28:02d}", float(1e6 + rng.normal()), float(i % 2) if i % 9 else None, float(i // 200), 7.0, None)
        for s in ("n", None) for i in range(600)
    ]
    df = spark.createDataFrame(data, "s string, day string, y double, flag double, step double, same double, none double")
    columns = ["y", "flag", "step", "same", "none"]
    log = moments.moments_log(str(tmp_path / "m"), [T.StructField("s", T.StringType())])
    for month in ("01", "02", "03", "04", "05", "03"):
        log.append(moments.month_moments(df.where(F.substring("day", 6, 2) == month), columns, "day", ["s"]))
    got = {(r.s, r.role, r.column): (r["mean"], r["std"]) for r in moments.fit_from_moments(log.read(spark), "y", ["s"]).collect()}
    full = {(r.s, r.role, r.column): (r["mean"], r["std"]) for r in scaling.fit_scaler(df, columns, "y", ["s"]).collect()}
    assert got.keys() == full.keys() and len(got) == 2 * 3  # y, flag (two values and missing ones), step
    for k in got:
        assert got[k] == pytest.approx(full[k], rel=1e-9)


def test_a_new_month_reads_no_old_rows(spark, tmp_path):
    df = spark.createDataFrame([(f"2024-0{m}-03", float(m * i)) for m in (1, 2) for i in range(5)], "day string, y double")
    path = str(tmp_path / "rows")
    df.withColumn("m", F.substring("day", 6, 2)).write.partitionBy("m").parquet(path)
    new = moments.month_moments(spark.read.parquet(path).where("m = '02'"), ["y"], "day")
    assert rows(new.select("month", "rows", "hi")) == [(__import__("datetime").date(2024, 2, 1), 5, 8.0)]
    log = moments.moments_log(str(tmp_path / "log"))
    log.append(moments.month_moments(spark.read.parquet(path).where("m = '01'"), ["y"], "day"))
    one = moments.fit_from_moments(log.read(spark), "y").first()
    log.append(new)
    both = moments.fit_from_moments(log.read(spark), "y").first()
    assert (one["mean"], both["mean"]) == (2.0, 3.0) and both["std"] == pytest.approx(np.std([m * i for m in (1, 2) for i in range(5)]))


def test_dictionaries_apply_to_other_tables(spark):
    fitted = spark.createDataFrame([("b", 1), ("a", 2), ("a", None), (None, 1)], "kind string, n int")
    dictionary = categories.fit_categories(fitted, ["kind", "n"])
    assert rows(dictionary, "column", "category") == [
        ("kind", "a", 2, 0), ("kind", "b", 1, 1), ("n", "1", 2, 0), ("n", "2", 1, 1)
    ]
    other = spark.createDataFrame([("b",), ("c",), (None,), ("",)], "label string")
    got = categories.one_hot_fitted(other, "label", dictionary, "k", fitted="kind")
    assert got.columns == ["label", "k_a", "k_b", "k_unseen"]
    assert sorted(map(tuple, got.collect()), key=repr) == [("", 0, 0, 1), ("b", 0, 1, 0), ("c", 0, 0, 1), (None, 0, 0, 0)]
    placed = categories.with_position(other, "label", dictionary, fitted="kind")
    assert sorted(map(tuple, placed.collect()), key=repr) == [("", None, 1), ("b", 1, 0), ("c", None, 1), (None, None, 0)]
    numbers = categories.one_hot_fitted(spark.createDataFrame([(2,), (3,)], "n int"), "n", dictionary)
    assert rows(numbers, "n") == [(2, 0, 1, 0), (3, 0, 0, 1)]
    with pytest.raises(ValueError, match="more than 1"):
        categories.one_hot_fitted(other, "label", dictionary, fitted="kind", most=1)
    nothing = categories.fit_categories(fitted.limit(0), ["kind"])
    assert rows(categories.one_hot_fitted(other.limit(1), "label", nothing, "k", fitted="kind")) == [("b", 1)]


def held(maps, axes):
    """The pairs of axes and places of their values that the maps hold."""
    at = lambda m, n: next(i for i, v in enumerate(axes[n]) if v == m[n])
    return {((a, at(m, a)), (b, at(m, b))) for m in maps for a, b in combinations(axes, 2)}


def test_every_pair_of_the_forest_in_few_maps():
    axes = spark_axes("RF")
    assert len(axes) == 7
    maps = covering_grid(axes)
    assert len(maps) < 30 and all(map(is_valid, maps)) and all(list(m) == list(axes) for m in maps)
    assert held(maps, axes) == held(expand_grid(axes), axes)  # all that valid maps can hold
    assert covering_grid(axes) == maps
    wide = {f"p{i}": list(range(6)) for i in range(14)}  # a product of 6^14 maps is never listed
    many = covering_grid(wide)
    assert len(held(many, wide)) == 91 * 36 and len(many) < 120


def test_drawn_maps_hold_every_value_without_the_product():
    for count in (1, 10, 500):
        maps = sample_grid(FOREST_AXES, count)
        assert len(maps) >= count and all(map(is_valid, maps))
        assert len({repr(sorted(m.items(), key=str)) for m in maps}) == len(maps)
        for name, values in FOREST_AXES.items():
            assert all(any(m[name] == v for m in maps) for v in values), name
        assert sample_grid(FOREST_AXES, count) == maps
    small = {"bootstrap": [True, False], "max_samples": [None, 0.5]}
    assert sorted(map(repr, sample_grid(small, 99))) == sorted(map(repr, expand_grid(small)))
    huge = {f"p{i}": list(range(9)) for i in range(30)}
    assert len(sample_grid(huge, 40)) == 40

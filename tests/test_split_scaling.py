from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from hourloom.operators import scaling
from hourloom.operators.split import chronological_split, split_counts
from hourloom.session import materialise
from tests.helpers import rows


@pytest.mark.parametrize("n, sizes", [(342, (239, 51, 52)), (1, (0, 0, 1)), (7, (4, 1, 2)), (39411, (27587, 5911, 5913))])
def test_split_sizes_are_truncated(spark, n, sizes):
    df = spark.range(n).select(F.col("id").alias("idx"), F.lit(n).cast("long").alias("series_rows"))
    counts = {r.split: r.rows for r in split_counts(chronological_split(df)).collect()}
    assert tuple(counts.get(s, 0) for s in ("train", "val", "test")) == sizes
    assert sizes == (int(n * 0.7), int(n * 0.15), n - int(n * 0.7) - int(n * 0.15))


def test_split_follows_time_in_each_series(spark):
    df = spark.createDataFrame(
        [(k, i, n) for k, n in (("a", 10), ("b", 4)) for i in range(n)], "k string, idx long, series_rows long"
    )
    got = chronological_split(df, 0.5, 0.25)
    assert [r.split for r in got.where("k = 'a'").orderBy("idx").collect()] == (
        ["train"] * 5 + ["val"] * 2 + ["test"] * 3
    )
    assert rows(split_counts(got, ["k"]).where("k = 'b'"), "split") == [
        ("b", "test", 1), ("b", "train", 2), ("b", "val", 1)
    ]


@pytest.fixture(scope="module")
def table(spark):
    return materialise(
        spark.range(60).select(
            F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 20 == 1, None).otherwise("b").alias("k"),
            F.col("id"),
            (F.col("id") % 2).alias("two"),
            F.when(F.col("id") % 5 != 0, F.col("id") % 2).alias("two_and_null"),
            F.greatest(F.col("id") - 57, F.lit(0)).alias("three"),
            F.lit(4.0).alias("same"),
            F.when(F.col("id") > 3, 1).alias("one_and_null"),
            (F.col("id") * 1.5).alias("y"),
        )
    )


COLUMNS = ["two", "two_and_null", "three", "same", "one_and_null", "y"]


def test_non_binary_counts_null_as_a_value(spark, table):
    got = {r.column: r.non_binary for r in scaling.column_profile(table, COLUMNS).collect()}
    pdf = table.toPandas()
    assert got == {c: bool(pdf[c].nunique(dropna=False) > 2) for c in COLUMNS}
    assert got == {
        "two": False, "two_and_null": True, "three": True, "same": False, "one_and_null": False, "y": True
    }


def test_non_binary_by_series(spark, table):
    got = {(r.k, r.column): r.non_binary for r in scaling.column_profile(table, COLUMNS, ["k"]).collect()}
    pdf = table.toPandas()
    expected = {
        (None if k != k else k, c): bool(g[c].nunique(dropna=False) > 2)
        for k, g in pdf.groupby("k", dropna=False)
        for c in COLUMNS
    }
    assert got == expected and len(got) == 18


def test_scaler_uses_population_deviation_and_scale_one_for_constants(spark, table):
    params = scaling.fit_scaler(table, ["two", "three", "y"], "same")
    got = {r.column: (r.role, r.mean, r.std) for r in params.collect()}
    y = np.arange(60) * 1.5
    assert set(got) == {"three", "y", "same"}
    assert got["y"] == ("feature", pytest.approx(y.mean()), pytest.approx(y.std()))
    assert got["same"] == ("target", 4.0, 1.0)


def test_scale_and_back(spark, table):
    params = materialise(scaling.fit_scaler(table, ["two", "three"], "y", ["k"]))
    scaled = scaling.scale(table, params, ["two", "three", "y"], ["k"])
    back = scaling.unscale(scaled, params, "y", {"y_scaled": "restored"}, ["k"])
    pdf = back.toPandas()
    assert len(pdf) == 60
    assert (pdf["two_scaled"] == pdf["two"].astype(float)).all()
    assert np.allclose(pdf["restored"], pdf["y"])
    hot = pdf[pdf["k"] == "hot"]
    assert np.allclose(hot["y_scaled"], (hot["y"] - hot["y"].mean()) / hot["y"].std(ddof=0))


def test_without_parameters_values_pass_through(spark, table):
    none = materialise(scaling.fit_scaler(table, [], "y").where("role = 'feature'"))
    assert scaling.scale(table, none, ["three"]).where("three_scaled <> three").count() == 0
    assert scaling.unscale(table, none, "y", {"y": "z"}).where("z <> y").count() == 0


def test_arrays_are_single_precision_in_feature_order(spark, table):
    arrays = scaling.feature_arrays(table, ["three", "two"], "y", ["id"])
    assert arrays.schema.simpleString() == "struct<id:bigint,x:array<float>,y:array<float>>"
    assert tuple(arrays.where("id = 59").first()) == (59, [2.0, 1.0], [88.5])

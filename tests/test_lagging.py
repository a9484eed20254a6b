from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from hourloom.operators import lagging
from hourloom.operators.timeindex import row_index, with_ordinal
from tests.helpers import rows

SLOW = settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def long_frame(spark, values, keys=None):
    """Rows in shuffled order; ``t`` has gaps."""
    n = len(values)
    data = [(int(3 * i + i % 2), None if keys is None else keys[i], values[i]) for i in range(n)]
    order = np.random.default_rng(7).permutation(n)
    df = spark.createDataFrame([data[i] for i in order], "t long, k string, v double")
    return df if keys is not None else df.drop("k")


def expected_frame(values, lags, horizon, keys=None):
    pdf = pd.DataFrame({"t": [3 * i + i % 2 for i in range(len(values))], "v": values})
    pdf["v"] = pdf["v"].astype("float64")
    pdf["k"] = "one" if keys is None else keys
    out = []
    for _, g in pdf.groupby("k", sort=True):
        g = g.copy()
        for i in range(1, lags + 1):
            g[f"lag_{i}_v"] = g["v"].shift(i)
        for i in range(1, horizon + 1):
            g[f"future_{i}_v"] = g["v"].shift(-i)
        g = g.dropna()
        g["idx"] = range(len(g))
        g["series_rows"] = len(g)
        out.append(g.drop(columns=[f"future_{i}_v" for i in range(1, horizon)]))
    both = pd.concat(out)
    names = ["t", "idx", "series_rows", "v", *[f"lag_{i}_v" for i in range(1, lags + 1)], f"future_{horizon}_v"]
    return [tuple(r) for r in both[["k", *names]].sort_values(["k", "t"]).itertuples(index=False)]


values = st.lists(st.one_of(st.none(), st.integers(-50, 50).map(float)), min_size=1, max_size=60)


@SLOW
@given(values=values, lags=st.integers(0, 5), horizon=st.integers(1, 4), width=st.integers(1, 13))
def test_buckets_equal_pandas_shift(spark, values, lags, horizon, width):
    df = long_frame(spark, values)
    got = lagging.supervised_frame(df, ["t"], ["v"], {"v": lags}, horizon, "v", bucket_rows=width)
    assert [("one", *r) for r in rows(got, "t")] == expected_frame(values, lags, horizon)


@SLOW
@given(
    values=values, lags=st.integers(0, 4), horizon=st.integers(1, 3), width=st.integers(1, 9),
    whole=st.booleans(),
)
def test_series_equal_pandas_shift(spark, values, lags, horizon, width, whole):
    # one hot series, two small ones
    keys = ["hot" if i % 3 else ("a" if i % 2 else "b") for i in range(len(values))]
    df = long_frame(spark, values, keys)
    got = lagging.supervised_frame(
        df, ["t"], ["v"], {"v": lags}, horizon, "v", ["k"],
        series_bound=len(values) if whole else None, bucket_rows=width,
    )
    assert rows(got, "k", "t") == expected_frame(values, lags, horizon, keys)


@pytest.mark.parametrize("width", [1, 2, 5, None])
def test_rolling_mean_needs_a_full_window(spark, width):
    values = [1.0, 2.0, None, 4.0, 6.0, 8.0, 1.0]
    got = lagging.shifted_frame(
        long_frame(spark, values), "v", ["t"], lags=1, leads=2, window_size=3, bucket_rows=width
    )
    assert got.columns == ["t", "v", "lag_1_v", "future_1_v", "future_2_v", "rolling_mean_v_window_size_3"]
    expected = pd.Series(values, dtype="float64").rolling(3).mean()
    means = [r[-1] for r in rows(got, "t")]
    assert means == [None if pd.isna(x) else pytest.approx(x) for x in expected]
    assert [r[3] for r in rows(got, "t")] == [2.0, None, 4.0, 6.0, 8.0, 1.0, None]


def test_a_missing_target_inside_the_horizon_removes_the_row(spark):
    values = [float(i) for i in range(12)]
    values[5] = None
    got = lagging.supervised_frame(long_frame(spark, values), ["t"], ["v"], {}, 4, "v")
    # rows 1..5 see the gap, rows 8..11 see the end
    assert [r[3] for r in rows(got, "t")] == [0.0, 6.0, 7.0]


def test_unknown_lag_features_are_skipped_and_order_is_kept(spark):
    df = spark.range(10).select(F.col("id").alias("t"), F.col("id").alias("a"), (F.col("id") * 2).alias("b"))
    with pytest.warns(UserWarning, match="nope"):
        got = lagging.supervised_frame(df, ["t"], ["b", "a"], {"a": 2, "nope": 3, "b": 1}, 2, "b")
    assert got.columns == ["t", "idx", "series_rows", "b", "a", "lag_1_a", "lag_2_a", "lag_1_b", "future_2_b"]
    with pytest.raises(ValueError, match="missing columns"):
        lagging.supervised_frame(df, ["t"], ["a", "c"], {}, 1, "a")


def test_row_index_with_a_hot_series(spark):
    df = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 211).cast("string")).alias("k"),
        F.pmod(F.col("id") * 7919, F.lit(5000)).alias("t"),
    )
    pdf = df.toPandas().sort_values(["k", "t"])
    pdf["idx"] = pdf.groupby("k").cumcount()
    expected = [tuple(r) for r in pdf.itertuples(index=False)]
    assert rows(row_index(df, ["t"], ["k"], bucket_rows=37).select("k", "t", "idx"), "k", "t") == expected
    single = rows(row_index(df.select("t"), ["t"]), "t")
    assert [r[1] for r in single] == list(range(5000))


def test_ordinals_are_dense_over_many_partitions(spark):
    df = spark.range(20000).select((F.col("id") * 31 % 20011).alias("t"))
    kept = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = with_ordinal(df, ["t"])
        assert placed.inputFiles() and len(placed.inputFiles()) > 1
        assert [r[0] for r in rows(placed.select("_ordinal"), "t")] == list(range(20000))
        assert placed.select("_total").distinct().collect() == [(20000,)]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", kept)


def test_copies_of_one_row_are_split(spark):
    # a third of all rows are equal, in every partition of the input
    df = spark.range(9000, numPartitions=16).select(
        F.when(F.col("id") % 3 == 0, 1000).otherwise(F.col("id")).alias("t"), F.lit("a").alias("k")
    )
    kept = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = with_ordinal(df, ["t"], ["k"])
        sizes = [spark.read.parquet(path).count() for path in placed.inputFiles()]
        assert sum(sizes) == 9000 and max(sizes) < 2500
        ordinals = rows(placed.select("t", "_ordinal"), "_ordinal")
        assert [r[1] for r in ordinals] == list(range(9000))
        assert [r[0] for r in ordinals] == sorted(r[0] for r in ordinals)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", kept)


def test_a_row_without_a_series_is_refused(spark):
    df = spark.createDataFrame([("a", 1), (None, 2)], "k string, t int")
    with pytest.raises(Exception, match="no series key k"):
        row_index(df, ["t"], ["k"]).collect()


def test_empty_table(spark):
    df = spark.createDataFrame([], "t long, v double")
    got = lagging.supervised_frame(df, ["t"], ["v"], {"v": 2}, 2, "v")
    assert got.count() == 0 and got.columns[-1] == "future_2_v"


@pytest.mark.parametrize("bound", [None, 1_000])
def test_rows_without_a_key_are_refused_in_both_layouts(spark, bound):
    df = long_frame(spark, [1.0, 2.0, 3.0, 4.0], ["a", "a", None, "a"])
    with pytest.raises(Exception, match="no series key"):
        lagging.supervised_frame(df, ["t"], ["v"], {"v": 1}, 1, "v", ["k"], bound).collect()


def test_nan_counts_as_missing(spark):
    values = [1.0, 2.0, float("nan"), 4.0, 5.0, 6.0, 7.0]
    nulls = [None if v != v else v for v in values]
    frames = [lagging.supervised_frame(long_frame(spark, v), ["t"], ["v"], {"v": 1}, 1, "v") for v in (values, nulls)]
    assert rows(frames[0], "t") == rows(frames[1], "t")

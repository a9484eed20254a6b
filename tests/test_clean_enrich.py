from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from hourloom.operators import clean, enrich
from hourloom.operators.lookup import lookup
from hourloom.sources.readers import nulls_for_nans
from tests.helpers import hours, rows


def test_range_is_closed_and_drops_missing_times(spark):
    df = hours(
        spark,
        [("2024-01-01 00:00:00", 1), ("2024-01-01 01:00:00", 2), ("2024-01-01 02:00:00", 3), (None, 4)],
        "t string, v int",
    )
    got = clean.filter_range(df, "t", "2024-01-01 00:00:00", "2024-01-01 01:00:00")
    assert [r.v for r in got.orderBy("v").collect()] == [1, 2]


def test_exclusion_with_a_date_as_upper_bound(spark):
    df = hours(
        spark,
        [("2024-01-01 23:00:00", 1), ("2024-01-02 00:00:00", 2), ("2024-01-02 01:00:00", 3), (None, 4)],
        "t string, v int",
    )
    got = clean.exclude_window(df, "t", "2024-01-01", "2024-01-02")
    assert [r.v for r in got.orderBy("v").collect()] == [3, 4]


def test_rounding_keeps_types_and_skips_text(spark):
    df = spark.createDataFrame([(2.5, 3, "a")], "x double, n int, s string")
    df = df.withColumn("f", F.lit(0.5).cast("float"))
    got = clean.round_numbers(df)
    assert got.schema.simpleString() == df.schema.simpleString()
    assert tuple(got.first()) == (2.0, 3, "a", 0.0)
    assert tuple(clean.round_numbers(df, ["f"]).first()) == (2.5, 3, "a", 0.0)


def test_column_helpers(spark):
    df = spark.createDataFrame([("2024-01-01", 1, None)], "DateTime string, a int, flag int")
    named = clean.parse_time(clean.rename(df, {"DateTime": "hourly_range"}), "hourly_range")
    assert named.first().hourly_range == dt.datetime(2024, 1, 1)
    assert clean.drop_if_present(named, "a", "not_there").columns == ["hourly_range", "flag"]
    assert clean.fill_flag(df, "flag").first().flag == 0
    assert clean.select_ordered(df, ["flag", "a"]).columns == ["flag", "a"]
    with pytest.raises(ValueError, match="missing columns"):
        clean.select_ordered(df, ["nope"])
    with pytest.warns(UserWarning, match="no such column"):
        assert clean.known_features(df, {"a": 3, "nope": 2}) == {"a": 3}


def test_nan_is_missing_after_reading(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,)], "x double")
    assert nulls_for_nans(df).agg(F.avg("x"), F.count("x")).first() == (1.0, 1)


def test_duplicate_keys_are_refused_or_fan_out(spark):
    left = hours(spark, [("2024-01-01 00:00:00", 1), ("2024-01-01 00:00:00", 2)], "t string, a int")
    right = hours(spark, [("2024-01-01 00:00:00", 7)], "t string, b int")
    with pytest.raises(ValueError, match="duplicate key"):
        clean.assert_unique(left, ["t"])
    assert clean.assert_unique(right, ["t"]) is right
    assert enrich.merge_hourly([left, right], ["t"]).count() == 2


def test_equal_names_need_suffixes(spark):
    a = hours(spark, [("2024-01-01 00:00:00", 1)], "t string, v int")
    b = hours(spark, [("2024-01-01 00:00:00", 2)], "t string, v int")
    with pytest.raises(ValueError, match="several tables"):
        enrich.merge_hourly([a, b], ["t"])
    merged = enrich.merge_hourly([a, b], ["t"], suffixes=["_x", "_y"])
    assert merged.columns == ["t", "v_x", "v_y"]


def test_calendar_flags(spark):
    df = hours(spark, [("2024-01-01 00:00:00",), ("2024-01-01 05:00:00",), ("2024-01-02 05:00:00",)], "t string")
    games = hours(spark, [("2024-01-02 05:00:00", 1, "x")], "t string, game int, note string")
    days = hours(spark, [("2024-01-01", 1)], "t string, holiday int")
    got = enrich.flag_dates(enrich.flag_hours(df, games, "t", "game"), days, "t", "holiday")
    assert got.columns == ["t", "game", "holiday"]
    assert [r[1:] for r in rows(got, "t")] == [(0, 1), (0, 1), (1, 0)]


def test_weather_replaces_its_label(spark):
    df = spark.createDataFrame([("Mist",), (None,)], "weather_main string")
    got = enrich.add_weather(df)
    assert got.columns[0] == "weather_type" and "weather_main" not in got.columns
    assert sorted(r.weather_type for r in got.collect()) == ["Clouds", "Others"]
    assert got.where("weather_type = 'Others'").first().weather_Others == 1


def test_extreme_flag_is_inclusive_and_uses_the_sample_deviation(spark):
    # mean 2, sample deviation 1: the limit is exactly 3
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (None,)], "v double")
    got = enrich.add_extreme_flag(df, "v")
    assert rows(got.where("v is not null"), "v") == [(1.0, 0), (2.0, 0), (3.0, 1)]
    assert got.where("v is null").first().extreme_indicator == 0


def test_extreme_flag_by_series_and_from_other_rows(spark):
    df = spark.createDataFrame(
        [("a", 1.0), ("a", 2.0), ("a", 3.0), ("b", 10.0), ("b", 20.0), ("b", 30.0), (None, 5.0), (None, 7.0)],
        "k string, v double",
    )
    got = {(r.k, r.v): r.extreme_indicator for r in enrich.add_extreme_flag(df, "v", by=["k"]).collect()}
    assert len(got) == 8
    assert [k for k, f in got.items() if f] == [("a", 3.0), ("b", 30.0)] or {
        k for k, f in got.items() if f
    } == {("a", 3.0), ("b", 30.0)}
    first = enrich.add_extreme_flag(df, "v", fit_on=df.where("k = 'a'"))
    assert first.agg(F.sum("extreme_indicator")).first()[0] == 6


def test_lookup_gives_the_same_with_and_without_broadcast(spark):
    facts = spark.range(2000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None)
        .otherwise((F.col("id") % 17).cast("string")).alias("k"),
        F.col("id").alias("v"),
    )
    params = facts.groupBy("k").agg(F.sum("v").alias("total"))
    wide = rows(lookup(facts, params, ["k"]), "v")
    dealt = rows(lookup(facts, params, ["k"], broadcast_rows=0, rows_per_deal=100), "v")
    assert len(wide) == 2000 and wide == dealt
    assert all(r[2] is not None for r in wide)


def test_regular_grid_fills_missing_hours_per_series(spark):
    df = hours(
        spark,
        [("2024-01-01 22:00:00", "a", 1), ("2024-01-02 01:00:00", "a", 2), ("2024-01-05 00:00:00", None, 3)],
        "t string, k string, v int",
    )
    got = enrich.regular_grid(df, "t", ["k"])
    assert got.count() == 5
    assert [r[2] for r in rows(got.where("k = 'a'"), "t")] == [1, None, None, 2]
    assert got.where("k is null").first().v == 3


def test_regular_grid_starts_at_the_first_time(spark):
    half = [(f"2024-01-{1 + (h + 12) // 24:02d} {(h + 12) % 24:02d}:30:00", "a", h) for h in range(24) if h != 20]
    got = enrich.regular_grid(hours(spark, half, "t string, k string, v int"), "t", ["k"])
    assert [r[2] for r in rows(got, "t")] == [*range(20), None, *range(21, 24)]
    mixed = [*half, ("2024-01-02 13:00:00", "a", 30)]
    with pytest.raises(Exception, match="off the hourly grid"):
        enrich.regular_grid(hours(spark, mixed, "t string, k string, v int"), "t", ["k"]).collect()


def test_a_dealt_lookup_hashes_rows_that_hold_maps(spark):
    facts = spark.range(900).select(
        F.when(F.col("id") < 600, 0).otherwise(F.col("id") % 7).alias("k"),
        F.struct(F.create_map(F.lit("a"), F.col("id")).alias("m")).alias("s"),
    )
    params = facts.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    got = lookup(facts, params, ["k"], broadcast_rows=0, rows_per_deal=50)
    assert got.count() == 900 and got.where("n IS NULL").count() == 0


def test_a_hot_key_is_dealt_over_many_tasks(spark):
    facts = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 5000).alias("k"), "id"
    )
    params = facts.select("k").distinct().withColumn("p", F.lit(1))
    names = ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")
    before = {n: spark.conf.get(n) for n in names}
    try:
        for name, value in zip(names, ("false", "-1"), strict=True):
            spark.conf.set(name, value)
        got = lookup(facts, params, ["k"], broadcast_rows=0, rows_per_deal=500)
        sizes = got.groupBy(F.spark_partition_id()).count().agg(F.max("count"), F.sum("count")).first()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert sizes[1] == 30_000 and sizes[0] < 8_000  # the key alone has 10,000


def test_finite_report_and_guard(spark):
    df = spark.createDataFrame(
        [("a", float("nan"), 1.0), ("a", float("inf"), None), ("b", -float("inf"), 2.0)],
        "k string, x double, y double",
    )
    report = rows(clean.finite_report(df, ["x", "y"], ["k"]), "k", "column")
    assert report == [("a", "x", 1, 1, 0), ("a", "y", 0, 0, 1), ("b", "x", 0, 1, 0), ("b", "y", 0, 0, 0)]
    assert clean.guard_finite(df, ["y"]).count() == 3
    with pytest.raises(Exception, match="not finite: x"):
        clean.guard_finite(df, ["x"]).collect()


def test_scoring_input_contract(spark):
    df = spark.createDataFrame([(1, 2.0, 3.0)], "id int, b double, a double")
    with pytest.warns(UserWarning, match="recorded order"):
        assert clean.conform_features(df, ["a", "b"], carry=["id"]).columns == ["id", "a", "b"]
    with pytest.raises(ValueError, match="expected"):
        clean.conform_features(df, ["a"], carry=["id"])

from __future__ import annotations

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from hourloom.functions import aggregates as A
from hourloom.functions import scalar as S
from tests.helpers import rows, value


def test_round_half_even(spark):
    df = spark.createDataFrame([(x,) for x in (0.5, 1.5, 2.5, -0.5, -1.5, 2.4999)], "x double")
    got = [r[0] for r in df.select(S.round_half_even(F.col("x"))).collect()]
    assert got == [0.0, 2.0, 2.0, 0.0, -2.0, 2.0]
    assert math.copysign(1, got[3]) == 1


def test_calendar_monday_is_zero(spark):
    ts = F.lit("2024-01-01 13:45:10").cast("timestamp_ntz")
    got = {k: value(spark, c) for k, c in S.calendar_parts(ts).items()}
    assert got == {"year": 2024, "month": 1, "day_of_month": 1, "hour": 13, "day_of_week": 0}
    assert value(spark, S.truncate_hour(ts)) == dt.datetime(2024, 1, 1, 13)


def test_truncation_ignores_the_session_zone(spark):
    ts = F.lit("2024-03-10 02:30:00").cast("timestamp_ntz")  # this hour is skipped in New York
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert value(spark, S.truncate_hour(ts)) == dt.datetime(2024, 3, 10, 2)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


@pytest.mark.parametrize(
    "label, group",
    [("Mist", "Clouds"), ("Clouds", "Clouds"), ("Drizzle", "Rain"), ("Rain", "Rain"),
     ("Thunderstorm", "Thunderstorm"), ("Clear", "Clear"), ("clear", "Others"), ("Snow", "Others"),
     (None, "Others")],
)
def test_weather_category(spark, label, group):
    assert value(spark, S.weather_category(F.lit(label).cast("string"))) == group


def test_one_hot_has_every_known_value(spark):
    flags = S.one_hot(F.lit("Rain"), S.WEATHER_TYPES, "weather")
    assert list(flags) == [
        "weather_Clear", "weather_Clouds", "weather_Others", "weather_Rain", "weather_Thunderstorm"
    ]
    assert [value(spark, c) for c in flags.values()] == [0, 0, 0, 1, 0]


@pytest.mark.parametrize(
    "name, metric",
    [("reg_TSTPlus_6hours_boarding_count_dataset1_trial4_mae4.2947.pkl", 4.2947),
     ("model_MAE_4.3311", 4.3311), ("model_without", None), ("mae7", 7.0)],
)
def test_metric_in_name(spark, name, metric):
    assert value(spark, S.metric_in_name(F.lit(name))) == metric


def test_name_parts_of_a_target_with_several_words(spark):
    name = F.lit("reg_TSTPlus_6hours_boarding_count_dataset15_trial4_mae4.2947")
    assert value(spark, S.dataset_in_name(name)) == "dataset15"
    assert value(spark, S.horizon_in_name(name)) == 6
    assert value(spark, S.target_in_name(name)) == "boarding_count"
    assert value(spark, S.dataset_in_test_file(F.lit("test_X_dataset3.npy"))) == "dataset3"
    assert value(spark, S.dataset_in_test_file(F.lit("else.npy"))) == "unknown"


def test_fixed4_rounds_like_c(spark):
    numbers = [68.42345, 0.00015, 0.00025, 2.00015, 1234567.0, -0.33333, 0.125, 12.34565, 1e-9]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(numbers)], "i int, x double")
    got = [r[0] for r in df.orderBy("i").select(S.fixed4(F.col("x"))).collect()]
    assert got == [f"{x:.4f}" for x in numbers]
    assert value(spark, S.fixed4_or_na(F.lit(None).cast("double"))) == "N/A"


def test_run_ids(spark):
    key = S.dataset_key(F.lit(6), F.lit("boarding_count"), F.lit("dataset1"))
    assert value(spark, key) == "6hours_boarding_count_dataset1"
    run = S.network_run_id(F.lit("TST"), key, F.lit(4), F.lit(4.29466))
    assert value(spark, run) == "reg_TST_6hours_boarding_count_dataset1_trial4_mae4.2947"
    stamp = F.lit("2024-02-03 04:05:06").cast("timestamp_ntz")
    parts = [("trees", F.lit(200)), ("depth", F.lit(20))]
    forest = S.grid_run_id(stamp, F.lit(4.5), "RF", parts, F.lit("dataset2"), value_first=True)
    assert value(spark, forest) == "20240203_040506_4_5000_RF_200_trees_20_depth_dataset2"
    boosted = S.grid_run_id(stamp, F.lit(4.5), "XGB", [("eta", F.lit(0.1))], F.lit("dataset2"))
    assert value(spark, boosted) == "20240203_040506_4_5000_XGB_eta_0.1_dataset2"


def test_small_helpers(spark):
    start, end = (F.lit(t).cast("timestamp_ntz") for t in ("2024-01-01 00:00:00", "2024-01-01 01:30:30"))
    assert value(spark, S.minutes_between(start, end)) == 90.5
    assert value(spark, S.map_total(F.create_map(F.lit("a"), F.lit(24), F.lit("b"), F.lit(12)))) == 36
    assert value(spark, S.array_mean(F.array(F.lit(1.0), F.lit(2.0), F.lit(6.0)))) == 3.0
    assert value(spark, S.array_mean(F.array().cast("array<double>"))) is None
    for x, expected in ((float("nan"), True), (float("-inf"), True), (1.0, False)):
        assert value(spark, S.not_finite(F.lit(x))) is expected


def test_strict_cast_raises_whatever_the_ansi_mode_is(spark):
    assert value(spark, S.strict_cast(F.lit("2024-01-01"), "timestamp_ntz")) == dt.datetime(2024, 1, 1)
    assert value(spark, S.strict_cast(F.lit(None).cast("string"), "double")) is None
    for ansi in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        try:
            with pytest.raises(Exception, match="cannot read as"):
                value(spark, S.strict_cast(F.concat(F.lit("x"), F.lit("y")), "double"))
        finally:
            spark.conf.unset("spark.sql.ansi.enabled")


def test_metrics(spark):
    df = spark.createDataFrame([(3.0, 2.5), (-0.5, 0.0), (2.0, 2.0), (7.0, 8.0)], "y double, p double")
    y, p = F.col("y"), F.col("p")
    mae, mse, rmse, r2 = df.agg(A.mae(y, p), A.mse(y, p), A.rmse(y, p), A.r2(y, p)).first()
    assert (mae, mse) == (0.5, 0.375)
    assert rmse == pytest.approx(0.375**0.5)
    assert r2 == pytest.approx(0.9486081370449679)


def test_r2_of_a_constant_truth(spark):
    df = spark.createDataFrame(
        [("exact", 2.0, 2.0), ("exact", 2.0, 2.0), ("off", 2.0, 1.0), ("off", 2.0, 2.0)],
        "k string, y double, p double",
    )
    got = df.groupBy("k").agg(A.r2(F.col("y"), F.col("p")).alias("r2"))
    assert rows(got, "k") == [("exact", 1.0), ("off", 0.0)]

"""Views over the driver's tables that stand in for the hourly inputs and the logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from hourloom.functions import scalar as S
from hourloom.operators.lagging import supervised_frame
from hourloom.sources import schemas as N
from hourloom.sources.config import JobConfig

# The features of the default job, in order.
FEATURES = (
    "UED_Hospital_Census",
    "total_patient_count",
    "patient_count_ESI_1_2",
    "patient_count_ESI_3",
    "patient_count_ESI_4_5",
    "cumulative_total_average_waiting_time",
    "cumulative_average_waiting_ESI_1_2",
    "cumulative_average_waiting_ESI_3",
    "cumulative_average_waiting_ESI_4_5",
    "temp",
    "boarding_count",
    "average_boarding_times_minute",
    "treatment_count",
    "average_waiting_times_treatment_minute",
    "Alabama_Football_Game_Actual_Time",
    "Federal_Holiday",
    "year",
    "month",
    "day_of_month",
    "hour",
    "day_of_week",
    "weather_Clear",
    "weather_Clouds",
    "weather_Others",
    "weather_Rain",
    "weather_Thunderstorm",
    "humidity",
    "wind_speed",
    "extreme_indicator",
)

CONFIG = JobConfig(
    dataset_number="dataset15",
    features=FEATURES,
    target_feature="total_patient_count",
    future_hours=6,
    lag_features={"total_patient_count": 24, "UED_Hospital_Census": 24},
)

# The driver's tables as they are read here; without a schema each read would open a file first.
TABLES = {
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double,"
    " l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,"
    " l_shipdate timestamp_ntz",
    "embeddings": "vec_id long, embedding array<float>, label int",
}

RANGE = ("2024-01-01 00:00:00", "2024-01-30 23:00:00")

HOME_GAME_HOURS = ["2024-01-06 18:00:00", "2024-01-13 20:00:00", "2024-01-20 12:00:00"]
AWAY_GAME_HOURS = ["2024-01-07 15:00:00", "2024-01-27 19:00:00"]
HOLIDAY_DATES = ["2024-01-01", "2024-01-15"]

DAILY_FEATURES = ["order_count", "total_value", "urgent_count", "medium_count", "low_count"]
DAILY_LAGS = {"order_count": 7, "total_value": 3}
HORIZON = 6

EVENT_FEATURES = ["value", "is_click", "is_purchase", "hour", "day_of_week"]
EVENT_LAGS = {"value": 3}
EVENT_HORIZON = 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def exact_sum(x: Column) -> Column:
    """Sum of a two-decimal column that does not depend on the order of the rows."""
    return F.sum(x.cast("decimal(18,2)"))


def exact_mean(x: Column) -> Column:
    return exact_sum(x).cast("double") / F.count(x)


def events_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn(N.HOUR, S.truncate_hour(F.col("ts")))


def _kind(*kinds: str) -> Column:
    return F.col("event_type").isin(*kinds)


def _mean_of(*kinds: str) -> Column:
    mean = exact_mean(F.when(_kind(*kinds), F.col("value")))
    return F.when(F.count_if(_kind(*kinds)) > 0, mean).otherwise(0.0)


def patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = F.min(F.struct("ts", "event_id", "event_type")).getField("event_type")
    kinds = ["click", "error", "purchase", "signup"]
    labels = ["Clouds", "Drizzle", "Clear", "Thunderstorm"]
    weather = F
    for kind, label in zip(kinds, labels, strict=True):
        weather = weather.when(F.col("_first") == kind, label)
    return (
        events_by_hour(spark, sf_dir)
        .groupBy(N.HOUR)
        .agg(
            F.count(F.lit(1)).alias("total_patient_count"),
            F.count_if(_kind("error", "purchase")).alias("patient_count_ESI_1_2"),
            F.count_if(_kind("click")).alias("patient_count_ESI_3"),
            F.count_if(_kind("view", "signup")).alias("patient_count_ESI_4_5"),
            exact_mean(F.col("value")).alias("cumulative_total_average_waiting_time"),
            _mean_of("error", "purchase").alias("cumulative_average_waiting_ESI_1_2"),
            _mean_of("click").alias("cumulative_average_waiting_ESI_3"),
            _mean_of("view", "signup").alias("cumulative_average_waiting_ESI_4_5"),
            F.min("value").alias("temp"),
            F.max("value").alias("humidity"),
            (F.max("value") - F.min("value")).alias("wind_speed"),
            first.alias("_first"),
        )
        .withColumn("weather_main", weather.otherwise("Snow"))
        .drop("_first")
    )


def census(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        events_by_hour(spark, sf_dir)
        .groupBy(N.HOUR)
        .agg(F.count_distinct("user_id").alias("UED_Hospital_Census"))
    )


def _activity(spark, sf_dir, kind: str, count: str, mean: str) -> DataFrame:
    return (
        events_by_hour(spark, sf_dir)
        .where(F.col("event_type") == kind)
        .groupBy(N.HOUR)
        .agg(F.count(F.lit(1)).alias(count), exact_mean(F.col("value")).alias(mean))
    )


def boarding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _activity(spark, sf_dir, "purchase", "boarding_count", "average_boarding_times_minute")


def treatment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _activity(
        spark, sf_dir, "click", "treatment_count", "average_waiting_times_treatment_minute"
    )


def _calendar(spark: SparkSession, times: list[str], flag: str) -> DataFrame:
    rows = ", ".join(f"(TIMESTAMP_NTZ '{t}', 1)" for t in times)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS calendar({N.HOUR}, {flag})")


def home_games(spark: SparkSession) -> DataFrame:
    return _calendar(spark, HOME_GAME_HOURS, N.HOME_GAME_FLAG)


def away_games(spark: SparkSession) -> DataFrame:
    return _calendar(spark, AWAY_GAME_HOURS, N.AWAY_GAME_FLAG)


def holidays(spark: SparkSession) -> DataFrame:
    return _calendar(spark, HOLIDAY_DATES, N.HOLIDAY_FLAG)


def inputs(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "patients": patients(spark, sf_dir),
        "census": census(spark, sf_dir),
        "boarding": boarding(spark, sf_dir),
        "treatment": treatment(spark, sf_dir),
        "home_games": home_games(spark),
        "away_games": away_games(spark),
        "holidays": holidays(spark),
    }


def _order_measures() -> list[Column]:
    priority = F.substring("o_orderpriority", 1, 1)
    return [
        F.count(F.lit(1)).alias("order_count"),
        exact_sum(F.col("o_totalprice")).cast("double").alias("total_value"),
        F.count_if(priority.isin("1", "2")).alias("urgent_count"),
        F.count_if(priority == "3").alias("medium_count"),
        F.count_if(priority.isin("4", "5")).alias("low_count"),
    ]


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return orders.groupBy(F.col("o_orderdate").alias("day")).agg(*_order_measures())


def daily_by_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("nation"))
    orders = table(spark, sf_dir, "orders")
    joined = orders.join(customer, orders.o_custkey == customer.c_custkey)
    return joined.groupBy("nation", F.col("o_orderdate").alias("day")).agg(*_order_measures())


def daily_supervised(spark: SparkSession, sf_dir: str, daily: DataFrame | None = None) -> DataFrame:
    """``daily`` is the nations' days, if the caller has them written."""
    return supervised_frame(
        daily or daily_by_nation(spark, sf_dir),
        ["day"], DAILY_FEATURES, DAILY_LAGS, HORIZON, "order_count", keys=["nation"],
    )


def predictions(spark: SparkSession, sf_dir: str, daily: DataFrame | None = None) -> DataFrame:
    """Persistence forecast of every nation: the value now stands for the value six rows on."""
    frame = supervised_frame(
        daily or daily_by_nation(spark, sf_dir), ["day"], ["order_count"], {}, HORIZON, "order_count", ["nation"]
    )
    return frame.select(
        "nation",
        F.col("idx").alias("row_id"),
        F.col(f"future_{HORIZON}_order_count").cast("double").alias("y_true"),
        F.col("order_count").cast("double").alias("y_pred"),
    )


def event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "ts",
        "event_id",
        "user_id",
        "value",
        F.when(_kind("click"), 1).otherwise(0).alias("is_click"),
        F.when(_kind("purchase"), 1).otherwise(0).alias("is_purchase"),
        F.hour("ts").alias("hour"),
        F.weekday("ts").alias("day_of_week"),
    )


def event_supervised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw events as one long series: the load of the windows grows with the table."""
    return supervised_frame(
        event_rows(spark, sf_dir),
        ["ts", "event_id"], EVENT_FEATURES, EVENT_LAGS, EVENT_HORIZON, "value",
    )


def trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = F.col("l_returnflag")
    mae = F.when(F.col("l_quantity") >= 2, F.col("l_extendedprice") / 1000)
    target = F.when(F.col("l_partkey") % 2 == 0, "total_patient_count").otherwise("boarding_count")
    rows = table(spark, sf_dir, "lineitem").select(
        F.when(flag == "A", "RF").when(flag == "N", "GBT").otherwise("TSTPlus").alias("model"),
        target.alias("target"),
        F.col("l_linenumber").alias("horizon"),
        F.concat(F.lit("dataset"), (1 + F.col("l_suppkey") % 15).cast("string")).alias("dataset"),
        F.col("l_orderkey").alias("trial_num"),
        F.when(F.col("l_linestatus") == "O", "completed").otherwise("pruned").alias("status"),
        mae.alias("mae"),
        F.col("l_shipdate").alias("started"),
        "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_tax",
    )
    key = S.dataset_key(F.col("horizon"), F.col("target"), F.col("dataset"))
    known = S.network_run_id(F.col("model"), key, F.col("trial_num"), F.col("mae"))
    unknown = F.concat_ws("_", F.lit("reg"), F.col("model"), key, F.lit("unscored"))
    return rows.withColumns({"dataset_key": key, "run_id": F.coalesce(known, unknown)})

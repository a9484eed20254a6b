"""Explicit schemas of the inputs and of the tables the jobs write."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names of the seven hourly inputs.
HOUR = "hourly_range"
HOME_GAME_FLAG = "Alabama_Football_Game_Actual_Time"
AWAY_GAME_FLAG = "Auburn_Football_Game_Actual_Time"
HOLIDAY_FLAG = "Federal_Holiday"
CENSUS_RENAMES = {"UED Hospital Census": "UED_Hospital_Census", "DateTime": HOUR}
BOARDING_RENAMES = {"DateTime": HOUR}
ID_LIST_COLUMNS = ("patient_ids", "patient_visit_ids")


def _table(
    strings: tuple[str, ...] = (), doubles: tuple[str, ...] = (), ints: tuple[str, ...] = ()
) -> T.StructType:
    fields = []
    for kind, names in ((T.StringType(), strings), (T.DoubleType(), doubles), (T.IntegerType(), ints)):
        fields += [T.StructField(name, kind) for name in names]
    return T.StructType(fields)


def _timed(time_column: str, rest: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(time_column, T.TimestampNTZType()), *rest.fields])


PATIENTS = _timed(
    HOUR,
    _table(
        strings=("weather_main", "weather_description"),
        doubles=(
            "total_patient_count",
            "patient_count_ESI_1_2",
            "patient_count_ESI_3",
            "patient_count_ESI_4_5",
            "cumulative_total_average_waiting_time",
            "cumulative_average_waiting_ESI_1_2",
            "cumulative_average_waiting_ESI_3",
            "cumulative_average_waiting_ESI_4_5",
            "temp",
            "humidity",
            "wind_speed",
        ),
    ),
)
CENSUS = T.StructType(
    [
        T.StructField("DateTime", T.TimestampNTZType()),
        T.StructField("UED Hospital Census", T.DoubleType()),
    ]
)
TREATMENT = _timed(
    HOUR, _table(doubles=("treatment_count", "average_waiting_times_treatment_minute"))
)
BOARDING = _timed("DateTime", _table(doubles=("boarding_count", "average_boarding_times_minute")))
HOME_GAMES = _timed(HOUR, _table(ints=(HOME_GAME_FLAG,)))
AWAY_GAMES = _timed(HOUR, _table(ints=(AWAY_GAME_FLAG,)))
HOLIDAYS = _timed(HOUR, _table(ints=(HOLIDAY_FLAG,)))

INPUTS = {
    "patients": PATIENTS,
    "census": CENSUS,
    "treatment": TREATMENT,
    "boarding": BOARDING,
    "home_games": HOME_GAMES,
    "away_games": AWAY_GAMES,
    "holidays": HOLIDAYS,
}

JOB_CONFIG = T.StructType(
    [
        T.StructField("dataset_number", T.StringType()),
        T.StructField("features", T.ArrayType(T.StringType())),
        T.StructField("target_feature", T.StringType()),
        T.StructField("covid_deletion", T.BooleanType()),
        T.StructField("covid_filter_start", T.StringType()),
        T.StructField("covid_filter_end", T.StringType()),
        T.StructField("lag_features_config", T.MapType(T.StringType(), T.IntegerType())),
        T.StructField("lag_N", T.IntegerType()),
        T.StructField("future_hours", T.IntegerType()),
        T.StructField("window_size", T.IntegerType()),
        T.StructField("train_fraction", T.DoubleType()),
        T.StructField("validation_fraction", T.DoubleType()),
    ]
)

SCALER_PARAMS = T.StructType(
    [
        T.StructField("role", T.StringType()),
        T.StructField("column", T.StringType()),
        T.StructField("mean", T.DoubleType()),
        T.StructField("std", T.DoubleType()),
    ]
)

TRIALS = T.StructType(
    [
        T.StructField("search_id", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("model", T.StringType()),
        T.StructField("target", T.StringType()),
        T.StructField("horizon", T.IntegerType()),
        T.StructField("dataset", T.StringType()),
        T.StructField("trial_num", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("reason", T.StringType()),
        T.StructField("params", T.MapType(T.StringType(), T.StringType())),
        T.StructField("mae", T.DoubleType()),
        T.StructField("mse", T.DoubleType()),
        T.StructField("rmse", T.DoubleType()),
        T.StructField("r2", T.DoubleType()),
        T.StructField("runtime_minutes", T.DoubleType()),
    ]
)

MODELS = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("model", T.StringType()),
        T.StructField("target", T.StringType()),
        T.StructField("horizon", T.IntegerType()),
        T.StructField("dataset", T.StringType()),
        T.StructField("mae", T.DoubleType()),
        T.StructField("params", T.MapType(T.StringType(), T.StringType())),
        T.StructField("feature_order", T.ArrayType(T.StringType())),
        T.StructField("path", T.StringType()),
    ]
)

EVALUATIONS = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("split", T.StringType()),
        T.StructField("predictions_count", T.LongType()),
        T.StructField("test_set_size", T.LongType()),
        T.StructField("mae", T.DoubleType()),
        T.StructField("mse", T.DoubleType()),
        T.StructField("rmse", T.DoubleType()),
        T.StructField("r2", T.DoubleType()),
    ]
)

DATASET_INFO = T.StructType(
    [
        T.StructField("target", T.StringType()),
        T.StructField("horizon", T.IntegerType()),
        T.StructField("dataset", T.StringType()),
        T.StructField("generated_at", T.TimestampType()),
        T.StructField("sources", T.ArrayType(T.StringType())),
        T.StructField("excluded_from", T.StringType()),
        T.StructField("excluded_to", T.StringType()),
        T.StructField("lag_features_config", T.MapType(T.StringType(), T.IntegerType())),
        T.StructField("target_column", T.StringType()),
        T.StructField("total_samples", T.LongType()),
        T.StructField("train_rows", T.LongType()),
        T.StructField("val_rows", T.LongType()),
        T.StructField("test_rows", T.LongType()),
        T.StructField("train_fraction", T.DoubleType()),
        T.StructField("validation_fraction", T.DoubleType()),
        T.StructField("original_features", T.IntegerType()),
        T.StructField("lag_features", T.IntegerType()),
        T.StructField("feature_order", T.ArrayType(T.StringType())),
        T.StructField("scaled_features", T.ArrayType(T.StringType())),
        T.StructField("tensor_shape", T.ArrayType(T.IntegerType())),
        T.StructField("config_json", T.StringType()),
    ]
)

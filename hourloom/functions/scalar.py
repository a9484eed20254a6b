"""Row-wise column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# The category of every known weather label; all others are "Others".
WEATHER_GROUPS = {
    "Clouds": ("Clouds", "Mist"),
    "Rain": ("Rain", "Drizzle"),
    "Thunderstorm": ("Thunderstorm",),
    "Clear": ("Clear",),
}
OTHER_WEATHER = "Others"
WEATHER_TYPES = ("Clear", "Clouds", "Others", "Rain", "Thunderstorm")

# Patterns of the parts of run ids, folders and file names.
MAE_IN_NAME = r"mae[_]?(\d+\.?\d*)"
DATASET_IN_NAME = r"(dataset\d+)"
HORIZON_TARGET_IN_NAME = r"(\d+)hours_(.+?)_dataset\d+"
TEST_FILE_NAME = r"test_X_(.+)\.npy"


def strict_cast(col: Column, kind: str) -> Column:
    """Cast; a value that is present but unreadable raises whatever the ANSI setting is."""
    message = F.concat(F.lit(f"cannot read as {kind}: "), col.cast("string"))
    return F.coalesce(col.try_cast(kind), F.when(col.isNotNull(), F.raise_error(message)))


def nan_to_null(col: Column) -> Column:
    return F.when(~F.isnan(col), col)


def round_half_even(col: Column) -> Column:
    """Round to a whole number, ties to the even neighbour (0.5 -> 0, 2.5 -> 2, -0.5 -> 0)."""
    return F.rint(col) + F.lit(0.0)


def truncate_hour(ts: Column) -> Column:
    """Start of the hour of a zone-less timestamp, whatever the session zone is."""
    return F.make_timestamp_ntz(
        F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts), F.lit(0), F.lit(0)
    )


def calendar_parts(ts: Column) -> dict[str, Column]:
    """Calendar fields of a timestamp; Monday is day 0 of the week."""
    return {
        "year": F.year(ts),
        "month": F.month(ts),
        "day_of_month": F.dayofmonth(ts),
        "hour": F.hour(ts),
        "day_of_week": F.weekday(ts),
    }


def weather_category(label: Column) -> Column:
    """Coarse weather type; case-sensitive, unknown and missing labels become "Others"."""
    chain = F
    for category, labels in WEATHER_GROUPS.items():
        chain = chain.when(label.isin(*labels), category)
    return chain.otherwise(OTHER_WEATHER)


def one_hot(col: Column, values: Sequence[str], prefix: str) -> dict[str, Column]:
    """0/1 flags for a fixed list of values, in alphabetical order."""
    return {f"{prefix}_{v}": F.when(col == v, 1).otherwise(0) for v in sorted(values)}


def standardise(x: Column, mean: Column, std: Column) -> Column:
    return (x.cast("double") - mean) / std


def unstandardise(z: Column, mean: Column, std: Column) -> Column:
    return z * std + mean


def fixed4(x: Column) -> Column:
    """Four decimals as text, rounding the exact binary value (only 0.00005 itself goes down, not up)."""
    return F.call_function("format_number", x.cast("double"), F.lit("0.0000"))


def fixed4_or_na(x: Column) -> Column:
    return F.coalesce(fixed4(x), F.lit("N/A"))


def metric_in_name(name: Column) -> Column:
    """The metric a run id carries (``mae4.2947``, ``MAE_4.3311``), or null."""
    text = F.regexp_extract(F.lower(name), MAE_IN_NAME, 1)
    return F.nullif(text, F.lit("")).cast("double")


def dataset_in_name(name: Column) -> Column:
    return F.nullif(F.regexp_extract(name, DATASET_IN_NAME, 1), F.lit(""))


def horizon_in_name(name: Column) -> Column:
    return F.nullif(F.regexp_extract(name, HORIZON_TARGET_IN_NAME, 1), F.lit("")).cast("int")


def target_in_name(name: Column) -> Column:
    return F.nullif(F.regexp_extract(name, HORIZON_TARGET_IN_NAME, 2), F.lit(""))


def dataset_in_test_file(name: Column) -> Column:
    found = F.nullif(F.regexp_extract(name, TEST_FILE_NAME, 1), F.lit(""))
    return F.coalesce(found, F.lit("unknown"))


def horizon_folder(horizon: Column, target: Column) -> Column:
    return F.concat(horizon.cast("string"), F.lit("hours_"), target)


def dataset_key(horizon: Column, target: Column, dataset: Column) -> Column:
    """``<H>hours_<target>_<dataset>``"""
    return F.concat_ws("_", horizon_folder(horizon, target), dataset)


def network_run_id(
    model: Column, key: Column, trial: Column, mae: Column
) -> Column:
    """Id of a searched network: ``reg_<model>_<dataset key>_trial<n>_mae<4 decimals>``."""
    return F.concat(
        F.concat_ws("_", F.lit("reg"), model, key),
        F.lit("_trial"), trial.cast("string"),
        F.lit("_mae"), fixed4(mae),
    )


def grid_run_id(
    stamp: Column, mae: Column, family: str, parts: Sequence[tuple[str, Column]], dataset: Column,
    value_first: bool = False,
) -> Column:
    """Id of a grid run: time, metric with ``_`` for ``.``, family, the parameters, the dataset.

    Parameters read ``<name>_<value>``, or ``<value>_<name>`` with ``value_first``.
    """
    pairs = []
    for name, value in parts:
        pair = [F.lit(name), value.cast("string")]
        pairs += pair[::-1] if value_first else pair
    return F.concat_ws(
        "_",
        F.date_format(stamp, "yyyyMMdd_HHmmss"),
        F.translate(fixed4(mae), ".", "_"),
        F.lit(family),
        *pairs,
        dataset,
    )


def minutes_between(start: Column, end: Column) -> Column:
    """Length of a run in minutes; zone-less times are subtracted as they are, without any clock change."""
    span = end - start
    parts = (("DAY", 1_440.0), ("HOUR", 60.0), ("MINUTE", 1.0))
    whole = sum((F.extract(F.lit(unit), span) * F.lit(minutes) for unit, minutes in parts), F.lit(0.0))
    return whole + F.extract(F.lit("SECOND"), span).cast("double") / 60


def map_total(m: Column) -> Column:
    """Sum of the values of a ``map<string,int>``."""
    return F.aggregate(F.map_values(m), F.lit(0).cast("long"), lambda acc, v: acc + v)


def array_mean(values: Column) -> Column:
    """Mean of an array column, summed left to right in double precision."""
    total = F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v.cast("double"))
    return F.when(F.size(values) > 0, total / F.size(values))


def not_finite(x: Column) -> Column:
    """True for NaN and both infinities."""
    inf = F.lit(float("inf"))
    return F.isnan(x) | (x == inf) | (x == -inf)

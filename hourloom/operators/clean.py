"""Column clean-up, filters and input guards."""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F, types as T

from hourloom.functions.scalar import not_finite, round_half_even, strict_cast

NUMERIC = (T.DoubleType, T.FloatType)


def time_literal(text: str) -> Column:
    """A zone-less timestamp; a date alone means its midnight."""
    moment = datetime.fromisoformat(text)
    if moment.tzinfo is not None:
        raise ValueError(f"times carry no zone here: {text}")
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def parse_time(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, strict_cast(F.col(column), "timestamp_ntz"))


def drop_if_present(df: DataFrame, *columns: str) -> DataFrame:
    return df.drop(*columns)


def round_numbers(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Round floating columns half to even and keep their types; whole numbers stay as they are."""
    wanted = set(df.columns if columns is None else columns)
    rounded = {
        f.name: round_half_even(F.col(f"`{f.name}`")).cast(f.dataType)
        for f in df.schema.fields
        if f.name in wanted and isinstance(f.dataType, NUMERIC)
    }
    return df.withColumns(rounded) if rounded else df


def filter_range(df: DataFrame, column: str, start: str, end: str) -> DataFrame:
    """Keep rows inside the closed range; rows without a time fall out."""
    return df.where(F.col(column).between(time_literal(start), time_literal(end)))


def exclude_window(df: DataFrame, column: str, start: str, end: str) -> DataFrame:
    """Remove rows inside the closed range; a date as upper bound removes its midnight only."""
    inside = F.col(column).between(time_literal(start), time_literal(end))
    return df.where(~F.coalesce(inside, F.lit(False)))


def select_ordered(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df.select(*columns)


def fill_flag(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.coalesce(F.col(column), F.lit(0)).cast("int"))


def known_features(df: DataFrame, lags: Mapping[str, int]) -> dict[str, int]:
    """The lag requests whose column exists; others are skipped with a warning."""
    for name in lags:
        if name not in df.columns:
            warnings.warn(f"no lags of '{name}': the table has no such column", stacklevel=2)
    return {name: n for name, n in lags.items() if name in df.columns}


def assert_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Fail if a key occurs twice; only an example leaves the cluster."""
    twice = df.groupBy(*keys).count().where(F.col("count") > 1).take(1)
    if twice:
        raise ValueError(f"duplicate key: {twice[0].asDict()}")
    return df


def assert_whole_hours(df: DataFrame, column: str) -> DataFrame:
    """Fail if a time lies between two hours; only an example leaves the cluster."""
    off = df.where(F.col(column) != F.date_trunc("hour", F.col(column))).select(column).take(1)
    if off:
        raise ValueError(f"not a whole hour: {off[0][0]}")
    return df


def finite_report(
    df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()
) -> DataFrame:
    """NaN, infinite and missing counts of each column in one pass, one row per column and group."""
    inf = F.lit(float("inf"))
    counts = []
    for c in columns:
        x = F.col(c).cast("double")
        counts.append(
            F.struct(
                F.lit(c).alias("column"),
                F.count_if(F.isnan(x)).alias("nan_count"),
                F.count_if((x == inf) | (x == -inf)).alias("inf_count"),
                F.count_if(x.isNull()).alias("null_count"),
            )
        )
    return df.groupBy(*by).agg(F.array(*counts).alias("report")).select(*by, F.inline("report"))


def guard_finite(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Raise while rows flow if a value is NaN or infinite."""
    checked = {}
    for c in columns:
        x = F.col(c)
        bad = F.raise_error(F.concat(F.lit(f"not finite: {c} = "), x.cast("string")))
        checked[c] = F.when(not_finite(x.cast("double")), bad).otherwise(x)
    return df.withColumns(checked)


def conform_features(df: DataFrame, feature_order: Sequence[str], carry: Sequence[str] = ()) -> DataFrame:
    """Check a scoring table against the recorded features and put them in their order.

    A wrong number of feature columns or an unknown name is an error; a wrong order only warns.
    """
    given = [c for c in df.columns if c not in carry]
    if len(given) != len(feature_order):
        raise ValueError(f"{len(given)} features given, {len(feature_order)} expected")
    if given != list(feature_order):
        warnings.warn("features are not in the recorded order", stacklevel=2)
    return select_ordered(df, [*carry, *feature_order])

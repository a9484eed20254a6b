"""Joins on the hour, calendar flags, categories and the extreme flag."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from hourloom.functions.aggregates import extreme_threshold
from hourloom.functions.scalar import WEATHER_TYPES, calendar_parts, one_hot, weather_category
from hourloom.operators.clean import fill_flag
from hourloom.operators.lookup import join_same, lookup


def merge_hourly(
    tables: Sequence[DataFrame],
    on: Sequence[str],
    suffixes: Sequence[str] | None = None,
) -> DataFrame:
    """Inner-join hourly tables on ``on``; repeated keys multiply.

    Equal names outside the key are an error unless ``suffixes`` gives one per table.
    """
    named = [
        t if suffixes is None else _suffix_shared(t, suffix, tables, on)
        for t, suffix in zip(tables, suffixes or [""] * len(tables), strict=True)
    ]
    seen: set[str] = set()
    for t in named:
        rest = set(t.columns) - set(on)
        if rest & seen:
            raise ValueError(f"columns occur in several tables: {sorted(rest & seen)}")
        seen |= rest
    return reduce(lambda left, right: left.join(right, list(on), "inner"), named)


def _suffix_shared(
    table: DataFrame, suffix: str, tables: Sequence[DataFrame], on: Sequence[str]
) -> DataFrame:
    others = [c for t in tables if t is not table for c in t.columns]
    shared = set(table.columns) & set(others) - set(on)
    return table.withColumnsRenamed({c: c + suffix for c in shared})


def flag_hours(df: DataFrame, calendar: DataFrame, hour: str, flag: str) -> DataFrame:
    """Left-join an event calendar on the exact hour; hours outside it get 0.

    No broadcast hint: the optimizer broadcasts the calendar while its scan is
    below the session's threshold and shuffles it beyond.
    """
    return fill_flag(df.join(calendar.select(hour, flag), hour, "left"), flag)


def flag_dates(df: DataFrame, calendar: DataFrame, hour: str, flag: str) -> DataFrame:
    """Left-join a date calendar; every hour of a listed date gets the flag."""
    days = calendar.select(F.to_date(hour).alias("_date"), flag)
    joined = df.withColumn("_date", F.to_date(hour)).join(days, "_date", "left")
    return fill_flag(joined, flag).drop("_date")


def add_calendar(df: DataFrame, hour: str) -> DataFrame:
    return df.withColumns(calendar_parts(F.col(hour)))


def add_weather(
    df: DataFrame, label: str = "weather_main", values: Sequence[str] = WEATHER_TYPES
) -> DataFrame:
    """Replace the raw label by ``weather_type`` and its 0/1 flags."""
    typed = df.withColumn(label, weather_category(F.col(label))).withColumnRenamed(label, "weather_type")
    return typed.withColumns(one_hot(F.col("weather_type"), values, "weather"))


def add_extreme_flag(
    df: DataFrame,
    column: str,
    by: Sequence[str] = (),
    fit_on: DataFrame | None = None,
    flag: str = "extreme_indicator",
) -> DataFrame:
    """1 where ``column`` is at least its mean plus one sample deviation, else 0.

    The threshold comes from all rows, or from ``fit_on`` (such as the train
    rows alone). Missing values get 0.
    """
    source = df if fit_on is None else fit_on
    limit = extreme_threshold(F.col(column)).alias("_limit")
    if by:
        with_limit = lookup(df, source.groupBy(*by).agg(limit), by)
    else:
        with_limit = df.withColumn("_limit", source.agg(limit).scalar())
    hit = F.col(column) >= F.col("_limit")
    return with_limit.withColumn(flag, F.when(hit, 1).otherwise(0)).drop("_limit")


def regular_grid(df: DataFrame, hour: str, keys: Sequence[str] = ()) -> DataFrame:
    """Add a row without values for every hour missing between a series' first and last one.

    The grid runs in whole hours from the first time of each series. A row that
    is not on its series' grid is an error: it could neither be kept in step nor
    left out. The hours are laid out in stretches of a day, spread over the
    cluster, so that one long series is not produced by one task.
    """
    into = F.col(hour) - F.date_trunc("hour", F.col(hour))
    span = df.groupBy(*keys).agg(
        F.min(hour).alias("_lo"), F.max(hour).alias("_hi"), F.min(into).alias("_from"), F.max(into).alias("_to")
    )
    off = F.raise_error(F.concat(F.lit("rows off the hourly grid that starts at "), F.col("_lo").cast("string")))
    span = span.withColumn("_lo", F.when(F.col("_from") == F.col("_to"), F.col("_lo")).otherwise(off))
    day, step = F.expr("INTERVAL 24 HOURS"), F.expr("INTERVAL 1 HOUR")
    begins = span.withColumn("_begin", F.explode(F.sequence("_lo", "_hi", day)))
    hours = F.sequence("_begin", F.least("_hi", F.col("_begin") + F.expr("INTERVAL 23 HOURS")), step)
    grid = begins.repartition(*keys, "_begin").select(*keys, F.explode(hours).alias(hour))
    return join_same(grid, df, [*keys, hour], "left")

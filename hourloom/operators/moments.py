"""Moments of columns by month, from which scaling parameters of any range of months are fitted.

A month's moments are made from its own rows alone and logged; a month that is
logged again replaces itself. Moments of months merge without the rows: counts,
means and squared deviations by the rule for two groups, bounds by their
extremes, and a value between the bounds is one of the months' bounds or inner
values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from hourloom.operators.lookup import join_same
from hourloom.operators.scaling import FEATURE, TARGET
from hourloom.session import materialise
from hourloom.sources.logs import Log

MONTH = "month"

STORED = [
    T.StructField("column", T.StringType()),
    T.StructField("rows", T.LongType()),
    T.StructField("n", T.LongType()),
    T.StructField("mean", T.DoubleType()),
    T.StructField("m2", T.DoubleType()),
    T.StructField("lo", T.DoubleType()),
    T.StructField("hi", T.DoubleType()),
    T.StructField("inner", T.DoubleType()),
]


def moments_log(path: str, by: Sequence[T.StructField] = ()) -> Log:
    """Moments by series, month and column."""
    schema = T.StructType([*by, T.StructField(MONTH, T.DateType()), *STORED])
    return Log(path, schema, (*[f.name for f in by], MONTH, "column"))


def month_moments(df: DataFrame, columns: Sequence[str], time: str, by: Sequence[str] = ()) -> DataFrame:
    """One row a series, month and column: counts, mean, squared deviations, bounds and a value between them.

    Missing values count in ``rows`` alone. The rows are read twice: the second
    time looks between the bounds that the first one found.
    """
    values = F.array(*[F.col(f"`{c}`").cast("double") for c in columns])
    month = F.trunc(F.col(time).cast("date"), "month").alias(MONTH)
    wide = df.select(*by, month, F.posexplode(values).alias("position", "x"))
    place = [*by, MONTH, "position"]
    stats = materialise(
        wide.groupBy(*place).agg(
            F.count(F.lit(1)).alias("rows"),
            F.count("x").alias("n"),
            F.avg("x").alias("mean"),
            (F.var_pop("x") * F.count("x")).alias("m2"),
            F.min("x").alias("lo"),
            F.max("x").alias("hi"),
        )
    )
    bounded = join_same(wide, stats.select(*place, "lo", "hi"), place, "inner")
    inner = bounded.where((F.col("x") > F.col("lo")) & (F.col("x") < F.col("hi"))).groupBy(*place).agg(F.min("x").alias("inner"))
    name = F.get(F.array(*[F.lit(c) for c in columns]), F.col("position")).alias("column")
    return join_same(stats, inner, place, "left").select(*by, MONTH, name, "rows", "n", "mean", "m2", "lo", "hi", "inner")


def _merged(months: str) -> Column:
    """Counts, mean and squared deviations of an array of months, two groups at a time."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))

    def add(acc: Column, month: Column) -> Column:
        n = acc["n"] + month["n"]
        apart = month["mean"] - acc["mean"]
        mean = acc["mean"] + apart * month["n"] / n
        m2 = acc["m2"] + month["m2"] + apart * apart * acc["n"] * month["n"] / n
        return F.struct(n.alias("n"), mean.alias("mean"), m2.alias("m2"))

    return F.aggregate(F.filter(months, lambda m: m["n"] > 0), start, add)


def merge_moments(moments: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``mean``, ``std``, ``lo``, ``hi`` and ``non_binary`` of each column over the months given.

    A group holds a row a month: a few hundred, whatever the rows behind them.
    Months are merged in their order, so that a repeated fit gives the same bits.
    """
    months = F.sort_array(F.collect_list(F.struct(MONTH, "n", "mean", "m2", "lo", "hi", "inner"))).alias("months")
    grouped = moments.groupBy(*by, "column").agg(
        months, F.min("lo").alias("lo"), F.max("hi").alias("hi"), (F.sum("rows") - F.sum("n")).alias("nulls")
    )
    merged = grouped.withColumn("all", _merged("months"))

    def between(x: Column) -> Column:
        return F.coalesce((x > F.col("lo")) & (x < F.col("hi")), F.lit(False))

    inside = F.exists("months", lambda m: between(m["lo"]) | between(m["hi"]) | m["inner"].isNotNull())
    two_and_null = (F.col("lo") < F.col("hi")) & (F.col("nulls") > 0)
    some = F.col("all.n") > 0
    return merged.select(
        *by, "column", F.when(some, F.col("all.mean")).alias("mean"),
        F.when(some, F.sqrt(F.col("all.m2") / F.col("all.n"))).alias("std"), "lo", "hi",
        F.coalesce(inside | two_and_null, F.lit(False)).alias("non_binary"),
    )


def fit_from_moments(moments: DataFrame, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Scaling parameters as ``fit_scaler`` gives them, without reading a row of data."""
    profile = merge_moments(moments, by)
    is_label = F.col("column") == label
    return profile.where(is_label | F.col("non_binary")).select(
        *by, F.when(is_label, TARGET).otherwise(FEATURE).alias("role"), "column", "mean",
        F.when(F.col("lo") == F.col("hi"), 1.0).otherwise(F.col("std")).alias("std"),
    )

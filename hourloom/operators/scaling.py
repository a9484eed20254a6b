"""Standardisation with parameters kept as a table (population deviation, scale 1 for constants)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from hourloom.functions.scalar import standardise, unstandardise
from hourloom.operators.lookup import join_same, lookup
from hourloom.session import materialise

FEATURE = "feature"
TARGET = "target"


def _values(columns: Sequence[str]) -> list[Column]:
    return [F.col(f"`{c}`").cast("double") for c in columns]


def _attach(
    df: DataFrame, params: DataFrame, by: Sequence[str], column: str, width: int
) -> DataFrame:
    """Add an array column of a small table: per series, or its only row."""
    if by:
        return lookup(df, params.select(*by, column), by, width=width)
    return df.withColumn(column, params.select(column).scalar())


def column_profile(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Mean, population deviation, bounds and value-count test of each column.

    ``non_binary`` is true when a column has more than two distinct values, null
    counting as one. Two passes decide it exactly and without a distinct
    shuffle: the first finds the bounds, the second looks for a value between
    them. The columns are turned into rows, so a wide table needs five
    aggregates in all rather than five per column; they combine before the shuffle.
    """
    stats = materialise(
        df.select(*by, F.posexplode(F.array(*_values(columns))).alias("position", "x"))
        .groupBy(*by, "position")
        .agg(
            F.avg("x").alias("mean"),
            F.stddev_pop("x").alias("std"),
            F.min("x").alias("lo"),
            F.max("x").alias("hi"),
            F.count_if(F.col("x").isNull()).alias("nulls"),
        )
    )
    # One array per series, as long as the list of columns.
    bounds = stats.groupBy(*by).agg(
        F.array_sort(F.collect_list(F.struct("position", "lo", "hi"))).alias("_bounds")
    )
    inside = []
    for i, x in enumerate(_values(columns)):
        bound = F.get("_bounds", F.lit(i))
        inside.append((x > bound["lo"]) & (x < bound["hi"]))
    between = (
        _attach(df, bounds, by, "_bounds", 3 * len(columns))
        .select(*by, F.posexplode(F.array(*inside)).alias("position", "inside"))
        .groupBy(*by, "position")
        .agg(F.bool_or("inside").alias("inside"))
    )
    two_and_null = (F.col("lo") < F.col("hi")) & (F.col("nulls") > 0)
    return join_same(stats, between, [*by, "position"], "inner").select(
        *by,
        F.get(F.array(*[F.lit(c) for c in columns]), F.col("position")).alias("column"),
        "mean",
        "std",
        "lo",
        "hi",
        F.coalesce(F.col("inside") | two_and_null, F.lit(False)).alias("non_binary"),
    )


def fit_scaler(
    train: DataFrame, features: Sequence[str], label: str, by: Sequence[str] = ()
) -> DataFrame:
    """Parameters of the non-binary features and of the label, one row each.

    ``train`` is read twice: pass a written table, not a long lazy plan. Write the
    result too before scaling with it.
    """
    profile = column_profile(train, [*features, label], by)
    is_label = F.col("column") == label
    return profile.where(is_label | F.col("non_binary")).select(
        *by,
        F.when(is_label, TARGET).otherwise(FEATURE).alias("role"),
        "column",
        "mean",
        F.when(F.col("lo") == F.col("hi"), 1.0).otherwise(F.col("std")).alias("std"),
    )


def _with_params(
    df: DataFrame, params: DataFrame, columns: Sequence[str], by: Sequence[str]
) -> DataFrame:
    """Add ``_p``, the (mean, std) of each column in the order of ``columns``, null where unscaled."""
    entry = F.struct("column", F.struct("mean", "std"))
    wanted = params.where(F.col("column").isin(*columns)).groupBy(*by)
    named = wanted.agg(F.map_from_entries(F.collect_list(entry)).alias("_named"))
    names = F.array(*[F.lit(c) for c in columns])
    ordered = F.transform(names, lambda c: F.try_element_at("_named", c))
    return _attach(df, named.select(*by, ordered.alias("_p")), by, "_p", 2 * len(columns))


def scale(
    df: DataFrame,
    params: DataFrame,
    columns: Sequence[str],
    by: Sequence[str] = (),
    suffix: str = "_scaled",
) -> DataFrame:
    """Add ``<column><suffix>``; columns without parameters pass through as double.

    Scale features and label in one call: each call attaches the parameters once.
    """
    joined = _with_params(df, params, columns, by)
    scaled = {}
    for i, (c, x) in enumerate(zip(columns, _values(columns), strict=True)):
        p = F.get("_p", F.lit(i))
        scaled[c + suffix] = F.when(p.isNotNull(), standardise(x, p["mean"], p["std"])).otherwise(x)
    return joined.withColumns(scaled).drop("_p")


def unscale(
    df: DataFrame,
    params: DataFrame,
    column: str,
    into: dict[str, str],
    by: Sequence[str] = (),
) -> DataFrame:
    """Undo the scaling of ``column`` for every ``source -> result`` pair; without parameters values stay."""
    joined = _with_params(df, params, [column], by)
    p = F.get("_p", F.lit(0))
    restored = {}
    for source, result in into.items():
        z = F.col(f"`{source}`").cast("double")
        restored[result] = F.when(p.isNotNull(), unstandardise(z, p["mean"], p["std"])).otherwise(z)
    return joined.withColumns(restored).drop("_p")


def feature_arrays(
    df: DataFrame, features: Sequence[str], label: str, carry: Sequence[str] = ()
) -> DataFrame:
    """Float32 arrays ``x`` (features in their order) and ``y`` (the label), ready for export."""
    return df.select(
        *carry,
        F.array(*[F.col(f"`{c}`").cast("float") for c in features]).alias("x"),
        F.array(F.col(f"`{label}`").cast("float")).alias("y"),
    )

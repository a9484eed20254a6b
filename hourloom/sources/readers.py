"""Scans. Floating NaN becomes NULL here, so NULL is the only missing value downstream."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from hourloom.functions.scalar import nan_to_null, strict_cast

FLOATING = (T.DoubleType, T.FloatType)


def nulls_for_nans(df: DataFrame) -> DataFrame:
    columns = {
        f.name: nan_to_null(F.col(f"`{f.name}`"))
        for f in df.schema.fields
        if isinstance(f.dataType, FLOATING)
    }
    return df.withColumns(columns) if columns else df


def _conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return nulls_for_nans(
        df.select(
            *[strict_cast(F.col(f"`{f.name}`"), f.dataType.simpleString()).alias(f.name) for f in schema.fields]
        )
    )


def read_delimited(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read a CSV with a header by column name.

    Columns outside the schema, such as an unnamed index, are not parsed. A
    missing column or an unreadable value fails the load.
    """
    return _conform(spark.read.option("header", True).csv(path), schema)


def read_columnar(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return _conform(spark.read.parquet(path), schema)


READERS = {"csv": read_delimited, "parquet": read_columnar}


def read_inputs(
    spark: SparkSession,
    paths: Mapping[str, str],
    schemas: Mapping[str, T.StructType],
    formats: str | Mapping[str, str] = "csv",
) -> dict[str, DataFrame]:
    """All inputs or none: every path is resolved before any is used.

    ``formats`` is ``csv`` or ``parquet``, for all inputs or by name; a path may be a file or a folder.
    """
    absent = sorted(set(schemas) - set(paths))
    if absent:
        raise ValueError(f"no path for inputs: {absent}")
    chosen = {name: formats if isinstance(formats, str) else formats[name] for name in schemas}
    unknown = sorted(set(chosen.values()) - set(READERS))
    if unknown:
        raise ValueError(f"unknown formats: {unknown}")
    return {name: READERS[chosen[name]](spark, paths[name], schema) for name, schema in schemas.items()}


def train_and_validation(df: DataFrame) -> DataFrame:
    """Train followed by validation, told apart by ``split`` and ordered by ``idx``."""
    return df.where(F.col("split").isin("train", "val"))

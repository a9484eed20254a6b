"""Chronological split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def chronological_split(
    df: DataFrame, train_fraction: float = 0.7, validation_fraction: float = 0.15
) -> DataFrame:
    """Name the split of every row from its position ``idx`` among ``series_rows``.

    Sizes are truncated products in double precision; the rest is the test set.
    """
    rows = F.col("series_rows").cast("double")
    train_end = F.floor(rows * F.lit(train_fraction))
    val_end = train_end + F.floor(rows * F.lit(validation_fraction))
    name = F.when(F.col("idx") < train_end, "train").when(F.col("idx") < val_end, "val")
    return df.withColumn("split", name.otherwise("test"))


def split_counts(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by, "split").agg(F.count(F.lit(1)).alias("rows"))

"""Dictionaries of categories: fitted on one table, stored, and applied to others."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from hourloom.operators.lookup import lookup

#: Categories that become a column each at most; a larger dictionary is applied by position.
MOST_COLUMNS = 1_000


def fit_categories(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, category, frequency, position): every value of each column as text, in alphabetical order.

    Values are counted before they are shuffled; missing ones are no category.
    Positions count from 0 in each column, over its distinct values only.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("category")) for c in columns])
    values = df.select(F.explode(pairs).alias("v")).select("v.*").where("category IS NOT NULL")
    counts = values.groupBy("column", "category").agg(F.count(F.lit(1)).alias("frequency"))
    place = F.row_number().over(Window.partitionBy("column").orderBy("category"))
    return counts.withColumn("position", place - 1)


def with_position(df: DataFrame, column: str, dictionary: DataFrame, fitted: str | None = None) -> DataFrame:
    """Add ``<column>_position``, null for missing and unseen values, and ``<column>_unseen`` (0 or 1).

    ``fitted`` is the name under which the column was fitted, its own unless
    given. A dictionary of any size: it is looked up, not laid out in columns.
    """
    own = dictionary.where(F.col("column") == (fitted or column))
    own = own.select(F.col("category").alias("_category"), F.col("position").alias(f"{column}_position"))
    placed = lookup(df.withColumn("_category", F.col(f"`{column}`").cast("string")), own, ["_category"]).drop("_category")
    unseen = F.col(f"`{column}`").isNotNull() & F.col(f"`{column}_position`").isNull()
    return placed.withColumn(f"{column}_unseen", unseen.cast("int"))


def fitted_values(dictionary: DataFrame, column: str, most: int = MOST_COLUMNS) -> list[str]:
    """The categories of a column in their order; more than ``most`` are refused."""
    own = dictionary.where(F.col("column") == column).orderBy("position").select("category").take(most + 1)
    if len(own) > most:
        raise ValueError(f"'{column}' has more than {most} categories; use their positions")
    return [r["category"] for r in own]


def one_hot_fitted(
    df: DataFrame, column: str, dictionary: DataFrame, prefix: str | None = None, fitted: str | None = None, most: int = MOST_COLUMNS
) -> DataFrame:
    """Add a 0/1 column ``<prefix>_<category>`` for each fitted category, and ``<prefix>_unseen``.

    The columns are those of the dictionary, whatever the table holds: all are 0
    for a missing value, and only ``<prefix>_unseen`` is 1 for a value that was not
    there when the dictionary was fitted.
    """
    prefix, text = prefix or column, F.col(f"`{column}`").cast("string")
    values = fitted_values(dictionary, fitted or column, most)
    flags = {f"{prefix}_{v}": F.coalesce(text == v, F.lit(False)).cast("int") for v in values}
    # One lookup in a literal map instead of a comparison with every value.
    known = F.lit(False) if not values else F.map_contains_key(F.create_map(*[F.lit(x) for v in values for x in (v, 1)]), F.coalesce(text, F.lit("")))
    unseen = text.isNotNull() & ~known
    if f"{prefix}_unseen" in flags:
        raise ValueError(f"a category of '{column}' is named 'unseen'")
    return df.withColumns({**flags, f"{prefix}_unseen": unseen.cast("int")})

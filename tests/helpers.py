from __future__ import annotations

from pyspark.sql import functions as F


def rows(df, *order):
    """Rows as tuples, sorted by ``order``."""
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def one(spark, **columns):
    """A one-row frame of literal columns."""
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in columns.items()])


def value(spark, column):
    """The value of a column expression over no table."""
    return spark.range(1).select(column.alias("v")).first()["v"]


def hours(spark, pairs, schema):
    """A frame whose first column holds zone-less hours given as text."""
    names = schema.split(", ")
    first = names[0].split()[0]
    raw = spark.createDataFrame(pairs, ", ".join([f"{first} string", *names[1:]]))
    return raw.withColumn(first, F.col(first).cast("timestamp_ntz"))

"""Hourly tables stored by their join key, so that joins read them where they lie.

A bucketed table is written once, one sorted file a bucket. Joins of tables with
the same key and number of buckets need no exchange: each task reads the files
of one bucket. Time is part of the key, so a long series is spread like any other.

The files lie in a folder of their own; a session learns of them when it attaches
the folder as a table of its catalogue, from the layout stored beside the files.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, types as T

#: Buckets of a table unless the job says otherwise.
BUCKETS = 64

LAYOUT = T.StructType(
    [T.StructField("ddl", T.StringType()), T.StructField("key", T.ArrayType(T.StringType())), T.StructField("buckets", T.IntegerType())]
)


def _name(path: str) -> str:
    return f"bucketed_{hashlib.sha256(path.encode()).hexdigest()[:20]}"


def write_bucketed(df: DataFrame, path: str, key: Sequence[str], buckets: int = BUCKETS) -> None:
    """Write ``df`` by ``key`` into a new folder; the layout comes last, and without it there is no table."""
    spark, name = df.sparkSession, _name(path)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    dealt = df.repartition(buckets, *key).write.format("parquet").bucketBy(buckets, *key).sortBy(*key)
    dealt.option("path", f"{path}/rows").saveAsTable(name)
    layout = spark.createDataFrame([(df.schema.simpleString(), list(key), buckets)], LAYOUT)
    layout.coalesce(1).write.parquet(f"{path}/layout")


def read_bucketed(spark: SparkSession, path: str) -> DataFrame:
    """The table, known by its buckets; attached if this session has not seen it."""
    name = _name(path)
    if not spark.catalog.tableExists(name):
        ddl, key, buckets = spark.read.schema(LAYOUT).parquet(f"{path}/layout").first()
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in T.StructType.fromDDL(ddl.removeprefix("struct<").removesuffix(">")))
        by = ", ".join(f"`{k}`" for k in key)
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS "
            f"LOCATION '{path}/rows'"
        )
    return spark.table(name)


def bucket_tables(tables: Mapping[str, DataFrame], path: str, key: Sequence[str], buckets: int = BUCKETS) -> None:
    """Write every table under ``path`` by the same key."""
    for name, df in tables.items():
        write_bucketed(df, f"{path}/{name}", key, buckets)


def bucketed_tables(spark: SparkSession, path: str, names: Sequence[str]) -> dict[str, DataFrame]:
    return {name: read_bucketed(spark, f"{path}/{name}") for name in names}

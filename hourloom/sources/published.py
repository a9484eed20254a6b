"""Published tables: several tables under one key that change together.

Every write goes to folders of a version of its own and touches nothing that is
there. The version counts from the moment its row is in the manifest, which is
written last. A job that dies half-way leaves the former version as it was;
readers see all tables of one version or of the other, never a mixture.

    <root>/<table>/<key=value>/.../version=<id>    a table of one version
    a manifest beside them                         a log: key, version, description

Versions that a later one has replaced stay until ``retire`` deletes them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Row, SparkSession, functions as F, types as T

from hourloom.session import delete_tables, list_names
from hourloom.sources.logs import Log, new_id

VERSION = "version"


def manifest(path: str, key: Sequence[T.StructField], described: T.StructType = T.StructType()) -> Log:
    """The log of published versions: the key's columns, the version, its tables and a description."""
    own = [T.StructField(VERSION, T.StringType()), T.StructField("tables", T.ArrayType(T.StringType()))]
    names = {f.name for f in key}
    rest = [f for f in described.fields if f.name not in names]
    return Log(path, T.StructType([*key, *own, *rest]), (*[f.name for f in key], VERSION))


def _key_folder(spark: SparkSession, key: Mapping[str, object]) -> str:
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    return "/".join(f"{escape(name)}={escape(str(value))}" for name, value in key.items())


@dataclass
class Release:
    """One version of the tables under ``key``, while it is written and when it is read."""

    spark: SparkSession
    root: str
    key: Mapping[str, object]
    version: str = field(default_factory=new_id)
    tables: list[str] = field(default_factory=list)

    def path(self, table: str) -> str:
        return f"{self.root}/{table}/{_key_folder(self.spark, self.key)}/{VERSION}={self.version}"

    def write(self, df: DataFrame, table: str, partition_by: Sequence[str] = ()) -> DataFrame:
        """Write a table of this version and read it back."""
        df.drop(*self.key, VERSION).write.partitionBy(*partition_by).parquet(self.path(table))
        self.tables.append(table)
        return self.read(table)

    def read(self, table: str) -> DataFrame:
        """A table of this version; of a partitioned one, a filter on the partition opens only its folders."""
        return self.spark.read.parquet(self.path(table))

    def commit(self, log: Log, description: DataFrame | None = None) -> None:
        """Publish: one row in the manifest, behind all tables."""
        row = self.spark.range(1).drop("id") if description is None else description
        names = F.array(*[F.lit(t) for t in self.tables]).cast("array<string>")
        own = {**{k: F.lit(v) for k, v in self.key.items()}, VERSION: F.lit(self.version), "tables": names}
        log.append(row.withColumns(own))


def versions(spark: SparkSession, log: Log, key: Mapping[str, object]) -> DataFrame:
    """The published versions of a key."""
    rows = log.read(spark)
    for name, value in key.items():
        rows = rows.where(F.col(name).eqNullSafe(F.lit(value)))
    return rows


def published(spark: SparkSession, root: str, log: Log, key: Mapping[str, object]) -> tuple[Release, Row] | None:
    """The latest published version of a key with its row of the manifest; none if there is none."""
    last = versions(spark, log, key).orderBy(F.desc(VERSION)).take(1)
    if not last:
        return None
    return Release(spark, root, key, last[0][VERSION], list(last[0]["tables"])), last[0]


def published_rows(spark: SparkSession, root: str, log: Log, table: str) -> DataFrame:
    """A table of the latest versions of all keys, with the key's columns."""
    keys = [c for c in log.identity if c != VERSION]
    last = log.read(spark).groupBy(*keys).agg(F.max(VERSION).alias(VERSION))
    return spark.read.parquet(f"{root}/{table}").join(last, [*keys, VERSION], "left_semi").drop(VERSION)


def retire(spark: SparkSession, root: str, log: Log, key: Mapping[str, object], keep: int = 2) -> list[str]:
    """Delete what is older than the ``keep`` latest published versions of a key, also writes that were never published.

    A write that is younger than the oldest version kept stays: it may be under
    way. Returns the versions that went.
    """
    if keep < 1:
        raise ValueError("at least one version stays")
    last = [r[VERSION] for r in versions(spark, log, key).orderBy(F.desc(VERSION)).limit(keep).select(VERSION).collect()]
    if len(last) < keep:
        return []
    gone: set[str] = set()
    for table in list_names(spark, root):
        folder = f"{root}/{table}/{_key_folder(spark, key)}"
        old = [n for n in list_names(spark, folder) if n.startswith(f"{VERSION}=") and n.removeprefix(f"{VERSION}=") < last[-1]]
        delete_tables(spark, [f"{folder}/{n}" for n in old])
        gone |= {n.removeprefix(f"{VERSION}=") for n in old}
    return sorted(gone)

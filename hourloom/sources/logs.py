"""Logs: tables that grow by a few rows at a time and are read whole.

An entry is known by the columns of its identity. Writing it again, because a
job was repeated or failed behind its write, adds another attempt; readers see
the latest attempt of every entry. So a compaction may be interrupted anywhere:
an entry that is both in the folded table and in a batch is still one entry.

    <path>/batches/<id>        what one append wrote
    <path>/folded/<id>/rows    all entries of earlier batches, one row each
    <path>/folded/<id>/names   the batches that it holds

A folded table counts from the marker that ends its write. The batches that it
holds, and the folded table before it, go when the next one has been written:
who reads meanwhile keeps the files that they have listed.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from hourloom.session import delete_tables, is_written, list_names

LOGGED_AT = "logged_at"
ATTEMPT = "attempt"

#: Entries of one file of a folded table.
FOLDED_ROWS = 1_000_000


def new_id() -> str:
    """Ids in the order in which they are drawn, as far as clocks agree; two draws never share one."""
    return f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:12]}"


@dataclass(frozen=True)
class Log:
    """A log of rows of ``schema`` at ``path``; ``identity`` names the columns that tell entries apart."""

    path: str
    schema: T.StructType
    identity: tuple[str, ...]

    @property
    def stored(self) -> T.StructType:
        own = [T.StructField(LOGGED_AT, T.TimestampType()), T.StructField(ATTEMPT, T.StringType())]
        return T.StructType([*self.schema.fields, *own])

    def append(self, df: DataFrame) -> None:
        """Add the rows as one batch; columns that a row does not carry are null."""
        present = set(df.columns)
        columns = [
            (F.col(f"`{f.name}`") if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name) for f in self.schema.fields
        ]
        batch = new_id()
        own = [F.current_timestamp().alias(LOGGED_AT), F.lit(batch).alias(ATTEMPT)]
        df.select(*columns, *own).write.parquet(f"{self.path}/batches/{batch}")

    def _folded(self, spark: SparkSession) -> list[str]:
        """Ids of the folded tables that count, the latest last."""
        return [i for i in list_names(spark, f"{self.path}/folded") if is_written(spark, f"{self.path}/folded/{i}/rows")]

    def _batches(self, spark: SparkSession) -> list[str]:
        return [i for i in list_names(spark, f"{self.path}/batches") if is_written(spark, f"{self.path}/batches/{i}")]

    def _attempts(self, spark: SparkSession, batches: Sequence[str], folded: Sequence[str]) -> DataFrame:
        paths = [f"{self.path}/batches/{i}" for i in batches] + [f"{self.path}/folded/{i}/rows" for i in folded[-1:]]
        return spark.read.schema(self.stored).parquet(*paths) if paths else spark.createDataFrame([], self.stored)

    def _latest(self, attempts: DataFrame) -> DataFrame:
        # Identities may hold nulls, which group as one value. Attempts of one time are told apart by their batch.
        rest = [f.name for f in self.stored.fields if f.name not in self.identity]
        latest = F.max_by(F.struct(*rest), F.struct(LOGGED_AT, ATTEMPT)).alias("_latest")
        return attempts.groupBy(*self.identity).agg(latest).select(*self.identity, "_latest.*")

    def read(self, spark: SparkSession) -> DataFrame:
        """One row for each entry, its latest attempt."""
        # Batches are listed first: what is folded in between is then read twice, not missed.
        batches = self._batches(spark)
        return self._latest(self._attempts(spark, batches, self._folded(spark))).select(*[f.name for f in self.schema.fields])

    def compact(self, spark: SparkSession, beyond: int = 0) -> None:
        """Fold all batches into one table of one row an entry, if there are more than ``beyond``."""
        batches, folded = self._batches(spark), self._folded(spark)
        if len(batches) <= beyond:
            return
        done = [r.name for i in folded[-1:] for r in spark.read.parquet(f"{self.path}/folded/{i}/names").collect()]
        if not set(batches) - set(done):
            return
        target = f"{self.path}/folded/{new_id()}"
        names = [(i,) for i in batches]
        spark.createDataFrame(names, "name string").coalesce(1).write.parquet(f"{target}/names")
        rows = self._latest(self._attempts(spark, batches, folded)).select(*[f.name for f in self.stored.fields])
        rows.write.option("maxRecordsPerFile", FOLDED_ROWS).parquet(f"{target}/rows")
        delete_tables(spark, [f"{self.path}/batches/{i}" for i in done])
        delete_tables(spark, [f"{self.path}/folded/{i}" for i in folded[:-1]])

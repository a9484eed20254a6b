"""Joining a small derived table, one row per key, to a large one."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F, types as T

from hourloom.session import materialise

BROADCAST_ROWS = 100_000
BROADCAST_VALUES = 2_000_000

# A key with more rows than this is dealt over several tasks.
ROWS_PER_DEAL = 1_000_000
# No key is dealt over more tasks than this times the shuffle partitions.
DEALS_PER_PARTITION = 4


def join_same(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Equi-join in which a missing key equals a missing key, as it does in grouping."""
    other = right.withColumnsRenamed({k: f"_same_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_same_{k}")) for k in keys]
    return left.join(other, reduce(and_, same), how).drop(*[f"_same_{k}" for k in keys])


def lookup(
    facts: DataFrame,
    params: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    written: bool = False,
    width: int = 1,
    broadcast_rows: int = BROADCAST_ROWS,
    rows_per_deal: int = ROWS_PER_DEAL,
) -> DataFrame:
    """Attach ``params`` (unique on ``keys``) to ``facts``.

    The parameters are written first, unless the caller did (``written``), so
    their row count is known: up to ``broadcast_rows``, and two million values
    at ``width`` values a row, they are broadcast and the facts are not shuffled.
    Beyond that both sides are shuffled, and a key with more than
    ``rows_per_deal`` facts is dealt over as many tasks as it needs: only such
    keys are repeated, and there are at most facts / ``rows_per_deal`` of them.
    """
    if not written:
        params = materialise(params)
    if params.count() <= min(broadcast_rows, BROADCAST_VALUES // width):
        return join_same(facts, F.broadcast(params), keys, how)
    partitions = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    most = F.lit(DEALS_PER_PARTITION * partitions)
    counts = facts.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > rows_per_deal)
    deals = F.least(F.ceil(F.col("_rows") / rows_per_deal), most).cast("int")
    hot = materialise(counts.select(*keys, deals.alias("_deals")))
    # Only keys of more than ``rows_per_deal`` rows: a small table, which the optimizer may broadcast.
    dealt = join_same(facts, hot, keys, "left")
    dealt = dealt.withColumn("_deal", F.pmod(_row_hash(facts), F.coalesce("_deals", F.lit(1))).cast("int")).drop("_deals")
    last = F.coalesce("_deals", F.lit(1)) - 1
    repeated = join_same(params, hot, keys, "left").withColumn("_deal", F.explode(F.sequence(F.lit(0), last))).drop("_deals")
    return join_same(dealt, repeated, [*keys, "_deal"], how).drop("_deal")


def _row_hash(facts: DataFrame) -> Column:
    # A hash of the row and its partition, not a random number: a repeated task deals the same
    # way, and equal rows from many partitions are still dealt apart. Maps have no hash.
    values = [F.col(f"`{f.name}`") for f in facts.schema.fields if not _holds_map(f.dataType)]
    return F.xxhash64(*values, F.spark_partition_id(), F.monotonically_increasing_id())


def _holds_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _holds_map(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(_holds_map(f.dataType) for f in kind.fields)
    return isinstance(kind, (T.MapType, T.VariantType))

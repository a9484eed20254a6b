"""Row positions in time order, without sorting anything in one task.

``with_ordinal`` numbers the rows of a table sorted by (series, time). The sort
is a range exchange whose borders are sampled from the full sort key, so its
partitions stay even when one series, or one moment, holds a third of all rows.
The sorted rows are written before they are numbered: sampled borders could
differ between two runs of the same plan, a written table cannot.

``calendar_index`` numbers rows whose order begins with a time without that
sort: it counts the rows of days, or of shorter stretches where a day is busy.

``with_position`` turns any ascending number into dense positions within each
series by counting fixed-width buckets of it; a task sees one bucket at a time.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from hourloom.operators.lookup import join_same, lookup
from hourloom.session import materialise

ORDINAL = "_ordinal"
TOTAL = "_total"
BUCKET = "_bucket"

# monotonically_increasing_id() keeps the partition above bit 33 and the row below.
ROW_BITS = 33

# Buckets are even work for the reduce tasks, neither so narrow that the copies at their
# borders matter nor so many that their counts do.
BUCKETS_PER_TASK = 64
MIN_BUCKET_ROWS = 4_096
MAX_BUCKET_ROWS = 65_536
MAX_BUCKETS = 4_000_000
BUCKETS_PER_BLOCK = 1_024


def with_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Refuse, while rows flow, a row without a series key."""
    required = {k: F.coalesce(F.col(k), F.raise_error(F.lit(f"a row has no series key {k}"))) for k in keys}
    return df.withColumns(required) if required else df


def with_ordinal(
    df: DataFrame, order_by: Sequence[str], keys: Sequence[str] = ()
) -> DataFrame:
    """Add ``_ordinal``, the dense 0-based position in the whole table sorted by keys and time.

    ``_total`` holds the number of rows, for the width of the buckets.
    ``order_by`` must make the order total: end it with a tie-breaker where times repeat.
    Equal rows are ordered by the partition they come from, so that many copies
    of one row do not meet in one partition of the sort. A row without a series
    key has no series to be placed in and is refused.
    """
    ordered = with_keys(df, keys).withColumn("_from", F.spark_partition_id()).orderBy(*keys, *order_by, "_from")
    placed = materialise(ordered.drop("_from").withColumn("_at", F.monotonically_increasing_id()))
    placed = placed.withColumn("_part", F.shiftright("_at", ROW_BITS))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition of the sort, so this table is small whatever the data is.
    starts = (
        placed.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select(
            "_part",
            F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start"),
            F.sum("_rows").over(Window.partitionBy()).alias(TOTAL),
        )
    )
    row = F.col("_at").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    return (
        placed.join(F.broadcast(starts), "_part")
        .withColumn(ORDINAL, F.col("_start") + row)
        .drop("_part", "_at", "_start")
    )


def bucket_of(
    spark: SparkSession, position: Column, reach: int = 0, width: int | None = None
) -> Column:
    """Bucket of a position. The width follows from ``_total`` unless it is given."""
    if width is not None:
        return F.floor(position / F.lit(width))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    even = F.least(F.ceil(F.col(TOTAL) / (BUCKETS_PER_TASK * tasks)), F.lit(MAX_BUCKET_ROWS))
    fewest = F.ceil(F.col(TOTAL) / MAX_BUCKETS)
    widest = F.greatest(even, fewest, F.lit(max(MIN_BUCKET_ROWS, 32 * reach)))
    return F.floor(position / widest)


def _running(counts: DataFrame, keys: Sequence[str], step: str, rows: str, before: str) -> DataFrame:
    """Add ``before``, the sum of ``rows`` over the smaller values of ``step`` in each series."""
    earlier = Window.partitionBy(*keys).orderBy(step).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn(before, F.coalesce(F.sum(rows).over(earlier), F.lit(0)))


def bucket_offsets(counts: DataFrame, keys: Sequence[str], bucket: str = BUCKET) -> DataFrame:
    """``_offset`` and ``series_rows`` from (keys, bucket, _rows), in two levels.

    Blocks of buckets are summed side by side; only the sums of the blocks of a
    series, a few thousand at most, are added up in one place.
    """
    block = F.floor(F.col(bucket) / BUCKETS_PER_BLOCK)
    within = _running(counts.withColumn("_block", block), [*keys, "_block"], bucket, "_rows", "_inside")
    blocks = counts.groupBy(*keys, block.alias("_block")).agg(F.sum("_rows").alias("_sum"))
    before = _running(blocks, keys, "_block", "_sum", "_before")
    total = blocks.groupBy(*keys).agg(F.sum("_sum").alias("series_rows"))
    if keys:
        before = before.join(total, list(keys))
    else:
        before = before.withColumn("series_rows", total.scalar())
    return (
        within.join(before, [*keys, "_block"])
        .withColumn("_offset", F.col("_inside") + F.col("_before"))
        .select(*keys, bucket, "_offset", "series_rows")
    )


def running_offsets(
    totals: DataFrame,
    keys: Sequence[str],
    sums: Mapping[str, str],
    bucket: str = BUCKET,
    per_block: int = BUCKETS_PER_BLOCK,
) -> DataFrame:
    """The sums over all earlier buckets of a series, under the names given, in two levels as ``bucket_offsets``."""
    block = F.floor(F.col(bucket) / per_block)
    within, blocks = totals.withColumn("_block", block), totals.groupBy(*keys, block.alias("_block")).agg(
        *[F.sum(c).alias(c) for c in sums]
    )
    for c, name in sums.items():
        within = _running(within, [*keys, "_block"], bucket, c, f"{name}_inside")
        blocks = _running(blocks, keys, "_block", c, f"{name}_before")
    joined = join_same(within, blocks.drop(*sums), [*keys, "_block"], "inner")
    added = [(F.col(f"{name}_inside") + F.col(f"{name}_before")).alias(name) for name in sums.values()]
    return joined.select(*keys, bucket, *added)


def with_position(
    df: DataFrame, keys: Sequence[str], order: str, bucket: str = BUCKET
) -> DataFrame:
    """Add ``idx`` (0-based) and ``series_rows`` within each series.

    ``bucket`` must rise with ``order``. Rows are ranked inside their bucket and
    written with their rank; the bucket counts are read from the written table,
    so that whatever made ``df`` runs once, and move the ranks up.
    """
    group = [*keys, bucket]
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(order))
    ranked = materialise(df.withColumn("_rank", rank))
    offsets = bucket_offsets(ranked.groupBy(*group).agg(F.count(F.lit(1)).alias("_rows")), keys, bucket)
    return (
        ranked.join(offsets, group)
        .withColumn("idx", (F.col("_offset") + F.col("_rank") - 1).cast("long"))
        .drop("_rank", "_offset")
    )


# Rows of a stretch of time that are ranked in one place; busier stretches are cut into shorter ones.
CELL_ROWS = 262_144
# Days, hours, minutes and seconds.
CELL_SECONDS = (86_400, 3_600, 60, 1)
# Rows of one second of one series beyond which times alone do not cut the series.
MOMENT_ROWS = 16_000_000
# Cells are added up in blocks of a month or so.
BLOCK_SECONDS = 32 * 86_400
BEFORE_ALL = -(1 << 62)


def seconds_of(df: DataFrame, time: str) -> Column | None:
    """Whole seconds of a date or time on a line of its own; none for other types. Missing times come before all others."""
    kind, t = df.schema[time].dataType, F.col(f"`{time}`")
    if isinstance(kind, T.TimestampType):
        seconds = F.unix_seconds(t)
    elif isinstance(kind, (T.TimestampNTZType, T.DateType)):
        days = F.datediff(F.to_date(t), F.lit("1970-01-01").cast("date")).cast("long") * 86_400
        whole = isinstance(kind, T.DateType)
        seconds = days if whole else days + F.hour(t) * 3_600 + F.minute(t) * 60 + F.floor(F.second(t))
    else:
        return None
    return F.coalesce(seconds.cast("long"), F.lit(BEFORE_ALL))


def calendar_cells(df: DataFrame, keys: Sequence[str], cell_rows: int) -> tuple[DataFrame, DataFrame, bool]:
    """Rows with ``_cell``, the first second of their stretch of time; the rows of every cell; whether one is too large.

    Days first; of days with more than ``cell_rows`` rows the hours, of such
    hours the minutes, and so on. Each step reads the keys and times alone, and
    only those of the busy stretches.
    """
    placed = df.withColumn("_cell", F.col("_second") - F.pmod("_second", F.lit(CELL_SECONDS[0])))
    quiet, rows = [], df.select(*keys, "_second")
    for n, width in enumerate(CELL_SECONDS):
        cells = rows.withColumn("_cell", F.col("_second") - F.pmod("_second", F.lit(width)))
        counts = materialise(cells.groupBy(*keys, "_cell").agg(F.count(F.lit(1)).alias("_rows")))
        if n + 1 == len(CELL_SECONDS):
            quiet.append(counts)
            busy = counts.where(F.col("_rows") > max(cell_rows, MOMENT_ROWS))
            break
        busy = counts.where(F.col("_rows") > cell_rows).select(*keys, "_cell")
        quiet.append(counts.where(F.col("_rows") <= cell_rows))
        if busy.isEmpty():
            break
        shorter = CELL_SECONDS[n + 1]
        found = lookup(placed, busy.withColumn("_busy", F.lit(True)), [*keys, "_cell"])
        next_cell = F.col("_second") - F.pmod("_second", F.lit(shorter))
        placed = found.withColumn("_cell", F.when(F.col("_busy"), next_cell).otherwise(F.col("_cell"))).drop("_busy")
        rows = lookup(cells, busy, [*keys, "_cell"], how="inner").select(*keys, "_second")
    return placed, reduce(DataFrame.unionByName, quiet), not busy.isEmpty()


def calendar_index(
    df: DataFrame, order_by: Sequence[str], keys: Sequence[str] = (), cell_rows: int = CELL_ROWS
) -> DataFrame | None:
    """Add ``idx`` by counting stretches of time, with one exchange of the rows and none of them written.

    The rows of every stretch are counted from keys and times; prefix sums of the
    counts say where a stretch begins, and rows are ranked inside theirs. None if
    the first column of the order is no time, or one second of one series holds
    more rows than a task should sort.
    """
    seconds = seconds_of(df, order_by[0])
    if seconds is None:
        return None
    placed, cells, too_busy = calendar_cells(with_keys(df, keys).withColumn("_second", seconds), keys, cell_rows)
    if too_busy:
        return None
    offsets = running_offsets(cells, keys, {"_rows": "_offset"}, "_cell", BLOCK_SECONDS)
    # The rows lie by series and cell for the ranks, and stay there for the join.
    group = [*keys, "_cell"]
    ranked = placed.withColumn("_rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order_by)))
    found = ranked.join(offsets, group)
    return found.select(*df.columns, (F.col("_offset") + F.col("_rank") - 1).cast("long").alias("idx"))


def row_index(
    df: DataFrame,
    order_by: Sequence[str],
    keys: Sequence[str] = (),
    bucket_rows: int | None = None,
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """Add the 0-based position ``idx`` of every row in time order, per series if ``keys`` are given.

    By the calendar where the order begins with a time, otherwise by a sort of all rows.
    """
    if bucket_rows is None and (indexed := calendar_index(df, order_by, keys, cell_rows)) is not None:
        return indexed
    placed = with_ordinal(df, order_by, keys)
    if not keys:
        return placed.drop(TOTAL).withColumnRenamed(ORDINAL, "idx")
    bucketed = placed.withColumn(BUCKET, bucket_of(df.sparkSession, F.col(ORDINAL), width=bucket_rows))
    return with_position(bucketed, keys, ORDINAL).drop(TOTAL, BUCKET, ORDINAL, "series_rows")

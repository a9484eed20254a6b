"""Positional lags, leads and rolling means over long ordered series.

A window over one whole series would run in one task. Here the sorted rows are
cut into buckets of equal width, and every row is also copied into the buckets
whose rows can see it. Windows then run per bucket, and the copies are dropped.
The copied share is (back + ahead) / bucket width.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.window import WindowSpec

from hourloom.operators.clean import known_features, select_ordered
from hourloom.operators.lookup import join_same
from hourloom.operators.timeindex import (
    BUCKET,
    ORDINAL,
    TOTAL,
    bucket_of,
    row_index,
    running_offsets,
    with_keys,
    with_ordinal,
    with_position,
)
from hourloom.session import materialise
from hourloom.sources.readers import nulls_for_nans

OWN = "_own"
COMPLETE = "_complete"

# Series of at most this many rows are windowed whole: an hourly series of five years has 44,000.
WHOLE_SERIES_ROWS = 100_000


# Wider windows are summed by position: a bucket would hold 32 times their rows.
WIDE_WINDOW = 2_048


@dataclass(frozen=True)
class Layout:
    """Rows arranged for windows: run them over ``window``, then keep the ``own`` rows."""

    frame: DataFrame
    keys: tuple[str, ...]
    order: tuple[str, ...]
    bucketed: bool

    @property
    def window(self) -> WindowSpec:
        group = [*self.keys, BUCKET] if self.bucketed else list(self.keys)
        return Window.partitionBy(*group).orderBy(*self.order)

    def own_rows(self) -> Layout:
        frame = self.frame.where(OWN).drop(OWN) if self.bucketed else self.frame
        return replace(self, frame=frame)

    def positions(self) -> DataFrame:
        """Add ``idx`` and ``series_rows`` over the rows still in the frame."""
        if self.bucketed:
            return with_position(self.frame, self.keys, ORDINAL)
        series = Window.partitionBy(*self.keys)
        return self.frame.withColumns(
            {
                "idx": (F.row_number().over(self.window) - 1).cast("long"),
                "series_rows": F.count(F.lit(1)).over(series),
            }
        )

    def plain(self, frame: DataFrame) -> DataFrame:
        return frame.drop(ORDINAL, BUCKET)


def lay_out(
    df: DataFrame,
    order_by: Sequence[str],
    keys: Sequence[str] = (),
    back: int = 0,
    ahead: int = 0,
    series_bound: int | None = None,
    bucket_rows: int | None = None,
) -> Layout:
    """Arrange ``df`` so that a row window can reach ``back`` rows behind and ``ahead`` in front.

    ``series_bound`` is a proven limit on the rows of one series, such as the
    hours of the job's range for an hourly table with unique hours. Within
    ``WHOLE_SERIES_ROWS`` each series is one window partition and no copies are
    made. Without a bound, or without keys, the rows are bucketed.
    """
    if keys and series_bound is not None and series_bound <= WHOLE_SERIES_ROWS:
        return Layout(with_keys(df, keys), tuple(keys), tuple(order_by), bucketed=False)
    placed = with_ordinal(df, order_by, keys)
    at = F.col(ORDINAL)

    def bucket(position: Column) -> Column:
        return bucket_of(df.sparkSession, position, back + ahead, bucket_rows)

    seen_in = F.sequence(bucket(F.greatest(at - ahead, F.lit(0))), bucket(at + back))
    copies = placed.withColumn(BUCKET, F.explode(seen_in))
    owned = copies.withColumn(OWN, bucket(at) == F.col(BUCKET)).drop(TOTAL)
    return Layout(owned, tuple(keys), (ORDINAL,), bucketed=True)


def lag_columns(window: WindowSpec, column: str, count: int) -> dict[str, Column]:
    return {f"lag_{i}_{column}": F.lag(column, i).over(window) for i in range(1, count + 1)}


def lead_columns(window: WindowSpec, column: str, count: int, only_last: bool = False) -> dict[str, Column]:
    first = count if only_last else 1
    return {f"future_{i}_{column}": F.lead(column, i).over(window) for i in range(first, count + 1)}


def rolling_mean(window: WindowSpec, column: str, size: int) -> dict[str, Column]:
    """Mean of the last ``size`` values; null unless all of them are present."""
    frame = window.rowsBetween(-(size - 1), 0)
    mean = F.when(F.count(column).over(frame) == size, F.avg(column).over(frame))
    return {f"rolling_mean_{column}_window_size_{size}": mean}


# Sums are kept as decimals of so many places: differences of sums are then exact.
SUM_SCALE = 9
# Rows of a bucket in which sums run, whatever the width of the window.
SUM_ROWS = 8_192


def wide_rolling_mean(
    df: DataFrame,
    column: str,
    order_by: Sequence[str],
    size: int,
    keys: Sequence[str] = (),
    bucket_rows: int = SUM_ROWS,
    scale: int = SUM_SCALE,
) -> DataFrame:
    """Mean of the last ``size`` values of any width; null unless all of them are present.

    Rows are numbered in each series; sums and counts of present values run
    inside buckets of ``bucket_rows`` positions, and the sums of whole buckets are
    added up in two levels. The mean at a position is then the difference of two
    sums, ``size`` rows apart: each row is sent to its own position and to the one
    that it leaves the window of, so a window of a million rows costs as much as
    one of ten. Values are taken to ``scale`` decimal places, sums of them are exact.
    """
    if size < 1:
        raise ValueError("a window holds at least one row")
    name = f"rolling_mean_{column}_window_size_{size}"
    x = F.col(f"`{column}`")
    x = F.when(~F.isnan(x.cast("double")), x).cast(f"decimal(38,{scale})")
    placed = row_index(df, order_by, keys).withColumn(BUCKET, F.floor(F.col("idx") / bucket_rows))
    group = [*keys, BUCKET]
    inside = Window.partitionBy(*group).orderBy("idx").rowsBetween(Window.unboundedPreceding, 0)
    running = placed.withColumns({"_sum": F.coalesce(F.sum(x).over(inside), F.lit(0)), "_n": F.count(x).over(inside)})
    running = materialise(running)
    totals = running.groupBy(*group).agg(F.max_by("_sum", "idx").alias("_sum"), F.max("_n").alias("_n"))
    offsets = running_offsets(totals, keys, {"_sum": "_sums", "_n": "_ns"})
    summed = join_same(running, offsets, group, "left").withColumns(
        {"_sum": (F.col("_sum") + F.col("_sums")).cast(f"decimal(38,{scale})"), "_n": F.col("_n") + F.col("_ns")}
    )
    summed = summed.drop("_sums", "_ns", BUCKET)
    # The sums up to a position, sent to the position whose window they have left.
    left = summed.select(*keys, (F.col("idx") + size).alias("idx"), F.col("_sum").alias("_gone"), F.col("_n").alias("_gone_n"))
    both = join_same(summed, left, [*keys, "idx"], "left")
    total = F.col("_sum") - F.coalesce("_gone", F.lit(0))
    present = F.col("_n") - F.coalesce("_gone_n", F.lit(0))
    mean = F.when(present == size, total.cast("double") / size)
    return both.withColumn(name, mean).drop("idx", "_sum", "_n", "_gone", "_gone_n")


def shifted_frame(
    df: DataFrame,
    column: str,
    order_by: Sequence[str],
    lags: int = 0,
    leads: int = 0,
    window_size: int = 0,
    keys: Sequence[str] = (),
    series_bound: int | None = None,
    bucket_rows: int | None = None,
) -> DataFrame:
    """Lags, all leads and an optional rolling mean of one column; incomplete rows stay, with nulls.

    A window beyond ``WIDE_WINDOW`` rows is summed by position instead of in buckets that reach over it.
    """
    if window_size > WIDE_WINDOW:
        df = wide_rolling_mean(df, column, order_by, window_size, keys)
        mean = df.columns[-1]
        shifted = shifted_frame(df, column, order_by, lags, leads, 0, keys, series_bound, bucket_rows)
        return shifted.select(*[c for c in shifted.columns if c != mean], mean)
    layout = lay_out(
        df, order_by, keys, max(lags, window_size - 1, 0), leads, series_bound, bucket_rows
    )
    w = layout.window
    new = {**lag_columns(w, column, lags), **lead_columns(w, column, leads)}
    if window_size > 0:
        new |= rolling_mean(w, column, window_size)
    shifted = replace(layout, frame=layout.frame.withColumns(new)).own_rows()
    return layout.plain(shifted.frame)


def supervised_frame(
    df: DataFrame,
    order_by: Sequence[str],
    features: Sequence[str],
    lags: Mapping[str, int],
    horizon: int,
    target: str,
    keys: Sequence[str] = (),
    series_bound: int | None = None,
    bucket_rows: int | None = None,
) -> DataFrame:
    """The learning table: features, their lags, and the target ``horizon`` rows ahead.

    A row is kept only if every feature, every lag and the target of **each** of
    the next ``horizon`` rows are present. ``idx`` and ``series_rows`` count the
    kept rows. Lags follow the order of ``lags``; the label comes last. NaN is a
    missing value. A row without a series key is refused.

    Completeness is found by counting values in the row frames instead of testing
    the shifted columns, so counting the kept rows needs only a few narrow ones.
    """
    base = nulls_for_nans(select_ordered(df, [*keys, *[c for c in order_by if c not in features], *features]))
    lags = known_features(base.select(*features), lags)
    present = [F.col(c).isNotNull() for c in features]
    base = base.withColumn(COMPLETE, _all_of(present))
    layout = lay_out(
        base, order_by, keys, max([0, *lags.values()]), horizon, series_bound, bucket_rows
    )
    w = layout.window
    filled = [F.count(c).over(w.rowsBetween(-n, -1)) == n for c, n in lags.items() if n > 0]
    if horizon > 0:
        filled.append(F.count(target).over(w.rowsBetween(1, horizon)) == horizon)
    new: dict[str, Column] = {}
    for c, n in lags.items():
        new |= lag_columns(w, c, n)
    new |= lead_columns(w, target, horizon, only_last=True)
    shifted = layout.frame.withColumns(
        {COMPLETE: _all_of([F.col(COMPLETE), *filled]), **new}
    )
    kept = replace(layout, frame=shifted.where(COMPLETE).drop(COMPLETE)).own_rows()
    return layout.plain(kept.positions()).select(
        *[c for c in base.columns if c != COMPLETE and c not in features],
        "idx", "series_rows", *features, *new,
    )


def _all_of(conditions: Sequence[Column]) -> Column:
    result = F.lit(True)
    for condition in conditions:
        result = result & condition
    return result

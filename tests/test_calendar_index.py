"""Positions by counted stretches of time, against plain sorting."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from hourloom.operators import timeindex
from tests.helpers import rows


def events(n, seed):
    r = random.Random(seed)
    start = datetime(1969, 12, 30, 22, 0, 0)
    out = []
    for i in range(n):
        # A third of all rows in one minute of one series, many of them in one second.
        busy = r.random() < 0.33
        at = datetime(2024, 3, 31, 2, 30, r.choice([7, 7, 7, 41]), r.randrange(4)) if busy else start + timedelta(seconds=r.randrange(10**7))
        out.append(("a" if busy else r.choice("abc"), None if i % 97 == 5 else at, i))
    r.shuffle(out)
    return out


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp", "date"])
@pytest.mark.parametrize("cell_rows", [1, 40, 10**6])
def test_positions_equal_sorting(spark, kind, cell_rows):
    data = events(700, cell_rows)
    df = spark.createDataFrame(data, "s string, t timestamp_ntz, i long").withColumn("t", F.col("t").cast(kind)).repartition(5)
    got = timeindex.calendar_index(df, ["t", "i"], ["s"], cell_rows)
    assert got.columns == ["s", "t", "i", "idx"]
    found = rows(got)
    assert len(found) == len(data)
    for s in "abc":
        ordered = sorted((r for r in found if r[0] == s), key=lambda r: (r[1] is not None, r[1] or 0, r[2]) if r[1] else (False, 0, r[2]))
        assert [r[3] for r in ordered] == list(range(len(ordered)))
    whole = rows(timeindex.row_index(df, ["t", "i"], cell_rows=cell_rows), "idx")
    assert [r[3] for r in whole] == list(range(len(data)))
    assert [r[:3] for r in whole] == [tuple(r) for r in df.orderBy("t", "i").collect()]


def test_rows_are_exchanged_once(spark):
    df = spark.range(1_000).select(
        (F.col("id") % 3).alias("s"), F.timestamp_seconds(F.col("id") * 977).alias("t"), "id", F.lit("wide").alias("carried")
    )
    plan = timeindex.calendar_index(df, ["t", "id"], ["s"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Sort" not in plan  # no sort of all rows
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = timeindex.calendar_index(df, ["t", "id"], ["s"])._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    depth = lambda line: len(line) - len(line.lstrip(" :+-*(0123456789)"))
    at = next(i for i, line in enumerate(plan) if "Range (0, 1000" in line)
    above, here = [], depth(plan[at])
    for line in reversed(plan[:at]):
        if depth(line) < here:
            here = depth(line)
            above.append(line)
    assert sum("Exchange" in line for line in above) == 1 and any("Window" in line for line in above)


def test_other_orders_and_crowded_seconds_are_sorted(spark, monkeypatch):
    df = spark.createDataFrame([("a", i % 7, i) for i in range(50)], "s string, t int, i long")
    assert timeindex.calendar_index(df, ["t", "i"], ["s"]) is None
    assert [r[2] for r in rows(timeindex.row_index(df, ["t", "i"], ["s"]), "idx")] == sorted(range(50), key=lambda i: (i % 7, i))
    monkeypatch.setattr(timeindex, "MOMENT_ROWS", 10)
    same = df.withColumn("t", F.lit("2024-01-01").cast("timestamp"))
    assert timeindex.calendar_index(same, ["t", "i"], ["s"], cell_rows=5) is None
    assert [r[2] for r in rows(timeindex.row_index(same, ["t", "i"], ["s"], cell_rows=5), "idx")] == list(range(50))


def test_a_row_without_its_series_is_refused(spark):
    df = spark.createDataFrame([("a", datetime(2024, 1, 1)), (None, datetime(2024, 1, 2))], "s string, t timestamp")
    with pytest.raises(Exception, match="no series key"):
        timeindex.row_index(df, ["t"], ["s"]).collect()


def test_an_empty_table(spark):
    df = spark.createDataFrame([], "s string, t timestamp, i long")
    assert timeindex.row_index(df, ["t", "i"], ["s"]).count() == 0

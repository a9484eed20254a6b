"""Every query with SQL gives what DuckDB gives; plans keep their shape."""

from __future__ import annotations

import glob
import math
import os

import pytest

import __spark_entry__ as contract
from hourloom.plans.oracles import ORACLES
from hourloom.plans.queries import QUERIES

duckdb = pytest.importorskip("duckdb")

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="the test tables are not here")


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def comparable(value):
    return "NaN" if isinstance(value, float) and math.isnan(value) else value


def table(data, names):
    return sorted((tuple(comparable(r[c]) for c in names) for r in data.select(names).to_pylist()), key=repr)


def test_only_models_have_no_sql():
    assert set(QUERIES) - set(ORACLES) == {"rf_forecast", "gbt_forecast"}
    assert not set(ORACLES) - set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, oracle, name):
    got = QUERIES[name](spark, SF_DIR).toArrow()
    expected = oracle.sql(ORACLES[name]).to_arrow_table()
    names = sorted(expected.column_names)
    assert sorted(got.column_names) == names
    assert table(got, names) == table(expected, names)


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_fact_rows_meet_in_one_task(spark):
    """Only the row counts of partitions and buckets may use a single partition."""
    for name in ("supervised_frame", "supervised_frame_events", "lag_features", "row_index_by_series"):
        lines = plan_of(QUERIES[name](spark, SF_DIR)).splitlines()
        for i, line in enumerate(lines):
            if "Exchange SinglePartition" in line:
                below = lines[i + 1]
                assert "HashAggregate" in below and any(c in below for c in ("_rows", "_sum", "series_rows")), (name, below)


def test_range_filter_reaches_the_scan(spark):
    plan = plan_of(QUERIES["range_filter_events"](spark, SF_DIR))
    assert "GreaterThanOrEqual(ts,2024-01-05T06:00)" in plan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,value:double>" in plan


def test_windows_share_one_sort(spark):
    plan = plan_of(QUERIES["lag_features"](spark, SF_DIR))
    assert plan.count("Sort [") == 2  # the windows, and the few partition counts
    assert "Python" not in plan and "BatchEvalPython" not in plan

"""The queries of the driver contract: ``name -> (spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

import uuid
import warnings
from collections.abc import Callable, Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from hourloom.functions import scalar as S
from hourloom.operators import catalog, categories, clean, enrich, evaluate, forecast, lagging, moments, scaling
from hourloom.operators.lookup import lookup
from hourloom.operators.split import chronological_split, split_counts
from hourloom.operators.timeindex import row_index
from hourloom.operators.validate import validation_gate
from hourloom.plans import standins as V
from hourloom.plans.prepare import (
    RENAMES,
    Dataset,
    clean_inputs,
    learning_table,
    merge_inputs,
    merged_table,
    prepare,
    published_dataset,
    scaled_dataset,
)
from hourloom.plans.search import evaluate_run, score_table, search, trial_metrics, validate_model
from hourloom.session import materialise, scratch_root
from hourloom.sources import schemas as N
from hourloom.sources.bucketed import bucket_tables, bucketed_tables
from hourloom.sources.readers import nulls_for_nans, read_inputs, train_and_validation
from hourloom.sources.config import read_config
from hourloom.sources.published import Release, published_rows, retire
from hourloom.sources.writers import DATASET_KEY, dataset_log, evaluation_log, read_predictions, trial_log

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def rounded(df: DataFrame, columns: Sequence[str], digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), digits) + F.lit(0.0) for c in columns})


def job_folder(spark: SparkSession) -> str:
    """A folder of its own for what a query's job writes and reads again."""
    return f"{scratch_root(spark)}/jobs/{uuid.uuid4().hex}"


# ---- scans, sinks and whole jobs


def _delivered(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """The seven inputs as delivered: folders of CSV with an index, the old names and lists of ids."""
    folder = job_folder(spark)
    for name, df in V.inputs(spark, sf_dir).items():
        old = {new: before for before, new in RENAMES.get(name, {}).items()}
        df = df.withColumnsRenamed(old)
        if name in ("treatment", "boarding"):
            df = df.withColumns({c: F.lit("17; 18") for c in N.ID_LIST_COLUMNS})
        if name == "patients":
            df = df.withColumn("weather_description", F.lit("words, and more"))
        df.select(F.monotonically_increasing_id().alias("_c0"), "*").write.option("header", True).csv(f"{folder}/{name}")
    return {name: f"{folder}/{name}" for name in N.INPUTS}


@query
def csv_inputs(spark, sf_dir):
    """Delivered files read, renamed, cut, freed of id lists, rounded and joined."""
    cleaned = clean_inputs(read_inputs(spark, _delivered(spark, sf_dir), N.INPUTS, "csv"), *V.RANGE)
    tables = [cleaned[name] for name in ("census", "boarding", "treatment")]
    counts = ["UED_Hospital_Census", "boarding_count", "treatment_count"]
    merged = enrich.merge_hourly(tables, [N.HOUR]).withColumns({c: F.col(c).cast("long") for c in counts})
    return rounded(merged, ["average_waiting_times_treatment_minute"])


JOB_KEY = (V.CONFIG.target_feature, V.CONFIG.future_hours, V.CONFIG.dataset_number)


def _prepared(spark: SparkSession, sf_dir: str, times: int = 1) -> str:
    """The folder of the whole preparation from delivered files, by the configuration in a file of its own."""
    out = job_folder(spark)
    paths = _delivered(spark, sf_dir)
    document = spark.createDataFrame([(V.CONFIG.as_json(),)], "value string")
    document.coalesce(1).write.text(f"{out}/config")
    config = read_config(spark, f"{out}/config")
    for _ in range(times):
        prepare(spark, config, paths, out, *V.RANGE)
    return out


@query
def prepared_dataset(spark, sf_dir):
    """The whole preparation from delivered files, run twice; sizes as described and as read back."""
    out = _prepared(spark, sf_dir, 2)
    release, info = published_dataset(spark, out, JOB_KEY)
    names = ["train_rows", "val_rows", "test_rows", "original_features", "lag_features"]
    rows = release.read("datasets")
    read_back = rows.agg(F.count(F.lit(1)).alias("read_rows"), F.sum("idx").alias("read_positions"))
    listed = catalog.list_datasets(spark, out)
    described = listed.withColumns({c: F.lit(info[c]).cast("long") for c in names})
    return described.withColumns({c: read_back.select(c).scalar() for c in read_back.columns})


@query
def written_merged(spark, sf_dir):
    """The merged table as the preparation wrote it."""
    release, _ = published_dataset(spark, _prepared(spark, sf_dir), JOB_KEY)
    weather = [f"weather_{w}" for w in S.WEATHER_TYPES]
    return release.read("merged").select(N.HOUR, "day_of_week", "extreme_indicator", N.HOLIDAY_FLAG, *weather)


@query
def written_scalers(spark, sf_dir):
    """The scaling parameters as the preparation wrote them."""
    release, _ = published_dataset(spark, _prepared(spark, sf_dir), JOB_KEY)
    # Means of values in cents can lie exactly between two roundings: all of those go up.
    params = release.read("scalers").withColumns({c: F.col(c) + 1e-7 for c in ("mean", "std")})
    return rounded(params.select("role", "column", "mean", "std"), ["mean", "std"], 4)


@query
def written_tensors(spark, sf_dir):
    """The float arrays as the preparation wrote them: the label, and one scaled feature by its place."""
    release, info = published_dataset(spark, _prepared(spark, sf_dir), JOB_KEY)
    place = list(info["feature_order"]).index("total_patient_count") + 1
    arrays = release.read("tensors").select(
        "idx", "split", F.size("x").alias("n_features"),
        F.element_at("x", place).cast("double").alias("x"), F.element_at("y", 1).cast("double").alias("y"),
    )
    return rounded(arrays, ["x", "y"], 3)


def _event_release(spark: SparkSession, root: str, frame: DataFrame, fail_between: bool = False) -> None:
    """Publish the split table and its sums; ``fail_between`` makes the second table's write fail."""
    log = dataset_log(root)
    release = Release(spark, root, dict(zip(DATASET_KEY, ("value", V.EVENT_HORIZON, "dataset1"), strict=True)))
    rows = release.write(frame, "datasets", ("split",))
    sums = rows.groupBy("split").agg(F.sum("idx").alias("positions"))
    if fail_between:
        sums = sums.withColumn("positions", F.when(F.col("split") != "", F.raise_error(F.lit("lost"))).cast("long"))
    release.write(sums, "sums")
    release.commit(log)
    retire(spark, root, log, release.key)


def _rewritten(spark: SparkSession, sf_dir: str, fail: bool) -> DataFrame:
    """A dataset with three splits, then one with two, whose job may fail between two tables; what is published then."""
    frame, root = _event_split(spark, sf_dir).select("idx", "split", "value"), job_folder(spark)
    _event_release(spark, root, frame)
    two = frame.withColumn("split", F.when(F.col("split") == "val", "test").otherwise(F.col("split")))
    try:
        _event_release(spark, root, two, fail)
    except Exception as lost:
        if not fail or "lost" not in str(lost):
            raise
    log = dataset_log(root)
    rows = published_rows(spark, root, log, "datasets").groupBy(*DATASET_KEY, "split").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("idx").alias("positions")
    )
    sums = published_rows(spark, root, log, "sums").withColumnRenamed("positions", "written_positions")
    return rows.join(sums, [*DATASET_KEY, "split"], "full")


@query
def dataset_rewrite(spark, sf_dir):
    """A dataset published with three splits, then with two: nothing of the first stays."""
    return _rewritten(spark, sf_dir, False)


@query
def dataset_kept_when_a_rewrite_fails(spark, sf_dir):
    """The job of the second version dies between its two tables: both tables are those of the first."""
    return _rewritten(spark, sf_dir, True)


def _order_trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A trial for every order."""
    orders = V.table(spark, sf_dir, "orders")
    return orders.select(
        F.col("o_orderpriority").alias("search_id"),
        F.col("o_orderkey").alias("trial_num"),
        F.lit(catalog.COMPLETED).alias("status"),
        (F.col("o_totalprice") / 1000).alias("mae"),
        (F.col("o_custkey") / 60).alias("runtime_minutes"),
    )


@query
def logged_trials(spark, sf_dir):
    """Trials logged twice in batches and folded in between, the second time with other run times for some."""
    log = trial_log(job_folder(spark))
    trials = _order_trials(spark, sf_dir)
    batch = F.col("trial_num") % 3
    log.append(trials.where(batch == 0))
    log.append(trials.where(batch == 1))
    log.compact(spark)
    log.append(trials.where(batch == 2))
    log.append(trials.where(batch < 2).withColumn("runtime_minutes", F.col("runtime_minutes") + F.when(batch == 1, 1).otherwise(0)))
    log.compact(spark)
    log.append(trials.where(batch == 2))
    found = log.read(spark).groupBy("search_id").agg(
        F.count(F.lit(1)).alias("trials"), F.sum("runtime_minutes").alias("minutes"), F.min("mae").alias("mae")
    )
    return rounded(found, ["minutes"], 2)


@query
def logged_evaluations(spark, sf_dir):
    """A model evaluated twice on one split and once on another: one row for each in the evaluations, with a run time logged."""
    dataset, out, run, model = _searched(spark, sf_dir, "RF")
    for split in ("test", "test", "val"):
        evaluate_run(dataset, model, run, out, split)
    timed = trial_log(out).read(spark).where("runtime_minutes > 0").select("run_id")
    rows = evaluation_log(out).read(spark).join(timed, "run_id")
    return rounded(rows.select("split", "predictions_count", "test_set_size", "mae", "rmse"), ["mae", "rmse"], 2)


@query
def scored_table(spark, sf_dir):
    """Raw rows scored by a searched model with the published description and parameters."""
    dataset, out, _, model = _searched(spark, sf_dir, "RF")
    release = Release(spark, out, dict(zip(DATASET_KEY, STUMP_KEY, strict=True)))
    release.write(dataset.params, "scalers")
    info = spark.createDataFrame([(dataset.features, dataset.label)], "feature_order array<string>, target_column string")
    release.commit(dataset_log(out), info)
    raw = V.table(spark, sf_dir, "lineitem").select("l_returnflag", F.col("l_quantity").alias("quantity"))
    scored = score_table(raw, out, STUMP_KEY, model, ["l_returnflag"])
    return scored.groupBy("l_returnflag", F.round("y_pred", 2).alias("y_pred")).agg(F.count(F.lit(1)).alias("rows"))


# ---- filters and rounding


@query
def range_filter(spark, sf_dir):
    return clean.filter_range(
        V.patients(spark, sf_dir), N.HOUR, "2024-01-05 06:00:00", "2024-01-20 18:00:00"
    ).select(N.HOUR, "total_patient_count", "temp", "humidity")


@query
def range_filter_events(spark, sf_dir):
    events = V.table(spark, sf_dir, "events").select("event_id", "ts", "value")
    return clean.filter_range(events, "ts", "2024-01-05 06:00:00", "2024-01-20")


@query
def exclusion_filter(spark, sf_dir):
    return clean.exclude_window(
        V.patients(spark, sf_dir), N.HOUR, "2024-01-10", "2024-01-12"
    ).select(N.HOUR, "total_patient_count")


@query
def round_half_even(spark, sf_dir):
    orders = V.table(spark, sf_dir, "orders").select(
        F.lit("order").alias("source"), F.col("o_orderkey").alias("id"),
        F.col("o_totalprice").alias("x"), (F.floor("o_totalprice") / 2).alias("half"),
    )
    events = V.table(spark, sf_dir, "events").select(
        F.lit("event").alias("source"), F.col("event_id").alias("id"),
        F.col("value").alias("x"), (-F.floor("value") / 2).alias("half"),
    )
    return clean.round_numbers(orders.unionByName(events))


# ---- joins


@query
def merge_inner_hourly(spark, sf_dir):
    """All hours: the range is as wide as times go."""
    cleaned = clean_inputs(V.inputs(spark, sf_dir), "0001-01-01 00:00:00", "9999-12-31 23:00:00")
    tables = [cleaned[name] for name in ("census", "patients", "boarding", "treatment")]
    return rounded(enrich.merge_hourly(tables, [N.HOUR]), ["average_waiting_times_treatment_minute"])


@query
def merge_bucketed_hourly(spark, sf_dir):
    """The same join of tables that were written by the hour: no row is exchanged."""
    cleaned = clean_inputs(V.inputs(spark, sf_dir), "0001-01-01 00:00:00", "9999-12-31 23:00:00")
    names, folder = ("census", "patients", "boarding", "treatment"), job_folder(spark)
    bucket_tables({name: cleaned[name] for name in names}, folder, [N.HOUR], buckets=8)
    tables = bucketed_tables(spark, folder, names).values()
    return rounded(enrich.merge_hourly(list(tables), [N.HOUR]), ["average_waiting_times_treatment_minute"])


@query
def enrich_games(spark, sf_dir):
    hours = V.patients(spark, sf_dir).select(N.HOUR, "total_patient_count")
    flagged = enrich.flag_hours(hours, V.away_games(spark), N.HOUR, N.AWAY_GAME_FLAG)
    return enrich.flag_hours(flagged, V.home_games(spark), N.HOUR, N.HOME_GAME_FLAG)


@query
def enrich_holiday(spark, sf_dir):
    hours = V.patients(spark, sf_dir).select(N.HOUR, "total_patient_count")
    return enrich.flag_dates(hours, V.holidays(spark), N.HOUR, N.HOLIDAY_FLAG)


@query
def enrich_holiday_events(spark, sf_dir):
    events = V.table(spark, sf_dir, "events").select("event_id", F.col("ts").alias(N.HOUR))
    return enrich.flag_dates(events, V.holidays(spark), N.HOUR, N.HOLIDAY_FLAG)


# ---- derived columns


@query
def calendar_features(spark, sf_dir):
    return enrich.add_calendar(V.patients(spark, sf_dir).select(N.HOUR), N.HOUR)


@query
def weather_category(spark, sf_dir):
    hours = V.patients(spark, sf_dir)
    return hours.select(N.HOUR, S.weather_category(F.col("weather_main")).alias("weather_type"))


@query
def weather_onehot(spark, sf_dir):
    return enrich.add_weather(V.patients(spark, sf_dir).select(N.HOUR, "weather_main"))


@query
def category_frequencies(spark, sf_dir):
    lines = V.table(spark, sf_dir, "lineitem")
    return categories.fit_categories(lines, ["l_returnflag", "l_linestatus", "l_linenumber"])


@query
def onehot_fitted(spark, sf_dir):
    """Columns for the states of lines, found in the lines, applied to orders, which have a state that no line has."""
    dictionary = materialise(categories.fit_categories(V.table(spark, sf_dir, "lineitem"), ["l_linestatus"]))
    orders = V.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    flagged = categories.one_hot_fitted(orders, "o_orderstatus", dictionary, "status", fitted="l_linestatus")
    placed = categories.with_position(flagged, "o_orderstatus", dictionary, fitted="l_linestatus")
    return placed.drop("o_orderstatus").withColumnRenamed("o_orderstatus_position", "position").drop("o_orderstatus_unseen")


@query
def extreme_flag(spark, sf_dir):
    hours = V.patients(spark, sf_dir).select(N.HOUR, "total_patient_count")
    return enrich.add_extreme_flag(hours, "total_patient_count")


@query
def extreme_flag_by_series(spark, sf_dir):
    events = V.table(spark, sf_dir, "events").select("event_id", "user_id", "value")
    return enrich.add_extreme_flag(events, "value", by=["user_id"])


@query
def regular_grid(spark, sf_dir):
    return rounded(
        enrich.regular_grid(V.boarding(spark, sf_dir), N.HOUR), ["average_boarding_times_minute"]
    )


@query
def regular_grid_half_hours(spark, sf_dir):
    """A grid that starts half an hour past the hour."""
    late = V.boarding(spark, sf_dir).withColumn(N.HOUR, F.col(N.HOUR) + F.expr("INTERVAL 30 MINUTES"))
    return rounded(enrich.regular_grid(late, N.HOUR), ["average_boarding_times_minute"])


# ---- positions and shifts


@query
def row_index_events(spark, sf_dir):
    return row_index(V.event_rows(spark, sf_dir).select("ts", "event_id"), ["ts", "event_id"])


@query
def row_index_by_series(spark, sf_dir):
    events = V.event_rows(spark, sf_dir).select("user_id", "ts", "event_id")
    return row_index(events, ["ts", "event_id"], keys=["user_id"])


@query
def lag_features(spark, sf_dir):
    events = V.event_rows(spark, sf_dir).select("ts", "event_id", "value")
    return lagging.shifted_frame(events, "value", ["ts", "event_id"], lags=4)


@query
def lead_features(spark, sf_dir):
    events = V.event_rows(spark, sf_dir).select("ts", "event_id", "value")
    return lagging.shifted_frame(events, "value", ["ts", "event_id"], leads=4)


@query
def rolling_mean(spark, sf_dir):
    days = V.daily(spark, sf_dir).select("day", "total_value")
    frame = lagging.shifted_frame(days, "total_value", ["day"], window_size=4)
    return rounded(frame, ["rolling_mean_total_value_window_size_4"], 4)


@query
def rolling_mean_wide(spark, sf_dir):
    """A window of many buckets, over a long series with missing values."""
    value = F.when(F.col("event_id") % 1009 != 7, F.col("value"))
    events = V.event_rows(spark, sf_dir).select("ts", "event_id", value.alias("value"))
    frame = lagging.wide_rolling_mean(events, "value", ["ts", "event_id"], 700, bucket_rows=64)
    return rounded(frame, ["rolling_mean_value_window_size_700"], 6)


@query
def rolling_mean_wide_by_series(spark, sf_dir):
    events = V.event_rows(spark, sf_dir).select("user_id", "ts", "event_id", "value")
    frame = lagging.wide_rolling_mean(events, "value", ["ts", "event_id"], 3, ["user_id"], bucket_rows=2)
    return rounded(frame, ["rolling_mean_value_window_size_3"], 6)


@query
def lagged_and_rolling(spark, sf_dir):
    events = V.event_rows(spark, sf_dir).select("user_id", "ts", "event_id", "value")
    frame = lagging.shifted_frame(
        events, "value", ["ts", "event_id"], lags=2, leads=2, window_size=3, keys=["user_id"]
    )
    return rounded(frame, ["rolling_mean_value_window_size_3"], 4)


# ---- learning tables


def _flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = merged_table(clean_inputs(V.inputs(spark, sf_dir), *V.RANGE), V.CONFIG)
    return learning_table(merged, V.CONFIG)


@query
def supervised_frame(spark, sf_dir):
    """The flagship: seven inputs to 77 model inputs and a target six hours ahead."""
    frame = _flagship(spark, sf_dir)
    return rounded(frame.drop("series_rows"), ["average_waiting_times_treatment_minute"])


@query
def supervised_frame_by_series(spark, sf_dir):
    return V.daily_supervised(spark, sf_dir)


@query
def supervised_frame_events(spark, sf_dir):
    return V.event_supervised(spark, sf_dir)


@query
def supervised_frame_bounded_series(spark, sf_dir):
    """Hourly series of each event type; the bound is the length of the longest one."""
    by_type = materialise(
        V.events_by_hour(spark, sf_dir)
        .groupBy("event_type", N.HOUR)
        .agg(F.count(F.lit(1)).alias("events"), F.max("value").alias("peak"))
    )
    longest = by_type.groupBy("event_type").count().agg(F.max("count")).first()[0]
    return lagging.supervised_frame(
        by_type, [N.HOUR], ["events", "peak"], {"events": 3, "peak": 2}, 2, "events",
        keys=["event_type"], series_bound=longest,
    )


@query
def supervised_frame_missing(spark, sf_dir):
    """NaN is missing: rows that hold one, or see one, are left out."""
    value = F.when(F.col("event_id") % 53 == 7, float("nan")).otherwise(F.col("value"))
    events = V.event_rows(spark, sf_dir).select("ts", "event_id", value.alias("value"))
    return lagging.supervised_frame(events, ["ts", "event_id"], ["value"], {"value": 1}, 1, "value")


@query
def supervised_frame_known_lags(spark, sf_dir):
    """Lags are asked of a column that is not there: they are left out, the others stay."""
    events = V.event_rows(spark, sf_dir).select("ts", "event_id", "value")
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        return lagging.supervised_frame(events, ["ts", "event_id"], ["value"], {"value": 1, "absent": 2}, 1, "value")


@query
def scoring_inputs(spark, sf_dir):
    """Feature columns in another order are put in theirs; one too few or of another name is refused."""
    lines, order = V.table(spark, sf_dir, "lineitem").select("l_tax", "l_orderkey", "l_quantity"), ["l_quantity", "l_tax"]
    tables = {"reordered": lines, "too few": lines.drop("l_tax"), "renamed": lines.withColumnRenamed("l_tax", "tax")}
    told = []
    for name, df in tables.items():
        try:
            with warnings.catch_warnings():
                warnings.simplefilter("ignore")
                fits = clean.conform_features(df, order, ["l_orderkey"])
            verdict = ",".join(fits.columns)
        except ValueError:
            fits, verdict = df.where("false"), "refused"
        told.append(fits.agg(F.count(F.lit(1)).alias("rows"), F.sum("l_quantity").alias("quantity")).withColumns({"input": F.lit(name), "verdict": F.lit(verdict)}))
    return reduce(DataFrame.unionByName, told)


def _event_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chronological_split(V.event_supervised(spark, sf_dir))


def _daily_split(spark: SparkSession, sf_dir: str, daily: DataFrame | None = None) -> DataFrame:
    return chronological_split(V.daily_supervised(spark, sf_dir, daily))


EVENT_LABEL = f"future_{V.EVENT_HORIZON}_value"
EVENT_INPUTS = [*V.EVENT_FEATURES, *[f"lag_{i}_value" for i in (1, 2, 3)]]
DAILY_LABEL = f"future_{V.HORIZON}_order_count"
DAILY_INPUTS = [
    *V.DAILY_FEATURES, *[f"lag_{i}_{c}" for c, n in V.DAILY_LAGS.items() for i in range(1, n + 1)]
]


@query
def chronological_split_frame(spark, sf_dir):
    return _event_split(spark, sf_dir).select("event_id", "idx", "split")


@query
def chronological_split_by_series(spark, sf_dir):
    return _daily_split(spark, sf_dir).select("nation", "day", "idx", "split")


@query
def split_row_counts(spark, sf_dir):
    return split_counts(_flagship(spark, sf_dir).select("split"))


@query
def split_row_counts_by_series(spark, sf_dir):
    return split_counts(_daily_split(spark, sf_dir), ["nation"])


@query
def train_val_concat(spark, sf_dir):
    frame = train_and_validation(_event_split(spark, sf_dir))
    return frame.select("idx", "split", "value", EVENT_LABEL)


# ---- scaling


def _event_dataset(spark: SparkSession, sf_dir: str) -> Dataset:
    return scaled_dataset(_event_split(spark, sf_dir), EVENT_INPUTS, EVENT_LABEL, written=True)


def _daily_dataset(spark: SparkSession, sf_dir: str, by: Sequence[str] = ()) -> Dataset:
    return scaled_dataset(_daily_split(spark, sf_dir), DAILY_INPUTS, DAILY_LABEL, by, written=True)


@query
def nonbinary_columns(spark, sf_dir):
    train = materialise(_event_split(spark, sf_dir).where(F.col("split") == "train"))
    return scaling.column_profile(train, EVENT_INPUTS).select("column", "non_binary")


@query
def scaler_params(spark, sf_dir):
    return rounded(_event_dataset(spark, sf_dir).params, ["mean", "std"])


@query
def scaler_params_by_series(spark, sf_dir):
    # Means of few cents-values can lie exactly between two roundings: all of those go up.
    params = _daily_dataset(spark, sf_dir, ["nation"]).params
    return rounded(params.withColumns({c: F.col(c) + 1e-7 for c in ("mean", "std")}), ["mean", "std"], 4)


@query
def scaler_params_by_month(spark, sf_dir):
    """Parameters from moments of months, logged in two batches, one month a second time: as from all rows at once."""
    columns = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]
    lines = V.table(spark, sf_dir, "lineitem").withColumn("l_tax", F.when(F.col("l_tax") > 0.04, F.col("l_tax")))
    log = moments.moments_log(job_folder(spark), [T.StructField("l_linestatus", T.StringType())])
    late = F.col("l_shipdate") >= F.lit("1996-06-01")
    again = (F.col("l_shipdate") >= F.lit("1996-06-01")) & (F.col("l_shipdate") < F.lit("1996-07-01"))
    for chosen in (~late, late, again):
        log.append(moments.month_moments(lines.where(chosen), columns, "l_shipdate", ["l_linestatus"]))
    log.compact(spark)
    params = moments.fit_from_moments(log.read(spark), "l_extendedprice", ["l_linestatus"])
    return rounded(params, ["mean", "std"], 6)


@query
def scaled_frame(spark, sf_dir):
    dataset = _event_dataset(spark, sf_dir)
    scaled = [c + "_scaled" for c in [*EVENT_INPUTS, EVENT_LABEL]]
    return rounded(dataset.rows, scaled).select("idx", "split", *scaled)


@query
def scaled_frame_by_series(spark, sf_dir):
    dataset = _daily_dataset(spark, sf_dir, ["nation"])
    scaled = [c + "_scaled" for c in [*V.DAILY_FEATURES, DAILY_LABEL]]
    return rounded(dataset.rows, scaled).select("nation", "idx", "split", *scaled)


@query
def unscaled_frame(spark, sf_dir):
    dataset = _daily_dataset(spark, sf_dir, ["nation"])
    restored = scaling.unscale(
        dataset.rows, dataset.params, DAILY_LABEL, {DAILY_LABEL + "_scaled": "restored"}, ["nation"]
    )
    return rounded(restored, ["restored"]).select("nation", "idx", DAILY_LABEL, "restored")


@query
def feature_arrays(spark, sf_dir):
    """The exported arrays, one row per element."""
    arrays = _event_dataset(spark, sf_dir).arrays()
    elements = arrays.select("idx", "split", "y", F.posexplode("x").alias("position", "x"))
    wide = elements.select(
        "idx", "split", "position", F.col("x").cast("double").alias("x"),
        F.element_at("y", 1).cast("double").alias("y"),
    )
    return rounded(wide, ["x", "y"], 3)


# ---- evaluation


@query
def aligned_predictions(spark, sf_dir):
    """Truth and a shorter list of predictions, paired by position."""
    both = V.predictions(spark, sf_dir)
    truth = both.select("nation", "row_id", "y_true")
    made = both.where(F.col("row_id") >= 3).select(
        "nation", (F.col("row_id") - 3).alias("row_id"), "y_pred"
    )
    return evaluate.align(truth, made, by=["nation"])


METRICS = ["mae", "mse", "rmse", "r2"]


@query
def regression_metrics(spark, sf_dir):
    return rounded(evaluate.regression_metrics(V.predictions(spark, sf_dir)), METRICS)


@query
def regression_metrics_by_run(spark, sf_dir):
    return rounded(evaluate.regression_metrics(V.predictions(spark, sf_dir), ["nation"]), METRICS)


@query
def array_mean_prediction(spark, sf_dir):
    vectors = V.table(spark, sf_dir, "embeddings")
    return vectors.select("vec_id", F.round(S.array_mean(F.col("embedding")), 6).alias("y_pred"))


@query
def residual_profile(spark, sf_dir):
    profile = evaluate.residual_profile(V.predictions(spark, sf_dir), ["nation"])
    return rounded(profile, ["residual_mean", "residual_std"])


@query
def range_check(spark, sf_dir):
    narrowed = V.predictions(spark, sf_dir).withColumn(
        "y_pred", F.col("y_pred") * (F.col("nation") % 3 + F.lit(0.25))
    )
    return evaluate.range_check(narrowed, ["nation"])


def _damaged(y_pred: Column) -> Column:
    row = F.col("row_id")
    return (
        F.when(row % 97 == 13, float("nan")).when(row % 101 == 17, float("inf")).otherwise(y_pred - 2)
    )


@query
def prediction_issue_counts(spark, sf_dir):
    damaged = V.predictions(spark, sf_dir).withColumn("y_pred", _damaged(F.col("y_pred")))
    return evaluate.issue_counts(damaged, ["nation"])


@query
def finite_counts(spark, sf_dir):
    quantity = F.col("l_quantity")
    damaged = V.table(spark, sf_dir, "lineitem").select(
        "l_returnflag",
        F.when(quantity == 1, float("nan")).when(quantity == 2, float("-inf"))
        .when(quantity != 3, quantity).alias("quantity"),
        F.col("l_extendedprice").alias("price"),
    )
    return clean.finite_report(damaged, ["quantity", "price"], ["l_returnflag"])


@query
def nan_to_null_mean(spark, sf_dir):
    quantity = F.col("l_quantity")
    damaged = V.table(spark, sf_dir, "lineitem").select(
        "l_returnflag", F.when(quantity == 1, float("nan")).otherwise(quantity).alias("quantity")
    )
    means = nulls_for_nans(damaged).groupBy("l_returnflag").agg(
        F.count("quantity").alias("present"), F.avg("quantity").alias("mean_quantity")
    )
    return rounded(means, ["mean_quantity"])


def _repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = materialise(V.predictions(spark, sf_dir))
    shift = F.col("row_id") % 3 * (F.col("nation") % 5)
    runs = [first.withColumn("y_pred", F.col("y_pred") + shift * (0.0004 * n)) for n in range(5)]
    return evaluate.stack_runs(runs)


@query
def repeatability(spark, sf_dir):
    return rounded(evaluate.repeatability(_repeated(spark, sf_dir), by=["nation"]), ["max_std"])


def _model_ids(metrics: DataFrame) -> DataFrame:
    nation = F.col("nation")
    claimed = F.when(nation % 7 != 6, F.col("mae") + (nation % 2) * F.lit(0.5))
    number = nation.cast("string")
    name = F.concat(F.lit("reg_Persistence_6hours_order_count_dataset"), number, F.lit("_trial"), number)
    return metrics.select(
        "nation", F.concat(name, F.coalesce(F.concat(F.lit("_mae"), S.fixed4(claimed)), F.lit(""))).alias("model_id")
    )


@query
def validation(spark, sf_dir):
    """Verdict per nation; every fourth has damaged rows, some ids claim a wrong metric or none."""
    plain = materialise(V.predictions(spark, sf_dir))
    every_fourth = F.col("nation") % 4 == 3
    mixed = plain.withColumn(
        "y_pred", F.when(every_fourth, _damaged(F.col("y_pred"))).otherwise(F.col("y_pred"))
    )
    ids = _model_ids(evaluate.regression_metrics(plain, ["nation"]))
    gate = validation_gate(mixed, ids, ["nation"])
    return rounded(gate, [*METRICS, "expected_mae"]).withColumn("issues", F.array_join("issues", "; "))


class _TrainMean:
    """A model whose prediction is the mean of the scaled label: zero."""

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn("prediction", F.lit(0.0))


@query
def validation_by_series(spark, sf_dir):
    """Five runs of one model over all nations, a verdict each: equal runs have no spread."""
    dataset = _daily_dataset(spark, sf_dir, ["nation"])
    verdicts = validate_model(dataset, _TrainMean(), "reg_mean", by_series=True)
    both = verdicts.unionByName(
        validate_model(dataset, _TrainMean(), "reg_mean").withColumn("nation", F.lit(None).cast("int"))
    )
    plain = both.select("nation", "success", "mae", "rmse", "expected_mae", "max_std", "inconsistent")
    return rounded(plain, ["mae", "rmse", "max_std"], 4)


# ---- trials, datasets, scalers


@query
def trial_run_ids(spark, sf_dir):
    """Format every run id, read its parts back and compare the metric."""
    run = F.col("run_id")
    found = V.trials(spark, sf_dir).withColumn("found_mae", S.metric_in_name(run))
    return found.select(
        "run_id",
        "dataset_key",
        "found_mae",
        S.dataset_in_name(run).alias("found_dataset"),
        S.horizon_in_name(run).alias("found_horizon"),
        S.target_in_name(run).alias("found_target"),
        F.coalesce(F.abs(F.col("mae") - F.col("found_mae")) < 0.01, F.lit(False)).alias("matches"),
    )


@query
def grid_run_ids(spark, sf_dir):
    parts = [("depth", F.col("horizon")), ("leaf", F.col("l_quantity").cast("int"))]
    run = S.grid_run_id(
        F.col("started"), F.col("mae"), "RF", parts, F.col("dataset"), value_first=True
    )
    trials = V.trials(spark, sf_dir)
    return trials.select(
        "trial_num", "l_partkey", "l_suppkey", run.alias("grid_run_id"),
        S.fixed4_or_na(F.col("mae")).alias("mae_text"),
    )


@query
def covering_pairs(spark, sf_dir):
    """A grid over the values that lines have: for every two columns, the pairs of values that its maps hold."""
    lines = V.table(spark, sf_dir, "lineitem")
    columns = ["l_returnflag", "l_linestatus", "l_linenumber", "l_discount", "l_tax"]
    dictionary = materialise(categories.fit_categories(lines, columns))
    axes = {c: categories.fitted_values(dictionary, c) for c in columns}
    maps = spark.createDataFrame([tuple(m[c] for c in columns) for m in forecast.covering_grid(axes)], columns)
    found = [
        maps.select(F.lit(a).alias("first"), F.lit(b).alias("second"), F.struct(a, b).alias("pair")) for a, b in combinations(columns, 2)
    ]
    few = F.lit(maps.count() <= 2 * max(len(x) * len(y) for x, y in combinations(axes.values(), 2)))
    pairs = reduce(DataFrame.unionAll, [f.withColumn("pair", F.to_json("pair")) for f in found])
    return pairs.groupBy("first", "second").agg(F.count_distinct("pair").alias("pairs")).withColumn("few_maps", few)


@query
def trial_minutes(spark, sf_dir):
    ended = F.col("started") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.col("l_quantity").cast("int"), (F.col("l_discount") * 100).cast("int")
    )
    minutes = S.minutes_between(F.col("started"), ended)
    spent = V.trials(spark, sf_dir).withColumn("minutes", F.round(minutes * 60).cast("long"))
    return spent.groupBy("model", "status").agg(
        F.count(F.lit(1)).alias("trials"), F.sum("minutes").alias("seconds")
    )


@query
def best_trial(spark, sf_dir):
    order = ["trial_num", "l_linenumber", "l_partkey", "l_suppkey"]
    return catalog.best_trial(V.trials(spark, sf_dir), order=order, keep=["run_id"])


@query
def dataset_catalog(spark, sf_dir):
    return catalog.dataset_catalog(V.trials(spark, sf_dir))


@query
def model_dataset_location(spark, sf_dir):
    """Every run resolved to its dataset by exact key, with the dataset's trial counts."""
    trials = V.trials(spark, sf_dir)
    models = trials.select(F.col("run_id").alias("model_id"), "trial_num")
    datasets = catalog.dataset_catalog(trials.where(F.col("status") == catalog.COMPLETED))
    located = catalog.locate_datasets(models, datasets)
    return located.groupBy("target", "horizon", "dataset").agg(
        F.count(F.lit(1)).alias("models"), F.max("trials").alias("trials")
    )


@query
def scaler_lookup(spark, sf_dir):
    """One scaler per nation from three catalogues, then the predictions un-scaled with each.

    The full catalogue has target scalers, the second scalers that name their
    dataset, the third neither: every step of the preference decides once.
    """
    daily = materialise(V.daily_by_nation(spark, sf_dir))  # both learning tables read it
    split = _daily_split(spark, sf_dir, daily)
    params = scaled_dataset(split, DAILY_INPUTS, DAILY_LABEL, ["nation"], written=True).params
    dataset = F.concat(F.lit("dataset"), F.col("nation").cast("string"))
    is_target = F.col("role") == scaling.TARGET
    is_lag = F.col("column").startswith("lag_")
    name = (
        F.when(is_target, F.concat(F.lit("target_scaler_"), dataset))
        .when(is_lag, F.concat(F.lit("scaler_"), F.col("column")))
        .otherwise(F.concat(F.lit("scaler_"), dataset, F.lit("_"), F.col("column")))
    )
    catalogues = F.when(is_target, F.array(F.lit("full"))).otherwise(
        F.when(is_lag, F.array(F.lit("full"), F.lit("features"), F.lit("lags")))
        .otherwise(F.array(F.lit("full"), F.lit("features")))
    )
    scalers = params.select(
        F.explode(catalogues).alias("catalogue"), "nation", dataset.alias("dataset"),
        name.alias("scaler"), "mean", "std",
    )
    chosen = catalog.choose_scaler(scalers, ["catalogue", "nation", "dataset"])
    each = F.collect_list(F.struct("catalogue", "dataset", "scaler", "mean", "std"))
    by_nation = chosen.groupBy("nation").agg(each.alias("chosen"))
    restored = lookup(V.predictions(spark, sf_dir, daily), by_nation, ["nation"]).select("*", F.inline("chosen"))
    unscaled = S.unstandardise(F.col("y_pred"), F.col("mean"), F.col("std"))
    return restored.select(
        "catalogue", "nation", "dataset", "scaler", "row_id", F.round(unscaled, 3).alias("y_pred")
    )


@query
def test_file_datasets(spark, sf_dir):
    """The dataset that the name of an exported file carries."""
    trials = V.trials(spark, sf_dir)
    name = F.when(F.col("status") == catalog.COMPLETED, F.concat(F.lit("test_X_"), "dataset", F.lit(".npy")))
    found = S.dataset_in_test_file(F.coalesce(name, F.col("dataset")))
    return trials.groupBy(found.alias("found")).agg(F.count(F.lit(1)).alias("files"))


# ---- models that SQL can state: one tree, one split

STUMPS = {
    "RF": {"n_estimators": 1, "max_depth": 1, "bootstrap": False, "max_bins": 64},
    "GBT": {"n_estimators": 1, "max_depth": 1, "max_bins": 64},
}
STUMP_KEY = ("price", 1, "dataset1")


def _price_dataset(spark: SparkSession, sf_dir: str) -> Dataset:
    digit = F.col("l_orderkey") % 10
    rows = V.table(spark, sf_dir, "lineitem").select(
        F.monotonically_increasing_id().alias("idx"),
        F.when(digit < 7, "train").when(digit == 7, "val").otherwise("test").alias("split"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("price"),
    )
    return scaled_dataset(rows, ["quantity"], "price")


def _searched(spark: SparkSession, sf_dir: str, family: str) -> tuple[Dataset, str, str, object]:
    dataset, out = _price_dataset(spark, sf_dir), job_folder(spark)
    trials = search(dataset, STUMP_KEY, family, [STUMPS[family]], out)
    run = catalog.best_trial(trials).first().run_id
    return dataset, out, run, forecast.load_model(f"{out}/models/{run}")


def _stump_forecast(spark: SparkSession, sf_dir: str, family: str) -> DataFrame:
    """Searched, then evaluated twice and once on another split: every row is there once."""
    dataset, out, run, model = _searched(spark, sf_dir, family)
    for split in ("test", "test", "val"):
        evaluate_run(dataset, model, run, out, split)
    saved = read_predictions(spark, out).where(F.col("run_id") == run)
    return saved.groupBy("split", F.round("y_pred", 2).alias("y_pred")).agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.sum("y_true"), 1).alias("total")
    )


@query
def rf_stump_forecast(spark, sf_dir):
    return _stump_forecast(spark, sf_dir, "RF")


@query
def gbt_stump_forecast(spark, sf_dir):
    return _stump_forecast(spark, sf_dir, "GBT")


@query
def registered_model_verdict(spark, sf_dir):
    """From a searched id to its dataset, its target scaler and a verdict that knows the claimed error."""
    dataset, out, run, model = _searched(spark, sf_dir, "RF")
    known = catalog.registered(spark, out)
    target = dataset.params.where(F.col("role") == scaling.TARGET)
    place = target.select(
        *[F.lit(v).alias(k) for k, v in zip(("target", "horizon", "dataset"), STUMP_KEY, strict=True)],
        "mean", "std",
    )
    located = catalog.locate_datasets(known.select(F.col("run_id").alias("model_id")), place, known)
    verdict = validate_model(dataset, model, run, out=out)
    judged = located.withColumns(
        {c: verdict.select(c).scalar() for c in ("success", "mae", "mae_matches", "max_std", "inconsistent")}
    )
    return rounded(judged.drop("model_id"), ["mean", "std", "mae", "max_std"], 2)


@query
def trial_outcomes(spark, sf_dir):
    """How a sound, a damaged, an empty and a failing trial are logged."""
    plain = materialise(V.predictions(spark, sf_dir))
    frames = {
        "sound": plain,
        "damaged": plain.withColumn("y_pred", F.when(F.col("row_id") == 3, float("nan")).otherwise(F.col("y_pred"))),
        "empty": plain.where(F.col("row_id") < 0),
    }
    rows = [(name, *(trial_metrics(df)[c] for c in ("status", "rows", "mae", "reason"))) for name, df in frames.items()]
    failing = search(_price_dataset(spark, sf_dir), STUMP_KEY, "RF", [{"max_depth": 99}], job_folder(spark)).first()
    rows.append(("failing", failing.status, None, failing.mae, failing.reason and "given"))
    logged = spark.createDataFrame(rows, "trial string, status string, rows long, mae double, reason string")
    return rounded(logged, ["mae"])


# ---- larger models: row checks only


def _tree_forecast(spark: SparkSession, sf_dir: str, family: str, params: dict) -> DataFrame:
    dataset = _daily_dataset(spark, sf_dir)
    train = dataset.split("train", "val")
    # The fit passes over its rows many times: written once, and only what it reads.
    train = materialise(train.select(*[c for c in train.columns if c.endswith("_scaled")]))
    model = forecast.model_pipeline(family, params, DAILY_INPUTS, DAILY_LABEL).fit(train)
    scored = forecast.predict(dataset.split("test"), model, dataset.params, DAILY_LABEL)
    return scored.select(
        "nation", F.col("idx").alias("row_id"),
        F.col(DAILY_LABEL).cast("double").alias("y_true"), "y_pred",
    )


@query
def rf_forecast(spark, sf_dir):
    params = {"n_estimators": 20, "max_depth": 6, "min_samples_leaf": 2, "max_features": "sqrt"}
    return _tree_forecast(spark, sf_dir, "RF", params)


@query
def gbt_forecast(spark, sf_dir):
    params = {"n_estimators": 10, "max_depth": 4, "eta": 0.1, "subsample": 0.8}
    return _tree_forecast(spark, sf_dir, "GBT", params)

"""From raw hourly inputs to a split, scaled learning table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from datetime import datetime

from pyspark.sql import DataFrame, Row, SparkSession, functions as F, types as T

from hourloom.functions.scalar import WEATHER_TYPES, map_total
from hourloom.operators import clean, enrich
from hourloom.operators.catalog import dataset_info
from hourloom.operators.lagging import supervised_frame
from hourloom.operators.lookup import lookup
from hourloom.operators.scaling import FEATURE, feature_arrays, fit_scaler, scale
from hourloom.operators.split import chronological_split
from hourloom.session import materialise, scratch
from hourloom.sources import schemas as N
from hourloom.sources.config import JobConfig
from hourloom.sources.readers import read_inputs
from hourloom.sources.published import Release, retire
from hourloom.sources.writers import DATASET_KEY, dataset_log

# The range every input is cut to.
RANGE_START = "2018-12-31 12:00:00"
RANGE_END = "2023-07-01 20:00:00"

HOURLY = ("census", "patients", "boarding", "treatment")
ROUNDED = ("patients", "census", "boarding", "holidays", "away_games", "home_games")
RENAMES = {"census": N.CENSUS_RENAMES, "boarding": N.BOARDING_RENAMES}


def clean_inputs(
    inputs: Mapping[str, DataFrame],
    start: str = RANGE_START,
    end: str = RANGE_END,
    rounded: Sequence[str] = ROUNDED,
) -> dict[str, DataFrame]:
    """Rename, parse, cut to the range, drop id lists and round; treatment is not rounded."""
    cleaned = {}
    for name, df in inputs.items():
        df = clean.rename(df, RENAMES.get(name, {}))
        df = clean.filter_range(clean.parse_time(df, N.HOUR), N.HOUR, start, end)
        df = clean.drop_if_present(df, *N.ID_LIST_COLUMNS)
        cleaned[name] = clean.round_numbers(df) if name in rounded else df
    return cleaned


def merge_inputs(
    cleaned: Mapping[str, DataFrame],
    keys: Sequence[str] = (),
    weather_types: Sequence[str] = WEATHER_TYPES,
) -> DataFrame:
    """Join the hourly tables and the calendars, then add weather flags and calendar fields."""
    df = enrich.merge_hourly([cleaned[name] for name in HOURLY], [*keys, N.HOUR])
    df = enrich.flag_hours(df, cleaned["away_games"], N.HOUR, N.AWAY_GAME_FLAG)
    df = enrich.flag_hours(df, cleaned["home_games"], N.HOUR, N.HOME_GAME_FLAG)
    df = enrich.flag_dates(df, cleaned["holidays"], N.HOUR, N.HOLIDAY_FLAG)
    df = enrich.add_weather(df, values=weather_types)
    return enrich.add_calendar(df, N.HOUR)


def merged_table(
    cleaned: Mapping[str, DataFrame],
    config: JobConfig,
    keys: Sequence[str] = (),
    fit_scope: str = "all",
    tie_breaker: Sequence[str] = (),
    series_bound: int | None = None,
    regular: bool = False,
) -> DataFrame:
    """The merged table with the extreme flag, written once because the flag reads it twice.

    An hour that occurs twice in a series is refused, unless ``tie_breaker``
    names the columns that order its rows. The threshold uses all rows;
    ``fit_scope="train"`` uses the rows up to the last train row of each series.
    """
    merged = merge_inputs(cleaned, keys)
    if config.exclude:
        merged = clean.exclude_window(merged, N.HOUR, config.exclude_from, config.exclude_to)
    merged = materialise(merged)
    clean.assert_unique(merged, [*keys, N.HOUR, *tie_breaker])
    if series_bound is not None:
        clean.assert_whole_hours(merged, N.HOUR)
    fit_on = None
    if fit_scope == "train":
        fit_on = train_rows(merged, config, keys, tie_breaker, series_bound, regular)
    flagged = enrich.add_extreme_flag(merged, config.target_feature, keys, fit_on)
    return clean.drop_if_present(flagged, "weather_type", "weather_description")


def train_rows(
    merged: DataFrame,
    config: JobConfig,
    keys: Sequence[str] = (),
    tie_breaker: Sequence[str] = (),
    series_bound: int | None = None,
    regular: bool = False,
) -> DataFrame:
    """Rows of each series up to its last train row in the learning table.

    Which rows are kept and how they are split does not depend on the extreme
    flag, so a learning table without it tells where the train rows end.
    """
    unflagged = merged.withColumn("extreme_indicator", F.lit(0))
    frame = learning_table(unflagged, config, keys, series_bound, regular, tie_breaker)
    place = F.struct(N.HOUR, *tie_breaker)
    last = frame.where(F.col("split") == "train").groupBy(*keys).agg(F.max(place).alias("_last"))
    placed = lookup(merged, last, keys) if keys else merged.withColumn("_last", last.scalar())
    return placed.where(place <= F.col("_last")).drop("_last")


def learning_table(
    merged: DataFrame,
    config: JobConfig,
    keys: Sequence[str] = (),
    series_bound: int | None = None,
    regular: bool = False,
    tie_breaker: Sequence[str] = (),
) -> DataFrame:
    """Select the configured features, add lags and the label, and split by time."""
    if regular:
        merged = enrich.regular_grid(merged, N.HOUR, keys)
    frame = supervised_frame(
        merged,
        [N.HOUR, *tie_breaker],
        config.features,
        config.lag_features,
        config.future_hours,
        config.target_feature,
        keys,
        series_bound,
    )
    return chronological_split(frame, config.train_fraction, config.validation_fraction)


def feature_order(
    frame: DataFrame, config: JobConfig, keys: Sequence[str] = (), tie_breaker: Sequence[str] = ()
) -> list[str]:
    """Every model input in table order: the features, then their lags."""
    order = {N.HOUR, *tie_breaker} - set(config.features)
    outside = {*keys, *order, "idx", "series_rows", "split", config.target_column, *DATASET_KEY}
    return [c for c in frame.columns if c not in outside]


@dataclass(frozen=True)
class Dataset:
    """A prepared dataset: its rows (plain and ``_scaled`` columns), parameters and input order."""

    rows: DataFrame
    params: DataFrame
    features: list[str]
    label: str
    keys: tuple[str, ...] = ()

    def split(self, *names: str) -> DataFrame:
        return self.rows.where(F.col("split").isin(*names))

    def arrays(self) -> DataFrame:
        """Float32 arrays of the scaled features and label; one value per feature and step."""
        return feature_arrays(
            self.rows,
            [c + "_scaled" for c in self.features],
            self.label + "_scaled",
            [*self.keys, "idx", "split"],
        )


def scaled_dataset(
    frame: DataFrame,
    features: Sequence[str],
    label: str,
    keys: Sequence[str] = (),
    written: bool = False,
) -> Dataset:
    """Write the split table, fit the parameters on its train rows, and scale all rows with them.

    ``written``: the frame is cheap to read again, as learning tables are whose
    rows were written with their buckets.
    """
    frame = frame if written else materialise(frame)
    params = materialise(fit_scaler(frame.where(F.col("split") == "train"), features, label, keys))
    rows = scale(frame, params, [*features, label], keys)
    return Dataset(rows, params, list(features), label, tuple(keys))


def hours_between(start: str, end: str) -> int:
    """Hours of a closed range: the most rows an hourly series without repeated hours can have."""
    return int((datetime.fromisoformat(end) - datetime.fromisoformat(start)).total_seconds() // 3600) + 1


def keyed_schemas(keys: Sequence[str]) -> dict[str, T.StructType]:
    """The input schemas, with text keys in front of the hourly tables."""
    added = [T.StructField(k, T.StringType()) for k in keys]
    return {
        name: T.StructType([*added, *schema.fields]) if name in HOURLY else schema
        for name, schema in N.INPUTS.items()
    }


def prepare(
    spark: SparkSession,
    config: JobConfig,
    paths: Mapping[str, str],
    out: str,
    start: str = RANGE_START,
    end: str = RANGE_END,
    fit_scope: str = "all",
    regular: bool = False,
    keys: Sequence[str] = (),
    whole_hours: bool = False,
    tie_breaker: Sequence[str] = (),
    formats: str | Mapping[str, str] = "csv",
) -> Dataset:
    """Run the whole preparation, write every table under ``out`` and return the written dataset.

    With ``keys`` the hourly inputs hold many series; thresholds, shifts, splits
    and parameters are then taken per series, in the same jobs. An hour that
    occurs twice is refused unless ``tie_breaker`` orders its rows. With
    ``whole_hours`` times between two hours are refused as well, so no series can
    be longer than the range: each is windowed whole and the rows are not sorted
    across the cluster. All tables are those of one new version, which counts
    when its description is written behind them: until then, and if the job
    fails, a dataset of the same key stays as it was. The version before it
    stays for who reads it, older ones and intermediate tables are deleted.
    """
    if whole_hours and tie_breaker:
        raise ValueError("hours that repeat do not bound a series")
    bound = hours_between(start, end) if whole_hours else None
    key = (config.target_feature, config.future_hours, config.dataset_number)
    release = Release(spark, out, dict(zip(DATASET_KEY, key, strict=True)))
    with scratch(spark):
        cleaned = clean_inputs(read_inputs(spark, paths, keyed_schemas(keys), formats), start, end)
        merged = merged_table(cleaned, config, keys, fit_scope, tie_breaker, bound, regular)
        frame = learning_table(merged, config, keys, bound, regular, tie_breaker)
        features = feature_order(frame, config, keys, tie_breaker)
        dataset = scaled_dataset(frame, features, config.target_column, keys, written=bound is None)
        release.write(merged, "merged")
        release.write(dataset.params, "scalers")
        # From here on the written rows are read: scaling runs once.
        dataset = replace(dataset, rows=release.write(dataset.rows, "datasets", ("split",)))
        release.write(dataset.arrays(), "tensors", ("split",))
        release.commit(dataset_log(out), describe(dataset, config, paths))
    retire(spark, out, dataset_log(out), release.key)
    return load_dataset(spark, out, key, keys)


def published_dataset(spark: SparkSession, out: str, key: tuple[str, int, str]) -> tuple[Release, Row]:
    """The tables of the dataset's last published version, and its description."""
    info = dataset_info(spark, out, *key)
    return Release(spark, out, dict(zip(DATASET_KEY, key, strict=True)), info["version"], list(info["tables"])), info


def load_dataset(
    spark: SparkSession, out: str, key: tuple[str, int, str], keys: Sequence[str] = ()
) -> Dataset:
    """A dataset written earlier; reading one split of it opens only that split's folders."""
    release, info = published_dataset(spark, out, key)
    params = release.read("scalers").select(*keys, *[f.name for f in N.SCALER_PARAMS.fields])
    return Dataset(release.read("datasets"), params, list(info["feature_order"]), info["target_column"], tuple(keys))


def describe(dataset: Dataset, config: JobConfig, sources: Mapping[str, str]) -> DataFrame:
    """The one-row description of a dataset."""
    counts = F.col("split")
    sizes = dataset.rows.agg(
        F.count(F.lit(1)).alias("total_samples"),
        *[F.count_if(counts == s).alias(f"{s}_rows") for s in ("train", "val", "test")],
    )
    names = dataset.params.where(F.col("role") == FEATURE).agg(F.collect_set("column").alias("c"))
    in_order = F.array_intersect(
        F.array(*[F.lit(c) for c in dataset.features]), names.select("c").scalar()
    )
    lag_map = F.create_map(*[F.lit(x) for pair in config.lag_features.items() for x in pair])
    used = F.map_filter("lag_features_config", lambda c, _: F.array_contains(F.lit(list(config.features)), c))
    fixed = {
        "target": config.target_feature,
        "horizon": config.future_hours,
        "dataset": config.dataset_number,
        "excluded_from": config.exclude_from if config.exclude else None,
        "excluded_to": config.exclude_to if config.exclude else None,
        "target_column": config.target_column,
        "train_fraction": config.train_fraction,
        "validation_fraction": config.validation_fraction,
        "original_features": len(config.features),
        "config_json": config.as_json(),
    }
    return sizes.withColumns(
        {
            **{name: F.lit(value) for name, value in fixed.items()},
            "generated_at": F.current_timestamp(),
            "sources": F.array(*[F.lit(p) for p in sources.values()]),
            "lag_features_config": lag_map,
            "feature_order": F.array(*[F.lit(c) for c in dataset.features]),
            "scaled_features": in_order,
            "tensor_shape": F.array(F.lit(len(dataset.features)), F.lit(1)),
        }
    ).withColumn("lag_features", map_total(used).cast("int"))

"""The job configuration."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import Row, SparkSession

from hourloom.sources.schemas import JOB_CONFIG


@dataclass(frozen=True)
class JobConfig:
    dataset_number: str
    features: tuple[str, ...]
    target_feature: str
    future_hours: int
    lag_features: dict[str, int] = field(default_factory=dict)
    exclude: bool = False
    exclude_from: str | None = None
    exclude_to: str | None = None
    window_size: int = 0
    train_fraction: float = 0.7
    validation_fraction: float = 0.15

    def __post_init__(self) -> None:
        if self.target_feature not in self.features:
            raise ValueError(
                f"the target '{self.target_feature}' is not among the features"
            )

    @property
    def target_column(self) -> str:
        return f"future_{self.future_hours}_{self.target_feature}"

    def as_json(self) -> str:
        """The document this configuration can be read back from, defaults filled in."""
        document = {
            "dataset_number": self.dataset_number,
            "features": list(self.features),
            "target_feature": self.target_feature,
            "covid_deletion": self.exclude,
            "covid_filter_start": self.exclude_from,
            "covid_filter_end": self.exclude_to,
            "lag_features_config": self.lag_features,
            "future_hours": self.future_hours,
            "window_size": self.window_size,
            "train_fraction": self.train_fraction,
            "validation_fraction": self.validation_fraction,
        }
        return json.dumps(document)


def config_from_row(row: Row) -> JobConfig:
    """Apply the defaults; without a lag map the target gets ``lag_N`` (24) lags."""

    def need(name: str):
        if row[name] is None:
            raise ValueError(f"the job configuration has no '{name}'")
        return row[name]

    def default(name: str, value):
        return value if row[name] is None else row[name]

    exclude = default("covid_deletion", False)
    lags = dict(row["lag_features_config"] or {})
    return JobConfig(
        dataset_number=need("dataset_number"),
        features=tuple(need("features")),
        target_feature=need("target_feature"),
        future_hours=need("future_hours"),
        lag_features=lags or {row["target_feature"]: default("lag_N", 24)},
        exclude=exclude,
        exclude_from=need("covid_filter_start") if exclude else row["covid_filter_start"],
        exclude_to=need("covid_filter_end") if exclude else row["covid_filter_end"],
        window_size=default("window_size", 0),
        train_fraction=default("train_fraction", 0.7),
        validation_fraction=default("validation_fraction", 0.15),
    )


def read_config(spark: SparkSession, path: str) -> JobConfig:
    """Read one JSON document; the explicit schema keeps the lag map a map."""
    rows = (
        spark.read.schema(JOB_CONFIG)
        .option("multiLine", True)
        .option("mode", "FAILFAST")
        .json(path)
        .take(2)
    )
    if len(rows) != 1:
        raise ValueError(f"{path} must hold exactly one job configuration")
    return config_from_row(rows[0])

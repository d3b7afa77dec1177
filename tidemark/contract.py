"""Declarations the operators work from: the column contract of a table and the models to register."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame

# The accepted spellings of configuration fields.
DATE_KINDS = ("auto", "parts", "yyyymmdd_int", "unix_days", "unix_seconds")
DIRECTIONS = ("minimize", "maximize")
SELECTS = ("latest", "first")
SOURCES = ("experiment", "run", "file")

# Working column that holds the resolved date of a feature row.
EVENT_DATE = "_event_date"


@dataclass(frozen=True)
class TableContract:
    """Table names and what their columns mean."""

    feature_table: str
    baseline_table: str
    actual_table: str | None = None
    date_kind: str = "auto"
    date_col: str | None = None
    date_parts: Sequence[str] | None = None
    date_format: str | None = None
    min_valid_date: str | None = None
    join_keys: Sequence[str] = ()
    label_col: str = "target"
    prediction_col: str = "prediction_raw"
    test_months: int = 3
    exclude_from_features: Sequence[str] = ()

    def __post_init__(self) -> None:
        if self.date_kind not in DATE_KINDS:
            raise ValueError(f"unknown date_kind {self.date_kind!r}; use one of {DATE_KINDS}")
        if self.date_kind == "parts" and len(self.date_parts or ()) != 3:
            raise ValueError("date_kind 'parts' needs three date_parts: year, month, day")
        if self.date_kind != "parts" and not self.date_col:
            raise ValueError(f"date_kind {self.date_kind!r} needs date_col")
        for source in (self.feature_table, self.actual_table):
            if source and _same_place(source, self.baseline_table):
                raise ValueError(f"the baseline would overwrite its own input {source!r}")

    @property
    def date_sources(self) -> list[str]:
        """Raw columns the event date is made from."""
        return list(self.date_parts) if self.date_kind == "parts" else [self.date_col]

    @property
    def keys(self) -> list[str]:
        """Join keys; asking for them when none are set is an error."""
        if not self.join_keys:
            raise ValueError("join_keys is empty: name the columns features and actuals share")
        return list(self.join_keys)


def _same_place(left: str, right: str) -> bool:
    """Whether two references are one table, or one folder lies in the other."""
    a, b = (ref.removeprefix("file:").rstrip("/") + "/" for ref in (left, right))
    return a == b or ("/" in a[:-1] and "/" in b[:-1] and (a.startswith(b) or b.startswith(a)))


@dataclass(frozen=True)
class ModelSpec:
    """One model to register and how to find and compare its run."""

    model_name: str
    metric: str | None = None
    metric_pattern: str | None = None
    metric_select: str = "latest"
    metric_direction: str = "minimize"
    improvement_threshold: float = 0.0
    search_max_results: int = 200
    source: str = "experiment"
    experiment_path: str | None = None
    run_id: str | None = None
    model_path: str | None = None
    model_format: str | None = None
    metrics: Mapping[str, float] = field(default_factory=dict)
    params: Mapping[str, str] = field(default_factory=dict)
    tags: Mapping[str, str] = field(default_factory=dict)
    create_baseline: bool = True

    def check(self) -> ModelSpec:
        """Raise on the first rule the spec breaks; return the spec itself otherwise."""
        rules = [
            (self.metric_direction in DIRECTIONS, f"metric_direction must be one of {DIRECTIONS}"),
            (self.improvement_threshold >= 0, "improvement_threshold must not be negative"),
            (bool(self.metric or self.metric_pattern), "set metric or metric_pattern"),
            (self.metric_select in SELECTS, f"metric_select must be one of {SELECTS}"),
            (self.source in SOURCES, f"source must be one of {SOURCES}"),
            (self.source != "experiment" or bool(self.experiment_path), "experiment_path is missing"),
            (self.source != "run" or bool(self.run_id), "run_id is missing"),
            (self.source != "file" or bool(self.model_path), "model_path is missing"),
            (self.source != "file" or bool(self.metric), "a file needs an exact metric name"),
            (self.source != "file" or self.metric in self.metrics, "a file needs a value for its metric"),
        ]
        for holds, message in rules:
            if not holds:
                raise ValueError(f"model {self.model_name!r}: {message}")
        return self


@dataclass(frozen=True)
class PipelineSpec:
    """A use case: its tables, its models and the experiment they inherit."""

    name: str
    catalog: str
    schema: str
    experiment_path: str
    tables: TableContract
    models: Mapping[str, ModelSpec]

    def resolved_models(self) -> dict[str, ModelSpec]:
        """Checked specs, with the pipeline's experiment filled in where a spec has none."""
        if not self.models:
            raise ValueError(f"pipeline {self.name!r} has no models")
        out = {}
        for key, spec in self.models.items():
            if spec.source == "experiment" and not spec.experiment_path:
                spec = replace(spec, experiment_path=self.experiment_path)
            out[key] = spec.check()
        return out


def require_columns(df: DataFrame, columns: Sequence[str], table: str) -> None:
    """Raise when a table lacks columns; names the table, the missing and the present ones."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"table {table!r} lacks {missing}; it has {sorted(df.columns)}")


def same_key_types(features: DataFrame, actuals: DataFrame, keys: Sequence[str]) -> None:
    """Refuse join keys that are text on one side only: Spark would quietly cast them."""
    left, right = dict(features.dtypes), dict(actuals.dtypes)
    for key in keys:
        if (left[key] == "string") != (right[key] == "string"):
            raise TypeError(f"join key {key!r} is {left[key]} in the features and {right[key]} in the actuals")

"""Registering a batch of models: from specs to decisions and a new registry state."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.contract import ModelSpec
from tidemark.functions.values import finite, merge_maps
from tidemark.operators.artifacts import classify_artifacts, require_files
from tidemark.operators.registry import (
    SKIPPED, aliases_after, champion_lookup, decide, registration_results, version_tags, versions_after,
)
from tidemark.operators.runs import (
    claimed_metrics, file_run_id, file_runs, last_values, match_experiment, newest_runs, resolve_metric_per_spec,
)
from tidemark.session import materialise

SPEC_SCHEMA = (
    "spec string, model_name string, source string, experiment string, run_id string, model_path string, "
    "model_format string, metric string, metric_pattern string, metric_select string, metric_direction string, "
    "improvement_threshold double, search_max_results int, metrics map<string,double>, "
    "params map<string,string>, tags map<string,string>"
)
_REQUEST = ["metric", "metric_pattern", "metric_select", "metric_direction", "improvement_threshold"]


@dataclass(frozen=True)
class Grown:
    """A table of a registry to which rows were only added: all of it, the folders it was read from and the rows since."""

    whole: DataFrame
    folders: tuple[str, ...]
    added: DataFrame | None = None


@dataclass(frozen=True)
class Registry:
    """The tables registration reads, and after it the ones to be written as the new state."""

    runs: DataFrame
    run_metrics: DataFrame
    versions: DataFrame
    aliases: DataFrame
    version_tags: DataFrame | None = None
    # The number of the committed state these tables were read from.
    state: int = 0
    # What of these tables is stored already, by table; it counts for no other frame than its ``whole``.
    grown: Mapping[str, Grown] = field(default_factory=dict)

    def stored(self, name: str) -> Grown | None:
        grown = self.grown.get(name)
        return grown if grown is not None and grown.whole is getattr(self, name) else None

    def with_rows(self, name: str, whole: DataFrame, added: DataFrame) -> dict[str, Grown]:
        """The entry of ``grown`` for a table that has become ``whole`` by the rows ``added``."""
        before = self.stored(name)
        if before is None or before.whole.dtypes != whole.dtypes:
            return {}
        added = added.select(*[F.col(c).cast(kind) for c, kind in whole.dtypes])
        return {name: Grown(whole, before.folders, added if before.added is None else before.added.unionByName(added))}


@dataclass(frozen=True)
class Registration:
    results: DataFrame
    decisions: DataFrame
    registry: Registry


def specs_frame(spark: SparkSession, models: Mapping[str, ModelSpec]) -> DataFrame:
    """Checked specs as a table."""
    rows = []
    for key, spec in models.items():
        spec.check()
        rows.append((
            key, spec.model_name, spec.source, spec.experiment_path, spec.run_id, spec.model_path, spec.model_format,
            spec.metric, spec.metric_pattern, spec.metric_select, spec.metric_direction,
            float(spec.improvement_threshold), spec.search_max_results, dict(spec.metrics),
            {k: str(v) for k, v in spec.params.items()}, dict(spec.tags),
        ))
    return spark.createDataFrame(rows, SPEC_SCHEMA)


def resolve_candidates(
    specs: DataFrame, runs: DataFrame, run_metrics: DataFrame, logged_at: dt.datetime | Column,
    default_experiment: str | None = None, files: DataFrame | None = None,
) -> DataFrame:
    """The run each spec stands for and the metric it is judged by, or an error text.

    All columns of the spec come back with run_id, resolved_key, value and error. The three kinds of
    source are three branches of one plan. Specs without an experiment take the default one; file sources
    use the claimed metrics and the run they are logged as; given the ``files`` that there are, others are errors.
    """
    if default_experiment is not None:
        specs = specs.withColumn("experiment", F.coalesce("experiment", F.lit(default_experiment)))
    keep = ["spec", "model_name", "source", *_REQUEST]
    given = specs.filter("source = 'run'")
    named = given.select("spec", "run_id", *_REQUEST[:3])
    there = runs.join(named.select("run_id"), "run_id", "left_semi").select("run_id", F.lit(True).alias("_found"))
    resolved = resolve_metric_per_spec(named.join(run_metrics, "run_id"), ["spec"])
    by_run = given.join(there, "run_id", "left").join(resolved, "spec", "left").select(
        *keep, "run_id", "resolved_key", "value",
        F.when(F.col("_found").isNull(), F.concat(F.lit("no run '"), "run_id", F.lit("'"))).alias("error"),
    )
    by_file = _from_files(specs.filter("source = 'file'"), keep, _column(logged_at), files)
    by_experiment = _from_experiments(specs.filter("source = 'experiment'"), runs, run_metrics, keep)
    found = by_run.unionByName(by_file).unionByName(by_experiment)
    pattern = F.concat(F.lit("pattern '"), "metric_pattern", F.lit("'"))
    nothing = F.concat(F.lit("no metric for "), F.coalesce("metric", pattern), F.lit(" in run '"), "run_id", F.lit("'"))
    unusable = F.concat(F.lit("metric '"), "resolved_key", F.lit("' of run '"), "run_id", F.lit("' is not a number"))
    missing = F.when(F.col("resolved_key").isNull(), nothing).when(F.col("value").isNull(), unusable)
    error = F.coalesce("error", missing)
    return found.withColumn("error", error)


def _column(at: dt.datetime | Column) -> Column:
    return at if isinstance(at, Column) else F.lit(at)


def _from_files(specs: DataFrame, keep: list[str], logged_at: Column, files: DataFrame | None) -> DataFrame:
    known = classify_artifacts(specs.drop("run_id"), "model_path", "model_format")
    if files is not None:
        known = require_files(known, files, "model_path")
    run_id = F.when(F.col("error").isNull(), file_run_id("model_name", "model_path", logged_at))
    value = finite(F.try_element_at("metrics", F.col("metric")))
    key = F.when(F.map_contains_key("metrics", F.col("metric")), F.col("metric"))
    return known.select(*keep, run_id.alias("run_id"), key.alias("resolved_key"), value.alias("value"), "error")


def _from_experiments(specs: DataFrame, runs: DataFrame, run_metrics: DataFrame, keep: list[str]) -> DataFrame:
    """Specs that ask the same of the same experiment share one search.

    The requests, and the newest runs that compete, are stored: with their true size known, Spark
    broadcasts them to the scan of the metrics while they are small and shuffles once they are not.
    """
    found = match_experiment(specs.select(F.col("experiment").alias("wanted")), runs)
    matched = specs.join(found, F.col("experiment") == F.col("wanted"), "left").drop("experiment", "run_id", "wanted")
    request = ["matched", *_REQUEST[:4], "search_max_results"]
    asked = materialise(matched.filter("matched IS NOT NULL").select(*request).distinct(), "requests")
    best = _best_exact(asked.filter("metric_pattern IS NULL"), runs, run_metrics, request).unionByName(
        _best_by_pattern(asked.filter("metric_pattern IS NOT NULL"), runs, run_metrics, request)
    )
    best = best.select(*[F.col(c).alias(f"_{c}") for c in request], "run_id", "resolved_key", "value")
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in request]
    pattern = F.concat(F.lit("pattern '"), "metric_pattern", F.lit("'"))
    error = F.when(F.col("matched").isNull(), "experiment not found").when(
        F.col("run_id").isNull(),
        F.concat(F.lit("no run in '"), "matched", F.lit("' has a metric for "), F.coalesce("metric", pattern)),
    )
    return matched.join(best, same, "left").select(*keep, "run_id", "resolved_key", "value", error.alias("error"))


def _winner(scored: DataFrame, request: list[str]) -> DataFrame:
    """Best value per request; of equal values the newest run, then the smaller id."""
    rank = F.when(F.col("metric_direction") == "maximize", -F.col("value")).otherwise(F.col("value"))
    age = -F.unix_micros(F.col("start_time").cast("timestamp"))
    place = F.struct(rank.alias("rank"), age.alias("age"), "run_id", "resolved_key", "value")
    best = scored.filter("value IS NOT NULL").groupBy(*request).agg(F.min(place).alias("_best"))
    return best.select(*request, "_best.run_id", "_best.resolved_key", "_best.value")


def _best_exact(asked: DataFrame, runs: DataFrame, run_metrics: DataFrame, request: list[str]) -> DataFrame:
    """All runs of the experiment compete, whatever their age.

    The lowest and the highest value of an experiment and key are found once, however many requests ask for them.
    """
    wanted = asked.select(F.col("matched").alias("experiment"), F.col("metric").alias("key")).distinct()
    pool = runs.join(wanted.select("experiment").distinct(), "experiment", "left_semi").select("experiment", "run_id", "start_time")
    entries = run_metrics.join(wanted.select("key").distinct(), "key", "left_semi").join(pool.select("run_id"), "run_id", "left_semi")
    scored = last_values(entries).filter("value IS NOT NULL").join(pool, "run_id").join(wanted, ["experiment", "key"], "left_semi")
    age = -F.unix_micros(F.col("start_time").cast("timestamp"))
    ends = [F.min(F.struct(v.alias("rank"), age.alias("age"), "run_id", "value")) for v in (F.col("value"), -F.col("value"))]
    best = scored.groupBy("experiment", "key").agg(ends[0].alias("low"), ends[1].alias("high"))
    found = asked.join(best, [asked.matched == best.experiment, asked.metric == best.key])
    chosen = F.when(F.col("metric_direction") == "maximize", F.col("high")).otherwise(F.col("low"))
    found = found.withColumn("_best", chosen)
    return found.select(*request, "_best.run_id", F.col("key").alias("resolved_key"), "_best.value")


def _best_by_pattern(asked: DataFrame, runs: DataFrame, run_metrics: DataFrame, request: list[str]) -> DataFrame:
    """The newest runs compete; the limit comes before the search for the metric."""
    pool = runs.join(asked.select(F.col("matched").alias("experiment")).distinct(), "experiment", "left_semi")
    widest = asked.agg(F.max("search_max_results")).first()[0] or 0  # one number, so that the limit is a literal
    recent = materialise(newest_runs(pool.select("experiment", "run_id", "start_time"), widest), "recent-runs")
    competing = asked.join(recent, (asked.matched == recent.experiment) & (recent["rank"] <= asked.search_max_results))
    entries = competing.join(run_metrics, "run_id")
    return _winner(resolve_metric_per_spec(entries, [*request, "run_id", "start_time"]), request)


def register(
    specs: DataFrame, registry: Registry, registered_at: dt.datetime | Column, catalog: str | None = None,
    schema: str | None = None, fail_fast: bool = False, files: DataFrame | None = None,
) -> Registration:
    """Decide for every spec of a batch and build the registry state that follows.

    The candidates and the decisions, one row per spec, are stored as they are made, because results,
    versions, aliases and tags all start from them.

    One spec per model name; repeated names become errors, since the second would have to see what the
    first did. A failing spec becomes a row with an error and touches nothing; ``fail_fast`` raises.
    With ``files`` (column path, see ``list_artifacts``) a model file that is not among them is such an error.
    """
    candidates = resolve_candidates(specs, registry.runs, registry.run_metrics, registered_at, files=files)
    repeated = specs.groupBy("model_name").agg((F.count(F.lit(1)) > 1).alias("_repeated"))
    candidates = candidates.join(repeated, "model_name").withColumn(
        "error", F.coalesce("error", F.when(F.col("_repeated"), "several specs for one model in a batch"))
    ).drop("_repeated")
    candidates = materialise(candidates, "candidates")
    looked_up = champion_lookup(candidates, registry.aliases, registry.versions, registry.run_metrics)
    decisions = materialise(decide(looked_up, registry.versions), "decisions")
    new_runs = file_runs(
        specs.filter("source = 'file'").withColumns({"path": F.col("model_path"), "format": F.col("model_format")}),
        registered_at,
    )
    # A file seen before at the very same time is the run that is already there.
    named = F.create_map(F.lit("mlflow.runName"), F.col("run_name"))
    new_runs = new_runs.withColumn("tags", merge_maps(named, F.col("tags")))
    logged = new_runs.join(decisions.filter(F.col("scenario") != SKIPPED).select("run_id"), "run_id", "left_semi")
    new_runs, new_metrics = logged.select(*registry.runs.columns), claimed_metrics(logged)
    runs, run_metrics = registry.runs.unionByName(new_runs), registry.run_metrics.unionByName(new_metrics)
    results = registration_results(decisions, catalog, schema)
    if fail_fast:
        failed = results.filter("error IS NOT NULL").select("registered_model_name", "error").first()
        if failed:
            raise ValueError(f"{failed.registered_model_name}: {failed.error}")
    tags = new_tags = version_tags(decisions, runs, run_metrics, registered_at)
    if registry.version_tags is not None:
        tags = registry.version_tags.unionByName(tags)
    grown = [("runs", runs, new_runs), ("run_metrics", run_metrics, new_metrics), ("version_tags", tags, new_tags)]
    after = Registry(
        runs, run_metrics, versions_after(decisions, registry.versions, registered_at),
        aliases_after(decisions, registry.aliases), tags, registry.state,
        {name: entry for table in grown for name, entry in registry.with_rows(*table).items()},
    )
    return Registration(results, decisions, after)

"""Tracked runs as tables: finding runs, resolving their metric and logging new ones.

``runs``: run_id, experiment, parent_run_id, start_time, params, tags.
``run_metrics``: run_id, key, step, value.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.metrics import METRICS
from tidemark.functions.values import finite, merge_maps, utc_text
from tidemark.operators.artifacts import classify_artifacts, require_files
from tidemark.operators.scan import newest
from tidemark.session import materialise


def newest_runs(runs: DataFrame, limit: int | Column = 200) -> DataFrame:
    """The newest runs of every experiment, ranked; runs started together are ordered by id."""
    order = [F.col("start_time").desc_nulls_last(), F.col("run_id")]
    return newest(runs, ["experiment"], order, limit)


def last_values(run_metrics: DataFrame) -> DataFrame:
    """One value per run and key: that of the last step; the larger of two for one step, NaN counts least."""
    by_step = F.struct("step", finite(F.col("value")).alias("value"))
    latest = run_metrics.groupBy("run_id", "key").agg(F.max(by_step).alias("_last"))
    return latest.select("run_id", "key", F.col("_last.value").alias("value"))


def _entries(run_metrics: DataFrame, metric: str | None, pattern: str | None, select: str) -> DataFrame:
    """Metric rows that can matter, with the request beside them; the filter reaches the scan."""
    candidate = F.lit(False)
    if metric is not None:
        candidate = candidate | (F.col("key") == metric)
    if pattern is not None:
        candidate = candidate | F.col("key").rlike(pattern)
    return run_metrics.filter(candidate).withColumns(
        {
            "metric": F.lit(metric).cast("string"),
            "metric_pattern": F.lit(pattern).cast("string"),
            "metric_select": F.lit(select),
        }
    )


def resolve_metric(
    run_metrics: DataFrame, metric: str | None = None, pattern: str | None = None, select: str = "latest"
) -> DataFrame:
    """The metric each run is judged by: run_id, resolved_key, value. Runs without one are absent."""
    return resolve_metric_per_spec(_entries(run_metrics, metric, pattern, select), ["run_id"])


def resolve_metric_per_spec(entries: DataFrame, keys: list[str]) -> DataFrame:
    """The same for metric rows that carry their own metric, metric_pattern and metric_select.

    The exact name beats any pattern match; among matches the last or the first key in code-point order
    counts, and within a key the last step. Both picks are mergeable, so a run with very many entries is
    reduced where its rows lie.
    """
    key, step, value, select = (F.col(c) for c in ("key", "step", "value", "metric_select"))
    exact = F.coalesce(key == F.col("metric"), F.lit(False))
    matched = exact | F.coalesce(F.rlike(key, F.col("metric_pattern")), F.lit(False))
    # Of values logged twice for one step the larger counts, in both picks; NaN counts least.
    number, nothing = finite(value), F.lit(float("inf"))
    last = F.struct(exact.alias("exact"), key.alias("key"), step.alias("step"), number.alias("value"))
    first = F.struct((~exact).alias("other"), key.alias("key"), (-step).alias("back"), F.coalesce(-number, nothing).alias("minus"))
    picked = entries.groupBy(*keys).agg(
        F.max(F.when(matched & (select == "latest"), last)).alias("_latest"),
        F.min(F.when(matched & (select == "first"), first)).alias("_first"),
    )
    found = picked.select(
        *keys,
        F.coalesce("_latest.key", "_first.key").alias("resolved_key"),
        F.coalesce("_latest.value", F.when(F.col("_first.minus") != nothing, -F.col("_first.minus"))).alias("value"),
    )
    return found.filter("resolved_key IS NOT NULL")


def available_metrics(run_metrics: DataFrame) -> DataFrame:
    """The metric keys every run has, one row each."""
    return run_metrics.select("run_id", "key").distinct()


def _signed(direction: str) -> Column:
    return F.col("value") if direction == "minimize" else -F.col("value")


def best_run(
    runs: DataFrame,
    run_metrics: DataFrame,
    metric: str | None = None,
    pattern: str | None = None,
    select: str = "latest",
    direction: str = "minimize",
    recent: int = 200,
    top_level_only: bool = False,
) -> DataFrame:
    """The best run of every experiment: experiment, run_id, resolved_key, value.

    With a pattern only the newest ``recent`` runs compete, and the limit comes before the search for
    the metric. With an exact name alone all runs compete and one without the metric can only win where
    no run has it. Of equal values the newest run wins. The winner is a mergeable minimum, not a sort.
    """
    pool = runs.filter("parent_run_id IS NULL") if top_level_only else runs
    own = ["experiment", "run_id", "start_time"]
    if pattern is not None:
        # Stored, so that Spark knows how small the pool is before it plans the scan of the metrics.
        pool = materialise(newest_runs(pool.select(*own), recent).select(*own), "recent-runs")
        entries = _entries(run_metrics, metric, pattern, select)
        # Only the entries of the competing runs are grouped.
        scored = resolve_metric_per_spec(pool.join(entries, "run_id"), own).filter("value IS NOT NULL")
    else:
        scored = pool.select(*own).join(resolve_metric(run_metrics, metric), "run_id", "left")
    # Timestamps have no sign to flip: order by the negated microseconds to prefer the newest.
    age = -F.unix_micros(F.col("start_time").cast("timestamp"))
    place = F.struct(
        F.col("value").isNull().alias("missing"), _signed(direction).alias("rank"), age.alias("age"),
        "run_id", "resolved_key", "value",
    )
    best = scored.groupBy("experiment").agg(F.min(place).alias("_best"))
    return best.select("experiment", "_best.run_id", "_best.resolved_key", "_best.value")


def match_experiment(wanted: DataFrame, experiments: DataFrame) -> DataFrame:
    """Find experiments by path, with or without a trailing slash: wanted, matched (NULL if none).

    The spelling as given wins, then the one without, then the one with a slash.
    """
    bare = lambda c: F.rtrim(F.col(c), F.lit("/"))
    left = wanted.select("wanted").distinct().withColumn("_bare", bare("wanted"))
    right = experiments.select(F.col("experiment").alias("matched")).distinct().withColumn("_bare", bare("matched"))
    found = left.join(right, "_bare", "left")
    rank = (
        F.when(F.col("matched") == F.col("wanted"), 0)
        .when(F.col("matched") == F.col("_bare"), 1)
        .when(F.col("matched") == F.concat(F.col("wanted"), F.lit("/")), 2)
    )
    # Other spellings, such as two slashes, are different experiments.
    best = found.groupBy("wanted").agg(F.min(F.when(rank.isNotNull(), F.struct(rank.alias("r"), "matched"))).alias("_m"))
    return best.select("wanted", F.col("_m.matched").alias("matched"))


def log_run_metrics(split_metrics: DataFrame, primary: str = "rmse", best: bool = False) -> DataFrame:
    """The metric rows training runs log: one per split and metric, and the weighted mean.

    Rows of different runs, models and trials (columns ``run_id``, ``model_name`` and ``trial_no``, as far as they are
    there) stay apart, so that one plan logs any number of them. All rows come from one pass over the split metrics:
    each split gives its own entries and its share of the weighted mean, and every entry is a mean over the rows of its key.
    """
    prefix = "best_" if best else ""
    one = F.lit(1.0)
    owner = [c for c in ("run_id", "model_name", "trial_no") if c in split_metrics.columns]

    def entry(key: Column, value: Column, weight: Column) -> Column:
        return F.struct(key.alias("key"), value.cast("double").alias("v"), weight.alias("w"))

    own = [entry(F.concat(F.lit(f"{prefix}{m}_"), F.col("split_name")), F.col(m), one) for m in METRICS]
    overall = entry(F.lit(f"{prefix}weighted_mean_{primary}"), F.col(primary), F.col("weight"))
    rows = split_metrics.select(*owner, F.inline(F.array(*own, overall)))
    mean = F.try_divide(F.sum(F.col("v") * F.col("w")), F.sum("w"))
    complete = F.count("v") == F.count(F.lit(1))
    return rows.groupBy(*owner, "key").agg(F.when(complete, mean).alias("value"))


def file_run_id(model_name: str, path: str, logged_at: Column) -> Column:
    """The id of the run a model file is logged as: a digest of model, file and time.

    Logging the same file later makes a new run; computing the plan again does not.
    """
    return F.sha2(F.concat_ws("\n", model_name, path, _stamp(logged_at)), 256)


def _stamp(at: Column) -> Column:
    return F.translate(utc_text(at), " -:", "_")


def file_runs(claims: DataFrame, logged_at: dt.datetime | Column, files: DataFrame | None = None) -> DataFrame:
    """Runs for models that arrive as a file with claimed metrics.

    ``claims``: model_name, path, format (override or NULL), experiment, metrics, params, tags. User tags
    override the standard ones. Files of unknown format come back with an ``error`` and no run id, and so do files that
    are not among ``files`` (column path, see ``list_artifacts``), if that is given.
    """
    known = classify_artifacts(claims, "path", "format")
    if files is not None:
        known = require_files(known, files)
    when = logged_at if isinstance(logged_at, Column) else F.lit(logged_at)
    standard = F.create_map(
        F.lit("model_type"), F.col("resolved_format"),
        F.lit("source_artifact"), F.col("path"),
        F.lit("registered_via"), F.lit("file"),
    )
    own = F.coalesce("tags", F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>")))
    return known.select(
        F.when(F.col("error").isNull(), file_run_id("model_name", "path", when)).alias("run_id"),
        "experiment",
        F.lit(None).cast("string").alias("parent_run_id"),
        when.cast("timestamp").alias("start_time"),
        "params",
        merge_maps(F.map_filter(standard, lambda _, v: v.isNotNull()), own).alias("tags"),
        F.concat_ws("_", "model_name", "resolved_format", _stamp(when)).alias("run_name"),
        "metrics",
        "error",
    )


def claimed_metrics(new_runs: DataFrame) -> DataFrame:
    """The claimed metrics of file runs as rows of ``run_metrics``."""
    rows = new_runs.filter("error IS NULL").select("run_id", F.explode("metrics").alias("key", "value"))
    return rows.select("run_id", "key", F.lit(0).alias("step"), F.col("value").cast("double").alias("value"))

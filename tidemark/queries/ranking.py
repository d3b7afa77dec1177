"""Queries on tracked runs, their metrics and model files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.values import is_better
from tidemark.operators import runs as r
from tidemark.operators.artifacts import classify_artifacts
from tidemark.plans.registration import resolve_candidates
from tidemark.queries import views as v
from tidemark.queries.catalog import query
from tidemark.session import materialise


@query("resolve_metric", "SELECT run_id, resolved_key, round(value, 6) AS value FROM f_stamped", "f_stamped")
def latest_key(spark: SparkSession, sf: str) -> DataFrame:
    resolved = r.resolve_metric(v.run_metrics(spark, sf), pattern=v.STAMPED)
    return resolved.withColumn("value", F.round("value", 6))


@query(
    "resolve_metric_first",
    "SELECT run_id, coalesce(max(key) FILTER (key = 'test_rmse'), min(key)) AS resolved_key, "
    "round(coalesce(max(value) FILTER (key = 'test_rmse'), arg_min(value, key)), 6) AS value FROM f_run_metrics "
    "WHERE key = 'test_rmse' OR regexp_matches(key, '^rmse_val_') GROUP BY run_id",
    "f_run_metrics",
)
def first_key(spark: SparkSession, sf: str) -> DataFrame:
    resolved = r.resolve_metric(v.run_metrics(spark, sf), "test_rmse", v.STAMPED, "first")
    return resolved.withColumn("value", F.round("value", 6))


@query("available_metrics", "SELECT DISTINCT run_id, key FROM f_run_metrics", "f_run_metrics")
def available(spark: SparkSession, sf: str) -> DataFrame:
    return r.available_metrics(v.run_metrics(spark, sf))


@query(
    "recent_runs",
    "SELECT * FROM (SELECT experiment, run_id, CAST(row_number() OVER (PARTITION BY experiment ORDER BY start_time DESC, run_id) AS INT) AS rank "
    "FROM f_runs) WHERE rank <= 200",
    "f_runs",
)
def recent(spark: SparkSession, sf: str) -> DataFrame:
    return r.newest_runs(v.runs(spark, sf), 200).select("experiment", "run_id", "rank")


_BEST = (
    "SELECT experiment, run_id, resolved_key, round(value, 6) AS value FROM (SELECT *, row_number() OVER (PARTITION BY experiment "
    "ORDER BY {order}, start_time DESC, run_id) AS place FROM {source}) WHERE place = 1"
)


@query(
    "best_run_pattern",
    _BEST.format(
        order="value",
        source="(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY experiment ORDER BY start_time DESC, run_id) AS age FROM f_runs) "
        "JOIN f_stamped USING (run_id) WHERE age <= 200)",
    ),
    "f_runs f_stamped",
)
def best_pattern(spark: SparkSession, sf: str) -> DataFrame:
    best = r.best_run(v.runs(spark, sf), v.run_metrics(spark, sf), pattern=v.STAMPED)
    return best.withColumn("value", F.round("value", 6))


@query(
    "best_run_exact",
    _BEST.format(
        order="value NULLS LAST",
        source="(SELECT r.*, m.key AS resolved_key, m.value FROM f_runs r LEFT JOIN "
        "(SELECT * FROM f_run_metrics WHERE key = 'test_rmse') m USING (run_id))",
    ),
    "f_runs f_run_metrics",
)
def best_exact(spark: SparkSession, sf: str) -> DataFrame:
    best = r.best_run(v.runs(spark, sf), v.run_metrics(spark, sf), metric="test_rmse")
    return best.withColumn("value", F.round("value", 6))


@query(
    "match_experiment",
    f"SELECT wanted, arg_min(experiment, spelling) AS matched FROM (SELECT w.wanted, e.experiment, CASE WHEN experiment = wanted THEN 0 "
    f"WHEN experiment = rtrim(wanted, '/') THEN 1 WHEN experiment = wanted || '/' THEN 2 END AS spelling FROM "
    f"(SELECT DISTINCT {v.WANTED[0]} FROM events) w LEFT JOIN (SELECT DISTINCT {v.EXPERIMENTS[0]} FROM events) e "
    f"ON rtrim(w.wanted, '/') = rtrim(e.experiment, '/')) GROUP BY wanted",
)
def matched(spark: SparkSession, sf: str) -> DataFrame:
    events = v.table(spark, sf, "events")
    return r.match_experiment(events.selectExpr(*v.WANTED), events.selectExpr(*v.EXPERIMENTS))


_AT = "20240201_000000"


@query(
    "file_runs",
    "SELECT sha256('m' || p_partkey || chr(10) || path || chr(10) || '" + _AT + "') AS run_id, resolved_format AS model_type, path AS source_artifact, "
    "'file' AS registered_via, 'test_rmse' AS key, p_retailprice AS value FROM f_formats WHERE resolved_format IS NOT NULL",
    "f_formats",
)
def from_files(spark: SparkSession, sf: str) -> DataFrame:
    claims = v.artifacts(spark, sf).select(
        F.concat(F.lit("m"), F.col("p_partkey").cast("string")).alias("model_name"), "path", "format",
        F.lit("/exp/files").alias("experiment"),
        F.create_map(F.lit("test_rmse"), F.col("p_retailprice")).alias("metrics"),
        F.lit(None).cast("map<string,string>").alias("params"),
        F.create_map(F.lit("brand"), F.col("p_brand")).alias("tags"),
    )
    logged = r.file_runs(claims, v.registered_at()).filter("error IS NULL")
    tags = [F.col("tags")[t].alias(t) for t in ("model_type", "source_artifact", "registered_via")]
    return logged.select("run_id", *tags, F.explode("metrics").alias("key", "value"))


@query(
    "artifact_formats",
    "SELECT path, resolved_format, family, CASE WHEN resolved_format IS NOT NULL THEN NULL WHEN format IS NOT NULL THEN "
    "'unknown format ''' || format || ''', known: catboost, joblib, lightgbm, pickle, xgboost' ELSE 'cannot tell the format from extension ''' || ext || "
    "''', known: .bst, .cb, .cbm, .joblib, .json, .model, .pickle, .pkl, .txt, .ubj' END AS error FROM f_formats",
    "f_formats",
)
def formats(spark: SparkSession, sf: str) -> DataFrame:
    known = classify_artifacts(v.artifacts(spark, sf), "path", "format")
    return known.select("path", "resolved_format", "family", "error")


@query(
    "is_better",
    f"SELECT event_id, CASE WHEN champion_value IS NULL THEN true WHEN champion_value = 0 THEN gain > 0 "
    f"ELSE gain / abs(champion_value) >= threshold END AS better FROM (SELECT *, CASE direction WHEN 'minimize' THEN champion_value - new_value "
    f"ELSE new_value - champion_value END AS gain FROM (SELECT {', '.join(v.COMPARISONS)} FROM events))",
)
def better(spark: SparkSession, sf: str) -> DataFrame:
    pairs = v.table(spark, sf, "events").selectExpr(*v.COMPARISONS)
    verdict = is_better(F.col("new_value"), F.col("champion_value"), F.col("direction"), F.col("threshold"))
    return pairs.select("event_id", verdict.alias("better"))


RESOLVED_SQL = f"""
specs AS (SELECT {', '.join(v.SPECS)} FROM events GROUP BY user_id),
wanted AS (SELECT s.*, e.experiment AS matched FROM specs s LEFT JOIN (SELECT DISTINCT experiment FROM f_runs) e
  ON rtrim(s.experiment, '/') = rtrim(e.experiment, '/')),
aged AS (SELECT *, row_number() OVER (PARTITION BY experiment ORDER BY start_time DESC, run_id) AS age FROM f_runs),
pool AS (
  SELECT w.spec, w.metric_direction, a.run_id, a.start_time,
    CASE WHEN w.metric_pattern IS NULL THEN t.key WHEN w.metric_select = 'first' THEN s.first_key ELSE s.resolved_key END AS resolved_key,
    CASE WHEN w.metric_pattern IS NULL THEN t.value WHEN w.metric_select = 'first' THEN s.first_value ELSE s.value END AS value
  FROM wanted w JOIN aged a ON a.experiment = w.matched AND (w.metric_pattern IS NULL OR a.age <= w.search_max_results)
  LEFT JOIN f_stamped s ON s.run_id = a.run_id LEFT JOIN f_run_metrics t ON t.run_id = a.run_id AND t.key = w.metric),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY spec ORDER BY CASE metric_direction WHEN 'maximize' THEN -value ELSE value END,
  start_time DESC, run_id) AS place FROM pool WHERE value IS NOT NULL) WHERE place = 1),
resolved AS (
  SELECT w.spec, w.model_name, w.source, w.metric, w.metric_pattern, w.metric_select, w.metric_direction, w.improvement_threshold,
    b.run_id, b.resolved_key, b.value, CASE WHEN w.matched IS NULL THEN 'experiment not found' WHEN b.run_id IS NULL THEN
      'no run in ''' || w.matched || ''' has a metric for ' || coalesce(w.metric, 'pattern ''' || w.metric_pattern || '''') END AS error
  FROM wanted w LEFT JOIN best b USING (spec) WHERE w.source = 'experiment'
  UNION ALL
  SELECT spec, model_name, source, metric, metric_pattern, metric_select, metric_direction, improvement_threshold, run_id, k, x,
    CASE WHEN found IS NULL THEN 'no run ''' || run_id || '''' WHEN k IS NULL THEN
      'no metric for ' || coalesce(metric, 'pattern ''' || metric_pattern || '''') || ' in run ''' || run_id || '''' END
  FROM (SELECT w.*, r.run_id AS found,
      CASE WHEN t.key IS NOT NULL THEN t.key WHEN w.metric_select = 'first' THEN s.first_key ELSE s.resolved_key END AS k,
      CASE WHEN t.key IS NOT NULL THEN t.value WHEN w.metric_select = 'first' THEN s.first_value ELSE s.value END AS x
    FROM wanted w LEFT JOIN f_runs r USING (run_id) LEFT JOIN f_stamped s ON s.run_id = r.run_id
    LEFT JOIN f_run_metrics t ON t.run_id = r.run_id AND t.key = w.metric WHERE w.source = 'run')
  UNION ALL
  SELECT spec, model_name, source, metric, metric_pattern, metric_select, metric_direction, improvement_threshold,
    CASE WHEN model_path NOT LIKE '%.onnx' THEN sha256(model_name || chr(10) || model_path || chr(10) || '{_AT}') END, 'claimed_rmse', claimed,
    CASE WHEN model_path LIKE '%.onnx' THEN 'cannot tell the format from extension ''.onnx'', known: .bst, .cb, .cbm, .joblib, .json, .model, .pickle, .pkl, .txt, .ubj' END
  FROM wanted WHERE source = 'file')
"""


@query(
    "resolve_candidates",
    "SELECT spec, run_id, resolved_key, round(value, 6) AS value, error FROM (WITH " + RESOLVED_SQL + " SELECT * FROM resolved)",
    "f_runs f_stamped f_run_metrics",
)
def candidates(spark: SparkSession, sf: str) -> DataFrame:
    found = resolve_candidates(
        materialise(v.specs(spark, sf), "specs"), v.runs(spark, sf), v.run_metrics(spark, sf), v.registered_at()
    )
    return found.select("spec", "run_id", "resolved_key", F.round("value", 6).alias("value"), "error")

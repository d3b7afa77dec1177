"""Queries on the registry: decisions, aliases, versions and promotion histories."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.contract import ModelSpec, PipelineSpec, TableContract
from tidemark.functions.values import minute_text, qualified_name
from tidemark.operators import registry as g
from tidemark.operators.runs import resolve_metric
from tidemark.operators.scoring import Scorer
from tidemark.plans.registration import Registry, register
from tidemark.plans.run import load_registry, run_pipeline, save_registry
from tidemark.queries import views as v
from tidemark.queries.catalog import query
from tidemark.queries.ranking import RESOLVED_SQL
from tidemark.session import materialise, scratch_path
from tidemark.sources.tables import load_table, write_replacing


def _resolved(spark: SparkSession, sf: str, run_metrics: DataFrame) -> DataFrame:
    """The newest candidate per model with its own metric."""
    # Stored, so that its size decides how the metrics are searched; only those of these runs are grouped.
    latest = materialise(v.latest_candidates(spark, sf), "latest")
    own = resolve_metric(run_metrics.join(latest.select("run_id"), "run_id", "left_semi"), pattern=v.STAMPED)
    found = latest.join(own, "run_id", "left")
    missing = F.when(F.col("resolved_key").isNull(), F.concat(F.lit("no metric in run "), "run_id"))
    return found.withColumn("error", missing)


def _champions(spark: SparkSession, sf: str, versions: DataFrame, run_metrics: DataFrame | None = None) -> DataFrame:
    """``run_metrics``: those of the tables as stored files, if there are any."""
    run_metrics = v.run_metrics(spark, sf) if run_metrics is None else run_metrics
    return g.champion_lookup(_resolved(spark, sf, run_metrics), v.aliases(spark, sf), versions, run_metrics)


def _versions(spark: SparkSession, sf: str) -> DataFrame:
    """The version table as stored files, the form a registry has."""
    return materialise(v.versions(spark, sf), "versions")


def _decisions(spark: SparkSession, sf: str, versions: DataFrame, run_metrics: DataFrame | None = None) -> DataFrame:
    return materialise(g.decide(_champions(spark, sf, versions, run_metrics), versions), "decisions")


@query(
    "champion_lookup",
    "SELECT model_name, run_id, champion_version, champion_run_id, champion_key, round(champion_value, 6) AS champion_value FROM f_champions",
    "f_champions",
)
def champions(spark: SparkSession, sf: str) -> DataFrame:
    return _champions(spark, sf, v.versions(spark, sf)).select(
        "model_name", "run_id", "champion_version", "champion_run_id", "champion_key",
        F.round("champion_value", 6).alias("champion_value"),
    )


@query(
    "skip_registered",
    "SELECT model_name, run_id FROM f_candidates c WHERE EXISTS (SELECT 1 FROM f_versions v WHERE v.model_name = c.model_name AND v.run_id = c.run_id)",
    "f_candidates f_versions",
)
def skipped(spark: SparkSession, sf: str) -> DataFrame:
    return g.already_registered(v.candidates(spark, sf), v.versions(spark, sf)).select("model_name", "run_id")


@query(
    "new_candidates",
    "SELECT model_name, run_id FROM f_candidates c WHERE NOT EXISTS (SELECT 1 FROM f_versions v WHERE v.model_name = c.model_name AND v.run_id = c.run_id)",
    "f_candidates f_versions",
)
def fresh(spark: SparkSession, sf: str) -> DataFrame:
    return g.not_registered(v.candidates(spark, sf), v.versions(spark, sf)).select("model_name", "run_id")


@query("decide_promotions", "SELECT model_name, run_id, scenario, new_version FROM f_decisions", "f_decisions")
def decided(spark: SparkSession, sf: str) -> DataFrame:
    versions = v.versions(spark, sf)
    decided = g.decide(_champions(spark, sf, versions), versions)
    return decided.select("model_name", "run_id", "scenario", "new_version")


_VERSIONS_AFTER = (
    "SELECT model_name, version, run_id, created_at FROM f_versions UNION ALL "
    f"SELECT model_name, new_version, run_id, TIMESTAMP '{v.REGISTERED_AT}' FROM f_decisions WHERE new_version IS NOT NULL"
)


@query(
    "versions_after",
    f"SELECT model_name, version, run_id, strftime(created_at, '%Y-%m-%d %H:%M') AS created FROM ({_VERSIONS_AFTER})",
    "f_versions f_decisions",
)
def versions_after(spark: SparkSession, sf: str) -> DataFrame:
    versions = _versions(spark, sf)
    after = g.versions_after(_decisions(spark, sf, versions), versions, v.registered_at())
    return after.select("model_name", "version", "run_id", minute_text(F.col("created_at")).alias("created"))


@query(
    "aliases_after",
    "SELECT model_name, alias, version FROM f_aliases a WHERE NOT EXISTS (SELECT 1 FROM f_decisions d WHERE d.model_name = a.model_name AND "
    "((a.alias = 'champion' AND scenario IN ('first_registration', 'promoted')) OR (a.alias = 'challenger' AND scenario IN ('promoted', 'challenger')))) "
    "UNION ALL SELECT model_name, 'champion', new_version FROM f_decisions WHERE scenario IN ('first_registration', 'promoted') "
    "UNION ALL SELECT model_name, 'challenger', CASE scenario WHEN 'promoted' THEN champion_version ELSE new_version END FROM f_decisions "
    "WHERE scenario IN ('promoted', 'challenger')",
    "f_aliases f_decisions",
)
def aliases_after(spark: SparkSession, sf: str) -> DataFrame:
    return g.aliases_after(_decisions(spark, sf, _versions(spark, sf)), v.aliases(spark, sf))


@query(
    "version_tags",
    "SELECT d.model_name, new_version AS version, key, CAST(m.value AS VARCHAR) AS value FROM f_decisions d JOIN f_run_metrics m USING (run_id) "
    "WHERE new_version IS NOT NULL UNION ALL SELECT model_name, new_version, t.key, t.value FROM "
    "(SELECT d.*, event_type FROM f_decisions d JOIN f_runs USING (run_id) WHERE new_version IS NOT NULL), LATERAL (VALUES ('model_type', event_type), ('run_name', 'N/A'), "
    "('role', CASE scenario WHEN 'challenger' THEN 'challenger' ELSE 'champion' END), ('promoted_from', CASE scenario WHEN 'promoted' THEN 'new_registration' END), "
    "('replaced_version', CASE scenario WHEN 'promoted' THEN CAST(champion_version AS VARCHAR) END), "
    "('current_champion_version', CASE scenario WHEN 'challenger' THEN CAST(champion_version AS VARCHAR) END)) t(key, value) WHERE t.value IS NOT NULL",
    "f_decisions f_run_metrics f_runs",
)
def tags(spark: SparkSession, sf: str) -> DataFrame:
    return g.version_tags(_decisions(spark, sf, _versions(spark, sf)), v.runs(spark, sf), v.run_metrics(spark, sf))


@query(
    "version_descriptions",
    "SELECT model_name, new_version AS version, concat_ws(chr(10), "
    "CASE scenario WHEN 'first_registration' THEN 'Production Champion Model' WHEN 'promoted' THEN 'Production Champion Model (Promoted)' "
    "ELSE 'Challenger Model (Did not outperform Champion)' END, '', "
    "CASE scenario WHEN 'first_registration' THEN 'Performance : ' WHEN 'promoted' THEN 'Performance     : ' ELSE 'Performance      : ' END || resolved_key || ' = ' || printf('%.4f', value), "
    "CASE scenario WHEN 'first_registration' THEN 'Registered  : ' WHEN 'promoted' THEN 'Promoted        : ' ELSE 'Registered       : ' END || '" + v.REGISTERED_AT + " UTC', "
    "CASE scenario WHEN 'promoted' THEN 'Replaced version: ' || champion_version WHEN 'challenger' THEN 'Current Champion : Version ' || champion_version END, "
    "CASE scenario WHEN 'first_registration' THEN 'Run ID      : ' WHEN 'promoted' THEN 'Run ID          : ' ELSE 'Run ID           : ' END || run_id) AS description "
    "FROM f_decisions WHERE new_version IS NOT NULL",
    "f_decisions",
)
def descriptions(spark: SparkSession, sf: str) -> DataFrame:
    versions = _versions(spark, sf)
    after = g.versions_after(_decisions(spark, sf, versions), versions, v.registered_at())
    return after.filter("description IS NOT NULL").select("model_name", "version", "description")


@query(
    "registration_results",
    "SELECT 'main.ops.' || model_name AS registered_model_name, CASE WHEN scenario <> 'error' THEN coalesce(CAST(new_version AS VARCHAR), 'N/A') END AS new_version, "
    "CASE scenario WHEN 'skipped_duplicate' THEN 'already_registered' WHEN 'challenger' THEN 'challenger' WHEN 'error' THEN NULL ELSE 'champion' END AS new_alias, "
    "CASE scenario WHEN 'error' THEN NULL WHEN 'skipped_duplicate' THEN 'N/A' WHEN 'challenger' THEN CAST(champion_version AS VARCHAR) ELSE CAST(new_version AS VARCHAR) END AS champion_version, "
    "run_id, resolved_key AS metric, round(value, 6) AS metric_value, scenario, CASE WHEN error IS NOT NULL THEN error WHEN scenario = 'error' THEN "
    "'champion run ''' || champion_run_id || ''' has no metric for ' || coalesce(metric, 'pattern ''' || metric_pattern || '''') END AS error FROM ("
    "WITH " + RESOLVED_SQL + ", judged AS (SELECT c.*, version AS champion_version, champ_run AS champion_run_id, CASE WHEN metric IS NOT NULL AND t.key IS NOT NULL THEN t.value "
    "WHEN metric_pattern IS NULL THEN NULL WHEN metric_select = 'first' THEN s.first_value ELSE s.value END AS champion_value, coalesce(max_version, 0) + 1 AS next_version "
    "FROM resolved c LEFT JOIN (SELECT a.model_name, a.version, w.run_id AS champ_run FROM f_aliases a JOIN f_versions w USING (model_name, version) WHERE alias = 'champion') h USING (model_name) "
    "LEFT JOIN f_stamped s ON s.run_id = champ_run LEFT JOIN f_run_metrics t ON t.run_id = champ_run AND t.key = metric "
    "LEFT JOIN (SELECT model_name, max(version) AS max_version FROM f_versions GROUP BY model_name) USING (model_name)), "
    "outcome AS (SELECT *, CASE WHEN error IS NOT NULL THEN 'error' WHEN EXISTS (SELECT 1 FROM f_versions x WHERE x.model_name = j.model_name AND x.run_id = j.run_id) "
    "THEN 'skipped_duplicate' WHEN champion_version IS NULL THEN 'first_registration' WHEN champion_value IS NULL THEN 'error' "
    "WHEN CASE metric_direction WHEN 'maximize' THEN value - champion_value ELSE champion_value - value END / abs(champion_value) >= improvement_threshold THEN 'promoted' "
    "ELSE 'challenger' END AS scenario FROM judged j) SELECT *, CASE WHEN scenario NOT IN ('error', 'skipped_duplicate') THEN next_version END AS new_version FROM outcome)",
    "f_runs f_stamped f_run_metrics f_aliases f_versions",
)
def results(spark: SparkSession, sf: str) -> DataFrame:
    versions = _versions(spark, sf)
    before = Registry(v.runs(spark, sf), v.run_metrics(spark, sf), versions, v.aliases(spark, sf))
    done = register(materialise(v.specs(spark, sf), "specs"), before, v.registered_at(), "main", "ops")
    return done.results.withColumn("metric_value", F.round("metric_value", 6))


@query("qualified_names", "SELECT DISTINCT 'main.ops.' || model_name AS full_name FROM f_versions", "f_versions")
def qualified(spark: SparkSession, sf: str) -> DataFrame:
    named = qualified_name(F.lit("main"), F.lit("ops"), F.col("model_name"))
    return v.versions(spark, sf).select(named.alias("full_name")).distinct()


@query(
    "final_state",
    "SELECT model_name, version, CASE WHEN value IS NULL THEN 'N/A' ELSE printf('%.4f', value) END AS metric_text, "
    f"strftime(created_at, '%Y-%m-%d %H:%M') AS created, substr(run_id, 1, 8) || '...' AS short_run_id FROM ({_VERSIONS_AFTER}) LEFT JOIN f_stamped USING (run_id)",
    "f_versions f_decisions f_stamped",
)
def state(spark: SparkSession, sf: str) -> DataFrame:
    versions = _versions(spark, sf)
    after = g.versions_after(_decisions(spark, sf, versions), versions, v.registered_at())
    return g.final_state(after, v.run_metrics(spark, sf), pattern=v.STAMPED)


def _history(spark: SparkSession, sf: str, threshold: float) -> DataFrame:
    arrivals = v.candidates(spark, sf).withColumnRenamed("event_id", "arrival_no")
    return g.promotion_history(arrivals, "minimize", threshold)


@query(
    "promotion_history_t0",
    "SELECT model_name, seq, run_id, CASE WHEN bar IS NULL THEN 'first_registration' WHEN wins THEN 'promoted' ELSE 'challenger' END AS scenario, "
    "last_value(CASE WHEN wins THEN run_id END IGNORE NULLS) OVER (PARTITION BY model_name ORDER BY seq ROWS UNBOUNDED PRECEDING) AS champion_run "
    "FROM (SELECT *, bar IS NULL OR value < bar OR (value = bar AND value <> 0) AS wins FROM (SELECT *, "
    "row_number() OVER (PARTITION BY model_name ORDER BY arrived, event_id) AS seq, "
    "min(value) OVER (PARTITION BY model_name ORDER BY arrived, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS bar FROM f_candidates))",
    "f_candidates",
)
def history_any_gain(spark: SparkSession, sf: str) -> DataFrame:
    return _history(spark, sf, 0.0)


@query(
    "promotion_history_t2pct",
    "WITH RECURSIVE numbered AS (SELECT *, row_number() OVER (PARTITION BY model_name ORDER BY arrived, event_id) AS seq FROM f_candidates), "
    "folded AS (SELECT model_name, seq, run_id, 'first_registration' AS scenario, run_id AS champion_run, value AS champion FROM numbered WHERE seq = 1 "
    "UNION ALL SELECT n.model_name, n.seq, n.run_id, CASE WHEN wins THEN 'promoted' ELSE 'challenger' END, CASE WHEN wins THEN n.run_id ELSE f_run END, "
    "CASE WHEN wins THEN n.value ELSE champion END FROM (SELECT m.*, f.champion_run AS f_run, f.champion, CASE WHEN f.champion = 0 THEN m.value < 0 "
    "ELSE (f.champion - m.value) / abs(f.champion) >= 0.02e0 END AS wins FROM folded f JOIN numbered m ON m.model_name = f.model_name AND m.seq = f.seq + 1) n) "
    "SELECT model_name, seq, run_id, scenario, champion_run FROM folded",
    "f_candidates",
)
def history_two_percent(spark: SparkSession, sf: str) -> DataFrame:
    return _history(spark, sf, 0.02)


@query(
    "pipeline_results",
    "WITH chosen AS (SELECT scenario AS model, min_by(run_id, model_name) AS run_id, min(model_name) AS model_name FROM f_decisions GROUP BY scenario), "
    "built AS (SELECT count(*) || ' rows, ' || count(label) || ' with actuals' AS detail FROM f_baseline) "
    "SELECT model, 'registration' AS stage, CASE model WHEN 'error' THEN 'failed' ELSE 'done' END AS status, CASE WHEN model <> 'error' THEN model END AS detail FROM chosen "
    "UNION ALL SELECT model, 'baseline', 'done', detail FROM chosen, built WHERE model NOT IN ('error', 'skipped_duplicate') "
    "UNION ALL SELECT 'again ' || model, 'registration', CASE model WHEN 'error' THEN 'failed' ELSE 'done' END, CASE WHEN model <> 'error' THEN 'skipped_duplicate' END FROM chosen "
    "UNION ALL SELECT 'champion ' || d.model_name, 'registry', 'done', CASE WHEN scenario IN ('first_registration', 'promoted') THEN CAST(new_version AS VARCHAR) ELSE CAST(champion_version AS VARCHAR) END "
    "FROM f_decisions d JOIN chosen c ON c.model_name = d.model_name AND d.scenario = c.model WHERE scenario <> 'error' AND (champion_version IS NOT NULL OR scenario IN ('first_registration', 'promoted'))",
    "f_decisions f_baseline",
)
def pipeline_results(spark: SparkSession, sf: str) -> DataFrame:
    """A whole run over one model of every kind of outcome, from registration to the written baseline; then the same run
    on the committed registry, in which every model is known; last the champions of the committed state."""
    versions = _versions(spark, sf)
    name = lambda frame: frame.withColumn("model_name", qualified_name(F.lit("main"), F.lit("ops"), F.col("model_name")))
    folder, tables = scratch_path(spark, "registry"), scratch_path(spark, "tables")
    # Committed first: all that follows reads the stored runs and metrics.
    registry = save_registry(Registry(v.runs(spark, sf), v.run_metrics(spark, sf), name(versions), name(v.aliases(spark, sf))), folder)
    # One model for each of the few kinds of outcome.
    place = F.struct("model_name", "run_id")
    decisions = _decisions(spark, sf, versions, registry.run_metrics)
    chosen = decisions.groupBy("scenario").agg(F.min(place).alias("m")).select("scenario", "m.*").collect()
    write_replacing(v.features(spark, sf), f"{tables}/features")
    write_replacing(v.actuals(spark, sf), f"{tables}/actuals")
    refs = {"feature_table": f"{tables}/features", "actual_table": f"{tables}/actuals", "baseline_table": f"{tables}/baseline"}
    contract = TableContract(**{**vars(v.CONTRACT), **refs})
    models = {
        r.scenario: ModelSpec(r.model_name, metric_pattern=v.STAMPED, source="run", run_id=r.run_id, improvement_threshold=0.02) for r in chosen
    }
    spec = PipelineSpec("cost", "main", "ops", "/exp/none", contract, models)
    line = v.line_of(load_table(spark, contract.feature_table), load_table(spark, contract.actual_table)).first()
    scorer = Scorer(expression=F.lit(line.slope) * F.col("o_totalprice") + F.lit(line.intercept))
    at = dt.datetime.fromisoformat(v.REGISTERED_AT)
    done = run_pipeline(spark, spec, registry, lambda *_: scorer, at)
    kept = save_registry(done.registry, folder)
    again = run_pipeline(spark, spec, kept, lambda *_: scorer, at, skip_baseline=True)
    known = F.when(F.col("status") == "done", F.col("detail"))
    rows = done.rows.select("model", "stage", "status", known.alias("detail"))
    later = again.rows.select(F.concat(F.lit("again "), "model").alias("model"), "stage", "status", known.alias("detail"))
    registered = [f"main.ops.{r.model_name}" for r in chosen if r.scenario != g.ERROR]
    holders = load_registry(spark, folder).aliases.filter((F.col("alias") == "champion") & F.col("model_name").isin(registered))
    bare = F.element_at(F.split("model_name", "[.]"), -1)
    champions_ = holders.select(
        F.concat(F.lit("champion "), bare).alias("model"), F.lit("registry").alias("stage"), F.lit("done").alias("status"), F.col("version").cast("string").alias("detail")
    )
    return rows.unionByName(later).unionByName(champions_)

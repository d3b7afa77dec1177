"""Running a whole use case: validate, register, refresh the baseline."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.contract import PipelineSpec, TableContract
from tidemark.operators.quality import key_uniqueness, validate_table
from tidemark.operators.scoring import Scorer, matching_actuals
from tidemark.operators.windows import fixed_bounds, test_window, window_rows
from tidemark.plans.baseline import build_baseline
from tidemark.plans.registration import Grown, Registry, register, specs_frame
from tidemark.session import materialise
from tidemark.sources.snapshots import State, current, read_text, write_text
from tidemark.sources.snapshots import replace as commit
from tidemark.sources.tables import load_optional, load_table, write_baseline

LoadChampion = Callable[[str, int, str], Scorer]


@dataclass(frozen=True)
class Outcome:
    """Result, warning and failure rows (model, stage, status, detail) and the registry as it should become."""

    rows: DataFrame
    registry: Registry

    @property
    def failed(self) -> bool:
        return not self.rows.filter("status = 'failed'").isEmpty()


def dry_run(spark: SparkSession, pipeline: PipelineSpec) -> tuple[dt.date, dt.date]:
    """Check the tables against their contract and return the test window; nothing is registered."""
    contract = pipeline.tables
    features = load_table(spark, contract.feature_table)
    validate_table(features, load_optional(spark, contract.actual_table), contract, strict=True)
    return fixed_bounds(test_window(features, contract), contract.feature_table)


def run_pipeline(
    spark: SparkSession,
    pipeline: PipelineSpec,
    registry: Registry,
    load_champion: LoadChampion,
    registered_at: dt.datetime | None = None,
    skip_baseline: bool = False,
    fail_fast: bool = False,
    files: DataFrame | None = None,
) -> Outcome:
    """Register every model of a use case and rebuild the baseline with the champions.

    A failing model does not stop the others unless ``fail_fast`` is set. Models named twice are
    registered in rounds, so that the second registration sees the first. The driver only ever holds one
    row per configured model and two dates. The registry knows models by catalog, schema and name, so that models of
    equal names in two catalogs have champions of their own; ``load_champion`` is asked by that full name. ``files`` lists the model files that there are, see ``register``.
    """
    models = {k: replace(m, model_name=qualified(pipeline, m.model_name)) for k, m in pipeline.resolved_models().items()}
    contract = pipeline.tables
    bounds = dry_run(spark, pipeline)
    features = load_table(spark, contract.feature_table)
    actuals = load_optional(spark, contract.actual_table)
    now = registered_at or dt.datetime.now(dt.timezone.utc)

    outcome: list[tuple[str, str, str, str]] = []
    ready: list[str] = []
    for batch in _rounds({k: m.model_name for k, m in models.items()}):
        names = {models[k].model_name: k for k in batch}
        # Stored, so that Spark knows how few they are and never moves the registry's tables for them.
        specs = materialise(specs_frame(spark, {k: models[k] for k in batch}), "specs")
        registration = register(specs, registry, now, fail_fast=fail_fast, files=files)
        registry = registration.registry
        for row in registration.results.collect():
            key = names[row.registered_model_name]
            if row.error is not None:
                outcome.append((key, "registration", "failed", row.error))
                continue
            outcome.append((key, "registration", "done", row.scenario))
            if models[key].create_baseline and row.scenario != "skipped_duplicate":
                ready.append(key)

    repeats = _repeated_keys(actuals, contract) if ready and not skip_baseline else None
    champions = _champions(registry, [models[k].model_name for k in ready]) if ready and not skip_baseline else {}
    window = labels = None
    for key in ready if not skip_baseline else []:
        try:
            version, run_id = champions[models[key].model_name]
            name = models[key].model_name
            # The window and its actuals are the same for all models: found and stored once.
            if window is None:
                window = materialise(window_rows(features, contract, bounds).select(*features.columns), "window")
                before = window.count()
            if before == 0:
                raise ValueError(f"no feature rows between {bounds[0]} and {bounds[1]}")
            scorer = load_champion(models[key].model_name, version, run_id)
            if labels is None and actuals is not None:
                labels = materialise(matching_actuals(window, actuals, contract), "labels")
            baseline = build_baseline(window, labels, scorer, contract, name, version, bounds, now)
            written = write_baseline(baseline, contract)
            matched = written.agg(F.count(F.lit(1)).alias("n"), F.count(contract.label_col).alias("m")).first()
            outcome.append((key, "baseline", "done", f"{matched.n} rows, {matched.m} with actuals"))
            if matched.n != before:
                outcome.append((key, "baseline", "warning", f"repeated keys in the actuals made {matched.n} rows of {before}"))
            elif repeats is not None:
                outcome.append((key, "baseline", "warning", repeats))
            if matched.m == 0:
                outcome.append((key, "baseline", "warning", "no row has an actual" if actuals is not None else "there is no actuals table"))
        except Exception as problem:
            if fail_fast:
                raise
            outcome.append((key, "baseline", "failed", str(problem)))
    schema = "model string, stage string, status string, detail string"
    return Outcome(spark.createDataFrame(outcome, schema), registry)


def _repeated_keys(actuals: DataFrame | None, contract: TableContract) -> str | None:
    """What is said of actuals whose keys are not unique, even if no repeated key meets the window."""
    if actuals is None or not set(contract.keys) <= set(actuals.columns):
        return None
    keys = key_uniqueness(actuals, contract.keys).first()
    if keys.is_unique:
        return None
    return f"{keys.n_rows - keys.n_keys} of {keys.n_rows} rows of the actuals repeat a key"


def qualified(pipeline: PipelineSpec, model_name: str) -> str:
    """The name under which a use case's model is registered."""
    return ".".join(part for part in (pipeline.catalog, pipeline.schema, model_name) if part)


def _rounds(names: dict[str, str]) -> list[list[str]]:
    """Spec keys in rounds that name each model at most once, in the configured order."""
    rounds: list[list[str]] = []
    seen: dict[str, int] = {}
    for key, name in names.items():
        turn = seen.get(name, 0)
        seen[name] = turn + 1
        if turn == len(rounds):
            rounds.append([])
        rounds[turn].append(key)
    return rounds


def _champions(registry: Registry, names: list[str]) -> dict[str, tuple[int, str]]:
    holders = registry.aliases.filter((F.col("alias") == "champion") & F.col("model_name").isin(names))
    found = holders.join(registry.versions, ["model_name", "version"]).select("model_name", "version", "run_id")
    return {r.model_name: (r.version, r.run_id) for r in found.collect()}


_TABLES = ("runs", "run_metrics", "versions", "aliases", "version_tags")
# Tables that registration only adds rows to, and the folders one of them may be spread over before it is written anew.
_GROWING = ("runs", "run_metrics", "version_tags")
FOLDERS = 50


def save_registry(registry: Registry, folder: str) -> Registry:
    """Commit a registry as the next state of its folder and return it as read back.

    Of tables that grow only the rows added since the folder was read are written: a state names all folders they lie in,
    those of older snapshots included. A registry that was loaded from a state which is no longer the newest raises
    ``CommitConflict``: what another batch registered meanwhile would be lost. Load it again and register again. Old
    states stay readable.
    """
    spark = registry.runs.sparkSession
    folder = folder.rstrip("/")

    def write(path: str) -> None:
        places = []
        for name in _TABLES:
            table, stored = getattr(registry, name), registry.stored(name)
            if table is None:
                continue
            if stored is not None and len(stored.folders) < FOLDERS and all(f.startswith(f"{folder}/") for f in stored.folders):
                places.extend((name, f.removeprefix(f"{folder}/")) for f in stored.folders)
                table = stored.added
            if table is not None:
                table.write.parquet(f"{path}/{name}")
                places.append((name, f"{path}/{name}".removeprefix(f"{folder}/")))
        write_text(spark, f"{path}/{_PLACES}", json.dumps(places))

    return _registry_at(spark, folder, commit(spark, folder, write, parent=registry.state))


def load_registry(spark: SparkSession, folder: str) -> Registry:
    """The newest committed state of a registry's folder."""
    folder = folder.rstrip("/")
    return _registry_at(spark, folder, current(spark, folder))


# The file of a snapshot that names its tables' folders; without it every table has one folder of its own name.
_PLACES = "_folders.json"


def _registry_at(spark: SparkSession, folder: str, state: State) -> Registry:
    text = read_text(spark, f"{state.path}/{_PLACES}")
    if text is None:
        tables = {n: load_optional(spark, f"{state.path}/{n}") for n in _TABLES}
        folders = {n: (f"{state.path}/{n}",) for n in _TABLES}
    else:
        folders = {n: tuple(f"{folder}/{place}" for table, place in json.loads(text) if table == n) for n in _TABLES}
        tables = {n: spark.read.parquet(*places) if places else None for n, places in folders.items()}
    grown = {n: Grown(tables[n], folders[n]) for n in _GROWING if tables[n] is not None}
    return Registry(**tables, state=state.number, grown=grown)

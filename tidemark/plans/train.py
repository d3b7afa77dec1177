"""The training flow: from features and actuals to ranked trials and the refitted best model."""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.contract import EVENT_DATE, TableContract
from tidemark.functions.metrics import METRICS
from tidemark.functions.values import merge_maps, to_number
from tidemark.operators.products import elastic_net, line_frame, quadratic_metric, split_products, strength_and_mixing, trial_metrics
from tidemark.operators.runs import log_run_metrics
from tidemark.operators.training import (
    SPACES, STAGE, category_codes, evaluate_trials, features_with_values, fit_and_measure, importance_of, make_estimator, measured_columns,
    measured_frame, model_features, numeric_features, ordered_statistics, predictions, training_set, usable_target, with_codes,
)
from tidemark.operators.tuning import median_prune, rank_trials, sample_trials
from tidemark.operators.windows import (
    check_splits, split_anchor, split_rows, split_sizes, time_splits, with_event_date,
)
from tidemark.session import materialise
from tidemark.sources.tables import load_optional, load_table, write_predictions, write_replacing, write_split_metrics, write_split_rows


@dataclass(frozen=True)
class Prepared:
    """Rows assigned to splits and what the models will see of them."""

    rows: DataFrame
    splits: DataFrame
    summary: DataFrame
    features: list[str]
    target: str
    # Columns that are neither numbers nor declared as categories: no model sees them.
    left_out: list[str]
    # Categorical columns with their numbers of codes.
    categories: dict[str, int] = field(default_factory=dict)


@dataclass(frozen=True)
class Tuned:
    """All a tuning run leaves behind for one family."""

    family: str
    trials: DataFrame
    split_metrics: DataFrame
    ranking: DataFrame
    best_trial: int
    pruned: list[int]
    primary: str
    best_params: dict[str, object]
    best_metrics: DataFrame
    run_metrics: DataFrame
    importance: DataFrame
    predictions: DataFrame
    model: PipelineModel


def prepare(
    features: DataFrame,
    actuals: DataFrame,
    contract: TableContract,
    target: str,
    numeric_text: Sequence[str] = (),
    categorical: Sequence[str] = (),
    n_splits: int = 2,
    val_weeks: int = 8,
    step_weeks: int = 4,
    min_rows: int = 50,
) -> Prepared:
    """Join, clean, date and split the training rows; raises where nothing usable is left."""
    joined = training_set(features, actuals, contract, target)
    cleaned = joined.withColumns({c: to_number(F.col(c)) for c in numeric_text}) if numeric_text else joined
    dated = materialise(with_event_date(usable_target(cleaned, target), contract), "training-rows")
    if dated.isEmpty():
        raise ValueError(f"features and actuals share no {contract.keys} with a usable date and target")
    anchor = split_anchor(dated, EVENT_DATE, n_splits, val_weeks, step_weeks, min_rows)
    if anchor.isEmpty():
        raise ValueError(f"no date leaves {min_rows} rows in each of {n_splits} windows of {val_weeks} weeks")
    anchor = materialise(anchor, "anchor")
    splits = materialise(time_splits(dated, EVENT_DATE, n_splits, val_weeks, step_weeks, anchor), "splits")
    categories: dict[str, int] = {}
    if categorical:
        # Coded before the splits repeat the rows; up to the anchor every row is in a split. Stored, so that Spark
        # knows the size of the lookups: small ones are broadcast, large ones are not.
        seen = dated.filter(F.col(EVENT_DATE) <= anchor.select("anchor").scalar())
        codes = materialise(category_codes(seen, categorical), "category-codes")
        dated = with_codes(dated, codes, categorical)
        counted = {r.column_name: r["count"] for r in codes.groupBy("column_name").count().collect()}
        categories = {c: counted.get(c, 0) for c in categorical}
    rows = split_rows(dated, splits, EVENT_DATE)
    usable = {f.name for f in rows.schema.fields if isinstance(f.dataType, T.NumericType)}
    names = [c for c in joined.columns if c in usable and c not in (*contract.keys, target)]
    names = [c for c in names if c not in contract.exclude_from_features]
    seen_by_none = {*names, *contract.keys, target, *contract.exclude_from_features}
    left_out = [c for c in joined.columns if c not in seen_by_none]
    summary = materialise(split_sizes(rows, splits, names, target, categorical), "split-summary")
    check_splits(summary, min_rows)
    return Prepared(rows, splits, summary, names, target, left_out, {c: n for c, n in categories.items() if c in names})


RUN_SCHEMA = (
    "run_id string, experiment string, parent_run_id string, start_time timestamp, params map<string,string>, "
    "tags map<string,string>"
)


def space_frame(spark: SparkSession, family: str, space: Mapping[str, object] | None = None) -> DataFrame:
    """A parameter space as a table."""
    rows = []
    for name, entry in (space or SPACES[family]).items():
        if isinstance(entry, tuple) and entry[0] == "categorical":
            rows.append((family, name, "categorical", None, None, False, None, [str(c) for c in entry[1]]))
        elif isinstance(entry, tuple):
            kind, low, high, *log = entry
            rows.append((family, name, kind, float(low), float(high), bool(log and log[0]), None, None))
        else:
            rows.append((family, name, "fixed", None, None, False, str(entry), None))
    schema = (
        "model_name string, param string, kind string, low double, high double, log boolean, fixed string, "
        "choices array<string>"
    )
    return spark.createDataFrame(rows, schema)


@dataclass(frozen=True)
class Swept:
    """The trials of a family after all splits: parameters, metric rows, ranking, and the trials stopped on the way."""

    params: dict[int, dict[str, object]]
    trials: DataFrame
    split_metrics: DataFrame
    ranking: DataFrame
    best_trial: int
    pruned: list[int]


def seen_by(prepared: Prepared, family: str) -> Prepared:
    """The rows as a family wants its categories: ``catboost`` learns from ordered target statistics, by date."""
    if family != "catboost" or not prepared.categories:
        return prepared
    day, tie = F.unix_date(F.col(EVENT_DATE)), F.xxhash64(*prepared.rows.columns)
    rows = ordered_statistics(prepared.rows, list(prepared.categories), prepared.target, day, tie)
    return replace(prepared, rows=rows, categories={})


def drawn_trials(
    spark: SparkSession, family: str, space: Mapping[str, object] | None, n_trials: int, structures: int | None = None
) -> tuple[DataFrame, dict[int, dict[str, object]]]:
    trials = sample_trials(space_frame(spark, family, space), n_trials, structures, STAGE.get(family))
    params: dict[int, dict[str, object]] = {}
    for row in trials.collect():
        params.setdefault(row.trial_no, {})[row.param] = row.value if row.value is not None else row.text
    return trials, params


def ranked(scores: DataFrame, alive: Sequence[int], weights: Sequence[float], primary: str) -> tuple[DataFrame, int]:
    """The trials that reached the end, ranked, and the best of them."""
    ranking = rank_trials(scores.filter(F.col("trial_no").isin(list(alive))), list(weights))
    best = ranking.filter("is_best").first()
    if best is None:
        raise ValueError(f"no trial has {primary} on every split")
    return ranking, best.trial_no


def sweep_lines(prepared: Prepared, space: Mapping[str, object] | None = None, n_trials: int = 20, primary: str = "rmse", n_startup: int = 5) -> Swept:
    """The linear family: every trial of every split from one pass over the rows.

    ``rmse`` and ``r2`` follow from the same sums, so ranking by them needs no further pass; the rows of all metrics are
    one more, over the test rows, when they are read.
    """
    spark = prepared.rows.sparkSession
    features, target = prepared.features, prepared.target
    trials, params = drawn_trials(spark, "linear", space, n_trials)
    ready = numeric_features(prepared.rows, features, target)
    products = split_products(ready, features, target)
    weights = {r.split_no: r.weight for r in prepared.splits.select("split_no", "weight").collect()}
    lines = line_frame(spark, "linear", products, params)
    measured = trial_metrics(ready, lines, features, target)
    if primary in ("rmse", "r2"):
        values = [
            ("linear", trial, step, quadratic_metric(sums, elastic_net(sums, *strength_and_mixing(drawn)), primary))
            for step, sums in enumerate(products) for trial, drawn in params.items()
        ]
        scores = spark.createDataFrame(values, "model_name string, trial_no int, step int, value double")
    else:
        measured = materialise(measured, "trial-metrics")
        scores = _scores(measured, primary)
    judged = median_prune(scores, len(products), n_startup)
    reached = judged.select("trial_no", F.col("step").alias("split_no"))
    stopped = {r.trial_no for r in judged.filter("pruned").select("trial_no").distinct().collect()}
    alive = [no for no in sorted(params) if no not in stopped]
    ranking, best = ranked(scores, alive, [weights[sums.split_no] for sums in products], primary)
    return Swept(params, trials, measured.join(reached, ["trial_no", "split_no"], "left_semi").select(measured_columns()), ranking, best, sorted(stopped))


def sweep_fits(
    prepared: Prepared, family: str, space: Mapping[str, object] | None, n_trials: int, primary: str, n_startup: int, parallelism: int,
    structures: int | None = None,
) -> Swept:
    """Any other family: fits of all trials split by split; the hopeless ones are stopped after each split.

    With ``structures`` there are at most that many fits a split, whatever the number of trials: trials of one structure
    differ in their number of trees and are read off the largest.
    """
    spark = prepared.rows.sparkSession
    features, target = prepared.features, prepared.target
    trials, params = drawn_trials(spark, family, space, n_trials, structures)
    split_list = prepared.splits.select("split_no", "weight").orderBy("split_no").collect()
    measured: DataFrame | None = None
    alive = sorted(params)
    for step, split in enumerate(split_list):
        work = [(family, no, params[no]) for no in alive]
        now = evaluate_trials(prepared.rows, work, [split.split_no], features, target, parallelism, prepared.categories)
        measured = now if measured is None else measured.unionByName(now)
        judged = median_prune(_scores(measured, primary), step + 1, n_startup)
        stopped = judged.filter("pruned").select("trial_no").distinct().collect()
        alive = [no for no in alive if no not in {r.trial_no for r in stopped}]
    # A trial stopped at the last step is stopped all the same; it has values but does not compete.
    ranking, best = ranked(_scores(measured, primary), alive, [s.weight for s in split_list], primary)
    return Swept(params, trials, measured, ranking, best, sorted(set(params) - set(alive)))


def tune(
    prepared: Prepared,
    family: str,
    space: Mapping[str, object] | None = None,
    n_trials: int = 20,
    primary: str = "rmse",
    keys: Sequence[str] = (),
    n_startup: int = 5,
    parallelism: int = 4,
    structures: int | None = None,
) -> Tuned:
    """Sweep a family's trials split by split, stop the hopeless ones, refit the best.

    The rows stay distributed; the driver holds the trials' parameters and scores, as many as were asked
    for. The last split is the most recent one and gives model, importances and predictions.
    """
    spark = prepared.rows.sparkSession
    prepared = seen_by(prepared, family)
    if family == "linear":
        swept = sweep_lines(prepared, space, n_trials, primary, n_startup)
    else:
        swept = sweep_fits(prepared, family, space, n_trials, primary, n_startup, parallelism, structures)
    features, target = prepared.features, prepared.target
    chosen = swept.params[swept.best_trial]
    nominal = prepared.categories if family in STAGE else {}
    ready = numeric_features(prepared.rows, features, target, keys, nominal)
    split_nos = [r.split_no for r in prepared.splits.select("split_no").orderBy("split_no").collect()]
    if family == "linear":
        # The refit of a trial is the trial: its rows are there already. One fit gives the model itself.
        best_metrics = swept.split_metrics.filter(F.col("trial_no") == swept.best_trial)
        train = ready.filter((F.col("split_no") == split_nos[-1]) & (F.col("role") == "train"))
        model = make_estimator(family, chosen, features_with_values(train, features), target).fit(train)
    else:
        refits = [fit_and_measure(ready, family, swept.best_trial, chosen, s, features, target, nominal) for s in split_nos]
        best_metrics = measured_frame(spark, [row for row, _ in refits])
        model = refits[-1][1]
    last = ready.filter((F.col("split_no") == split_nos[-1]) & (F.col("role") == "test"))
    return Tuned(
        family, swept.trials, with_ranges(swept.split_metrics, prepared.summary), swept.ranking, swept.best_trial, swept.pruned, primary, chosen,
        with_ranges(best_metrics, prepared.summary), log_run_metrics(best_metrics, primary, best=True),
        importance_of(model, prepared.rows, model_features(model)),
        predictions(model.transform(last), keys, target, "prediction"), model,
    )


def with_ranges(measured: DataFrame, summary: DataFrame) -> DataFrame:
    """Metric rows with the ranges and row counts of their splits."""
    about = summary.select("split_no", "train_start", "train_end", "test_start", "test_end", "n_train", "n_test")
    first = [c for c in ("model_name", "trial_no", "split_no", "split_name") if c in measured.columns]
    rest = [c for c in measured.columns if c not in first]
    return measured.join(about, "split_no").select(*first, *about.columns[1:], *rest)


def _scores(measured: DataFrame, primary: str) -> DataFrame:
    return measured.select("model_name", "trial_no", F.col("split_no").alias("step"), F.col(primary).alias("value"))


def tuning_runs(tuned: Tuned, experiment: str, started_at: dt.datetime) -> tuple[DataFrame, DataFrame]:
    """The runs a tuning leaves in the tracking tables, as rows of ``runs`` and of ``run_metrics``.

    One run for the family with the refitted best model, and one below it per trial. Only the family's
    run carries the ``best_`` metrics. A pruned trial has metrics for the splits it reached and no
    weighted mean.
    """
    spark = tuned.trials.sparkSession
    stamp = f"{started_at:%Y%m%d_%H%M%S}"
    parent = hashlib.sha256(f"{experiment}\n{tuned.family}\n{stamp}".encode()).hexdigest()
    trial_id = F.concat(F.lit(f"{parent}-"), F.col("trial_no").cast("string"))

    text = F.coalesce("text", F.col("value").cast("string"))
    entry = F.struct(F.col("param").alias("key"), text.alias("value"))
    drawn = tuned.trials.groupBy("trial_no").agg(F.map_from_entries(F.collect_list(entry)).alias("drawn"))
    status = F.when(F.col("trial_no").isin(tuned.pruned), "pruned").otherwise("completed")
    name = F.create_map(F.lit("model_name"), F.lit(tuned.family))
    trials = drawn.select(
        trial_id.alias("run_id"), F.lit(experiment).alias("experiment"), F.lit(parent).alias("parent_run_id"),
        F.lit(started_at).cast("timestamp").alias("start_time"), merge_maps(F.col("drawn"), name).alias("params"),
        F.create_map(
            F.lit("trial_status"), status, F.lit("run_name"), F.concat(F.lit("trial_"), F.col("trial_no").cast("string"))
        ).alias("tags"),
    )
    best = {"model_name": tuned.family, **{f"best_{k}": str(v) for k, v in tuned.best_params.items()}}
    tags = {
        "model_name": tuned.family, "run_name": tuned.family, "stage": "best_model_refit", "primary_metric": tuned.primary,
        "best_trial_number": str(tuned.best_trial), "n_trials": str(drawn.count()),
    }
    family = spark.createDataFrame([(parent, experiment, None, started_at, best, tags)], RUN_SCHEMA)

    keyed = tuned.split_metrics.withColumn("run_id", trial_id)
    long = keyed.unpivot(["run_id", "split_name"], list(METRICS), "metric", "value")
    per_split = long.select("run_id", F.concat_ws("_", "metric", "split_name").alias("key"), "value")
    means = tuned.ranking.select(
        trial_id.alias("run_id"), F.lit(f"weighted_mean_{tuned.primary}").alias("key"), F.col("score").alias("value")
    )
    own = tuned.run_metrics.select(F.lit(parent).alias("run_id"), "key", "value")
    metrics = per_split.unionByName(means).unionByName(own)
    return family.unionByName(trials), metrics.select("run_id", "key", F.lit(0).alias("step"), "value")


# The outputs of a family, as folders below its own.
OUTPUTS = ("trials", "split_metrics", "best_metrics", "ranking", "run_metrics", "importance", "predictions")
OUTCOME = "family string, status string, best_trial int, score double, detail string"


def train_pipeline(
    prepared: Prepared,
    folder: str,
    run_id: str,
    families: Sequence[str] = tuple(SPACES),
    spaces: Mapping[str, Mapping[str, object]] | None = None,
    n_trials: int = 20,
    primary: str = "rmse",
    keys: Sequence[str] = (),
    structures: int | None = None,
    n_startup: int = 5,
    fail_fast: bool = False,
) -> DataFrame:
    """Tune all families and write what each leaves behind below ``folder/run_id``; one row per family on what came of it.

    The split rows and their summary are written once for all. A family's outputs and its model go into its own folder,
    and a last row marks it as complete. Called again with the same run id after a failure, the complete families are
    skipped and read, the others are fitted anew. A family that fails does not stop the others unless ``fail_fast`` is
    set. Rows: family, status (done, skipped, failed), best_trial, score, detail.
    """
    spark = prepared.rows.sparkSession
    base = f"{folder.rstrip('/')}/{run_id}"
    unknown = sorted(set(families) - set(SPACES))
    if unknown:
        raise ValueError(f"unknown model families {unknown}, known: {sorted(SPACES)}")
    if load_optional(spark, f"{base}/split_summary") is None:
        write_split_rows(prepared.rows, f"{base}/split_rows")
        write_replacing(prepared.summary, f"{base}/split_summary")
    outcome = []
    for family in families:
        there = load_optional(spark, f"{base}/{family}/complete")
        if there is not None:
            before = there.first()
            outcome.append((family, "skipped", before.best_trial, before.score, "complete already"))
            continue
        try:
            tuned = tune(prepared, family, (spaces or {}).get(family), n_trials, primary, keys, n_startup, structures=structures)
            for name in OUTPUTS:
                write = {"split_metrics": write_split_metrics, "predictions": write_predictions}.get(name, write_replacing)
                write(getattr(tuned, name), f"{base}/{family}/{name}")
            tuned.model.write().overwrite().save(f"{base}/{family}/model")
            score = tuned.ranking.filter("is_best").first().score
            done = (family, "done", tuned.best_trial, score, f"{len(tuned.pruned)} of {n_trials} trials stopped early")
            write_replacing(spark.createDataFrame([done], OUTCOME), f"{base}/{family}/complete")
            outcome.append(done)
        except Exception as problem:
            if fail_fast:
                raise
            outcome.append((family, "failed", None, None, str(problem)))
    return spark.createDataFrame(outcome, OUTCOME)


def training_output(spark: SparkSession, folder: str, run_id: str, name: str, families: Sequence[str] = tuple(SPACES)) -> DataFrame:
    """One output of all complete families of a run, with the family in front."""
    if name not in OUTPUTS:
        raise ValueError(f"unknown output {name!r}, known: {list(OUTPUTS)}")
    base = f"{folder.rstrip('/')}/{run_id}"
    out = None
    for family in families:
        if load_optional(spark, f"{base}/{family}/complete") is not None:
            rows = load_table(spark, f"{base}/{family}/{name}")
            rows = rows.select(F.lit(family).alias("family"), *[c for c in rows.columns if c != "family"])
            out = rows if out is None else out.unionByName(rows)
    if out is None:
        raise ValueError(f"run {run_id!r} has no complete family")
    return out


def load_model(folder: str, run_id: str, family: str) -> PipelineModel:
    """The refitted best model of a family."""
    return PipelineModel.load(f"{folder.rstrip('/')}/{run_id}/{family}/model")

import datetime as dt
import math
import random

import numpy as np
import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.contract import ModelSpec
from tidemark.functions.values import four_decimals, is_better
from tidemark.operators import registry as g
from tidemark.plans.registration import Registry, register, specs_frame

NOW = dt.datetime(2024, 2, 1, 12, 0, tzinfo=dt.timezone.utc)


def beats(new, champion, direction, threshold):
    if champion is None:
        return True
    gain = champion - new if direction == "minimize" else new - champion
    return gain > 0 if champion == 0 else gain / abs(champion) >= threshold


def test_is_better(spark):
    grid = [
        (new, champion, direction, threshold)
        for new in (-3.0, -2.0, 0.0, 1.96, 2.0, 2.04, 5.0)
        for champion in (None, -2.0, 0.0, 2.0)
        for direction in ("minimize", "maximize")
        for threshold in (0.0, 0.02, 0.5)
    ]
    df = spark.createDataFrame(grid, "new double, champ double, dir string, thr double")
    got = df.select("*", is_better(F.col("new"), F.col("champ"), F.col("dir"), F.col("thr")).alias("b")).collect()
    assert [x.b for x in got] == [beats(*row) for row in grid]
    assert beats(2.0, 2.0, "minimize", 0.0) and not beats(0.0, 0.0, "minimize", 0.0)


def test_four_decimals(spark):
    df = spark.createDataFrame([(1.23456,), (2.0,), (None,)], "v double")
    assert [x[0] for x in df.select(four_decimals(F.col("v"))).collect()] == ["1.2346", "2.0000", "N/A"]


def replay(candidates, direction, threshold):
    """The promotion rule in a plain loop."""
    out, state = [], {}
    for name, run, arrived, no, value in sorted(candidates, key=lambda c: (c[2], c[3])):
        model = state.setdefault(name, {"champion": None, "value": None, "runs": set(), "seq": 0})
        model["seq"] += 1
        if value is None:
            scenario = "error"
        elif run in model["runs"]:
            scenario = "skipped_duplicate"
        else:
            model["runs"].add(run)
            if model["champion"] is None:
                scenario = "first_registration"
            else:
                scenario = "promoted" if beats(value, model["value"], direction, threshold) else "challenger"
            if scenario != "challenger":
                model.update(champion=run, value=value)
        out.append((name, model["seq"], run, scenario, model["champion"]))
    return sorted(out, key=repr)


CANDIDATE = "model_name string, run_id string, arrived timestamp, arrival_no long, value double"


def history(spark, candidates, direction, threshold, **options):
    return rows(g.promotion_history(spark.createDataFrame(candidates, CANDIDATE), direction, threshold, **options))


value = st.none() | st.integers(-6, 6).map(float) | st.floats(0.5, 2.0)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 25), st.integers(0, 8), value), max_size=40),
    st.sampled_from(["minimize", "maximize"]),
    st.sampled_from([0.0, 0.02, 0.3]),
)
def test_history_against_a_loop(spark, entries, direction, threshold):
    start = dt.datetime(2024, 1, 1)
    candidates = [(m, f"r{r}", start + dt.timedelta(minutes=t), i, v) for i, (m, r, t, v) in enumerate(entries)]
    assert history(spark, candidates, direction, threshold) == replay(candidates, direction, threshold)


@pytest.mark.parametrize("threshold", [0.0, 0.02])
def test_history_of_a_hot_model(spark, threshold):
    rng = random.Random(5)
    start = dt.datetime(2024, 1, 1)
    candidates = []
    for i in range(4000):
        name = "hot" if i % 3 else f"m{rng.randrange(30)}"
        level = 1000 - i / 5 if i % 2 else 1000.0
        candidates.append((name, f"r{i if i % 11 else i // 2}", start + dt.timedelta(seconds=i // 2), i, round(level + rng.randrange(3), 2)))
    assert history(spark, candidates, "minimize", threshold) == replay(candidates, "minimize", threshold)


@pytest.mark.parametrize("threshold, direction", [(0.02, "maximize"), (1.0, "minimize")])
def test_history_by_jumps(spark, threshold, direction):
    rng = random.Random(7)
    start = dt.datetime(2024, 1, 1)
    sign = 1 if direction == "minimize" else -1
    candidates = []
    for i in range(600):
        # Steady gains through zero, a standstill, a fall; few records in the other models.
        level = {0: 50 - i / 6, 1: 3.0 if i < 400 else 1.0 - i / 1e6}.get(i % 3, rng.choice([5.0, 4.9, 0.0, -0.0, None]))
        name = "hot" if i % 3 == 0 else "flat" if i % 3 == 1 else f"m{rng.randrange(20)}"
        candidates.append((name, f"r{i}", start + dt.timedelta(seconds=i), i, level if level is None else sign * level))
    assert history(spark, candidates, direction, threshold, streamed=20) == replay(candidates, direction, threshold)


special = st.sampled_from([0.0, -0.0, 5e-324, -5e-324, 1.0, -1.0, 1e308, -1e308, math.inf, -math.inf])


@settings(max_examples=300, deadline=None)
@given(st.lists(special | st.floats(allow_nan=False), min_size=1, max_size=5), st.sampled_from([1e-12, 0.0005, 0.02, 0.5, 1.0, 1.5, 1e9, -0.1]))
def test_goals_are_the_greatest_winners(champions, threshold):
    champions = np.array(champions)
    goals = g._goals(champions, threshold)
    none = np.isnan(goals)
    assert not g._beats(champions, np.full(len(champions), -np.inf), threshold)[none].any()
    assert (goals[~none] < champions[~none]).all()
    assert g._beats(champions, goals, threshold)[~none].all()
    above = np.nextafter(goals, np.inf)
    assert not (g._beats(champions, above, threshold) & (above < champions))[~none].any()


def test_jumps_of_a_long_chain(spark):
    """Every record is promoted, and the only model is the hot one."""
    n = 300
    made = spark.range(n).select(
        F.lit("hot").alias("model_name"), F.format_string("r%d", "id").alias("run_id"), F.timestamp_seconds(F.col("id")).alias("arrived"),
        F.col("id").alias("arrival_no"), (F.lit(2.0) * n - F.col("id")).alias("value"),
    )
    got = g.promotion_history(made, "minimize", 1e-6, streamed=10).groupBy("scenario").count().collect()
    assert {r.scenario: r["count"] for r in got} == {"first_registration": 1, "promoted": n - 1}


RUN = "run_id string, experiment string, parent_run_id string, start_time timestamp, params map<string,string>, tags map<string,string>"


@pytest.fixture(scope="module")
def registry(spark):
    """Models: new (nothing yet), better/worse (champion and challenger), bare (no alias), twice, dumb (champion without metric)."""
    runs, metrics = [], []
    for i, (name, old, new) in enumerate([("new", None, 5.0), ("better", 10.0, 9.0), ("worse", 10.0, 11.0), ("bare", 10.0, 99.0),
                                          ("twice", 10.0, 9.0), ("dumb", None, 1.0)]):
        for kind, amount in (("old", old), ("new", new)):
            tags = {"model_type": "gbt"} if i % 2 else {"model_name": "rf", "mlflow.runName": "night"}
            runs.append((f"{kind}-{name}", "/e/" + name, None, dt.datetime(2024, 1, 1, i, 0 if kind == "old" else 1), {}, tags))
            if amount is not None:
                metrics.append((f"{kind}-{name}", f"rmse_val_{kind}", 0, amount))
                metrics.append((f"{kind}-{name}", "role", 0, 1.0))
    versions = [(m, v, f"old-{m}" if v == 9 else f"other-{m}", None, dt.datetime(2024, 1, 1)) for m in ("better", "worse", "bare", "dumb") for v in (9, 10)]
    versions += [("twice", 9, "new-twice", None, dt.datetime(2024, 1, 1))]
    aliases = [(m, "champion", 9) for m in ("better", "worse", "twice", "dumb")] + [("better", "challenger", 10)]
    return Registry(
        spark.createDataFrame(runs, RUN),
        spark.createDataFrame(metrics, "run_id string, key string, step int, value double"),
        spark.createDataFrame(versions, "model_name string, version int, run_id string, description string, created_at timestamp"),
        spark.createDataFrame(aliases, "model_name string, alias string, version int"),
    )


@pytest.fixture(scope="module")
def done(spark, registry):
    names = ["new", "better", "worse", "bare", "twice", "dumb"]
    models = {m: ModelSpec(m, metric_pattern="^rmse_val_", source="run", run_id=f"new-{m}") for m in names}
    return register(specs_frame(spark, models), registry, NOW, "c", "s")


def test_results(done):
    got = {x.registered_model_name[4:]: x for x in done.results.collect()}
    assert {k: (x.new_version, x.new_alias, x.champion_version, x.scenario) for k, x in got.items()} == {
        "new": ("1", "champion", "1", "first_registration"),
        "better": ("11", "champion", "11", "promoted"),
        "worse": ("11", "challenger", "9", "challenger"),
        "bare": ("11", "champion", "11", "first_registration"),
        "twice": ("N/A", "already_registered", "N/A", "skipped_duplicate"),
        "dumb": (None, None, None, "error"),
    }
    assert got["better"].registered_model_name == "c.s.better" and got["better"].metric == "rmse_val_new"
    assert "champion run 'old-dumb'" in got["dumb"].error
    assert all(x.error is None for k, x in got.items() if k != "dumb")


def test_registry_after(done):
    after = {(x.model_name, x.alias): x.version for x in done.registry.aliases.collect()}
    assert after == {
        ("new", "champion"): 1, ("better", "champion"): 11, ("better", "challenger"): 9, ("worse", "champion"): 9,
        ("worse", "challenger"): 11, ("bare", "champion"): 11, ("twice", "champion"): 9, ("dumb", "champion"): 9,
    }
    versions = done.registry.versions
    assert versions.count() == 9 + 4
    assert versions.groupBy("model_name", "version").count().filter("count > 1").isEmpty()


def test_tags_and_descriptions(done):
    tags = {}
    for x in done.registry.version_tags.collect():
        assert (x.model_name, x.key) not in tags
        tags[x.model_name, x.key] = x.value
    assert tags["better", "rmse_val_new"] == "9.0" and tags["better", "replaced_version"] == "9"
    assert tags["better", "promoted_from"] == "new_registration" and tags["better", "role"] == "champion"
    assert tags["worse", "current_champion_version"] == "9" and tags["worse", "role"] == "challenger"
    assert tags["new", "model_type"] == "rf" and tags["new", "run_name"] == "night"
    assert tags["better", "model_type"] == "gbt" and tags["better", "run_name"] == "N/A"
    assert tags["new", "registered_date"] == "2024-02-01 12:00:00 UTC"
    text = {x.model_name: x.description for x in done.registry.versions.filter("description IS NOT NULL").collect()}
    assert text["better"].splitlines() == [
        "Production Champion Model (Promoted)", "", "Performance     : rmse_val_new = 9.0000",
        "Promoted        : 2024-02-01 12:00:00 UTC", "Replaced version: 9", "Run ID          : new-better",
    ]
    assert "Current Champion : Version 9" in text["worse"] and text["new"].startswith("Production Champion Model\n\n")


def test_final_state(done):
    state = g.final_state(done.registry.versions, done.registry.run_metrics, pattern="^rmse_val_")
    better = [(x.version, x.metric_text, x.short_run_id) for x in state.collect() if x.model_name == "better"]
    assert better == [(11, "9.0000", "new-bett..."), (10, "N/A", "other-be..."), (9, "10.0000", "old-bett...")]


def test_one_model_named_twice_in_a_batch(spark, registry):
    models = {k: ModelSpec("new", metric_pattern="^rmse_val_", source="run", run_id=r) for k, r in (("a", "new-new"), ("b", "new-worse"))}
    batch = register(specs_frame(spark, models), registry, NOW)
    assert {x.scenario for x in batch.results.collect()} == {"error"}
    with pytest.raises(ValueError, match="several specs"):
        register(specs_frame(spark, models), registry, NOW, fail_fast=True)


def test_files_become_runs(spark, registry):
    models = {"f": ModelSpec("better", metric="test_rmse", source="file", model_path="/m/x.cb", metrics={"test_rmse": 4.0},
                             tags={"team": "t"}, experiment_path="/files")}
    batch = register(specs_frame(spark, models), registry, NOW)
    result = batch.results.first()
    # The champion was never measured by that name.
    assert result.scenario == "error" and "has no metric for test_rmse" in result.error
    assert batch.registry.runs.filter(F.col("run_id") == result.run_id).first().tags["registered_via"] == "file"
    assert batch.registry.run_metrics.filter(F.col("run_id") == result.run_id).first().value == 4.0


def test_history_of_a_model_that_always_improves(spark):
    """Every candidate is a record; the fold runs over several Arrow batches and two models."""
    start = dt.datetime(2024, 1, 1)
    candidates = [(m, f"{m}{i}", start + dt.timedelta(seconds=i), i, 1000.0 - i / 20) for m in ("a", "b") for i in range(15_000)]
    assert history(spark, candidates, "minimize", 0.02) == replay(candidates, "minimize", 0.02)


def test_metrics_that_are_no_numbers(spark, registry):
    """Such a candidate is an error whatever its source; such a champion keeps its place."""
    nan = spark.createDataFrame([("new-new", "odd", 0, float("nan")), ("old-worse", "odd", 0, float("nan")), ("new-worse", "odd", 0, 1.0)], registry.run_metrics.schema)
    state = Registry(registry.runs, registry.run_metrics.unionByName(nan), registry.versions, registry.aliases)
    models = {
        "run": ModelSpec("new", metric="odd", source="run", run_id="new-new"),
        "champion": ModelSpec("worse", metric="odd", source="run", run_id="new-worse"),
        "file": ModelSpec("filed", metric="odd", source="file", model_path="/m/x.cb", metrics={"odd": float("nan")}, experiment_path="/files"),
    }
    got = {x.registered_model_name: x for x in register(specs_frame(spark, models), state, NOW).results.collect()}
    assert "'odd' of run 'new-new' is not a number" in got["new"].error and "is not a number" in got["filed"].error
    assert got["worse"].scenario == "challenger" and got["worse"].error is None


def test_versions_of_files_carry_the_name_of_their_run(spark, registry):
    models = {"f": ModelSpec("filed", metric="a", source="file", model_path="/m/x.cb", metrics={"a": 4.0}, experiment_path="/files")}
    batch = register(specs_frame(spark, models), registry, NOW)
    name = batch.registry.version_tags.filter("model_name = 'filed' AND key = 'run_name'").first().value
    assert name.startswith("filed_") and name.endswith("20240201_120000")


def test_best_run_in_both_directions(spark, registry):
    both = spark.createDataFrame([(f"new-{m}", "gain", 0, v) for m, v in (("new", 1.0), ("better", 5.0))], registry.run_metrics.schema)
    runs = registry.runs.withColumn("experiment", F.lit("/one"))
    state = Registry(runs, registry.run_metrics.unionByName(both), registry.versions.limit(0), registry.aliases.limit(0))
    models = {d: ModelSpec(d, metric="gain", metric_direction=d, experiment_path="/one") for d in ("minimize", "maximize")}
    got = {x.registered_model_name: (x.run_id, x.metric_value) for x in register(specs_frame(spark, models), state, NOW).results.collect()}
    assert got == {"minimize": ("new-new", 1.0), "maximize": ("new-better", 5.0)}

"""Replacing tables in one step, guarded registry commits, and the resumable training flow."""

from __future__ import annotations

import dataclasses
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.contract import ModelSpec, PipelineSpec, TableContract
from tidemark.operators.registry import version_tags
from tidemark.operators.runs import log_run_metrics
from tidemark.operators.scoring import Scorer
from tidemark.plans import train
from tidemark.plans.registration import Registry, register, specs_frame
from tidemark.plans.run import load_registry, run_pipeline, save_registry
from tidemark.sources.snapshots import CommitConflict, current, replace
from tidemark.sources.tables import load_optional, load_table, write_predictions, write_replacing

AT = dt.datetime(2024, 5, 1)


def failing(spark, rows=20):
    """A frame whose write fails after some of its files are there."""
    return spark.range(rows).repartition(4).select(F.when(F.col("id") == 13, F.raise_error(F.lit("half-way"))).otherwise(F.col("id")).cast("long").alias("id"))


def test_a_write_that_fails_half_way_leaves_the_old_rows(spark, tmp_path):
    ref = str(tmp_path / "table")
    write_replacing(spark.range(5), ref)
    held = load_table(spark, ref)
    with pytest.raises(Exception, match="half-way"):
        write_replacing(failing(spark), ref)
    assert load_table(spark, ref).count() == 5 and current(spark, ref).number == 1
    write_replacing(spark.range(7).withColumn("more", F.lit("x")), ref, ("more",))
    assert load_table(spark, ref).count() == 7 and load_optional(spark, ref).columns == ["id", "more"]
    # Whoever resolved the old state still reads it.
    assert held.count() == 5


def test_a_table_may_be_replaced_from_itself(spark, tmp_path):
    ref = str(tmp_path / "table")
    write_replacing(spark.range(5), ref)
    write_replacing(load_table(spark, ref).filter("id > 1"), ref)
    assert load_table(spark, ref).count() == 3


def test_catalog_tables_keep_their_rows_when_a_write_fails(spark):
    spark.sql("DROP TABLE IF EXISTS swapped")
    try:
        write_replacing(spark.range(4), "swapped")
        with pytest.raises(Exception, match="half-way"):
            write_replacing(failing(spark), "swapped")
        assert spark.table("swapped").count() == 4
        write_replacing(spark.range(6).withColumn("more", F.lit(1)), "swapped")
        assert spark.table("swapped").count() == 6 and spark.table("swapped").columns == ["id", "more"]
        assert [t.name for t in spark.catalog.listTables() if t.name.startswith("swapped")] == ["swapped"]
    finally:
        spark.sql("DROP TABLE IF EXISTS swapped")


def test_of_two_writers_from_one_state_one_succeeds(spark, tmp_path):
    ref = str(tmp_path / "state")
    first = replace(spark, ref, lambda path: spark.range(1).write.parquet(path), parent=0)
    with pytest.raises(CommitConflict, match="is at state 1, the write started from 0"):
        replace(spark, ref, lambda path: spark.range(2).write.parquet(path), parent=0)

    def overtaken(path):
        spark.range(3).write.parquet(path)
        replace(spark, ref, lambda other: spark.range(4).write.parquet(other), parent=first.number)

    with pytest.raises(CommitConflict, match="is at state 2, the write started from 1"):
        replace(spark, ref, overtaken, parent=first.number)
    assert load_table(spark, ref).count() == 4


def test_a_commit_without_a_name_never_took_place(spark, tmp_path):
    ref = tmp_path / "state"
    write_replacing(spark.range(2), str(ref))
    (ref / "_commits" / "0000000002").write_text("")
    assert load_table(spark, str(ref)).count() == 2
    write_replacing(spark.range(3), str(ref))
    assert load_table(spark, str(ref)).count() == 3


@pytest.fixture()
def registry(spark):
    runs = [(f"r{i}", "/exp", None, dt.datetime(2024, 1, i + 1), {}, {}) for i in range(4)]
    metrics = [("r0", "rmse_val_1", 0, 5.0), ("r1", "rmse_val_1", 0, 4.0), ("r2", "rmse_val_1", 0, 3.0), ("r3", "rmse_val_1", 0, 6.0)]
    return Registry(
        spark.createDataFrame(runs, "run_id string, experiment string, parent_run_id string, start_time timestamp, params map<string,string>, tags map<string,string>"),
        spark.createDataFrame(metrics, "run_id string, key string, step int, value double"),
        spark.createDataFrame([], "model_name string, version int, run_id string, description string, created_at timestamp"),
        spark.createDataFrame([], "model_name string, alias string, version int"),
    )


def one(spark, name, run):
    return specs_frame(spark, {"m": ModelSpec(name, metric_pattern="^rmse_val_", source="run", run_id=run)})


def test_two_interleaved_registrations_do_not_lose_one(spark, registry, tmp_path):
    folder = str(tmp_path / "registry")
    start = save_registry(registry, folder)
    assert start.state == 1
    left = register(one(spark, "a", "r0"), load_registry(spark, folder), AT).registry
    right = register(one(spark, "b", "r1"), load_registry(spark, folder), AT).registry
    assert save_registry(left, folder).state == 2
    with pytest.raises(CommitConflict):
        save_registry(right, folder)
    again = register(one(spark, "b", "r1"), load_registry(spark, folder), AT).registry
    assert save_registry(again, folder).state == 3
    assert sorted(r.model_name for r in load_registry(spark, folder).versions.collect()) == ["a", "b"]


def test_a_commit_writes_only_the_rows_that_were_added(spark, registry, tmp_path):
    folder = str(tmp_path / "state")
    start = save_registry(registry, folder)
    spec = ModelSpec("a", source="file", model_path="/m/a.cbm", metric="rmse", metrics={"rmse": 2.0})
    first = save_registry(register(specs_frame(spark, {"a": spec}), start, AT).registry, folder)
    second = save_registry(register(specs_frame(spark, {"a": spec}), first, AT + dt.timedelta(days=1)).registry, folder)
    n = registry.runs.count()
    assert [s.runs.count() for s in (start, first, load_registry(spark, folder))] == [n, n + 1, n + 2]
    for name in ("runs", "run_metrics"):
        assert spark.read.parquet(f"{current(spark, folder).path}/{name}").count() == 1
    assert second.version_tags.select("version").distinct().count() == 2 and second.versions.count() == 2
    # A frame put in the place of a table is written as it is, and so is all that goes to another folder.
    fewer = save_registry(dataclasses.replace(second, runs=second.runs.limit(1)), folder)
    assert fewer.runs.count() == 1 and fewer.run_metrics.count() == second.run_metrics.count()
    other = save_registry(dataclasses.replace(second, state=0), str(tmp_path / "other"))
    assert other.runs.count() == n + 2 and all(f.startswith(str(tmp_path / "other")) for f in other.grown["runs"].folders)


def test_equal_names_in_two_catalogs_are_two_models(spark, registry, tmp_path):
    contract = TableContract("", "", "", date_col="day", join_keys=["k"], label_col="y", min_valid_date="2000-01-01", exclude_from_features=["k"])
    contract = dataclasses.replace(contract, feature_table=str(tmp_path / "f"), actual_table=str(tmp_path / "a"), baseline_table=str(tmp_path / "b"))
    spark.sql("SELECT 1 AS k, DATE '2024-03-01' AS day, 2.0D AS x").write.parquet(contract.feature_table)
    spark.sql("SELECT 1 AS k, 3.0D AS y").write.parquet(contract.actual_table)
    asked = []

    def champion(name, version, run):
        asked.append((name, version, run))
        return Scorer(expression="x")

    for catalog, run in (("cat1", "r3"), ("cat2", "r0"), ("cat1", "r2")):
        models = {"m": ModelSpec("cost", metric_pattern="^rmse_val_", source="run", run_id=run)}
        done = run_pipeline(spark, PipelineSpec("p", catalog, "s", "/exp", contract, models), registry, champion, AT)
        registry = done.registry
    assert asked == [("cat1.s.cost", 1, "r3"), ("cat2.s.cost", 1, "r0"), ("cat1.s.cost", 2, "r2")]
    held = {(r.model_name, r.alias): r.version for r in registry.aliases.collect()}
    assert held == {("cat1.s.cost", "champion"): 2, ("cat1.s.cost", "challenger"): 1, ("cat2.s.cost", "champion"): 1}


def test_versions_are_tagged_with_the_value_they_are_judged_by(spark, registry):
    nan = float("nan")
    metrics = [("r0", "rmse_val_1", 0, 9.0), ("r0", "rmse_val_1", 3, nan), ("r0", "rmse_val_1", 3, 2.0), ("r0", "other", 1, nan)]
    frame = spark.createDataFrame(metrics, "run_id string, key string, step int, value double")
    state = dataclasses.replace(registry, run_metrics=frame)
    done = register(one(spark, "a", "r0"), state, AT)
    judged = done.results.first().metric_value
    tags = {r.key: r.value for r in version_tags(done.decisions, state.runs, frame, AT).collect()}
    assert float(tags["rmse_val_1"]) == judged and "other" not in tags


def test_many_runs_are_logged_in_one_plan(spark):
    rows = [("a", 0, "s0", 0.3, 10.0), ("b", 0, "s0", 0.3, 30.0), ("a", 0, "s1", 1.0, 20.0), ("b", 1, "s0", 0.3, 5.0)]
    frame = spark.createDataFrame(rows, "model_name string, trial_no int, split_name string, weight double, rmse double")
    frame = frame.withColumns({m: F.lit(1.0) for m in ("mae", "mape", "wmape", "smape", "r2")})
    got = {(r.model_name, r.trial_no, r.key): r.value for r in log_run_metrics(frame).collect()}
    assert got["a", 0, "rmse_s0"] == 10 and got["b", 0, "rmse_s0"] == 30 and got["b", 1, "rmse_s0"] == 5
    assert got["a", 0, "weighted_mean_rmse"] == pytest.approx((3 + 20) / 1.3)
    only = {r.key: r.value for r in log_run_metrics(frame.filter("model_name = 'a'").drop("model_name", "trial_no")).collect()}
    assert only["rmse_s1"] == 20


@pytest.fixture(scope="module")
def prepared(spark):
    rng = random.Random(6)
    start = dt.date(2023, 1, 1)
    rows = [(i, start + dt.timedelta(days=i // 3), x := rng.uniform(0, 10), 3 * x + rng.gauss(0, 2)) for i in range(600)]
    frame = spark.createDataFrame(rows, "k int, day date, x double, cost double")
    contract = TableContract("f", "b", "a", date_col="day", join_keys=["k"], label_col="cost", min_valid_date="2000-01-01", exclude_from_features=["k"])
    return train.prepare(frame.drop("cost"), frame.select("k", "cost"), contract, "total")


SPACES = {"linear": {"regParam": ("float", 0.1, 9.0, True)}, "gbt": {"maxIter": ("int", 1, 3), "maxDepth": 2, "seed": 1}}


def test_a_training_run_is_taken_up_where_it_failed(spark, prepared, tmp_path, monkeypatch):
    folder, fits = str(tmp_path / "runs"), []
    plain = train.tune

    def counted(ready, family, *args, **options):
        fits.append(family)
        return plain(ready, family, *args, **options)

    monkeypatch.setattr(train, "tune", counted)

    def go():
        done = train.train_pipeline(prepared, folder, "one", ["linear", "gbt"], SPACES, n_trials=3, keys=["k"], structures=1)
        return {r.family: (r.status, r.best_trial) for r in done.collect()}

    # The last sink of the second family fails: all it wrote before does not count.
    with monkeypatch.context() as broken:
        def refuse(df, ref):
            if "/gbt/" in ref:
                raise OSError("disk full")
            write_predictions(df, ref)

        broken.setattr(train, "write_predictions", refuse)
        first = go()
    assert first["linear"][0] == "done" and first["gbt"] == ("failed", None)
    assert {r.family for r in train.training_output(spark, folder, "one", "split_metrics").collect()} == {"linear"}
    second = go()
    assert second["linear"] == ("skipped", first["linear"][1]) and second["gbt"][0] == "done"
    assert fits == ["linear", "gbt", "gbt"]

    metrics = train.training_output(spark, folder, "one", "best_metrics")
    sizes = {r.split_no: r for r in prepared.summary.collect()}
    for r in metrics.collect():
        about = sizes[r.split_no]
        assert (r.train_start, r.train_end, r.test_start, r.test_end, r.n_train, r.n_test) == (
            about.train_start, about.train_end, about.test_start, about.test_end, about.n_train, about.n_test)
        assert r.n == r.n_test
    assert metrics.count() == 4 and train.training_output(spark, folder, "one", "trials").filter("family = 'gbt'").count() == 9
    model = train.load_model(folder, "one", "gbt")
    last = prepared.rows.filter("split_no = 1 AND role = 'test'").withColumn("x", F.col("x").cast("double"))
    rmse = model.transform(last).agg(F.sqrt(F.avg((F.col("total") - F.col("prediction")) ** 2))).first()[0]
    assert metrics.filter("family = 'gbt' AND split_no = 1").first().rmse == pytest.approx(rmse)
    with pytest.raises(ValueError, match="unknown output"):
        train.training_output(spark, folder, "one", "nothing")
    with pytest.raises(ValueError, match="no complete family"):
        train.training_output(spark, folder, "two", "trials")
    with pytest.raises(ValueError, match="unknown model families"):
        train.train_pipeline(prepared, folder, "one", ["svm"])

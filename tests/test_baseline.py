import datetime as dt
import os
import uuid

import numpy as np
import pandas as pd
import pytest
from conftest import rows
from pyspark.serializers import CloudPickleSerializer
from pyspark.sql import functions as F

from tidemark.contract import ModelSpec, PipelineSpec, TableContract
from tidemark.operators.quality import join_report
from tidemark.operators.scoring import Scorer, attach_actuals, batch_function, matching_actuals, prediction_values, score
from tidemark.plans.baseline import build_baseline
from tidemark.plans import run
from tidemark.plans.registration import Registry
from tidemark.plans.run import dry_run, load_registry, run_pipeline, save_registry
from tidemark.sources.tables import load_optional, load_table, sample_input, write_baseline

AT = dt.datetime(2024, 2, 1, tzinfo=dt.timezone.utc)


def contract(**change):
    base = dict(feature_table="f", baseline_table="b", date_kind="auto", date_col="day", join_keys=["k"], label_col="y",
                test_months=1, exclude_from_features=["k", "day", "absent"])
    return TableContract(**{**base, **change})


@pytest.fixture(scope="module")
def features(spark):
    data = [(1, dt.date(2024, 3, 31), 1.0), (2, dt.date(2024, 3, 1), 2.0), (3, dt.date(2024, 2, 29), 3.0),
            (None, dt.date(2024, 3, 2), 4.0), (5, dt.date(2024, 2, 28), 5.0), (6, dt.date(2024, 3, 3), None)]
    return spark.createDataFrame(data, "k int, day date, x double")


@pytest.fixture(scope="module")
def actuals(spark):
    return spark.createDataFrame([(1, 10.0), (2, 20.0), (2, 21.0), (None, 40.0), (9, 90.0)], "k int, y double")


DOUBLE = Scorer(expression="x * 2")


def test_baseline(features, actuals):
    built = build_baseline(features, actuals, DOUBLE, contract(), "m", 7, scored_at=AT)
    assert built.columns == ["k", "day", "x", "event_date", "prediction_final", "model_version", "model_name", "prediction_timestamp", "y"]
    assert dict(built.dtypes)["prediction_final"] == dict(built.dtypes)["y"] == "float"
    got = rows(built.select("k", "prediction_final", "y", "model_version"))
    assert got == sorted(
        [(1, 2.0, 10.0, "7"), (2, 4.0, 20.0, "7"), (2, 4.0, 21.0, "7"), (3, 6.0, None, "7"), (None, 8.0, 40.0, "7"), (6, None, None, "7")], key=repr
    )
    assert tuple(join_report(built, features, "y").first()) == (6, 6, 4, "ok")
    assert join_report(built, features.limit(5), "y").first().level == "warning"
    with pytest.raises(ValueError, match="5 rows but 4 distinct"):
        build_baseline(features, actuals, DOUBLE, contract(), "m", 7, strict=True)


def test_no_actuals(features):
    built = build_baseline(features, None, DOUBLE, contract(), "m", 7)
    assert dict(built.dtypes)["y"] == "float" and built.filter("y IS NOT NULL").isEmpty()


def test_label_in_the_features_is_replaced(features, actuals):
    built = build_baseline(features.withColumn("y", F.lit(-1.0)), actuals, DOUBLE, contract(), "m", 7)
    assert built.columns.count("y") == 1 and built.filter("y = -1").isEmpty()


def test_keys_of_different_types_are_refused(features, actuals):
    with pytest.raises(TypeError, match="'k'"):
        attach_actuals(features, actuals.withColumn("k", F.col("k").cast("string")), contract())


@pytest.mark.parametrize(
    "predict",
    [
        lambda b: b["x"] * 2,
        lambda b: (b["x"] * 2).to_numpy().reshape(-1, 1),
        lambda b: pd.DataFrame({"other": b["x"], "prediction_raw": b["x"] * 2}),
        lambda b: pd.DataFrame({"first": b["x"] * 2, "other": b["x"]}),
    ],
)
def test_opaque_models(features, predict):
    seen = score(features, Scorer(predict=predict), contract())
    assert rows(seen.select("x", "prediction")) == rows(features.select("x", (F.col("x") * 2).alias("p")))


def test_models_see_only_their_columns(features):
    def predict(batch):
        assert list(batch.columns) == ["x"], list(batch.columns)
        return batch["x"]

    assert score(features, Scorer(predict=predict), contract()).count() == 6


def test_prediction_count():
    with pytest.raises(ValueError, match="2 predictions for 3 rows"):
        prediction_values(np.zeros(2), "p", 3)


def test_sample(features):
    assert [r.x for r in sample_input(features, contract(), 2).collect()] == [4.0, 1.0]
    assert sample_input(features, contract()).columns == ["x"]


def test_write_replaces_rows_and_schema(spark, features, actuals, tmp_path):
    c = contract(feature_table=str(tmp_path / "f"), actual_table=str(tmp_path / "a"), baseline_table=str(tmp_path / "b"))
    features.write.parquet(c.feature_table)
    stored = spark.read.parquet(c.feature_table)
    assert write_baseline(build_baseline(stored, None, DOUBLE, c, "m", 1), c).count() == 5
    wider = write_baseline(build_baseline(stored.withColumn("more", F.lit(1)), actuals, DOUBLE, c, "m", 2), c)
    assert wider.count() == 6 and "more" in wider.columns
    with pytest.raises(ValueError, match="overwrite"):
        contract(feature_table=str(tmp_path / "f"), baseline_table=str(tmp_path))


def test_optional_tables(spark, tmp_path):
    assert load_optional(spark, None) is None
    assert load_optional(spark, str(tmp_path / "nothing")) is None
    assert load_optional(spark, "no_such_table") is None


def test_a_scorer_is_one_model():
    for wrong in ({}, {"expression": "x", "predict": lambda b: b["x"]}, {"file": "/m.npy"}, {"load": np.load}):
        with pytest.raises(ValueError):
            Scorer(**wrong)


def test_stored_model_is_shipped_once_and_loaded_once_per_worker(spark, tmp_path):
    """A model of 200 MB: tasks carry its name only, and a worker process loads it once, however many batches and jobs it serves."""
    path, marks = tmp_path / "weights-of-cost.npy", tmp_path / "loads"
    marks.mkdir()
    weights = np.lib.format.open_memmap(path, "w+", np.float64, (25_000_000,))
    weights[:5] = [1, 2, 3, 4, 5]
    weights.flush()
    assert path.stat().st_size > 200_000_000

    def load(file):
        table = np.load(file, mmap_mode="r")
        (marks / f"{os.getpid()}-{uuid.uuid4().hex}").touch()
        return lambda batch: table[batch["x"].to_numpy().astype(int) % 5]

    scorer, own = Scorer(file=str(path), load=load), contract()
    assert len(CloudPickleSerializer().dumps(batch_function(spark, scorer, own.prediction_col))) < 1_000_000
    data = spark.range(0, 4000, 1, 16).select(F.col("id").cast("double").alias("x"), F.col("id").alias("k"))
    for _ in range(2):
        assert score(data, scorer, own).filter("NOT prediction <=> x % 5 + 1").count() == 0
    loads = [m.name.split("-")[0] for m in marks.iterdir()]
    assert loads and len(loads) == len(set(loads))
    other = tmp_path / "other" / path.name
    with pytest.raises(ValueError):
        score(data, Scorer(file=str(other), load=load), own)


@pytest.fixture()
def use_case(spark, features, actuals, tmp_path):
    c = contract(feature_table=str(tmp_path / "f"), actual_table=str(tmp_path / "a"), baseline_table=str(tmp_path / "b"),
                 min_valid_date="1990-01-01")
    features.write.parquet(c.feature_table)
    actuals.write.parquet(c.actual_table)
    runs = [("r1", "/exp", None, dt.datetime(2024, 1, 1), {}, {}), ("r2", "/exp", None, dt.datetime(2024, 1, 2), {}, {})]
    registry = Registry(
        spark.createDataFrame(runs, "run_id string, experiment string, parent_run_id string, start_time timestamp, params map<string,string>, tags map<string,string>"),
        spark.createDataFrame([("r1", "rmse_val_1", 0, 5.0), ("r2", "rmse_val_2", 0, 4.0)], "run_id string, key string, step int, value double"),
        spark.createDataFrame([], "model_name string, version int, run_id string, description string, created_at timestamp"),
        spark.createDataFrame([], "model_name string, alias string, version int"),
    )
    models = {
        "old": ModelSpec("cost", metric_pattern="^rmse_val_", source="run", run_id="r1"),
        "best": ModelSpec("cost", metric_pattern="^rmse_val_"),
        "bad": ModelSpec("delay", metric_pattern="^mae_val_"),
        "quiet": ModelSpec("quiet", metric_pattern="^rmse_val_", create_baseline=False),
    }
    return PipelineSpec("p", "cat", "sch", "/exp/", c, models), registry


def test_run_pipeline(spark, use_case, tmp_path):
    pipeline, registry = use_case
    assert dry_run(spark, pipeline) == (dt.date(2024, 2, 29), dt.date(2024, 3, 31))
    outcome = run_pipeline(spark, pipeline, registry, lambda name, version, run: Scorer(expression=F.col("x") + version), AT)
    got = {(r.model, r.stage): (r.status, r.detail) for r in outcome.rows.filter("status != 'warning'").collect()}
    warned = outcome.rows.filter("status = 'warning'").collect()
    assert {(r.model, r.detail) for r in warned} == {(m, "repeated keys in the actuals made 6 rows of 5") for m in ("old", "best")}
    assert got.pop(("bad", "registration"))[0] == "failed"
    assert got == {
        ("old", "registration"): ("done", "first_registration"),
        ("best", "registration"): ("done", "promoted"),
        ("quiet", "registration"): ("done", "first_registration"),
        ("old", "baseline"): ("done", "6 rows, 4 with actuals"),
        ("best", "baseline"): ("done", "6 rows, 4 with actuals"),
    }
    assert outcome.failed
    written = load_table(spark, pipeline.tables.baseline_table)
    assert {(r.model_name, r.model_version) for r in written.collect()} == {("cat.sch.cost", "2")}

    folder = str(tmp_path / "state")
    save_registry(outcome.registry, folder)
    again = load_registry(spark, folder)
    assert rows(again.aliases) == [("cat.sch.cost", "challenger", 1), ("cat.sch.cost", "champion", 2), ("cat.sch.quiet", "champion", 1)]
    # The same specs again: both runs of 'cost' are known, nothing is rebuilt.
    repeated = run_pipeline(spark, pipeline, again, lambda *_: DOUBLE, AT)
    details = {(r.model, r.stage): r.detail for r in repeated.rows.collect() if r.status == "done"}
    assert details == {(m, "registration"): "skipped_duplicate" for m in ("old", "best", "quiet")}


def test_window_and_its_actuals_are_found_once_for_all_models(spark, use_case, monkeypatch):
    pipeline, registry = use_case
    calls = []
    for name in ("window_rows", "matching_actuals"):
        plain = getattr(run, name)
        monkeypatch.setattr(run, name, lambda *a, plain=plain, name=name: calls.append(name) or plain(*a))
    outcome = run_pipeline(spark, pipeline, registry, lambda *_: DOUBLE, AT)
    assert outcome.rows.filter("stage = 'baseline' AND status = 'done'").count() == 2
    assert sorted(calls) == ["matching_actuals", "window_rows"]


def test_matching_actuals(spark):
    wanted = spark.createDataFrame([(1,), (1,), (None,), (7,)], "k long")
    held = spark.createDataFrame([(1, 1.0, "a"), (1, 2.0, "b"), (None, 3.0, "c"), (2, 4.0, "d")], "k long, y double, more string")
    found = matching_actuals(wanted, held, contract(join_keys=("k",), label_col="y"))
    assert rows(found) == [(1, 1.0), (1, 2.0), (None, 3.0)]


def test_repeated_actuals_outside_the_window_are_told(spark, use_case):
    pipeline, registry = use_case
    actuals = load_table(spark, pipeline.tables.actual_table)
    once = actuals.dropDuplicates(pipeline.tables.keys)
    far = once.limit(1).withColumn("k", F.lit(999).cast(once.schema["k"].dataType))
    held = once.unionByName(far).unionByName(far).collect()
    spark.createDataFrame(held, once.schema).write.mode("overwrite").parquet(pipeline.tables.actual_table)
    outcome = run_pipeline(spark, pipeline, registry, lambda *_: DOUBLE, AT)
    told = {r.detail for r in outcome.rows.filter("status = 'warning'").collect()}
    assert told == {f"1 of {len(held)} rows of the actuals repeat a key"}


def test_failures(spark, use_case):
    pipeline, registry = use_case
    with pytest.raises(ValueError, match="delay"):
        run_pipeline(spark, pipeline, registry, lambda *_: DOUBLE, AT, fail_fast=True)

    def broken(*_):
        raise OSError("no model file")

    outcome = run_pipeline(spark, pipeline, registry, broken, AT)
    assert {r.detail for r in outcome.rows.filter("stage = 'baseline'").collect()} == {"no model file"}
    skipped = run_pipeline(spark, pipeline, registry, broken, AT, skip_baseline=True)
    assert skipped.rows.filter("stage = 'baseline'").isEmpty()

import datetime as dt
import random
import statistics
from dataclasses import replace

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.contract import TableContract
from tidemark.operators.runs import best_run
from tidemark.operators.training import (
    FAMILIES, category_codes, fit_and_measure, fit_stages, make_estimator, measured_columns, model_features, numeric_features, ordered_statistics, staged_groups,
    training_set, usable_target, with_codes,
)
from tidemark.operators.tuning import median_prune, rank_trials, sample_trials
from tidemark.plans.train import prepare, seen_by, space_frame, tune, tuning_runs
from tidemark.queries import QUERIES
from tidemark.sources.tables import load_table, write_predictions, write_split_metrics, write_split_rows

CONTRACT = TableContract("f", "b", "a", date_col="day", join_keys=["k"], label_col="cost", min_valid_date="2000-01-01",
                         exclude_from_features=["k"])


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(2)
    start = dt.date(2023, 1, 1)
    data, labels = [], []
    for i in range(900):
        x, z = rng.uniform(0, 10), rng.uniform(0, 1)
        kind = rng.choice(["red", "green", "blue"])
        data.append((i, start + dt.timedelta(days=i // 3), x, None if i % 50 == 0 else z, kind, str(round(x, 3)) if i % 9 else "x"))
        labels.append((i, str(round(3 * x + rng.gauss(0, 0.1), 4)) if i % 40 else "n/a"))
    return (
        spark.createDataFrame(data, "k int, day date, x double, z double, kind string, text string"),
        spark.createDataFrame(labels, "k int, cost string"),
    )


@pytest.fixture(scope="module")
def prepared(tables):
    return prepare(*tables, CONTRACT, "total", numeric_text=["text"], categorical=["kind"])


def test_training_set(tables):
    features, actuals = tables
    joined = training_set(features, actuals.filter("k < 10"), CONTRACT, "total")
    assert joined.count() == 10 and joined.columns[-1] == "total"


def test_prepare(prepared):
    assert prepared.features == ["x", "z", "kind", "text"]
    assert prepared.rows.filter("total IS NULL").isEmpty()
    assert {r.n_train > 500 and r.n_test > 150 for r in prepared.summary.collect()} == {True}
    kinds = {r[0] for r in prepared.rows.select("kind").distinct().collect()}
    assert kinds == {0, 1, 2}


def test_prepare_refuses_unusable_data(tables):
    features, actuals = tables
    with pytest.raises(ValueError, match="share no"):
        prepare(features, actuals.filter("k < 0"), CONTRACT, "total")
    with pytest.raises(ValueError, match="no date leaves"):
        prepare(features, actuals, CONTRACT, "total", min_rows=10_000)


def test_category_codes(spark):
    df = spark.createDataFrame([("b", "x"), ("a", None), ("b", "y")], "p string, q string")
    codes = category_codes(df, ["p", "q"])
    assert rows(codes) == [("p", "a", 0), ("p", "b", 1), ("q", "x", 0), ("q", "y", 1)]
    assert rows(with_codes(df, codes, ["p", "q"]).select("p", "q")) == [(0, None), (1, 0), (1, 1)]


def test_trials_stay_in_their_ranges(spark):
    space = {"n": ("int", 3, 5), "f": ("float", 0.5, 0.9), "g": ("float", 1e-4, 1.0, True), "c": ("categorical", ["u", "v"]), "seed": 42}
    drawn = sample_trials(space_frame(spark, "gbt", space), 200).collect()
    by = {}
    for r in drawn:
        by.setdefault(r.param, []).append(r.value if r.param not in ("c",) else r.text)
    assert set(by["n"]) == {3.0, 4.0, 5.0} and set(by["c"]) == {"u", "v"} and set(by["seed"]) == {42.0}
    assert 0.5 <= min(by["f"]) and max(by["f"]) < 0.9
    assert 1e-4 <= min(by["g"]) and 0.002 < statistics.median(by["g"]) < 0.05
    assert drawn == sample_trials(space_frame(spark, "gbt", space), 200).collect()


def test_fixed_values_win(spark):
    space = space_frame(spark, "m", {"a": ("int", 1, 9)}).unionByName(space_frame(spark, "m", {"a": 7}))
    assert {r.value for r in sample_trials(space, 5).collect()} == {7.0}


def brute_prune(scores, steps, startup):
    out, alive = [], {m: None for m, *_ in scores}
    best, gone = {}, set()
    for step in range(steps):
        for model in alive:
            now = {t: v for m, t, s, v in scores if m == model and s == step and (m, t) not in gone}
            middle = statistics.median(now.values())
            for trial, v in now.items():
                best[model, trial] = min(v, best.get((model, trial), v))
                stop = len(now) - 1 >= startup and best[model, trial] > middle
                out.append((model, trial, step, stop))
            gone |= {(m, t) for m, t, s, stop in out if stop and s == step}
    return sorted(out, key=repr)


def test_median_prune(spark):
    rng = random.Random(4)
    scores = [(m, t, s, float(rng.randrange(30))) for m, n in (("hot", 400), ("few", 4), ("mid", 9)) for t in range(n) for s in range(3)]
    df = spark.createDataFrame(scores, "model_name string, trial_no int, step int, value double")
    assert rows(median_prune(df, 3).select("model_name", "trial_no", "step", "pruned")) == brute_prune(scores, 3, 5)


def test_rank_trials(spark):
    data = [("m", 1, 0, 4.0), ("m", 1, 1, 8.0), ("m", 2, 0, 8.0), ("m", 2, 1, 4.0), ("m", 3, 0, 1.0), ("m", 4, 0, 8.0), ("m", 4, 1, 4.0)]
    df = spark.createDataFrame(data, "model_name string, trial_no int, step int, value double")
    assert rows(rank_trials(df, [0.25, 0.75])) == [("m", 1, 7.0, False), ("m", 2, 5.0, True), ("m", 4, 5.0, False)]


def test_unknown_family():
    with pytest.raises(ValueError, match="unknown model family"):
        make_estimator("svm", {}, ["x"], "y")


@pytest.fixture(scope="module")
def tuned(prepared):
    space = {"regParam": ("float", 1e-3, 50.0, True), "elasticNetParam": 0.0}
    return tune(prepared, "linear", space, n_trials=4, keys=["k"], n_startup=1)


def test_tuning_becomes_runs(spark, prepared, tuned):
    runs, metrics = tuning_runs(tuned, "/exp/train", dt.datetime(2024, 1, 1))
    found = {r.run_id: r for r in runs.collect()}
    family = next(r for r in found.values() if r.parent_run_id is None)
    assert len(found) == 5 and family.tags["stage"] == "best_model_refit" and family.tags["n_trials"] == "4"
    assert family.params["best_elasticNetParam"] == "0.0" and family.tags["best_trial_number"] == str(tuned.best_trial)
    trials = [r for r in found.values() if r.parent_run_id == family.run_id]
    pruned = {int(r.run_id.split("-")[1]) for r in trials if r.tags["trial_status"] == "pruned"}
    assert sorted(pruned) == tuned.pruned and 0 < len(pruned) < 4
    assert all(r.params["model_name"] == "linear" and "regParam" in r.params for r in trials)
    means = {r.run_id for r in metrics.filter("key = 'weighted_mean_rmse'").collect()}
    assert means == {r.run_id for r in trials if r.tags["trial_status"] == "completed"}
    # The tracking tables feed registration: the nested runs compete too unless they are left out.
    best = best_run(runs, metrics, pattern="^best_rmse_val_")
    assert best.first().run_id == family.run_id
    assert best_run(runs, metrics, pattern="^rmse_val_").first().run_id != family.run_id
    assert best_run(runs, metrics, pattern="^rmse_val_", top_level_only=True).collect() == []


def test_tune_finds_the_line(spark, prepared, tuned, tmp_path):
    best = tuned.ranking.filter("is_best").first()
    assert best.score < 1 and best.trial_no in (0, 1, 2, 3)
    assert {r.n for r in tuned.best_metrics.collect()} <= {r.n_test for r in prepared.summary.collect()}
    keys = {r.key for r in tuned.run_metrics.collect()}
    assert "best_weighted_mean_rmse" in keys and len(keys) == 13
    assert tuned.importance.first().feature in ("x", "text")
    newest = max(prepared.summary.collect(), key=lambda r: r.split_no)
    assert tuned.predictions.count() == newest.n_test
    assert tuned.predictions.filter("abs(residual - (y_true - y_pred)) > 1e-9").isEmpty()
    write_predictions(tuned.predictions, str(tmp_path / "p"))
    write_split_metrics(tuned.split_metrics, str(tmp_path / "m"))
    write_split_rows(prepared.rows, str(tmp_path / "r"))
    assert load_table(spark, str(tmp_path / "m")).count() == tuned.split_metrics.count()
    assert load_table(spark, str(tmp_path / "r")).filter("role = 'test'").count() == prepared.rows.filter("role = 'test'").count()


def test_tree_families_train(prepared):
    tuned = tune(prepared, "gbt", {"maxIter": ("int", 2, 3), "maxDepth": 3, "seed": 42}, n_trials=1, keys=["k"])
    assert tuned.best_params["maxDepth"] == 3.0 and tuned.best_metrics.first().r2 > 0.5


def test_fit_queries_tune_whole_spaces(spark):
    ranking = QUERIES["trial_sweep"].run(spark, "/root/testdata/sf0.01").collect()
    # Of twenty trials the pruner stops some at each of two steps.
    assert 1 <= len(ranking) < 20 and max(r.trial_no for r in ranking) >= 8
    assert min(ranking, key=lambda r: (r.score, r.trial_no)).is_best and sum(r.is_best for r in ranking) == 1


def test_every_family_is_fitted(spark):
    assert {r.family for r in QUERIES["train_ml_families"].run(spark, "/root/testdata/sf0.01").collect()} == set(FAMILIES)


@pytest.fixture(scope="module")
def coded(spark):
    rng = random.Random(8)
    rows = []
    for i in range(800):
        kind = rng.choice([0, 1, 2, 3, 4, 5, None])
        y = (10.0 if kind in (0, 2, 5) else 25.0 if kind is None else -10.0) + rng.gauss(0, 0.01)
        rows.append((0, "s0", 1.0, "train" if i % 4 else "test", kind, rng.uniform(0, 1), None, y))
    return spark.createDataFrame(rows, "split_no int, split_name string, weight double, role string, kind int, x double, none double, y double")


def test_codes_are_split_by_sets(coded):
    plain, nominal = (
        fit_and_measure(numeric_features(coded, ["kind", "x", "none"], "y", categories=c), "gbt", 0, {"maxIter": 1, "maxDepth": 2}, 0, ["kind", "x", "none"], "y", c)
        for c in ({}, {"kind": 6})
    )
    r2 = measured_columns().index("r2")
    # Two splits by sets of codes separate the three levels; as numbers, codes 0, 2 and 5 are not next to each other.
    assert nominal[0][r2] > 0.999 > 0.9 > plain[0][r2]
    assert model_features(nominal[1]) == ["kind", "x"]


def test_statistics_see_earlier_training_rows_only(spark):
    rng = random.Random(4)
    table = [
        (s, "train" if rng.random() < 0.7 else "test", rng.choice(["hot"] * 6 + ["a", "b", None]), rng.choice("xy"), rng.randrange(9), i, rng.uniform(-5, 5))
        for s in range(2) for i in range(300)
    ]
    frame = spark.createDataFrame(table, "split_no int, role string, kind string, side string, day int, k long, y double")
    coded = ordered_statistics(frame, ["kind", "side"], "y", F.col("day"), F.col("k"), weight=2.0)
    assert coded.columns == frame.columns
    got = {(r.split_no, r.k): (r.kind, r.side) for r in coded.collect()}
    for s, role, *values, day, k, _ in table:
        learned = [r for r in table if r[0] == s and r[1] == "train"]
        mean = sum(r[6] for r in learned) / len(learned)
        for place, value in enumerate(values):
            earlier = [r[6] for r in learned if r[2 + place] == value and (role == "test" or r[4:6] < (day, k))]
            assert got[s, k][place] == pytest.approx((sum(earlier) + 2 * mean) / (len(earlier) + 2))
    assert ordered_statistics(frame.limit(0), ["kind"], "y", F.col("day"), F.col("k")).count() == 0


def test_one_family_learns_from_statistics(prepared):
    seen = seen_by(replace(prepared, categories={"kind": 3}), "catboost")
    assert seen.categories == {} and dict(seen.rows.dtypes)["kind"] == "double" and seen.rows.columns == prepared.rows.columns
    assert seen_by(prepared, "gbt") is prepared


def test_many_codes_widen_the_bins(spark):
    rows = [(0, "s0", 1.0, "train" if i // 70 % 5 else "test", i % 70, float(i % 70 % 2)) for i in range(1400)]
    frame = spark.createDataFrame(rows, "split_no int, split_name string, weight double, role string, kind int, y double")
    row, _ = fit_and_measure(numeric_features(frame, ["kind"], "y", categories={"kind": 70}), "random_forest", 0, {"numTrees": 3, "maxDepth": 2, "seed": 1}, 0, ["kind"], "y", {"kind": 70})
    assert row[measured_columns().index("r2")] > 0.99


def test_smaller_boosted_models_are_the_first_trees(spark, coded):
    ready = numeric_features(coded, ["kind", "x"], "y")
    shared = {"maxDepth": 3, "stepSize": 0.3, "subsamplingRate": 0.8, "seed": 42}
    trials = {no: {**shared, "maxIter": rounds} for no, rounds in enumerate((2, 9, 5, 9))}
    together, model = fit_stages(ready, "gbt", trials, 0, ["kind", "x"], "y")
    assert len(model.stages[-1].trees) == 9
    for no, params in trials.items():
        alone, _ = fit_and_measure(ready, "gbt", no, params, 0, ["kind", "x"], "y")
        assert together[no] == pytest.approx(alone)
    forest, _ = fit_stages(ready, "random_forest", {0: {"numTrees": 2, "maxDepth": 3, "seed": 1}, 1: {"numTrees": 7, "maxDepth": 3, "seed": 1}}, 0, ["kind", "x"], "y")
    assert len(forest) == 2 and forest[0] != forest[1]


def test_trials_of_one_structure_share_a_fit(spark):
    space = {"maxIter": ("int", 2, 40), "maxDepth": ("int", 2, 9), "stepSize": ("float", 0.01, 0.3, True)}
    drawn = {}
    for r in sample_trials(space_frame(spark, "gbt", space), 12, structures=3, staged="maxIter").collect():
        drawn.setdefault(r.trial_no, {})[r.param] = r.value
    groups = staged_groups("gbt", drawn)
    assert sorted(map(sorted, groups)) == [[0, 3, 6, 9], [1, 4, 7, 10], [2, 5, 8, 11]]
    assert len({p["maxIter"] for p in drawn.values()}) > 6
    assert len(staged_groups("linear", drawn)) == 12


def test_a_tree_family_is_tuned_with_few_fits(prepared):
    space = {"maxIter": ("int", 1, 6), "maxDepth": ("int", 2, 4), "seed": 42}
    tuned = tune(prepared, "gbt", space, n_trials=6, keys=["k"], n_startup=1, structures=2)
    assert prepared.categories == {"kind": 3} and tuned.best_metrics.count() == 2
    scores = {r.trial_no: r.score for r in tuned.ranking.collect()}
    assert scores[tuned.best_trial] == min(scores.values())
    refit = tuned.best_metrics.agg({"rmse": "max"}).first()[0]
    swept = tuned.split_metrics.filter(f"trial_no = {tuned.best_trial}").agg({"rmse": "max"}).first()[0]
    assert refit == pytest.approx(swept)


def test_numeric_targets_are_not_read_as_text(spark):
    frame = spark.createDataFrame([(1.5,), (float("nan"),), (float("inf"),), (None,)], "y double")
    assert usable_target(frame, "y").collect() == [(1.5,)]

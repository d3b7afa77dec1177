"""Linear trials from sums of products against fits by Spark's own learner."""

from __future__ import annotations

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from tidemark.contract import TableContract
from tidemark.operators.products import (
    coordinate_descent, elastic_net, line_frame, quadratic_metric, split_products, squared_error, trial_metrics,
)
from tidemark.operators.training import evaluate_split, make_estimator, measured_columns, numeric_features
from tidemark.plans.train import prepare, sweep_lines, tune

FEATURES = ["a", "b", "c", "flat"]
TRIALS = {0: {"regParam": 0.0}, 1: {"regParam": 0.5}, 2: {"regParam": 3.0, "elasticNetParam": 1.0}, 3: {"regParam": 1.5, "elasticNetParam": 0.4}}


@pytest.fixture(scope="module")
def split(spark):
    rng = random.Random(4)
    rows = []
    for i in range(600):
        a, b = rng.gauss(5, 3), rng.gauss(0, 1)
        c = b + rng.gauss(0, 0.3)
        y = 2 * a - 4 * b + 0.5 * c + rng.gauss(0, 1)
        rows.append((i % 2, f"s{i % 2}", 0.5, "train" if i % 5 else "test", a if i % 11 else None, float("nan") if i % 17 == 0 else b, c, 7.0, None if i % 50 == 0 else y))
    return spark.createDataFrame(rows, "split_no int, split_name string, weight double, role string, a double, b double, c double, flat double, y double")


def test_trials_equal_sparks_linear_regression(spark, split):
    # Without the column of one value: the learner's own solver gives up exactness on it.
    FEATURES = ["a", "b", "c"]
    sums = split_products(split, FEATURES, "y")
    got = {(r.trial_no, r.split_no): r for r in trial_metrics(split, line_frame(spark, "linear", sums, TRIALS), FEATURES, "y").collect()}
    known = split.filter("y IS NOT NULL")
    for trial, params in TRIALS.items():
        estimator = make_estimator("linear", params, FEATURES, "y")
        regression = estimator.getStages()[-1]
        assert isinstance(regression, LinearRegression)
        regression.setTol(1e-13).setMaxIter(5000)
        measured, model = evaluate_split(known, 1, estimator, "y")
        want, row = measured.first(), got[trial, 1]
        found = elastic_net(sums[1], params["regParam"], params.get("elasticNetParam", 0.0))
        assert found == pytest.approx(model.stages[-1].coefficients.toArray(), rel=1e-6, abs=1e-6)
        for metric in ("rmse", "mae", "mape", "wmape", "smape", "r2"):
            assert row[metric] == pytest.approx(want[metric], rel=1e-6)
        assert quadratic_metric(sums[1], found, "rmse") == pytest.approx(row.rmse, rel=1e-9)
        assert quadratic_metric(sums[1], found, "r2") == pytest.approx(row.r2, rel=1e-9)


def test_large_values_do_not_cancel(split):
    moved = split.withColumn("a", F.col("a") + 1e8).withColumn("y", F.col("y") + 2e8)
    for near, far in zip(split_products(split, FEATURES, "y"), split_products(moved, FEATURES, "y"), strict=True):
        assert elastic_net(far, 0.5, 0.3) == pytest.approx(elastic_net(near, 0.5, 0.3), rel=1e-6)


def test_further_pairs_are_further_passes(split):
    one, two = split_products(split, FEATURES, "y"), split_products(split, FEATURES, "y", block=4)
    for a, b in zip(one, two, strict=True):
        assert a.n_train == b.n_train and a.train == pytest.approx(b.train) and a.test == pytest.approx(b.test)


def test_columns_without_values_or_spread_get_no_weight(split):
    sums = split_products(split.withColumn("none", F.lit(None).cast("double")), [*FEATURES, "none"], "y")
    found = elastic_net(sums[0], 0.1, 0.0)
    assert found[3] == found[4] == 0 and abs(found[0]) > 1
    level = split_products(split.withColumn("y", F.lit(3.0)), FEATURES, "y")[0]
    assert elastic_net(level, 0.1, 0.5).tolist() == [0.0] * 4 and squared_error(level, np.zeros(4)) == 0
    assert quadratic_metric(level, np.zeros(4), "r2") == 1.0
    with pytest.raises(ValueError, match="split 0 has no test rows"):
        split_products(split.filter("role = 'train' OR split_no = 1"), FEATURES, "y")


def test_descent_reaches_the_minimum():
    rng = np.random.default_rng(0)
    for _ in range(20):
        x = rng.normal(size=(50, 6))
        square, right = x.T @ x / 50, rng.normal(size=6)
        l1, l2 = rng.uniform(0, 0.5, 2)
        w = coordinate_descent(square, right, l1, l2)
        slope = square @ w - right + l2 * w
        assert all(abs(s + l1 * np.sign(v)) < 1e-9 if v else abs(s) <= l1 + 1e-9 for s, v in zip(slope, w, strict=True))


@pytest.fixture(scope="module")
def ready(spark):
    rng = random.Random(6)
    start = dt.date(2023, 1, 1)
    rows = [(i, start + dt.timedelta(days=i // 3), x := rng.uniform(0, 10), rng.uniform(0, 5), 3 * x + rng.gauss(0, 2)) for i in range(900)]
    frame = spark.createDataFrame(rows, "k int, day date, x double, z double, cost double")
    contract = TableContract("f", "b", "a", date_col="day", join_keys=["k"], label_col="cost", min_valid_date="2000-01-01", exclude_from_features=["k"])
    return prepare(frame.drop("cost"), frame.select("k", "cost"), contract, "total")


STRONG = {"regParam": ("float", 0.01, 30.0, True), "elasticNetParam": ("float", 0.0, 1.0, False)}


def test_a_sweep_prunes_and_ranks_as_fits_do(spark, ready):
    swept = sweep_lines(ready, STRONG, n_trials=12)
    rows = numeric_features(ready.rows, ready.features, ready.target)
    assert swept.split_metrics.columns == measured_columns()
    scores = {}
    for trial, params in swept.params.items():
        for split_no in (0, 1):
            scores[trial, split_no] = evaluate_split(rows, split_no, make_estimator("linear", params, ready.features, ready.target), ready.target)[0].first().rmse
    by_first = sorted(scores[t, 0] for t in range(12))
    median = (by_first[5] + by_first[6]) / 2
    stopped = {t for t in range(12) if scores[t, 0] > median}
    left = [t for t in range(12) if t not in stopped]
    if len(left) > 5:
        values = sorted(scores[t, 1] for t in left)
        middle = (values[2] + values[3]) / 2 if len(left) == 6 else values[len(left) // 2]
        stopped |= {t for t in left if min(scores[t, 0], scores[t, 1]) > middle}
    assert set(swept.pruned) == stopped
    assert {(r.trial_no, r.split_no) for r in swept.split_metrics.collect()} == {(t, s) for t in range(12) for s in (0, 1) if s == 0 or t in left}
    for r in swept.split_metrics.collect():
        assert r.rmse == pytest.approx(scores[r.trial_no, r.split_no], rel=1e-5)
    best = min((t for t in range(12) if t not in stopped), key=lambda t: (0.3 * scores[t, 0] + scores[t, 1]) / 1.3)
    assert swept.best_trial == best


def test_other_primary_metrics_and_the_refit(spark, ready):
    tuned = tune(ready, "linear", STRONG, n_trials=8, primary="mae", keys=["k"])
    assert tuned.best_metrics.count() == 2
    last = tuned.best_metrics.filter("split_no = 1").first()
    assert last.mae == pytest.approx(tuned.predictions.agg(F.avg(F.abs("residual"))).first()[0], rel=1e-4)
    assert {r.key for r in tuned.run_metrics.filter("key LIKE 'best_weighted_mean%'").collect()} == {"best_weighted_mean_mae"}


def test_no_trial_with_a_value_is_a_stated_error(ready):
    with pytest.raises(ValueError, match="no trial has mape on every split"):
        level = ready.__class__(ready.rows.withColumn("total", F.lit(0.0)), ready.splits, ready.summary, ready.features, ready.target, ready.left_out)
        sweep_lines(level, STRONG, n_trials=3, primary="mape")

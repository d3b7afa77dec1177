import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidemark.functions.metrics import METRICS, regression_metrics, weighted_score


def expected(pairs):
    pairs = [(y, p) for y, p in pairs if y is not None and p is not None]
    if not pairs:
        return dict.fromkeys(METRICS)
    y, p = np.array(pairs, dtype=float).T
    r = y - p
    spread = np.abs(y) + np.abs(p)
    total = np.sum((y - y.mean()) ** 2)
    if len(y) < 2:
        r2 = None
    elif np.all(y == y[0]):
        r2 = 1.0 if np.sum(r * r) == 0 else 0.0
    else:
        r2 = 1 - np.sum(r * r) / total
    return {
        "rmse": math.sqrt(np.mean(r * r)),
        "mae": np.mean(np.abs(r)),
        "mape": np.mean(np.abs(r[y != 0] / y[y != 0])) * 100 if (y != 0).any() else None,
        "wmape": np.sum(np.abs(r)) / np.sum(np.abs(y)) * 100 if np.sum(np.abs(y)) > 0 else None,
        "smape": np.mean(2 * np.abs(r[spread != 0]) / spread[spread != 0]) * 100 if (spread != 0).any() else None,
        "r2": r2,
    }


def check(spark, pairs):
    row = regression_metrics(spark.createDataFrame(pairs, "y double, p double"), "y", "p").first()
    want = expected(pairs)
    for m in METRICS:
        if want[m] is None:
            assert row[m] is None, (m, row)
        else:
            assert row[m] == pytest.approx(want[m], rel=1e-9, abs=1e-9), m
    return row


@pytest.mark.parametrize(
    "pairs",
    [
        [(1.0, 1.0), (2.0, 2.0)],
        [(5.0, 5.0), (5.0, 5.0)],
        [(5.0, 5.0), (5.0, 6.0)],
        [(0.0, 1.0), (0.0, 2.0)],
        [(0.0, 0.0), (0.0, 0.0)],
        [(3.0, 4.0)],
        [],
        [(None, 1.0), (1.0, None), (2.0, 3.0), (4.0, 4.5)],
    ],
)
def test_edge_cases(spark, pairs):
    check(spark, pairs)


def test_r2_can_be_negative(spark):
    assert check(spark, [(1.0, 2.0), (2.0, 4.0), (3.0, 6.0)]).r2 == pytest.approx(-6.0)


# Small integers and quarters: no number so small that its square vanishes.
number = st.integers(-400, 400).map(lambda i: i / 4)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.none() | number, st.none() | number), max_size=12))
def test_against_numpy(spark, pairs):
    check(spark, pairs)


def test_weighted_score(spark):
    df = spark.createDataFrame([("a", 0.25, 4.0), ("a", 0.75, 8.0), ("b", 0.5, 1.0), ("b", 0.5, None)], "g string, weight double, rmse double")
    got = {r.g: r.score for r in weighted_score(df, "rmse", ["g"]).collect()}
    assert got == {"a": 7.0, "b": None}

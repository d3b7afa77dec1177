"""Linear trials from sums of products: one pass over the rows fits every trial of every split.

An elastic net needs the rows only through the means and the sums of products of its columns. They are taken once per
split and role, as deviations from the means of the split's train rows, so that large values do not cancel and a
missing value, which stands for that mean, adds nothing. All else is arithmetic on as many numbers as there are pairs
of columns: the coefficients of a trial by coordinate descent, its squared error on the test rows by a quadratic form.

The objective is that of ``pyspark.ml``'s linear regression with standardised columns: half the mean squared error of
the standardised target plus the penalties, the strength divided by the target's deviation.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.metrics import regression_metrics

# Sums computed side by side; further pairs of columns are further passes over the same columns.
BLOCK = 400


@dataclass(frozen=True)
class Products:
    """Of one split: train means of features and target (last), and mean products of deviations from them."""

    split_no: int
    n_train: int
    n_test: int
    means: np.ndarray
    train: np.ndarray
    test: np.ndarray
    # Of the test rows' target: mean deviation, whether it is one value only.
    test_offset: float
    test_constant: bool


def number(name: str) -> Column:
    value = F.col(name).cast("double")
    return F.when(~F.isnan(value), value)


def deviations(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """split_no, role, ``m`` (train means of the split) and ``d`` columns: deviations from them, 0 where missing."""
    means = rows.filter("role = 'train'").groupBy("split_no").agg(*[F.avg(number(c)).alias(f"m{i}") for i, c in enumerate(columns)])
    # One row for each split that was asked for.
    joined = rows.join(F.broadcast(means), "split_no")
    gaps = [F.coalesce(number(c) - F.col(f"m{i}"), F.lit(0.0)).alias(f"d{i}") for i, c in enumerate(columns)]
    return joined.select("split_no", "role", *[f"m{i}" for i in range(len(columns))], *gaps)


def split_products(rows: DataFrame, features: Sequence[str], target: str, block: int = BLOCK) -> list[Products]:
    """The sums of every split, in order. ``rows``: split_no, role, features and target; rows without target are left out."""
    columns = [*features, target]
    p = len(columns)
    gaps = deviations(rows.filter(number(target).isNotNull()), columns)
    pairs = [(i, j) for i in range(p) for j in range(i + 1)]
    last = f"d{p - 1}"
    facts = [F.count("*").alias("n"), F.avg(last).alias("offset"), F.min(last).alias("low"), F.max(last).alias("high"), *[F.first(f"m{i}").alias(f"m{i}") for i in range(p)]]
    found: dict[tuple[int, str], dict] = {}
    for at in range(0, len(pairs), block):
        sums = [F.avg(F.col(f"d{i}") * F.col(f"d{j}")).alias(f"s{i}_{j}") for i, j in pairs[at : at + block]]
        for row in gaps.groupBy("split_no", "role").agg(*(facts if at == 0 else []), *sums).collect():
            found.setdefault((row.split_no, row.role), {}).update(row.asDict())
    out = []
    for split in sorted({s for s, _ in found}):
        train, test = (found.get((split, role), {}) for role in ("train", "test"))
        if not train or not test:
            raise ValueError(f"split {split} has no {'test' if train else 'train'} rows")
        squares = []
        for part in (train, test):
            square = np.zeros((p, p))
            for i, j in pairs:
                square[i, j] = square[j, i] = part[f"s{i}_{j}"]
            squares.append(square)
        means = np.array([0.0 if train[f"m{i}"] is None else train[f"m{i}"] for i in range(p)])
        out.append(Products(split, train["n"], test["n"], means, *squares, test["offset"], test["low"] == test["high"]))
    return out


def coordinate_descent(square: np.ndarray, right: np.ndarray, l1: float, l2: float, tolerance: float = 1e-13, most: int = 100_000) -> np.ndarray:
    """The minimum of w'Aw/2 - b'w + l1 |w|_1 + l2 w'w/2; columns with a zero on the diagonal get weight 0."""
    w = np.zeros(len(right))
    used = [i for i in range(len(right)) if square[i, i] > 0]
    for _ in range(most):
        moved = 0.0
        for i in used:
            rest = right[i] - square[i] @ w + square[i, i] * w[i]
            new = math.copysign(max(0.0, abs(rest) - l1), rest) / (square[i, i] + l2)
            moved = max(moved, abs(new - w[i]))
            w[i] = new
        if moved <= tolerance * max(1.0, float(np.abs(w).max(initial=0.0))):
            break
    return w


def elastic_net(sums: Products, strength: float, mixing: float) -> np.ndarray:
    """Coefficients of the features for one trial; the prediction is the target's mean plus their sum over deviations."""
    spread = np.sqrt(np.maximum(np.diag(sums.train), 0.0))
    target = spread[-1]
    if target == 0:
        return np.zeros(len(spread) - 1)
    # Deviations that are rounding errors of a constant column are no spread.
    flat = spread[:-1] <= 1e-12 * np.maximum(np.abs(sums.means[:-1]), 1e-300)
    scale = np.where(flat, 1.0, spread[:-1])
    square = np.where(flat[:, None] | flat, 0.0, sums.train[:-1, :-1] / np.outer(scale, scale))
    right = np.where(flat, 0.0, sums.train[:-1, -1] / (scale * target))
    w = coordinate_descent(square, right, strength * mixing / target, strength * (1 - mixing) / target)
    return w * target / scale


def squared_error(sums: Products, coefficients: np.ndarray) -> float:
    """Mean squared error on the test rows."""
    return max(0.0, float(np.r_[-coefficients, 1.0] @ sums.test @ np.r_[-coefficients, 1.0]))


def quadratic_metric(sums: Products, coefficients: np.ndarray, metric: str) -> float | None:
    """``rmse`` or ``r2`` of a trial on a split's test rows, from the sums alone."""
    error = squared_error(sums, coefficients)
    if metric == "rmse":
        return math.sqrt(error)
    if sums.n_test < 2:
        return None
    if sums.test_constant:
        return 1.0 if error == 0 else 0.0
    return 1 - error / (sums.test[-1, -1] - sums.test_offset**2)


LINES = "model_name string, trial_no int, split_no int, base double, means array<double>, coefficients array<double>"


def line_frame(spark: SparkSession, family: str, products: Sequence[Products], trials: Mapping[int, Mapping[str, object]]) -> DataFrame:
    """The fitted lines of all trials on all splits."""
    rows = []
    for sums in products:
        for trial, params in trials.items():
            found = elastic_net(sums, *strength_and_mixing(params))
            rows.append((family, trial, sums.split_no, float(sums.means[-1]), sums.means[:-1].tolist(), found.tolist()))
    return spark.createDataFrame(rows, LINES)


def strength_and_mixing(params: Mapping[str, object]) -> tuple[float, float]:
    return float(params.get("regParam", 0.0)), float(params.get("elasticNetParam", 0.0))


def score_trials(rows: DataFrame, lines: DataFrame, features: Sequence[str], name: str = "prediction") -> DataFrame:
    """Every row once for each line of its split, with that line's prediction. There are as many lines as trials were
    asked for, times the splits."""
    joined = rows.join(F.broadcast(lines), "split_no")
    parts = [F.col("coefficients")[i] * F.coalesce(number(c) - F.col("means")[i], F.lit(0.0)) for i, c in enumerate(features)]
    return joined.withColumn(name, reduce(add, parts, F.col("base"))).drop("base", "means", "coefficients")


def trial_metrics(rows: DataFrame, lines: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """All metrics of all trials on all splits in one pass over the test rows."""
    scored = score_trials(rows.filter("role = 'test'"), lines, features)
    by = ["model_name", "trial_no", "split_no", "split_name", "weight"]
    return regression_metrics(scored, target, "prediction", by)

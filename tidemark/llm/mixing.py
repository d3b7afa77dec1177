"""Mixing documents to target weights of domains they belong to in part.

A multinomial classifier, fitted on a labelled table, gives each document posteriors p over the domains. Nonnegative
rates x are then fitted so that the expected tokens of each domain, sum of x * tokens * p, match the targets: least
squares over the domains, solved by accelerated projected gradient from x = 1. A step needs only the domains' totals
from the executors (a handful of numbers); a document's rate follows from its posteriors and the steps so far, so no
rates are kept between steps and nothing but the totals reaches the driver.

Steps are scaled by 1 / tokens (rates of equal posteriors stay equal) and by the domains' own sizes.

Defined cases: missing and empty texts have no tokens and keep posteriors of a text without words; without labelled
rows posteriors are equal; a domain without any token mass leaves its target unmet; documents with equal texts get
equal rates; repeated rows count as often as they occur; ``mix`` keeps further columns, ``rates`` ignores them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import append, computed, field, fresh, uniform
from tidemark.llm.linear import FeatureMap, collected, fit_softmax, labelled_sample, learn_features, probabilities
from tidemark.session import materialise


@dataclass
class Domains:
    features: FeatureMap
    weights: np.ndarray
    names: list[str]

    def __call__(self, texts: pa.Array) -> list[pa.Array]:
        held = texts.to_pylist()
        p = probabilities(self.weights, self.features.size, *self.features.rows(held))
        counts = pa.array([len((t or "").encode("utf-8", "surrogatepass").split()) for t in held], pa.int64())
        ends = pa.array(np.arange(len(held) + 1) * p.shape[1], pa.int32())
        return [counts, pa.ListArray.from_arrays(ends, pa.array(p.ravel()))]


def fit_domains(docs: DataFrame, labels: DataFrame, domain: Column, names: list[str], bound: int = 8_000, words: int = 300) -> Domains:
    """Learn the domains. ``domain`` gives a label row's domain number (0, 1, ... in the order of ``names``) or null."""
    numbered = labels.select("doc_id", domain.cast("int").alias("domain"))
    sample = materialise(labelled_sample(docs, numbered, ["domain"], bound), "domain-sample")
    flags = [f"is{k}" for k in range(len(names))]
    flagged = sample.select("doc_id", "text", "domain", *((F.col("domain") == k).cast("int").alias(f) for k, f in enumerate(flags)))
    features = learn_features(flagged, flags, words)
    numbers, ends, truth = collected(flagged, features, ["domain"])
    return Domains(features, fit_softmax(numbers, ends, features.size, truth[:, 0].astype(int), len(names)), names)


@dataclass
class Fit:
    """The steps taken; each is the change per posterior and the momentum after it."""

    steps: list[tuple[np.ndarray, float]]

    def replay(self, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rates of rows with posteriors ``p``, and the points where the next totals are taken."""
        rate = ahead = np.ones(len(p))
        for change, momentum in self.steps:
            new = np.maximum(0, ahead - p @ change)
            ahead = new + momentum * (new - rate)
            rate = new
        return rate, ahead


def posteriors(docs: DataFrame, domains: Domains) -> DataFrame:
    """doc_id, n_tokens (words) and p, stored."""
    shared = docs.sparkSession.sparkContext.broadcast(domains)
    fields = [field("n_tokens", "long"), field("p", "array<double>")]
    return materialise(append(docs.select("doc_id", "text"), lambda: shared.value, fields, ["text"]).drop("text"), "posteriors")


def p_matrix(column: pa.Array, k: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, k)


def totals(rows: DataFrame, k: int, fit: Fit | None) -> np.ndarray:
    """Of the executors: the domains' tokens at the point ahead, or, without a fit, the matrix sum of tokens * p * p'."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros((1 if fit else k, k))
        for batch in batches:
            tokens, p = batch.column(0).to_numpy(), p_matrix(batch.column(1), k)
            out += (tokens * fit.replay(p)[1]) @ p if fit else (p * tokens[:, None]).T @ p
        yield pa.RecordBatch.from_arrays([pa.array(range(out.size)), pa.array(out.ravel())], names=["i", "value"])

    found = rows.select("n_tokens", "p").mapInArrow(run, "i long, value double").groupBy("i").agg(F.sum("value").alias("value")).collect()
    out = np.zeros(k if fit else k * k)
    for row in found:
        out[row.i] = row.value
    return out if fit else out.reshape(k, k)


def fit_rates(rows: DataFrame, targets: np.ndarray, most: int = 60, tolerance: float = 1e-6) -> Fit:
    """Projected gradient until all domains are within ``tolerance`` of the target total, or ``most`` steps are done."""
    k = len(targets)
    square = totals(rows, k, None)
    weight = 1 / np.maximum(np.diag(square), 1e-9)
    scaled = np.sqrt(weight)[:, None] * square * np.sqrt(weight)
    length = 1 / max(np.linalg.eigvalsh(scaled).max(), 1e-9)
    fit, t = Fit([]), 1.0
    last = np.inf
    for _ in range(most):
        rest = totals(rows, k, fit) - targets
        off = np.abs(rest).max()
        if off <= tolerance * targets.sum():
            break
        if off > last:
            t = 1.0  # start the momentum anew
        last = off
        after = (1 + np.sqrt(1 + 4 * t * t)) / 2
        fit = Fit([*fit.steps, (length * weight * rest, (t - 1) / after)])
        t = after
    return fit


def fitted_to(rows: DataFrame, domains: Domains, targets: dict[str, float], tokens: str | float) -> Fit:
    k = len(domains.names)
    share = np.array([targets[name] for name in domains.names], float)
    share = share / share.sum()
    mass = totals(rows, k, Fit([]))
    if isinstance(tokens, str) and tokens != "same":
        at = domains.names.index(tokens)
        total = mass[at] / share[at]
    else:
        total = mass.sum() if tokens == "same" else tokens
    return fit_rates(rows, share * total)


def rates(docs: DataFrame, domains: Domains, targets: dict[str, float], tokens: str | float = "same") -> DataFrame:
    """Per document: doc_id, n_tokens, p_<domain>, and rate, how often it should be used.

    ``targets`` are the domains' shares. The total is that of the documents (``same``), a number, or the name of a
    domain that shall keep all its tokens.
    """
    rows = posteriors(docs, domains)
    k = len(domains.names)
    fitted = fitted_to(rows, domains, targets, tokens)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = p_matrix(batch.column("p"), k)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(fitted.replay(p)[0])], names=[*batch.schema.names, "rate"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    rated = rows.mapInArrow(run, f"doc_id {kind}, n_tokens long, p array<double>, rate double")
    return rated.select("doc_id", "n_tokens", *(F.col("p")[i].alias(f"p_{name}") for i, name in enumerate(domains.names)), "rate")


def copies(rate: Column, key: Column, slack: float = 0.02) -> Column:
    """A whole number of uses with the rate as its mean, fixed by the key. Rates within ``slack`` of 1 count as 1."""
    return F.when(F.abs(rate - 1) <= slack, F.lit(1)).otherwise(F.floor(rate + uniform(F.concat(F.lit("mix "), F.coalesce(key.cast("string"), F.lit("")))))).cast("int")


def mix(docs: DataFrame, domains: Domains, targets: dict[str, float], tokens: str | float = "same") -> DataFrame:
    """The documents, each as often as its rate says, with their own columns.

    Every row has the rate of its own text, computed where the row lies. The fraction of a rate is decided by the id, so
    rows with equal ids, or without one, fall on the same side of it.
    """
    fitted = fitted_to(posteriors(docs, domains), domains, targets, tokens)
    shared = docs.sparkSession.sparkContext.broadcast((domains, fitted))

    def make():
        model, steps = shared.value
        return lambda texts: pa.array(steps.replay(p_matrix(model(texts)[1], len(model.names)))[0], pa.float64())

    rate, copy = fresh(docs, "rate", "copy")
    rated = docs.withColumn(rate, computed(make, "double", [F.col("text")]))
    used = rated.withColumn(copy, copies(F.col(rate), F.col("doc_id"))).filter(F.col(copy) > 0)
    return used.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copy)))).drop(rate, copy)

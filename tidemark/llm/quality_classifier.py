"""Quality scores by positive-unlabelled learning.

Trusted positives are documents that a label marks as good; all other knowledge comes from unlabelled text of the same
folds. With class prior pi the risk of a scorer f is pi * R+(P) + max(0, R-(U) - pi * R-(P)): the unlabelled text
stands for the negatives once the positives expected in it are taken out, and the estimate of the negatives' risk may
not fall below zero. When it does, its gradient step is turned round. The prior is the share of good documents among
the labelled ones of the training folds. The model is linear in bins of a text's measures.

``bound`` limits both samples that the fit sees; scoring covers every document in one pass without a shuffle.

Defined cases: empty or missing texts get the score of a text whose measures are all 0; without any trusted positive
every score is 0.5; repeated rows get equal scores; labels of repeated rows count once, by the largest value; further
columns are kept by ``keep_good`` and ignored by ``scores``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import append, computed, field, fresh
from tidemark.llm.linear import N_MEASURES, FeatureMap, edges_of, labelled_sample, sample_of, summed, with_measures


@dataclass
class QualityModel:
    features: FeatureMap
    weights: np.ndarray  # feature weights, then the offset

    def __call__(self, texts: pa.Array) -> list[pa.Array]:
        numbers, ends = self.features.rows(texts.to_pylist())
        values = summed(self.weights[:-1, None], numbers, ends)[:, 0] + self.weights[-1]
        return [pa.array(1 / (1 + np.exp(-np.clip(values, -30, 30))))]


def one_hot(bins: np.ndarray, size: int) -> np.ndarray:
    out = np.zeros((len(bins), size + 1), np.float32)
    out[np.arange(len(bins))[:, None], bins] = 1
    out[:, -1] = 1
    return out


def fit_nnpu(good: np.ndarray, web: np.ndarray, prior: float, l2: float = 1e-5, steps: int = 1000, rate: float = 0.05) -> np.ndarray:
    """Weights that minimise the non-negative unbiased risk with the logistic loss. Rows are 0/1 features with an offset.

    Full-batch Adam from zero weights. Returns zeros without positives.
    """
    weights = np.zeros(good.shape[1])
    if not len(good) or not len(web):
        return weights
    first, second = np.zeros_like(weights), np.zeros_like(weights)

    def parts(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        values = np.clip(rows @ weights.astype(np.float32), -30, 30).astype(float)
        return values, 1 / (1 + np.exp(-values))

    def mean_slope(error: np.ndarray, rows: np.ndarray) -> np.ndarray:
        return (error.astype(np.float32) @ rows).astype(float) / len(rows)

    for step in range(1, steps + 1):
        of_good, p_good = parts(good)
        of_web, p_web = parts(web)
        negative = np.logaddexp(0, of_web).mean() - prior * np.logaddexp(0, of_good).mean()
        rise = mean_slope(p_web, web) - prior * mean_slope(p_good, good)
        if negative >= 0:
            slope = prior * mean_slope(p_good - 1, good) + rise
        else:
            slope = -rise
        slope = slope + l2 * weights
        first = 0.9 * first + 0.1 * slope
        second = 0.99 * second + 0.01 * slope**2
        weights = weights - rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-10)
    return weights


def sampled_web(docs: DataFrame, bound: int, where: Column) -> DataFrame:
    """About ``bound`` texts. Rows with equal or missing ids are drawn each for itself, by their texts; equal rows count once."""
    rows = docs.select(F.col("doc_id"), F.col("text"), F.concat_ws(" ", F.col("doc_id").cast("string"), F.xxhash64("text").cast("string")).alias("row"))
    return rows.filter(sample_of(rows, bound, "row", where)).dropDuplicates(["doc_id", "text"]).drop("row")


def fit(docs: DataFrame, labels: DataFrame, where: Column, bound: int = 12_000, label: str = "quality") -> QualityModel:
    """Learn from rows for which ``where`` (on doc_id) holds. At most about ``bound`` positives and unlabelled texts."""
    trusted = labels.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(label).alias(label)).dropna().filter(where)
    seen = trusted.agg(F.count("*").alias("n"), F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).alias("good")).first()
    prior = min(0.99, max(0.01, (seen.good or 0) / max(1, seen.n)))
    positives = labelled_sample(docs, labels.filter(F.col(label) == 1), [label], bound, where)
    web = sampled_web(docs, bound, where)

    def measured(frame: DataFrame) -> np.ndarray:
        rows = with_measures(frame.select("text")).select("measures").toArrow().column("measures").to_pylist()
        return np.array(rows, float).reshape(-1, N_MEASURES)

    good, unlabelled = measured(positives), measured(web)
    features = FeatureMap(edges_of(unlabelled))
    if not len(good) or not len(unlabelled):
        return QualityModel(features, np.zeros(features.size + 1))
    return QualityModel(features, fit_nnpu(one_hot(features.bins(good), features.size), one_hot(features.bins(unlabelled), features.size), prior))


def with_score(docs: DataFrame, model: QualityModel, name: str) -> DataFrame:
    """All rows and columns of the documents with their score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return append(docs, lambda: shared.value, [field(name, "double")], ["text"])


def scores(docs: DataFrame, model: QualityModel) -> DataFrame:
    """doc_id, score (0 to 1, higher: better) and predicted (1 from 0.5)."""
    scored = with_score(docs.select("doc_id", "text"), model, "score")
    return scored.select("doc_id", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, model: QualityModel, least: float = 0.5) -> DataFrame:
    """The documents that score at least ``least``, with their own columns only."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    score = computed(lambda: lambda texts: shared.value(texts)[0], "double", [F.col("text")])
    (name,) = fresh(docs, "score")
    return docs.withColumn(name, score).filter(F.col(name) >= least).drop(name)

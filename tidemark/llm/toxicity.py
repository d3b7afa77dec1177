"""Toxicity by a chain of linear classifiers.

Categories are predicted in a given order. The model of each category sees the text's features and the probabilities of
all categories before it. While fitting, those probabilities come from models that have not seen the row (out of fold);
while scoring, from the category models themselves. Features are bins of measures and the presence of telling words and
word beginnings, chosen by chi-squared on the sample.

``bound`` limits the sample of labelled rows that the fit sees; scoring covers every document in one pass.

Defined cases: empty or missing texts get the probabilities of a text without words; without labelled rows every
probability is 0.5; repeated rows get equal results; further columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame

from tidemark.llm.common import append, field
from tidemark.llm.linear import FeatureMap, collected, fit_softmax, labelled_sample, learn_features, probabilities
from tidemark.session import materialise


def logits(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p)) / 4


@dataclass
class Chain:
    features: FeatureMap
    categories: list[str]
    weights: list[np.ndarray]

    def probabilities(self, numbers: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """rows x categories."""
        found = np.zeros((len(ends) - 1, 0))
        for weights in self.weights:
            own = probabilities(weights, self.features.size, numbers, ends, logits(found))[:, 1:]
            found = np.hstack([found, own])
        return found

    def __call__(self, texts: pa.Array) -> list[pa.Array]:
        found = self.probabilities(*self.features.rows(texts.to_pylist()))
        return [pa.array(np.ascontiguousarray(found[:, i])) for i in range(found.shape[1])]


def rows_at(numbers: np.ndarray, ends: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The chosen rows' features."""
    lists = [numbers[ends[i] : ends[i + 1]] for i in chosen]
    return np.concatenate([np.zeros(0, np.int64), *lists]), np.cumsum([0, *map(len, lists)])


def fit_chain(features: FeatureMap, numbers: np.ndarray, ends: np.ndarray, truth: np.ndarray, categories: list[str], folds: int = 3) -> Chain:
    """``truth``: rows x categories, 0 or 1, in the chain's order. Rows are dealt to folds in turn."""
    rows = len(ends) - 1
    before = np.zeros((rows, 0))
    weights = []
    for k in range(len(categories)):
        extra, target = logits(before), truth[:, k].astype(int)
        weights.append(fit_softmax(numbers, ends, features.size, target, 2, extra=extra))
        if k + 1 == len(categories):
            break
        unseen = np.zeros((rows, 1))
        for held in range(folds):
            out = np.arange(rows) % folds == held
            used, left = np.flatnonzero(~out), np.flatnonzero(out)
            part = fit_softmax(*rows_at(numbers, ends, used), features.size, target[used], 2, extra=extra[used])
            unseen[left, 0] = probabilities(part, features.size, *rows_at(numbers, ends, left), extra[left])[:, 1]
        before = np.hstack([before, unseen])
    return Chain(features, categories, weights)


def fit(docs: DataFrame, labels: DataFrame, categories: list[str], where: Column | None = None, bound: int = 8_000, words: int = 300) -> Chain:
    """Learn the categories (0/1 columns of ``labels``, keyed by doc_id) in the order given."""
    sample = materialise(labelled_sample(docs, labels, categories, bound, where), "chain-sample")
    features = learn_features(sample, categories, words)
    numbers, ends, truth = collected(sample, features, categories)
    return fit_chain(features, numbers, ends, truth > 0, categories)


def predict(docs: DataFrame, chain: Chain) -> DataFrame:
    """doc_id and one column ``p_<category>`` per category."""
    shared = docs.sparkSession.sparkContext.broadcast(chain)
    fields = [field(f"p_{c}", "double") for c in chain.categories]
    return append(docs.select("doc_id", "text"), lambda: shared.value, fields, ["text"]).drop("text")

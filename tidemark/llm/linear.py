"""Text features and small linear models: measured on the executors, fitted on bounded samples.

A text's features are the bins of some twenty measures (length, shares of character classes, repetition) and, where a
vocabulary is given, the presence of words and word beginnings. All features are 0 or 1; a text has a list of numbers.
"""

from __future__ import annotations

import operator
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import append, uniform
from tidemark.llm.common import field as column
from tidemark.llm.decontaminate import FOLDED
from tidemark.session import materialise

_CLASSES = [b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t", b"|", b"#*$%&<>", b".,;:", b"!?"]
CLASS_OF = np.full(256, len(_CLASSES), np.int64)  # everything else in ASCII
for _number, _members in enumerate(_CLASSES):
    CLASS_OF[list(_members)] = _number
CLASS_OF[10] = len(_CLASSES) + 1
CLASS_OF[128:] = len(_CLASSES) + 2
N_CLASSES = len(_CLASSES) + 3
N_MEASURES = N_CLASSES + 7


def measures(text: str | None) -> list[float]:
    """The measures of one text; all 0 for an empty one."""
    held = (text or "").encode("utf-8", "surrogatepass")
    if not held:
        return [0.0] * N_MEASURES
    counts = np.bincount(np.frombuffer(held, np.uint8), minlength=256)
    shares = np.bincount(CLASS_OF, counts, N_CLASSES) / len(held)
    words = held.split()
    n = max(1, len(words))
    lines = [x for x in held.split(b"\n") if x.strip()]
    return [
        *shares.tolist(), np.log1p(len(held)), len(held) / n, len(set(words)) / n, sum(map(operator.eq, words, words[1:])) / n,
        (len(lines) - len(set(lines))) / max(1, len(lines)), np.log1p(n / max(1, len(lines))), len(zlib.compress(held, 1)) / len(held),
    ]


def marks(text: str | None) -> set[bytes]:
    """The text's distinct lower-cased words and their beginnings of four and five bytes (ending in ``-``)."""
    words = set((text or "").encode("utf-8", "surrogatepass").translate(FOLDED).split())
    return words | {w[:4] + b"-" for w in words if len(w) > 4} | {w[:5] + b"-" for w in words if len(w) > 5}


@dataclass
class FeatureMap:
    """Which number a feature has. Bins of measures come first, words after them."""

    edges: np.ndarray  # measures x (bins - 1), ascending in each row
    words: dict[bytes, int] = field(default_factory=dict)

    @property
    def size(self) -> int:
        return self.edges.shape[0] * (self.edges.shape[1] + 1) + len(self.words)

    def bins(self, measured: np.ndarray) -> np.ndarray:
        """rows x measures: the number of each measure's bin."""
        width = self.edges.shape[1] + 1
        out = np.empty(measured.shape, np.int64)
        for i, edges in enumerate(self.edges):
            out[:, i] = i * width + np.searchsorted(edges, measured[:, i], "right")
        return out

    def rows(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Feature numbers of all texts one after the other, and where each text's begin and end."""
        bins = self.bins(np.array([measures(t) for t in texts], float).reshape(-1, N_MEASURES))
        if not self.words:
            return bins.ravel(), np.arange(len(texts) + 1) * bins.shape[1]
        known, get = self.words.keys(), self.words.__getitem__
        lists = [own.tolist() + sorted(map(get, known & marks(t))) for own, t in zip(bins, texts)]
        ends = np.cumsum([0, *map(len, lists)])
        return np.fromiter((x for own in lists for x in own), np.int64, ends[-1]), ends


def edges_of(measured: np.ndarray, bins: int = 16) -> np.ndarray:
    """Bin edges from the sample: quantiles of each measure, and of its values above the smallest one.

    The second half tells the many texts that have nothing of a class from those that have a little.
    """
    out = np.zeros((measured.shape[1] if len(measured) else N_MEASURES, bins - 1))
    half = bins // 2
    for i in range(len(out) if len(measured) else 0):
        values = measured[:, i]
        above = values[values > values.min()]
        above = above if len(above) else values
        lowest = np.nextafter(values.min(), np.inf)
        out[i] = np.sort([lowest, *np.quantile(values, np.arange(1, half) / half), *np.quantile(above, (np.arange(half - 1) + 0.5) / (half - 1))])
    return out


def summed(weights: np.ndarray, features: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Per text the sum of its features' rows of ``weights``."""
    out = np.zeros((len(ends) - 1, weights.shape[1]))
    full = ends[1:] > ends[:-1]
    if full.any():
        out[full] = np.add.reduceat(weights[features], ends[:-1][full], axis=0)
    return out


def softmax(values: np.ndarray) -> np.ndarray:
    e = np.exp(values - values.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit_softmax(features: np.ndarray, ends: np.ndarray, size: int, target: np.ndarray, classes: int, l2: float = 1e-4, steps: int = 150, extra: np.ndarray | None = None) -> np.ndarray:
    """Weights ``(size + extra columns + 1) x classes`` of a multinomial logistic model; the last row is the offset.

    ``target`` are class numbers. Full-batch Adam from zero weights, so the result does not depend on chance.
    """
    rows = len(ends) - 1
    extra = np.zeros((rows, 0)) if extra is None else extra
    weights = np.zeros((size + extra.shape[1] + 1, classes))
    if not rows:
        return weights
    row_of = np.repeat(np.arange(rows), np.diff(ends))
    truth = np.eye(classes)[target]
    first, second = np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, steps + 1):
        error = (softmax(summed(weights[:size], features, ends) + extra @ weights[size:-1] + weights[-1]) - truth) / rows
        slope = l2 * weights
        for k in range(classes):
            slope[:size, k] += np.bincount(features, error[row_of, k], size)
        slope[size:-1] += extra.T @ error
        slope[-1] = error.sum(axis=0)
        first = 0.9 * first + 0.1 * slope
        second = 0.99 * second + 0.01 * slope**2
        weights -= 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-10)
    return weights


def probabilities(weights: np.ndarray, size: int, features: np.ndarray, ends: np.ndarray, extra: np.ndarray | None = None) -> np.ndarray:
    values = summed(weights[:size], features, ends) + weights[-1]
    return softmax(values if extra is None else values + extra @ weights[size:-1])


def sample_of(frame: DataFrame, bound: int, key: str, where: Column | None = None) -> Column:
    """A filter on the key that keeps about ``bound`` of the frame's rows, the same ones for equal keys."""
    count = (frame if where is None else frame.filter(where)).count()
    kept = uniform(F.concat(F.lit("sample "), F.coalesce(F.col(key).cast("string"), F.lit("")))) < min(1.0, bound / max(1, count))
    return kept if where is None else kept & where


def labelled_sample(docs: DataFrame, labels: DataFrame, columns: list[str], bound: int, where: Column | None = None) -> DataFrame:
    """doc_id, text and label columns of about ``bound`` labelled documents.

    Repeated label rows of a document count once, by their largest values; documents without all labels are left out.
    Only sampled rows are shuffled.
    """
    known = labels.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(*(F.max(c).alias(c) for c in columns)).dropna()
    kept = sample_of(known, bound, "doc_id", where)
    texts = docs.select("doc_id", "text").filter(kept).dropDuplicates(["doc_id"])
    return known.filter(kept).join(texts, "doc_id").select("doc_id", "text", *columns)


def with_measures(frame: DataFrame) -> DataFrame:
    def make():
        return lambda texts: [pa.array([measures(t) for t in texts.to_pylist()], pa.list_(pa.float64()))]

    return append(frame, make, [column("measures", "array<double>")], ["text"])


def telling_words(sample: DataFrame, targets: list[str], count: int, least: int = 5) -> list[str]:
    """Words and beginnings whose presence tells most about one of the 0/1 columns: the largest chi-squared values.

    ``count`` per column; ties are broken by the word. ``sample`` is bounded; its words are counted by Spark.
    """

    def make():
        return lambda texts: [pa.array([[m.decode("utf-8", "replace") for m in marks(t)] for t in texts.to_pylist()], pa.list_(pa.string()))]

    wanted = sample.select("text", *(F.col(t).cast("double").alias(f"y{i}") for i, t in enumerate(targets)))
    seen = append(wanted, make, [column("marks", "array<string>")], ["text"]).drop("text")
    total = sample.agg(F.count("*").alias("n"), *(F.coalesce(F.sum(t), F.lit(0)).cast("double").alias(f"y{i}") for i, t in enumerate(targets))).first()
    n = float(total.n)
    sums = [F.sum(f"y{i}").alias(f"y{i}") for i in range(len(targets))]
    counts = seen.withColumn("mark", F.explode("marks")).groupBy("mark").agg(F.count("*").alias("df"), *sums).filter(F.col("df") >= least)
    counts = materialise(counts, "mark-counts")
    chosen: set[str] = set()
    for i in range(len(targets)):
        ones = total[f"y{i}"]
        if 0 < ones < n:
            gap = F.col(f"y{i}") * n - F.col("df") * ones
            value = gap * gap / (F.col("df") * (n - F.col("df") + 1) * ones * (n - ones))
            chosen.update(row.mark for row in counts.select("mark", value.alias("value")).orderBy(F.desc("value"), "mark").limit(count).collect())
    return sorted(chosen)


def learn_features(sample: DataFrame, targets: list[str], words: int) -> FeatureMap:
    """Bins of the sample's measures, and the telling words of the 0/1 columns."""
    measured = with_measures(sample.select("text")).select("measures").toArrow().column("measures").to_pylist()
    features = FeatureMap(edges_of(np.array(measured, float).reshape(-1, N_MEASURES)))
    first = features.size
    features.words = {word.encode(): first + i for i, word in enumerate(telling_words(sample, targets, words))}
    return features


def collected(sample: DataFrame, features: FeatureMap, targets: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a bounded sample, in order of doc_id: feature numbers, where each row's end, and rows x targets."""
    shared = sample.sparkSession.sparkContext.broadcast(features)

    def make():
        def listed(texts: pa.Array) -> list[pa.Array]:
            numbers, ends = shared.value.rows(texts.to_pylist())
            return [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(numbers, pa.int32()))]

        return listed

    known = append(sample, make, [column("numbers", "array<int>")], ["text"]).select("numbers", *targets, "doc_id").orderBy("doc_id").toArrow()
    truth = np.array([known.column(c).to_numpy() for c in targets], float).T.reshape(-1, len(targets))
    lists = known.column("numbers").to_pylist()
    return np.fromiter((x for own in lists for x in own), np.int64), np.cumsum([0, *map(len, lists)]), truth

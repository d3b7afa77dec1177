"""Hyperparameter trials as tables: sampling, pruning and ranking."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.scan import cut_points, medians
from tidemark.session import materialise


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) that depends on nothing but its inputs: 32 bits of their digest."""
    digest = F.substring(F.md5(F.concat_ws("|", *parts)), 1, 8)
    return F.conv(digest, 16, 10).cast("double") / F.lit(2.0**32)


def sample_trials(space: DataFrame, n_trials: int = 20, structures: int | None = None, staged: str | None = None) -> DataFrame:
    """Parameter values of every trial: model_name, trial_no, param, value (number), text (category).

    ``space``: model_name, param, kind (int, float, categorical, fixed), low, high, log, fixed, choices.
    Integers include both ends; log floats are uniform in the logarithm; fixed values pass through and
    win over a tuned entry of the same name.

    With ``structures`` the trials share that many draws of all parameters but ``staged``, the one that counts the trees:
    trial t has draw t modulo ``structures``, and its own number of trees.
    """
    fixed_names = F.max((F.col("kind") == "fixed").cast("int"))
    has_fixed = space.groupBy("model_name", "param").agg(fixed_names.alias("_has_fixed"))
    chosen = space.join(has_fixed, ["model_name", "param"]).filter((F.col("_has_fixed") == 0) | (F.col("kind") == "fixed"))
    trials = chosen.withColumn("trial_no", F.explode(F.sequence(F.lit(0), F.lit(n_trials - 1))))
    draw = F.col("trial_no")
    if structures is not None:
        draw = F.when(F.col("param") == F.lit(staged), draw).otherwise(draw % F.lit(structures))
    u = uniform(F.col("model_name"), draw.cast("string"), F.col("param"))
    low, high = F.col("low").cast("double"), F.col("high").cast("double")
    positive = F.when(low > 0, low)
    value = (
        F.when(F.col("kind") == "int", F.floor(low + u * (high - low + 1)).cast("double"))
        .when((F.col("kind") == "float") & F.col("log"), F.exp(F.ln(positive) + u * (F.ln(F.when(high > 0, high)) - F.ln(positive))))
        .when(F.col("kind") == "float", low + u * (high - low))
        .when(F.col("kind") == "fixed", F.col("fixed").try_cast("double"))
    )
    pick = F.floor(u * F.size("choices")).cast("int") + 1
    text = F.when(F.col("kind") == "categorical", F.try_element_at("choices", pick)).when(F.col("kind") == "fixed", F.col("fixed"))
    return trials.select("model_name", "trial_no", "param", value.alias("value"), text.alias("text"))


def median_prune(trial_scores: DataFrame, n_steps: int, n_startup: int = 5) -> DataFrame:
    """Which trials stop at which step: model_name, trial_no, step, value, best, median, pruned.

    ``trial_scores``: model_name, trial_no, step (from 0), value to be minimised. At each step the trials
    still running report; a trial whose best value so far is above the exact median of that step's values
    stops, unless fewer than ``n_startup`` others reported. Stopped trials have no rows for later steps.
    """
    cuts = cut_points(trial_scores.filter("value IS NOT NULL"), "value")
    alive: DataFrame | None = None
    out: DataFrame | None = None
    for step in range(n_steps):
        now = trial_scores.filter(F.col("step") == step).select("model_name", "trial_no", "step", "value")
        if alive is None:
            now = now.withColumn("best", F.col("value"))
        else:
            now = now.join(alive, ["model_name", "trial_no"])
            now = now.withColumn("best", F.least("value", "_best")).drop("_best")
        middle = medians(now, ["model_name"], "value", cuts)
        judged = now.join(middle, "model_name", "left")
        enough = F.coalesce(F.col("n"), F.lit(0)) - 1 >= n_startup
        judged = judged.withColumn("pruned", F.coalesce(enough & (F.col("best") > F.col("median")), F.lit(False))).drop("n")
        # Stored: the next step starts from it, and the plan would grow threefold with every step.
        judged = materialise(judged, "judged")
        out = judged if out is None else out.unionByName(judged)
        alive = judged.filter(~F.col("pruned")).select("model_name", "trial_no", F.col("best").alias("_best"))
    return out


def rank_trials(trial_scores: DataFrame, weights: list[float]) -> DataFrame:
    """The weighted score of every finished trial, the best trial of each model marked.

    A trial counts only with a value for every step. Of equal scores the earlier trial wins. The best is
    an aggregate joined back, so no model's trials are gathered to be sorted.
    """
    table = F.array(*[F.lit(w) for w in weights])
    weight = F.get(table, F.col("step"))
    mean = F.sum(weight * F.col("value")) / F.lit(math.fsum(weights))
    complete = F.count(F.when(weight.isNotNull(), F.col("value"))) == len(weights)
    scored = trial_scores.groupBy("model_name", "trial_no").agg(mean.alias("score"), complete.alias("_complete"))
    scored = scored.filter("_complete").drop("_complete")
    best = scored.groupBy("model_name").agg(F.min(F.struct("score", "trial_no")).alias("_best"))
    marked = scored.join(best, "model_name")
    return marked.select("model_name", "trial_no", "score", (F.col("trial_no") == F.col("_best.trial_no")).alias("is_best"))

"""Queries on trials, and model fits with Spark's own learners (those have no SQL twin)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.metrics import METRICS, regression_metrics
from tidemark.operators import training as t
from tidemark.operators.tuning import median_prune, rank_trials, sample_trials
from tidemark.operators.windows import split_weights
from tidemark.plans.train import Prepared, prepare, sweep_lines, train_pipeline, training_output, tune
from tidemark.queries import views as v
from tidemark.queries.catalog import query
from tidemark.session import materialise, scratch_path
from tidemark.sources.tables import load_table

_U = "(('0x' || substr(md5(model_name || '|' || trial_no || '|' || param), 1, 8))::BIGINT / 4294967296e0)"


@query(
    "trial_grid",
    "SELECT model_name, CAST(trial_no AS INT) AS trial_no, param, round(CASE kind WHEN 'int' THEN floor(low + u * (high - low + 1)) "
    "WHEN 'float' THEN low + u * (high - low) WHEN 'log' THEN exp(ln(low) + u * (ln(high) - ln(low))) WHEN 'fixed' THEN 42 END, 6) AS value, "
    "CASE kind WHEN 'categorical' THEN (['squared', 'absolute', 'huber'])[CAST(floor(u * 3) AS INT) + 1] WHEN 'fixed' THEN '42' END AS text "
    f"FROM (SELECT *, {_U} AS u FROM f_space, range(20) r(trial_no))",
    "f_space",
)
def trial_grid(spark: SparkSession, sf: str) -> DataFrame:
    return sample_trials(v.space(spark, sf), 20).withColumn("value", F.round("value", 6))


@query(
    "median_prune",
    "WITH first AS (SELECT *, value AS best, median(value) OVER w AS median, count(*) OVER w AS n FROM f_trial_scores WHERE step = 0 WINDOW w AS (PARTITION BY model_name)), "
    "kept AS (SELECT * FROM first WHERE NOT (n - 1 >= 5 AND best > median)), "
    "second AS (SELECT s.*, least(s.value, k.best) AS best FROM f_trial_scores s JOIN kept k USING (model_name, trial_no) WHERE s.step = 1), "
    "judged AS (SELECT *, median(value) OVER w AS median, count(*) OVER w AS n FROM second WINDOW w AS (PARTITION BY model_name)) "
    "SELECT model_name, trial_no, step, round(median, 4) AS median, n - 1 >= 5 AND best > median AS pruned FROM "
    "(SELECT model_name, trial_no, step, best, median, n FROM first UNION ALL SELECT model_name, trial_no, step, best, median, n FROM judged)",
    "f_trial_scores",
)
def pruned(spark: SparkSession, sf: str) -> DataFrame:
    judged = median_prune(v.trial_scores(spark, sf), 2)
    return judged.select("model_name", "trial_no", "step", F.round("median", 4).alias("median"), "pruned")


@query(
    "rank_trials",
    "SELECT model_name, trial_no, round(score, 4) AS score, row_number() OVER (PARTITION BY model_name ORDER BY score, trial_no) = 1 AS is_best FROM "
    "(SELECT model_name, trial_no, sum(value * CASE step WHEN 0 THEN 0.3e0 / 1.3e0 ELSE 1e0 / 1.3e0 END) AS score FROM f_trial_scores GROUP BY model_name, trial_no)",
    "f_trial_scores",
)
def ranked(spark: SparkSession, sf: str) -> DataFrame:
    return rank_trials(v.trial_scores(spark, sf), split_weights(2)).withColumn("score", F.round("score", 4))


# Small settings that keep the fits of trees short; the README has the time of settings from SPACES.
_QUICK = {
    "linear": {"regParam": 0.01},
    "random_forest": {"numTrees": 5, "maxDepth": 3, "seed": 42},
    "gbt": {"maxIter": 3, "maxDepth": 3, "seed": 42},
    "xgboost": {"maxIter": 3, "maxDepth": 3, "featureSubsetStrategy": "0.8", "seed": 42},
    "lightgbm": {"maxIter": 3, "maxDepth": 3, "minInstancesPerNode": 10, "seed": 42},
    "catboost": {"maxIter": 3, "maxDepth": 4, "seed": 42},
}


def _prepared(spark: SparkSession, sf: str) -> Prepared:
    return prepare(v.features(spark, sf), v.actuals(spark, sf), v.TRAINING, "total_cost", categorical=["o_orderstatus", "o_orderpriority"])


@query("train_ml_families")
def families(spark: SparkSession, sf: str) -> DataFrame:
    """Each family once on the most recent split, measured on its test rows."""
    ready = _prepared(spark, sf)
    rows = t.numeric_features(ready.rows, ready.features, ready.target, categories=ready.categories)
    last = materialise(rows.filter(F.col("split_no") == ready.splits.agg(F.max("split_no")).scalar()), "last-split")
    out = None
    for family, params in _QUICK.items():
        model = t.make_estimator(family, params, ready.features, ready.target, ready.categories).fit(last.filter("role = 'train'"))
        scored = model.transform(last.filter("role = 'test'"))
        row = regression_metrics(scored, ready.target, "prediction").select(F.lit(family).alias("family"), "*")
        out = row if out is None else out.unionByName(row)
    return out


# The sums of products of every split, and coordinate descent on them: from the end result backwards, all trials of the
# linear space with their scores.
_COLUMNS = ["req_year", "req_month", "req_day", "o_custkey", "o_totalprice", "o_orderstatus", "o_orderpriority"]
_P = len(_COLUMNS)
_DRAWN = "(('0x' || substr(md5('linear|' || CAST(t AS VARCHAR) || '|{}'), 1, 8))::BIGINT / 4294967296e0)"
_VALUES = ", ".join(f"CAST(r.{c} AS DOUBLE)" for c in _COLUMNS[:5])
_LINEAR = (
    "WITH RECURSIVE codes_s AS (SELECT DISTINCT o_orderstatus AS s, dense_rank() OVER (ORDER BY o_orderstatus) - 1 AS cs FROM f_split_rows WHERE split_no = 1 AND o_orderstatus IS NOT NULL), "
    "codes_p AS (SELECT DISTINCT o_orderpriority AS p, dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS cp FROM f_split_rows WHERE split_no = 1 AND o_orderpriority IS NOT NULL), "
    f"x AS (SELECT r.split_no, r.split_name, r.weight, r.role, [{_VALUES}, CAST(cs AS DOUBLE), CAST(cp AS DOUBLE), CAST(total_cost AS DOUBLE)] AS v "
    "FROM f_split_rows r LEFT JOIN codes_s ON r.o_orderstatus = s LEFT JOIN codes_p ON r.o_orderpriority = p WHERE total_cost IS NOT NULL), "
    f"m AS (SELECT split_no, [{', '.join(f'avg(v[{i}])' for i in range(1, _P + 2))}] AS m FROM x WHERE role = 'train' GROUP BY split_no), "
    "d AS (SELECT x.split_no, split_name, weight, role, v, m, list_transform(list_zip(v, m), lambda z: coalesce(z[1] - z[2], 0e0)) AS d FROM x JOIN m USING (split_no)), "
    "g AS (SELECT split_no, role, ["
    + ", ".join("[" + ", ".join(f"avg(d[{i}] * d[{j}])" for j in range(1, _P + 2)) + "]" for i in range(1, _P + 2))
    + "] AS g FROM d GROUP BY split_no, role), "
    f"t AS (SELECT t, exp(ln(1e-4) + {_DRAWN.format('regParam')} * (ln(1e0) - ln(1e-4))) AS strength, {_DRAWN.format('elasticNetParam')} AS mixing FROM range(20) r(t)), "
    f"k AS (SELECT split_no, t, strength * mixing / sqrt(g[{_P + 1}][{_P + 1}]) AS l1, strength * (1 - mixing) / sqrt(g[{_P + 1}][{_P + 1}]) AS l2, "
    f"list_transform(range(1, {_P + 1}), lambda i: list_transform(range(1, {_P + 1}), lambda j: g[i][j] / sqrt(g[i][i] * g[j][j]))) AS a, "
    f"list_transform(range(1, {_P + 1}), lambda i: g[i][{_P + 1}] / sqrt(g[i][i] * g[{_P + 1}][{_P + 1}])) AS b FROM g, t WHERE role = 'train'), "
    f"w(split_no, t, turn, w) AS (SELECT split_no, t, 0, [{', '.join(['0e0'] * _P)}] FROM k UNION ALL "
    "SELECT split_no, t, turn + 1, list_reduce(list_prepend(w, list_transform(range(1, " + str(_P + 1) + "), lambda i: [CAST(i AS DOUBLE)])), "
    "lambda acc, i: list_transform(acc, lambda old, j: CASE WHEN j <> i[1] THEN old ELSE "
    "(CASE WHEN b[j] - list_dot_product(a[j], acc) + a[j][j] * old < 0 THEN -1 ELSE 1 END) * greatest(0, abs(b[j] - list_dot_product(a[j], acc) + a[j][j] * old) - l1) / (a[j][j] + l2) END)) "
    "FROM w JOIN k USING (split_no, t) WHERE turn < 60), "
    f"beta AS (SELECT split_no, t, list_transform(w, lambda z, i: z * sqrt(g[{_P + 1}][{_P + 1}] / g[i][i])) AS beta FROM w JOIN g USING (split_no) WHERE turn = 60 AND role = 'train'), "
    "scores AS (SELECT b.split_no AS step, t AS trial_no, sqrt(list_sum(list_transform(list_append(list_transform(beta, lambda z: -z), 1e0), lambda z, i: "
    "z * list_dot_product(g[i], list_append(list_transform(beta, lambda q: -q), 1e0))))) AS value FROM beta b JOIN g ON g.split_no = b.split_no AND g.role = 'test'), "
    "stopped0 AS (SELECT trial_no FROM (SELECT trial_no, value > median(value) OVER () AS out FROM scores WHERE step = 0) WHERE out), "
    "left0 AS (SELECT s.trial_no, s.value, least(s.value, f.value) AS best FROM scores s JOIN scores f ON f.trial_no = s.trial_no AND f.step = 0 WHERE s.step = 1 AND s.trial_no NOT IN (SELECT trial_no FROM stopped0)), "
    "alive AS (SELECT trial_no FROM (SELECT trial_no, best > median(value) OVER () AS out FROM left0) WHERE NOT out), "
    "ranking AS (SELECT trial_no, sum(value * CASE step WHEN 0 THEN 0.3e0 / 1.3e0 ELSE 1e0 / 1.3e0 END) AS score FROM scores WHERE trial_no IN (SELECT trial_no FROM alive) GROUP BY trial_no), "
    "best AS (SELECT trial_no FROM ranking ORDER BY score, trial_no LIMIT 1), "
    f"tested AS (SELECT d.split_no, split_name, weight, v[{_P + 1}] AS y, m[{_P + 1}] + list_dot_product(beta, d[1:{_P}]) AS p FROM d JOIN beta USING (split_no) WHERE role = 'test' AND t = (SELECT trial_no FROM best)), "
    "measured AS (SELECT split_no, split_name, weight, {metrics} FROM tested GROUP BY split_no, split_name, weight) "
)


@query("split_metrics_ml", _LINEAR + "SELECT * REPLACE (round(weight, 9) AS weight) FROM measured", "f_split_rows")
def split_metrics_ml(spark: SparkSession, sf: str) -> DataFrame:
    """The best trial of the linear space on every split."""
    swept = sweep_lines(_prepared(spark, sf), n_trials=20)
    best = swept.split_metrics.filter(F.col("trial_no") == swept.best_trial).drop("model_name", "trial_no")
    return v.rounded(best).withColumn("weight", F.round("weight", 9))


@query(
    "trial_sweep",
    _LINEAR + "SELECT 'linear' AS model_name, CAST(trial_no AS INT) AS trial_no, round(score, 4) AS score, trial_no = (SELECT trial_no FROM best) AS is_best FROM ranking",
    "f_split_rows",
)
def sweep(spark: SparkSession, sf: str) -> DataFrame:
    """The trials that were not pruned, ranked."""
    return sweep_lines(_prepared(spark, sf), n_trials=20).ranking.withColumn("score", F.round("score", 4))


@query(
    "best_trial_refit",
    _LINEAR
    + " UNION ALL ".join(f"SELECT 'best_{m}_' || split_name AS key, round({m}, {v.DIGITS[m]}) AS value FROM measured" for m in METRICS)
    + " UNION ALL SELECT 'best_weighted_mean_rmse', round(sum(weight * rmse) / sum(weight), 4) FROM measured",
    "f_split_rows",
)
def refit(spark: SparkSession, sf: str) -> DataFrame:
    """The winner of the sweep on every split; its metrics as a run logs them."""
    logged = tune(_prepared(spark, sf), "linear", n_trials=20).run_metrics
    digits = F.when(F.col("key").rlike("_(mape|wmape|smape|r2)_"), F.round("value", 6)).otherwise(F.round("value", 4))
    return logged.select("key", digits.alias("value"))


@query(
    "training_outputs",
    _LINEAR + ", counted AS (SELECT split_no, count(*) FILTER (role = 'train') AS n_train, count(*) FILTER (role = 'test') AS n_test FROM f_split_rows GROUP BY split_no) "
    "SELECT 'linear' AS family, (SELECT CAST(trial_no AS INT) FROM best) AS trial_no, m.* EXCLUDE (weight), train_start, train_end, test_start, test_end, n_train, n_test, "
    "n_test AS n_predictions FROM measured m JOIN f_splits s USING (split_no, split_name) JOIN counted USING (split_no)",
    "f_split_rows f_splits",
)
def training_outputs(spark: SparkSession, sf: str) -> DataFrame:
    """The training flow of the linear family, read back from what it wrote: the best trial's full metric rows, and how
    many predictions the most recent split has."""
    folder = scratch_path(spark, "training")
    ready = _prepared(spark, sf)
    train_pipeline(ready, folder, "run", ["linear"], keys=["po"], fail_fast=True)
    best = v.rounded(training_output(spark, folder, "run", "best_metrics", ["linear"])).drop("model_name", "weight")
    written = load_table(spark, f"{folder}/run/split_rows").filter("role = 'test'").groupBy("split_name").agg(F.count("*").alias("n_predictions"))
    last = training_output(spark, folder, "run", "predictions", ["linear"]).agg(F.count("residual").alias("n")).scalar()
    newest = F.col("split_no") == ready.splits.agg(F.max("split_no")).scalar()
    return best.join(written, "split_name").withColumn("n_predictions", F.when(newest, last).otherwise(F.col("n_predictions")))

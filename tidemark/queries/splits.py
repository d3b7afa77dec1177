"""Queries on training sets, time splits and error metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.contract import EVENT_DATE
from tidemark.functions.metrics import METRICS, regression_metrics, weighted_score
from tidemark.operators import training as t
from tidemark.operators.runs import log_run_metrics
from tidemark.operators.windows import split_anchor, split_rows, split_sizes, time_splits, with_event_date
from tidemark.queries import views as v
from tidemark.queries.catalog import query
from tidemark.session import materialise

_FEATURES = ["req_year", "req_month", "req_day", "o_custkey", "o_totalprice", "o_orderstatus", "o_orderpriority"]


def _dated(spark: SparkSession, sf: str) -> DataFrame:
    return with_event_date(v.training(spark, sf), v.TRAINING)


def _stored(spark: SparkSession, sf: str) -> DataFrame:
    """The dated rows as files: anchor, splits and rows all start from them."""
    return materialise(_dated(spark, sf), "training-rows")


def _splits(dated: DataFrame) -> DataFrame:
    return time_splits(dated, EVENT_DATE, anchor=split_anchor(dated, EVENT_DATE))


def split_table(spark: SparkSession, sf: str) -> DataFrame:
    dated = _stored(spark, sf)
    return split_rows(dated, _splits(dated), EVENT_DATE)


def _last(rows: DataFrame) -> DataFrame:
    """Rows of the most recent split."""
    return rows.filter(F.col("split_no") == rows.agg(F.max("split_no")).scalar())


@query("training_set", "SELECT * EXCLUDE (event_date) REPLACE (round(total_cost, 4) AS total_cost) FROM f_training", "f_training")
def training_set(spark: SparkSession, sf: str) -> DataFrame:
    return v.training(spark, sf).withColumn("total_cost", F.round("total_cost", 4))


@query("training_dates", "SELECT po, d FROM f_train_dates", "f_train_dates")
def training_dates(spark: SparkSession, sf: str) -> DataFrame:
    return _dated(spark, sf).select("po", F.col(EVENT_DATE).alias("d"))


@query("split_anchor", "SELECT anchor, CAST(n0 AS BIGINT) AS n0, CAST(n1 AS BIGINT) AS n1 FROM f_anchor", "f_anchor")
def anchor(spark: SparkSession, sf: str) -> DataFrame:
    return split_anchor(_dated(spark, sf), EVENT_DATE)


@query("time_splits", "SELECT * REPLACE (round(weight, 9) AS weight) FROM f_splits", "f_splits")
def splits(spark: SparkSession, sf: str) -> DataFrame:
    return _splits(_stored(spark, sf)).withColumn("weight", F.round("weight", 9))


@query("split_rows", "SELECT split_no, role, po FROM f_split_rows", "f_split_rows")
def rows_by_split(spark: SparkSession, sf: str) -> DataFrame:
    return split_table(spark, sf).select("split_no", "role", "po")


@query(
    "split_summary",
    "SELECT split_no, split_name, train_start, train_end, test_start, test_end, n_train, n_test, 7 AS n_features, 'o_orderstatus,o_orderpriority' AS categorical_features, 'total_cost' AS target "
    "FROM f_splits JOIN (SELECT split_no, count(*) FILTER (role = 'train') AS n_train, count(*) FILTER (role = 'test') AS n_test "
    "FROM f_split_rows GROUP BY split_no) USING (split_no)",
    "f_splits f_split_rows",
)
def split_summary(spark: SparkSession, sf: str) -> DataFrame:
    dated = _stored(spark, sf)
    found = _splits(dated)
    return split_sizes(split_rows(dated, found, EVENT_DATE), found, _FEATURES, "total_cost", ["o_orderstatus", "o_orderpriority"])


def _ols_metrics(spark: SparkSession, sf: str) -> DataFrame:
    rows = split_table(spark, sf)
    lines = v.rounded_line(t.fit_lines(rows.filter("role = 'train'"), "o_totalprice", "total_cost", ["split_no"]))
    return t.evaluate_lines(rows, "o_totalprice", "total_cost", lines)


@query(
    "split_metrics_ols", "SELECT * REPLACE (round(weight, 9) AS weight) FROM f_split_metrics", "f_split_metrics"
)
def split_metrics_ols(spark: SparkSession, sf: str) -> DataFrame:
    return v.rounded(_ols_metrics(spark, sf)).withColumn("weight", F.round("weight", 9))


@query(
    "weighted_score",
    " UNION ALL ".join(f"SELECT '{m}' AS metric, round(sum(weight * {m}) / sum(weight), 4) AS score FROM f_split_metrics" for m in METRICS),
    "f_split_metrics",
)
def weighted(spark: SparkSession, sf: str) -> DataFrame:
    measured = _ols_metrics(spark, sf)
    long = measured.unpivot(["weight"], list(METRICS), "metric", "value")
    return weighted_score(long, "value", ["metric"]).withColumn("score", F.round("score", 4))


@query("regression_metrics", "SELECT {metrics} FROM f_scored", "f_scored")
def metrics_overall(spark: SparkSession, sf: str) -> DataFrame:
    scored = v.table(spark, sf, "lineitem").selectExpr(*v.SCORED)
    return v.rounded(regression_metrics(scored, "y", "p"))


@query(
    "regression_metrics_by_group",
    "SELECT l_returnflag, l_linestatus, {metrics} FROM f_scored GROUP BY l_returnflag, l_linestatus",
    "f_scored",
)
def metrics_by_group(spark: SparkSession, sf: str) -> DataFrame:
    scored = v.table(spark, sf, "lineitem").selectExpr(*v.SCORED)
    return v.rounded(regression_metrics(scored, "y", "p", ["l_returnflag", "l_linestatus"]))


@query(
    "predictions_residuals",
    "SELECT po, round(y, 4) AS y_true, p AS y_pred, round(y, 4) - p AS residual FROM f_tested "
    "WHERE split_no = (SELECT max(split_no) FROM f_splits)",
    "f_tested f_splits",
)
def residuals(spark: SparkSession, sf: str) -> DataFrame:
    rows = _last(split_table(spark, sf))
    lines = v.rounded_line(t.fit_lines(rows.filter("role = 'train'"), "o_totalprice", "total_cost", ["split_no"]))
    scored = t.score_lines(rows.filter("role = 'test'"), lines, "o_totalprice")
    # Costs have four decimals; rounding takes off the noise of their summation order.
    return t.predictions(scored.withColumn("total_cost", F.round("total_cost", 4)), ["po"], "total_cost", "y_pred")


@query(
    "category_codes",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {c} AS value, CAST(row_number() OVER (ORDER BY {c}) - 1 AS INT) AS code FROM "
        f"(SELECT DISTINCT {c} FROM f_split_rows WHERE split_no = 1 AND {c} IS NOT NULL)"
        for c in ("o_orderpriority", "o_orderstatus")
    ),
    "f_split_rows",
)
def codes(spark: SparkSession, sf: str) -> DataFrame:
    return t.category_codes(_last(split_table(spark, sf)), ["o_orderpriority", "o_orderstatus"])


_CATEGORIES = ("o_orderpriority", "o_orderstatus")


def _earlier(what: str, column: str) -> str:
    return (
        f"coalesce({what}(CASE WHEN role = 'train' THEN total_cost END) OVER (PARTITION BY split_no, {column} "
        "ORDER BY CASE role WHEN 'train' THEN d END NULLS LAST, po ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)"
    )


@query(
    "ordered_statistics",
    "SELECT split_no, po, role, "
    + ", ".join(f"round(({_earlier('sum', c)} + mean) / ({_earlier('count', c)} + 1), 2) AS {c}" for c in _CATEGORIES)
    + " FROM (SELECT *, avg(CASE WHEN role = 'train' THEN total_cost END) OVER (PARTITION BY split_no) AS mean FROM f_split_rows)",
    "f_split_rows",
)
def ordered_statistics(spark: SparkSession, sf: str) -> DataFrame:
    coded = t.ordered_statistics(split_table(spark, sf), _CATEGORIES, "total_cost", F.unix_date(EVENT_DATE), F.col("po"))
    return coded.select("split_no", "po", "role", *(F.round(c, 2).alias(c) for c in _CATEGORIES))


@query(
    "log_run_metrics",
    " UNION ALL ".join(f"SELECT '{m}_' || split_name AS key, round({m}, 4) AS value FROM f_split_metrics" for m in METRICS)
    + " UNION ALL SELECT 'weighted_mean_rmse', round(sum(weight * rmse) / sum(weight), 4) FROM f_split_metrics",
    "f_split_metrics",
)
def logged(spark: SparkSession, sf: str) -> DataFrame:
    return log_run_metrics(_ols_metrics(spark, sf)).withColumn("value", F.round("value", 4))


_NUMERIC = ["req_year", "req_month", "req_day", "o_custkey", "o_totalprice"]


@query(
    "feature_importance_top",
    "SELECT feature, round(abs(importance), 6) AS importance FROM ("
    + " UNION ALL ".join(f"SELECT '{c}' AS feature, corr({c}, total_cost) AS importance FROM f_split_rows WHERE split_no = 1 AND role = 'train'" for c in _NUMERIC)
    + ") ORDER BY importance DESC LIMIT 30",
    "f_split_rows",
)
def importance(spark: SparkSession, sf: str) -> DataFrame:
    rows = _last(split_table(spark, sf)).filter("role = 'train'")
    return t.importance_by_correlation(rows, _NUMERIC, "total_cost", 30).withColumn("importance", F.round("importance", 6))

"""Error metrics of a regression as plain aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Metric names in their reporting order.
METRICS = ("rmse", "mae", "mape", "wmape", "smape", "r2")


def metric_columns(truth: str, predicted: str) -> list[Column]:
    """One pass of mergeable aggregates for all six metrics and the number of scored rows.

    Rows count only where both values are present. A metric without a defined value is NULL.
    """
    t, p = F.col(truth).cast("double"), F.col(predicted).cast("double")
    y = F.when(p.isNotNull(), t)
    error = t - p
    size = F.abs(error)
    spread = F.abs(t) + F.abs(p)
    n = F.count(error)
    squared = F.sum(error * error)
    r2 = (
        F.when(n < 2, F.lit(None))
        .when(F.min(y) == F.max(y), F.when(squared == 0, 1.0).otherwise(0.0))
        .otherwise(1 - F.try_divide(squared, F.var_pop(y) * n))
    )
    return [
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(size).alias("mae"),
        (100 * F.avg(F.when(t != 0, size / F.nullif(F.abs(t), F.lit(0.0))))).alias("mape"),
        (100 * F.try_divide(F.sum(size), F.nullif(F.sum(F.abs(y)), F.lit(0.0)))).alias("wmape"),
        (100 * F.avg(F.when(spread != 0, 2 * size / F.nullif(spread, F.lit(0.0))))).alias("smape"),
        r2.cast("double").alias("r2"),
        n.alias("n"),
    ]


def regression_metrics(df: DataFrame, truth: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """The six metrics, overall or per group."""
    return df.groupBy(*by).agg(*metric_columns(truth, predicted))


def weighted_score(split_metrics: DataFrame, metric: str = "rmse", by: Sequence[str] = ()) -> DataFrame:
    """Mean of a metric over the splits, weighted by the splits' weights; NULL if a split has none."""
    mean = F.try_divide(F.sum(F.col("weight") * F.col(metric)), F.sum("weight"))
    complete = F.count(metric) == F.count(F.lit(1))
    return split_metrics.groupBy(*by).agg(F.when(complete, mean).alias("score"))


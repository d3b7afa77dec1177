"""Applying a model to the rows of a window and attaching the actuals."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.contract import EVENT_DATE, TableContract, require_columns, same_key_types


@dataclass(frozen=True)
class Scorer:
    """A model in one of four forms; exactly one is given.

    ``expression`` is a column over the features (or its SQL text), ``transformer`` a fitted ``pyspark.ml`` model and
    ``predict`` any function from a pandas frame to predictions. ``file`` is a stored model of any size together with
    ``load``, a function from a local path to such a function: every executor gets the file once, every worker process
    loads it once, and tasks carry its name only. A loader that maps the file shares it between the workers of a machine.
    """

    expression: str | Column | None = None
    transformer: object | None = None
    predict: Callable[[pd.DataFrame], object] | None = None
    file: str | None = None
    load: Callable[[str], Callable[[pd.DataFrame], object]] | None = None

    def __post_init__(self) -> None:
        given = [f for f in ("expression", "transformer", "predict", "file") if getattr(self, f) is not None]
        if len(given) != 1:
            raise ValueError(f"a Scorer takes exactly one of expression, transformer, predict and file, not {given or 'none'}")
        if (self.file is None) != (self.load is None):
            raise ValueError("a model file comes with its load function")


# Files sent to the executors, by name: there, all lie in one folder.
_SENT: dict[str, tuple[str, str]] = {}
# Models loaded by this worker process.
_LOADED: dict[tuple[str, str], Callable[[pd.DataFrame], object]] = {}


def ship(spark: SparkSession, path: str) -> str:
    """Send a model file to all executors, now and to come, and return its name there.

    Spark keeps the first file of a name, so files of different models need different names, and a changed model a new one.
    """
    name, application = path.rstrip("/").rsplit("/", 1)[-1], spark.sparkContext.applicationId
    if _SENT.get(name, (application, path)) == (application, path):
        spark.sparkContext.addFile(path)
        _SENT[name] = (application, path)
        return name
    if _SENT[name][0] == application:
        raise ValueError(f"{path} and {_SENT[name][1]} have one name; give every stored model a name of its own")
    del _SENT[name]
    return ship(spark, path)


def loaded(name: str, load: Callable[[str], Callable[[pd.DataFrame], object]]) -> Callable[[pd.DataFrame], object]:
    """The model of a shipped file, loaded at its first use in a worker process."""
    key = (SparkFiles.getRootDirectory(), name)
    if key not in _LOADED:
        _LOADED[key] = load(SparkFiles.get(name))
    return _LOADED[key]


def predict_input(df: DataFrame, contract: TableContract) -> DataFrame:
    """The columns a model may see: no ids, no label, no helper date."""
    return df.drop(*contract.exclude_from_features, EVENT_DATE, contract.label_col)


def prediction_values(raw: object, column: str, rows: int) -> np.ndarray:
    """One prediction per row from whatever a model returned; NaN where it has none."""
    if isinstance(raw, pd.DataFrame):
        raw = raw[column] if column in raw.columns else raw.iloc[:, 0]
    values = np.asarray(raw, dtype=float).reshape(-1)
    if values.size != rows:
        raise ValueError(f"the model gave {values.size} predictions for {rows} rows")
    return values


def batch_function(spark: SparkSession, scorer: Scorer, column: str) -> Callable:
    """What the tasks of an opaque model run: predictions for batches of rows."""
    if scorer.file is not None:
        name, load = ship(spark, scorer.file), scorer.load
        model = lambda: loaded(name, load)
    else:
        given = scorer.predict
        model = lambda: given

    def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        predict = model()
        for batch in batches:
            yield pd.Series(prediction_values(predict(batch), column, len(batch)))

    return apply


def score(df: DataFrame, scorer: Scorer, contract: TableContract, name: str = "prediction") -> DataFrame:
    """Add the model's prediction to every row; NaN predictions become NULL.

    Expressions and ``pyspark.ml`` models run in the JVM. An opaque function, given or loaded from a file, gets Arrow
    batches of the model's columns on the executors; all other columns stay in the JVM beside the returned values.
    """
    if scorer.expression is not None:
        value = F.expr(scorer.expression) if isinstance(scorer.expression, str) else scorer.expression
        scored = df.withColumn(name, value.cast("double"))
    elif scorer.transformer is not None:
        added = scorer.transformer.transform(df)
        scored = added.select(*df.columns, F.col("prediction").cast("double").alias(name))
    else:
        apply = F.pandas_udf(batch_function(df.sparkSession, scorer, contract.prediction_col), "double")
        scored = df.withColumn(name, apply(F.struct(*predict_input(df, contract).columns)))
    return scored.withColumn(name, F.when(~F.isnan(name), F.col(name)))


def matching_actuals(rows: DataFrame, actuals: DataFrame, contract: TableContract) -> DataFrame:
    """Keys and labels of the actuals that any of ``rows`` has the keys of.

    A left join would shuffle all actuals, however few rows there are. ``rows`` are best stored, so that their size
    decides how the actuals are searched.
    """
    require_columns(actuals, [*contract.keys, contract.label_col], contract.actual_table or "actuals")
    same_key_types(rows, actuals, contract.keys)
    wanted = rows.select(*[F.col(k).alias(f"_wanted_{k}") for k in contract.keys])
    same = [F.col(k).eqNullSafe(F.col(f"_wanted_{k}")) for k in contract.keys]
    return actuals.select(*contract.keys, contract.label_col).join(wanted, same, "left_semi")


def attach_actuals(scored: DataFrame, actuals: DataFrame | None, contract: TableContract) -> DataFrame:
    """Left join of the label; rows without an actual, or all rows without a table, get NULL.

    NULL keys match NULL keys. Keys of different types are refused, because Spark would quietly cast.
    """
    label = contract.label_col
    base = scored.drop(label)
    if actuals is None:
        return base.withColumn(label, F.lit(None).cast("float"))
    require_columns(actuals, [*contract.keys, label], contract.actual_table or "actuals")
    same_key_types(base, actuals, contract.keys)
    renamed = {k: f"_actual_{k}" for k in contract.keys}
    labels = actuals.select(*[F.col(k).alias(a) for k, a in renamed.items()], F.col(label).try_cast("float").alias(label))
    same = [F.col(k).eqNullSafe(F.col(a)) for k, a in renamed.items()]
    return base.join(labels, same, "left").drop(*renamed.values())

"""Training sets, category codes, model fits per split and their evaluation."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import SparkContext
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, LinearRegression, RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.contract import TableContract, require_columns, same_key_types
from tidemark.functions.metrics import METRICS, regression_metrics
from tidemark.functions.values import to_number
from tidemark.operators.scan import Running, add_buckets, cut_points, dense_codes, running
from tidemark.session import materialise

# The boosting families of single-machine libraries all become Spark's gradient-boosted trees.
FAMILIES = {
    "linear": LinearRegression,
    "random_forest": RandomForestRegressor,
    "gbt": GBTRegressor,
    "xgboost": GBTRegressor,
    "lightgbm": GBTRegressor,
    "catboost": GBTRegressor,
}

# Tuned ranges in terms of Spark's own parameters: (kind, low, high, log), ("categorical", choices) or one
# value. Shares of columns or features per tree become featureSubsetStrategy, the least gain of a split minInfoGain.
SPACES: dict[str, dict[str, tuple | int | float | str]] = {
    "linear": {"regParam": ("float", 1e-4, 1.0, True), "elasticNetParam": ("float", 0.0, 1.0, False)},
    "random_forest": {
        "numTrees": ("int", 100, 500, False),
        "maxDepth": ("int", 5, 25, False),
        "minInstancesPerNode": ("int", 1, 10, False),
        "featureSubsetStrategy": ("categorical", ["0.4", "0.6", "0.8", "1.0"]),
        "seed": 42,
    },
    "gbt": {
        "maxIter": ("int", 200, 1500, False),
        "maxDepth": ("int", 3, 10, False),
        "minInstancesPerNode": ("int", 1, 20, False),
        "stepSize": ("float", 1e-3, 0.2, True),
        "subsamplingRate": ("float", 0.5, 0.95, False),
        "seed": 42,
    },
    "xgboost": {
        "maxIter": ("int", 200, 1500, False),
        "maxDepth": ("int", 3, 10, False),
        "minInstancesPerNode": ("int", 1, 20, False),
        "stepSize": ("float", 1e-3, 0.2, True),
        "minInfoGain": ("float", 0.0, 5.0, False),
        "subsamplingRate": ("float", 0.5, 0.95, False),
        "featureSubsetStrategy": ("categorical", ["0.5", "0.65", "0.8", "0.95"]),
        "seed": 42,
    },
    "lightgbm": {
        "maxIter": ("int", 200, 1500, False),
        "maxDepth": ("int", 3, 12, False),
        "minInstancesPerNode": ("int", 10, 100, False),
        "stepSize": ("float", 1e-3, 0.2, True),
        "subsamplingRate": ("float", 0.5, 0.95, False),
        "featureSubsetStrategy": ("categorical", ["0.5", "0.65", "0.8", "0.95"]),
        "seed": 42,
    },
    "catboost": {
        "maxIter": ("int", 300, 1500, False),
        "maxDepth": ("int", 4, 10, False),
        "stepSize": ("float", 1e-3, 0.2, True),
        "seed": 42,
    },
}


def training_set(features: DataFrame, actuals: DataFrame, contract: TableContract, target: str) -> DataFrame:
    """Features with their known target: inner join on the keys, label renamed."""
    require_columns(features, contract.keys, contract.feature_table)
    require_columns(actuals, [*contract.keys, contract.label_col], contract.actual_table or "actuals")
    same_key_types(features, actuals, contract.keys)
    labels = actuals.select(*contract.keys, F.col(contract.label_col).alias(target))
    return features.drop(contract.label_col, target).join(labels, contract.keys)


def usable_target(df: DataFrame, target: str) -> DataFrame:
    """Target as a number; rows without one cannot be learned from and are left out."""
    if isinstance(df.schema[target].dataType, T.NumericType):
        value = F.col(target).cast("double")
        value = F.when(~F.isnan(value) & (F.abs(value) != float("inf")), value)
    else:
        value = to_number(F.col(target))
    return df.withColumn(target, value).filter(F.col(target).isNotNull())


def category_codes(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One code list per categorical column, shared by train and test rows: column_name, value, code."""
    long = rows.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns
    ]))).filter("value IS NOT NULL")
    return dense_codes(long, ["column_name"], "value")


def with_codes(rows: DataFrame, codes: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace categorical columns by their codes."""
    out = rows
    for column in columns:
        lookup = codes.filter(F.col("column_name") == column).select(
            F.col("value").alias(f"_{column}"), F.col("code").alias(f"_{column}_code")
        )
        out = out.join(lookup, out[column].cast("string") == lookup[f"_{column}"], "left").drop(f"_{column}")
        out = out.drop(column).withColumnRenamed(f"_{column}_code", column)
    return out


def ordered_statistics(rows: DataFrame, columns: Sequence[str], target: str, order: Column, tie: Column, weight: float = 1.0) -> DataFrame:
    """Replace categorical columns by the mean target of the training rows before each row.

    ``rows`` are split rows. A training row sees the training rows of its split and category that come earlier in
    (``order``, ``tie``), two numbers, and never its own target; test rows see all training rows. The split's mean counts as
    ``weight`` further rows, so it stands where a category is new. Gaps are a category of their own. A category
    that holds most of the rows is still worked on by many tasks.
    """
    learned = F.col("role") == "train"
    means = rows.filter(learned).groupBy("split_no").agg(F.avg(target).alias("_mean"))
    at = F.when(learned, order.cast("double")).otherwise(F.lit(2.0**62))
    # One row per split, as in score_lines.
    placed = rows.join(F.broadcast(means), "split_no", "left").withColumns({"_at": at, "_no": tie})
    placed = materialise(placed, "ordered-rows")
    placed = add_buckets(placed, "_at", cut_points(placed, "_at", tie="_no"), tie="_no")
    measures = {
        "_sum": Running("sum", F.when(learned, F.col(target).cast("double")), inclusive=False),
        "_count": Running("count", F.when(learned, 1), inclusive=False),
    }
    for column in columns:
        group = F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit(""))
        seen = running(placed.withColumn("_group", group), ["split_no", "_group"], ["_at", "_no"], measures)
        mean = (F.col("_sum") + weight * F.col("_mean")) / (F.col("_count") + weight)
        # Stored, because the next column reads its rows twice.
        placed = materialise(seen.withColumn(column, mean).drop("_group", "_sum", "_count"), "ordered-rows")
    return placed.select(*rows.columns)


def fit_lines(rows: DataFrame, x: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """Least-squares line per group from one aggregate."""
    usable = rows.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    return usable.groupBy(*by).agg(
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
    )


def score_lines(rows: DataFrame, lines: DataFrame, x: str, name: str = "y_pred") -> DataFrame:
    """Predictions of each split's own line.

    There is one line per split, so the lookup side has as many rows as splits were asked for.
    """
    scored = rows.join(F.broadcast(lines), "split_no")
    return scored.withColumn(name, F.col("slope") * F.col(x) + F.col("intercept")).drop("slope", "intercept")


def evaluate_lines(rows: DataFrame, x: str, y: str, lines: DataFrame | None = None) -> DataFrame:
    """Fit every split on its train rows and measure it on its test rows, all splits in one plan.

    ``lines`` replaces the fitted lines: split_no, slope, intercept.
    """
    lines = fit_lines(rows.filter("role = 'train'"), x, y, ["split_no"]) if lines is None else lines
    scored = score_lines(rows.filter("role = 'test'"), lines, x)
    return regression_metrics(scored, y, "y_pred", ["split_no", "split_name", "weight"])


def predictions(scored: DataFrame, keys: Sequence[str], truth: str, predicted: str) -> DataFrame:
    """Keys, truth, prediction and residual; the key travelled with the row, nothing is zipped."""
    y, p = F.col(truth).cast("double"), F.col(predicted).cast("double")
    return scored.select(*keys, y.alias("y_true"), p.alias("y_pred"), (y - p).alias("residual"))


def importance_by_correlation(rows: DataFrame, features: Sequence[str], target: str, top: int | None = None) -> DataFrame:
    """Features by absolute correlation with the target, from one aggregate over the rows."""
    def correlation(name: str):
        x, y = F.col(name).cast("double"), F.col(target).cast("double")
        both = x.isNotNull() & y.isNotNull()
        x, y = F.when(both, x), F.when(both, y)
        # A column of one value has no correlation; Spark's own corr would raise.
        return F.abs(F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y)))

    one_row = rows.agg(*[correlation(c).alias(c) for c in features])
    long = one_row.unpivot([], list(features), "feature", "importance")
    ordered = long.orderBy(F.col("importance").desc_nulls_last(), "feature")
    return ordered.limit(top) if top else ordered


def model_features(model: PipelineModel) -> list[str]:
    """The features a fitted pipeline uses, in the order of its vector."""
    return [c.removeprefix("_f_") for c in model.stages[-2].getInputCols()]


def importance_of(model: PipelineModel, rows: DataFrame, features: Sequence[str], top: int | None = None) -> DataFrame:
    """Feature importances of a fitted tree ensemble, or absolute coefficients of a linear model."""
    last = model.stages[-1]
    weights = last.featureImportances if hasattr(last, "featureImportances") else last.coefficients
    data = [(name, float(abs(w))) for name, w in zip(features, weights.toArray())]
    ordered = rows.sparkSession.createDataFrame(data, "feature string, importance double").orderBy(F.desc("importance"), "feature")
    return ordered.limit(top) if top else ordered


# The parameter that counts a family's trees; all smaller models are the first trees of the largest.
STAGE = {"random_forest": "numTrees", "gbt": "maxIter", "xgboost": "maxIter", "lightgbm": "maxIter", "catboost": "maxIter"}


def make_estimator(family: str, params: Mapping[str, object], features: Sequence[str], target: str, categories: Mapping[str, int] | None = None) -> Pipeline:
    """An ML pipeline: fill gaps with the train mean, assemble, regress.

    Integer parameters arrive as doubles from the trial table and are cast where Spark wants integers. ``categories``
    names coded columns with their numbers of codes: trees split them by sets of codes, and their gaps are a code of
    their own (see ``numeric_features``). A line takes codes as numbers.
    """
    if family not in FAMILIES:
        raise ValueError(f"unknown model family {family!r}, known: {sorted(FAMILIES)}")
    nominal = {c: n for c, n in (categories or {}).items() if c in features and family in STAGE}
    plain = [c for c in features if c not in nominal]
    regressor = FAMILIES[family](featuresCol="_features", labelCol=target, predictionCol="prediction")
    whole = {"numTrees", "maxDepth", "maxIter", "minInstancesPerNode", "seed", "maxBins"}
    regressor = regressor.copy()
    if nominal:
        regressor.set(regressor.getParam("maxBins"), max(32, *(n + 1 for n in nominal.values())))
    for name, value in params.items():
        regressor.set(regressor.getParam(name), int(float(value)) if name in whole else value)
    stages = [Imputer(inputCols=plain, outputCols=[f"_f_{c}" for c in plain])] if plain else []
    assembled = [c if c in nominal else f"_f_{c}" for c in features]
    return Pipeline(stages=[*stages, VectorAssembler(inputCols=assembled, outputCol="_features"), regressor])


def numeric_features(
    rows: DataFrame, features: Sequence[str], target: str, keys: Sequence[str] = (), categories: Mapping[str, int] | None = None
) -> DataFrame:
    """What the estimators need and nothing else: the split columns, features and target as doubles.

    Columns in ``categories`` become nominal: their gaps get the code after the last one, and the number of codes goes
    into the column's metadata, where assembler and trees look for it.
    """
    def feature(name: str):
        value = F.col(name).cast("double")
        if name not in (categories or {}):
            return value.alias(name)
        count = categories[name]
        return F.coalesce(value, F.lit(float(count))).alias(name, metadata={"ml_attr": {"type": "nominal", "num_vals": count + 1}})

    numbers = [feature(c) for c in features]
    return rows.select(*keys, "split_no", "split_name", "weight", "role", *numbers, F.col(target).cast("double").alias(target))


def features_with_values(train: DataFrame, features: Sequence[str]) -> list[str]:
    """Features with a number in some row; a column without any cannot be filled and is left out of a fit."""
    if not features:
        return []
    seen = train.agg(*[F.count(F.when(~F.isnan(c), F.col(c))).alias(f"n{i}") for i, c in enumerate(features)]).first()
    return [c for i, c in enumerate(features) if seen[f"n{i}"]]


def first_trees(model: PipelineModel, count: int) -> PipelineModel:
    """The ensemble of the first ``count`` trees of a fitted one, with the same preparation.

    A boosted model's rounds build on each other, so this is the model of ``count`` rounds itself. A forest's trees are
    drawn alike, so this is a forest of ``count`` trees.
    """
    last = model.stages[-1]
    trees = last._java_obj.trees()
    if count >= len(trees):
        return model
    context = SparkContext._active_spark_context
    jvm, gateway = context._jvm, context._gateway
    held = gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, count)
    for i in range(count):
        held[i] = trees[i]
    uid, width = last._java_obj.uid(), last._java_obj.numFeatures()
    if isinstance(last, GBTRegressionModel):
        weights = gateway.new_array(jvm.double, count)
        for i in range(count):
            weights[i] = float(last._java_obj.treeWeights()[i])
        made, kind = jvm.org.apache.spark.ml.regression.GBTRegressionModel(uid, held, weights, width), GBTRegressionModel
    else:
        made, kind = jvm.org.apache.spark.ml.regression.RandomForestRegressionModel(uid, held, width), RandomForestRegressionModel
    made.setFeaturesCol("_features")
    made.setPredictionCol("prediction")
    # One wrapper only: a second one would let go of the object when the first is collected.
    small = kind(made)
    small._transfer_params_from_java()
    return PipelineModel([*model.stages[:-1], small])


def evaluate_split(
    rows: DataFrame, split_no: int, estimator: Pipeline, target: str
) -> tuple[DataFrame, PipelineModel]:
    """Distributed fit on a split's train rows; its metric row on the test rows and the model."""
    split = rows.filter(F.col("split_no") == split_no)
    model = estimator.fit(split.filter("role = 'train'"))
    scored = model.transform(split.filter("role = 'test'"))
    return regression_metrics(scored, target, "prediction", ["split_no", "split_name", "weight"]), model


_RESULT = T.StructType([
    T.StructField("model_name", T.StringType()),
    T.StructField("trial_no", T.IntegerType()),
    T.StructField("split_no", T.IntegerType()),
    T.StructField("split_name", T.StringType()),
    T.StructField("weight", T.DoubleType()),
    *[T.StructField(m, T.DoubleType()) for m in METRICS],
    T.StructField("n", T.LongType()),
])


def measured_columns() -> list[str]:
    """The columns of a metric row, in order."""
    return _RESULT.fieldNames()


def fit_and_measure(
    ready: DataFrame, family: str, trial_no: int, params: Mapping[str, object], split_no: int, features: Sequence[str], target: str,
    categories: Mapping[str, int] | None = None,
) -> tuple[tuple, PipelineModel]:
    """One fit: its metrics as a row of the result table, and the model."""
    rows, model = fit_stages(ready, family, {trial_no: params}, split_no, features, target, categories)
    return rows[0], model


def fit_stages(
    ready: DataFrame, family: str, trials: Mapping[int, Mapping[str, object]], split_no: int, features: Sequence[str], target: str,
    categories: Mapping[str, int] | None = None,
) -> tuple[list[tuple], PipelineModel]:
    """One fit for trials that differ in their number of trees only: a metric row for each, and the largest model.

    The smaller models are prefixes of the largest, and one pass over the test rows measures all of them.
    """
    split = ready.filter(F.col("split_no") == split_no)
    train, test = split.filter("role = 'train'"), split.filter("role = 'test'")
    used = features_with_values(train, features)
    stage = STAGE.get(family)
    sizes = {no: int(float(params[stage])) if stage in params else None for no, params in trials.items()}
    largest = max(trials, key=lambda no: sizes[no] or 0)
    model = make_estimator(family, trials[largest], used, target, categories).fit(train)
    by_size = {}
    scored = test
    for size in sorted({size for size in sizes.values()}, key=lambda size: size or 0):
        name = f"_prediction_{size or 0}"
        part = model if size is None or size == sizes[largest] else first_trees(model, size)
        scored = part.transform(scored).select(*scored.columns, F.col("prediction").alias(name))
        by_size[size] = name
    long = scored.select(
        "split_no", "split_name", "weight", target,
        F.inline(F.array(*[F.struct(F.lit(size or 0).alias("_size"), F.col(name).alias("prediction")) for size, name in by_size.items()])),
    )
    measured = {r["_size"]: r for r in regression_metrics(long, target, "prediction", ["_size", "split_no", "split_name", "weight"]).collect()}
    if not measured:
        raise ValueError(f"split {split_no} has no test rows")
    rows = []
    for no in trials:
        row = measured[sizes[no] or 0]
        rows.append((family, no, row.split_no, row.split_name, row.weight, *[row[m] for m in METRICS], row.n))
    return rows, model


def staged_groups(family: str, trials: Mapping[int, Mapping[str, object]]) -> list[dict[int, Mapping[str, object]]]:
    """Trials that differ in their number of trees only, group by group."""
    groups: dict[tuple, dict[int, Mapping[str, object]]] = {}
    for no, params in trials.items():
        rest = tuple(sorted((k, str(v)) for k, v in params.items() if k != STAGE.get(family)))
        groups.setdefault(rest if family in STAGE else (no,), {})[no] = params
    return list(groups.values())


def measured_frame(spark: SparkSession, measured: Sequence[tuple]) -> DataFrame:
    return spark.createDataFrame(list(measured), _RESULT)


def evaluate_trials(
    rows: DataFrame,
    trials: Iterable[tuple[str, int, Mapping[str, object]]],
    split_nos: Sequence[int],
    features: Sequence[str],
    target: str,
    parallelism: int = 4,
    categories: Mapping[str, int] | None = None,
) -> DataFrame:
    """Metric rows of (family, trial number, parameters) on every split.

    Trials that differ in their number of trees only share a fit. The fits are Spark jobs over one cached frame, started
    from a few threads as Spark's own cross validation does. Only one metric row per trial comes back to the driver.
    """
    ready = numeric_features(rows.filter(F.col("split_no").isin(list(split_nos))), features, target, categories=categories).persist()
    by_family: dict[str, dict[int, Mapping[str, object]]] = {}
    for family, number, params in trials:
        by_family.setdefault(family, {})[number] = params
    work = [(family, group, s) for family, all_ in by_family.items() for group in staged_groups(family, all_) for s in split_nos]

    def run(item: tuple[str, dict[int, Mapping[str, object]], int]) -> list[tuple]:
        family, group, split_no = item
        return fit_stages(ready, family, group, split_no, features, target, categories)[0]

    try:
        with ThreadPoolExecutor(parallelism) as pool:
            results = [row for rows in pool.map(run, work) for row in rows]
    finally:
        ready.unpersist()
    return measured_frame(rows.sparkSession, results)

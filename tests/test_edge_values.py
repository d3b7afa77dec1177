"""Values at the edges: many importances, small slopes, odd dates, gaps in metrics and keys."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidemark.contract import TableContract
from tidemark.functions.dates import date_from_epoch_days, date_from_epoch_seconds
from tidemark.functions.values import minute_text
from tidemark.operators.runs import resolve_metric
from tidemark.operators.training import FAMILIES, fit_lines, importance_by_correlation, make_estimator, training_set
from tidemark.operators.tuning import median_prune, sample_trials
from tidemark.operators.windows import window_rows
from tidemark.plans.train import space_frame


def test_all_importances_are_kept(spark):
    names = [f"f{i}" for i in range(40)]
    rows = spark.range(20).select(F.col("id").cast("double").alias("y"), *((F.col("id") * (i + 1) % 7).alias(n) for i, n in enumerate(names)))
    assert importance_by_correlation(rows, names, "y").count() == 40
    assert importance_by_correlation(rows, names, "y", 30).count() == 30


def test_small_slopes_survive(spark):
    rows = spark.range(1, 50).select((F.col("id") * 1e9).alias("x"), (F.col("id") * 1e9 * 3e-7).alias("y"))
    assert fit_lines(rows, "x", "y").first().slope == pytest.approx(3e-7)


@pytest.mark.parametrize("family", sorted(FAMILIES))
def test_every_family_has_a_space_its_learner_accepts(spark, family):
    trials = sample_trials(space_frame(spark, family), 2).filter("trial_no = 1").collect()
    params = {r.param: r.value if r.value is not None else r.text for r in trials}
    assert make_estimator(family, params, ["x"], "y").getStages()


def test_epoch_columns_never_raise(spark):
    row = spark.sql("SELECT 20240131L AS days, 1706659200000000L AS seconds, 1706659200L AS good").select(
        date_from_epoch_days(F.col("days")).alias("a"), date_from_epoch_seconds(F.col("seconds")).alias("b"), date_from_epoch_seconds(F.col("good")).cast("string").alias("c")
    ).first()
    assert (row.a, row.b, row.c) == (None, None, "2024-01-31")


def test_utc_texts_inside_a_clock_change(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for other in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", other)
            frame = spark.range(1).select(minute_text(F.timestamp_seconds(F.lit(1710037800))).alias("t"))
            assert frame.first().t == "2024-03-10 02:30"
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_first_and_latest_agree_on_a_repeated_step(spark):
    rows = spark.createDataFrame(
        [("r", "rmse", 3, 1.0), ("r", "rmse", 3, 2.0), ("r", "rmse", 3, float("nan")), ("n", "rmse", 0, float("nan"))],
        "run_id string, key string, step long, value double",
    )
    for select in ("latest", "first"):
        found = {r.run_id: r.value for r in resolve_metric(rows, pattern="^rmse", select=select).collect()}
        assert found == {"r": 2.0, "n": None}


def test_text_keys_do_not_join_numbers(spark):
    features = spark.createDataFrame([("01", 1.0)], "po string, f double")
    actuals = spark.createDataFrame([(1, 2.0)], "po int, cost double")
    contract = TableContract(
        feature_table="a.f", actual_table="a.a", baseline_table="a.b", date_kind="parts", date_parts=("y", "m", "d"),
        min_valid_date="1990-01-01", join_keys=["po"], label_col="cost", test_months=2, exclude_from_features=["po"],
    )
    with pytest.raises(TypeError):
        training_set(features, actuals, contract, "target")


def test_a_window_reads_its_months_only(spark, tmp_path, capsys):
    days = spark.sql("SELECT year(d) AS y, month(d) AS m, day(d) AS d, id FROM (SELECT date_add(DATE'2000-01-01', CAST(id AS INT)) AS d, id FROM range(1000))")
    days.repartition(1).write.partitionBy("y", "m").parquet(str(tmp_path / "t"))
    contract = TableContract(feature_table="t", baseline_table="b", date_kind="parts", date_parts=("y", "m", "d"), join_keys=["id"], label_col="l")
    rows = window_rows(spark.read.parquet(str(tmp_path / "t")), contract, ("2000-11-15", "2001-01-10"))
    assert rows.count() == 57
    spark.conf.set("spark.sql.maxMetadataStringLength", 4000)
    rows.explain()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    plan = capsys.readouterr().out
    partitions = plan[plan.index("PartitionFilters") : plan.index("PushedFilters")]
    assert ">= 11)" in partitions and "<= 1)" in partitions


def test_the_pruning_plan_does_not_grow_with_the_steps(spark):
    scores = spark.range(60).selectExpr("'a' AS model_name", "CAST(id % 10 AS INT) AS trial_no", "CAST(id DIV 10 AS INT) AS step", "CAST(id % 7 AS DOUBLE) AS value")
    joins = [median_prune(scores, n)._jdf.queryExecution().optimizedPlan().toString().count("Join ") for n in (2, 4)]
    assert joins == [0, 0]

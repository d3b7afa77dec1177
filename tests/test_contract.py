import pytest
from conftest import rows

from tidemark.contract import ModelSpec, PipelineSpec, TableContract, require_columns
from tidemark.operators.quality import key_uniqueness, validate_table

PARTS = dict(feature_table="f", baseline_table="b", date_kind="parts", date_parts=("y", "m", "d"))


@pytest.mark.parametrize(
    "change, message",
    [
        ({"date_kind": "weeks"}, "date_kind"),
        ({"date_parts": ("y", "m")}, "date_parts"),
        ({"date_kind": "auto", "date_parts": None}, "date_col"),
        ({"baseline_table": "f"}, "overwrite"),
        ({"actual_table": "/data/b/", "baseline_table": "file:/data/b"}, "overwrite"),
        ({"feature_table": "/data/b/features", "baseline_table": "/data/b"}, "overwrite"),
    ],
)
def test_table_contract_rules(change, message):
    with pytest.raises(ValueError, match=message):
        TableContract(**{**PARTS, **change})


def test_keys_must_be_named():
    with pytest.raises(ValueError, match="join_keys"):
        TableContract(**PARTS).keys


@pytest.mark.parametrize(
    "change",
    [
        {"metric_direction": "up"},
        {"improvement_threshold": -0.1},
        {"metric": None},
        {"metric_select": "middle"},
        {"source": "disk"},
        {"experiment_path": None},
        {"source": "run"},
        {"source": "file"},
        {"source": "file", "model_path": "m.pkl", "metric": None, "metric_pattern": "^r"},
        {"source": "file", "model_path": "m.pkl"},
    ],
)
def test_model_spec_rules(change):
    good = dict(model_name="m", metric="rmse", experiment_path="/e")
    ModelSpec(**good).check()
    with pytest.raises(ValueError):
        ModelSpec(**{**good, **change}).check()


def test_models_inherit_the_experiment():
    tables = TableContract(**PARTS)
    spec = PipelineSpec("p", "c", "s", "/exp", tables, {"a": ModelSpec("m", metric="rmse")})
    assert spec.resolved_models()["a"].experiment_path == "/exp"
    with pytest.raises(ValueError, match="no models"):
        PipelineSpec("p", "c", "s", "/exp", tables, {}).resolved_models()


def test_require_columns_names_what_is_missing(spark):
    with pytest.raises(ValueError, match=r"table 't' lacks \['z'\].*\['a', 'b'\]"):
        require_columns(spark.createDataFrame([(1, 2)], "b int, a int"), ["a", "z"], "t")


def test_validation_report(spark):
    features = spark.createDataFrame([(1, 2024, 1, 1), (2, 1900, 1, 1), (3, 2024, 2, 30)], "k int, y int, m int, d int")
    contract = TableContract(**PARTS, join_keys=["k"], min_valid_date="1990-01-01", exclude_from_features=["k", "gone"])
    report = {(r[0], r[1], r[2]) for r in validate_table(features, None, contract).collect()}
    assert report == {
        ("feature_columns", "ok", ""),
        ("excluded_column", "warning", "gone"),
        ("date_resolves", "ok", "2/3"),
        ("date_coverage", "ok", "1/3"),
    }


def test_validation_errors(spark):
    features = spark.createDataFrame([(1, 1900, 1, 1)], "k int, y int, m int, d int")
    contract = TableContract(**PARTS, join_keys=["k"], min_valid_date="1990-01-01", actual_table="a", label_col="l")
    actuals = spark.createDataFrame([(1,)], "k int")
    with pytest.raises(ValueError, match="lacks"):
        validate_table(features, actuals, contract, strict=True)
    labelled = spark.createDataFrame([(1, 2.0)], "k int, l double")
    with pytest.raises(ValueError, match="date_coverage"):
        validate_table(features, labelled, contract, strict=True)
    nothing = features.selectExpr("k", "CAST(NULL AS INT) AS y", "m", "d")
    with pytest.raises(ValueError, match="date_resolves"):
        validate_table(nothing, labelled, contract, strict=True)
    report = validate_table(features.drop("y"), actuals, contract)
    assert [(r.check, r.level, r.detail) for r in report.collect()] == [
        ("feature_columns", "error", "y"), ("actual_columns", "error", "l"),
    ]


def test_key_uniqueness(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (None, "a"), (None, "a"), (None, "a")], "k int, s string")
    assert rows(key_uniqueness(df, ["k", "s"])) == [(5, 2, 3, False)]
    assert rows(key_uniqueness(df.limit(0), ["k"])) == [(0, 0, 0, True)]

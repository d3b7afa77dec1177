import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.contract import ModelSpec
from tidemark.functions.values import file_extension, merge_maps, to_number
from tidemark.operators import runs as r
from tidemark.operators.artifacts import classify_artifacts, list_artifacts
from tidemark.plans.registration import resolve_candidates, specs_frame

RUN = "run_id string, experiment string, parent_run_id string, start_time timestamp, params map<string,string>, tags map<string,string>"
METRIC = "run_id string, key string, step int, value double"


def at(minute):
    return dt.datetime(2024, 1, 1, 0, minute)


def make(spark, runs, metrics):
    table = [(i, e, p, at(m), {}, {}) for i, e, p, m in runs]
    return spark.createDataFrame(table, RUN), spark.createDataFrame(metrics, METRIC)


METRICS = [
    ("a", "rmse_val_2024-01-01_2024-02-26", 0, 3.0),
    ("a", "rmse_val_2024-03-01_2024-04-26", 0, 4.0),
    ("a", "wmape_val_2024-03-01_2024-04-26", 0, 0.5),
    ("a", "best_rmse_val_2024-03-01_2024-04-26", 0, 2.0),
    ("b", "test_rmse", 0, 9.0),
    ("b", "test_rmse", 1, 8.0),
    ("b", "rmse_val_2024-01-01_2024-02-26", 0, 7.0),
    ("c", "other", 0, 1.0),
    ("d", "rmse_val_x", 0, float("nan")),
]


@pytest.mark.parametrize(
    "arguments, want",
    [
        (dict(pattern="^rmse_val_"), {"a": 4.0, "b": 7.0, "d": None}),
        (dict(pattern="^rmse_val_", select="first"), {"a": 3.0, "b": 7.0, "d": None}),
        (dict(pattern="rmse_val_"), {"a": 4.0, "b": 7.0, "d": None}),
        (dict(pattern="^best_"), {"a": 2.0}),
        (dict(metric="test_rmse", pattern="^rmse_val_"), {"a": 4.0, "b": 8.0, "d": None}),
        (dict(metric="test_rmse"), {"b": 8.0}),
        (dict(metric="nothing"), {}),
    ],
)
def test_resolve_metric(spark, arguments, want):
    found = r.resolve_metric(spark.createDataFrame(METRICS, METRIC), **arguments)
    assert {x.run_id: x.value for x in found.collect()} == want


def test_unanchored_pattern_takes_the_last_key(spark):
    found = r.resolve_metric(spark.createDataFrame(METRICS, METRIC).filter("run_id = 'a'"), pattern="rmse")
    assert found.first().resolved_key == "rmse_val_2024-03-01_2024-04-26"


def test_best_run(spark):
    runs, metrics = make(
        spark,
        [("old", "/e", None, 1), ("tie1", "/e", None, 5), ("tie2", "/e", "tie1", 6), ("none", "/e", None, 9), ("lone", "/f", None, 1)],
        [("old", "m_1", 0, 1.0), ("tie1", "m_2", 0, 2.0), ("tie2", "m_3", 0, 2.0), ("none", "x", 0, 0.0)],
    )

    def best(**arguments):
        return {x.experiment: x.run_id for x in r.best_run(runs, metrics, **arguments).collect()}

    assert best(pattern="^m_") == {"/e": "old"}
    # The best value is outside the newest three; one of those has no metric; the newer of the equals wins.
    assert best(pattern="^m_", recent=3) == {"/e": "tie2"}
    assert best(pattern="^m_", recent=3, top_level_only=True) == {"/e": "old"}
    assert best(pattern="^m_", direction="maximize") == {"/e": "tie2"}
    assert best(metric="m_2") == {"/e": "tie1", "/f": "lone"}
    assert best(metric="unknown") == {"/e": "none", "/f": "lone"}


def test_match_experiment(spark):
    have = spark.createDataFrame([("/a",), ("/b/",), ("/c",), ("/c/",), ("/d//",)], "experiment string")
    asked = spark.createDataFrame([("/a",), ("/a/",), ("/b",), ("/b/",), ("/c",), ("/c/",), ("/d",), ("/z",)], "wanted string")
    got = {x.wanted: x.matched for x in r.match_experiment(asked, have).collect()}
    assert got == {"/a": "/a", "/a/": "/a", "/b": "/b/", "/b/": "/b/", "/c": "/c", "/c/": "/c/", "/d": None, "/z": None}


@pytest.mark.parametrize(
    "path, want",
    [("/m/a.pkl", ".pkl"), ("/m/a.CBM", ".cbm"), ("/m.d/a", ""), ("/m/a.tar.gz", ".gz"), ("/m/.hidden", ""), ("a.", ""),
     ("a.b.JSON", ".json"), ("/m/x.txt/", ".txt")],
)
def test_file_extension(spark, path, want):
    assert spark.range(1).select(file_extension(F.lit(path))).first()[0] == want


def test_classify_artifacts(spark):
    files = spark.createDataFrame(
        [("a.pickle", None), ("a.bst", None), ("a.cb", ""), ("a.txt", "pickle"), ("a", "catboost"), ("a.onnx", None), ("a.pkl", "onnx")],
        "path string, fmt string",
    )
    got = [(x.resolved_format, x.family, x.error is None) for x in classify_artifacts(files, "path", "fmt").collect()]
    assert got == [
        ("pickle", "sklearn", True), ("xgboost", "xgboost", True), ("catboost", "catboost", True), ("pickle", "sklearn", True),
        ("catboost", "catboost", True), (None, None, False), (None, None, False),
    ]


def test_list_artifacts(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    for name in ("a.pkl", "sub/b.zip"):
        (tmp_path / name).write_bytes(b"x")
    found = classify_artifacts(list_artifacts(spark, str(tmp_path))).collect()
    assert sorted((x.path.rsplit("/", 1)[1], x.resolved_format) for x in found) == [("a.pkl", "pickle"), ("b.zip", None)]


@pytest.mark.parametrize("text, want", [("1", 1.0), (" 2.5 ", 2.5), ("-1e3", -1000.0), (".5", 0.5), ("x", None), ("1d", None),
                                        ("", None), (None, None), ("NaN", None), ("1,5", None)])
def test_to_number(spark, text, want):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(to_number(F.col("t"))).first()[0] == want


def test_merge_maps(spark):
    df = spark.createDataFrame([({"a": "1", "b": "2"}, {"b": "3", "c": "4"})], "x map<string,string>, y map<string,string>")
    assert df.select(merge_maps(F.col("x"), F.col("y"))).first()[0] == {"a": "1", "b": "3", "c": "4"}


def test_file_runs(spark):
    claims = spark.createDataFrame(
        [("m", "/x/m.ubj", None, "/e", {"rmse": 1.5}, {"p": "1"}, {"model_type": "mine", "team": "t"}),
         ("n", "/x/n.zip", None, "/e", {"rmse": 1.0}, None, None)],
        "model_name string, path string, format string, experiment string, metrics map<string,double>, params map<string,string>, tags map<string,string>",
    )
    logged = r.file_runs(claims, at(0))
    good, bad = sorted(logged.collect(), key=lambda x: x.error or "")
    assert good.tags == {"model_type": "mine", "source_artifact": "/x/m.ubj", "registered_via": "file", "team": "t"}
    assert good.run_name == "m_xgboost_20240101_000000" and len(good.run_id) == 64
    assert bad.run_id is None and ".zip" in bad.error
    assert rows(r.claimed_metrics(logged)) == [(good.run_id, "rmse", 0, 1.5)]
    assert r.file_runs(claims, at(1)).filter("error IS NULL").first().run_id != good.run_id


def test_model_files_that_are_not_there_are_errors(spark, tmp_path):
    (tmp_path / "m.ubj").write_text("model")
    files = list_artifacts(spark, str(tmp_path))
    claims = spark.createDataFrame(
        [(name, path, None, "/e", {"rmse": 1.0}, None, None) for name, path in
         (("a", f"{tmp_path}/m.ubj"), ("b", f"file://{tmp_path}/m.ubj"), ("c", f"{tmp_path}/n.ubj"), ("d", f"{tmp_path}/n.zip"))],
        "model_name string, path string, format string, experiment string, metrics map<string,double>, params map<string,string>, tags map<string,string>",
    )
    got = {x.model_name: (x.run_id is None, x.error) for x in r.file_runs(claims, at(0), files).withColumn("model_name", F.substring("run_name", 1, 1)).filter("run_name IS NOT NULL").collect()}
    assert got["a"] == got["b"] == (False, None) and got["c"] == (True, f"no such file: {tmp_path}/n.ubj")
    # An unknown format is told before the missing file, and the batch registers only what is there.
    assert ".zip" in r.file_runs(claims, at(0), files).filter(F.col("error").contains("zip")).first().error
    models = {k: ModelSpec(k, metric="rmse", source="file", model_path=f"{tmp_path}/{f}", metrics={"rmse": 2.0}) for k, f in (("there", "m.ubj"), ("gone", "n.ubj"))}
    runs, metrics = make(spark, [], [])
    found = {c.model_name: c.error for c in resolve_candidates(specs_frame(spark, models), runs, metrics, at(0), files=files).collect()}
    assert found == {"there": None, "gone": f"no such file: {tmp_path}/n.ubj"}


def test_resolve_candidates(spark):
    runs, metrics = make(
        spark,
        [("a", "/e", None, 1), ("b", "/e", None, 2), ("c", "/e", None, 3), ("z", "/empty", None, 1)],
        [("a", "m_1", 0, 1.0), ("b", "m_2", 0, 2.0), ("c", "m_3", 0, 3.0), ("a", "exact", 0, 5.0), ("b", "exact", 0, 6.0)],
    )
    specs = specs_frame(spark, {
        "pattern": ModelSpec("p", metric_pattern="^m_", experiment_path="/e/"),
        "recent": ModelSpec("r", metric_pattern="^m_", experiment_path="/e", search_max_results=2),
        "exact": ModelSpec("e", metric="exact", experiment_path="/e", search_max_results=1),
        "max": ModelSpec("x", metric="exact", metric_direction="maximize", experiment_path="/e"),
        "both": ModelSpec("o", metric="exact", metric_pattern="^m_", experiment_path="/e", search_max_results=2),
        "lost": ModelSpec("l", metric="exact", experiment_path="/nowhere"),
        "empty": ModelSpec("y", metric_pattern="^m_", experiment_path="/empty"),
        "heir": ModelSpec("h", metric="exact", experiment_path="/e"),
        "run": ModelSpec("n", metric_pattern="^m_", source="run", run_id="b"),
        "norun": ModelSpec("q", metric="exact", source="run", run_id="zz"),
        "nometric": ModelSpec("s", metric="exact", source="run", run_id="c"),
        "file": ModelSpec("f", metric="claimed", source="file", model_path="/f.cbm", metrics={"claimed": 0.5}),
        "badfile": ModelSpec("g", metric="claimed", source="file", model_path="/f.zip", metrics={"claimed": 0.5}),
    })
    specs = specs.withColumn("experiment", F.when(F.col("spec") != "heir", F.col("experiment")))
    got = {x.spec: x for x in resolve_candidates(specs, runs, metrics, at(0), "/e/").collect()}
    assert len(got) == 13
    chosen = {k: (x.run_id, x.resolved_key, x.value) for k, x in got.items() if x.error is None}
    file_run = chosen.pop("file")
    assert file_run[1:] == ("claimed", 0.5) and len(file_run[0]) == 64
    assert chosen == {
        "pattern": ("a", "m_1", 1.0), "recent": ("b", "m_2", 2.0), "exact": ("a", "exact", 5.0), "max": ("b", "exact", 6.0),
        "both": ("c", "m_3", 3.0), "run": ("b", "m_2", 2.0),
        "heir": ("a", "exact", 5.0),
    }
    assert got["lost"].error == "experiment not found"
    assert "/empty" in got["empty"].error and "no run 'zz'" == got["norun"].error
    assert "in run 'c'" in got["nometric"].error and ".zip" in got["badfile"].error

"""Ordered operators on skewed groups against plain pandas."""

import random

import pandas as pd
import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.operators.scan import Running, add_buckets, cut_points, dense_codes, medians, newest, running


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(7)
    data = [("hot" if i % 3 else f"g{rng.randrange(40)}", float(rng.randrange(300)), i, rng.choice([None, i % 17])) for i in range(3000)]
    return spark.createDataFrame(data, "g string, x double, i int, v int"), pd.DataFrame(data, columns=["g", "x", "i", "v"])


def test_buckets_bound_the_hot_group(skewed):
    df, _ = skewed
    cuts = cut_points(df, "x", buckets=8)
    sizes = add_buckets(df, "x", cuts).groupBy("g", "_bucket").count().toPandas()
    assert sizes["count"].max() < 3000 / 8 * 2
    assert sizes[sizes.g == "hot"].shape[0] >= 7


def test_one_frequent_value_is_cut_by_the_tie_column(spark):
    data = [("hot", 5.0 if i % 3 else float(i % 11), i) for i in range(3000)]
    df = spark.createDataFrame(data, "g string, x double, i int")
    cuts = cut_points(df, "x", tie="i", buckets=10)
    bucketed = add_buckets(df, "x", cuts, tie="i")
    assert cuts.heavy == [5.0]
    assert bucketed.groupBy("g", "_bucket").count().toPandas()["count"].max() < 3000 / 10 * 2
    numbered = running(bucketed, ["g"], ["x", "i"], {"n": Running("count", F.lit(1))}).select("i", "n")
    order = sorted(data, key=lambda d: (d[1], d[2]))
    assert rows(numbered) == sorted(((d[2], n) for n, d in enumerate(order, 1)), key=repr)


def test_running(skewed):
    df, pdf = skewed
    bucketed = add_buckets(df, "x", cut_points(df, "x", buckets=8))
    got = running(
        bucketed, ["g"], ["x", "i"],
        {
            "n": Running("count", F.lit(1)),
            "s": Running("sum", F.col("v")),
            "lo": Running("min", F.col("v"), inclusive=False),
            "prev": Running("last", F.col("v")),
        },
    ).select("i", "n", "s", "lo", "prev")
    ordered = pdf.sort_values(["x", "i"])
    want = []
    for _, group in ordered.groupby("g"):
        total, low, last = 0, None, None
        for n, (i, v) in enumerate(zip(group.i, group.v), 1):
            before = low
            if not pd.isna(v):
                total, low, last = total + int(v), int(v) if low is None else min(low, int(v)), int(v)
            want.append((i, n, total, before, last))
    assert rows(got) == sorted(want, key=repr)


def test_medians(skewed):
    df, pdf = skewed
    got = {r.g: (r["median"], r.n) for r in medians(df, ["g"], "x").collect()}
    want = pdf.groupby("g").x.agg(["median", "count"])
    assert got == {g: (r["median"], r["count"]) for g, r in want.iterrows()}


def test_medians_of_one_repeated_value(spark):
    df = spark.createDataFrame([("a", 1.0)] * 50 + [("a", 9.0)] * 50 + [("b", 3.0), ("b", None)], "g string, x double")
    assert {r.g: (r["median"], r.n) for r in medians(df, ["g"], "x").collect()} == {"a": (5.0, 100), "b": (3.0, 1)}


@pytest.mark.parametrize("limit", [1, 7, 5000])
def test_newest(skewed, limit):
    df, pdf = skewed
    got = rows(newest(df, ["g"], [F.col("x").desc(), F.col("i")], limit).select("g", "i", "rank"))
    ordered = pdf.sort_values(["x", "i"], ascending=[False, True])
    ordered["rank"] = ordered.groupby("g").cumcount() + 1
    kept = ordered[ordered["rank"] <= limit]
    assert got == sorted(((g, i, r) for g, i, r in zip(kept.g, kept.i, kept["rank"])), key=repr)


def test_dense_codes(spark):
    rng = random.Random(3)
    data = [("a", f"v{rng.randrange(200):03d}") for _ in range(900)] + [("b", "z"), ("b", "y"), ("b", "z")]
    got = rows(dense_codes(spark.createDataFrame(data, "c string, v string"), ["c"], "v"))
    want = [("a", v, i) for i, v in enumerate(sorted({v for c, v in data if c == "a"}))] + [("b", "y", 0), ("b", "z", 1)]
    assert got == sorted(want, key=repr)

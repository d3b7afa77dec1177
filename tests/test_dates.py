import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.contract import EVENT_DATE, TableContract
from tidemark.functions import dates as d
from tidemark.operators.windows import test_window as newest_window
from tidemark.operators.windows import fixed_bounds, window_rows, with_event_date


def only(df):
    return [r[0] for r in df.collect()]


@pytest.mark.parametrize("kind", ["int", "string"])
def test_parts(spark, kind):
    good = [(2024, 2, 29), (1000, 1, 1), (9999, 12, 31)]
    bad = [(2023, 2, 29), (2024, 2, 30), (2024, 4, 31), (2024, 13, 1), (2024, 0, 1), (2024, 1, 0), (999, 1, 1),
           (99999, 1, 1), (None, 1, 1), (2024, None, 1), (2024, 1, None), (-2024, 1, 1)]
    df = spark.createDataFrame(good + bad, "y int, m int, d int").select(*[F.col(c).cast(kind) for c in "ymd"])
    got = only(df.select(d.date_from_parts(F.col("y"), F.col("m"), F.col("d"))))
    assert got == [dt.date(*g) for g in good] + [None] * len(bad)


def test_malformed_text_parts_are_null(spark):
    df = spark.createDataFrame([("20x4", "1", "1"), ("", "1", "1")], "y string, m string, d string")
    assert only(df.select(d.date_from_parts(F.col("y"), F.col("m"), F.col("d")))) == [None, None]


def test_encodings(spark):
    df = spark.createDataFrame([(20240229, 19782, 1709164799), (20240230, 0, 0), (0, -1, -1), (None, None, None)],
                               "p int, days int, secs long")
    assert only(df.select(d.date_from_packed(F.col("p")))) == [dt.date(2024, 2, 29), None, None, None]
    assert only(df.select(d.date_from_epoch_days(F.col("days")))) == [
        dt.date(2024, 2, 29), dt.date(1970, 1, 1), dt.date(1969, 12, 31), None]
    assert only(df.select(d.date_from_epoch_seconds(F.col("secs")))) == [
        dt.date(2024, 2, 28), dt.date(1970, 1, 1), dt.date(1969, 12, 31), None]


@pytest.mark.parametrize(
    "end, months, start",
    [((2024, 4, 30), 2, (2024, 2, 29)), ((2024, 3, 31), 1, (2024, 2, 29)), ((2024, 2, 29), 2, (2023, 12, 29))],
)
def test_months_before(spark, end, months, start):
    df = spark.createDataFrame([(dt.date(*end),)], "d date")
    assert only(df.select(d.months_before(F.col("d"), months))) == [dt.date(*start)]


def contract(**change):
    base = dict(feature_table="f", baseline_table="b", date_kind="parts", date_parts=("y", "m", "d"),
                min_valid_date="1990-01-01", join_keys=["k"], test_months=1)
    return TableContract(**{**base, **change})


@pytest.fixture(scope="module")
def features(spark):
    days = [dt.date(2024, 3, 31) - dt.timedelta(days=i) for i in range(60)] + [dt.date(1900, 1, 1)]
    data = [(i, day.year, day.month, day.day, day.year * 10000 + day.month * 100 + day.day, (day - dt.date(1970, 1, 1)).days,
             (day - dt.date(1970, 1, 1)).days * 86400 + 86399, day.isoformat()) for i, day in enumerate(days)]
    data.append((99, 2024, 2, 30, 20240230, None, None, "x"))
    return spark.createDataFrame(data, "k int, y int, m int, d int, packed int, days int, secs long, text string")


ENCODINGS = [
    {},
    {"date_kind": "yyyymmdd_int", "date_col": "packed"},
    {"date_kind": "unix_days", "date_col": "days"},
    {"date_kind": "unix_seconds", "date_col": "secs"},
    {"date_kind": "auto", "date_col": "text", "date_format": "yyyy-MM-dd"},
    {"date_kind": "auto", "date_col": "text"},
]


@pytest.mark.parametrize("change", ENCODINGS)
@pytest.mark.parametrize("lazy", [True, False])
def test_window_of_every_encoding(features, change, lazy):
    c = contract(**change)
    bounds = newest_window(features, c)
    assert [tuple(r) for r in bounds.collect()] == [(dt.date(2024, 2, 29), dt.date(2024, 3, 31))]
    inside = window_rows(features, c, bounds if lazy else tuple(bounds.first()))
    assert sorted(only(inside.select("k"))) == list(range(32))


def test_minimum_date_is_optional(features):
    assert with_event_date(features, contract()).count() == 60
    assert with_event_date(features, contract(min_valid_date=None)).count() == 62


def test_no_usable_date(features):
    nothing = newest_window(features, contract(min_valid_date="2030-01-01"))
    assert [tuple(r) for r in nothing.collect()] == [(None, None)]


@pytest.mark.parametrize(
    "change, column, low, high",
    [
        ({}, "y", 2024, 2024),
        ({"date_kind": "unix_days", "date_col": "days"}, "days", 19782, 19814),
        ({"date_kind": "yyyymmdd_int", "date_col": "packed"}, "packed", 20240229, 20240401),
        ({"date_kind": "unix_seconds", "date_col": "secs"}, "secs", 19782 * 86400, 19814 * 86400),
    ],
)
def test_fixed_window_reaches_the_file_reader(spark, features, tmp_path, change, column, low, high, capsys):
    path = str(tmp_path / "features")
    features.write.parquet(path)
    stored = spark.read.parquet(path)
    c = contract(**change)
    bounds = fixed_bounds(newest_window(stored, c), "features")
    window_rows(stored, c, bounds).select("k", EVENT_DATE).explain("formatted")
    plan = capsys.readouterr().out
    pushed = next(line for line in plan.splitlines() if "PushedFilters" in line)
    assert f"GreaterThanOrEqual({column},{low})" in pushed and f"LessThanOrEqual({column},{high})" in pushed, pushed


def test_lazy_window_needs_no_join(features, capsys):
    c = contract()
    window_rows(features, c, newest_window(features, c)).explain()
    assert "Join" not in capsys.readouterr().out


def test_fixed_bounds_need_a_date(features):
    with pytest.raises(ValueError, match="no usable date"):
        fixed_bounds(newest_window(features, contract(min_valid_date="2030-01-01")), "features")

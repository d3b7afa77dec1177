"""Splits and anchors against plain date arithmetic."""

import datetime as dt
import random

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidemark.operators.windows import check_splits, split_anchor, split_rows, split_sizes, split_weights, time_splits

DAY = dt.timedelta(days=1)
WEEK = dt.timedelta(weeks=1)


def frame(spark, days):
    return spark.createDataFrame([(i, d) for i, d in enumerate(days)], "k int, d date")


def expected_splits(days, n, val, step):
    newest, oldest = max(days), min(days)
    out = []
    for i in range(n):
        end = newest - (n - 1 - i) * step * WEEK + DAY
        start = end - val * WEEK
        out.append((i, f"val_{start}_{end}", oldest, start, start, end))
    return out


def expected_anchor(days, n, val, step, least):
    for anchor in sorted(set(days), reverse=True):
        counts = []
        for i in range(n):
            end = anchor - (n - 1 - i) * step * WEEK + DAY
            counts.append(sum(end - val * WEEK <= d < end for d in days))
        if min(counts) >= least:
            return [(anchor, *counts)]
    return []


@pytest.mark.parametrize("n, want", [(1, [1.0]), (2, [3 / 13, 10 / 13]), (3, [0.153846, 0.333333, 0.512821])])
def test_weights(n, want):
    assert split_weights(n) == pytest.approx(want, abs=1e-6)


offsets = st.lists(st.integers(0, 400), min_size=1, max_size=40)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(offsets, st.integers(1, 4), st.integers(1, 9), st.integers(1, 6), st.integers(1, 4))
def test_against_plain_dates(spark, offsets, n, val, step, least):
    days = [dt.date(2023, 1, 1) + o * DAY for o in offsets]
    df = frame(spark, days)
    splits = time_splits(df, "d", n, val, step)
    assert [tuple(r)[:6] for r in splits.orderBy("split_no").collect()] == expected_splits(days, n, val, step)
    assert sum(r.weight for r in splits.collect()) == pytest.approx(1)
    assert rows(split_anchor(df, "d", n, val, step, least)) == expected_anchor(days, n, val, step, least)
    got = rows(split_rows(df, splits, "d").select("split_no", "role", "k"))
    want = []
    for no, _, start, train_end, test_start, test_end in expected_splits(days, n, val, step):
        want += [(no, "train", i) for i, d in enumerate(days) if start <= d < train_end]
        want += [(no, "test", i) for i, d in enumerate(days) if test_start <= d < test_end]
    # A window that reaches before the first date has an empty train range; its rows are test rows.
    assert got == sorted(want, key=repr)


def test_rows_are_matched_without_a_join(spark, capsys):
    df = frame(spark, [dt.date(2024, 1, 1) + i * DAY for i in range(200)])
    split_rows(df, time_splits(df, "d"), "d").explain()
    assert "Join" not in capsys.readouterr().out


def test_anchor_clips_later_dates(spark):
    rng = random.Random(1)
    days = [dt.date(2024, 1, 1) + rng.randrange(300) * DAY for _ in range(600)] + [dt.date(2025, 6, 1)]
    df = frame(spark, days)
    anchor = split_anchor(df, "d", min_rows=50)
    found = anchor.first().anchor
    assert found < dt.date(2025, 1, 1)
    assert time_splits(df, "d", anchor=anchor).orderBy("split_no").collect()[-1].test_end == found + DAY
    assert split_anchor(df, "d", min_rows=5000).collect() == []


def test_summary_and_check(spark):
    df = frame(spark, [dt.date(2024, 1, 1) + i * DAY for i in range(200)])
    splits = time_splits(df, "d")
    summary = split_sizes(split_rows(df, splits, "d"), splits, ["a", "b"], "y")
    assert [(r.n_train, r.n_test, r.n_features) for r in summary.orderBy("split_no").collect()] == [(116, 56, 2), (144, 56, 2)]
    check_splits(summary, 50)
    with pytest.raises(ValueError, match="116 train, 56 test"):
        check_splits(summary, 57)
    short = frame(spark, [dt.date(2024, 1, 1), dt.date(2024, 1, 2)])
    empty = time_splits(short, "d")
    with pytest.raises(ValueError, match="0 train"):
        check_splits(split_sizes(split_rows(short, empty, "d"), empty, [], "y"), 1)

"""Every named query against its SQL twin."""

import pytest
from check import compare, database

from tidemark.queries import QUERIES

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
# The smallest tables have no date with 50 test rows in every window.
NEEDS_SPLITS = {
    "split_anchor", "time_splits", "split_rows", "split_summary", "split_metrics_ols", "weighted_score",
    "predictions_residuals", "category_codes", "ordered_statistics", "log_run_metrics", "feature_importance_top", "train_ml_families",
    "split_metrics_ml", "trial_sweep", "best_trial_refit", "training_outputs",
}


@pytest.fixture(scope="module")
def databases():
    return {sf: database(sf) for sf in (SMALL, MIDDLE)}


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, databases, name):
    sf = MIDDLE if name in NEEDS_SPLITS else SMALL
    verdict, count, _ = compare(spark, databases[sf], name, sf)
    assert verdict == ("ok" if QUERIES[name].sql else "rows only"), verdict
    assert count > 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())

"""What the physical plans must not contain."""

import pytest

from tidemark.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
TRAINS = {"train_ml_families", "split_metrics_ml", "trial_sweep", "best_trial_refit", "training_outputs"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - TRAINS))
def test_no_cross_joins_and_no_row_functions(spark, name, capsys):
    QUERIES[name].run(spark, SMALL).explain()
    plan = capsys.readouterr().out
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert unwanted not in plan

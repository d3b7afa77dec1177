"""The monitoring baseline: the newest window scored by the champion, with its actuals."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.contract import EVENT_DATE, TableContract
from tidemark.operators.quality import key_uniqueness
from tidemark.operators.scoring import Scorer, attach_actuals, score
from tidemark.operators.windows import Bounds, fixed_bounds, test_window, window_rows


def build_baseline(
    features: DataFrame,
    actuals: DataFrame | None,
    scorer: Scorer,
    contract: TableContract,
    model_name: str,
    model_version: str | int,
    bounds: Bounds | None = None,
    scored_at: dt.datetime | None = None,
    strict: bool = False,
) -> DataFrame:
    """All feature columns, then event date, prediction, lineage and label.

    Without bounds the newest window is looked up first, a pass over the date columns alone, so that the
    wide scan can skip every file outside it.

    Repeated keys in the actuals repeat baseline rows; ``strict`` refuses them instead.
    """
    if strict and actuals is not None:
        keys = key_uniqueness(actuals, contract.keys).first()
        if not keys.is_unique:
            raise ValueError(f"{contract.actual_table}: {keys.n_rows} rows but {keys.n_keys} distinct {contract.keys}")
    window = bounds if bounds is not None else fixed_bounds(test_window(features, contract), contract.feature_table)
    rows = window_rows(features, contract, window)
    scored = score(rows, scorer, contract, "prediction_final")
    own = [c for c in features.columns if c != contract.label_col]
    stamped = scored.select(
        *own,
        F.col(EVENT_DATE).cast("timestamp").alias("event_date"),
        F.col("prediction_final").cast("float").alias("prediction_final"),
        F.lit(str(model_version)).alias("model_version"),
        F.lit(model_name).alias("model_name"),
        F.lit(scored_at or dt.datetime.now(dt.timezone.utc)).cast("timestamp").alias("prediction_timestamp"),
    )
    return attach_actuals(stamped, actuals, contract)

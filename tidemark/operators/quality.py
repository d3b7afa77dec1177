"""Checks of the column contract, the dates and the join keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.contract import TableContract, require_columns
from tidemark.functions.dates import event_date


def date_coverage(features: DataFrame, contract: TableContract) -> DataFrame:
    """One row: all rows, rows with a date, rows on or after the minimum date and the others."""
    dates = features.select(event_date(contract).alias("d"))
    day = F.col("d")
    valid = day.isNotNull()
    if contract.min_valid_date:
        valid = day >= F.lit(contract.min_valid_date).cast("date")
    return dates.agg(
        F.count(F.lit(1)).alias("total"),
        F.count(day).alias("dated"),
        F.count_if(valid).alias("kept"),
    ).withColumn("dropped", F.col("total") - F.col("kept"))


def key_uniqueness(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows, distinct keys, the most rows a key has, and whether keys are unique."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.count(F.lit(1)).alias("n_keys"),
        F.coalesce(F.max("n"), F.lit(0)).alias("max_per_key"),
    ).withColumn("is_unique", F.col("n_rows") == F.col("n_keys"))


def join_report(joined: DataFrame, rows_before: DataFrame, label: str) -> DataFrame:
    """One row: rows before and after attaching the labels and how many got one.

    The level is a warning where repeated keys multiplied rows or nothing matched.
    """
    after = joined.agg(F.count(F.lit(1)).alias("n_after"), F.count(label).alias("n_matched"))
    before = rows_before.agg(F.count(F.lit(1)).alias("n")).scalar()
    counted = after.select(before.alias("n_before"), "n_after", "n_matched")
    suspicious = (F.col("n_after") != F.col("n_before")) | (F.col("n_matched") == 0)
    return counted.withColumn("level", F.when(suspicious, "warning").otherwise("ok"))


def validate_table(
    features: DataFrame, actuals: DataFrame | None, contract: TableContract, strict: bool = False
) -> DataFrame:
    """Check a contract against its tables; the report has one row per check (check, level, detail).

    Missing columns are errors, unknown excluded columns warnings. The dates are judged from a single
    pass over the date columns. With ``strict`` the first error is raised instead of reported.
    """
    needed = [*contract.date_sources, *contract.join_keys]
    found = [("feature_columns", features, needed, contract.feature_table)]
    if actuals is not None:
        found.append(("actual_columns", actuals, [*contract.keys, contract.label_col], contract.actual_table))
    fixed = []
    for check, df, columns, table in found:
        if strict:
            require_columns(df, columns, table)
        missing = sorted(c for c in set(columns) if c not in df.columns)
        fixed.append((check, "error" if missing else "ok", ",".join(missing)))
    if contract.actual_table and actuals is None:
        fixed.append(("actual_table", "warning", contract.actual_table))
    unknown = [c for c in contract.exclude_from_features if c not in features.columns]
    fixed.extend(("excluded_column", "warning", c) for c in unknown)

    rows = F.array(*[F.struct(*[F.lit(v).alias(n) for v, n in zip(r, ("check", "level", "detail"))]) for r in fixed])
    if any(c not in features.columns for c in contract.date_sources):
        return features.sparkSession.range(1).select(F.inline(rows))

    coverage = date_coverage(features, contract)
    dated = F.struct(
        F.lit("date_resolves").alias("check"),
        F.when(F.col("dated") > 0, "ok").otherwise("error").alias("level"),
        F.concat_ws("/", "dated", "total").alias("detail"),
    )
    kept = F.struct(
        F.lit("date_coverage").alias("check"),
        F.when(F.col("kept") > 0, "ok").otherwise("error").alias("level"),
        F.concat_ws("/", "kept", "total").alias("detail"),
    )
    checks = F.array(dated, kept) if contract.min_valid_date else F.array(dated)
    report = coverage.select(F.inline(F.concat(rows, checks)))
    if strict:
        errors = report.filter("level = 'error'").collect()
        if errors:
            raise ValueError(
                f"{contract.feature_table}: " + "; ".join(f"{e.check} {e.detail}" for e in errors)
                + f" (date_kind {contract.date_kind!r} on {contract.date_sources})"
            )
    return report

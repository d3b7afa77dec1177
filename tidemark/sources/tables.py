"""Reading inputs and writing results."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.contract import TableContract
from tidemark.sources.snapshots import current, replace


def load_table(spark: SparkSession, ref: str) -> DataFrame:
    """A catalog table by name, or a Parquet folder by path, in its current state."""
    return spark.read.parquet(current(spark, ref).path) if "/" in ref else spark.read.table(ref)


def load_optional(spark: SparkSession, ref: str | None) -> DataFrame | None:
    """The table, or None when no name is given or nothing lies there."""
    if not ref:
        return None
    if "/" not in ref:
        return spark.read.table(ref) if spark.catalog.tableExists(ref) else None
    try:
        return spark.read.parquet(current(spark, ref).path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def write_replacing(df: DataFrame, ref: str, partition_by: tuple[str, ...] = ()) -> None:
    """Replace a table, its schema included, in one step at the end: a write that fails leaves the old rows.

    A folder gets a new snapshot (see ``snapshots``), to be read with ``load_table``. A catalog table is written under
    another name, which then takes the place of the old table.
    """
    def writer():
        return df.write.partitionBy(*partition_by) if partition_by else df.write

    if "/" in ref:
        replace(df.sparkSession, ref, lambda path: writer().parquet(path))
        return
    spark = df.sparkSession
    staged, old = f"{ref}_{uuid.uuid4().hex}", f"{ref}_{uuid.uuid4().hex}"
    try:
        writer().format("parquet").saveAsTable(staged)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {staged}")
        raise
    if not spark.catalog.tableExists(ref):
        spark.sql(f"ALTER TABLE {staged} RENAME TO {ref}")
        return
    # The old table is dropped only when the new one stands in its place.
    spark.sql(f"ALTER TABLE {ref} RENAME TO {old}")
    try:
        spark.sql(f"ALTER TABLE {staged} RENAME TO {ref}")
    except Exception:
        spark.sql(f"ALTER TABLE {old} RENAME TO {ref}")
        raise
    spark.sql(f"DROP TABLE {old}")


def write_baseline(df: DataFrame, contract: TableContract) -> DataFrame:
    """Replace the baseline table and return it as it now stands.

    The contract has made sure that the target is neither of its inputs.
    """
    write_replacing(df, contract.baseline_table)
    return load_table(df.sparkSession, contract.baseline_table)


def write_split_metrics(metrics: DataFrame, ref: str) -> None:
    write_replacing(metrics, ref, ("model_name",))


def write_predictions(predictions: DataFrame, ref: str) -> None:
    write_replacing(predictions, ref)


def write_split_rows(rows: DataFrame, ref: str) -> None:
    """Train and validation rows of every split, one folder per split and role."""
    write_replacing(rows, ref, ("split_name", "role"))


def sample_input(df: DataFrame, contract: TableContract, n: int = 5) -> DataFrame:
    """A few dated rows with the model's columns only, chosen by key so that the choice repeats."""
    from tidemark.operators.scoring import predict_input
    from tidemark.operators.windows import with_event_date

    rows = with_event_date(df, contract).orderBy(*contract.keys).limit(n)
    return predict_input(rows, contract)


def feature_list(df: DataFrame, not_features: list[str]) -> DataFrame:
    """Model columns in table order with the number of rows that have a value."""
    names = [c for c in df.columns if c not in not_features]
    counts = df.agg(*[F.count(F.col(c)).alias(c) for c in names])
    entries = [
        F.struct(F.lit(i).alias("position"), F.lit(c).alias("feature"), F.col(c).alias("n_present"))
        for i, c in enumerate(names)
    ]
    return counts.select(F.inline(F.array(*entries)))

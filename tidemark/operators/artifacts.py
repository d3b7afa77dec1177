"""Model files: telling format and family from a path."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.values import file_extension

# File extensions of each model format.
EXTENSIONS = {
    "pickle": (".pkl", ".pickle"),
    "joblib": (".joblib",),
    "xgboost": (".ubj", ".json", ".bst", ".model"),
    "catboost": (".cb", ".cbm"),
    "lightgbm": (".txt",),
}
# The library family that stores each format.
FAMILIES = {
    "pickle": "sklearn",
    "joblib": "sklearn",
    "xgboost": "xgboost",
    "catboost": "catboost",
    "lightgbm": "lightgbm",
}


def list_artifacts(spark: SparkSession, folder: str) -> DataFrame:
    """Paths of the files below a folder; their contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return files.select("path")


def classify_artifacts(files: DataFrame, path: str = "path", override: str | None = None) -> DataFrame:
    """Add resolved_format, family and error to a table of paths.

    A format named in the ``override`` column beats the extension. The lookups are literal maps inside
    the projection, so the table is neither joined nor shuffled.
    """
    by_extension = {ext: fmt for fmt, exts in EXTENSIONS.items() for ext in exts}
    formats = F.create_map(*[F.lit(x) for pair in by_extension.items() for x in pair])
    families = F.create_map(*[F.lit(x) for pair in FAMILIES.items() for x in pair])
    extension = file_extension(F.col(path))
    named = F.nullif(F.col(override), F.lit("")) if override else F.lit(None).cast("string")
    known = F.when(named.isin(list(FAMILIES)), named)
    resolved = F.when(named.isNotNull(), known).otherwise(F.try_element_at(formats, extension))
    no_such_name = F.concat(
        F.lit("unknown format '"), named, F.lit("', known: " + ", ".join(sorted(FAMILIES)))
    )
    no_such_extension = F.concat(
        F.lit("cannot tell the format from extension '"), extension,
        F.lit("', known: " + ", ".join(sorted(by_extension))),
    )
    return (
        files.withColumn("resolved_format", resolved)
        .withColumn("family", F.try_element_at(families, F.col("resolved_format")))
        .withColumn(
            "error",
            F.when(F.col("resolved_format").isNotNull(), F.lit(None).cast("string"))
            .when(named.isNotNull(), no_such_name)
            .otherwise(no_such_extension),
        )
    )


def require_files(claims: DataFrame, files: DataFrame, path: str = "path") -> DataFrame:
    """Set ``error`` on claims whose file is not there; errors found before stay. A local path may be given with or without scheme."""

    def bare(name: Column) -> Column:
        return F.regexp_replace(name, "^file:/+", "/")

    there = files.select(bare(F.col("path")).alias("_there")).distinct()
    found = claims.join(there, bare(F.col(path)) == F.col("_there"), "left")
    missing = F.when(F.col("_there").isNull(), F.concat(F.lit("no such file: "), F.coalesce(path, F.lit("no path given"))))
    return found.withColumn("error", F.coalesce("error", missing)).drop("_there")

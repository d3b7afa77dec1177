"""Ordered computations per group that stay spread out when one group holds most of the rows.

A plain window over a group puts the whole group into one task. The operators here cut every group into
ordered buckets first, work inside the buckets, and carry one summary row per (group, bucket) forward.
Group columns must not be NULL.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import shared_dir, shuffle_width

BUCKET = "_bucket"


@dataclass(frozen=True)
class Cuts:
    """Where to cut a column: ``edges``, the values too frequent for one range, and cuts of the tie column."""

    edges: list[float]
    heavy: list[float]
    tie_edges: list[float]


def cut_points(df: DataFrame, column: str, tie: str | None = None, buckets: int | None = None) -> Cuts:
    """Values that cut a numeric column into ranges with about equally many rows.

    Quantiles of the whole column in one pass; the driver gets one number per range. The largest part
    of any group between two cuts is then about ``rows / buckets``, however the groups are skewed. A
    value that alone fills more than a range gets a range of its own, which ``tie``, the second column
    of the order, cuts further.
    """
    count = buckets or shuffle_width(df.sparkSession)
    if count == 1:
        return Cuts([], [], [])
    shares = [i / count for i in range(1, count)]
    columns = [column, tie] if tie else [column]
    found = df.approxQuantile(columns, shares, 1 / (4 * count))
    heavy = sorted({a for a, b in zip(found[0], found[0][1:]) if a == b}) if tie else []
    edges = sorted(filter(math.isfinite, {*found[0], *(math.nextafter(h, math.inf) for h in heavy)}))
    return Cuts(edges, heavy, sorted(set(found[1])) if heavy else [])


def add_buckets(df: DataFrame, column: str, cuts: Cuts, tie: str | None = None) -> DataFrame:
    """Add ``_bucket``, a number that rises with (column, tie) and bounds the rows of any group in it."""
    out = _ranges(df, column, cuts.edges, BUCKET)
    if not cuts.heavy:
        return out
    split = _ranges(out, tie, cuts.tie_edges, "_tie")
    inner = F.when(F.col(column).isin(cuts.heavy), F.col("_tie")).otherwise(0)
    return split.withColumn(BUCKET, F.col(BUCKET) * (len(cuts.tie_edges) + 2) + inner).drop("_tie")


def _ranges(df: DataFrame, column: str, edges: Sequence[float], name: str) -> DataFrame:
    if not edges:
        return df.withColumn(name, F.lit(0))
    cutter = Bucketizer(
        splits=[-math.inf, *edges, math.inf], inputCol=column, outputCol=name, handleInvalid="keep"
    )
    return cutter.transform(df).withColumn(name, F.col(name).cast("int"))


@dataclass(frozen=True)
class Running:
    """A running aggregate: ``count``, ``sum``, ``min`` or ``last`` (last value that is not NULL).

    Without ``inclusive`` it ends before the row itself.
    """

    kind: str
    value: Column
    inclusive: bool = True


def running(df: DataFrame, by: Sequence[str], order: Sequence[str], measures: dict[str, Running]) -> DataFrame:
    """Add running aggregates per group to a bucketed frame.

    ``order`` must begin with the bucketed column. Both joined sides are partitioned by (group, bucket),
    so the rows are shuffled once.
    """
    ordered = Window.partitionBy(*by, BUCKET).orderBy(*order)
    earlier = Window.partitionBy(*by).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    position = F.struct(*order)

    local, totals, carried, merged = [], [], [], []
    for name, measure in measures.items():
        value = measure.value
        inside = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow if measure.inclusive else -1)
        here, before, total = F.col(f"_l_{name}"), F.col(f"_c_{name}"), F.col(f"_t_{name}")
        if measure.kind == "last":
            pieces = (
                F.last(value, ignorenulls=True).over(inside),
                F.max_by(value, F.when(value.isNotNull(), position)),
                F.last(total, ignorenulls=True).over(earlier),
                F.coalesce(here, before),
            )
        elif measure.kind == "min":
            pieces = (F.min(value).over(inside), F.min(value), F.min(total).over(earlier), F.least(here, before))
        elif measure.kind in ("count", "sum"):
            fold = F.count if measure.kind == "count" else F.sum
            zero = F.lit(0)
            pieces = (
                fold(value).over(inside), fold(value), F.sum(total).over(earlier),
                F.coalesce(here, zero) + F.coalesce(before, zero),
            )
        else:
            raise ValueError(f"unknown running aggregate {measure.kind!r}")
        for column, prefix, kept in zip(pieces, ("_l_", "_t_", "_c_", ""), (local, totals, carried, merged)):
            kept.append(column.alias(prefix + name))

    rows = df.select("*", *local)
    carry = df.groupBy(*by, BUCKET).agg(*totals).select(*by, BUCKET, *carried)
    joined = rows.join(carry, [*by, BUCKET], "left")
    return joined.select(*df.columns, *merged)


def at_or_below(rows: DataFrame, points: DataFrame, by: Sequence[str], x: str, value: str) -> DataFrame:
    """The points, each with ``value`` of the row of its group that has the greatest ``x`` not above its own, or NULL.

    ``x`` is a double, unique among the rows of a group; points may share one. Rows and points are ordered together
    in buckets, so neither a large group nor a point that comes up in millions of rows ends up in one task.
    Both frames are read three times.
    """
    spread = F.pmod(F.xxhash64(*points.columns), F.lit(1_000_003)) / 1_000_003
    held = rows.select(*by, x, F.col(value).alias("_held"), F.lit(-1.0).alias("_side"))
    both = held.unionByName(points.withColumns({"_side": spread, "_point": F.lit(True)}), allowMissingColumns=True)
    bucketed = add_buckets(both, x, cut_points(both, x, tie="_side"), tie="_side")
    found = running(bucketed, by, [x, "_side"], {value: Running("last", F.col("_held"))})
    return found.filter("_point").select(*points.columns, value)


def newest(
    df: DataFrame, by: Sequence[str], order: Sequence[Column], limit: int | Column, rank: str = "rank"
) -> DataFrame:
    """The first ``limit`` rows of every group in the given order, with their rank.

    Each group is first ranked in slices of input partitions; only the slices' own leaders are ranked
    together. With a literal limit Spark also drops, before anything is shuffled, what is not among the
    leaders of its partition.
    """
    slices = F.spark_partition_id() % shuffle_width(df.sparkSession)
    keys = [F.col(c) for c in by]
    sliced = df.withColumn("_slice", slices)
    leaders = sliced.withColumn(rank, F.row_number().over(Window.partitionBy(*keys, "_slice").orderBy(*order)))
    leaders = leaders.filter(F.col(rank) <= limit).drop("_slice")
    final = leaders.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return final.filter(F.col(rank) <= limit)


def dense_codes(values: DataFrame, by: Sequence[str], column: str, code: str = "code") -> DataFrame:
    """Number the distinct values of every group from 0 in ascending order.

    The distinct values are range-partitioned, so neither a task nor the driver sees all of them. The
    partition number is part of the result of each row; it is written down once, so that the counts and
    the rows joined to them can never come from two different samplings.
    """
    shared_dir(values.sparkSession)
    distinct = values.select(*by, column).distinct()
    ordered = distinct.repartitionByRange(*by, column)
    placed = ordered.withColumn(BUCKET, F.spark_partition_id()).checkpoint()
    numbered = running(placed, by, [column], {code: Running("count", F.lit(1), inclusive=False)})
    return numbered.select(*by, column, F.col(code).cast("int").alias(code))


def medians(
    df: DataFrame, by: Sequence[str], value: str, cuts: Cuts | None = None, name: str = "median"
) -> DataFrame:
    """Exact median and row count per group, without gathering a group.

    The rows are first only counted per (group, bucket), which finds the one or two buckets around the
    middle of each group. Only rows of those buckets are looked at again: equal values are counted
    together and the middle values picked by running counts. ``cuts`` saves the pass that finds them.
    """
    present = df.filter(F.col(value).isNotNull())
    bucketed = add_buckets(present, value, cut_points(present, value) if cuts is None else cuts)
    own, upto, total = F.col("_own"), F.col("_upto"), F.col("n")
    whole = Window.partitionBy(*by)
    sizes = bucketed.groupBy(*by, BUCKET).agg(F.count(F.lit(1)).alias("_own"))
    placed = sizes.select(
        "*", F.sum("_own").over(whole.orderBy(BUCKET)).alias("_upto"), F.sum("_own").over(whole).alias("n")
    )
    low, high = F.floor((total + 1) / 2), F.floor(total / 2) + 1
    around = placed.filter((upto - own < high) & (low <= upto)).select(*by, BUCKET, (upto - own).alias("_before"), "n")

    middle = bucketed.join(around, [*by, BUCKET])
    counted = middle.groupBy(*by, BUCKET, "_before", "n", value).agg(F.count(F.lit(1)).alias("_own"))
    in_bucket = Window.partitionBy(*by, BUCKET).orderBy(value)
    ranked = counted.withColumn("_upto", F.col("_before") + F.sum("_own").over(in_bucket))

    def at(rank: Column) -> Column:
        return F.max(F.when((upto - own < rank) & (rank <= upto), F.col(value)))

    picked = ranked.groupBy(*by, "n").agg(at(low).alias("_low"), at(high).alias("_high"))
    return picked.select(*by, (F.col("_low") + (F.col("_high") - F.col("_low")) * 0.5).alias(name), "n")

"""Event dates, test windows and rolling time splits."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.contract import EVENT_DATE, TableContract
from tidemark.functions.dates import event_date, months_before, raw_encoding

Bounds = DataFrame | tuple[dt.date | str, dt.date | str]


def with_event_date(df: DataFrame, contract: TableContract) -> DataFrame:
    """Add the event date; with a minimum date set, keep only rows on or after it."""
    if not contract.min_valid_date:
        return df.withColumn(EVENT_DATE, event_date(contract))
    earliest = F.lit(dt.date.fromisoformat(contract.min_valid_date))
    raw = _raw_column(df, contract)
    if raw is not None:
        name, encode = raw
        df = df.filter(F.col(name) >= encode(earliest))
    return df.withColumn(EVENT_DATE, event_date(contract)).filter(F.col(EVENT_DATE) >= earliest)


def _raw_column(df: DataFrame, contract: TableContract) -> tuple[str, Callable[[Column], Column]] | None:
    """The raw column ranges can be pushed on and the encoding in that column's own type."""
    found = raw_encoding(contract)
    if found is None:
        return None
    name, encode = found
    stored = dict(df.dtypes).get(name)
    if stored not in ("smallint", "int", "bigint"):
        return None
    return name, lambda d: encode(d).cast(stored)


def test_window(df: DataFrame, contract: TableContract) -> DataFrame:
    """One row: the newest valid date and the date some months before it; NULLs if there is none."""
    dated = with_event_date(df, contract).agg(F.max(EVENT_DATE).alias("end_date"))
    return dated.select(months_before(F.col("end_date"), contract.test_months).alias("start_date"), "end_date")


def window_rows(df: DataFrame, contract: TableContract, bounds: Bounds) -> DataFrame:
    """Dated rows of a closed window.

    Bounds given as dates reach the file reader: the range they imply on the raw date column is pushed
    down, and files and row groups outside it are not read. A one-row frame of bounds keeps the plan lazy
    and enters as scalar subqueries, without a join, but those are too late to skip files.
    """
    if isinstance(bounds, DataFrame):
        low, high = (bounds.select(c).scalar() for c in ("start_date", "end_date"))
        return with_event_date(df, contract).filter(F.col(EVENT_DATE).between(low, high))
    low, high = (F.lit(b).cast("date") for b in bounds)
    raw = _raw_column(df, contract)
    if raw is not None:
        name, encode = raw
        # Up to the day after the end, to keep every second of the last day; the date filter is exact.
        df = df.filter(F.col(name).between(encode(low), encode(F.date_add(high, 1))))
    months = _month_range(df, contract, low, high)
    if months is not None:
        df = df.filter(months)
    return with_event_date(df, contract).filter(F.col(EVENT_DATE).between(low, high))


def _month_range(df: DataFrame, contract: TableContract, low: Column, high: Column) -> Column | None:
    """The months of a window as a predicate on stored columns, for dates kept as year, month and day."""
    if contract.date_kind != "parts":
        return None
    kinds, names = dict(df.dtypes), contract.date_parts[:2]
    if any(kinds.get(c) not in ("tinyint", "smallint", "int", "bigint") for c in names):
        return None
    year, month = (F.col(c) for c in names)
    (y0, m0), (y1, m1) = ([part(d).cast(kinds[c]) for part, c in zip((F.year, F.month), names)] for d in (low, high))
    return ((year > y0) | ((year == y0) & (month >= m0))) & ((year < y1) | ((year == y1) & (month <= m1)))


def fixed_bounds(bounds: DataFrame, table: str) -> tuple[dt.date, dt.date]:
    """The two dates of a one-row frame of bounds; raises if the table had no usable date."""
    row = bounds.first()
    if row is None or row.end_date is None:
        raise ValueError(f"{table} has no usable date")
    return row.start_date, row.end_date


def split_weights(n_splits: int) -> list[float]:
    """Weights rising evenly from 0.3 to 1.0, scaled to sum to one."""
    step = 0.7 / (n_splits - 1) if n_splits > 1 else 0.0
    raw = [0.3 + step * i for i in range(n_splits)]
    return [w / sum(raw) for w in raw]


def time_splits(
    df: DataFrame, date_col: str, n_splits: int = 2, val_weeks: int = 8, step_weeks: int = 4,
    anchor: DataFrame | None = None,
) -> DataFrame:
    """Rolling train and test windows, one row per split, the last one ending on the newest date.

    All ranges are half open. ``anchor`` is a one-row frame with a column ``anchor``; later dates are
    ignored.
    """
    dates = df if anchor is None else df.filter(F.col(date_col) <= anchor.select("anchor").scalar())
    span = dates.agg(F.min(date_col).alias("train_start"), F.max(date_col).alias("newest"))
    numbered = span.filter("newest IS NOT NULL").withColumn("split_no", F.explode(F.sequence(F.lit(0), F.lit(n_splits - 1))))
    steps_back = (F.lit(n_splits - 1) - F.col("split_no")) * F.lit(7 * step_weeks)
    test_end = F.date_add(F.date_sub("newest", steps_back.cast("int")), 1)
    ranged = numbered.withColumn("test_end", test_end)
    ranged = ranged.withColumn("test_start", F.date_sub("test_end", 7 * val_weeks))
    weights = F.array(*[F.lit(w) for w in split_weights(n_splits)])
    return ranged.select(
        "split_no",
        F.concat(F.lit("val_"), F.col("test_start").cast("string"), F.lit("_"), F.col("test_end").cast("string")).alias("split_name"),
        "train_start",
        F.col("test_start").alias("train_end"),
        "test_start",
        "test_end",
        weights[F.col("split_no")].alias("weight"),
    )


def split_anchor(
    df: DataFrame, date_col: str, n_splits: int = 2, val_weeks: int = 8, step_weeks: int = 4, min_rows: int = 50
) -> DataFrame:
    """The newest date on which all test windows would hold enough rows, and those row counts.

    No row comes back when there is no such date. The rows are first counted per day; the window then
    runs over that histogram, which has one row per calendar day whatever the size of the table.
    """
    daily = df.filter(F.col(date_col).isNotNull()).groupBy(date_col).agg(F.count(F.lit(1)).alias("_n"))
    daily = daily.withColumn("_day", F.unix_date(date_col))
    by_day = Window.orderBy("_day")
    counts = []
    for i in range(n_splits):
        back = (n_splits - 1 - i) * 7 * step_weeks
        frame = by_day.rangeBetween(-(back + 7 * val_weeks) + 1, -back)
        counts.append(F.coalesce(F.sum("_n").over(frame), F.lit(0)).alias(f"n{i}"))
    names = [f"n{i}" for i in range(n_splits)]
    counted = daily.select(F.col(date_col).alias("anchor"), *counts)
    enough = counted.filter(F.least(*names) >= min_rows if n_splits > 1 else F.col("n0") >= min_rows)
    best = enough.agg(F.max("anchor").alias("anchor"), F.max_by(F.struct(*names), "anchor").alias("_n"))
    return best.filter("anchor IS NOT NULL").select("anchor", *[F.col(f"_n.{n}").alias(n) for n in names])


def split_rows(df: DataFrame, splits: DataFrame, date_col: str) -> DataFrame:
    """Every row once per split whose train or test range holds its date, with its role.

    The splits (a handful of rows, as many as asked for) enter as one array-valued scalar subquery, so
    rows are matched where they lie: no join and no shuffle.
    """
    entry = F.struct("split_no", "split_name", "weight", "train_start", "train_end", "test_start", "test_end")
    table = splits.agg(F.array_sort(F.collect_list(entry))).scalar()
    day = F.col(date_col)

    def role(s: Column) -> Column:
        trained = (day >= s.train_start) & (day < s.train_end)
        tested = (day >= s.test_start) & (day < s.test_end)
        return F.when(trained, "train").when(tested, "test")

    placed = F.transform("_splits", lambda s: F.struct(s.split_no, s.split_name, s.weight, role(s).alias("role")))
    held = F.filter(placed, lambda s: s.role.isNotNull())
    out = df.withColumn("_splits", table).withColumn("_split", F.explode(held))
    return out.select(*df.columns, "_split.*")


def split_sizes(
    rows: DataFrame, splits: DataFrame, features: Sequence[str], target: str, categorical: Sequence[str] = ()
) -> DataFrame:
    """One record per split: row counts of both roles, the ranges and what the model sees.

    A split nobody belongs to keeps its record with zero counts.
    """
    counted = rows.groupBy("split_no").agg(
        F.count_if(F.col("role") == "train").alias("n_train"), F.count_if(F.col("role") == "test").alias("n_test")
    )
    joined = splits.join(counted, "split_no", "left")
    return joined.select(
        "split_no", "split_name", "train_start", "train_end", "test_start", "test_end",
        F.coalesce("n_train", F.lit(0)).cast("long").alias("n_train"),
        F.coalesce("n_test", F.lit(0)).cast("long").alias("n_test"),
        F.lit(len(features)).alias("n_features"),
        F.lit(",".join(categorical)).alias("categorical_features"),
        F.lit(target).alias("target"),
    )


def check_splits(summary: DataFrame, min_rows: int = 50) -> None:
    """Raise if a split lacks train rows or has too few test rows. ``summary`` has one row per split."""
    empty = (F.col("n_train") == 0) | (F.col("n_test") < F.lit(max(min_rows, 1)))
    bad = summary.filter(empty).collect()
    if bad:
        detail = "; ".join(f"{r.split_name}: {r.n_train} train, {r.n_test} test" for r in bad)
        raise ValueError(f"splits without enough rows (at least {min_rows} test rows needed): {detail}")

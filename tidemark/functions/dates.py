"""Date expressions. All of them give NULL for values that are no date; none raises."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.contract import TableContract


def date_from_parts(year: Column, month: Column, day: Column) -> Column:
    """DATE from three numbers, NULL unless they name a real day of the years 1000 to 9999."""
    y, m, d = (c.try_cast("int") for c in (year, month, day))
    # Years past 9999 make a timestamp Spark accepts but a client cannot read: drop them first.
    four_digits = F.when(y.between(1000, 9999), y)
    midnight = F.try_make_timestamp_ntz(four_digits, m, d, F.lit(0), F.lit(0), F.lit(0))
    return midnight.cast("date")


def date_from_packed(packed: Column) -> Column:
    """DATE from an integer such as 20240131, by arithmetic and without string parsing."""
    n = packed.try_cast("int")
    return date_from_parts(F.floor(n / 10000), F.floor(n / 100) % 100, n % 100)


def _readable(days: Column) -> Column:
    """The date of an epoch day of the years 1000 to 9999."""
    return F.date_from_unix_date(F.when(days.between(-354285, 2932896), days))


def date_from_epoch_days(days: Column) -> Column:
    return _readable(days.try_cast("int"))


def date_from_epoch_seconds(seconds: Column) -> Column:
    """UTC day of an epoch second, whatever the session time zone."""
    return _readable(F.floor(seconds.try_cast("long") / 86400).try_cast("int"))


def date_from_text(text: Column, pattern: str) -> Column:
    return F.try_to_date(text.cast("string"), pattern)


def event_date(contract: TableContract) -> Column:
    """The event date of a feature row, as the contract encodes it."""
    if contract.date_kind == "parts":
        return date_from_parts(*[F.col(c) for c in contract.date_parts])
    raw = F.col(contract.date_col)
    if contract.date_kind == "yyyymmdd_int":
        return date_from_packed(raw)
    if contract.date_kind == "unix_days":
        return date_from_epoch_days(raw)
    if contract.date_kind == "unix_seconds":
        return date_from_epoch_seconds(raw)
    if contract.date_format:
        return date_from_text(raw, contract.date_format)
    return raw.try_cast("date")


def months_before(date: Column, months: int) -> Column:
    """The same day some months earlier, or the last day of that month if it is shorter."""
    return F.add_months(date, -months)


def raw_encoding(contract: TableContract) -> tuple[str, Callable[[Column], Column]] | None:
    """A raw numeric column that rises with the date, and how a date looks in it.

    The computed date hides the stored column from the file reader. With this encoding a range of dates
    implies a range of stored values (equal values at both ends included), so that files and row groups
    outside it are skipped. None when the contract stores text.
    """
    if contract.date_kind == "parts":
        return contract.date_parts[0], F.year
    if contract.date_kind == "yyyymmdd_int":
        return contract.date_col, lambda d: F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)
    if contract.date_kind == "unix_days":
        return contract.date_col, F.unix_date
    if contract.date_kind == "unix_seconds":
        return contract.date_col, lambda d: F.unix_date(d).cast("long") * 86400
    return None

"""Scalar expressions on numbers, texts, paths and maps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def to_number(text: Column) -> Column:
    """DOUBLE of a numeric text, NULL of anything else."""
    # The pattern keeps out forms the JVM reads as numbers but no data file means: '1d', 'NaN'.
    plain = text.cast("string")
    return F.when(plain.rlike(_NUMBER), F.trim(plain).try_cast("double"))


def finite(value: Column) -> Column:
    """The value, or NULL where it is NaN: Spark orders NaN above all numbers, a metric must not."""
    number = value.cast("double")
    return F.when(~F.isnan(number), number)


def four_decimals(value: Column) -> Column:
    return F.when(value.isNotNull(), F.format_string("%.4f", value)).otherwise("N/A")


def short_id(run_id: Column) -> Column:
    return F.concat(F.substring(run_id, 1, 8), F.lit("..."))


def utc_text(at: Column) -> Column:
    """A point in time as UTC text such as 2024-03-10 02:30:00, whatever the session time zone.

    From the epoch second, because a local time of the session may not exist or exist twice.
    """
    second = F.floor(F.unix_micros(at.cast("timestamp")) / 1_000_000)
    day = F.date_from_unix_date(F.floor(second / 86400).cast("int"))
    left = F.pmod(second, F.lit(86400))
    clock = F.format_string("%02d:%02d:%02d", F.floor(left / 3600), F.floor(left / 60) % 60, left % 60)
    return F.when(at.isNotNull(), F.concat_ws(" ", day.cast("string"), clock))


def minute_text(at: Column) -> Column:
    return F.substring(utc_text(at), 1, 16)


def qualified_name(catalog: Column, schema: Column, name: Column) -> Column:
    return F.concat_ws(".", catalog, schema, name)


def file_extension(path: Column) -> Column:
    """Lower-case last suffix of the file name with its dot; empty where the name has none.

    A leading dot marks a hidden file and a trailing dot no suffix at all.
    """
    name = F.element_at(F.split(F.rtrim(path, F.lit("/")), "/"), -1)
    return F.lower(F.regexp_extract(name, r"^.+(\.[^.]+)$", 1))


def merge_maps(first: Column, second: Column) -> Column:
    """Union of two maps where the second one wins."""
    kept = F.map_filter(first, lambda k, _: ~F.array_contains(F.map_keys(second), k))
    return F.map_concat(kept, second)


def tag(tags: Column, *names: str) -> Column:
    """The first of some tags that is present, else N/A."""
    return F.coalesce(*[F.try_element_at(tags, F.lit(n)) for n in names], F.lit("N/A"))


def is_better(new: Column, champion: Column, direction: Column, threshold: Column) -> Column:
    """Whether a new metric value beats the champion's.

    No champion value: it does. Champion at zero: strict comparison without threshold. Otherwise the
    gain relative to the champion's magnitude must reach the threshold, so a tie wins at threshold 0.
    """
    gain = F.when(direction == "maximize", new - champion).otherwise(champion - new)
    relative = F.try_divide(gain, F.abs(champion))
    return F.when(champion.isNull(), True).when(champion == 0, gain > 0).otherwise(relative >= threshold)

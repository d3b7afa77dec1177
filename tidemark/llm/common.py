"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts worked on at a time by a task, in bytes; one longer text is worked on alone.
STRETCH = 4 << 20


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def fold(key: Column, folds: int) -> Column:
    """crc32 of the key as text, modulo ``folds``; a missing key counts as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % folds


def uniform(key: Column) -> Column:
    """A number in [0, 1) that depends on the key only."""
    digits = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 13)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(16**13))


def stretches(batch: pa.RecordBatch, column: int, limit: int = STRETCH) -> Iterator[pa.RecordBatch]:
    """The batch cut so that the texts of a cut stay below ``limit`` bytes, but for a single longer text."""
    sizes = batch.column(column)
    start = held = 0
    lengths = [0 if n is None else n for n in pc.binary_length(sizes).to_pylist()]
    for at, n in enumerate(lengths):
        if at > start and held + n > limit:
            yield batch.slice(start, at - start)
            start, held = at, 0
        held += n
    if len(lengths) > start:
        yield batch.slice(start)


def append(df: DataFrame, make: Callable[[], Callable], fields: list[T.StructField], inputs: list[str], limit: int = STRETCH) -> DataFrame:
    """The frame with further columns, computed from the columns ``inputs`` batch by batch, without a shuffle.

    ``make()`` runs once per task and returns a function from the input arrays to the new arrays. The first
    input is a text: batches are cut by its size, at ``limit`` bytes. New names must not be among the frame's; for
    frames with columns of a user's own see ``computed``.
    """
    where = [df.columns.index(name) for name in inputs]
    schema = T.StructType([*df.schema.fields, *fields])
    names = schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for cut in stretches(batch, where[0], limit):
                added = work(*(cut.column(i) for i in where))
                yield pa.RecordBatch.from_arrays([*cut.columns, *added], names=names)
        del work
        release()

    return df.mapInArrow(run, schema)


def release() -> None:
    """Give free memory of this worker process back to the system. Workers outlive their tasks, and what one stage left
    in the allocators would stand beside the tables of the next."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def fresh(df: DataFrame, *wanted: str) -> list[str]:
    """Names made from ``wanted`` that no column of the frame has, in whatever case."""
    taken = {name.lower() for name in df.columns}
    names = []
    for name in wanted:
        while name.lower() in taken:
            name = f"{name}_"
        taken.add(name.lower())
        names.append(name)
    return names


def computed(make: Callable[[], Callable], kind: str, inputs: list[Column], limit: int = STRETCH) -> Column:
    """A column of type ``kind`` computed in Arrow batches from ``inputs`` alone; all other columns stay in the JVM.

    ``make`` and ``limit`` are as in ``append``; the function returns one array.
    """

    def run(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        work = make()
        for arrays in batches:
            batch = pa.RecordBatch.from_arrays(list(arrays), names=[str(i) for i in range(len(arrays))])
            made = [work(*cut.columns) for cut in stretches(batch, 0, limit)]
            yield pa.concat_arrays(made) if made else work(*batch.columns)
        del work
        release()

    def run_one(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from run((array,) for array in batches)

    # Not to be evaluated twice, once in a filter and once in its output.
    return F.arrow_udf(run_one if len(inputs) == 1 else run, kind).asNondeterministic()(*inputs)


def field(name: str, kind: str) -> T.StructField:
    return T.StructField(name, T._parse_datatype_string(kind))

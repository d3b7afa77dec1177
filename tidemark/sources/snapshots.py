"""Folders that are replaced as a whole: snapshots, and numbered commits that name the current one.

A folder holds ``snapshot-<id>`` folders with the data and ``_commits`` with one small file per state, named by its number
and holding the snapshot's name. A new state is first written out, then committed by creating the next number, which
fails if it is there already. So a failed write leaves the old state, readers see the old or the new one, and of two
writers that start from the same state only one succeeds. Old snapshots stay readable for whoever resolved them.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class CommitConflict(RuntimeError):
    """The folder has moved on since the state that a write started from."""


@dataclass(frozen=True)
class State:
    """A committed state: its number (0 where nothing is committed yet) and the folder of its data."""

    number: int
    path: str


def _files(spark: SparkSession, folder: str):
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    return jvm, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def read_text(spark: SparkSession, file: str) -> str | None:
    """The text of a small file, or None if it is not there."""
    jvm, files, path = _files(spark, file)
    if not files.exists(path):
        return None
    stream = files.open(path)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, file: str, text: str) -> None:
    _, files, path = _files(spark, file)
    stream = files.create(path, False)
    try:
        stream.write(text.encode())
    finally:
        stream.close()


def current(spark: SparkSession, folder: str) -> State:
    """The newest committed state. A folder without commits is its own data: a plain table."""
    folder = folder.rstrip("/")
    _, files, commits = _files(spark, f"{folder}/_commits")
    if not files.exists(commits):
        return State(0, folder)
    names = sorted((s.getPath().getName() for s in files.listStatus(commits) if s.getPath().getName().isdigit()), reverse=True)
    for name in names:
        snapshot = read_text(spark, f"{folder}/_commits/{name}")
        # A number without a name is a commit that was cut off: it never took place.
        if snapshot:
            return State(int(name), f"{folder}/{snapshot}")
    return State(0, folder)


def replace(spark: SparkSession, folder: str, write: Callable[[str], None], parent: int | None = None) -> State:
    """Let ``write`` fill a new snapshot folder, then make it the current state.

    With ``parent``, the number of the state the new one was derived from, any other state committed meanwhile raises
    ``CommitConflict``; without it the newest state is replaced, whatever it is.
    """
    folder = folder.rstrip("/")
    before = current(spark, folder).number
    if parent is not None and parent != before:
        raise CommitConflict(f"{folder} is at state {before}, the write started from {parent}")
    snapshot = f"snapshot-{uuid.uuid4().hex}"
    write(f"{folder}/{snapshot}")
    jvm, files, commits = _files(spark, f"{folder}/_commits")
    files.mkdirs(commits)
    number = (parent if parent is not None else current(spark, folder).number) + 1
    while True:
        try:
            stream = files.create(jvm.org.apache.hadoop.fs.Path(commits, f"{number:010d}"), False)
            break
        except Py4JJavaError as taken:
            if "FileAlreadyExists" not in taken.java_exception.getClass().getName() and "already exists" not in str(taken.java_exception.getMessage()):
                raise
            if parent is not None and current(spark, folder).number >= number:
                raise CommitConflict(f"{folder} is at state {current(spark, folder).number}, the write started from {parent}") from None
            number += 1
    try:
        stream.write(snapshot.encode())
    finally:
        stream.close()
    return State(number, f"{folder}/{snapshot}")

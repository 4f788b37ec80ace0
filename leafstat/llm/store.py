"""Files of the operators in the shared folder, reached from any task."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyarrow import fs


def located(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI (local, HDFS, object stores), and the path in it."""
    return fs.FileSystem.from_uri(uri)


def task_file(folder: str, suffix: str) -> str:
    """A new name for a file of this task.

    Each attempt has its own, so that a repeated or lost task cannot harm a
    file that another one wrote; the files that count are those listed in the
    manifest that the attempt's committed output makes up.
    """
    part = TaskContext.get().partitionId()
    return f"{folder.rstrip('/')}/part-{part:06d}-{uuid.uuid4().hex}{suffix}"


def create(uri: str):
    """An output stream for a new file; makes its folder where there are such."""
    store, path = located(uri)
    store.create_dir(path.rsplit("/", 1)[0], recursive=True)
    return store.open_output_stream(path, compression=None)


def opened(uri: str):
    """A buffered input stream."""
    store, path = located(uri)
    return store.open_input_stream(path, compression=None, buffer_size=1 << 20)


def one_file_a_task(manifest: DataFrame, files: int) -> DataFrame:
    """The manifest dealt so that a task holds about one file."""
    return manifest.repartitionByRange(max(1, files), F.col("path"))


def rows_of(batch: pa.RecordBatch) -> Iterator[dict]:
    yield from batch.to_pylist()

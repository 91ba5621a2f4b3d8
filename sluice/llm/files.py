"""Written intermediate tables and binary files in the folder that all executors share."""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

from sluice.session import shared_folder


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder; nothing is made yet."""
    return f"{shared_folder(spark)}/sluice-{name}-{uuid.uuid4().hex}"


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def _batches_of(spark: SparkSession, limit: int | None):
    """Jobs planned meanwhile send Arrow batches of about ``limit`` bytes to Python, if the session's are larger."""
    before = spark.conf.get(BATCH_BYTES, None)  # None: not set
    size = re.fullmatch(r"(\d+)([kmgtp]?)b?", before.strip().lower()) if before else None
    if limit is None or (size and int(size[1]) << 10 * " kmgtp".index(size[2] or " ") <= limit):
        yield
        return
    spark.conf.set(BATCH_BYTES, str(limit))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(BATCH_BYTES)
        else:
            spark.conf.set(BATCH_BYTES, before)


def written(df: DataFrame, name: str, codec: str = "zstd", batch_bytes: int | None = None) -> DataFrame:
    """The rows of ``df``, written once as Parquet and read again: lineage is cut, lost executors cost nothing.

    With ``batch_bytes`` its texts go to Python in Arrow batches of about that size, and not of up to 10,000 rows, which
    the JVM holds thrice and Python once in each task. What a batch holds is no part of any result. The folder's clean-up is the cluster's (a time to live on its scratch folder): rows may be read
    long after the operator has returned.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    with _batches_of(spark, batch_bytes):
        df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path within it."""
    if "://" in path or path.startswith("file:"):
        if path.startswith("file:"):
            return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), os.path.abspath(path)


class NewFile:
    """A file under a name of its own, so a repeated or speculative task never meets another's.

    A reader takes only files that a finished task has named.
    """

    def __init__(self, folder: str, suffix: str):
        self.name = f"{uuid.uuid4().hex}{suffix}"
        self._fs, base = file_system(folder)
        self._fs.create_dir(base, recursive=True)
        self._out = self._fs.open_output_stream(f"{base}/{self.name}", compression=None)
        self.size = 0

    def write(self, data: bytes) -> None:
        self._out.write(data)
        self.size += len(data)

    def close(self) -> None:
        self._out.close()


def open_input(folder: str, name: str) -> pa.NativeFile:
    system, base = file_system(folder)
    return system.open_input_file(f"{base}/{name}")


def chunks_of(batches: Iterator[pa.RecordBatch], column: str, limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with at most ``limit`` bytes in ``column``, or one row."""
    import pyarrow.compute as pc

    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False)
        first = total = 0
        for row, length in enumerate(lengths):
            if total and total + length > limit:
                yield batch.slice(first, row - first)
                first, total = row, 0
            total += int(length)
        if first < batch.num_rows:
            yield batch.slice(first)

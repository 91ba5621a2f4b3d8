"""Files of large local or mounted folders, listed and read by tasks: the driver holds neither names nor sizes."""

from __future__ import annotations

import os
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.sources.staging import staged

DRIVER_ENTRIES = 10_000  # of one folder, with all below; Spark's own readers keep every file on the driver, so no more go to them
CHUNK_FILES, CHUNK_BYTES = 100, 4 << 20  # of one folder, listed as one row and read at once; a larger file is alone
TASK_FILES, TASK_BYTES = 2_000, 64 << 20  # read by one task
WALKED = 100  # folders that a listing task goes on with below its own

_LISTED = "folder binary, names array<binary>, bytes bigint"  # without names: a folder still to be listed; names are bytes, as in the folder


def large_folder(spark: SparkSession, path: str) -> str | None:
    """The plain path of a local or mounted folder that holds more than ``DRIVER_ENTRIES``, else None.

    A path with signs of a pattern is none: Spark's readers take it as one.
    """
    if path.startswith("/"):
        if not spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///").startswith("file:"):
            return None
    elif not path.startswith("file:"):
        return None
    local = "/" + path.removeprefix("file:").lstrip("/")
    if any(sign in local for sign in "*?[{\\") or not os.path.isdir(local):
        return None
    return local if next(islice(_all_entries(local), DRIVER_ENTRIES, None), None) else None


def binary_files(spark: SparkSession, folder: str, suffix: str) -> DataFrame:
    """``below, content`` of every file with that suffix in ``folder`` and all below; ``below`` is the path from there.

    The files are those that Spark's ``binaryFile`` reader takes: hidden names and empty files are left out, links are
    followed (checksum files beside them are not read). They are listed when this is called and read when the rows are.
    """
    listed, tasks = _listing(spark, folder, suffix)
    return listed.repartition(tasks).mapInArrow(_reading(len(folder)), "below string, content binary")


def _view():
    """``entries`` of a folder, and of an entry ``is_folder`` and ``size``, as Spark's readers have them.

    As inner functions they go to the tasks by value, whose workers need not have this package.
    """

    def entries(folder: str) -> Iterator[os.DirEntry]:
        try:
            with os.scandir(folder) as found:
                for entry in found:
                    name = entry.name
                    if name.startswith(".") or name.endswith("._COPYING_"):
                        continue
                    if name.startswith("_") and "=" not in name and not (name.startswith(("_metadata", "_common_metadata")) and is_folder(entry)):
                        continue
                    yield entry
        except FileNotFoundError:  # gone meanwhile
            pass

    def is_folder(entry: os.DirEntry) -> bool:
        return os.path.isdir(entry.path) if entry.is_symlink() else entry.is_dir()

    def size(entry: os.DirEntry) -> int:
        try:
            return entry.stat().st_size
        except OSError:
            if entry.is_symlink() or not os.path.lexists(entry.path):  # a link that leads nowhere, or gone meanwhile
                return 0
            raise

    return entries, is_folder, size


_entries, _is_folder, _size = _view()


def _all_entries(folder: str) -> Iterator[os.DirEntry]:
    todo = [folder]
    while todo:
        for entry in _entries(todo.pop()):
            yield entry
            if _is_folder(entry):
                todo.append(entry.path)


def _listing(spark: SparkSession, folder: str, suffix: str) -> tuple[DataFrame, int]:
    """The chunks of files, staged, and the number of tasks to read them; one job lists what the one before it left."""
    cores = spark.sparkContext.defaultParallelism
    todo, folders = spark.range(1).select(F.lit(os.fsencode(folder)).alias("folder")), 1
    listed, chunks, files, size = None, 0, 0, 0
    while folders:
        tasks = max(min(folders, cores), -(-folders // WALKED))
        level = staged(todo.repartition(tasks).mapInArrow(_walking(suffix), _LISTED), "listing")
        held = level.agg(
            F.count("names").alias("chunks"), F.count_if(F.col("names").isNull()).alias("folders"),
            F.coalesce(F.sum(F.size("names")), F.lit(0)).alias("files"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"),
        ).first()
        listed = level if listed is None else listed.unionByName(level)
        todo, folders = level.where(F.col("names").isNull()).select("folder"), held.folders
        chunks, files, size = chunks + held.chunks, files + held.files, size + held.bytes
    tasks = max(min(chunks, cores), -(-files // TASK_FILES), -(-size // TASK_BYTES), 1)
    return listed.where(F.col("names").isNotNull()).select("folder", "names"), tasks


def _walking(suffix: str):
    """A task lists its folders and goes on with ``WALKED`` folders below them; further ones come out as they are."""

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        rows = [(os.fsencode(folder), names and [*map(os.fsencode, names)], size) for folder, names, size in rows]
        kinds = (pa.binary(), pa.list_(pa.binary()), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(values, kind) for values, kind in zip(zip(*rows), kinds)], names=["folder", "names", "bytes"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = WALKED
        rows: list[tuple] = []
        for batch in batches:
            todo = [*map(os.fsdecode, batch["folder"].to_pylist())]
            while todo:
                folder = todo.pop()
                names, total = [], 0
                for entry in _entries(folder):
                    if _is_folder(entry):
                        if left:
                            left -= 1
                            todo.append(entry.path)
                        else:
                            rows.append((entry.path, None, None))
                    elif entry.name.endswith(suffix) and (size := _size(entry)):
                        if names and (len(names) == CHUNK_FILES or total + size > CHUNK_BYTES):
                            rows.append((folder, names, total))
                            names, total = [], 0
                        names.append(entry.name)
                        total += size
                    if len(rows) >= CHUNK_FILES:
                        yield batch_of(rows)
                        rows = []
                if names:
                    rows.append((folder, names, total))
        if rows:
            yield batch_of(rows)

    return run


def _reading(root: int):
    """A task reads its chunks one at a time; paths lose their first ``root`` characters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for folder, names in zip(batch["folder"], batch["names"]):
                paths = [os.fsdecode(os.path.join(folder.as_py(), name)) for name in names.as_py()]
                contents = []
                for path in paths:
                    with open(path, "rb") as file:
                        contents.append(file.read())
                below = pa.array([path[root:].encode(errors="replace").decode() for path in paths], pa.string())
                yield pa.RecordBatch.from_arrays([below, pa.array(contents, pa.binary())], names=["below", "content"])

    return run

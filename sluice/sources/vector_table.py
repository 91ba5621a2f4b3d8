"""A vector table on Parquet: namespaces and id buckets are partitions, and an upsert touches only those it writes to.

An upsert reads the partitions that its batch falls into, keeps the last write of each ``(namespace, id)`` and puts the merged
partitions in the place of the old ones. All other partitions keep their files. The merged rows are first
written beside the table, so a failure while partitions are being replaced loses nothing: publish them again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructType

from sluice.sources.sinks import latest_vectors
from sluice.sources.staging import replace_partitions, staged, stored

BUCKETS = 64
PARTITIONS = ("part_space", "part_buckets", "part_bucket")


def bucket_of(ident: Column, buckets: int) -> Column:
    """Bucket of an id, from its MD5; a null id is in bucket 0."""
    return F.coalesce(F.conv(F.substring(F.md5(ident.cast("binary")), 1, 8), 16, 10).cast("long") % buckets, F.lit(0)).cast("int")


def _placed(rows: DataFrame, buckets: int) -> DataFrame:
    """Rows with their partition. Names get a letter in front, so that no name reads as a number or as nothing."""
    return rows.withColumns(
        {
            "part_space": F.concat(F.lit("n"), F.coalesce(F.col("namespace"), F.lit(""))),
            "part_buckets": F.lit(buckets), "part_bucket": bucket_of(F.col("id"), buckets),
        }
    )


def _schema(rows: StructType) -> StructType:
    return StructType(rows.fields).add("part_space", StringType()).add("part_buckets", IntegerType()).add("part_bucket", IntegerType())


def read_vectors(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All vectors of a table, one row per ``(namespace, id)``; no rows where there is no table yet."""
    return stored(spark, path, _schema(schema)).drop(*PARTITIONS)


def stage_upsert(batch: DataFrame, path: str, buckets: int = BUCKETS, seq: str = "seq") -> DataFrame:
    """The merged rows of all partitions that a batch touches, written beside the table but not published.

    The batch is run once. Which partitions it touches is known to the driver: their number is at most that of
    the table's partitions, which Spark lists there as well. ``buckets`` belongs to the table: a
    table made with another number is refused.
    """
    taken = [c for c in PARTITIONS if c in batch.columns]
    if taken:
        raise ValueError(f"columns of the batch have the names of partitions: {taken}")
    spark, schema = batch.sparkSession, batch.schema
    fresh = staged(_placed(latest_vectors(None, batch, seq), buckets), "upsert-batch")
    table = stored(spark, path, _schema(schema))
    other = table.where(F.col("part_buckets") != buckets).select("part_buckets").first()
    if other:
        raise ValueError(f"the table at {path} has {other[0]} buckets, not {buckets}")
    place = F.concat_ws("/", "part_bucket", "part_space")
    touched = [r[0] for r in fresh.select(place).distinct().collect()]
    old = table.where(place.isin(touched)) if touched else table.limit(0)
    merged = latest_vectors(old.drop(*PARTITIONS), fresh.drop(*PARTITIONS), seq).select(*schema.names)
    return staged(_placed(merged, buckets), "upsert-merged")


def publish(merged: DataFrame, path: str) -> None:
    """Put staged partitions in the place of the table's own. Doing it again changes nothing."""
    replace_partitions(merged.hint("rebalance", "part_space", "part_bucket"), path, *PARTITIONS)


def upsert(batch: DataFrame, path: str, buckets: int = BUCKETS, seq: str = "seq") -> None:
    """Merge a batch into the table at ``path``; the last write of each ``(namespace, id)`` by ``seq`` stays.

    Fits ``foreachBatch``: a batch that comes again changes nothing. One writer at a time.
    """
    merged = stage_upsert(batch, path, buckets, seq)
    try:
        publish(merged, path)
    except Exception as problem:
        problem.add_note(f"the merged partitions are in {merged.inputFiles()[:1]}: publish them again before the next batch")
        raise

"""A table in ascending key order over many tasks, cut at keys that occur in it."""

from __future__ import annotations

from bisect import bisect_right

import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame

ROWS_PER_BUCKET = 4000
MAX_BUCKETS = 20_000


def bounds(df: DataFrame, key: str, rows_per_bucket: int = ROWS_PER_BUCKET) -> list:
    """Keys of ``df`` that cut it into buckets of about so many rows, ascending.

    Reads the key column alone. At most MAX_BUCKETS keys come to the driver: on a larger table the
    buckets grow, and a bucket is sorted by Spark, which spills.
    """
    rows = df.where(F.col(key).isNotNull()).agg(F.count("*").alias("n")).first().n
    n = min(MAX_BUCKETS, rows // rows_per_bucket)
    if n < 2:
        return []
    marks = [k / n for k in range(1, n)]
    found = df.agg(F.percentile_approx(key, marks, max(10_000, 10 * n)).alias("m")).first().m
    return sorted(set(found))


def bucket(key: Column, cuts: list, strict: bool = False) -> Column:
    """How many of the cuts are at or below the key, or below it (``strict``); null keys come first, in bucket 0."""
    if not cuts:
        return F.lit(0)
    tree = _tree(key, cuts, 0, len(cuts), strict)
    return F.when(key.isNull(), F.lit(0)).otherwise(tree)


def _tree(key: Column, cuts: list, low: int, high: int, strict: bool) -> Column:
    if high - low > 64:
        mid = (low + high) // 2
        before = key <= F.lit(cuts[mid]) if strict else key < F.lit(cuts[mid])
        return F.when(before, _tree(key, cuts, low, mid, strict)).otherwise(_tree(key, cuts, mid + 1, high, strict))
    below = F.array(*(F.lit(c) for c in cuts[low:high]))
    return F.lit(low) + F.size(F.filter(below, lambda c: c < key if strict else c <= key))


def bucket_of(value, cuts: list) -> int:
    return 0 if value is None else bisect_right(cuts, value)


def in_order(df: DataFrame, cuts: list, key: str, *ties: str) -> DataFrame:
    """Rows by bucket: a task holds whole buckets, each in ascending order of key and ties."""
    spark = df.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(len(cuts) + 1, 4 * spark.sparkContext.defaultParallelism))
    placed = df if "bucket_no" in df.columns else df.withColumn("bucket_no", bucket(F.col(key), cuts))
    return placed.repartition(tasks, "bucket_no").sortWithinPartitions(
        "bucket_no", F.col(key).asc_nulls_first(), *(F.col(t).asc_nulls_first() for t in ties)
    )

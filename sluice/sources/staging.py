"""Tables written once in the folder that all executors share, so that what made them runs once."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from sluice.session import shared_folder


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder; nothing is made yet."""
    return f"{shared_folder(spark)}/sluice-{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df`` as a written table: lineage is cut, and a lost executor costs nothing.

    The folder's clean-up is the cluster's, since rows may be read long after the caller has returned.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored(spark: SparkSession, path: str, schema) -> DataFrame:
    """The Parquet table at ``path``, or no rows where there is none yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def replace_partitions(df: DataFrame, path: str, *columns: str) -> None:
    """Write rows under ``path`` by partition; those that occur are replaced, all others keep their files."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*columns).parquet(path)

"""Cloud-plan documents: JSON text in, one row per planned resource out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def plan_resources(documents: DataFrame, plan_id: str = "plan_id", body: str = "body") -> DataFrame:
    """``plan_id, type, name, address, after`` of every ``resource_changes`` item.

    ``after`` is NULL where the plan does not state it and a VARIANT null where it states null.
    Documents that are not JSON give no rows.
    """
    parsed = documents.select(
        F.col(plan_id).alias("plan_id"),
        F.try_variant_get(F.try_parse_json(F.col(body)), "$.resource_changes", "array<variant>").alias("_changes"),
    )
    rows = parsed.select("plan_id", F.explode_outer("_changes").alias("_r")).where(F.col("_r").isNotNull())
    return rows.select(
        "plan_id",
        *[F.try_variant_get("_r", f"$.{n}", "string").alias(n) for n in ("type", "name", "address")],
        F.try_variant_get("_r", "$.change.after", "variant").alias("after"),
    )


def read_plans(spark: SparkSession, folder: str) -> DataFrame:
    """Plan files of a folder, one document per file, keyed by file name."""
    files = spark.read.text(folder, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.json")
    return plan_resources(
        files.select(F.element_at(F.split("_metadata.file_path", "/"), -1).alias("plan_id"), F.col("value").alias("body"))
    )

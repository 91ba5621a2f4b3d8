"""Rule tables spelled in the program as DataFrames."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def fixed_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """Rule rows known to the program. The size is that of the program text, so it is broadcast."""
    names = [part.strip().split(" ")[0] for part in _split_columns(schema)]
    payload = json.dumps([dict(zip(names, row)) for row in rows], ensure_ascii=False)
    parsed = F.from_json(F.lit(payload), f"array<struct<{_struct_fields(schema)}>>")
    return F.broadcast(spark.range(1).select(F.inline(parsed)))


def _split_columns(schema: str) -> list[str]:
    parts, depth, current = [], 0, ""
    for char in schema:
        depth += (char in "<(") - (char in ">)")
        if char == "," and depth == 0:
            parts.append(current)
            current = ""
        else:
            current += char
    return [*parts, current]


def _struct_fields(schema: str) -> str:
    return ",".join(":".join(part.strip().split(" ", 1)) for part in _split_columns(schema))


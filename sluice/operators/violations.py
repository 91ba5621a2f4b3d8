"""Rule packs over requests, model output, logs and evidence.

Each pack appends an array of messages to its rows, so several packs cost one pass; the long
report is one row per record, pack and message.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.rows import explode_found
from sluice.plans import fixed_values as V


def messages(*rules: tuple[Column, Column | str]) -> Column:
    """Array of the messages whose condition is true; NULL conditions do not fire."""
    none = F.array().cast("array<string>")
    arms = []
    for test, message in rules:
        text = F.lit(message) if isinstance(message, str) else message
        arms.append(F.when(test, F.array(text)).otherwise(none))
    return F.concat(*arms) if len(arms) > 1 else arms[0]


def input_messages(types: Column) -> Column:
    """Entity types that may not appear in a prompt at all."""
    return messages(
        (F.array_contains(types, "SSN"), V.MSG_SSN_INPUT),
        (F.array_contains(types, "MRN"), V.MSG_MRN_INPUT),
    )


def agent_messages(action: Column, allow_api: Column) -> Column:
    return messages(((action == "api_call") & ~F.coalesce(allow_api, F.lit(False)), V.MSG_AGENT))


def absent(record: Column, name: str) -> Column:
    """A field of a VARIANT record that is missing or false. JSON null counts as present."""
    value = F.to_json(F.try_variant_get(record, f"$.{name}", "variant"))
    return F.coalesce(value == "false", F.lit(True))


def missing_fields(record: Column, fields: list[str] | None = None) -> Column:
    """Array of the required log fields a record lacks."""
    wanted = V.LOG_FIELDS if fields is None else fields
    return messages(*[(absent(record, name), name) for name in wanted])


def evidence_messages(record: Column, fields: list[str] | None = None) -> Column:
    """One message however many required evidence fields are lacking."""
    gap = F.lit(False)
    for name in V.EVIDENCE_FIELDS if fields is None else fields:
        gap = gap | absent(record, name)
    return messages((gap, V.MSG_EVIDENCE))


def untrusted_sources(df: DataFrame, trusted: DataFrame, source: str = "source") -> DataFrame:
    """Rows whose source is in no trusted row; an absent source is not trusted."""
    known = trusted.select(F.col(trusted.columns[0]).alias("_known"))
    return df.join(known, F.col(source) == F.col("_known"), "left_anti")


def with_trust(df: DataFrame, trusted: DataFrame, source: str = "source") -> DataFrame:
    """Append ``trusted``: whether the source is in a trusted row."""
    known = trusted.select(F.col(trusted.columns[0]).alias("_known")).distinct()
    joined = df.join(known, F.col(source) == F.col("_known"), "left")
    return joined.withColumn("trusted", F.col("_known").isNotNull()).drop("_known")


def acl_allowed(df: DataFrame, acl: DataFrame, record_type: str = "record_type", role: str = "role") -> DataFrame:
    """Rows whose role is the one role the ACL names for their record type; default is deny."""
    rules = acl.select(F.col("record_type").alias("_type"), F.col("role").alias("_role"))
    return df.join(rules, (F.col(record_type) == F.col("_type")) & (F.col(role) == F.col("_role")), "left_semi")


def long_report(df: DataFrame, *keys: str, packs: dict[str, Column]) -> DataFrame:
    """One row per record, pack and message, from one pass over the records."""
    empty = F.array().cast("array<struct<pack:string,message:string>>")

    def tagged(name: str):
        return lambda message: F.struct(F.lit(name).alias("pack"), message.alias("message"))

    parts = [
        F.when(F.size(found) > 0, F.transform(found, tagged(name))).otherwise(empty)
        for name, found in packs.items()
    ]
    listed = explode_found(df, *keys, array=F.concat(*parts) if len(parts) > 1 else parts[0], alias="_found")
    return listed.select(*keys, "_found.pack", "_found.message")

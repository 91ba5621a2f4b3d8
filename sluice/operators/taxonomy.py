"""Label rules as tables: findings in long form joined to a taxonomy."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.operators.tables import fixed_table


def taxonomy_table(spark: SparkSession, mapping: dict[str, str], priority: list[str]) -> DataFrame:
    rows = [(kind, label, priority.index(label)) for kind, label in mapping.items()]
    return fixed_table(spark, rows, "entity_type string, label string, priority int")


def label_findings(
    findings: DataFrame,
    taxonomy: DataFrame,
    *keys: str,
    no_entities: str = "INTERNAL",
    fallback: str | None = None,
) -> DataFrame:
    """One label per key from findings in long form; a NULL entity type means no finding.

    The taxonomy is joined before the shuffle and the best priority is a minimum of numbers, so
    each task hashes its rows and sends one per key: a key with most of the rows costs no more than
    others. A priority stands for one label.
    """
    joined = findings.join(taxonomy.select("entity_type", "priority"), "entity_type", "left")
    best = joined.groupBy(*keys).agg(F.min("priority").alias("priority"), F.count("entity_type").alias("_n_types"))
    named = best.join(taxonomy.select("priority", F.col("label").alias("_label")).distinct(), "priority", "left")
    rest = F.when(F.col("_n_types") == 0, no_entities).otherwise(
        no_entities if fallback is None else fallback
    )
    return named.select(*keys, F.coalesce("_label", rest).alias("label"))


def with_handling(labelled: DataFrame, handling: dict[str, list[str]], label: str = "label") -> DataFrame:
    """Flags ``h_allow … h_evidence`` of the label; NULL for a label with no handling entry."""
    known = F.col(label).isin(*handling)
    flags = {
        f"h_{step}": F.when(known, F.col(label).isin(*[k for k, steps in handling.items() if step in steps]))
        for step in ("allow", "mask", "block", "log", "evidence")
    }
    return labelled.withColumns(flags)


def unknown_tokens(df: DataFrame, taxonomy: DataFrame, column: str = "entity_type") -> DataFrame:
    """Rows whose type is in no taxonomy row; an absent type is unknown too."""
    known = taxonomy.select(F.col("entity_type").alias("_known"))
    return df.join(known, F.col(column) == F.col("_known"), "left_anti")


def rollup(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))

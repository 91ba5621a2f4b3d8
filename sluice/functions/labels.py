"""Sensitivity labels from hit columns, entity arrays and taxonomies."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sluice.functions.patterns import SPACE_CHARS
from sluice.plans import fixed_values as V


def label_from_hits() -> Column:
    """Label of a scanned row: health beats identity beats internal."""
    return (
        F.when(F.col("hit_mrn") | F.col("hit_phi"), "phi")
        .when(F.col("hit_ssn").isNotNull() | F.col("hit_routing").isNotNull(), "restricted_pii")
        .otherwise("internal")
    )


def state_label_from_hits() -> Column:
    """``normalise_label`` of the label of a scanned row, without going through its text."""
    return (
        F.when(F.col("hit_mrn") | F.col("hit_phi"), "RESTRICTED_PHI")
        .when(F.col("hit_ssn").isNotNull() | F.col("hit_routing").isNotNull(), "RESTRICTED_PII")
        .otherwise("INTERNAL")
    )


def label_from_pii_hits() -> Column:
    """Label of the identity findings alone; health hits are not among them."""
    sensitive = F.col("hit_ssn").isNotNull() | F.col("hit_ssn_word") | F.col("hit_routing").isNotNull()
    return F.when(sensitive, "restricted_pii").otherwise("internal")


def entity_types(entities: Column) -> Column:
    return F.coalesce(entities.getField("type"), F.array().cast("array<string>"))


def label_from_types(types: Column) -> Column:
    """Label of any array of entity type names, in any letter case."""
    upper = F.transform(types, lambda t: F.upper(t))

    def holds(wanted: list[str]) -> Column:
        return F.coalesce(F.arrays_overlap(upper, F.array(*[F.lit(w) for w in wanted])), F.lit(False))

    return (
        F.when(holds(V.PHI_TYPES), "phi")
        .when(holds(V.PII_TYPES), "restricted_pii")
        .otherwise("internal")
    )


def normalise_label(label: Column) -> Column:
    """Policy spelling of a label. Anything not recognised becomes INTERNAL."""
    norm = F.lower(F.trim(F.coalesce(label, F.lit("")), F.lit(SPACE_CHARS)))
    return (
        F.when(norm.isin("restricted_pii", "pii"), "RESTRICTED_PII")
        .when(norm.isin("restricted_phi", "phi"), "RESTRICTED_PHI")
        .otherwise("INTERNAL")
    )


def default_action(label: Column) -> Column:
    return F.when(label.isin("RESTRICTED_PII", "RESTRICTED_PHI"), "block").otherwise("allow")


def label_by_taxonomy(
    types: Column,
    taxonomy: dict[str, str],
    priority: list[str],
    *,
    no_entities: str = "INTERNAL",
    fallback: str | None = None,
) -> Column:
    """Highest-priority label any type of the array maps to, as one CASE without a join.

    ``fallback`` is given to rows whose types are all unmapped; by default they get the same
    label as rows with no entity at all.
    """
    expr = None
    for label in priority:
        members = [F.lit(t) for t, mapped in taxonomy.items() if mapped == label]
        if not members:
            continue
        test = F.coalesce(F.arrays_overlap(types, F.array(*members)), F.lit(False))
        expr = F.when(test, label) if expr is None else expr.when(test, label)
    empty = F.coalesce(F.size(types), F.lit(0)) <= 0
    rest = F.when(empty, no_entities).otherwise(no_entities if fallback is None else fallback)
    return rest if expr is None else expr.otherwise(rest)


def unknown_types(types: Column, allowed: list[str]) -> Column:
    """Distinct types of the array that no taxonomy row allows."""
    return F.array_except(types, F.array(*[F.lit(a) for a in allowed]))

"""Role, runtime and gateway decisions as CASE expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sluice.plans import fixed_values as V


def role_action(role: Column, has_ssn: Column) -> Column:
    """Only SSN findings count: none allows, the gateway admin masks, all others block."""
    return (
        F.when(~F.coalesce(has_ssn, F.lit(False)), "allow")
        .when(role == "dlp-admin", "mask")
        .otherwise("block")
    )


def has_type(entities: Column, kind: str) -> Column:
    return F.coalesce(F.exists(entities, lambda e: F.upper(e["type"]) == kind), F.lit(False))


def _first_with_risk(types: Column, level: str, risk: dict[str, str]) -> Column:
    members = [F.lit(t) for t, r in risk.items() if r == level]
    if not members:
        return F.lit(None).cast("string")
    return F.get(F.array_intersect(types, F.array(*members)), F.lit(0))


def runtime_decision(
    direction: Column,
    role: Column,
    types: Column,
    label: Column,
    move_allow: Column,
    move_reason: Column,
    *,
    risk: dict[str, str] | None = None,
    roles_high: list[str] | None = None,
    roles_medium: list[str] | None = None,
) -> Column:
    """Struct ``action, reason`` of the seven-rung chain; the first rung that applies decides.

    Missing input fails closed: an absent role reads ``unknown``, an absent reason is empty and
    absent entities are none, so the blocking rungs still apply. Of several risky types the
    first of the array is named.
    """
    risk = V.PII_RISK if risk is None else risk
    who = F.coalesce(role, F.lit("unknown"))
    found = F.coalesce(types, F.array().cast("array<string>"))
    high, medium = _first_with_risk(found, "high", risk), _first_with_risk(found, "medium", risk)
    sees_high = who.isin(*(V.ROLES_ALLOW_HIGH if roles_high is None else roles_high))
    sees_medium = who.isin(*(V.ROLES_ALLOW_MEDIUM if roles_medium is None else roles_medium))

    def verdict(action: str, reason: Column) -> Column:
        return F.struct(F.lit(action).alias("action"), reason.alias("reason"))

    return (
        F.when(label == "RESTRICTED_PHI",
               verdict("block", F.lit("PHI detected: restricted by classification")))
        .when(move_allow == F.lit(False),
              verdict("block", F.concat(F.lit("data movement denied: "), F.coalesce(move_reason, F.lit("")))))
        .when(high.isNotNull() & ~sees_high,
              verdict("block", F.format_string("high-risk PII (%s) blocked for role %s", high, who)))
        .when(medium.isNotNull() & ~sees_medium,
              verdict("mask", F.format_string("medium-risk PII (%s) masked for role %s", medium, who)))
        .when((direction == "egress") & (label == "CONFIDENTIAL"),
              verdict("mask", F.lit("confidential output masked on egress")))
        .when((direction == "ingress") & label.isin("INTERNAL", "CONFIDENTIAL", "PUBLIC"),
              verdict("allow", F.lit("classification allowed on ingress")))
        .otherwise(verdict("allow", F.lit("no policy matched")))
    )


def treated_answer(action: Column, answer: Column) -> Column:
    """Answer text as the gateway returns it; ``mask`` only prefixes, it hides nothing."""
    return (
        F.when(action == "block", V.ANSWER_BLOCKED)
        .when(action == "mask", F.concat(F.lit(V.ANSWER_MASK_PREFIX), answer))
        .otherwise(answer)
    )


def stub_answer(context: Column, prompt: Column) -> Column:
    """Fixed-form answer, so that treatment can be run without a model."""
    return F.concat(
        F.lit("[STUBBED ANSWER]\n\nContext:\n"), F.coalesce(context, F.lit("")),
        F.lit("\n\nPrompt:\n"), F.coalesce(prompt, F.lit("")),
    )


def decision_id(stage: str, *key: Column) -> Column:
    """Stable id of an evidence record: a hash of the stage and the request key."""
    return F.sha2(F.concat_ws("|", F.lit(stage), *[k.cast("string") for k in key]), 256)

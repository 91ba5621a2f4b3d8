"""The gateway as table jobs: request parsing, ingress and egress outcomes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions import decisions as D
from sluice.functions import detect, labels, masking
from sluice.functions import movement as M
from sluice.plans import fixed_values as V


def parse_requests(df: DataFrame, body: str = "body") -> DataFrame:
    """Append ``status, error, user_id, role, prompt`` read from a JSON request body.

    A body that is absent, not JSON or not an object reads as an empty object. A prompt that is
    absent, empty or not text gives status 400; an absent role reads ``unknown``.
    """
    parsed = df.withColumn("_body", F.try_parse_json(F.col(body)))
    kind = F.schema_of_variant(F.try_variant_get("_body", "$.prompt", "variant"))
    text = F.when(kind == "STRING", F.try_variant_get("_body", "$.prompt", "string"))
    read = parsed.withColumns(
        {
            "user_id": F.try_variant_get("_body", "$.user_id", "string"),
            "role": F.coalesce(F.try_variant_get("_body", "$.role", "string"), F.lit("unknown")),
            "prompt": F.nullif(text, F.lit("")),
        }
    ).drop("_body")
    missing = F.col("prompt").isNull()
    return read.withColumns(
        {
            "status": F.when(missing, 400).otherwise(200),
            "error": F.when(missing, V.ERROR_NO_PROMPT),
        }
    )


def ingress(df: DataFrame, *keys: str, text: str = "prompt", role: str = "role") -> DataFrame:
    """Outcome of each prompt: action, status, what is forwarded, and the masked alternative.

    ``forwarded_prompt`` is the prompt as it came, even for ``mask``; ``masked_prompt`` is what
    a masking gateway would send on, and what previews are cut from.
    """
    scanned = detect.with_hits(df, text)
    who = F.coalesce(F.col(role), F.lit("unknown"))
    acted = scanned.withColumns(
        {"pii_findings": detect.pii_entities(), "action": D.role_action(who, detect.has_ssn_finding())}
    )
    blocked = F.col("action") == "block"
    return masking.with_masked(detect.drop_hits(acted), text, "masked_prompt").withColumns(
        {
            "status": F.when(blocked, 400).otherwise(200),
            "error": F.when(blocked, V.ERROR_BLOCKED),
            "forwarded_prompt": F.when(~blocked, F.col(text)),
            "decision_id": D.decision_id("request", *[F.col(k) for k in keys]),
        }
    )


def egress(df: DataFrame, *keys: str, answer: str = "answer", role: str = "role") -> DataFrame:
    """Outcome of each answer: action, the returned text and the masked alternative."""
    scanned = detect.with_hits(df, answer)
    who = F.coalesce(F.col(role), F.lit("unknown"))
    acted = scanned.withColumns(
        {"pii_findings": detect.pii_entities(), "action": D.role_action(who, detect.has_ssn_finding())}
    )
    return masking.with_masked(detect.drop_hits(acted), answer, "masked_answer").withColumns(
        {
            "safe_answer": D.treated_answer(F.col("action"), F.col(answer)),
            "decision_id": D.decision_id("response", *[F.col(k) for k in keys]),
        }
    )


def runtime(
    df: DataFrame, direction: str, src: str, dst: str, *, text: str = "text", role: str = "role",
    flows: list[M.Flow] | None = None, normalise: bool = True, redacted: bool | None = None,
) -> DataFrame:
    """Detect, label, test one hop and run the decision chain.

    ``normalise=True`` gives rules the label spelling they know. ``normalise=False`` passes the
    lower-case label on as the original handlers do, which no rule matches.
    ``redacted=None`` derives the flag from the label.
    """
    scanned = detect.with_hits(df, text).withColumns(
        {"entities": detect.pii_entities(), "label": labels.label_from_pii_hits()}
    )
    used = labels.normalise_label(F.col("label")) if normalise else F.col("label")
    flag = ~used.isin(*M.RESTRICTED) if redacted is None else F.lit(redacted)
    judged = detect.drop_hits(scanned.withColumn("used_label", used)).withColumn(
        "movement",
        M.hop_verdict(M.DEFAULT_FLOWS if flows is None else flows, src, dst, M.state(F.col("used_label"), F.lit("allow"), flag)),
    )
    verdict = D.runtime_decision(
        F.lit(direction), F.coalesce(F.col(role), F.lit("anonymous")), labels.entity_types(F.col("entities")),
        F.col("used_label"), F.col("movement.allow"), F.col("movement.reason"),
    )
    return judged.withColumn("_verdict", verdict).withColumn("decision", decision_record("_verdict")).drop("_verdict")


def decision_record(verdict: str, label: str = "used_label", entities: str = "entities") -> Column:
    """Decision as it is handed on: ``action, reason, labels, entities``."""
    return F.struct(
        F.col(f"{verdict}.action").alias("action"), F.col(f"{verdict}.reason").alias("reason"),
        F.array_compact(F.array(label)).alias("labels"), F.col(entities).alias("entities"),
    )


def handle_ingress(df: DataFrame, **options) -> DataFrame:
    return runtime(df, "ingress", "dlp_gateway", "rag_orchestrator", **options)


def handle_egress(df: DataFrame, **options) -> DataFrame:
    return runtime(df, "egress", "dlp_gateway", "user", redacted=True, **options)

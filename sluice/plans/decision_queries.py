"""Role, runtime and gateway queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from sluice.functions import decisions as D
from sluice.functions import detect, labels
from sluice.operators import gateway
from sluice.plans import fixed_values as V
from sluice.plans import triggers as T
from sluice.plans.registry import query, table
from sluice.plans.text_queries import SQL_STATE, documents, scanned_documents, turns

DOC_ROLE = "CASE doc_id % 5 WHEN 0 THEN 'analyst' WHEN 1 THEN 'dlp-admin' WHEN 2 THEN 'admin' WHEN 3 THEN 'professional' END"
TURN_ROLE = "CASE conv_id % 4 WHEN 0 THEN 'member' WHEN 1 THEN 'dlp-admin' WHEN 2 THEN 'admin' END"
SQL_HAS_SSN = "(ssn IS NOT NULL OR ssn_word)"


def _sql_action(role: str) -> str:
    return f"CASE WHEN NOT {SQL_HAS_SSN} THEN 'allow' WHEN {role} = 'dlp-admin' THEN 'mask' ELSE 'block' END"


@query(
    "role_actions",
    T.sql_docs(f", r AS (SELECT *, coalesce({DOC_ROLE}, 'unknown') AS role FROM hits)") + f"""
    SELECT doc_id, role, {_sql_action('role')} AS action FROM r""",
)
def role_actions(spark, folder):
    found = detect.detect_pii(documents(spark, folder).select("doc_id", "text"))
    acted = found.withColumn("role", F.coalesce(F.expr(DOC_ROLE), F.lit("unknown")))
    return acted.select(
        "doc_id", "role", D.role_action(F.col("role"), D.has_type(F.col("entities"), "SSN")).alias("action")
    )


_DECLARED = """CASE doc_id % 7 WHEN 1 THEN 'EMAIL_ADDRESS' WHEN 2 THEN 'IP_ADDRESS'
  WHEN 3 THEN 'CREDIT_CARD' WHEN 5 THEN 'DOB' END"""
_MOVE_ALLOW = "doc_id % 13 <> 0"
_MOVE_REASON = "CASE WHEN doc_id % 2 = 0 THEN 'restricted flow' END"
_DIRECTION = "CASE WHEN doc_id % 2 = 0 THEN 'ingress' ELSE 'egress' END"
_HIGH = "('SSN', 'PASSPORT', 'DRIVERS_LICENSE', 'CREDIT_CARD')"
_MEDIUM = "('DOB', 'PHONE_NUMBER', 'EMAIL_ADDRESS', 'ADDRESS')"


@query(
    "runtime_decisions",
    T.sql_docs(f""", i AS (SELECT doc_id, {_DIRECTION} AS direction, coalesce({DOC_ROLE}, 'unknown') AS role,
      CASE doc_id % 6 WHEN 0 THEN 'CONFIDENTIAL' WHEN 1 THEN 'PUBLIC' ELSE {SQL_STATE} END AS label,
      list_filter([{_DECLARED}, CASE WHEN ssn IS NOT NULL THEN 'SSN' END, CASE WHEN routing IS NOT NULL THEN 'ROUTING' END,
        CASE WHEN passport IS NOT NULL THEN 'PASSPORT' END], lambda t: t IS NOT NULL) AS types,
      {_MOVE_ALLOW} AS ok, {_MOVE_REASON} AS why FROM hits),
    f AS (SELECT *, list_filter(types, lambda t: t IN {_HIGH})[1] AS high, list_filter(types, lambda t: t IN {_MEDIUM})[1] AS medium FROM i),
    v AS (SELECT *, CASE WHEN label = 'RESTRICTED_PHI' THEN 'block|PHI detected: restricted by classification'
      WHEN NOT ok THEN 'block|data movement denied: ' || coalesce(why, '')
      WHEN high IS NOT NULL AND role <> 'admin' THEN 'block|high-risk PII (' || high || ') blocked for role ' || role
      WHEN medium IS NOT NULL AND role NOT IN ('admin', 'professional') THEN 'mask|medium-risk PII (' || medium || ') masked for role ' || role
      WHEN direction = 'egress' AND label = 'CONFIDENTIAL' THEN 'mask|confidential output masked on egress'
      WHEN direction = 'ingress' AND label IN ('INTERNAL', 'CONFIDENTIAL', 'PUBLIC') THEN 'allow|classification allowed on ingress'
      ELSE 'allow|no policy matched' END AS verdict FROM f)
    SELECT doc_id, label, split_part(verdict, '|', 1) AS action, split_part(verdict, '|', 2) AS reason FROM v"""),
)
def runtime_decisions(spark, folder):
    scanned = scanned_documents(spark, folder).select(
        "doc_id",
        F.expr(_DIRECTION).alias("direction"),
        F.expr(DOC_ROLE).alias("role"),
        F.when(F.expr("doc_id % 6 = 0"), "CONFIDENTIAL").when(F.expr("doc_id % 6 = 1"), "PUBLIC")
        .otherwise(labels.state_label_from_hits()).alias("label"),
        F.array_compact(
            F.array(
                F.expr(_DECLARED),
                F.when(F.col("hit_ssn").isNotNull(), "SSN"),
                F.when(F.col("hit_routing").isNotNull(), "ROUTING"),
                F.when(F.col("hit_passport").isNotNull(), "PASSPORT"),
            )
        ).alias("types"),
        F.expr(_MOVE_ALLOW).alias("move_allow"),
        F.expr(_MOVE_REASON).alias("move_reason"),
    )
    decided = scanned.withColumn(
        "decision",
        D.runtime_decision(
            F.col("direction"), F.col("role"), F.col("types"), F.col("label"), F.col("move_allow"), F.col("move_reason")
        ),
    )
    return decided.select("doc_id", "label", "decision.action", "decision.reason")


_SHAPE = "(conv_id + turn) % 9"


@query(
    "request_validation",
    f"""WITH r AS (SELECT conv_id, turn, {_SHAPE} AS shape, coalesce({TURN_ROLE}, 'unknown') AS role, text FROM conversations)
    SELECT conv_id, turn, CASE WHEN shape IN (0, 1, 2, 5, 6, 7) OR text = '' THEN 400 ELSE 200 END AS status,
      CASE WHEN shape IN (0, 1, 2, 5, 6, 7) OR text = '' THEN 'Missing ''prompt'' in request body' END AS error,
      CASE WHEN shape IN (0, 3, 6, 7) THEN 'unknown' ELSE role END AS role,
      CASE WHEN shape IN (0, 1, 2, 5, 6, 7) OR text = '' THEN NULL ELSE length(text) END AS prompt_chars FROM r""",
)
def request_validation(spark, folder):
    # Bodies by shape: 0 cut off, 1 empty prompt, 2 no prompt, 3 no role, 5 numeric prompt, 6 none, 7 not an object.
    shape = F.expr(_SHAPE)
    prompt = F.when(shape == 1, "").when(shape != 2, F.col("text"))
    whole = F.to_json(
        F.struct(
            F.col("conv_id").cast("string").alias("user_id"),
            F.when(shape != 3, F.expr(TURN_ROLE)).alias("role"),
            F.when(shape != 5, prompt).alias("prompt"),
        )
    )
    body = (
        F.when(shape == 0, F.expr("left(_whole, length(_whole) - 2)"))
        .when(shape == 5, F.regexp_replace("_whole", r"\}$", ',"prompt":5}'))
        .when(shape == 6, None).when(shape == 7, "[1, 2]").otherwise(F.col("_whole"))
    )
    requests = table(spark, folder, "conversations").withColumn("_whole", whole).select("conv_id", "turn", body.alias("body"))
    parsed = gateway.parse_requests(requests)
    return parsed.select(
        "conv_id", "turn", "status", "error", "role", F.length("prompt").cast("bigint").alias("prompt_chars")
    )


@query(
    "ingress_outcome",
    T.sql_turns(f""", a AS (SELECT *, coalesce({TURN_ROLE}, 'unknown') AS who FROM hits WHERE role = 'user'),
      b AS (SELECT *, {_sql_action('who')} AS action FROM a)""") + """
    SELECT conv_id, turn, who AS role, action, CASE WHEN action = 'block' THEN 400 ELSE 200 END AS status,
      CASE WHEN action = 'block' THEN 'Prompt blocked by DLP policy.' END AS error,
      CASE WHEN action <> 'block' THEN text END AS forwarded_prompt,
      sha256(concat_ws('|', 'request', conv_id, turn)) AS decision_id FROM b""",
)
def ingress_outcome(spark, folder):
    prompts = turns(spark, folder).where("role = 'user'").select(
        "conv_id", "turn", F.coalesce(F.expr(TURN_ROLE), F.lit("unknown")).alias("role"), F.col("text").alias("prompt")
    )
    return gateway.ingress(prompts, "conv_id", "turn").select(
        "conv_id", "turn", "role", "action", "status", "error", "forwarded_prompt", "decision_id"
    )


@query(
    "egress_outcome",
    f"""WITH docs AS (SELECT conv_id, turn, coalesce({TURN_ROLE}, 'unknown') AS who,
        concat('[STUBBED ANSWER]\n\nContext:\n', text, {T.phrase_case('conv_id + turn')}, '\n\nPrompt:\nturn ', turn) AS text
        FROM conversations WHERE role = 'assistant'),
      hits AS (SELECT *, {T.SQL_HIT_COLUMNS} FROM docs),
      a AS (SELECT *, {_sql_action('who')} AS action FROM hits)
    SELECT conv_id, turn, action, CASE action WHEN 'block' THEN 'Response blocked by DLP policy.'
      WHEN 'mask' THEN '[PII REDACTED] ' || text ELSE text END AS safe_answer,
      sha256(concat_ws('|', 'response', conv_id, turn)) AS decision_id FROM a""",
)
def egress_outcome(spark, folder):
    answers = turns(spark, folder).where("role = 'assistant'").select(
        "conv_id", "turn", F.coalesce(F.expr(TURN_ROLE), F.lit("unknown")).alias("role"),
        D.stub_answer(F.col("text"), F.concat(F.lit("turn "), F.col("turn"))).alias("answer"),
    )
    return gateway.egress(answers, "conv_id", "turn").select("conv_id", "turn", "action", "safe_answer", "decision_id")


_RAW_HIGH = """CASE WHEN ssn IS NOT NULL THEN 'SSN' WHEN passport IS NOT NULL THEN 'PASSPORT' WHEN ssn_word THEN 'SSN' END"""
_GATE_FLOW = V.DEFAULT_FLOWS[1][0]


@query(
    "handle_ingress",
    T.sql_docs(f""", i AS (SELECT doc_id, {T.SQL_PII_LABEL} AS label, coalesce({DOC_ROLE}, 'anonymous') AS role, {_RAW_HIGH} AS high FROM hits),
      v AS (SELECT *, CASE WHEN high IS NOT NULL AND role <> 'admin' THEN 'block|high-risk PII (' || high || ') blocked for role ' || role END AS risky FROM i),
      w AS (SELECT doc_id, label,
        CASE WHEN label = 'restricted_pii' THEN 'block|data movement denied: flow {_GATE_FLOW} denied: {V.NOT_RESTRICTED}'
          WHEN risky IS NOT NULL THEN risky ELSE 'allow|classification allowed on ingress' END AS safe,
        coalesce(risky, 'allow|no policy matched') AS raw FROM v)""") + """
    SELECT doc_id, label, split_part(safe, '|', 1) AS action, split_part(safe, '|', 2) AS reason,
      split_part(raw, '|', 1) AS raw_action, split_part(raw, '|', 2) AS raw_reason FROM w""",
)
def handle_ingress(spark, folder):
    prompts = documents(spark, folder).select("doc_id", "text", F.expr(DOC_ROLE).alias("role"))
    safe = gateway.handle_ingress(prompts).select("doc_id", "text", "role", F.col("decision").alias("safe"))
    return gateway.handle_ingress(safe, normalise=False).select(
        "doc_id", "label", "safe.action", "safe.reason",
        F.col("decision.action").alias("raw_action"), F.col("decision.reason").alias("raw_reason"),
    )


@query(
    "handle_egress",
    T.sql_turns(f", i AS (SELECT conv_id, turn, {T.SQL_PII_LABEL} AS label FROM hits WHERE role = 'assistant')") + """
    SELECT conv_id, turn, label, 'block' AS action, 'data movement denied: no matching flow definition in policy' AS reason FROM i""",
)
def handle_egress(spark, folder):
    answers = turns(spark, folder).where("role = 'assistant'").select(
        "conv_id", "turn", "text", F.expr(TURN_ROLE).alias("role")
    )
    return gateway.handle_egress(answers).select("conv_id", "turn", "label", "decision.action", "decision.reason")

"""Data-movement queries: prompt chains, flow tables in both modes, requirements and cases."""

from __future__ import annotations

from pyspark.sql import functions as F

from sluice.functions import labels
from sluice.functions import movement as M
from sluice.operators import moves
from sluice.plans import fixed_values as V
from sluice.plans import triggers as T
from sluice.sources.readers import policy_refusal
from sluice.plans.registry import query, table
from sluice.plans.text_queries import SQL_STATE, scanned_documents

_HOPS = ", ".join(
    f"({i}, '{src}', '{dst}', '{flow[0]}')"
    for i, ((src, dst), flow) in enumerate(zip(V.PROMPT_HOPS, V.DEFAULT_FLOWS), start=1)
)


@query(
    "prompt_hops",
    T.sql_docs(f", states AS (SELECT doc_id, {SQL_STATE} AS state FROM hits)") + f"""
    SELECT doc_id, hop_no, src, dst, state = 'INTERNAL' AS allow,
      CASE WHEN state = 'INTERNAL' THEN 'flow ' || flow || ' allowed (conditions satisfied)'
        ELSE 'flow ' || flow || ' denied: {V.NOT_RESTRICTED}' END AS reason
    FROM states, (VALUES {_HOPS}) h(hop_no, src, dst, flow)""",
)
def prompt_hops(spark, folder):
    return moves.hop_rows(scanned_documents(spark, folder), "doc_id").withColumnsRenamed({"from": "src", "to": "dst"})


@query(
    "prompt_verdicts",
    T.sql_docs() + f"""
    SELECT doc_id, {T.SQL_LABEL} AS label, {SQL_STATE} <> 'INTERNAL' AS blocked FROM hits""",
)
def prompt_verdicts(spark, folder):
    return moves.prompt_verdicts(scanned_documents(spark, folder), "doc_id").select("doc_id", "label", "blocked")


# Nine node pairs and the flows between them: conditions, none, denied, unknown form, two for a pair.
PAIRS = [
    ("user", "dlp_gateway"), ("dlp_gateway", "rag_orchestrator"), ("rag_orchestrator", "pinecone"),
    ("rag_orchestrator", "llm"), ("llm", "dlp_gateway"), ("dlp_gateway", "user"),
    ("dlp_gateway", "evidence_s3"), ("pinecone", "rag_orchestrator"), ("user", "llm"),
]
MIXED_FLOWS = M.flow_list(
    [
        ("A", *PAIRS[0], True, [V.NOT_RESTRICTED, V.ALLOW_OR_MASK]),
        ("B1", *PAIRS[1], True, [" classification_label not_in [RESTRICTED_PHI] ", "policy_decision.action in [allow, mask]"]),
        ("B2", *PAIRS[1], True, ["redaction_applied == true"]),
        ("C", *PAIRS[2], True, [V.NOT_RESTRICTED, "redaction_applied == true"]),
        ("E", *PAIRS[4], True, None),
        ("F", *PAIRS[5], False, []),
        ("G", *PAIRS[6], False, ["policy_decision.action in [allow]"]),
        ("H", *PAIRS[7], True, ["region == eu"]),
    ]
)
MOVE_STATE = {
    "action": "CASE doc_id % 4 WHEN 0 THEN 'allow' WHEN 1 THEN 'mask' WHEN 2 THEN 'block' END",
    "redacted": "CASE doc_id % 3 WHEN 0 THEN true WHEN 1 THEN false END",
}
_PAIR_SRC = "CASE doc_id % 9 " + " ".join(f"WHEN {i} THEN '{p[0]}'" for i, p in enumerate(PAIRS)) + " END"
_PAIR_DST = "CASE doc_id % 9 " + " ".join(f"WHEN {i} THEN '{p[1]}'" for i, p in enumerate(PAIRS)) + " END"
_MOVES_SQL = T.sql_docs(
    f""", m AS (SELECT doc_id, {_PAIR_SRC} AS src, {_PAIR_DST} AS dst, doc_id % 9 AS p,
      CASE WHEN doc_id % 8 <> 7 THEN {SQL_STATE} END AS label,
      {MOVE_STATE['action']} AS action, {MOVE_STATE['redacted']} AS redacted FROM hits)"""
)


def document_moves(spark, folder):
    return scanned_documents(spark, folder).select(
        "doc_id", F.expr(_PAIR_SRC).alias("src"), F.expr(_PAIR_DST).alias("dst"),
        F.when(F.expr("doc_id % 8 <> 7"), labels.state_label_from_hits()).alias("label"),
        *[F.expr(text).alias(name) for name, text in MOVE_STATE.items()],
    )


_RESTRICTED = "('RESTRICTED_PII', 'RESTRICTED_PHI')"


@query(
    "hop_first_match",
    _MOVES_SQL + f""",
    d AS (SELECT doc_id, src, dst, p, coalesce(label, 'INTERNAL') AS l, coalesce(action, 'allow') AS a,
      coalesce(redacted, false) AS r FROM m),
    v AS (SELECT *, CASE p
      WHEN 0 THEN CASE WHEN l IN {_RESTRICTED} THEN 'flow A denied: {V.NOT_RESTRICTED}'
        WHEN a NOT IN ('allow', 'mask') THEN 'flow A denied: {V.ALLOW_OR_MASK}' ELSE 'flow A allowed (conditions satisfied)' END
      WHEN 1 THEN CASE WHEN l = 'RESTRICTED_PHI' THEN 'flow B1 denied: classification_label not_in [RESTRICTED_PHI]'
        WHEN a NOT IN ('allow', 'mask') THEN 'flow B1 denied: policy_decision.action in [allow, mask]'
        ELSE 'flow B1 allowed (conditions satisfied)' END
      WHEN 2 THEN CASE WHEN l IN {_RESTRICTED} THEN 'flow C denied: {V.NOT_RESTRICTED}'
        WHEN NOT r THEN 'flow C denied: redaction_applied == true' ELSE 'flow C allowed (conditions satisfied)' END
      WHEN 3 THEN 'rag_orchestrator → llm ' || CASE WHEN l NOT IN {_RESTRICTED} AND a IN ('allow', 'mask')
        THEN 'allowed' ELSE 'blocked due to label/action' END || ' (label=' || l || ', action=' || a || ')'
      WHEN 4 THEN 'flow E allowed (no additional conditions)'
      WHEN 5 THEN 'flow F explicitly denied (no additional conditions)'
      WHEN 6 THEN CASE WHEN a <> 'allow' THEN 'flow G denied: policy_decision.action in [allow]'
        ELSE 'flow G denied (allowed=false despite conditions passing)' END
      WHEN 7 THEN 'flow H allowed (conditions satisfied)'
      ELSE 'no matching flow definition in policy' END AS reason FROM d)
    SELECT doc_id, src, dst, contains(reason, ' allowed ') AS allow, reason FROM v""",
)
def hop_first_match(spark, folder):
    judged = moves.judge(document_moves(spark, folder), moves.flow_table(spark, MIXED_FLOWS))
    return judged.select("doc_id", "src", "dst", "allow", "reason")


@query(
    "hop_no_policy",
    _MOVES_SQL + f"""
    SELECT doc_id, src, dst, false AS allow, CASE doc_id % 9 WHEN 0 THEN '{V.POLICY_MISSING}' WHEN 1 THEN '{V.POLICY_UNREADABLE}'
      ELSE '{V.POLICY_NO_LIST.replace("'", "''")}' END AS reason FROM m""",
)
def hop_no_policy(spark, folder):
    """Every move is denied, that to the model too, where the policy text is missing, torn or of another form."""
    text = F.expr(
        """CASE doc_id % 9 WHEN 1 THEN '{"flows": [' WHEN 2 THEN '{"flows": 3}' WHEN 3 THEN '{"flows": null}' WHEN 4 THEN '[1]'
        WHEN 5 THEN '5' WHEN 6 THEN '{"flows":"[x"}' WHEN 7 THEN 'null' WHEN 8 THEN '{"flows": {"id": "A"}}' END"""
    )
    judged = moves.judge(document_moves(spark, folder), moves.flow_table(spark, MIXED_FLOWS), refusal=policy_refusal(text))
    return judged.select("doc_id", "src", "dst", "allow", "reason")


@query(
    "hop_any_mode",
    _MOVES_SQL + f""",
    c AS (SELECT *, coalesce(label IN {_RESTRICTED}, false) AS restricted, coalesce(action IN ('allow', 'mask'), false) AS acts,
      coalesce(redacted, false) AS r FROM m),
    v AS (SELECT doc_id, src, dst,
      CASE p WHEN 0 THEN NOT restricted AND acts
        WHEN 1 THEN acts OR r
        WHEN 2 THEN NOT restricted AND r WHEN 3 THEN NOT restricted AND acts WHEN 7 THEN true ELSE false END AS allow,
      CASE p
        WHEN 0 THEN CASE WHEN restricted THEN 'flow A denied: {V.NOT_RESTRICTED}'
          WHEN NOT acts THEN 'flow A denied: {V.ALLOW_OR_MASK}' ELSE 'flow A allowed' END
        WHEN 1 THEN CASE WHEN acts THEN 'flow B1 allowed'
          WHEN r THEN 'flow B2 allowed'
          ELSE 'flow B1 denied: policy_decision.action in [allow, mask]' END
        WHEN 2 THEN CASE WHEN restricted THEN 'flow C denied: {V.NOT_RESTRICTED}'
          WHEN NOT r THEN 'flow C denied: redaction_applied == true' ELSE 'flow C allowed' END
        WHEN 3 THEN CASE WHEN NOT restricted AND acts AND label IS NOT NULL
          THEN 'rag_orchestrator → llm allowed (label=' || label || ', action=' || action || ')' ELSE 'no matching flow' END
        WHEN 6 THEN CASE WHEN coalesce(action <> 'allow', true) THEN 'flow G denied: policy_decision.action in [allow]'
          ELSE 'no matching flow' END
        WHEN 7 THEN 'flow H allowed' ELSE 'no matching flow' END AS reason FROM c)
    SELECT doc_id, src, dst, allow, reason FROM v""",
)
def hop_any_mode(spark, folder):
    judged = moves.judge(document_moves(spark, folder), moves.flow_table(spark, MIXED_FLOWS), mode="any")
    return judged.select("doc_id", "src", "dst", "allow", "reason")


_DONE = [("classification", "doc_id % 2 = 0"), ("policy_eval", "doc_id % 3 = 0"), ("outbound_scan", "doc_id % 5 = 0"),
         ("kms_encryption", "doc_id % 2 = 1"), ("immutable_logging", "doc_id % 3 = 1")]
_NEEDS = " ".join(
    f"WHEN {i} THEN [{', '.join(repr(c) for c in f.requires)}]" for i, f in enumerate(M.FULL_FLOWS) if f.requires
)


@query(
    "flow_requires",
    f"""WITH s AS (SELECT doc_id, CASE doc_id % 7 {' '.join(f"WHEN {i} THEN '{f.id}'" for i, f in enumerate(M.FULL_FLOWS))} END AS flow_id,
      CASE doc_id % 7 {_NEEDS} ELSE [] END AS needs,
      [{', '.join(f"CASE WHEN {test} THEN '{name}' ELSE '' END" for name, test in _DONE)}] AS done FROM documents),
      g AS (SELECT doc_id, flow_id, list_filter(needs, lambda n: NOT list_contains(done, n)) AS gap FROM s)
    SELECT doc_id, flow_id, len(gap) = 0 AS met, array_to_string(gap, ',') AS missing FROM g""",
)
def flow_requires(spark, folder):
    flows = M.FULL_FLOWS
    src = "CASE doc_id % 7 " + " ".join(f"WHEN {i} THEN '{f.src}'" for i, f in enumerate(flows)) + " END"
    dst = "CASE doc_id % 7 " + " ".join(f"WHEN {i} THEN '{f.dst}'" for i, f in enumerate(flows)) + " END"
    done = F.array(*[F.when(F.expr(test), name).otherwise("") for name, test in _DONE])
    planned = table(spark, folder, "documents").select(
        "doc_id", F.expr(src).alias("src"), F.expr(dst).alias("dst"), done.alias("done")
    )
    checked = moves.with_requirements(planned, moves.flow_table(spark, flows))
    return checked.select("doc_id", "flow_id", "met", F.array_join("missing", ",").alias("missing"))


@query(
    "unapproved_flows",
    """SELECT event_id, 'Unapproved data flow detected' AS message FROM events
    WHERE coalesce(CASE WHEN event_type = 'error' THEN NULL ELSE value < 20 END, false) = false""",
)
def unapproved_flows(spark, folder):
    flows = table(spark, folder, "events").select(
        "event_id", F.when(F.col("event_type") != "error", F.col("value") < 20).alias("allowed")
    )
    return moves.unapproved(flows).select("event_id", F.lit(V.MSG_FLOW).alias("message"))


@query(
    "combined_approval",
    """SELECT user_id, coalesce(bool_or(CASE WHEN event_type = 'error' THEN NULL ELSE value > 40 END), false) AS approved
    FROM events GROUP BY 1""",
)
def combined_approval(spark, folder):
    decisions = table(spark, folder, "events").select(
        "user_id", F.when(F.col("event_type") != "error", F.col("value") > 40).alias("allow")
    )
    return moves.any_approval(decisions, "user_id")


_CASE_DST = "CASE WHEN doc_id % 3 = 0 THEN 'llm' ELSE 'pinecone' END"


@query(
    "flow_cases",
    T.sql_docs(f", states AS (SELECT doc_id, {_CASE_DST} AS dst, {SQL_STATE} AS label FROM hits)") + """
    SELECT doc_id, label = 'INTERNAL' AS allow, (label = 'INTERNAL') = (doc_id % 2 = 0) AS passed,
      label <> 'INTERNAL' AND dst = 'pinecone' AS reason_found FROM states""",
)
def flow_cases(spark, folder):
    cases = scanned_documents(spark, folder).select(
        "doc_id", F.lit("rag_orchestrator").alias("src"), F.expr(_CASE_DST).alias("dst"),
        labels.state_label_from_hits().alias("label"),
        F.lit("allow").alias("action"), F.lit(False).alias("redacted"),
        F.expr("doc_id % 2 = 0").alias("expected"), F.lit("denied").alias("reason_contains"),
    )
    checked = moves.check_cases(cases, moves.flow_table(spark, M.DEFAULT_FLOWS))
    return checked.select("doc_id", "allow", "passed", "reason_found")

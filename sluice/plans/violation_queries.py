"""Rule-pack queries over prompts, model output, logs and evidence."""

from __future__ import annotations

from pyspark.sql import functions as F

from sluice.functions import detect, labels
from sluice.functions.rows import explode_found
from sluice.operators import violations as R
from sluice.operators.tables import fixed_table
from sluice.plans import fixed_values as V
from sluice.plans import triggers as T
from sluice.plans.registry import query, table
from sluice.plans.text_queries import EVENT_TYPE, documents, scanned_documents, turns
from sluice.sources import sinks

_SSN_MSG, _MRN_MSG = V.MSG_SSN_INPUT, V.MSG_MRN_INPUT


@query(
    "input_violations",
    T.sql_docs() + f"""
    SELECT doc_id, '{_SSN_MSG}' AS message FROM hits WHERE ssn IS NOT NULL
    UNION ALL SELECT doc_id, '{_MRN_MSG}' FROM hits WHERE mrn""",
)
def input_violations(spark, folder):
    found = detect.detect_entities(documents(spark, folder).select("doc_id", "text"))
    types = labels.entity_types(F.col("entities"))
    return explode_found(found, "doc_id", array=R.input_messages(types), alias="message")


@query(
    "input_allowed",
    T.sql_docs() + """
    SELECT doc_id, ssn IS NULL AND NOT mrn AS allow FROM hits""",
)
def input_allowed(spark, folder):
    found = detect.detect_entities(documents(spark, folder).select("doc_id", "text"))
    types = labels.entity_types(F.col("entities"))
    return found.select("doc_id", (F.size(R.input_messages(types)) == 0).alias("allow"))


@query(
    "quarantine_zone",
    T.sql_docs() + f"""
    SELECT doc_id, CASE WHEN {T.SQL_LABEL} = 'restricted_pii' THEN 'quarantine' ELSE 'open' END AS zone FROM hits""",
)
def quarantine_zone(spark, folder):
    return scanned_documents(spark, folder).select("doc_id", sinks.zone_of(labels.state_label_from_hits()).alias("zone"))


ACL = [("purchase", "professional"), ("click", "member"), ("view", "member"), ("signup", "admin")]
_EVENT_ROLE = "CASE user_id % 3 WHEN 0 THEN 'member' WHEN 1 THEN 'professional' ELSE 'admin' END"


@query(
    "rag_acl",
    f"""WITH e AS (SELECT event_id, event_type AS record_type, {_EVENT_ROLE} AS role FROM events)
    SELECT event_id, record_type, e.role FROM e
    JOIN (VALUES {', '.join(str(r) for r in ACL)}) acl(record_type, role) USING (record_type, role)""",
)
def rag_acl(spark, folder):
    asked = table(spark, folder, "events").select(
        "event_id", F.col("event_type").alias("record_type"), F.expr(_EVENT_ROLE).alias("role")
    )
    return R.acl_allowed(asked, fixed_table(spark, ACL, "record_type string, role string"))


def event_logs(spark, folder, *more):
    """Log records as VARIANT: some fields absent, some false, some JSON null."""
    body = F.concat(
        F.lit('{"timestamp":"'), F.date_format("ts", "yyyy-MM-dd"), F.lit('"'),
        F.when(F.expr("event_id % 4 <> 1"), F.concat(F.lit(',"user":'), F.col("user_id"))).otherwise(""),
        F.concat(F.lit(',"action":"'), F.col("event_type"), F.lit('"')),
        F.when(F.expr("event_id % 5 = 0"), ',"decision":false').when(F.expr("event_id % 5 = 1"), ',"decision":null')
        .when(F.expr("event_id % 5 = 2"), "").otherwise(',"decision":"allow"'),
        F.when(F.expr("event_id % 3 = 0"), "").otherwise(',"classification":"INTERNAL"'),
        F.lit("}"),
    )
    return table(spark, folder, "events").select("event_id", F.try_parse_json(body).alias("log"), *more)


_LOG_SQL = """SELECT event_id, 'user' AS field FROM events WHERE event_id % 4 = 1
    UNION ALL SELECT event_id, 'decision' FROM events WHERE event_id % 5 IN (0, 2)
    UNION ALL SELECT event_id, 'classification' FROM events WHERE event_id % 3 = 0"""


@query("log_completeness", _LOG_SQL)
def log_completeness(spark, folder):
    return explode_found(
        event_logs(spark, folder), "event_id", array=R.missing_fields(F.col("log")), alias="field"
    )


_EVIDENCE_SQL = f"""SELECT event_id, 'Missing evidence field' AS message FROM events
    WHERE event_id % {len(V.EVIDENCE_FIELDS) + 3} < {len(V.EVIDENCE_FIELDS) + 1}"""


def evidence_text():
    """Evidence records as JSON: one of the required fields lacks or is false; all there, or null, else."""
    fields, kinds = V.EVIDENCE_FIELDS, len(V.EVIDENCE_FIELDS) + 3
    parts = []
    for n, name in enumerate(fields):
        # Kind n lacks field n; in the next kind the first field is false, in the one after it is null.
        value = F.when(F.expr(f"event_id % {kinds} = {len(fields) + n}"), "false").when(
            F.expr(f"event_id % {kinds} = {len(fields) + 1}"), "null"
        ).otherwise('"x"')
        parts.append(F.when(F.expr(f"event_id % {kinds} <> {n}"), F.concat(F.lit(f'"{name}":'), value if n == 0 else F.lit('"x"'))))
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))


@query("evidence_completeness", _EVIDENCE_SQL)
def evidence_completeness(spark, folder):
    records = table(spark, folder, "events").select("event_id", F.try_parse_json(evidence_text()).alias("log"))
    return explode_found(records, "event_id", array=R.evidence_messages(F.col("log")), alias="message")


@query(
    "event_pack_violations",
    f"""SELECT event_id, 'logging' AS pack, field AS message FROM ({_LOG_SQL})
    UNION ALL SELECT event_id, 'evidence', message FROM ({_EVIDENCE_SQL})
    UNION ALL SELECT event_id, 'data_movement', '{V.MSG_FLOW}' FROM events
      WHERE NOT coalesce(CASE WHEN event_type <> 'error' THEN value < 20 END, false)
    UNION ALL SELECT event_id, 'classification', '{V.MSG_TOKEN}' FROM (SELECT event_id, {EVENT_TYPE} AS kind FROM events)
      WHERE kind IS NULL OR kind NOT IN ({', '.join(f"'{t}'" for t in V.CATALOG_TAXONOMY)})""",
)
def event_pack_violations(spark, folder):
    """The packs over logs, evidence, flows and tokens in one pass over the records."""
    records = event_logs(
        spark, folder, F.try_parse_json(evidence_text()).alias("evidence"), F.expr(EVENT_TYPE).alias("kind"),
        F.when(F.col("event_type") != "error", F.col("value") < 20).alias("allowed"),
    )
    known = F.coalesce(F.col("kind").isin(*V.CATALOG_TAXONOMY), F.lit(False))
    packs = {
        "logging": R.missing_fields(F.col("log")),
        "evidence": R.evidence_messages(F.col("evidence")),
        "data_movement": R.messages((~F.coalesce("allowed", F.lit(False)), V.MSG_FLOW)),
        "classification": R.messages((~known, V.MSG_TOKEN)),
    }
    return R.long_report(records, "event_id", packs=packs)


_AGENT_ACTION = "CASE WHEN event_type IN ('purchase', 'signup') THEN 'api_call' ELSE event_type END"
_ALLOW_API = "CASE user_id % 3 WHEN 0 THEN true WHEN 1 THEN false END"


@query(
    "agent_actions",
    f"""SELECT event_id, 'Unauthorized agentic action' AS message FROM events
    WHERE ({_AGENT_ACTION}) = 'api_call' AND NOT coalesce({_ALLOW_API}, false)""",
)
def agent_actions(spark, folder):
    acts = table(spark, folder, "events")
    found = R.agent_messages(F.expr(_AGENT_ACTION), F.expr(_ALLOW_API))
    return explode_found(acts, "event_id", array=found, alias="message")


TRUSTED = [(f"src{i}",) for i in range(8)]
_TRUSTED_SQL = ", ".join(f"'{s[0]}'" for s in TRUSTED)


@query(
    "training_sources",
    f"""SELECT doc_id, source, 'Untrusted data source' AS message FROM documents
    WHERE source IS NULL OR source NOT IN ({_TRUSTED_SQL})""",
)
def training_sources(spark, folder):
    rows = table(spark, folder, "documents").select("doc_id", "source")
    return R.untrusted_sources(rows, fixed_table(spark, TRUSTED, "source string")).withColumn(
        "message", F.lit(V.MSG_SOURCE)
    )


@query(
    "pack_violations",
    T.sql_turns() + f""",
    p(phrase) AS (VALUES {', '.join(f"('{p}')" for p in V.INJECTION_PHRASES)})
    SELECT conv_id, turn, 'input' AS pack, '{_SSN_MSG}' AS message FROM hits WHERE role = 'user' AND ssn IS NOT NULL
    UNION ALL SELECT conv_id, turn, 'input', '{_MRN_MSG}' FROM hits WHERE role = 'user' AND mrn
    UNION ALL SELECT conv_id, turn, 'prompt_injection', '{V.MSG_INJECTION}' || phrase FROM hits, p
      WHERE role = 'user' AND contains(lower(text), phrase)
    UNION ALL SELECT conv_id, turn, 'output', '{V.MSG_OUTPUT_LEAK}' FROM hits
      WHERE role = 'assistant' AND regexp_matches(text, '{T.SQL_SSN_LOOSE}')
    UNION ALL SELECT conv_id, turn, 'behavior', '{V.MSG_DIAGNOSIS}' FROM hits
      WHERE role = 'assistant' AND contains(lower(text), 'diagnose')
    UNION ALL SELECT conv_id, turn, 'agentic', '{V.MSG_AGENT}' FROM hits
      WHERE role = 'system' AND conv_id % 2 = 0
    UNION ALL SELECT conv_id, turn, 'training', '{V.MSG_SOURCE}' FROM hits WHERE role NOT IN ('user', 'assistant')""",
)
def pack_violations(spark, folder):
    text, role = F.col("text"), F.col("role")
    scanned = detect.with_hits(turns(spark, folder))
    user, model = role == "user", role == "assistant"
    packs = {
        "input": R.messages(
            (user & F.col("hit_ssn").isNotNull(), _SSN_MSG), (user & F.col("hit_mrn"), _MRN_MSG)
        ),
        "prompt_injection": F.transform(
            F.when(user, detect.injection_phrases(text)).otherwise(F.array().cast("array<string>")),
            lambda phrase: F.concat(F.lit(V.MSG_INJECTION), phrase),
        ),
        "output": R.messages((model & detect.leaks_ssn(text), V.MSG_OUTPUT_LEAK)),
        "behavior": R.messages((model & detect.unapproved_diagnosis(text, F.lit(None).cast("boolean")), V.MSG_DIAGNOSIS)),
        "agentic": R.agent_messages(
            F.when(role == "system", "api_call"), F.when(F.expr("conv_id % 2 = 1"), True)
        ),
        "training": R.messages((~role.isin("user", "assistant"), V.MSG_SOURCE)),
    }
    return R.long_report(scanned, "conv_id", "turn", packs=packs)

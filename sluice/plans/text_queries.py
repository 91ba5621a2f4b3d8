"""Detection, masking and classification queries over documents and conversations."""

from __future__ import annotations

from pyspark.sql import functions as F

from sluice.functions import detect, labels, masking
from sluice.functions import patterns as P
from sluice.functions.rows import explode_found
from sluice.operators import taxonomy
from sluice.plans import fixed_values as V
from sluice.plans import triggers as T
from sluice.plans.registry import query, table


def documents(spark, folder):
    return T.with_phrases(table(spark, folder, "documents"), "doc_id")


def turns(spark, folder):
    return T.with_phrases(table(spark, folder, "conversations"), "conv_id + turn")


def scanned_documents(spark, folder):
    return detect.with_hits(documents(spark, folder))


@query(
    "entities_long",
    T.sql_docs() + """
    SELECT doc_id, type, value, score FROM (
      SELECT doc_id, 'SSN' AS type, ssn AS value, 0.99::DOUBLE AS score FROM hits WHERE ssn IS NOT NULL
      UNION ALL SELECT doc_id, 'ROUTING', routing, 0.98 FROM hits WHERE routing IS NOT NULL
      UNION ALL SELECT doc_id, 'PASSPORT', passport, 0.97 FROM hits WHERE passport IS NOT NULL
      UNION ALL SELECT doc_id, 'MRN', 'unknown', 0.99 FROM hits WHERE mrn
      UNION ALL SELECT doc_id, 'PHI_HINT', 'medical_context', 0.9 FROM hits WHERE phi)""",
)
def entities_long(spark, folder):
    found = detect.detect_entities(documents(spark, folder).select("doc_id", "text"))
    return detect.explode_entities(found, "doc_id").select("doc_id", "type", "value", "score")


@query(
    "pii_findings",
    T.sql_docs() + """
    SELECT doc_id, type, value, score FROM (
      SELECT doc_id, 'SSN' AS type, ssn AS value, 0.99::DOUBLE AS score FROM hits WHERE ssn IS NOT NULL
      UNION ALL SELECT doc_id, 'ROUTING', routing, 0.98 FROM hits WHERE routing IS NOT NULL
      UNION ALL SELECT doc_id, 'PASSPORT', passport, 0.97 FROM hits WHERE passport IS NOT NULL
      UNION ALL SELECT doc_id, 'SSN', 'SSN', 0.9 FROM hits WHERE ssn IS NULL AND ssn_word)""",
)
def pii_findings(spark, folder):
    found = detect.detect_pii(documents(spark, folder).select("doc_id", "text"))
    return detect.explode_entities(found, "doc_id").select("doc_id", "type", "value", "score")


@query(
    "alt_entities",
    T.sql_docs() + f"""
    SELECT doc_id, type, score FROM (
      SELECT doc_id, 'SSN' AS type, 0.99::DOUBLE AS score FROM hits WHERE ssn IS NOT NULL
      UNION ALL SELECT doc_id, 'MRN', 0.95 FROM docs WHERE regexp_matches(text, '{T.SQL_MRN_SPACED}')
      UNION ALL SELECT doc_id, 'ADDRESS', 0.9 FROM docs WHERE regexp_matches(text, '{T.SQL_ADDRESS}'))""",
)
def alt_entities(spark, folder):
    found = detect.detect_alternate(documents(spark, folder).select("doc_id", "text"))
    return detect.explode_entities(found, "doc_id").select("doc_id", "type", "score")


@query(
    "spare_detectors",
    T.sql_docs() + f"""
    SELECT doc_id, ssn IS NOT NULL AS spare_ssn,
      regexp_matches(text, '{T.SQL_NINE}') AS spare_routing,
      regexp_matches(text, '{T.SQL_MRN_PUNCT}') AS spare_mrn
    FROM hits""",
)
def spare_detectors(spark, folder):
    return detect.with_spare_flags(documents(spark, folder)).select(
        "doc_id", "spare_ssn", "spare_routing", "spare_mrn"
    )


@query(
    "injection_hits",
    T.sql_turns() + """
    SELECT conv_id, turn, concat('Prompt injection attempt detected: ', phrase) AS message
    FROM docs, (VALUES ('ignore previous instructions'), ('override system'), ('jailbreak'),
      ('forget rules'), ('act as')) p(phrase)
    WHERE role = 'user' AND contains(lower(text), phrase)""",
)
def injection_hits(spark, folder):
    prompts = turns(spark, folder).where("role = 'user'")
    found = explode_found(
        prompts, "conv_id", "turn", array=detect.injection_phrases(F.col("text")), alias="phrase"
    )
    return found.select("conv_id", "turn", F.concat(F.lit(V.MSG_INJECTION), "phrase").alias("message"))


@query(
    "output_leaks",
    T.sql_turns() + f"""
    SELECT conv_id, turn, message FROM (
      SELECT conv_id, turn, role, 'Sensitive data leaked in LLM output' AS message FROM docs
      WHERE regexp_matches(text, '{T.SQL_SSN_LOOSE}')
      UNION ALL SELECT conv_id, turn, role, 'Unapproved medical diagnosis' FROM docs
      WHERE contains(lower(text), 'diagnose') AND NOT coalesce(
        CASE conv_id % 3 WHEN 0 THEN true WHEN 1 THEN false END, false))
    WHERE role = 'assistant'""",
)
def output_leaks(spark, folder):
    answers = turns(spark, folder).where("role = 'assistant'")
    approved = F.expr("CASE conv_id % 3 WHEN 0 THEN true WHEN 1 THEN false END")
    found = F.concat(
        F.when(detect.leaks_ssn(F.col("text")), F.array(F.lit(V.MSG_OUTPUT_LEAK)))
        .otherwise(F.array().cast("array<string>")),
        F.when(detect.unapproved_diagnosis(F.col("text"), approved), F.array(F.lit(V.MSG_DIAGNOSIS)))
        .otherwise(F.array().cast("array<string>")),
    )
    return explode_found(answers, "conv_id", "turn", array=found, alias="message")


SQL_MASKED = rf"""
    chained AS (SELECT *,
      regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text,
        '(^|{T.NOT_WORD})\p{{Nd}}{{3}}-\p{{Nd}}{{2}}-\p{{Nd}}{{4}}({T.NOT_WORD}|$)', '\1[SSN]\2', 'g'),
        '(^|{T.NOT_WORD})\p{{Nd}}{{3}}-\p{{Nd}}{{2}}-\p{{Nd}}{{4}}({T.NOT_WORD}|$)', '\1[SSN]\2', 'g'),
        '((?i:routing (number )?))\p{{Nd}}{{9}}', '\1[ROUTING]', 'g'),
        '({T.PASSPORT_WORD}[^\n]*?[^\p{{L}}\p{{N}}_\n])[A-Za-z]*[0-9][A-Za-z0-9]*', '\1[PASSPORT]', 'g'),
        '((^|{T.NOT_WORD})(?i:mrn)(:|{T.SPACE})*)\p{{Nd}}+', '\1[MRN]', 'g') AS chain
      FROM docs),
    masked AS (SELECT doc_id, text,
      CASE WHEN regexp_matches(regexp_extract(text, '{T.SQL_PASSPORT}', 1), '^[^0-9]+$')
        THEN regexp_replace(chain, '({T.PASSPORT_WORD}[^\n]*?[^\p{{L}}\p{{N}}_\n])[A-Za-z0-9]{{6,10}}({T.NOT_WORD}|$)', '\1[PASSPORT]\2')
        ELSE chain END AS masked_text
      FROM chained)"""


@query(
    "masked_text",
    T.sql_docs("," + SQL_MASKED) + """
    SELECT doc_id, masked_text, masked_text <> text AS redaction_applied FROM masked""",
)
def masked_text(spark, folder):
    masked = masking.with_masked(documents(spark, folder))
    return masked.select(
        "doc_id", "masked_text", (F.col("masked_text") != F.col("text")).alias("redaction_applied")
    )


@query(
    "masked_spares",
    T.sql_docs("," + SQL_MASKED) + rf"""
    SELECT doc_id, regexp_replace(regexp_replace(masked_text, '({T.START})\p{{Nd}}+{T.SPACE}+{T.WORD}+{T.SPACE}+((?i:blvd|ave|rd|dr)|[Ssſ][Tt]|[Dd][Rr][Iiİı][Vv][Ee])({T.END})',
      '\1[ADDRESS]\3', 'g'), '({T.START})\p{{Nd}}{{9}}({T.END})', '\1[ROUTING]\2', 'g') AS masked_text FROM masked""",
)
def masked_spares(spark, folder):
    """Masking with the detectors that no rule uses as well: street addresses and bare words of nine digits."""
    masked = masking.with_masked(documents(spark, folder), detectors=P.SPANS + P.SPARE_SPANS)
    return masked.select("doc_id", "masked_text")


@query(
    "unmasked_values",
    T.sql_docs() + """
    SELECT u.type, u.n AS n_detected, 0::BIGINT AS n_left FROM (
      SELECT count(ssn) AS s, count(routing) AS r, count(passport) AS p, count(*) FILTER (mrn AND regexp_matches(text, '""" + T.SQL_MRN_PUNCT + """')) AS m FROM hits),
      LATERAL (SELECT unnest(['SSN', 'ROUTING', 'PASSPORT', 'MRN']) AS type, unnest([s, r, p, m]) AS n) u""",
)
def unmasked_values(spark, folder):
    """How many documents hold a value of each type, and in how many it is still found once they are masked."""
    kinds = ["SSN", "ROUTING", "PASSPORT", "MRN"]

    def with_values(df, text, out):
        scanned = detect.with_spare_flags(detect.with_hits(df, text), text)
        found = F.array("hit_ssn", "hit_routing", "hit_passport", F.when(F.col("spare_mrn"), "number"))
        return detect.drop_hits(scanned.withColumn(out, found)).drop("spare_ssn", "spare_routing", "spare_mrn")

    masked = masking.with_masked(documents(spark, folder).select("text"))
    rows = with_values(with_values(masked, "text", "before"), "masked_text", "after")
    rows = rows.select("after", F.posexplode("before").alias("k", "value"))
    left = F.get("after", F.col("k"))  # the mask itself reads like a passport's value
    return rows.groupBy(F.get(F.array(*map(F.lit, kinds)), F.col("k")).alias("type")).agg(
        F.count("value").alias("n_detected"), F.count_if(left.isNotNull() & ~left.isin(*kinds)).alias("n_left")
    )


@query(
    "evidence_previews",
    T.sql_docs("," + SQL_MASKED) + """
    SELECT doc_id, left(masked_text, 200) AS preview FROM masked""",
)
def evidence_previews(spark, folder):
    masked = masking.with_masked(documents(spark, folder))
    return masked.select("doc_id", masking.safe_preview(F.col("masked_text")).alias("preview"))


_PHRASES_SQL = r"""p AS (SELECT DISTINCT lower(array_to_string(string_split_regex(trim(text), '\s+')[1:3], ' ')) AS phrase FROM benchmark
      UNION SELECT DISTINCT left(lower(array_to_string(string_split_regex(trim(text), '\s+')[2:3], ' ')), 4) FROM benchmark WHERE item_id % 9 = 0)"""


@query(
    "phrase_table_hits",
    f"WITH {_PHRASES_SQL} SELECT DISTINCT doc_id, phrase FROM documents, p WHERE contains(lower(text), phrase)",
)
def phrase_table_hits(spark, folder):
    """Phrases of a table, the beginnings of the benchmark's items and some short ones, in whole documents."""
    words = F.split(F.trim("text"), r"\s+")
    items = table(spark, folder, "benchmark").select("item_id", F.array_join(F.slice(words, 1, 3), " ").alias("a"), F.array_join(F.slice(words, 2, 2), " ").alias("b"))
    phrases = items.select(F.lower("a").alias("phrase")).union(items.where("item_id % 9 = 0").select(F.left(F.lower("b"), F.lit(4))))
    return detect.phrase_hits(table(spark, folder, "documents"), phrases, "doc_id")


@query(
    "label_counts",
    T.sql_docs() + f"""
    SELECT {T.SQL_LABEL} AS label, lang, count(*) AS n FROM hits GROUP BY 1, 2""",
)
def label_counts(spark, folder):
    labelled = scanned_documents(spark, folder).select("lang", labels.label_from_hits().alias("label"))
    return taxonomy.rollup(labelled, "label", "lang")


@query(
    "type_counts",
    T.sql_docs() + """
    SELECT source, type, count(*) AS n FROM (
      SELECT source, unnest(list_filter([
        CASE WHEN ssn IS NOT NULL THEN 'SSN' END, CASE WHEN routing IS NOT NULL THEN 'ROUTING' END,
        CASE WHEN passport IS NOT NULL THEN 'PASSPORT' END, CASE WHEN mrn THEN 'MRN' END,
        CASE WHEN phi THEN 'PHI_HINT' END], lambda x: x IS NOT NULL)) AS type FROM hits)
    GROUP BY 1, 2""",
)
def type_counts(spark, folder):
    found = detect.detect_entities(documents(spark, folder).select("source", "text"))
    return taxonomy.rollup(detect.explode_entities(found, "source"), "source", "type")


@query(
    "entity_labels",
    T.sql_docs() + f"""
    SELECT doc_id, {T.SQL_LABEL} AS label, {T.SQL_PII_LABEL} AS pii_label FROM hits""",
)
def entity_labels(spark, folder):
    scanned = scanned_documents(spark, folder)
    typed = scanned.select(
        "doc_id",
        F.transform(detect.entities()["type"], F.lower).alias("types"),
        labels.label_from_pii_hits().alias("pii_label"),
    )
    return typed.select("doc_id", labels.label_from_types(F.col("types")).alias("label"), "pii_label")


SQL_STATE = f"""CASE {T.SQL_LABEL} WHEN 'phi' THEN 'RESTRICTED_PHI'
    WHEN 'restricted_pii' THEN 'RESTRICTED_PII' ELSE 'INTERNAL' END"""


@query(
    "label_states",
    T.sql_docs(f""", raw AS (SELECT doc_id, CASE doc_id % 7 WHEN 0 THEN NULL WHEN 1 THEN ' PII '
        WHEN 2 THEN 'Confidential' WHEN 3 THEN 'Restricted_PHI' ELSE {T.SQL_LABEL} END AS label FROM hits),
      norm AS (SELECT doc_id, label, CASE lower(trim(coalesce(label, '')))
        WHEN 'pii' THEN 'RESTRICTED_PII' WHEN 'restricted_pii' THEN 'RESTRICTED_PII'
        WHEN 'phi' THEN 'RESTRICTED_PHI' WHEN 'restricted_phi' THEN 'RESTRICTED_PHI'
        ELSE 'INTERNAL' END AS state_label FROM raw)""")
    + """
    SELECT doc_id, label, state_label,
      CASE WHEN state_label LIKE 'RESTRICTED%' THEN 'block' ELSE 'allow' END AS default_action FROM norm""",
)
def label_states(spark, folder):
    raw = scanned_documents(spark, folder).select(
        "doc_id",
        F.when(F.expr("doc_id % 7 = 0"), None)
        .when(F.expr("doc_id % 7 = 1"), " PII ")
        .when(F.expr("doc_id % 7 = 2"), "Confidential")
        .when(F.expr("doc_id % 7 = 3"), "Restricted_PHI")
        .otherwise(labels.label_from_hits()).alias("label"),
    )
    return raw.withColumn("state_label", labels.normalise_label(F.col("label"))).withColumn(
        "default_action", labels.default_action(F.col("state_label"))
    )


# Findings of an outside scanner, one per event; a few types no taxonomy knows.
EVENT_TYPE = """CASE user_id % 17 WHEN 0 THEN 'MRN' WHEN 1 THEN 'SSN' WHEN 2 THEN 'EMAIL_ADDRESS'
  WHEN 3 THEN 'IP_ADDRESS' WHEN 4 THEN 'DOB' WHEN 5 THEN 'EMAIL' WHEN 6 THEN 'ICD10'
  WHEN 7 THEN 'ADDRESS' WHEN 8 THEN 'NICKNAME' WHEN 9 THEN 'DL' WHEN 10 THEN 'PHONE_NUMBER'
  WHEN 11 THEN 'ICD10_CODE' WHEN 12 THEN 'CREDIT_CARD' ELSE NULL END"""
FINDING_SUBJECT = "event_id // 3"


def findings(spark, folder):
    return table(spark, folder, "events").select(
        F.expr("event_id div 3").alias("subject_id"), F.expr(EVENT_TYPE).alias("entity_type")
    )


def _sql_rows(mapping: dict[str, str], priority: list[str]) -> str:
    return ", ".join(f"('{t}', '{label}', {priority.index(label)})" for t, label in mapping.items())


def _sql_by_taxonomy(mapping, priority, fallback):
    ranks = " ".join(f"WHEN {i} THEN '{label}'" for i, label in enumerate(priority))
    return f"""WITH found AS (SELECT {FINDING_SUBJECT} AS subject_id, {EVENT_TYPE} AS entity_type FROM events),
      tax(entity_type, label, rank) AS (VALUES {_sql_rows(mapping, priority)})
    SELECT subject_id, CASE WHEN best IS NOT NULL THEN CASE best {ranks} END
      WHEN n_types = 0 THEN 'INTERNAL' ELSE '{fallback}' END AS label
    FROM (SELECT subject_id, min(rank) AS best, count(f.entity_type) AS n_types
      FROM found f LEFT JOIN tax USING (entity_type) GROUP BY 1)"""


@query("policy_labels", _sql_by_taxonomy(V.POLICY_TAXONOMY, V.POLICY_PRIORITY, "INTERNAL"))
def policy_labels(spark, folder):
    tax = taxonomy.taxonomy_table(spark, V.POLICY_TAXONOMY, V.POLICY_PRIORITY)
    return taxonomy.label_findings(findings(spark, folder), tax, "subject_id")


@query("legacy_labels", _sql_by_taxonomy(V.LEGACY_TAXONOMY, V.LEGACY_PRIORITY, "INTERNAL"))
def legacy_labels(spark, folder):
    tax = taxonomy.taxonomy_table(spark, V.LEGACY_TAXONOMY, V.LEGACY_PRIORITY)
    return taxonomy.label_findings(findings(spark, folder), tax, "subject_id")


@query("catalog_labels", _sql_by_taxonomy(V.CATALOG_TAXONOMY, V.CATALOG_PRIORITY, "PUBLIC"))
def catalog_labels(spark, folder):
    tax = taxonomy.taxonomy_table(spark, V.CATALOG_TAXONOMY, V.CATALOG_PRIORITY)
    return taxonomy.label_findings(
        findings(spark, folder), tax, "subject_id",
        no_entities=V.CATALOG_NO_ENTITIES, fallback=V.CATALOG_FALLBACK,
    )


def _sql_case_label(column: str, mapping, priority) -> str:
    arms = []
    for label in priority:
        types = [t for t, mapped in mapping.items() if mapped == label]
        if types:
            listed = ", ".join(f"'{t}'" for t in types)
            arms.append(f"WHEN len(list_intersect({column}, [{listed}])) > 0 THEN '{label}'")
    return " ".join(arms)


@query(
    "document_taxonomy",
    T.sql_docs(f""", typed AS (SELECT doc_id, list_filter([
        CASE WHEN ssn IS NOT NULL THEN 'SSN' END, CASE WHEN regexp_matches(text, '{T.SQL_MRN_SPACED}') THEN 'MRN' END,
        CASE WHEN regexp_matches(text, '{T.SQL_ADDRESS}') THEN 'ADDRESS' END], lambda x: x IS NOT NULL) AS types
      FROM hits)""")
    + f"""
    SELECT doc_id,
      CASE {_sql_case_label('types', V.POLICY_TAXONOMY, V.POLICY_PRIORITY)} ELSE 'INTERNAL' END AS policy_label,
      CASE {_sql_case_label('types', V.LEGACY_TAXONOMY, V.LEGACY_PRIORITY)} ELSE 'INTERNAL' END AS legacy_label,
      CASE {_sql_case_label('types', V.CATALOG_TAXONOMY, V.CATALOG_PRIORITY)}
        WHEN len(types) = 0 THEN 'INTERNAL' ELSE 'PUBLIC' END AS catalog_label
    FROM typed""",
)
def document_taxonomy(spark, folder):
    found = detect.detect_alternate(documents(spark, folder).select("doc_id", "text"))
    typed = found.select("doc_id", labels.entity_types(F.col("entities")).alias("types"))
    return typed.select(
        "doc_id",
        labels.label_by_taxonomy(F.col("types"), V.POLICY_TAXONOMY, V.POLICY_PRIORITY).alias("policy_label"),
        labels.label_by_taxonomy(F.col("types"), V.LEGACY_TAXONOMY, V.LEGACY_PRIORITY).alias("legacy_label"),
        labels.label_by_taxonomy(
            F.col("types"), V.CATALOG_TAXONOMY, V.CATALOG_PRIORITY, fallback=V.CATALOG_FALLBACK
        ).alias("catalog_label"),
    )


_HANDLING_SQL = ", ".join(
    f"('{label}', {', '.join(str(step in steps).lower() for step in ('allow', 'mask', 'block', 'log', 'evidence'))})"
    for label, steps in V.CATALOG_HANDLING.items()
)


@query(
    "label_handling",
    f"""WITH labelled AS ({_sql_by_taxonomy(V.CATALOG_TAXONOMY, V.CATALOG_PRIORITY, "PUBLIC")}),
      handling(label, h_allow, h_mask, h_block, h_log, h_evidence) AS (VALUES {_HANDLING_SQL})
    SELECT subject_id, label, h_allow, h_mask, h_block, h_log, h_evidence
    FROM labelled LEFT JOIN handling USING (label)""",
)
def label_handling(spark, folder):
    return taxonomy.with_handling(catalog_labels(spark, folder), V.CATALOG_HANDLING)


@query(
    "unknown_types",
    f"""WITH found AS (SELECT event_id, {EVENT_TYPE} AS entity_type FROM events)
    SELECT event_id, entity_type, 'Unknown classification token' AS message FROM found
    WHERE entity_type IS NULL OR entity_type NOT IN ({', '.join(f"'{t}'" for t in V.CATALOG_TAXONOMY)})""",
)
def unknown_types(spark, folder):
    events = table(spark, folder, "events").select("event_id", F.expr(EVENT_TYPE).alias("entity_type"))
    tax = taxonomy.taxonomy_table(spark, V.CATALOG_TAXONOMY, V.CATALOG_PRIORITY)
    return taxonomy.unknown_tokens(events, tax).select(
        "event_id", "entity_type", F.lit(V.MSG_TOKEN).alias("message")
    )

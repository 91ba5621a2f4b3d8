"""Log, evidence-log and evidence-document queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from sluice.functions import masking
from sluice.operators import corpus, gateway
from sluice.plans import triggers as T
from sluice.plans.decision_queries import TURN_ROLE, _sql_action
from sluice.plans.evidence_queries import _CURRENT_SQL, _VALID_SQL, _index, _validated, controls
from sluice.plans.registry import query, table
from sluice.plans.text_queries import SQL_MASKED, turns
from sluice.sources import readers, sinks
from sluice.sources.staging import new_path


@query(
    "log_lines",
    """SELECT event_id, CASE WHEN event_id % 6 = 3 THEN NULL ELSE json_extract(props, '$.k')::INTEGER END AS k
    FROM events WHERE event_id % 6 NOT IN (0, 1)""",
)
def log_lines(spark, folder):
    # Every sixth line is blank, the next one cut off, another a bare number.
    line = F.expr(
        "CASE event_id % 6 WHEN 0 THEN '  ' WHEN 1 THEN left(props, length(props) - 1) WHEN 2 THEN concat(' ', props, '\\t') "
        "WHEN 3 THEN '5' ELSE props END"
    )
    lines = table(spark, folder, "events").select("event_id", line.alias("value"))
    return readers.parsed_lines(lines).select("event_id", F.try_variant_get("record", "$.k", "int").alias("k"))


_MASKED_TURNS = SQL_MASKED.replace("SELECT doc_id, text,", "SELECT *,").replace("FROM docs)", "FROM hits)")


@query(
    "evidence_log",
    T.sql_turns(f", {_MASKED_TURNS}, a AS (SELECT *, coalesce({TURN_ROLE}, 'unknown') AS who FROM masked WHERE role = 'user')") + f"""
    SELECT sha256(concat_ws('|', 'request', conv_id, turn)) AS decision_id, 'request' AS stage, {_sql_action('who')} AS action,
      who AS role, ((ssn IS NOT NULL)::INT + (routing IS NOT NULL)::INT + (passport IS NOT NULL)::INT + (ssn IS NULL AND ssn_word)::INT)::INTEGER AS n_findings,
      left(masked_text, 200) AS content_preview, DATE '2024-01-01' + (conv_id % 30)::INTEGER AS date FROM a""",
)
def evidence_log(spark, folder):
    prompts = turns(spark, folder).where("role = 'user'").select(
        "conv_id", "turn", F.coalesce(F.expr(TURN_ROLE), F.lit("unknown")).alias("role"), F.col("text").alias("prompt")
    )
    outcomes = gateway.ingress(prompts, "conv_id", "turn").withColumn(
        "preview", masking.safe_preview(F.col("masked_prompt"))
    )
    day = F.expr("cast(date_add(date'2024-01-01', cast(conv_id % 30 as int)) as timestamp)")
    rows = sinks.evidence_rows(outcomes, "request", "conv_id", "turn", preview="preview", ts=day)
    return rows.select(
        "decision_id", "stage", "action", "role", F.size("pii_findings").alias("n_findings"), "content_preview", "date"
    )


PART = 600  # bytes of links in a record: small, so that well-linked controls take several


@query(
    "evidence_document",
    f"""WITH {_CURRENT_SQL},
    t AS (SELECT control_id, kind, tool_id, rule, count(*) AS n FROM links GROUP BY ALL),
    k AS (SELECT control_id, count(*) FILTER (kind = 'opa_policies') AS n_policies, count(*) FILTER (kind = 'checkov_checks') AS n_checks,
      count(*) FILTER (kind = 'evidence_sources') AS n_sources, sum(n) AS n_links, md5(string_agg(concat_ws('|', kind, tool_id, rule, n), ',' ORDER BY kind, tool_id, rule NULLS FIRST)) AS tools
      FROM t GROUP BY 1)
    SELECT 'controls' AS section, coalesce(cur.id, control_id) AS item, name, domain, cur.id IS NOT NULL AS in_catalog,
      coalesce(n_policies, 0)::BIGINT AS n_policies, coalesce(n_checks, 0)::BIGINT AS n_checks, coalesce(n_sources, 0)::BIGINT AS n_sources,
      coalesce(n_links, 0)::BIGINT AS n_links, coalesce(tools, md5('')) AS tools, true AS within FROM cur FULL OUTER JOIN k ON cur.id = k.control_id
    UNION ALL SELECT 'artifacts.logs', event_id::VARCHAR, event_type, NULL, NULL, NULL, NULL, NULL, NULL, NULL, true FROM events
    UNION ALL SELECT 'run_metadata', '2024-01-01T00:00:00Z', 'sluice', NULL, NULL, NULL, NULL, NULL, NULL, NULL, true""",
)
def evidence_document(spark, folder):
    """The document's records read back from JSON: fields and tools of every control over its parts, artifacts, metadata."""
    current, links = _index(spark, folder)
    logs = table(spark, folder, "events").select(F.col("event_id").cast("string").alias("id"), "event_type")
    rows = readers.evidence_document(current, {"logs": logs}, "2024-01-01T00:00:00Z", "sluice", links, PART)
    path = new_path(spark, "document")
    sinks.write_report(rows, path)
    tool = "array<struct<id:string,check_id:string,rule:string,n:bigint>>"
    fields = f"id string, name string, domain string, in_catalog boolean, part bigint, event_type string, generated_at_utc string, tool string, tools struct<opa_policies:{tool},checkov_checks:{tool},evidence_sources:{tool}>"
    read = spark.read.schema("section string, payload string").json(path).select("section", F.from_json("payload", fields).alias("p"))

    def listed(kind):
        return F.transform(
            F.col(f"p.tools.{kind}"), lambda t: F.concat_ws("|", F.lit(kind), F.coalesce(t["id"], t["check_id"]), t["rule"], t["n"].cast("string"))
        )

    kinds = ("opa_policies", "checkov_checks", "evidence_sources")
    controls_ = read.where("section = 'controls'")
    size = sum((F.octet_length(F.to_json(f"p.tools.{kind}")) for kind in kinds), F.lit(0))
    one = controls_.select(
        "p.*", (size <= 2 * PART).alias("within"), *[F.size(f"p.tools.{kind}").alias(f"n_{kind}") for kind in kinds],
        F.concat(*[listed(kind) for kind in kinds]).alias("texts"),
        F.aggregate(F.concat(*[F.col(f"p.tools.{k}.n") for k in kinds]), F.lit(0).cast("bigint"), lambda a, n: a + n).alias("n_all"),
    )
    joined = one.groupBy(F.col("id").alias("item")).agg(
        F.lit("controls").alias("section"), *[F.array_max(F.collect_list(c)).alias(c) for c in ("name", "domain")], F.bool_or("in_catalog").alias("in_catalog"),
        F.sum("n_opa_policies").alias("n_policies"), F.sum("n_checkov_checks").alias("n_checks"), F.sum("n_evidence_sources").alias("n_sources"),
        F.sum("n_all").alias("n_links"), F.sort_array(F.flatten(F.collect_list("texts"))).alias("texts"), F.bool_and("within").alias("within"),
    )
    # tools by kind, id and rule; where a rule is missing the number stands in its place, which sorts first as well
    columns = ["section", "item", "name", "domain", "in_catalog", "n_policies", "n_checks", "n_sources", "n_links", "tools", "within"]
    document = joined.withColumn("tools", F.md5(F.array_join("texts", ",").cast("binary"))).select(columns)
    others = read.where("section <> 'controls'").select(
        "section", F.coalesce("p.id", "p.generated_at_utc").alias("item"), F.coalesce("p.event_type", "p.tool").alias("name"), F.lit(True).alias("within")
    )
    return document.unionByName(others, allowMissingColumns=True)


@query(
    "coverage_report",
    f"""WITH {_VALID_SQL} SELECT 'summary' AS section, NULL AS control_id, NULL AS reason, count(*) AS total_controls, count(reason) AS missing_evidence_count FROM v
    UNION ALL SELECT 'missing', id, reason, NULL, NULL FROM v WHERE reason IS NOT NULL""",
)
def coverage_report(spark, folder):
    """The report's records read back from JSON: totals, and each control that lacks evidence."""
    path = new_path(spark, "coverage")
    sinks.write_report(sinks.coverage_report(_validated(spark, folder), "2024-01-01T00:00:00Z"), path)
    read = spark.read.schema("section string, payload string").json(path)
    fields = "control_id string, reason string, total_controls bigint, missing_evidence_count bigint"
    return read.select("section", F.from_json("payload", fields).alias("p")).select("section", "p.*")


@query(
    "artifact_manifest",
    """WITH f AS (SELECT source || CASE WHEN doc_id % 3 = 0 THEN '/old/' ELSE '/' END || doc_id || '.txt' AS path, sha256(coalesce(text, '')) AS sha256 FROM documents),
    r AS (SELECT source || '/' || doc_id || '.txt' AS name, lang AS source FROM documents WHERE doc_id % 2 = 0)
    SELECT name, source, sha256, sha256 IS NULL AS missing FROM r LEFT JOIN f ON f.path = r.name""",
)
def artifact_manifest(spark, folder):
    """Half of the documents as required files; every third is in another folder under the same name, and so missing."""
    docs = table(spark, folder, "documents")
    path = F.concat("source", F.when(F.col("doc_id") % 3 == 0, "/old/").otherwise("/"), "doc_id", F.lit(".txt"))
    files = docs.select(path.alias("path"), F.coalesce("text", F.lit("")).cast("binary").alias("content"))
    required = docs.where("doc_id % 2 = 0").select(F.concat("source", F.lit("/"), "doc_id", F.lit(".txt")).alias("name"), F.col("lang").alias("source"))
    return sinks.manifest(required, files)


@query(
    "corpus_changes",
    """SELECT 'doc/' || doc_id || '.json' AS s3_key, CASE WHEN doc_id % 7 = 3 THEN NULL ELSE doc_id END AS doc_id,
      CASE doc_id % 7 WHEN 1 THEN 'new' WHEN 2 THEN 'changed' WHEN 3 THEN 'gone' END AS change FROM documents WHERE doc_id % 7 IN (1, 2, 3)""",
)
def corpus_changes(spark, folder):
    """A corpus against the manifest of an earlier run: some documents new since then, some changed, some gone."""
    docs = table(spark, folder, "documents").select(
        F.concat(F.lit("doc/"), "doc_id", F.lit(".json")).alias("s3_key"), "doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("digest")
    )
    path = new_path(spark, "manifest")
    old = F.when(F.col("doc_id") % 7 == 2, F.sha2("digest", 256)).otherwise(F.col("digest"))
    readers.record_manifest(docs.withColumn("digest", F.lit("x")), path, 1)
    readers.record_manifest(docs.where("doc_id % 7 <> 1").withColumn("digest", old), path, 2)
    return readers.corpus_changes(docs.where("doc_id % 7 <> 3"), readers.read_manifest(spark, path)).select("s3_key", "doc_id", "change")


_PREFIXES = ["clean/", "sensitive/"]


@query(
    "corpus_files",
    """SELECT CASE WHEN doc_id % 3 = 0 THEN 'clean/' ELSE 'sensitive/' END AS prefix, doc_id::VARCHAR AS doc_id, trim(text, ' ' || chr(9) || chr(10) || chr(13)) AS text FROM documents
    WHERE doc_id % 3 <> 2 AND trim(text, ' ' || chr(9) || chr(10) || chr(13)) <> ''""",
)
def corpus_files(spark, folder):
    """Documents as JSON files, one each as in an object store, under three prefixes, of which two are asked for."""
    root = new_path(spark, "corpus")
    stored = [*_PREFIXES, "other/"]
    prefix = F.get(F.array(*map(F.lit, stored)), (F.col("doc_id") % 3).cast("int"))
    rows = table(spark, folder, "documents").select(prefix.alias("prefix"), F.col("doc_id").cast("string").alias("id"), "text")
    sinks.write_objects(rows, root, stored)
    found = readers.read_corpus(spark, root, _PREFIXES)
    return corpus.usable_documents(found, "prefix").select("prefix", "doc_id", "text")


@query("first_artifact", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def first_artifact(spark, folder):
    """Counts written as one JSON artifact and read back as a VARIANT."""
    path = new_path(spark, "artifact")
    counts = table(spark, folder, "events").groupBy("event_type").agg(F.count("*").alias("n"))
    listed = counts.agg(F.to_json(F.sort_array(F.collect_list(F.struct("event_type", "n")))).alias("value"))
    listed.write.text(path)
    record = readers.read_artifact(spark, path).select(F.try_variant_get("record", "$", "array<struct<event_type:string,n:bigint>>").alias("r"))
    return record.select(F.inline("r"))


@query(
    "catalog_file",
    f"WITH {_CURRENT_SQL} SELECT ordinal, id, name, domain, 2 AS n_frameworks FROM raw",
)
def catalog_file(spark, folder):
    """A control catalog written as JSON lines and read with its declared schema."""
    path = new_path(spark, "catalog")
    controls(spark, folder).write.json(path)
    return readers.read_catalog(spark, path).select("ordinal", "id", "name", "domain", F.size("frameworks").alias("n_frameworks"))

"""Queries that write through a sink, feed it a batch twice, and read back what it holds."""

from __future__ import annotations

from pyspark.sql import functions as F

from sluice.functions import detect, labels
from sluice.plans import triggers as T
from sluice.plans.registry import query, table
from sluice.plans.text_queries import documents
from sluice.sources import sinks, vector_table
from sluice.sources.staging import new_path
from sluice.streaming import gateway as streams

_BUCKET_SQL = "(('0x' || md5(id)[1:8])::BIGINT % 8)::INTEGER"


@query(
    "upsert_partitions",
    f"""WITH w AS (
      SELECT 'ns' || (vec_id % 3) AS namespace, 'v' || (vec_id % 100) AS id, vec_id AS seq, label, round(embedding[1]::DOUBLE, 6) AS first_value
      FROM embeddings WHERE label < 5 OR vec_id % 3 = 1)
    SELECT namespace, id, max(seq) AS seq, arg_max(label, seq) AS label, arg_max(first_value, seq) AS first_value, any_value({_BUCKET_SQL}) AS bucket
    FROM w GROUP BY namespace, id""",
)
def upsert_partitions(spark, folder):
    """A vector table after a load and a later batch for one namespace, which is fed twice."""
    writes = table(spark, folder, "embeddings").select(
        F.expr("concat('ns', vec_id % 3)").alias("namespace"), F.expr("concat('v', vec_id % 100)").alias("id"),
        F.col("vec_id").alias("seq"), "label", F.col("embedding").alias("values"),
    )
    path = new_path(spark, "vectors")
    for batch in ("label < 5", "label >= 5 AND namespace = 'ns1'", "label >= 5 AND namespace = 'ns1'"):
        vector_table.upsert(writes.where(batch), path, 8)
    state = vector_table.read_vectors(spark, path, writes.schema)
    return state.select(
        "namespace", "id", "seq", "label", F.round(F.col("values")[0].cast("double"), 6).alias("first_value"),
        vector_table.bucket_of(F.col("id"), 8).alias("bucket"),
    )


@query(
    "replayed_zones",
    T.sql_docs() + f"""
    SELECT doc_id, CASE WHEN {T.SQL_LABEL} = 'restricted_pii' THEN 'quarantine' ELSE 'open' END AS zone, doc_id % 3 AS batch_id FROM hits""",
)
def replayed_zones(spark, folder):
    """Zones after three batches, of which one comes twice."""
    scanned = detect.with_hits(documents(spark, folder)).select("doc_id", F.upper(labels.label_from_hits()).alias("label"))
    path = new_path(spark, "zones")
    for number in (0, 1, 2, 1):
        sinks.write_zones(scanned.where(F.col("doc_id") % 3 == number), "label", path, number)
    return spark.read.parquet(path).select("doc_id", "zone", F.col("batch_id").cast("long").alias("batch_id"))


def decisions(spark, folder):
    """Decision rows over events, with the event's time."""
    outcomes = table(spark, folder, "events").select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), F.expr("CASE event_id % 3 WHEN 0 THEN 'allow' WHEN 1 THEN 'mask' ELSE 'block' END").alias("action"),
        F.expr("concat('role', user_id % 4)").alias("role"), F.array().cast(f"array<{detect.ENTITY_DDL}>").alias("pii_findings"),
        F.col("event_type").alias("preview"),
    )
    return sinks.evidence_rows(outcomes, "request", "event_id", preview="preview", ts=F.col("ts"))


_DECISIONS_SQL = """SELECT sha256(concat_ws('|', 'request', event_id)) AS decision_id, 'request' AS stage,
      CASE event_id % 3 WHEN 0 THEN 'allow' WHEN 1 THEN 'mask' ELSE 'block' END AS action, 'role' || (user_id % 4) AS role,
      event_type AS content_preview, ts::DATE AS date FROM events"""
DECISION = ["decision_id", "stage", "action", "role", "content_preview", "date"]


@query("replayed_evidence", _DECISIONS_SQL)
def replayed_evidence(spark, folder):
    """The decision log after batches that overlap: each decision once."""
    rows = decisions(spark, folder)
    path = new_path(spark, "evidence")
    for batch in ("action <> 'block'", "action <> 'allow'", "true"):
        sinks.append_new_evidence(rows.where(batch), path)
    return spark.read.parquet(path).select(*DECISION)


@query("evidence_stream", _DECISIONS_SQL)
def evidence_stream(spark, folder):
    """The decision log of a stream in which every request comes twice, once more in a later batch."""
    rows = decisions(spark, folder)
    source, path = new_path(spark, "requests"), new_path(spark, "log")
    for _ in range(2):
        rows.write.mode("append").parquet(source)
    live = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(source)
    log = streams.decision_log(live, "60 days")
    streams.write_available(log, path, "log", partition_by=["stage", "date"], checkpoint=f"{path}-state").awaitTermination()
    return spark.read.parquet(path).select(*DECISION)


@query(
    "audit_stream",
    "SELECT ts::DATE AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2",
)
def audit_stream(spark, folder):
    """Counts by day and type of a stream, of which every tenth row comes late, in a file after all others."""
    events = table(spark, folder, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type")
    source, path = new_path(spark, "events"), new_path(spark, "audit")
    for part in ("event_id % 10 <> 3", "event_id % 10 = 3"):
        events.where(part).write.mode("append").parquet(source)
    live = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(source)
    counts = streams.audit_counts(live, "event_type", window="1 hour", delay="60 days")
    streams.write_audit(counts, path, "audit", checkpoint=f"{path}-state").awaitTermination()
    hours = streams.read_audit(spark, path, "event_type")
    return hours.groupBy(F.to_date("window_start").alias("day"), "event_type").agg(F.sum("n").alias("n"))

"""Writers: decision log, quarantine split, vector table, reports, the artifact manifest and corpora of one file a record."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.decisions import decision_id
from sluice.functions.rows import first_by, fresh
from sluice.operators.tables import fixed_table
from sluice.sources.paths import below
from sluice.sources.staging import replace_partitions, staged, stored

QUARANTINED = "RESTRICTED_PII"
FOLDER_FILES = 100  # of one part; Spark lists folders side by side where there are more than 32


def zone_of(label: Column) -> Column:
    """Zone of a record: rows labelled as restricted identity data are quarantined."""
    return F.when(label == QUARANTINED, "quarantine").otherwise("open")


def evidence_rows(
    outcomes: DataFrame, stage: str, *keys: str, preview: str, role: str = "role", action: str = "action",
    findings: str = "pii_findings", ts: Column | None = None,
) -> DataFrame:
    """Decision-log rows of gateway outcomes, with a stable ``decision_id``.

    ``preview`` names a column that is already masked and cut.
    """
    stamp = F.current_timestamp() if ts is None else ts
    return outcomes.select(
        decision_id(stage, *[F.col(k) for k in keys]).alias("decision_id"),
        F.lit(stage).alias("stage"),
        F.col(action).alias("action"), F.col(role).alias("role"),
        F.col(findings).alias("pii_findings"), F.col(preview).alias("content_preview"),
        stamp.alias("ts"), F.to_date(stamp).alias("date"),
    )


def append_evidence(rows: DataFrame, path: str) -> None:
    """Append decision rows as Parquet, partitioned by stage and date, as they come: a repeated call repeats them."""
    rows.write.mode("append").partitionBy("stage", "date").parquet(path)


def append_new_evidence(rows: DataFrame, path: str, lookback_days: int = 1) -> None:
    """Append the decisions that the log does not hold yet; a batch fed twice leaves one copy of each.

    The rows are run once. Of the log only ids are read, and only in the stages and days of the batch and
    ``lookback_days`` before them, so ``ts`` must be the time of the request, not that of the write. Of
    several rows of one decision the first by time stays.
    """
    once = first_by(staged(rows, "evidence"), ["decision_id"], F.col("ts"), F.xxhash64(*rows.columns))
    days = once.groupBy("stage").agg(F.min("date").alias("low"), F.max("date").alias("high")).collect()  # one row per stage
    held = stored(rows.sparkSession, path, rows.schema)
    near = F.lit(False)
    for day in days:
        near = near | (F.col("stage").eqNullSafe(day.stage) & F.col("date").between(F.date_sub(F.lit(day.low), lookback_days), F.lit(day.high)))
    append_evidence(once.join(held.where(near).select("decision_id"), "decision_id", "left_anti"), path)


def write_zones(df: DataFrame, label: str, path: str, batch_id: int) -> None:
    """Write rows to ``zone=.../batch_id=...`` under ``path`` in one pass over them.

    A batch that comes again replaces its own partitions, so it leaves one copy. Fits a numbered ``foreachBatch``.
    """
    zoned = df.withColumns({"zone": zone_of(F.col(label)), "batch_id": F.lit(batch_id).cast("long")})
    replace_partitions(zoned, path, "zone", "batch_id")


def split_quarantine(df: DataFrame, label: str, open_path: str, quarantine_path: str, batch_id: int | None = None) -> None:
    """Write rows to the folder of their zone. The rows are run once; each zone is written from a staged table.

    With a ``batch_id`` each folder is partitioned by it and a batch that comes again replaces itself; without
    one, rows are appended as they come.
    """
    zone = fresh(df, "_zone")
    zoned = staged(df.withColumn(zone, zone_of(F.col(label))), "zones")
    for name, path in (("open", open_path), ("quarantine", quarantine_path)):
        own = zoned.where(F.col(zone) == name).drop(zone)
        if batch_id is None:
            own.write.mode("append").parquet(path)
        else:
            replace_partitions(own.withColumn("batch_id", F.lit(batch_id).cast("long")), path, "batch_id")


def latest_vectors(current: DataFrame | None, batch: DataFrame, seq: str = "seq") -> DataFrame:
    """State of a vector table after a batch: the last write of each ``(namespace, id)`` stays.

    Each task keeps one write per key before the shuffle, so an id with most of the writes does not gather in
    one task. Equal sequence numbers are settled by a hash of the content.
    """
    writes = batch if current is None else current.unionByName(batch)
    rest = [c for c in writes.columns if c not in ("namespace", "id")]
    kinds = dict(writes.dtypes)
    content = F.xxhash64(
        *[F.array_sort(F.map_entries(c)) if kinds[c].startswith("map") else F.col(c) for c in rest]
    )
    won = first_by(writes, ["namespace", "id"], F.col(seq).desc_nulls_last(), content.desc())
    return won.select("namespace", "id", *rest)


def write_report(report: DataFrame, path: str) -> None:
    """Write report rows as JSON lines."""
    report.write.mode("overwrite").json(path)


def write_objects(records: DataFrame, root: str, prefixes: list[str], prefix: str = "prefix") -> None:
    """Write every record as a JSON file of its own, below ``root`` and its prefix; rows of other prefixes are left out.

    In a local or mounted folder Hadoop starts processes that set the mode of each file, so there the tasks write the
    files themselves, in folders of bounded size. Elsewhere Spark's writer makes them, a prefix after the other.
    """
    columns = [F.col(f"`{c}`") for c in records.columns if c != prefix]
    base = root.rstrip("/")
    if not base.startswith(("/", "file:")):
        for name in dict.fromkeys(prefixes):
            own = records.where(F.col(prefix) == name).select(*columns)
            own.write.option("maxRecordsPerFile", 1).json(f"{base}/{name}")
        return
    local = "/" + base.removeprefix("file:").lstrip("/")
    bodies = records.where(F.col(prefix).isin(prefixes)).select(F.col(prefix).alias("prefix"), F.concat(F.to_json(F.struct(*columns)), F.lit("\n")).alias("body"))
    bodies.mapInArrow(_objects(local, uuid.uuid4().hex), "n long").write.format("noop").mode("overwrite").save()


def _objects(root: str, run_id: str):
    """A task writes to folders of its own, which get their names when all is written: of attempts that come twice one counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        part = f"{context.partitionId():05d}-{run_id}"
        own = f"{root}/.attempts/{part}-{context.taskAttemptId()}"
        counts: dict[str, int] = {}
        places: dict[str, str] = {}
        for batch in batches:
            for name, body in zip(batch["prefix"].to_pylist(), batch["body"]):
                place = places.setdefault(name, f"{own}/{len(places)}")
                n = counts.get(name, 0)
                folder = f"{place}/{n // FOLDER_FILES:06d}"
                if n % FOLDER_FILES == 0:
                    os.makedirs(folder)
                with open(f"{folder}/{n % FOLDER_FILES:03d}.json", "xb") as out:
                    out.write(body.as_buffer())
                counts[name] = n + 1
        for name, place in places.items():
            target = f"{root}/{name.rstrip('/')}/part-{part}"
            os.makedirs(os.path.dirname(target), exist_ok=True)
            try:
                os.rename(place, target)
            except OSError:
                if not os.path.isdir(target):
                    raise
        yield pa.RecordBatch.from_arrays([pa.array(counts.values(), pa.int64())], names=["n"])

    return run


def manifest(required: DataFrame, files: DataFrame, name: str = "name") -> DataFrame:
    """The required rows with the ``sha256`` of the file at exactly that path, or ``missing``.

    ``files`` has ``path, content``; a file of the same name in another folder does not count.
    """
    digests = files.select(F.col("path").alias(name), F.sha2("content", 256).alias("sha256"))
    found = required.join(digests, name, "left")
    return found.withColumn("missing", F.col("sha256").isNull())


def artifact_manifest(spark: SparkSession, required: list[tuple[str, str]], folder: str) -> DataFrame:
    """One row per required artifact: ``name, source, sha256, missing``.

    ``required`` lists paths below ``folder`` and their sources; only files of those base names are opened.
    """
    wanted = fixed_table(spark, required, "name string, source string")
    names = "{" + ",".join(sorted({name.rpartition("/")[2] for name, _ in required})) + "}"
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", names).load(folder)
    found = files.select(F.ltrim(below(F.col("_metadata.file_path"), folder.rstrip("/")), F.lit("/")).alias("path"), "content")
    return manifest(wanted, found).select("name", "source", "sha256", "missing")


def coverage_report(validated: DataFrame, generated_at: str) -> DataFrame:
    """``section, payload`` rows of a coverage report: the totals, then every control that lacks evidence and why.

    Ready for ``write_report``; the list has a row per control, so it has no size limit.
    """
    totals = validated.agg(F.count(F.lit(1)).alias("total_controls"), F.count("reason").alias("missing_evidence_count"))
    head = totals.select(
        F.lit("summary").alias("section"),
        F.to_json(F.struct(F.lit(generated_at).alias("generated_at"), "total_controls", "missing_evidence_count")).alias("payload"),
    )
    lacking = validated.where(F.col("reason").isNotNull())
    return head.unionByName(
        lacking.select(F.lit("missing").alias("section"), F.to_json(F.struct(F.col("id").alias("control_id"), "reason")).alias("payload"))
    )

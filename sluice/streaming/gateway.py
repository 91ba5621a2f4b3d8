"""The batch columns on streaming sources, the decision log without repeats, and audit counts by event time.

Every verdict is computed inside its row, so those streams hold no state and need no watermark. The log and the
counts keep state up to a watermark. Checkpoints go to the shared folder the session names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sluice.functions import detect
from sluice.functions.rows import first_by
from sluice.operators import gateway, moves
from sluice.session import shared_folder
from sluice.sources.staging import replace_partitions


def prompt_verdicts(prompts: DataFrame, *keys: str, text: str = "text") -> DataFrame:
    """``label, hops, blocked`` of every incoming prompt."""
    return moves.prompt_verdicts(detect.with_hits(prompts, text), *keys)


def ingress(requests: DataFrame, *keys: str, body: str = "body") -> DataFrame:
    """Outcome of every request body; a refused one keeps its status 400 and error, with no action."""
    parsed = gateway.parse_requests(requests, body).withColumnsRenamed({"status": "_status", "error": "_error"})
    judged = gateway.ingress(parsed, *keys)
    good = F.col("_status") == 200
    return judged.withColumns(
        {
            "status": F.when(good, F.col("status")).otherwise(F.col("_status")),
            "error": F.when(good, F.col("error")).otherwise(F.col("_error")),
            **{name: F.when(good, F.col(name)) for name in ("action", "forwarded_prompt", "masked_prompt")},
        }
    ).drop("_status", "_error")


def write_available(
    rows: DataFrame, path: str, name: str, *, partition_by: list[str] | None = None, checkpoint: str | None = None
) -> StreamingQuery:
    """Append all rows that are available now as Parquet, then stop. Runs again from the checkpoint."""
    spark: SparkSession = rows.sparkSession
    folder = checkpoint or f"{shared_folder(spark)}/streams/{name}"
    writer = rows.writeStream.format("parquet").outputMode("append").option("checkpointLocation", folder)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.trigger(availableNow=True).start(path)


def for_each_batch(rows: DataFrame, sink, name: str, *, checkpoint: str | None = None, numbered: bool = False, mode: str = "append") -> StreamingQuery:
    """Hand every micro-batch to a batch sink such as the quarantine split.

    After a failure Spark hands a batch over again under its old number. A ``numbered`` sink gets that number as
    its second argument and can replace what the batch left (``sinks.write_zones``, ``sinks.split_quarantine``).
    """
    folder = checkpoint or f"{shared_folder(rows.sparkSession)}/streams/{name}"
    take = sink if numbered else lambda batch, _: sink(batch)
    return rows.writeStream.foreachBatch(take).outputMode(mode).option("checkpointLocation", folder).trigger(availableNow=True).start()


def decision_log(rows: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Decision rows (``sinks.evidence_rows`` with the request's time as ``ts``) of a stream, each decision once.

    A decision that comes again within ``delay`` of its first row is dropped, in whatever batch it comes; state
    older than the watermark is let go, so it does not grow with the stream.
    """
    return rows.withWatermark("ts", delay).dropDuplicatesWithinWatermark(["decision_id"])


def audit_counts(rows: DataFrame, *keys: str, ts: str = "ts", window: str = "1 day", delay: str = "2 days") -> DataFrame:
    """``window_start, <keys>, n``: rows per window of event time and keys, kept up as rows come.

    A late row corrects its window as long as the watermark, ``delay`` behind the latest row seen, has not
    passed the window's end. Windows beyond it leave the state.
    """
    counted = rows.withWatermark(ts, delay).groupBy(F.window(ts, window), *keys).agg(F.count("*").alias("n"))
    return counted.select(F.col("window.start").alias("window_start"), *keys, "n")


def write_audit(counts: DataFrame, path: str, name: str, *, checkpoint: str | None = None) -> StreamingQuery:
    """Write what each batch changed to ``batch_id=...`` under ``path``; a batch that comes again replaces itself."""

    def sink(batch: DataFrame, number: int) -> None:
        replace_partitions(batch.withColumn("batch_id", F.lit(number).cast("long")), path, "batch_id")

    return for_each_batch(counts, sink, name, checkpoint=checkpoint, numbered=True, mode="update")


def read_audit(spark: SparkSession, path: str, *keys: str) -> DataFrame:
    """The counts as they stand: of each window and keys what the last batch that changed it wrote."""
    return first_by(spark.read.parquet(path), ["window_start", *keys], F.col("batch_id").desc()).drop("batch_id")

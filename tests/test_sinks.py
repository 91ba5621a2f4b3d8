"""Sinks that are fed twice, that fail half-way, and what they leave alone."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from sluice.sources import sinks, vector_table
from sluice.streaming import gateway as streams

VECTOR = "namespace string, id string, values array<float>, metadata map<string,string>, seq bigint"


def batch(spark, rows):
    return spark.createDataFrame([(n, i, [float(s)], {"s": str(s)}, s) for n, i, s in rows], VECTOR)


def state(spark, path):
    rows = vector_table.read_vectors(spark, str(path), spark.createDataFrame([], VECTOR).schema).collect()
    return sorted(((r.namespace, r.id, r.seq, r.values[0], r.metadata["s"]) for r in rows), key=str)


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_upsert_replaces_touched_partitions_only(spark, tmp_path):
    path = tmp_path / "table"
    assert state(spark, path) == []
    first = [("a", f"v{k}", 1) for k in range(40)] + [("b", "v1", 1), ("007", "v1", 1), ("", "v1", 1), (None, "v1", 1), ("x/y=1", "v1", 1), ("a", None, 1)]
    vector_table.upsert(batch(spark, first), str(path), 4)
    before = files(path)
    # the last write stays, whichever comes first; a batch may hold a key several times
    second = [("a", "v1", 3), ("a", "v1", 2), ("a", "new", 1), ("007", "v1", 0)]
    for _ in range(2):
        vector_table.upsert(batch(spark, second), str(path), 4)
        want = {(n, i): s for n, i, s in first} | {("a", "v1"): 3, ("a", "new"): 1}
        assert state(spark, path) == sorted(((n, i, s, float(s), str(s)) for (n, i), s in want.items()), key=str)
    touched = {f"part_space=na/part_buckets=4/part_bucket={b}" for b in buckets(spark, ["v1", "new"])} | {
        f"part_space=n007/part_buckets=4/part_bucket={b}" for b in buckets(spark, ["v1"])
    }
    after = files(path)
    kept = {f for f in before if not any(t in f for t in touched)}
    assert kept and all(after.get(f) == before[f] for f in kept)
    assert not {f for f in before if any(t in f for t in touched)} & set(after)
    vector_table.upsert(batch(spark, []), str(path), 4)
    assert files(path) == after


def buckets(spark, ids):
    return {r[0] for r in spark.createDataFrame([(i,) for i in ids], "id string").select(vector_table.bucket_of(F.col("id"), 4)).collect()}


def test_upsert_refuses_what_would_split_a_key(spark, tmp_path):
    path = str(tmp_path / "table")
    vector_table.upsert(batch(spark, [("a", "v", 1)]), path, 4)
    with pytest.raises(ValueError, match="has 4 buckets"):
        vector_table.upsert(batch(spark, [("a", "v", 2)]), path, 8)
    with pytest.raises(ValueError, match="part_bucket"):
        vector_table.upsert(batch(spark, [("a", "v", 2)]).withColumn("part_bucket", F.lit(0)), path, 4)


def test_a_failed_publish_can_be_done_again(spark, tmp_path, monkeypatch):
    path = tmp_path / "table"
    vector_table.upsert(batch(spark, [("a", f"v{k}", 1) for k in range(9)]), str(path), 2)
    merged = vector_table.stage_upsert(batch(spark, [("a", "v1", 2)]), str(path), 2)
    for name in files(path):  # the partitions are gone, the new ones not there yet
        os.truncate(name, 0)
    vector_table.publish(merged, str(path))
    touched = buckets_of_two(spark, "v1")
    got = [r for r in files(path) if f"part_bucket={touched}/" in r]
    assert got and all(os.path.getsize(f) for f in got)
    with monkeypatch.context() as patch:
        patch.setattr(vector_table, "publish", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError) as caught:
            vector_table.upsert(batch(spark, [("z", "v1", 2)]), str(tmp_path / "other"), 2)
    assert "publish them again" in caught.value.__notes__[0]


def buckets_of_two(spark, ident):
    return spark.createDataFrame([(ident,)], "id string").select(vector_table.bucket_of(F.col("id"), 2)).first()[0]


def counted(df, name):
    """The rows, with an accumulator that counts how often they are made."""
    made = df.sparkSession.sparkContext.accumulator(0)

    def run(batches):
        for part in batches:
            made.add(part.num_rows)
            yield part

    return df.mapInArrow(run, df.schema), made


def test_zones_run_their_input_once_and_replace_a_batch(spark, tmp_path):
    df = spark.createDataFrame([(1, "RESTRICTED_PII"), (2, "INTERNAL"), (3, None)], "id int, label string")
    rows, made = counted(df, "zones")
    sinks.write_zones(rows, "label", str(tmp_path / "zones"), 4)
    assert made.value == 3
    sinks.write_zones(df.where("id < 3"), "label", str(tmp_path / "zones"), 5)
    sinks.write_zones(df, "label", str(tmp_path / "zones"), 4)
    back = spark.read.parquet(str(tmp_path / "zones"))
    assert sorted(tuple(r) for r in back.select("id", "zone", "batch_id").collect()) == [
        (1, "quarantine", 4), (1, "quarantine", 5), (2, "open", 4), (2, "open", 5), (3, "open", 4)
    ]
    rows, made = counted(df, "split")
    for number in (None, None, 7, 7):
        sinks.split_quarantine(rows, "label", str(tmp_path / f"o{number}"), str(tmp_path / f"q{number}"), number)
    assert made.value == 12
    assert [spark.read.parquet(str(tmp_path / n)).count() for n in ("oNone", "qNone", "o7", "q7")] == [4, 2, 2, 1]


def test_zone_stream_that_fails_after_its_write(spark, tmp_path):
    """Spark hands the batch over again under the same number; it is there once."""
    spark.createDataFrame([(k, "RESTRICTED_PII" if k % 3 == 0 else "INTERNAL") for k in range(30)], "id int, label string").write.parquet(str(tmp_path / "in"))
    seen = []

    def sink(rows, number):
        sinks.write_zones(rows, "label", str(tmp_path / "zones"), number)
        seen.append(number)
        if len(seen) == 1:
            raise RuntimeError("lost after the write")

    for attempt in range(2):
        live = spark.readStream.schema("id int, label string").parquet(str(tmp_path / "in"))
        query = streams.for_each_batch(live, sink, "z", checkpoint=str(tmp_path / "cp"), numbered=True)
        if attempt == 0:
            with pytest.raises(Exception, match="lost after the write"):
                query.awaitTermination()
        else:
            query.awaitTermination()
    assert seen == [0, 0]
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "zones")).collect()) == list(range(30))


DAY = dt.datetime(2024, 1, 5, 12)


def decisions(spark, rows):
    df = spark.createDataFrame([(i, DAY + dt.timedelta(hours=h)) for i, h in rows], "id int, ts timestamp").withColumns(
        {"action": F.lit("allow"), "role": F.lit("r"), "pii_findings": F.array().cast("array<string>"), "preview": F.lit("p")}
    )
    return sinks.evidence_rows(df, "request", "id", preview="preview", ts=F.col("ts"))


def test_new_evidence_once(spark, tmp_path):
    path = str(tmp_path / "log")
    rows, made = counted(decisions(spark, [(1, 0), (2, 1), (2, 2), (3, 30)]), "log")
    sinks.append_new_evidence(rows, path)
    assert made.value == 4
    for _ in range(2):
        sinks.append_new_evidence(decisions(spark, [(1, 0), (2, 1), (4, 31)]), path)
    back = spark.read.parquet(path)
    assert back.count() == 4 and back.select("decision_id").distinct().count() == 4
    assert sorted(r.ts.hour for r in back.collect()) == [12, 13, 18, 19]
    sinks.append_new_evidence(decisions(spark, []), path)
    assert spark.read.parquet(path).count() == 4


def feed(spark, rows, folder):
    rows.coalesce(1).write.mode("append").parquet(folder)


def test_decision_log_stream(spark, tmp_path):
    """The same decision in one batch, in a later batch, after a restart; and rows behind the watermark."""
    source, path, state_folder = (str(tmp_path / n) for n in ("in", "log", "cp"))

    def run():
        live = spark.readStream.schema(decisions(spark, []).schema).option("maxFilesPerTrigger", 1).parquet(source)
        streams.write_available(streams.decision_log(live, "3 hours"), path, "log", partition_by=["stage", "date"], checkpoint=state_folder).awaitTermination()
        return sorted(r.ts.hour for r in spark.read.parquet(path).collect())

    feed(spark, decisions(spark, [(1, 0), (1, 0), (2, 1)]), source)
    assert run() == [12, 13]
    feed(spark, decisions(spark, [(1, 0), (3, 2)]), source)
    assert run() == [12, 13, 14]
    for rows in ([(4, 9)], [(4, 9)], [(5, 0)]):  # the last is behind the watermark, which counts from the batch after next
        feed(spark, decisions(spark, rows), source)
    assert run() == [12, 13, 14, 21]


def test_audit_stream_equals_batch_with_late_rows(spark, tmp_path):
    source, path, state_folder = (str(tmp_path / n) for n in ("in", "audit", "cp"))
    every = []

    def put(rows):
        every.extend(rows)
        df = spark.createDataFrame([(DAY + dt.timedelta(hours=h), label) for h, label in rows], "ts timestamp, label string")
        feed(spark, df, source)

    def run():
        live = spark.readStream.schema("ts timestamp, label string").option("maxFilesPerTrigger", 1).parquet(source)
        streams.write_audit(streams.audit_counts(live, "label", window="1 hour", delay="5 hours"), path, "a", checkpoint=state_folder).awaitTermination()
        got = {(r.window_start, r.label): r.n for r in streams.read_audit(spark, path, "label").collect()}
        df = spark.createDataFrame([(DAY + dt.timedelta(hours=h), label) for h, label in every], "ts timestamp, label string")
        want = df.groupBy(F.date_trunc("hour", "ts").alias("w"), "label").count().collect()
        return got, {(r.w, r.label): r["count"] for r in want}

    put([(0, "phi"), (0.2, "phi"), (1, None)])
    put([(4, "internal"), (0.9, "phi"), (1, None)])  # late, within the watermark
    got, want = run()
    assert got == want and len(got) == 3
    put([(2, "phi")])
    got, want = run()
    assert got == want and len(got) == 4
    before = dict(got)
    for _ in range(2):
        put([(40, "phi")])
        run()
    put([(0, "phi")])  # its window has left the state
    got, _ = run()
    assert {k: v for k, v in got.items() if k in before} == before and len(got) == len(before) + 1

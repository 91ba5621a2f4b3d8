import hashlib
import json

import pytest
from pyspark.sql import functions as F

from sluice.functions import detect
from sluice.operators import corpus, moves
from sluice.sources import readers, sinks
from sluice.streaming import gateway as streams

RECORDS = [
    ({"id": "d1", "text": "  hello\n"}, "d1", "hello"),
    ({"text": " \t", "body": "b"}, None, "b"),
    ({"content": 5, "question": "q", "answer": "a"}, None, "q\n\na"),
    ({"prompt": " p "}, None, " p "),
    ({"question": 7, "prompt": "p", "answer": "a"}, None, "a"),
    ({"question": "", "prompt": "p", "response": "r"}, None, "p\n\nr"),
    ({"question": "  ", "prompt": "p"}, None, None),
    ({"note": "x"}, None, None),
    ({"id": 5, "text": "t"}, "5", "t"),
    ({"id": 0, "text": "t"}, None, "t"),
    ({"text": "t", "metadata": {"s3_key": "own", "n": 1}}, None, "t"),
]


def test_corpus(spark, tmp_path):
    (tmp_path / "clean" / "deep").mkdir(parents=True)
    (tmp_path / "other").mkdir()
    for i, (record, _, _) in enumerate(RECORDS):
        (tmp_path / "clean" / "deep" / f"r{i:02d}.json").write_text(json.dumps(record))
    (tmp_path / "clean" / "bad.json").write_text("{nope")
    (tmp_path / "clean" / "skip.txt").write_text('{"text":"t"}')
    (tmp_path / "other" / "x.json").write_text('{"text":"t"}')
    raw = readers.read_corpus(spark, str(tmp_path), readers.prefix_list("clean/, ,absent/"))
    assert raw.count() == len(RECORDS) + 1
    out = {r["metadata"]["s3_key"]: r for r in corpus.usable_documents(raw, "prefix").collect()}
    for i, (record, ident, text) in enumerate(RECORDS):
        key = f"clean/deep/r{i:02d}.json"
        if text is None:
            assert key not in out
            continue
        row = out["own" if "metadata" in record else key]
        assert (row["text"], row["doc_id"], row["prefix"]) == (text, ident or key, "clean/")
    assert out["own"]["metadata"]["n"] == "1"
    assert readers.read_corpus(spark, str(tmp_path), ["absent/"]).count() == 0


def test_corpus_written_by_tasks(spark, tmp_path):
    """One file a record, in many folders, without Hadoop's own writer, whose processes for each file took most of the time."""
    rows = [("clean/", str(i), f"t{i}") for i in range(250)] + [("a/b", "1", None), ("a/b", None, "é\n"), ("a/b", None, "é\n"), (None, "9", "lost"), ("x/", "8", "left")]
    records = spark.createDataFrame(rows, "prefix string, id string, text string").coalesce(1)
    root = tmp_path / "corpus"
    sinks.write_objects(records, f"file://{root}/", ["clean/", "a/b", "none/"])
    made = [p for p in root.rglob("*") if p.is_file()]
    assert len(made) == 253 and {p.suffix for p in made} == {".json"}
    assert sorted(len(list(p.iterdir())) for p in (root / "clean").glob("*/*")) == [50, 100, 100]
    assert sorted(p.read_text() for p in (root / "a" / "b").rglob("*.json")) == ['{"id":"1"}\n', '{"text":"é\\n"}\n', '{"text":"é\\n"}\n']
    raw = readers.read_corpus(spark, str(root), ["clean/", "a/b", "none/"], digests=True)
    plan = raw._jdf.queryExecution().toString()
    assert "binaryFile" in plan.replace("BinaryFile", "binaryFile") and "FileScan text" not in plan
    read = [(r.prefix, r.id, r.text) for r in raw.select("prefix", F.expr("body:id::string").alias("id"), F.expr("body:text::string").alias("text")).collect()]
    assert sorted(read, key=str) == sorted(rows[:253], key=str)
    assert {r.digest for r in raw.collect()} == {hashlib.sha256(p.read_bytes()).hexdigest() for p in made}


def test_corpus_of_a_repeated_task(spark, tmp_path):
    """Where an attempt has written all before, that of a second one adds nothing; a call of its own adds its records."""
    bodies = spark.range(5).select(F.lit("c/").alias("prefix"), F.to_json(F.struct("id")).alias("body")).coalesce(1)
    for _ in range(2):
        bodies.mapInArrow(sinks._objects(str(tmp_path), "run"), "n long").collect()
    assert readers.read_corpus(spark, str(tmp_path), ["c/"]).count() == 5
    sinks.write_objects(bodies, str(tmp_path), ["c/"])
    assert readers.read_corpus(spark, str(tmp_path), ["c/"]).count() == 10


def test_corpus_in_a_store(spark, tmp_path):
    """Other stores than local folders are written by Spark's writer, with the same records."""
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.objects.link./c", f"file://{tmp_path}")
    records = spark.createDataFrame([("c/", "1", "x"), ("c/", "2", None), ("d/", "3", "z")], "prefix string, id string, text string")
    sinks.write_objects(records, "viewfs://objects/c", ["c/", "d/"])
    assert sorted(p.read_text() for p in tmp_path.rglob("*.json") if p.stat().st_size) == ['{"id":"1","text":"x"}\n', '{"id":"2"}\n', '{"id":"3","text":"z"}\n']


def test_corpus_keys_are_whole_paths(spark, tmp_path):
    """Folders that repeat the prefix, blanks, plus and percent signs in names."""
    names = ["x/clean/y.json", "z/clean/y.json", "a b.json", "c+d.json", "50%25.json", "y.json"]
    for name in names:
        path = tmp_path / "clean" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text('{"text":"t"}')
    for root in (str(tmp_path), f"file://{tmp_path}/"):
        raw = readers.read_corpus(spark, root, ["clean/"])
        assert sorted(r["s3_key"] for r in raw.collect()) == sorted(f"clean/{name}" for name in names)


def test_corpus_sync_with_the_callers_embedder(spark):
    raw = spark.createDataFrame([("k1", '{"text":"abc"}'), ("k2", '{"text":"x","id":"k1"}')], "s3_key string, t string")
    docs = corpus.usable_documents(raw.withColumn("body", F.try_parse_json("t")))
    embedded = corpus.with_embeddings(docs, lambda texts: [[float(len(t))] for t in texts])
    rows = corpus.vector_rows(embedded, "default", F.length("text"))
    state = sinks.latest_vectors(None, rows).collect()
    assert [(r["namespace"], r["id"], r["values"], r["metadata"]) for r in state] == [("default", "k1", [3.0], {"s3_key": "k1"})]


def test_logs(spark, tmp_path):
    path = tmp_path / "log.jsonl"
    path.write_text('{"a":1}\n\n  \n{bad\n {"a":2} \n5\n')
    rows = readers.read_log(spark, str(path)).select(F.try_variant_get("record", "$.a", "int").alias("a")).collect()
    assert [r["a"] for r in rows] == [1, 2, None]
    assert readers.read_log(spark, str(tmp_path / "none.jsonl")).count() == 0


def test_artifacts(spark, tmp_path):
    folder = tmp_path / "f"
    folder.mkdir()
    (folder / "a.txt").write_text('{"n":0}')
    (folder / "c.json").write_text('{"n":2}')
    (folder / "b.json").write_text('{"n":1}')
    number = F.variant_get("record", "$.n", "int").alias("n")
    assert readers.read_artifact(spark, str(folder)).select(number).first()["n"] == 1
    assert readers.read_artifact(spark, str(folder / "c.json")).select(number).first()["n"] == 2
    assert readers.read_artifact(spark, str(tmp_path / "no"), '{"n":9}').select(number).first()["n"] == 9
    with pytest.raises(FileNotFoundError):
        readers.read_artifact(spark, str(tmp_path / "no"))


def test_manifest(spark, tmp_path):
    (tmp_path / "x.json").write_bytes(b"abc")
    (tmp_path / "z.json").write_bytes(b"not asked for")
    required = [("x.json", "s1"), ("y.json", "s2")]
    rows = {r["name"]: r for r in sinks.artifact_manifest(spark, required, str(tmp_path)).collect()}
    assert rows["x.json"]["sha256"] == hashlib.sha256(b"abc").hexdigest() and not rows["x.json"]["missing"]
    assert rows["y.json"]["missing"] and rows["y.json"]["sha256"] is None


def test_manifest_is_by_whole_path(spark, tmp_path):
    for name, body in (("a/x.json", b"1"), ("b/x.json", b"2"), ("y.json", b"3"), ("b c/%z+.json", b"4")):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(body)
    required = [("a/x.json", "s"), ("x.json", "s"), ("c/y.json", "s"), ("y.json", "s"), ("b c/%z+.json", "s")]
    for folder in (str(tmp_path), f"{tmp_path}/", f"file://{tmp_path}"):
        rows = {r["name"]: r["sha256"] for r in sinks.artifact_manifest(spark, required, folder).collect()}
        digest = {n: hashlib.sha256(b).hexdigest() for n, b in (("a/x.json", b"1"), ("y.json", b"3"), ("b c/%z+.json", b"4"))}
        assert rows == {n: digest.get(n) for n, _ in required}


def test_corpus_sync_by_change(spark, tmp_path):
    """Only new and changed files come out; a second run gives none, a failed run is done again."""
    (tmp_path / "clean").mkdir()
    path = str(tmp_path / "manifest")

    def changes():
        now = readers.read_corpus(spark, str(tmp_path), ["clean/"], digests=True)
        return now, {r["s3_key"]: r["change"] for r in readers.corpus_changes(now, readers.read_manifest(spark, path)).collect()}

    assert changes()[1] == {}
    for name in ("a", "b", "c"):
        (tmp_path / "clean" / f"{name}.json").write_text(json.dumps({"text": name}))
    now, found = changes()
    assert found == {f"clean/{n}.json": "new" for n in "abc"} == changes()[1]
    readers.record_manifest(now, path, 1)
    assert changes()[1] == {}
    (tmp_path / "clean" / "a.json").write_text('{"text": "other"}')
    (tmp_path / "clean" / "b.json").rename(tmp_path / "clean" / "d.json")
    now, found = changes()
    assert found == {"clean/a.json": "changed", "clean/b.json": "gone", "clean/d.json": "new"}
    for _ in range(2):
        readers.record_manifest(now, path, 2)
    assert changes()[1] == {} and readers.read_manifest(spark, path).count() == 3


def test_coverage_report(spark, tmp_path):
    checked = spark.createDataFrame([("a", None), ("b", "no evidence mapping")], "id string, reason string")
    sinks.write_report(sinks.coverage_report(checked, "t"), str(tmp_path / "r"))
    rows = sorted((r["section"], json.loads(r["payload"])) for r in spark.read.json(str(tmp_path / "r")).collect())
    assert rows == [
        ("missing", {"control_id": "b", "reason": "no evidence mapping"}),
        ("summary", {"generated_at": "t", "total_controls": 2, "missing_evidence_count": 1}),
    ]


VECTOR = "namespace string, id string, values array<float>, metadata map<string,string>, seq bigint"


def test_upsert_keeps_the_last_write_and_is_idempotent(spark):
    batch = spark.createDataFrame([("n", "a", [1.0], {"k": "1"}, 1), ("n", "a", [2.0], {"k": "2"}, 2), ("m", "a", [3.0], None, 1)]
                                  + [("n", "hot", [float(i)], {}, i) for i in range(200)], VECTOR)
    once = sinks.latest_vectors(None, batch)
    twice = sinks.latest_vectors(once, batch)

    def state(df):
        return {(r["namespace"], r["id"]): (r["values"], r["metadata"], r["seq"]) for r in df.collect()}

    assert state(once) == state(twice) == {
        ("n", "a"): ([2.0], {"k": "2"}, 2), ("m", "a"): ([3.0], None, 1), ("n", "hot"): ([199.0], {}, 199)
    }


def test_decision_log_and_quarantine(spark, tmp_path):
    from sluice.operators import gateway

    df = spark.createDataFrame([(1, "SSN 123-45-6789", "dlp-admin"), (2, "hi", "x")], "id int, prompt string, role string")
    rows = sinks.evidence_rows(gateway.ingress(df, "id"), "request", "id", preview="masked_prompt")
    sinks.append_evidence(rows, str(tmp_path / "log"))
    sinks.append_evidence(rows, str(tmp_path / "log"))
    back = spark.read.parquet(str(tmp_path / "log"))
    assert back.count() == 4 and back.select("decision_id").distinct().count() == 2
    assert {r["content_preview"] for r in back.collect()} == {"SSN [SSN]", "hi"}
    labelled = spark.createDataFrame([(1, "RESTRICTED_PII"), (2, "INTERNAL"), (3, None)], "id int, label string")
    sinks.split_quarantine(labelled, "label", str(tmp_path / "open"), str(tmp_path / "zone"))
    assert [r["id"] for r in spark.read.parquet(str(tmp_path / "zone")).collect()] == [1]
    assert sorted(r["id"] for r in spark.read.parquet(str(tmp_path / "open")).collect()) == [2, 3]


def test_csv_and_document(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b\n1,x\n,y\n")
    assert [tuple(r) for r in readers.read_frame(spark, str(tmp_path / "t.csv"), "a int, b string").collect()] == [(1, "x"), (None, "y")]
    controls = spark.createDataFrame([("C1",), ("C2",)], "id string")
    doc = readers.evidence_document(controls, {"logs": controls}, "2024-01-01T00:00:00Z", "t")
    sinks.write_report(doc, str(tmp_path / "doc"))
    back = spark.read.json(str(tmp_path / "doc"))
    assert {r["section"]: r["n"] for r in back.groupBy("section").agg(F.count("*").alias("n")).collect()} == {
        "run_metadata": 1, "controls": 2, "artifacts.logs": 2
    }


def test_stream_equals_batch(spark, tmp_path):
    texts = ["plain", "SSN 123-45-6789", "mrn 5", "Patient", "routing 123456789"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    df.repartition(3).write.parquet(str(tmp_path / "in"))
    live = streams.prompt_verdicts(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")), "id")
    for _ in range(2):
        streams.write_available(live, str(tmp_path / "out"), "v", checkpoint=str(tmp_path / "cp")).awaitTermination()
    batch = moves.prompt_verdicts(detect.with_hits(df), "id")
    assert sorted(map(str, spark.read.parquet(str(tmp_path / "out")).collect())) == sorted(map(str, batch.collect()))


def test_request_and_log_streams(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.txt").write_text('{"prompt":"SSN 123-45-6789","role":"dlp-admin","user_id":"u"}\n{bad\n{"prompt":""}\n')
    out = streams.ingress(spark.readStream.text(str(folder)).withColumnRenamed("value", "body"), "user_id")
    seen = []
    streams.for_each_batch(out, lambda b: seen.extend(b.select("status", "action", "masked_prompt", "error").collect()), "x", checkpoint=str(tmp_path / "c1")).awaitTermination()
    assert sorted(tuple(r)[:3] for r in seen if r["action"]) == [(200, "mask", "SSN [SSN]")]
    refused = [r for r in seen if r["action"] is None]
    assert [(r["status"], r["masked_prompt"], r["error"] is not None) for r in refused] == [(400, None, True)] * 2
    logs = readers.stream_log(spark, str(folder)).select(F.try_variant_get("record", "$.prompt", "string").alias("p"))
    streams.write_available(logs, str(tmp_path / "logs"), "l", checkpoint=str(tmp_path / "c2")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "logs")).count() == 2

"""Every stage against a plain version, on the shared tables with odd rows and with columns named like the stages' own."""

import math
import re
import tracemalloc
import zlib
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from sluice.llm import files, minmax, packing, quality, tokens, toxicity
from sluice.llm.queries import QUERIES
from tests.llm.test_decontaminate import best

SHARED = "/root/testdata/sf0.001"
CLASHING = ["score", "_text", "_words", "_lines", "_stats", "gone_id", "many", "row", "_kept", "bucket_no", "ids"]
PASSAGE = " ".join(f"passage{i}" for i in range(60))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("tables")
    docs = spark.read.parquet(f"{SHARED}/documents.parquet")
    odd = [
        (None, "null id text with some words in it", "en", None, 0), (90_001, None, None, "s", None), (90_002, "", "en", "s", 0),
        (90_003, "again and again and again, the same row here.", "en", "s", 3), (90_003, "again and again and again, the same row here.", "en", "s", 3),
        (90_003, "another text under the id of others", "en", "s", 3), (90_004, "long words " * 30_000, "en", "s", 1),
        (90_005, "two words", "en", "s", 2), (90_006, "Before it all. " + PASSAGE + " And after it all.", "en", "s", 2), (90_007, "\n \t", None, None, None),
    ]
    rows = spark.createDataFrame(odd, "doc_id long, text string, lang string, source string, n_chars int").select(
        *(F.col(f.name).cast(f.dataType) for f in docs.schema)
    )
    whole = docs.unionByName(rows)
    for k, name in enumerate(CLASHING):
        whole = whole.withColumn(name, F.concat(F.lit(f"{k}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))))
    whole.write.parquet(f"{path}/documents.parquet")
    spark.read.parquet(f"{SHARED}/labels.parquet").write.parquet(f"{path}/labels.parquet")
    items = spark.read.parquet(f"{SHARED}/benchmark.parquet").select("item_id", "text")
    mine = spark.createDataFrame([(900_001, PASSAGE), (900_002, None)], "item_id long, text string").select(*(F.col(f.name).cast(f.dataType) for f in items.schema))
    items.unionByName(mine).write.parquet(f"{path}/benchmark.parquet")
    return str(path)


@pytest.fixture(scope="module")
def inputs(spark, folder):
    """The rows that each stage is given, and those that it returns."""
    docs, found = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, folder)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.schema.names == docs.schema.names and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
            out.write.parquet(f"{folder}/{name}")
            out = spark.read.schema(docs.schema).parquet(f"{folder}/{name}")
        found[name] = (docs, docs.collect(), out.collect())
        docs = out
    return found


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=str)


def test_toxicity_stage(spark, folder, inputs):
    docs, rows, out = inputs["toxicity"]
    grammar = toxicity.fit(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    assert ordered(out) == ordered(r for r in rows if grammar.score(r.text) < 0.5)
    assert 0 < len(out) <= len(rows)  # so few labels teach little


def statistics(text):
    """The statistics of a text by hand."""
    text = text or ""
    words, lines = re.findall(r"[^ \t\n\x0b\f\r]+", text), [x for x in text.split("\n") if x]

    def count(test):
        return sum(map(test, text))

    def share(part, whole):
        return part / whole if whole else 0.0

    def known(c):
        return c.isalpha() or c.isnumeric() or c in " \t\n\x0b\f\r.,;:'\"()-"

    return {
        "log_words": math.log1p(len(words)), "symbols": share(count(lambda c: not known(c)), len(text)), "capitals": share(count(str.isupper), len(text)),
        "digits": share(count(str.isdecimal), len(text)), "ends": share(len(re.findall(r"[.!?](?=[ \t\n\x0b\f\r]|$)", text)), len(words)),
        "word_length": share(len(text), len(words)), "distinct_words": share(len(set(words)), len(words)), "distinct_lines": share(len(set(lines)), len(lines)),
        "words_a_line": share(len(words), len(lines)), "short_words": share(sum(len(w) <= 2 for w in words), len(words)),
    }


def by_hand(model, text):
    stats, z = statistics(text), model.intercept
    for rule, weight in model.rules:
        z += weight * all(stats[n] <= b if sign == "<=" else stats[n] > b for n, sign, b in rule)
    return 1 / (1 + math.exp(-z))


def test_quality_stage(spark, folder, inputs):
    docs, rows, out = inputs["quality"]
    model = quality.fit(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    assert model.rules
    scores = [by_hand(model, r.text) for r in rows]
    got = {r.doc_id: r for r in quality.scored(docs, model).collect()}
    assert all(got[r.doc_id]["score"] == r["score"] for r in rows)  # a column of the rows' own
    assert all(got[r.doc_id]["_score"] == pytest.approx(s) for r, s in zip(rows, scores) if r.doc_id != 90_003)
    assert ordered(out) == ordered(r for r, s in zip(rows, scores) if s >= 0.3)
    assert 0 < len(out) < len(rows)


def test_quality_patterns_run_once(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = quality.fit(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    once = quality.with_statistics(docs.select("doc_id", "text"))

    def counts(df):
        plan = df._jdf.queryExecution().executedPlan().toString()
        return plan.count("regexp_count("), plan.count("split(")

    assert counts(quality.kept(docs, model)) == counts(once)


def shingles(text):
    words = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", words)
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def classes(rows):
    """The least id that each id is linked with, over all pairs of rows."""
    sets = [(r.doc_id, shingles(r.text)) for r in rows if r.doc_id is not None]
    least = {d: d for d, _ in sets}

    def find(d):
        while least[d] != d:
            d = least[d]
        return d

    for (a, x), (b, y) in combinations(sets, 2):
        if x and y and 100 * len(x & y) >= 75 * len(x | y):
            low, high = sorted((find(a), find(b)))
            least[high] = low
    return {d: find(d) for d in least}


def test_near_duplicates_stage(inputs):
    _, rows, out = inputs["near_duplicates"]
    root = classes(rows)
    stay = [r for r in rows if r.doc_id is None]
    for d in sorted({r.doc_id for r in rows if r.doc_id is not None and root[r.doc_id] == r.doc_id}):
        stay.append(min((r for r in rows if r.doc_id == d), key=lambda r: r.text or ""))
    assert ordered(out) == ordered(stay) and len(out) < len(rows)


def test_op10_query(spark):
    rows = spark.read.parquet(f"{SHARED}/documents.parquet").collect()
    root = classes(rows)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in QUERIES["op10_min_max_dedup"](spark, SHARED).collect()}
    assert got == {r.doc_id: (len(shingles(r.text)), root[r.doc_id], root[r.doc_id] == r.doc_id) for r in rows}


def test_op2_query(spark):
    docs, marks = (spark.read.parquet(f"{SHARED}/{n}.parquet") for n in ("documents", "labels"))
    model = quality.fit(docs, marks)
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in QUERIES["op2_quality_rules"](spark, SHARED).collect():
        score = by_hand(model, texts[r.doc_id])
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert r.score == pytest.approx(score) and (r.predicted == (score >= 0.3) or abs(score - 0.3) < 1e-9)


def test_decontamination_stage(spark, folder, inputs):
    _, rows, out = inputs["decontamination"]
    items = [r.text or "" for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    grams = [shingles(t) for t in items]
    kept = []
    for r in rows:
        own = shingles(r.text)
        held = any(own & g and best(r.text or "", t)[0] >= 0.75 for t, g in zip(items, grams) if t)
        if not held:
            kept.append(r)
    assert ordered(out) == ordered(kept)
    assert not any(PASSAGE in (r.text or "") for r in out) and any(PASSAGE in (r.text or "") for r in rows)


def check_pieces(rows, texts):
    """Pieces cover every document's ids once, and sequences have no gaps."""
    whole = Tokenizer.from_file(tokens.tokenizer_path())
    whole.encode_special_tokens = True
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for doc_id, text in texts.items():
        ids = np.array([*whole.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        at = 0
        for r in sorted(pieces.pop(doc_id), key=lambda r: r.start):
            crc = r.ids_crc32 if "ids_crc32" in r else zlib.crc32(r.ids)
            assert (r.start, r.doc_tokens, crc) == (at, len(ids), zlib.crc32(ids[at : at + r.length].tobytes()))
            at += r.length
        assert at == len(ids)
    assert not pieces
    for parts in sequences.values():
        assert [o for o, _ in sorted(parts)] == [0, *np.cumsum([n for _, n in sorted(parts)])[:-1]] and sum(n for _, n in parts) <= packing.CAPACITY


def test_packing_stage_and_op3_query(spark, inputs):
    _, rows, out = inputs["packing"]
    assert len({r.doc_id for r in rows}) == len(rows)
    check_pieces(out, {r.doc_id: r.text for r in rows})
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SHARED}/documents.parquet").collect()}
    check_pieces(QUERIES["op3_packing"](spark, SHARED).collect(), texts)


def test_op4_query(spark):
    whole = Tokenizer.from_file(tokens.tokenizer_path())
    whole.encode_special_tokens = True
    start, want = 0, []
    for r in spark.read.parquet(f"{SHARED}/documents.parquet").orderBy("doc_id").collect():
        ids = np.array([*whole.encode(r.text or "", add_special_tokens=False).ids, 2], "<u4")
        want.append((r.doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(tuple(r) for r in QUERIES["op4_token_codes"](spark, SHARED).collect()) == want


def test_run_and_empty_tables(spark, folder, tmp_path):
    assert corpus_pipeline.run(spark, folder).count() > 0
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_signatures_take_little_memory(spark):
    """Working memory of the scan does not grow with the batch, and what Spark sends at once is bounded by bytes."""
    texts = [" ".join(f"w{i}x{k}" for k in range(700)) for i in range(1200)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["doc_id", "text"])
    run, kind = minmax._scan(True)
    tracemalloc.start()
    try:
        rows = sum(made.num_rows for made in run(iter([batch])))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert rows == len(texts) and peak < 40 << 20

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], names=["n", "size"])

    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").coalesce(1)
    before = spark.conf.get(files.BATCH_BYTES)
    met = files.written(docs.mapInArrow(sizes, "n long, size long"), "sizes", batch_bytes=1 << 20).collect()
    assert spark.conf.get(files.BATCH_BYTES) == before
    assert sum(r.n for r in met) == len(texts) and max(r.size for r in met) < 3 << 20 and len(met) > 3

"""The numbered queries over the shared tables: each applies its operator with production parameters."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import sha256

import pyarrow as pa
import pyspark.sql.functions as F
from pyspark.sql import DataFrame, SparkSession

from sluice.llm import bpe, chat, codes, decontaminate, fingerprints, html, infill, minmax, packing, quality, spelling, toxicity, warc
from sluice.llm.labels import held_out

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(run):
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return run

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


@query("op3_packing")
def op3_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.pack(table(spark, folder, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query("op4_token_codes")
def op4_token_codes(spark: SparkSession, folder: str) -> DataFrame:
    return codes.read(*codes.write(table(spark, folder, "documents")))


@query(
    "op9_warc",
    """
    WITH p AS (SELECT page_id, COALESCE(html, '') AS html FROM pages),
    d AS (SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes, sha256(html) AS payload_digest FROM p),
    f AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN MIN(page_id) OVER (PARTITION BY payload_digest) END AS original FROM d)
    SELECT page_id, payload_bytes, payload_digest,
        CASE WHEN original <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
        CASE WHEN original <> page_id THEN original END AS refers_to
    FROM f
    """,
)
def op9_warc(spark: SparkSession, folder: str) -> DataFrame:
    records = warc.read(*warc.write(table(spark, folder, "pages")), payloads=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op10_min_max_dedup")
def op10_min_max_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return minmax.link_classes(table(spark, folder, "documents"))


@query("op5_fingerprints")
def op5_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    compared = fingerprints.compare_edits(fingerprints.with_next(docs), fingerprints.entropy_ranks(docs))
    return compared.withColumn("edited_sha256", F.sha2("edited", 256)).drop("edited")


@query("op8_main_text")
def op8_main_text(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    return html.extract(pages, html.fit(pages)).withColumn("n_chars", F.char_length("text").cast("long"))


ODD_TURNS = [(-7, 0, "user", r"\### Assistant: </turn> ok"), (-7, 1, "assistant", r"\### Assistant: </turn> ok")]


@query(
    "op1_chat_format",
    r"""
    WITH rows AS (
        SELECT conv_id, turn, COALESCE(role, '') AS role, COALESCE(text, '') AS text FROM conversations
        UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
        UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
    escaped AS (
        SELECT *, replace(replace(replace(text, '\', '\\'), '<turn:', '\<turn:'), '</turn>', '\</turn>') AS body,
            replace(replace(replace(role, '\', '\\'), '>', '\>'), chr(10), '\' || chr(10)) AS head FROM rows)
    SELECT conv_id, COUNT(*)::BIGINT AS n_turns,
        sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
        COALESCE(SUM(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
        sha256(COALESCE(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
        SUM(length(head) + length(body) + 17)::BIGINT AS formatted_chars
    FROM escaped GROUP BY conv_id
    """,
)
def op1_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    odd = spark.createDataFrame(ODD_TURNS, turns.schema)
    made = chat.format_best(chat.linear(turns.unionByName(odd)))

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                whole = row["formatted"]
                back = chat.parse_turns(whole)
                learned = "".join(chat.unescape(whole[s["start"] : s["start"] + s["length"]]) for s in row["loss_spans"])
                every = "".join(f"{role}\n{text}\n" for role, text in back)
                rows.append((row["tree_id"], len(back), sha256(every.encode()).hexdigest(), len(learned), sha256(learned.encode()).hexdigest(), len(whole)))
            names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=names)

    kind = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return made.select("tree_id", "formatted", "loss_spans").mapInArrow(digests, kind)


@query("op2_quality_rules")
def op2_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return _judged(quality.scored(docs, quality.fit(docs, table(spark, folder, "labels"))), quality.THRESHOLD)


@query("op6_toxicity_grammar")
def op6_toxicity_grammar(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return _judged(toxicity.scored(docs, toxicity.fit(docs, table(spark, folder, "labels"))), toxicity.THRESHOLD)


def _judged(scored: DataFrame, threshold: float) -> DataFrame:
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


@query("op7_decontamination")
def op7_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.matches(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op13_byte_bpe")
def op13_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.digests(bpe.encode(table(spark, folder, "documents")))


@query(
    "op11_spelling_variants",
    r"""
    WITH RECURSIVE bits AS (
        SELECT i, 0 AS k, i::UBIGINT AS v FROM range(256) r(i)
        UNION ALL SELECT i, k + 1, CASE WHEN v % 2 = 1 THEN xor(v >> 1, 3988292384::UBIGINT) ELSE v >> 1 END FROM bits WHERE k < 8),
    crcs AS (SELECT list(v ORDER BY i) AS tab FROM bits WHERE k = 8),
    runs AS (
        SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, COUNT(*) AS m
        FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]{7,}')) AS run FROM documents) GROUP BY ALL),
    codes AS (SELECT *, hex(encode(concat(COALESCE(doc_id::VARCHAR, ''), ':', run))) AS x FROM runs),
    hashed AS (
        SELECT run, m, xor(4294967295::UBIGINT, list_reduce(
            list_transform(range(0, length(x), 2), lambda i: ('0x' || x[i + 1:i + 2])::UBIGINT),
            lambda a, b: xor(a >> 8, tab[(xor(a, b) & 255)::BIGINT + 1]), 4294967295::UBIGINT)) AS h FROM codes, crcs),
    named AS (
        SELECT CASE WHEN h % 31 = 0 THEN concat(left(run, (h % length(run))::BIGINT), substr(run, (h % length(run))::BIGINT + 2)) ELSE run END AS word, m FROM hashed),
    words AS (SELECT word, SUM(m)::BIGINT AS n FROM named WHERE length(word) >= 7 GROUP BY word HAVING SUM(m) >= 2),
    less AS (SELECT DISTINCT word, n, k, concat(left(word, k), substr(word, k + 2)) AS rest FROM words, unnest(range(length(word))) u(k)),
    pairs AS (
        SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM less a JOIN less b ON a.rest = b.rest AND a.k = b.k AND a.word <> b.word
        UNION SELECT a.word, a.n, w.word, w.n FROM less a JOIN words w ON a.rest = w.word
        UNION SELECT w.word, w.n, a.word, a.n FROM less a JOIN words w ON a.rest = w.word),
    ranked AS (SELECT *, COUNT(*) OVER (PARTITION BY word) AS n_near, row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) AS r FROM pairs),
    formed AS (
        SELECT w.word, w.n, COALESCE(p.n_near, 0)::BIGINT AS n_near, CASE WHEN near_n >= 10 * w.n THEN near END AS form,
            CASE WHEN near_n >= 10 * w.n THEN near_n END AS form_n FROM words w LEFT JOIN ranked p ON p.word = w.word AND p.r = 1),
    paths AS (
        SELECT word, form AS root, 1 AS d FROM formed WHERE form IS NOT NULL
        UNION ALL SELECT p.word, f.form, d + 1 FROM paths p JOIN formed f ON f.word = p.root WHERE f.form IS NOT NULL),
    ends AS (SELECT word, arg_max(root, d) AS root FROM paths GROUP BY word)
    SELECT word, n, n_near, form, form_n, COALESCE(root, word) AS root FROM formed LEFT JOIN ends USING (word)
    """,
)
def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(spelling.vocabulary(table(spark, folder, "documents")))


@query(
    "op12_fill_in_middle",
    r"""
    WITH t AS (
        SELECT doc_id, COALESCE(text, '') AS text, regexp_extract_all(COALESCE(text, ''), '[^\n]*\n|[^\n]+') AS units,
            sha256(concat('7:', doc_id::VARCHAR)) AS h FROM documents),
    d AS (
        SELECT *, len(units)::BIGINT AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2, ('0x' || h[17:24])::BIGINT AS h3,
            ('0x' || h[25:32])::BIGINT AS h4 FROM t),
    f AS (
        SELECT *, CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 100 THEN 'plain'
            WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form, least(h1 % (n + 1), h2 % (n + 1)) AS low, greatest(h1 % (n + 1), h2 % (n + 1)) AS high FROM d),
    p AS (
        SELECT *, array_to_string(units[1:low], '') AS prefix, array_to_string(units[low + 1:high], '') AS middle,
            array_to_string(units[high + 1:n], '') AS suffix FROM f)
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix)::BIGINT END AS prefix_chars,
        CASE WHEN form <> 'plain' THEN length(middle)::BIGINT END AS middle_chars,
        sha256(CASE form WHEN 'plain' THEN text WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle
            ELSE '<P>' || prefix || '<S>' || suffix || '<M>' || middle END) AS output_sha256,
        sha256(CASE form WHEN 'plain' THEN text ELSE prefix || middle || suffix END) AS restored_sha256
    FROM p
    """,
)
def op12_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    return infill.digests(*infill.store(table(spark, folder, "documents")))

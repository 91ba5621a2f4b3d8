"""Corpus and vector queries over documents and embeddings."""

from __future__ import annotations

from pyspark.sql import functions as F

from sluice.functions.patterns import SPACE_CHARS
from sluice.operators import corpus, moves, retrieval
from sluice.plans import triggers as T
from sluice.operators.tables import fixed_table
from sluice.plans.registry import query, table
from sluice.plans.text_queries import SQL_STATE, scanned_documents
from sluice.sources import sinks

DIM = 64

_RECORD_SHAPE = """CASE doc_id % 9
  WHEN 0 THEN to_json(named_struct('id', concat('d', doc_id), 'text', text))
  WHEN 1 THEN to_json(named_struct('text', '   ', 'body', text))
  WHEN 2 THEN to_json(named_struct('content', 5, 'question', 'why?', 'answer', text))
  WHEN 3 THEN to_json(named_struct('prompt', text))
  WHEN 4 THEN '{"note":"x","text":null}'
  WHEN 5 THEN concat('{not json ', doc_id)
  WHEN 6 THEN to_json(named_struct('id', doc_id, 'text', text, 'metadata', named_struct('s3_key', 'mine', 'lang', lang)))
  WHEN 7 THEN to_json(named_struct('question', 7, 'prompt', text, 'answer', 'a'))
  ELSE to_json(named_struct('question', '', 'prompt', 'p', 'response', text, 'metadata', named_struct('lang', lang))) END"""
_KEY = "concat('clean/doc_', doc_id, '.json')"


@query(
    "corpus_text",
    f"""WITH r AS (SELECT doc_id AS n, lang, text, {_KEY} AS key, trim(text, '{SPACE_CHARS}') AS t FROM documents),
      c AS (SELECT *, CASE n % 9 WHEN 0 THEN t WHEN 1 THEN t WHEN 6 THEN t WHEN 3 THEN CASE WHEN t <> '' THEN text END
        WHEN 2 THEN 'why?' || CASE WHEN t <> '' THEN chr(10) || chr(10) || text ELSE '' END WHEN 7 THEN 'a'
        WHEN 8 THEN 'p' || CASE WHEN t <> '' THEN chr(10) || chr(10) || text ELSE '' END END AS chosen FROM r)
    SELECT CASE n % 9 WHEN 0 THEN 'd' || n WHEN 6 THEN CASE WHEN n = 0 THEN key ELSE n::VARCHAR END ELSE key END AS doc_id,
      chosen AS text, CASE WHEN n % 9 = 6 THEN 'mine' ELSE key END AS s3_key,
      CASE WHEN n % 9 IN (6, 8) THEN lang END AS lang
    FROM c WHERE chosen IS NOT NULL AND chosen <> ''""",
)
def corpus_text(spark, folder):
    raw = table(spark, folder, "documents").select(
        F.expr(_KEY).alias("s3_key"), F.try_parse_json(F.expr(_RECORD_SHAPE)).alias("body")
    )
    docs = corpus.usable_documents(raw)
    return docs.select(
        "doc_id", "text", F.element_at("metadata", F.lit("s3_key")).alias("s3_key"),
        F.element_at("metadata", F.lit("lang")).alias("lang"),
    )


@query(
    "corpus_upsert",
    """SELECT 'ns' || (vec_id % 3) AS namespace, 'v' || (vec_id % 100) AS id, max(vec_id) AS seq,
      arg_max(label, vec_id) AS label, round(arg_max(embedding, vec_id)[1]::DOUBLE, 6) AS first_value
    FROM embeddings GROUP BY 1, 2""",
)
def corpus_upsert(spark, folder):
    writes = table(spark, folder, "embeddings").select(
        F.expr("concat('ns', vec_id % 3)").alias("namespace"), F.expr("concat('v', vec_id % 100)").alias("id"),
        F.col("vec_id").alias("seq"), "label", F.col("embedding").alias("values"),
    )
    early, late = writes.where("label < 5"), writes.where("label >= 5")
    state = sinks.latest_vectors(early, late)
    return state.select(
        "namespace", "id", "seq", "label", F.round(F.col("values")[0].cast("double"), 6).alias("first_value")
    )


@query(
    "vector_shape",
    """SELECT vec_id AS id, (CASE WHEN vec_id % 11 = 0 THEN 63 WHEN vec_id % 11 = 1 THEN 0 END)::INTEGER AS n_dims
    FROM embeddings WHERE vec_id % 11 IN (0, 1)""",
)
def vector_shape(spark, folder):
    vectors = table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("id"),
        F.when(F.expr("vec_id % 11 = 0"), F.slice("embedding", 1, DIM - 1))
        .when(F.expr("vec_id % 11 = 1"), None).otherwise(F.col("embedding")).alias("values"),
    )
    return retrieval.wrong_shape(vectors, DIM).select("id", "n_dims")


def index(spark, folder):
    return table(spark, folder, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("values"))


def asked(vectors):
    return vectors.select(F.col("id").alias("query_id"), "values")


def _sql_matches(k: int, query_filter: str = "", vector_filter: str = "") -> str:
    return f"""sims AS (SELECT q.vec_id AS query_id, v.vec_id AS id,
        round(list_cosine_similarity(q.embedding::DOUBLE[], v.embedding::DOUBLE[]), 9) AS score
        FROM embeddings q, embeddings v WHERE true {query_filter} {vector_filter}),
      matches AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank, id, score
        FROM sims QUALIFY rank <= {k})"""


@query(
    "topk_matches",
    f"""WITH {_sql_matches(5)} SELECT query_id, rank::INTEGER AS rank, id, round(score, 6) AS score FROM matches""",
)
def topk_matches(spark, folder):
    vectors = index(spark, folder)
    found = retrieval.top_k(vectors, asked(vectors), 5, DIM)
    return found.withColumn("score", F.round("score", 6))


PREFIXES = {"ingest": ["clean/"]}
_PREFIX = "CASE WHEN vec_id % 3 = 0 THEN 'sensitive/' ELSE 'clean/' END"


@query(
    "gated_matches",
    T.sql_docs(
        f""", passed AS (SELECT doc_id FROM hits WHERE {SQL_STATE} = 'INTERNAL'),
    {_sql_matches(3, "AND q.vec_id IN (SELECT doc_id FROM passed)", "AND v.vec_id % 3 <> 0")}"""
    )
    + " SELECT query_id, rank::INTEGER AS rank, id, round(score, 6) AS score FROM matches",
)
def gated_matches(spark, folder):
    verdicts = moves.prompt_verdicts(scanned_documents(spark, folder), "doc_id").select(
        F.col("doc_id").alias("query_id"), "blocked"
    )
    stored = table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("values"), F.expr(_PREFIX).alias("prefix")
    )
    queries = retrieval.only_allowed(asked(stored), verdicts, "query_id")
    found = retrieval.top_k(retrieval.readable(stored, "ingest", PREFIXES), queries, 3, DIM)
    return found.withColumn("score", F.round("score", 6))


_LOCKS = [
    ("ingest", "clean/", True), ("ingest", "clean/src1", False), ("ingest", "clean/src11/", True), ("audit", "", True), ("audit", "sensitive/", False),
    ("audit", "sensitive/src2/en", True), ("guest", "clean/src3/de/", True), ("ghost", "none/", True), ("twice", "clean/", True), ("twice", "clean/", False),
]
_ROLES = ["ingest", "audit", "guest", "ghost", "twice", "admin"]


@query(
    "prefix_acl",
    f"""WITH locks(role, prefix, allow) AS (VALUES {', '.join(f"('{r}', '{p}', {str(a).lower()})" for r, p, a in _LOCKS)}
      UNION ALL SELECT 'n' || n_nationkey, 'clean/src' || (n_nationkey % 7), n_nationkey % 2 = 0 FROM nation),
    roles AS (SELECT unnest({_ROLES}) AS role UNION ALL SELECT 'n' || n_nationkey FROM nation),
    d AS (SELECT DISTINCT CASE WHEN doc_id % 3 = 0 THEN 'sensitive/' ELSE 'clean/' END || source || '/' || lang || '/' AS path FROM documents),
    m AS (SELECT d.path, r.role, l.prefix, bool_and(l.allow) AS allow FROM d, roles r JOIN locks l ON l.role = r.role WHERE starts_with(d.path, l.prefix) GROUP BY ALL),
    b AS (SELECT *, row_number() OVER (PARTITION BY path, role ORDER BY length(prefix) DESC) AS place FROM m)
    SELECT d.path, r.role, prefix AS lock, coalesce(allow, r.role NOT IN (SELECT role FROM locks)) AS allowed
    FROM d CROSS JOIN roles r LEFT JOIN b ON b.path = d.path AND b.role = r.role AND place = 1""",
)
def prefix_acl(spark, folder):
    """Every role's access to the folders of the documents: nested locks, locks of each nation, a role without any."""
    nations = table(spark, folder, "nation")
    locks = fixed_table(spark, _LOCKS, "role string, prefix string, allow boolean").unionByName(
        nations.select(
            F.expr("concat('n', n_nationkey)").alias("role"), F.expr("concat('clean/src', n_nationkey % 7)").alias("prefix"),
            F.expr("n_nationkey % 2 = 0").alias("allow"),
        )
    )
    roles = fixed_table(spark, [(r,) for r in _ROLES], "role string").unionByName(nations.select(F.expr("concat('n', n_nationkey)").alias("role")))
    listed = roles.agg(F.collect_list("role")).scalar()  # few: the fixed ones and a role per nation
    paths = table(spark, folder, "documents").select(
        F.expr("concat(CASE WHEN doc_id % 3 = 0 THEN 'sensitive/' ELSE 'clean/' END, source, '/', lang, '/')").alias("path")
    ).distinct()
    requests = paths.withColumn("roles", listed).select("path", F.explode("roles").alias("role"))
    return retrieval.prefix_access(requests, locks).select("path", "role", "lock", "allowed")


_SQL_META = """meta AS (SELECT doc_id AS id, CASE WHEN doc_id % 4 <> 0 THEN text END AS m_text,
    CASE WHEN doc_id % 5 = 0 THEN '' WHEN doc_id % 5 = 1 THEN text END AS m_content,
    CASE WHEN doc_id % 8 = 0 THEN 'chunk ' || doc_id END AS m_chunk,
    CASE WHEN doc_id % 3 = 0 THEN 'Title ' || doc_id END AS m_title, CASE WHEN doc_id % 3 = 1 THEN source END AS m_technique,
    CASE WHEN doc_id % 2 = 0 THEN lang END AS m_tactic, CASE WHEN doc_id % 7 = 0 THEN 'about ' || source END AS m_summary
    FROM documents)"""


def vectors_with_metadata(spark, folder):
    def entry(name, value):
        return F.struct(F.lit(name).alias("key"), value.alias("value"))

    fields = {
        "text": "CASE WHEN doc_id % 4 <> 0 THEN text END",
        "content": "CASE WHEN doc_id % 5 = 0 THEN '' WHEN doc_id % 5 = 1 THEN text END",
        "chunk": "CASE WHEN doc_id % 8 = 0 THEN concat('chunk ', doc_id) END",
        "title": "CASE WHEN doc_id % 3 = 0 THEN concat('Title ', doc_id) END",
        "technique": "CASE WHEN doc_id % 3 = 1 THEN source END",
        "tactic": "CASE WHEN doc_id % 2 = 0 THEN lang END",
        "summary": "CASE WHEN doc_id % 7 = 0 THEN concat('about ', source) END",
    }
    entries = F.filter(
        F.array(*[entry(name, F.expr(text)) for name, text in fields.items()]), lambda e: e["value"].isNotNull()
    )
    return table(spark, folder, "documents").select(
        F.col("doc_id").alias("id"), F.map_from_entries(entries).alias("metadata")
    )


def described_matches(spark, folder, k):
    vectors = index(spark, folder)
    found = retrieval.top_k(vectors, asked(vectors), k, DIM)
    return retrieval.with_metadata(found, vectors_with_metadata(spark, folder))


@query(
    "gateway_context",
    f"""WITH {_sql_matches(3)}, {_SQL_META}
    SELECT query_id, coalesce(string_agg(nullif(m_text, ''), chr(10) || '---' || chr(10) ORDER BY rank), '') AS context
    FROM matches LEFT JOIN meta USING (id) GROUP BY 1""",
)
def gateway_context(spark, folder):
    return retrieval.gateway_context(described_matches(spark, folder, 3))


@query(
    "answer_context",
    f"""WITH {_sql_matches(5)}, {_SQL_META},
    t AS (SELECT query_id, rank, coalesce(nullif(m_content, ''), nullif(m_text, ''), m_chunk) AS txt FROM matches LEFT JOIN meta USING (id)),
    f AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY rank) AS place FROM t WHERE txt IS NOT NULL)
    SELECT query_id, string_agg(txt, chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY rank) AS context
    FROM f WHERE place <= 3 GROUP BY 1""",
)
def answer_context(spark, folder):
    return retrieval.answer_context(described_matches(spark, folder, 5))


@query(
    "explanations",
    f"""WITH {_sql_matches(5)}, {_SQL_META},
    b AS (SELECT query_id, rank, 'ID: ' || id || chr(10) || 'Score: ' || printf('%.3f', score) || chr(10) ||
      'Title: ' || coalesce(m_title, m_technique, id::VARCHAR) || chr(10) ||
      CASE WHEN m_tactic IS NOT NULL THEN 'Tactic: ' || m_tactic || chr(10) ELSE '' END ||
      CASE WHEN m_summary IS NOT NULL THEN 'Description: ' || m_summary || chr(10) ELSE '' END AS block
      FROM matches LEFT JOIN meta USING (id))
    SELECT query_id, string_agg(block, chr(10) || chr(10) ORDER BY rank) AS explanation FROM b GROUP BY 1""",
)
def explanations(spark, folder):
    return retrieval.explanations(described_matches(spark, folder, 5))

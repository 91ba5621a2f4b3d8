import numpy as np
import pytest

from sluice.operators import clustered
from sluice.operators import retrieval as R

DIM = 4


def brute(vectors, queries, k):
    out = set()
    for qid, q in queries:
        scored = []
        for vid, v in vectors:
            nq, nv = np.linalg.norm(q), np.linalg.norm(v)
            score = None if nq == 0 or nv == 0 else round(float(np.dot(q, v) / (nq * nv)), 9)
            scored.append((score is None, -(score or 0.0), vid, score))
        for rank, (_, _, vid, score) in enumerate(sorted(scored)[:k], start=1):
            out.add((qid, rank, vid, None if score is None else round(score, 6)))
    return out


def data(ids):
    rng = np.random.default_rng(1)
    vecs = [rng.integers(-2, 3, DIM).astype(float).tolist() for _ in range(120)]
    vecs += [[1.0, 0.0, 0.0, 0.0]] * 60 + [[0.0] * DIM] * 5
    vectors = [(ids(i), v) for i, v in enumerate(vecs)]
    queries = [(i, rng.integers(-2, 3, DIM).astype(float).tolist()) for i in range(20)] + [(99, [0.0] * DIM), (98, [1.0, 0.0, 0.0, 0.0])]
    return vectors, queries


@pytest.mark.parametrize("id_type,ids", [("bigint", int), ("string", lambda i: f"v{i:03d}")])
@pytest.mark.parametrize("sizes", [{}, {"cell_bytes": 256}, {"cluster_rows": 5}, {"cell_bytes": 64, "cluster_rows": 1}])
def test_top_k_is_exact(spark, id_type, ids, sizes):
    """A third of the vectors are equal and some are zero; all sizes of clusters and cells give the brute-force rows."""
    vectors, queries = data(ids)
    v = spark.createDataFrame([*vectors, (ids(500), [1.0])], f"id {id_type}, values array<float>").repartition(5)
    q = spark.createDataFrame([*queries, (77, [1.0, 2.0])], "query_id bigint, values array<float>")
    out = R.top_k(v, q, 5, DIM, **sizes).collect()
    got = {(r["query_id"], r["rank"], r["id"], None if r["score"] is None else round(r["score"], 6)) for r in out}
    assert got == brute(vectors, queries, 5) and len(out) == len(got)


def test_fewer_vectors_than_k_and_none(spark):
    v = spark.createDataFrame([(1, [1.0, 0.0])], "id bigint, values array<float>")
    q = spark.createDataFrame([(7, [1.0, 1.0])], "query_id bigint, values array<float>")
    assert [(r["rank"], r["id"]) for r in R.top_k(v, q, 5, 2).collect()] == [(1, 1)]
    assert R.top_k(v.where("id > 1"), q, 5, 2).count() == 0
    assert R.top_k(v, q.where("query_id > 7"), 5, 2).count() == 0


def test_search_shuffles_each_vector_once_and_survivors(spark):
    v = spark.createDataFrame([(1, [1.0, 0.0])], "id bigint, values array<float>")
    q = spark.createDataFrame([(7, [1.0, 1.0])], "query_id bigint, values array<float>")
    plan = R.top_k(v, q, 5, 2)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and plan.count("Exchange") == 2


def test_gate_and_prefix_lock(spark):
    q = spark.createDataFrame([(1, [1.0]), (2, [1.0]), (3, [1.0])], "query_id bigint, values array<float>")
    verdicts = spark.createDataFrame([(1, False), (2, True)], "query_id bigint, blocked boolean")
    assert [r["query_id"] for r in R.only_allowed(q, verdicts, "query_id").collect()] == [1]
    v = spark.createDataFrame([("clean/a",), ("sensitive/b",)], "prefix string")
    assert [r[0] for r in R.readable(v, "ingest", {"ingest": ["clean/"]}).collect()] == ["clean/a"]
    assert R.readable(v, "admin", {"ingest": ["clean/"]}).count() == 2


def test_wrong_shape(spark):
    v = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0]), (3, None)], "id int, values array<float>")
    assert {(r["id"], r["n_dims"]) for r in R.wrong_shape(v, 2).collect()} == {(2, 1), (3, 0)}


def test_contexts(spark):
    rows = [(1, 1, "a", 0.5, {"text": "T1", "title": "One"}), (1, 2, "b", 0.25, {"text": "", "chunk": "C2", "tactic": "x"}),
            (1, 3, "c", 0.1, {"content": "K3", "text": "T3", "summary": "s"}), (1, 4, "d", None, {"text": "T4"}), (2, 1, "e", 0.0, {})]
    m = spark.createDataFrame(rows, "query_id int, rank int, id string, score double, metadata map<string,string>")
    assert {r[0]: r[1] for r in R.gateway_context(m).collect()} == {1: "T1\n---\nT3\n---\nT4", 2: ""}
    assert {r[0]: r[1] for r in R.answer_context(m).collect()} == {1: "T1\n\n---\n\nC2\n\n---\n\nK3"}
    text = {r[0]: r[1] for r in R.explanations(m.where("rank < 4")).collect()}
    assert text[1] == ("ID: a\nScore: 0.500\nTitle: One\n\n\nID: b\nScore: 0.250\nTitle: b\nTactic: x\n\n\n"
                       "ID: c\nScore: 0.100\nTitle: c\nDescription: s\n")


def test_far_clusters_are_not_met(spark, monkeypatch):
    """Vectors around few directions: a question meets its own cluster alone, and no more rows are dealt for more blocks."""
    rng = np.random.default_rng(3)
    centres = np.eye(16)[:8] * 10
    vectors = [(i, (centres[i % 8] + rng.normal(0, 0.05, 16)).tolist()) for i in range(800)]
    queries = [(i, (centres[i % 8] + rng.normal(0, 0.05, 16)).tolist()) for i in range(64)]
    v = spark.createDataFrame(vectors, "id bigint, values array<double>")
    q = spark.createDataFrame(queries, "query_id bigint, values array<double>")
    placed = []
    real = clustered._placed
    monkeypatch.setattr(clustered, "_placed", lambda *a: placed.append(real(*a)) or placed[-1])
    index = clustered.build(v, 16, 100)
    assert len(index.clusters.sizes) == 8 and index.clusters.sizes.sum() == 800 and index.clusters.radii.max() < 0.2
    out = clustered.top_k(index, q, 5).collect()
    got = {(r["query_id"], r["rank"], r["id"], round(r["score"], 6)) for r in out}
    assert got == brute([(i, np.array(x)) for i, x in vectors], [(i, np.array(x)) for i, x in queries], 5)
    assert [p.count() for p in placed] == [64, 0]


def test_an_index_is_searched_again(spark):
    vectors, queries = data(int)
    index = clustered.build(spark.createDataFrame(vectors, "id bigint, values array<float>"), DIM, 20)
    q = spark.createDataFrame(queries, "query_id bigint, values array<float>")
    for part, k in ((queries[:7], 3), (queries[7:], 200)):
        out = clustered.top_k(index, spark.createDataFrame(part, q.schema), k, 512).collect()
        got = {(r["query_id"], r["rank"], r["id"], None if r["score"] is None else round(r["score"], 6)) for r in out}
        assert got == brute(vectors, part, k)


def test_prefix_access(spark):
    locks = spark.createDataFrame([
        ("in", "a/", True), ("in", "a/b/", False), ("in", "a/b/c", True), ("all", "", True), ("all", "x", False), ("two", "a/", True), ("two", "a/", False),
        ("nul", "a/", None), (None, "a/", True), ("nop", None, True),
    ], "role string, prefix string, allow boolean")
    paths = ["a/1", "a/b/1", "a/b/cd", "b", "", "x/a/", None, "\u00e9"]
    roles = ["in", "all", "two", "nul", "free", "nop", None]
    requests = spark.createDataFrame([(r, p, "own") for r in roles for p in paths] * 2, "role string, path string, lock string")
    out = R.prefix_access(requests, locks)
    assert out.columns == ["role", "path", "lock", "_lock", "allowed"]
    rules = {"in": [("a/", True), ("a/b/", False), ("a/b/c", True)], "all": [("", True), ("x", False)], "two": [("a/", False)], "nul": [("a/", False)]}

    def plain(r, p):
        if r is None or p is None:
            return None, False
        met = [x for x in rules.get(r, []) if p.startswith(x[0])]
        return max(met, key=lambda x: len(x[0])) if met else (None, r not in rules)

    got = [((r.role, r.path), (r._lock, r.allowed)) for r in out.collect()]
    assert len(got) == 2 * len(roles) * len(paths) and all(v == plain(*k) for k, v in got) and {r.lock for r in out.collect()} == {"own"}

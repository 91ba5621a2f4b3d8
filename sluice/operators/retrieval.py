"""Exact top-k cosine search over vector tables, gating, and context blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.functions.rows import fresh, keep_where
from sluice.operators import clustered


def wrong_shape(vectors: DataFrame, dim: int, values: str = "values") -> DataFrame:
    """Rows whose vector has another length than the index; an absent vector counts as length 0."""
    sized = vectors.withColumn("n_dims", F.when(F.col(values).isNull(), 0).otherwise(F.size(values)))
    return sized.where(F.col("n_dims") != dim)


def only_allowed(queries: DataFrame, verdicts: DataFrame, key: str, blocked: str = "blocked") -> DataFrame:
    """Queries whose prompt passed every hop. Runs before the search, so the rest is never searched."""
    passed = keep_where(verdicts.select(key, blocked), ~F.col(blocked)).select(key)
    return queries.join(passed, key, "left_semi")


def readable(vectors: DataFrame, role: str, prefixes: dict[str, list[str]], path: str = "prefix") -> DataFrame:
    """Vectors a role may search. A role without an entry is not locked to any prefix."""
    allowed = prefixes.get(role)
    if allowed is None:
        return vectors
    test = F.lit(False)
    for prefix in allowed:
        test = test | F.startswith(F.col(path), F.lit(prefix))
    return vectors.where(test)


def prefix_access(requests: DataFrame, locks: DataFrame, role: str = "role", path: str = "path") -> DataFrame:
    """The requests with ``lock``, the longest prefix of the path that their role has a lock for, and ``allowed``.

    ``locks`` has ``role, prefix, allow``: what stands under a prefix is allowed or not unless a longer one says
    otherwise. A role with locks may read nothing else; a role without any is not locked, and a NULL role or
    path is refused. Of two locks on one prefix the refusal holds. Each distinct role and path is joined with the locks
    by the beginnings of the path that are as long as some lock, so the locks are a table of any size.
    """
    lock, allowed, own_role, own_path = (fresh(requests, n) for n in ("lock", "allowed", "_role", "_path"))
    held = locks.where(F.col("role").isNotNull() & F.col("prefix").isNotNull()).groupBy("role", "prefix").agg(
        F.bool_and(F.coalesce("allow", F.lit(False))).alias("allow")
    )
    lengths = held.agg(F.coalesce(F.collect_set(F.length("prefix")), F.array().cast("array<int>"))).scalar()
    pairs = requests.select(F.col(role).alias("r"), F.col(path).alias("p")).where(F.col("r").isNotNull() & F.col("p").isNotNull()).distinct()
    starts = F.transform(F.filter("_lengths", lambda n: n <= F.length("p")), lambda n: F.substring("p", F.lit(1), n))
    tried = pairs.withColumn("_lengths", lengths).select("r", "p", F.explode(starts).alias("prefix"))
    met = tried.join(held, (F.col("r") == F.col("role")) & (tried["prefix"] == held["prefix"])).select("r", "p", tried["prefix"], "allow")
    # the longest match as one number: twice its length, and one more if it allows
    best = met.groupBy("r", "p").agg(F.max(F.length("prefix") * 2 + F.col("allow").cast("int")).alias("best"))
    locked = held.select(F.col("role").alias("r")).distinct().withColumn("locked", F.lit(True))
    known = pairs.join(best, ["r", "p"], "left").join(locked, "r", "left").select(
        F.col("r").alias(own_role), F.col("p").alias(own_path),
        F.expr("substring(p, 1, cast(best div 2 as int))").alias(lock),
        F.when(F.col("best").isNotNull(), F.col("best") % 2 == 1).otherwise(F.col("locked").isNull()).alias(allowed),
    )
    joined = requests.join(known, (F.col(role) == F.col(own_role)) & (F.col(path) == F.col(own_path)), "left")
    return joined.withColumn(allowed, F.coalesce(allowed, F.lit(False))).drop(own_role, own_path)


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int, dim: int, *, cell_bytes: int = clustered.CELL_BYTES, cluster_rows: int = clustered.CLUSTER_ROWS
) -> DataFrame:
    """``query_id, rank, id, score`` of the k nearest vectors of each query, by cosine.

    ``vectors`` has unique ``id`` and ``values``, ``queries`` has ``query_id`` and ``values``; rows
    of another length than ``dim`` take no part. Scores are compared at nine decimals so that equal
    vectors tie wherever they are computed, and ties go to the smaller id. A vector of zeros has no
    angle: its score is NULL and comes last. A table that is searched again keeps its ``clustered.build``.
    """
    return clustered.top_k(clustered.build(vectors, dim, cluster_rows), queries, k, cell_bytes)


def with_metadata(matches: DataFrame, vectors: DataFrame) -> DataFrame:
    """Matches with the metadata of their vectors, NULL where there is none.

    The vector table is first cut to the matched ids by a semi-join, for which Spark may broadcast
    the ids, so that the outer join does not move the whole table. Both uses of the matches read
    the one shuffle of the search.
    """
    matched = matches.select("id").distinct()
    wanted = vectors.select("id", "metadata").join(matched, "id", "left_semi")
    return matches.join(wanted, "id", "left")


def filled(metadata, *names: str):
    """First non-empty of the named metadata fields."""
    return F.coalesce(*[F.nullif(F.element_at(metadata, F.lit(n)), F.lit("")) for n in names])


def gateway_context(matches: DataFrame) -> DataFrame:
    """Context of a gateway prompt: all non-empty texts in rank order."""
    texts = matches.withColumn("_text", filled(F.col("metadata"), "text"))
    return texts.groupBy("query_id").agg(
        F.coalesce(F.expr(r"listagg(_text, '\n---\n') WITHIN GROUP (ORDER BY rank)"), F.lit("")).alias("context")
    )


def answer_context(matches: DataFrame, first: int = 3) -> DataFrame:
    """Context of an answer: the first non-empty chunks in rank order."""
    texts = matches.withColumn("_text", filled(F.col("metadata"), "content", "text", "chunk")).where("_text IS NOT NULL")
    order = Window.partitionBy("query_id").orderBy("rank")
    kept = texts.withColumn("_place", F.row_number().over(order)).where(F.col("_place") <= first)
    return kept.groupBy("query_id").agg(
        F.expr(r"listagg(_text, '\n\n---\n\n') WITHIN GROUP (ORDER BY rank)").alias("context")
    )


def explanations(matches: DataFrame, first: int = 5) -> DataFrame:
    """Readable block over the first matches: id, score, title and what else is known."""
    meta = F.col("metadata")
    ident = F.col("id").cast("string")
    title = F.coalesce(filled(meta, "title", "name", "technique", "technique_name", "id"), ident)
    tactic = filled(meta, "tactic", "tactic_name")
    about = filled(meta, "description", "summary")
    block = F.concat(
        F.format_string("ID: %s\nScore: %.3f\nTitle: %s\n", ident, F.col("score"), title),
        F.when(tactic.isNotNull(), F.concat(F.lit("Tactic: "), tactic, F.lit("\n"))).otherwise(""),
        F.when(about.isNotNull(), F.concat(F.lit("Description: "), about, F.lit("\n"))).otherwise(""),
    )
    return (
        matches.where(F.col("rank") <= first).withColumn("_block", block).groupBy("query_id")
        .agg(F.expr(r"listagg(_block, '\n\n') WITHIN GROUP (ORDER BY rank)").alias("explanation"))
    )

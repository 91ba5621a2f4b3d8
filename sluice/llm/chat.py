"""Reply trees to chat-formatted conversations.

Root-to-leaf paths are enumerated by iterative self-joins: each round doubles the distance of every node's
jump to an ancestor and adds the scores on the way, so a path of n turns takes log2(n) rounds. Leaves rank
by the mean score of their path; the nodes of the chosen paths are then marked by the same jumps in reverse.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame, Window

from sluice.llm import files

# The template's control strings.
OPEN, OPEN_END, CLOSE = "<turn:", ">\n", "\n</turn>\n"
TEXT_CONTROLS = re.compile(r"\\|<turn:|</turn>")
ROLE_CONTROLS = re.compile(r"[\\>\n]")
HEADER = re.compile(r"<turn:((?:[^\\>]|\\.)*)>\n", re.S)
ESCAPED = re.compile(r"\\(.)", re.S)
MAX_ROUNDS = 40


def format_turns(turns: list[tuple[str, str]], learned: str = "assistant") -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation and the loss mask: (start, length) of each learned turn's text in it."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head = OPEN + ROLE_CONTROLS.sub(lambda m: "\\" + m[0], role) + OPEN_END
        body = TEXT_CONTROLS.sub(lambda m: "\\" + m[0], text)
        if role == learned:
            spans.append((at + len(head), len(body)))
        parts += (head, body, CLOSE)
        at += len(head) + len(body) + len(CLOSE)
    return "".join(parts), spans


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1", text)


def parse_turns(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation; raises where it is not one."""
    turns, at = [], 0
    while at < len(formatted):
        head = HEADER.match(formatted, at)
        end = formatted.find(CLOSE, head.end()) if head else -1
        if end < 0:
            raise ValueError(f"no turn at character {at}")
        turns.append((unescape(head[1]), unescape(formatted[head.end() : end])))
        at = end + len(CLOSE)
    return turns


def _key(*columns: str) -> Column:
    return F.to_json(F.struct(*columns))


def chosen_paths(nodes: DataFrame, top: int = 1) -> DataFrame:
    """(tree_id, path, rank, depth, role, text): the nodes of each root's ``top`` best paths.

    ``nodes`` has tree_id, node_id, parent_id, role, text, score. A parent that is not in the table makes a
    root; null text and role are empty, null score 0. Null ids are values like any other. Rows that repeat a
    node id count once, the least by role and text. Ties of score go to the least leaf id. Nodes on a cycle
    have no root: that raises. Texts are whole, however long; an empty table gives no rows. Other columns are not read.
    """
    source = nodes.select(
        "tree_id",
        _key("tree_id", F.col("node_id").alias("id")).alias("node"),
        _key("tree_id", F.col("parent_id").alias("id")).alias("parent"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"),
        F.col("parent_id").isNotNull().alias("has_parent"),
    )
    one = source.groupBy("node").agg(F.min(F.struct("role", "text", "score", "parent", "has_parent", "tree_id")).alias("row"))
    table = files.written(one.select("node", "row.*"), "turns")
    ids = table.select(F.col("node").alias("known"))
    jumps = table.join(ids, F.col("has_parent") & (F.col("parent") == F.col("known")), "left").select(
        "node", F.col("known").alias("up"), F.lit(1).cast("long").alias("steps"), F.col("score").alias("sum"),
        F.when(F.col("known").isNull(), F.col("node")).alias("root"),
    )
    whole, levels = _jumps(files.written(jumps, "jumps"))
    inner = levels[0].select(F.col("up").alias("node")).distinct() if levels else whole.select("node").limit(0)
    leaves = whole.join(inner, "node", "left_anti")
    best = Window.partitionBy("root").orderBy((F.col("sum") / F.col("steps")).desc(), "node")
    ranked = leaves.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    marked = files.written(ranked.select(F.col("node").alias("path"), "rank", "node"), "marked")
    for level in reversed(levels):
        further = marked.join(level.select("node", "up"), "node").select("path", "rank", F.col("up").alias("node"))
        marked = files.written(marked.unionByName(further), "marked")
    return (
        marked.join(whole.select("node", F.col("steps").alias("depth")), "node")
        .join(table.select("node", "tree_id", "role", "text"), "node")
        .select("tree_id", "path", "rank", "depth", "role", "text")
    )


def _jumps(current: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """All nodes with the length, sum and root of their path, and the jumps of each round.

    A node that has met its root is set aside: later rounds join the nodes below it only, so the rounds
    that one long conversation needs cost nothing for the others.
    """
    done, levels = current.where("up IS NULL"), []
    while not (rest := current.where("up IS NOT NULL")).isEmpty():
        if len(levels) >= MAX_ROUNDS:
            raise ValueError("some nodes reply to each other in a circle")
        levels.append(rest)
        above = done.unionByName(rest).toDF("up", "next", "more", "sum_above", "top")
        joined = rest.join(above, "up").select(
            "node", F.col("next").alias("up"), (F.col("steps") + F.col("more")).alias("steps"),
            (F.col("sum") + F.col("sum_above")).alias("sum"), F.col("top").alias("root"),
        )
        current = files.written(joined, "jumps")
        done = done.unionByName(current.where("up IS NULL"))
    return done, levels


def format_paths(paths: DataFrame, learned: str = "assistant") -> DataFrame:
    """One row per path: tree_id, rank, formatted, loss_spans. A conversation is one row, so it is one task's."""
    grouped = paths.groupBy("tree_id", "path", "rank").agg(F.sort_array(F.collect_list(F.struct("depth", "role", "text"))).alias("turns"))
    kind = grouped.schema["tree_id"].dataType.simpleString()
    schema = f"tree_id {kind}, rank int, formatted string, loss_spans array<struct<start:long,length:long>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))
        for batch in batches:
            made = [format_turns([(t["role"], t["text"]) for t in turns], learned) for turns in batch["turns"].to_pylist()]
            spans = pa.array([[{"start": a, "length": n} for a, n in s] for _, s in made], spans_type)
            texts = pa.array([text for text, _ in made], pa.string())
            yield pa.RecordBatch.from_arrays([batch["tree_id"], batch["rank"], texts, spans], names=["tree_id", "rank", "formatted", "loss_spans"])

    return grouped.select("tree_id", "rank", "turns").mapInArrow(run, schema)


def format_best(nodes: DataFrame, top: int = 1, learned: str = "assistant") -> DataFrame:
    """Each root's ``top`` best paths as formatted conversations with their loss masks."""
    return format_paths(chosen_paths(nodes, top), learned)


def linear(turns: DataFrame, key: str = "conv_id") -> DataFrame:
    """Conversations in rows by turn as reply trees: each row replies to the one before it."""
    order = Window.partitionBy(key).orderBy("turn", "role", "text")
    return turns.select(key, "turn", "role", "text", F.row_number().over(order).alias("node_id")).select(
        F.col(key).alias("tree_id"),
        "node_id",
        F.when(F.col("node_id") > 1, F.col("node_id") - 1).alias("parent_id"),
        "role",
        "text",
        F.lit(1.0).alias("score"),
    )

"""Near duplicates by min-max hashing.

A document's set is its distinct word shingles. Under each permutation both the least and the greatest
value are kept, so a signature of 2n values costs n hash evaluations. Bands of ROWS values give bucket
keys; a band holds minima or maxima only, never both ends of one permutation. Documents that share a
bucket are compared on their full sets, and links are joined into classes.

At the least similarity of 0.75, a band of 5 values agrees with probability 0.237 and one of 40 bands with
1 - 2e-5. Buckets are not cut: a large bucket is first compared with one member of each round's choice (a
star), which joins copies without their pairs. What then still lies in different classes within a bucket
is compared inside the join, which gives out links alone: first by signature, which agrees in LEAST_AGREE of
the 2n values for all but a few in a million pairs of similarity 0.75, then on the full sets, and only in the
first band that a pair has in common.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame

from sluice.functions.rows import fresh
from sluice.llm import files, hashing
from sluice.llm.components import components

PERCENT = 75
ROWS = 5
PERMUTATIONS = 100
STARS = 2
SCAN_BYTES = 4 << 20  # of text in a batch
LEAST_AGREE = 125  # of the values' sketches; four bits also agree by chance
SKETCH = -(-2 * PERMUTATIONS // 16)  # longs that hold four bits of each value

_rng = np.random.default_rng(75)
_PERMUTE = _rng.integers(1, 1 << 63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_JOIN = _rng.integers(1, 1 << 63, ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _distinct(values: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of each row, ascending, and the rows' offsets."""
    parts = [np.unique(values[a:b]) for a, b in zip(offsets[:-1], offsets[1:])]
    return (np.concatenate(parts) if parts else values), np.concatenate(([0], np.cumsum([len(p) for p in parts], dtype=np.int64)))


def signatures(sets: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Minima, then maxima, of each non-empty row under all permutations: rows x 2 * PERMUTATIONS."""
    rows = np.flatnonzero(np.diff(offsets))
    out = np.empty((len(rows), 2 * PERMUTATIONS), dtype=np.uint64)
    if len(rows):
        starts, buffer = offsets[rows], np.empty_like(sets)
        for k, factor in enumerate(_PERMUTE):
            np.multiply(sets, factor, out=buffer)
            out[:, k] = np.minimum.reduceat(buffer, starts)
            out[:, PERMUTATIONS + k] = np.maximum.reduceat(buffer, starts)
    return out


def bands(signature: np.ndarray) -> np.ndarray:
    """One bucket key per band: rows x (2 * PERMUTATIONS / ROWS)."""
    n = 2 * PERMUTATIONS // ROWS
    joined = (signature.reshape(len(signature), n, ROWS) * _JOIN).sum(axis=2, dtype=np.uint64)
    return hashing.mix(joined + np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def sketches(signature: np.ndarray) -> np.ndarray:
    """Four bits of every value, sixteen to a 64-bit word, with zeros at the end: rows x SKETCH."""
    bits = np.zeros((len(signature), 16 * SKETCH), dtype=np.uint8)
    bits[:, : signature.shape[1]] = (signature >> np.uint64(20)) & np.uint64(15)
    return np.ascontiguousarray(bits[:, 0::2] | (bits[:, 1::2] << 4)).view(np.int64)


def agree(left: str, right: str) -> Column:
    """In how many values two sketches agree: 2 * PERMUTATIONS less the groups of four bits that differ."""
    differ = F.lit(0)
    for k in range(SKETCH):
        x = F.col(left)[k].bitwiseXOR(F.col(right)[k])
        for step in (2, 1):  # the lowest bit of each group becomes the union of its four
            x = x.bitwiseOR(F.shiftrightunsigned(x, step))
        differ = differ + F.bit_count(x.bitwiseAND(F.lit(0x1111111111111111)))
    return F.lit(2 * PERMUTATIONS) - differ


def first_common(band: str, left: str, right: str) -> Column:
    """Whether two lists of band keys agree in no band before this one."""
    earlier = F.lit(False)
    for k in range(2 * PERMUTATIONS // ROWS - 1):
        earlier = earlier | ((F.col(band) > k) & (F.col(left)[k] == F.col(right)[k]))
    return ~earlier


def _set_ids(sets: np.ndarray, offsets: np.ndarray) -> list[str]:
    """128 bits of each set as hex: equal sets have equal ids."""
    first = np.concatenate(([np.uint64(0)], np.cumsum(hashing.mix(sets ^ np.uint64(0x5851F42D4C957F2D)), dtype=np.uint64)))
    second = np.concatenate(([np.uint64(0)], np.cumsum(hashing.mix(sets + np.uint64(0x2545F4914F6CDD1D)), dtype=np.uint64)))
    a, b = first[offsets[1:]] - first[offsets[:-1]], second[offsets[1:]] - second[offsets[:-1]]
    return [f"{x:016x}{y:016x}" for x, y in zip(a.tolist(), b.tolist())]


def _scan(with_bands: bool):
    kinds = {"doc_id": pa.int64(), "n_shingles": pa.int64(), "unit": pa.string()}
    kinds |= {"bands": pa.list_(pa.int64()), "sketch": pa.list_(pa.int64())} if with_bands else {"members": pa.list_(pa.int64())}
    schema = pa.schema(list(kinds.items()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, words, starts in hashing.word_chunks(batch["text"]):
                sets, offsets = _distinct(*hashing.shingles(words, starts))
                sizes = np.diff(offsets)
                if with_bands:
                    signature = signatures(sets, offsets)
                    lists = [_lists(bands(signature).view(np.int64), sizes > 0), _lists(sketches(signature), sizes > 0)]
                else:
                    lists = [pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(sets.view(np.int64)))]
                ids = batch["doc_id"].slice(first, last - first)
                yield pa.RecordBatch.from_arrays([ids, pa.array(sizes), pa.array(_set_ids(sets, offsets)), *lists], schema=schema)

    return run, "doc_id long, n_shingles long, unit string, " + ("bands array<long>, sketch array<long>" if with_bands else "members array<long>")


def _lists(values: np.ndarray, present: np.ndarray) -> pa.Array:
    """The rows of a matrix as lists, with an empty list where a row is not present."""
    ends = np.concatenate(([0], np.cumsum(present * values.shape[1])))
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(values.reshape(-1)))


def _close(left: str, right: str, percent: int) -> Column:
    """Whether two sets have ``percent`` of their union in common."""
    both = F.size(F.array_intersect(left, right))
    return both * (100 + percent) >= (F.size(left) + F.size(right)) * percent


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of the pairs of units, the first ids of those whose full sets are close."""
    left, right = sets.select("unit", "rep", "members").toDF("u", "a", "x"), sets.select("unit", "rep", "members").toDF("v", "b", "y")
    return pairs.join(left, "u").join(right, "v").where(_close("x", "y", percent)).select("a", "b")


def _named(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("x", "y").alias("u"), F.greatest("x", "y").alias("v")).distinct()


def link_classes(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id (least doc_id reachable), kept.

    Equal sets are one unit from the start, under their least id. A text without words has no set and
    stays alone; so does a row without doc_id, whose component_id is null and which is kept. Rows of one
    doc_id are one node: their links are united and each row is returned. Texts are read whole, however long; an empty
    table gives no rows. Extra columns, whatever their names, are not read.
    """
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scan, kind = _scan(True)
    signed = files.written(source.mapInArrow(scan, kind), "signatures", batch_bytes=SCAN_BYTES)
    named = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    units = named.groupBy("unit").agg(
        F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch")
    )
    units = files.written(units, "units")
    keyed = units.select("unit", "rep", "n", F.posexplode("bands").alias("band", "key"))
    full = keyed.groupBy("key").agg(F.count("*").alias("m")).where("m > 1").select("key")
    shared = files.written(keyed.join(full, "key"), "buckets")

    active = shared.select("unit", "rep").distinct()
    scan, kind = _scan(False)
    texts = source.join(active.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi")
    sets = texts.mapInArrow(scan, kind).join(active, "unit").where("doc_id = rep").dropDuplicates(["unit"])
    sets = files.written(sets.select("unit", "rep", "members"), "sets", "lz4", SCAN_BYTES)

    copies = named.join(units.select("unit", "rep"), "unit").where("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b")).distinct()
    links = files.written(copies, "links")
    tested = None
    drawn = files.written(units.join(active.select("unit"), "unit", "left_semi").select("unit", "sketch", "bands"), "sketches")
    sizes = f"own <> other AND 100 * least(n, m) >= {percent} * greatest(n, m)"
    labels = components(links)
    rounds = [("star", k) for k in range(STARS)] + [("rest", 0)]
    for how, k in rounds:
        placed = shared.join(labels.select(F.col("id").alias("rep"), "label"), "rep", "left").select("*", F.coalesce("label", "rep").alias("own"))
        spread = placed.groupBy("key").agg(F.min("own").alias("low"), F.max("own").alias("high")).where("low <> high").select("key")
        open_rows = files.written(placed.join(spread, "key").select("key", "band", "unit", "n", "own"), "open")
        if how == "star":
            hub = open_rows.groupBy("key").agg(F.min(F.struct(F.xxhash64("unit", F.lit(k)).alias("h"), "unit", "n", "own")).alias("hub"))
            pairs = open_rows.join(hub, "key").select("unit", "n", "own", "hub.unit", "hub.n", "hub.own").toDF("x", "n", "own", "y", "m", "other")
            pairs = _named(pairs.where(sizes))
            for name in ("u", "v"):
                pairs = pairs.join(drawn.select("unit", "sketch").toDF(name, f"{name}_sketch"), name)
            pairs = pairs.where(agree("u_sketch", "v_sketch") >= LEAST_AGREE).select("u", "v")
            if tested is not None:
                pairs = pairs.join(tested, ["u", "v"], "left_anti")
            pairs = files.written(pairs, "pairs")
            tested = pairs if tested is None else tested.union(pairs)
            found = files.written(_verified(pairs, sets, percent), "found")
        else:
            whole = drawn.join(sets, "unit")
            left = open_rows.join(whole, "unit").select("unit", "rep", "key", "band", "n", "own", "sketch", "bands", "members")
            left = left.toDF("x", "a", "key", "band", "n", "own", "x_sketch", "x_bands", "x_set")
            right = left.drop("band").toDF("y", "b", "key2", "m", "other", "y_sketch", "y_bands", "y_set")
            alike = (F.col("key") == F.col("key2")) & (F.col("x") < F.col("y")) & F.expr(sizes)
            alike = alike & first_common("band", "x_bands", "y_bands") & (agree("x_sketch", "y_sketch") >= LEAST_AGREE)
            found = files.written(left.join(right, alike & _close("x_set", "y_set", percent)).select("a", "b"), "found")
        if not found.isEmpty():
            links = links.union(found)
            labels = components(links)

    return signed.select("doc_id", "n_shingles").join(
        labels.select(F.col("id").alias("doc_id"), "label"), "doc_id", "left"
    ).select(
        "doc_id",
        "n_shingles",
        F.coalesce("label", "doc_id").alias("component_id"),
        (F.col("doc_id").isNull() | (F.col("doc_id") == F.coalesce("label", "doc_id"))).alias("kept"),
    )


def deduplicate(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` without near duplicates: one row of each class stays, that of its least doc_id.

    Of several rows of that id the first by text stays. Rows without doc_id all stay. Columns are unchanged,
    whatever their names; an empty table gives an empty one.
    """
    gone_id, many, row = (fresh(docs, n) for n in ("gone_id", "many", "row"))
    gone = link_classes(docs, percent).where("NOT kept").select(F.col("doc_id").alias(gone_id)).distinct()
    rest = docs.join(gone, F.col("doc_id").cast("long") == F.col(gone_id), "left_anti")
    repeated = rest.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias(many)).where(F.col(many) > 1).select(F.col("doc_id").alias(many))
    single = rest.join(repeated, F.col("doc_id") == F.col(many), "left_anti")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    first = (
        rest.join(repeated, F.col("doc_id") == F.col(many))
        .groupBy(many)
        .agg(F.min_by(F.struct(*columns), F.struct("text", F.xxhash64(*columns))).alias(row))
        .select(f"{row}.*")
    )
    return single.unionByName(first)

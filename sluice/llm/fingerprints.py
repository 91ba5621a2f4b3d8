"""Improbable-feature digests of documents.

Every window of WINDOW bytes has an entropy over 16 byte classes. Entropies that are rare in the corpus
rank first; within each run of NEIGHBOURS windows the best-ranked one gains a point, and windows with at
least POINTS points are the document's features. They go in order into a chain of Bloom filters of
FEATURES features each. Likeness is the overlap of set bits over what chance gives, normalised to 0..1.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from sluice.functions.rows import fresh
from sluice.llm import files, hashing, ordered

WINDOW = 64
NEIGHBOURS = 64
POINTS = 16
FEATURES = 64
FILTER_BITS = 1024
HASHES = 5
LEVELS = 256
LEAST_ENTROPY = 1.0  # bits; flatter windows (runs, padding) tell nothing
NEVER = np.int64(1) << 62
PIECE = 1 << 19  # bytes of text whose windows are looked at together, or one text

_CLASS_LOW = np.where(np.arange(256) & 15 < 8, np.uint64(1) << (np.uint64(8) * (np.arange(256, dtype=np.uint64) & np.uint64(7))), np.uint64(0)).astype(np.uint64)
_CLASS_HIGH = np.where(np.arange(256) & 15 >= 8, np.uint64(1) << (np.uint64(8) * (np.arange(256, dtype=np.uint64) & np.uint64(7))), np.uint64(0)).astype(np.uint64)
_COUNTS = np.arange(256, dtype=np.float64)
_TERM = np.round(100 * _COUNTS * np.log2(np.maximum(_COUNTS, 1))).astype(np.int64)
_TERM[WINDOW + 1 :] = 0
_TERM_PAIRS = (_TERM[None, :] + _TERM[:, None]).reshape(-1).astype(np.uint16)
_LEVEL = np.clip((np.log2(WINDOW) - np.arange(65536) / (100.0 * WINDOW)) / 4 * (LEVELS - 1), 0, LEVELS - 1).round().astype(np.int64)
_ONES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).sum(axis=1).astype(np.int64)


def entropy_levels(data: np.ndarray) -> np.ndarray:
    """Entropy level (0..LEVELS-1 for 0..4 bits) of each window; one per start.

    Eight class counts share one 64-bit running sum: a difference of sums holds each count in a byte.
    """
    n = len(data) - WINDOW + 1
    if n <= 0:
        return np.empty(0, np.int64)
    counts = np.empty((n, 2), dtype=np.uint64)
    for k, table in enumerate((_CLASS_LOW, _CLASS_HIGH)):
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(table[data], dtype=np.uint64)))
        counts[:, k] = sums[WINDOW:] - sums[:-WINDOW]
    terms = _TERM_PAIRS[counts.view(np.uint16)].view(np.uint64)
    lanes = terms[:, 0] + terms[:, 1]
    lanes += lanes >> np.uint64(32)
    lanes += lanes >> np.uint64(16)
    return _LEVEL[lanes & np.uint64(0xFFFF)]


def _inside(offsets: np.ndarray, n: int) -> np.ndarray:
    """Which of the n window starts lie within one row."""
    ok = np.ones(n, dtype=bool)
    marks = np.zeros(n + WINDOW + 1, dtype=np.int64)
    ends = np.asarray(offsets[1:-1])
    np.add.at(marks, np.maximum(ends - WINDOW + 1, 0), 1)
    np.add.at(marks, ends, -1)
    ok &= np.cumsum(marks)[:n] <= 0
    return ok


def digests(data: np.ndarray, offsets: np.ndarray, ranks: np.ndarray) -> list[bytes]:
    """Filter chain of each row of bytes.

    A text below WINDOW bytes is one feature, and so is a longer one none of whose windows is chosen, since all are
    flat: its whole bytes. An empty text has none.
    """
    rows = len(offsets) - 1
    levels = entropy_levels(data)
    feature_rows, hashes = [], []
    if len(levels):
        key = (ranks[levels] << np.int64(32)) | np.arange(len(levels))
        key[~_inside(offsets, len(levels)) | (levels < LEAST_ENTROPY / 4 * (LEVELS - 1))] = NEVER
        pad = np.full(NEIGHBOURS - 1, NEVER)
        least, width = np.concatenate((pad, key, pad)), 1
        while width < NEIGHBOURS:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        points = np.bincount(least[least < NEVER] & np.int64(0xFFFFFFFF), minlength=len(levels))
        chosen = np.flatnonzero(points >= POINTS)
        feature_rows.append(np.searchsorted(offsets, chosen, side="right") - 1)
        hashes.append(hashing.window_hashes(data, chosen, WINDOW))
    sizes = np.diff(offsets)
    chosen_rows = np.bincount(feature_rows[0], minlength=rows) if feature_rows else np.zeros(rows, dtype=np.int64)
    for row in np.flatnonzero((sizes > 0) & (chosen_rows == 0)):
        hashes.append(hashing.window_hashes(data[offsets[row] : offsets[row + 1]], np.array([0]), int(sizes[row])))
        feature_rows.append(np.array([row]))
    if not feature_rows:
        return [b""] * rows
    of, value = np.concatenate(feature_rows), np.concatenate(hashes)
    order = np.argsort(of, kind="stable")
    of, value = of[order], value[order]
    counts = np.bincount(of, minlength=rows)
    first = np.concatenate(([0], np.cumsum(counts)))[:-1]
    filters = -(-counts // FEATURES)
    filter_first = np.concatenate(([0], np.cumsum(filters)))
    place = filter_first[of] + (np.arange(len(of)) - first[of]) // FEATURES
    bits = np.zeros((filter_first[-1], FILTER_BITS), dtype=np.uint8)
    for k in range(HASHES):
        bits[place, ((value >> np.uint64(10 * k)) & np.uint64(FILTER_BITS - 1)).astype(np.int64)] = 1
    packed = np.packbits(bits, axis=1)
    return [packed[a:b].tobytes() for a, b in zip(filter_first[:-1], filter_first[1:])]


def likeness(left: bytes, right: bytes) -> float:
    """0 to 1. Each filter of the shorter chain counts with its best match in the other, by its set bits."""
    if left == right:
        return 1.0
    if not left or not right:
        return 0.0
    a, b = (np.frombuffer(x, np.uint8).reshape(-1, FILTER_BITS // 8) for x in sorted((left, right), key=lambda x: (len(x), x)))
    ones_a, ones_b = _ONES[a].sum(axis=1), _ONES[b].sum(axis=1)
    total = 0.0
    for own, ones in zip(a, ones_a):
        both = _ONES[b & own].sum(axis=1)
        chance = ones * ones_b / FILTER_BITS
        most = np.minimum(ones, ones_b)
        total += ones * float(np.clip((both - chance) / np.maximum(most - chance, 1e-9), 0, 1).max())
    return total / float(ones_a.sum())


def entropy_ranks(docs: DataFrame) -> np.ndarray:
    """Rank of each entropy level, the rarest in the whole corpus first; ties by level, higher first.

    Counts of LEVELS levels are summed by Spark over all texts; a level that never occurs comes last.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(LEVELS, dtype=np.int64)
        for batch in files.chunks_of(batches, "text", PIECE):
            data, offsets = hashing.column_bytes(batch["text"])
            levels = entropy_levels(data)
            counts += np.bincount(levels[_inside(offsets, len(levels))], minlength=LEVELS)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(LEVELS)), pa.array(counts)], names=["level", "n"])

    found = docs.select("text").mapInArrow(run, "level long, n long").groupBy("level").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(LEVELS, dtype=np.int64)
    for row in found:
        counts[row.level] = row.n
    order = sorted(range(LEVELS), key=lambda v: (counts[v] == 0, counts[v], -v))
    ranks = np.empty(LEVELS, dtype=np.int64)
    ranks[order] = np.arange(LEVELS)
    return ranks


def fingerprint(docs: DataFrame, ranks: np.ndarray) -> DataFrame:
    """The rows with one more column, hex of the filter chain: ``fingerprint``, or ``fresh(docs, "fingerprint")`` if they have one.

    Null text is empty, with ''. Texts are read whole; repeated rows have equal fingerprints; all other columns stay.
    """
    schema = StructType([*docs.schema.fields]).add(fresh(docs, "fingerprint"), "string")
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in files.chunks_of(batches, "text", PIECE):
            made = digests(*hashing.column_bytes(batch["text"]), ranks)
            columns = [batch[n] for n in names[:-1]] + [pa.array([d.hex() for d in made], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.mapInArrow(run, schema)


NEIGHBOUR_SCHEMA = "doc_id long, text string, next_text string"
COMPARED = "doc_id long, n_chars long, edited string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def with_next(docs: DataFrame) -> DataFrame:
    """(doc_id, text, next_text) with the document that follows by ascending doc_id; the first follows the last.

    One shuffle: a key that begins a bucket is also sent to the bucket before it, where it comes last.
    Null ids stand first, equal ids in order of text, null text is empty.
    """
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    cuts = ordered.bounds(source, "doc_id")
    ends = source.agg(F.min("doc_id").alias("low"), F.max(F.col("doc_id").isNull()).alias("nulls")).first()
    is_first = F.col("doc_id").isNull() if ends.nulls else F.col("doc_id") == F.lit(ends.low)
    own, before = ordered.bucket(F.col("doc_id"), cuts), ordered.bucket(F.col("doc_id"), cuts, strict=True)
    spots = F.array(
        F.struct(own.cast("int").alias("bucket_no"), F.lit(0).alias("late")),
        F.when((own > before) & F.col("doc_id").isNotNull(), F.struct((own - 1).cast("int").alias("bucket_no"), F.lit(1).alias("late"))),
        F.when(is_first, F.struct(F.lit(len(cuts)).alias("bucket_no"), F.lit(2).alias("late"))),
    )
    placed = source.select("doc_id", "text", F.explode(F.filter(spots, lambda s: s.isNotNull())).alias("spot")).select("doc_id", "text", "spot.*")
    tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    rows = placed.repartition(tasks, "bucket_no").sortWithinPartitions("bucket_no", "late", F.col("doc_id").asc_nulls_first(), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = bucket = None
        for batch in files.chunks_of(batches, "text", 1 << 21):
            out = []
            for number, late, doc, text in zip(*(batch[c].to_pylist() for c in ("bucket_no", "late", "doc_id", "text"))):
                if held is not None and number == bucket:
                    out.append((*held, text))
                held, bucket = (None, None) if late else ((doc, text), number)
            if out:
                kinds = (pa.int64(), pa.string(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=["doc_id", "text", "next_text"])

    return rows.mapInArrow(run, NEIGHBOUR_SCHEMA)


def edited(text: str, following: str) -> str:
    """The last quarter of the text replaced by as many first characters of another, or all of it."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def compare_edits(neighbours: DataFrame, ranks: np.ndarray) -> DataFrame:
    """Fingerprints of each text, its edited text and the next text, and their likeness."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in files.chunks_of(batches, "text", PIECE):
            texts, following = batch["text"].to_pylist(), batch["next_text"].to_pylist()
            changed = [edited(a, b) for a, b in zip(texts, following)]
            # the next text of a row is mostly the text of the row after it
            last = [b for k, b in enumerate(following) if k + 1 == len(texts) or texts[k + 1] != b]
            column = pa.array(texts + changed + last, pa.large_string())
            made = [m for part in _parts(column) for m in digests(*hashing.column_bytes(part), ranks)]
            n = len(texts)
            own, other, rest = made[:n], made[n : 2 * n], iter(made[2 * n :])
            after = [own[k + 1] if k + 1 < n and texts[k + 1] == b else next(rest) for k, b in enumerate(following)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.array(changed, pa.string()),
                    pa.array([d.hex() for d in own], pa.string()),
                    pa.array([d.hex() for d in other], pa.string()),
                    pa.array([likeness(a, b) for a, b in zip(own, other)]),
                    pa.array([likeness(a, b) for a, b in zip(own, after)]),
                ],
                names=[f.split()[0] for f in COMPARED.split(", ")],
            )

    return neighbours.mapInArrow(run, COMPARED)


def _parts(column: pa.Array) -> Iterator[pa.Array]:
    for part in files.chunks_of([pa.RecordBatch.from_arrays([column], names=["t"])], "t", PIECE):
        yield part["t"]

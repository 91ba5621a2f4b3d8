"""Token ids in directly addressable codes: any id is read without decoding a block.

An id is split into chunks of ``WIDTHS`` bits, lowest first. Level 0 holds the first chunk of every id;
a bitmap says for each whether the id goes on, and its next chunk stands in the level above at the rank of
that bit. Rank directories hold the set bits before each 512-bit block, so a rank is one entry and the
set bits of one block.

File, all integers little-endian: magic, levels (u32), ids (u64), documents (u64); per level its chunks
(u64); then the documents' ids (i64 each, 0 for null), a bitmap of those that are null, ends (u64 each), and per level: chunks (u8 or u16 each), bitmap
bytes (none for the last level), rank directory (u64 per block). A file is one segment of the corpus in
ascending doc_id order; the index table has the ids before each segment.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
from pyspark.sql import DataFrame, Window

from sluice.llm import files, ordered, tokens

# Fixed values of the format.
MAGIC = b"DACIDS02"
WIDTHS = (8, 8, 16)
RANK_BLOCK = 512
HEADER = struct.Struct("<8sIQQ3Q")
END_ID = 2
SEGMENT_IDS = 4 << 20


def encode(ids: np.ndarray, ends: np.ndarray, doc_ids: np.ndarray, nulls: np.ndarray | None = None) -> bytes:
    """One segment: uint32 ids, the documents' ends in them, the documents' own ids and which of these are null."""
    nulls = np.zeros(len(doc_ids), dtype=bool) if nulls is None else nulls
    levels, rest = [], ids.astype(np.uint32)
    for level, width in enumerate(WIDTHS):
        kind = np.uint8 if width == 8 else np.dtype("<u2")
        chunk = (rest & np.uint32((1 << width) - 1)).astype(kind)
        if level == len(WIDTHS) - 1:
            levels.append((len(chunk), chunk.tobytes()))
            break
        rest = rest >> np.uint32(width)
        more = rest > 0
        bits = np.packbits(more, bitorder="little")
        set_bits = np.concatenate(([0], np.cumsum(more, dtype=np.int64)))
        levels.append((len(chunk), chunk.tobytes() + bits.tobytes() + set_bits[:-1:RANK_BLOCK].astype("<u8").tobytes()))
        rest = rest[more]
    head = HEADER.pack(MAGIC, len(WIDTHS), len(ids), len(ends), *(n for n, _ in levels))
    names = np.where(nulls, 0, doc_ids).astype("<i8").tobytes() + np.packbits(nulls, bitorder="little").tobytes()
    return head + names + ends.astype("<u8").tobytes() + b"".join(body for _, body in levels)


class Segment:
    """A segment's sections as views of its bytes."""

    def __init__(self, raw: bytes):
        magic, levels, self.ids, documents, *counts = HEADER.unpack_from(raw)
        if magic != MAGIC or levels != len(WIDTHS):
            raise ValueError("not a segment of directly addressable codes")
        at = HEADER.size

        def view(kind, n):
            nonlocal at
            found = np.frombuffer(raw, dtype=kind, count=n, offset=at)
            at += found.nbytes
            return found

        self.doc_ids = view("<i8", documents)
        self.nulls = np.unpackbits(view(np.uint8, -(-documents // 8)), count=documents, bitorder="little").astype(bool)
        self.ends = view("<u8", documents).astype(np.int64)
        self.chunks, self.bits, self.ranks = [], [], []
        for level, (width, n) in enumerate(zip(WIDTHS, counts)):
            self.chunks.append(view(np.uint8 if width == 8 else "<u2", n))
            if level < len(WIDTHS) - 1:
                self.bits.append(view(np.uint8, -(-n // 8)))
                self.ranks.append(view("<u8", -(-n // RANK_BLOCK)))
        if at != len(raw):
            raise ValueError("segment has another length than its header says")

    def __getitem__(self, position: int) -> int:
        """The id at a position, from at most one chunk and one rank per level."""
        if not 0 <= position < self.ids:
            raise IndexError(position)
        value = shift = 0
        for level, width in enumerate(WIDTHS):
            value |= int(self.chunks[level][position]) << shift
            shift += width
            if level == len(WIDTHS) - 1 or not self.bits[level][position >> 3] >> (position & 7) & 1:
                return value
            block = position // RANK_BLOCK
            first = block * RANK_BLOCK // 8
            held = self.bits[level][first : (position >> 3) + 1].copy()
            held[-1] &= (1 << (position & 7)) - 1
            position = int(self.ranks[level][block]) + int(np.unpackbits(held).sum())
        return value

    def read(self, first: int, last: int) -> np.ndarray:
        """The ids from ``first`` to before ``last`` as uint32."""
        return self._level(0, first, last)

    def _level(self, level: int, first: int, last: int) -> np.ndarray:
        out = self.chunks[level][first:last].astype(np.uint32)
        if level == len(WIDTHS) - 1 or first >= last:
            return out
        low = first >> 3
        more = np.unpackbits(self.bits[level][low : -(-last // 8)], bitorder="little")[first - 8 * low : last - 8 * low]
        at = np.flatnonzero(more)
        if len(at):
            rank = self._rank(level, first)
            out[at] |= self._level(level + 1, rank, rank + len(at)) << np.uint32(WIDTHS[level])
        return out

    def _rank(self, level: int, position: int) -> int:
        block = position // RANK_BLOCK
        held = np.unpackbits(self.bits[level][block * RANK_BLOCK // 8 : (position >> 3) + 1], bitorder="little")
        return int(self.ranks[level][block]) + int(held[: position - block * RANK_BLOCK].sum())


WRITTEN = "bucket_no long, part long, file string, documents long, ids long, bytes long"


def _writer(folder: str, path: str, end_id: int, segment_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.encoder(tokens.tokenizer_path(path))
        end = int(end_id).to_bytes(4, "little")
        held: list[bytes] = []
        ends: list[int] = []
        names: list[int | None] = []
        total = part = 0
        open_bucket = None

        def close():
            nonlocal total, part
            out = files.NewFile(folder, ".dac")
            ids = np.array([0 if n is None else n for n in names], dtype=np.int64)
            out.write(encode(np.frombuffer(b"".join(held), dtype="<u4"), np.array(ends), ids, np.array([n is None for n in names])))
            out.close()
            row = pa.RecordBatch.from_pylist(
                [{"bucket_no": open_bucket, "part": part, "file": out.name, "documents": len(ends), "ids": total, "bytes": out.size}],
                schema=pa.schema([(n, pa.string() if n == "file" else pa.int64()) for n in ("bucket_no", "part", "file", "documents", "ids", "bytes")]),
            )
            held.clear()
            ends.clear()
            names.clear()
            total, part = 0, part + 1
            return row

        for batch in batches:
            for number, doc, body in zip(batch["bucket_no"].to_pylist(), batch["doc_id"].to_pylist(), batch["text"]):
                if ends and (number != open_bucket or total >= segment_ids):
                    yield close()
                if number != open_bucket:
                    open_bucket, part = number, 0
                ids = encoder.encode(body.as_py()) + end
                held.append(ids)
                total += len(ids) // 4
                ends.append(total)
                names.append(doc)
        if ends:
            yield close()

    return run


def write(docs: DataFrame, tokenizer: str = tokens.DEFAULT_FILE, end_id: int = END_ID, segment_ids: int = SEGMENT_IDS) -> tuple[str, DataFrame]:
    """Write all documents in ascending doc_id order; the folder and its index table.

    The table has one row per segment: file, documents, ids and start (ids
    before it). Only files named there count, so a task that ran twice does no harm. Null text
    is empty and has its end id alone; null ids come first; equal ids stand in order of their texts, repeated rows each.
    A long text is encoded whole. An empty table gives no segment. Other columns are not read.
    """
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    sorted_docs = ordered.in_order(source, ordered.bounds(source, "doc_id"), "doc_id", "text")
    folder = files.new_folder(docs.sparkSession, "codes")
    made = files.written(sorted_docs.select("bucket_no", "doc_id", "text").mapInArrow(_writer(folder, tokenizer, end_id, segment_ids), WRITTEN), "codes-index")
    # one row per segment of millions of ids: a running sum over the segments, not over the documents
    before = Window.orderBy("bucket_no", "part").rowsBetween(Window.unboundedPreceding, -1)
    index = made.select(
        "*",
        F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("start"),
    )
    return folder, index


def read(folder: str, index: DataFrame) -> DataFrame:
    """One row per document: doc_id, start, n_tokens, ids_crc32, decoded from the files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for seg in batch.to_pylist():
                with files.open_input(folder, seg["file"]) as source:
                    segment = Segment(source.read())
                starts = np.concatenate(([0], segment.ends[:-1]))
                ids = segment.read(0, segment.ids).astype("<u4")
                crcs = [zlib.crc32(ids[a:b]) for a, b in zip(starts, segment.ends)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(segment.doc_ids, mask=segment.nulls),
                        pa.array(starts + seg["start"]),
                        pa.array(segment.ends - starts),
                        pa.array(np.array(crcs, dtype=np.int64)),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    tasks = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return index.repartition(tasks, "file").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")

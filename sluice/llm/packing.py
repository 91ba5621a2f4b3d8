"""Pack documents into sequences by Karmarkar-Karp multiway differencing.

Documents are cut into full windows; what remains of each is cut into pieces of at most ``max_piece`` ids.
The pieces of a block of documents are split into k near-equal windows: partial partitions are merged,
the largest sums of one meeting the smallest of the other, widest spread first. k is searched for from the
sum over the capacity, each block anew, until no window is above it and with one window less there is one.
Every block is packed where it is read: no shuffle, bounded memory, and growth in proportion to the input.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pyarrow as pa
import pyspark.sql.functions as F
from pyspark import TaskContext
from pyspark.sql import DataFrame

from sluice.llm import tokens

CAPACITY = 1024
MAX_PIECE = 1024
BLOCK_PIECES = 1024
END_ID = 0
SCHEMA = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
NAMES = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]


def differencing(sizes: list[int], k: int) -> list[list[int]]:
    """k near-equal subsets of the items, as lists of item numbers; ties go by item number.

    A partial partition is its subsets ascending, each (sum, number); sums of zero are left out, so a
    merge costs what is in it and not k. Numbers from len(sizes) on are unions, kept as pairs.
    """
    unions: list[tuple[int, int]] = []
    heap = [(-size, i, [(size, i)]) for i, size in enumerate(sizes)]
    heapq.heapify(heap)
    age = len(heap)
    while len(heap) > 1:
        a = heapq.heappop(heap)[2]
        b = heap[0][2]
        over = len(a) + len(b) - k
        if over <= 0:
            merged = a + b
        else:
            # over the k sums a ascends and b descends, zeros included: opposite imbalances meet
            b = b[::-1]
            alone = k - len(a)
            first = len(sizes) + len(unions)
            pairs = list(zip(a, b[alone:]))
            unions.extend((x[1], y[1]) for x, y in pairs)
            merged = b[:alone] + [(x[0] + y[0], first + n) for n, (x, y) in enumerate(pairs)] + a[over:]
        merged.sort()
        least = merged[0][0] if len(merged) == k else 0
        heapq.heapreplace(heap, (least - merged[-1][0], age, merged))
        age += 1
    found = []
    for _, number in heap[0][2] if heap else []:
        members, open_numbers = [], [number]
        while open_numbers:
            n = open_numbers.pop()
            if n < len(sizes):
                members.append(n)
            else:
                open_numbers.extend(unions[n - len(sizes)])
        found.append(members)
    return found + [[] for _ in range(k - len(found))]


def windows(sizes: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Near-equal subsets with sums within capacity; every size must be.

    Their count is one that fits while the next smaller one does not, and depends on the sizes alone. Each
    trial gives the spread above the mean, and that the count to try next.
    """
    if not sizes:
        return []
    total = sum(sizes)
    low = max(-(-total // capacity), sum(2 * size > capacity for size in sizes)) - 1  # too few in any case
    high, best = len(sizes), [[i] for i in range(len(sizes))]
    k, step = low + 1, 1
    while high - low > 1:
        found = differencing(sizes, k)
        most = max(sum(sizes[i] for i in w) for w in found)
        room = capacity - most + total / k  # the mean at which this spread would fit
        guess = int(total / room) + 1 if room > 0 else high
        if most <= capacity:
            high, best = k, found
            k = min(guess, k - step)
        else:
            low = k
            k = max(guess, k + step)
        step *= 2
        if not low < k < high:
            k = (low + high) // 2 if high < len(sizes) else min(max(k, low + 1), high - 1)
    return [w for w in best if w]


def _pack(capacity: int, max_piece: int, block_pieces: int, path: str, end_id: int | None, doc: str, text: str):
    end = b"" if end_id is None else int(end_id).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.encoder(tokens.tokenizer_path(path))
        context = TaskContext.get()
        sequence = (context.partitionId() if context else 0) << 34
        rows: list[tuple] = []
        loose: list[tuple] = []
        held = 0

        def close_block():
            nonlocal sequence
            for members in windows([piece[2] for piece in loose], capacity):
                at = 0
                for i in sorted(members):
                    key, start, length, total, ids = loose[i]
                    rows.append((key, start, length, total, sequence, at, ids))
                    at += length
                sequence += 1
            loose.clear()

        def batch():
            columns = list(zip(*rows))
            kinds = [pa.int64()] * 6 + [pa.binary()]
            made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=NAMES)
            rows.clear()
            return made

        for source in batches:
            for key, body in zip(source[doc].to_pylist(), source[text]):
                ids = encoder.encode(body.as_py()) + end
                total = len(ids) // 4
                whole = total - total % capacity
                for start in range(0, whole, capacity):
                    rows.append((key, start, capacity, total, sequence, 0, ids[4 * start : 4 * (start + capacity)]))
                    sequence += 1
                parts = -(-(total - whole) // max_piece)
                for p in range(parts):
                    low = whole + (total - whole) * p // parts
                    high = whole + (total - whole) * (p + 1) // parts
                    loose.append((key, low, high - low, total, ids[4 * low : 4 * high]))
                held += len(ids)
                if len(loose) >= block_pieces:
                    close_block()
                if held > 4 << 20 and rows:
                    yield batch()
                    held = 0
        close_block()
        if rows:
            yield batch()

    return run


def pack(
    docs: DataFrame,
    tokenizer: str = tokens.DEFAULT_FILE,
    capacity: int = CAPACITY,
    max_piece: int = MAX_PIECE,
    block_pieces: int = BLOCK_PIECES,
    end_id: int | None = END_ID,
    doc: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, sequence_id, offset, ids (little-endian uint32).

    Null text is empty and still has its end id; a document without ids (``end_id=None``) gives no row.
    A null doc_id stays null. Repeated rows are packed each on their own. A long text fills whole sequences, and what is
    left of it is packed with others; an empty table gives no rows. Other columns, whatever their names, are not read.
    A sequence is its pieces in order of offset, padded to ``padded_length`` of their sum.
    """
    source = docs.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return source.mapInArrow(_pack(capacity, max_piece, block_pieces, tokenizer, end_id, "doc_id", "text"), SCHEMA)


def padded_length(filled: int, capacity: int = CAPACITY) -> int:
    """A sequence filled to a power of two needs no padding; any other is padded to capacity."""
    return filled if filled & (filled - 1) == 0 else capacity

"""Benchmark passages in documents: windows that share enough shingles with an item, then exact similarity.

A window of a document has as many words as a benchmark item. Items are found by their rarest shingles: a window that is alike
enough shares so many of an item's shingles that it must hold one of these, so all others are passed over and nothing is lost.
A window passes on if it has as many shingles of the item as the least similarity asks for, a bound that loses nothing
either. What passes is judged by the weighted Jaccard similarity of its shingles, each weighted by how often it stands there,
carried on from window to window. Items below five words are one shingle of their own length, found in windows of that length.

The benchmark is written as files of items by tasks and read by tasks; it never passes through the driver.
"""

from __future__ import annotations

import io
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
from pyspark.sql import DataFrame

from sluice.llm import files, hashing

PERCENT = 75
BLOCK_CHARS = 8 << 20  # benchmark text in one index file, or one item
FOUND = "doc_id long, item_id long, similarity double, first_word long, n_words long"
FILTER_BITS = 20


def similarities(shingles: np.ndarray, n: int, starts: np.ndarray, item: np.ndarray) -> Iterator[tuple[int, float]]:
    """Each start, ascending, with the similarity of its window of n shingles to the item.

    It is the sum of the lesser over the sum of the greater weights. The lesser ones are kept up as the
    window moves: one step a shingle, however often it stands there.
    """
    wanted: Counter = Counter(item.tolist())
    low = high = common = 0
    held: Counter = Counter()
    for start in starts.tolist():
        if start >= high:
            low = high = start
            common = 0
            held.clear()
        for s in shingles[high : start + n].tolist():
            held[s] += 1
            common += held[s] <= wanted[s] if s in wanted else 0
        high = start + n
        for s in shingles[low:start].tolist():
            common -= held[s] <= wanted[s] if s in wanted else 0
            held[s] -= 1
        low = start
        yield start, common / (n + len(item) - common)


@dataclass
class Item:
    item_id: int | None
    words: int
    shingles: np.ndarray


def least_shared(n: int, m: int, percent: int) -> int:
    """How many shingles a window of n must share with an item of m for the similarity, repeated ones counted."""
    return max(1, int(np.ceil(percent * (n + m) / (100 + percent) - 1e-6)))


@dataclass
class Index:
    """Items of five words and more by their rarest shingles, and shorter ones by their length and only shingle."""

    items: list[Item]
    percent: int = PERCENT
    filter: np.ndarray = field(init=False)
    known: np.ndarray = field(init=False)
    holders: dict[int, list[int]] = field(init=False)
    short: dict[int, dict[int, list[int]]] = field(init=False)

    def __post_init__(self):
        self.holders, self.short = {}, {}
        every = Counter(s for item in self.items if item.words >= hashing.SHINGLE for s in set(item.shingles.tolist()))
        for k, item in enumerate(self.items):
            if item.words < hashing.SHINGLE:
                self.short.setdefault(item.words, {}).setdefault(int(item.shingles[0]), []).append(k)
                continue
            # the shortest window that can be alike has the item's share of its shingles, all of them shared
            m = len(item.shingles)
            spare = m - least_shared(max(1, -(-m * self.percent // 100)), m, self.percent) + 1
            rarest = sorted(item.shingles.tolist(), key=lambda s: (every[s], s))[: max(1, spare)]
            for s in set(rarest):
                self.holders.setdefault(s, []).append(k)
        self.known = np.array(sorted(self.holders), dtype=np.uint64)
        self.filter = np.zeros(1 << FILTER_BITS, dtype=bool)
        self.filter[(self.known & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)] = True

    def hits(self, shingles: np.ndarray) -> np.ndarray:
        """Places of the shingles by which items are found."""
        maybe = np.flatnonzero(self.filter[(shingles & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)])
        return maybe[np.isin(shingles[maybe], self.known)] if len(maybe) else maybe

    def search(self, shingles: np.ndarray, words: int, hits: np.ndarray) -> Iterator[tuple[int | None, float, int, int]]:
        """(item, similarity, first word, words) of each item's best window that is alike enough."""
        for k in sorted({k for s in np.unique(shingles[hits]).tolist() for k in self.holders[s]}):
            item = self.items[k]
            n = max(1, min(item.words, words) - hashing.SHINGLE + 1)
            best = (0.0, 0)
            for start, similarity in similarities(shingles, n, self._enough(shingles, n, item), item.shingles):
                if similarity > best[0]:
                    best = (similarity, start)
            if 100 * best[0] >= self.percent - 1e-9:
                yield item.item_id, best[0], best[1], min(item.words, words)

    def _enough(self, shingles: np.ndarray, n: int, item: Item) -> np.ndarray:
        """Starts of the windows with as many places of the item's shingles as the similarity asks for."""
        sums = np.concatenate(([0], np.cumsum(np.isin(shingles, item.shingles))))
        return np.flatnonzero(sums[n:] - sums[:-n] >= least_shared(n, len(item.shingles), self.percent))

    def search_short(self, words: np.ndarray, size: int) -> Iterator[tuple[int | None, float, int, int]]:
        """The items of ``size`` words that the words hold, each at its first place."""
        made, _ = hashing.shingles(words, np.array([0, len(words)]), size)
        first = dict(zip(*(x.tolist() for x in np.unique(made, return_index=True))))
        for s, held in self.short[size].items():
            if s in first:
                for k in held:
                    yield self.items[k].item_id, 1.0, first[s], size

    def found(self, texts: pa.Array) -> Iterator[tuple[int, tuple[int | None, float, int, int]]]:
        """(row, match) of all matches in a column of texts."""
        for first, _, words, starts in hashing.word_chunks(texts):
            made, offsets = hashing.shingles(words, starts)
            hit = self.hits(made)
            row_of = np.searchsorted(offsets, hit, side="right") - 1
            for k in np.unique(row_of).tolist():
                own = hit[row_of == k] - offsets[k]
                for match in self.search(made[offsets[k] : offsets[k + 1]], int(starts[k + 1] - starts[k]), own):
                    yield first + k, match
            for size in sorted(self.short):
                for k in np.flatnonzero(np.diff(starts) >= size).tolist():
                    for match in self.search_short(words[starts[k] : starts[k + 1]], size):
                        yield first + k, match


def _items(ids: list[int | None], texts: pa.Array) -> Iterator[Item]:
    """Items of a batch; those without words are none. An item below five words is one shingle, its whole sequence."""
    for first, last, words, starts in hashing.word_chunks(texts):
        made, offsets = hashing.shingles(words, starts)
        for k in range(first, last):
            n = int(starts[k - first + 1] - starts[k - first])
            if 0 < n < hashing.SHINGLE:
                own = words[starts[k - first] : starts[k - first + 1]]
                yield Item(ids[k], n, hashing.shingles(own, np.array([0, n]), n)[0])
            elif n:
                yield Item(ids[k], n, made[offsets[k - first] : offsets[k - first + 1]])


def _packed(items: list[Item]) -> bytes:
    ids = [item.item_id for item in items]
    out = io.BytesIO()
    np.savez(
        out, ids=np.array([i or 0 for i in ids], dtype=np.int64), null=np.array([i is None for i in ids]), words=np.array([i.words for i in items], dtype=np.int64),
        sizes=np.array([len(i.shingles) for i in items], dtype=np.int64), shingles=np.concatenate([i.shingles for i in items]),
    )
    return out.getvalue()


def _unpacked(raw: bytes) -> list[Item]:
    held = np.load(io.BytesIO(raw))
    ends = np.cumsum(held["sizes"])
    whole, null = held["shingles"], held["null"].tolist()
    rows = zip(held["ids"].tolist(), null, held["words"].tolist(), (ends - held["sizes"]).tolist(), ends.tolist())
    return [Item(None if gone else i, n, whole[a:b]) for i, gone, n, a, b in rows]


def write_index(benchmark: DataFrame) -> tuple[str, list[tuple[str, ...]]]:
    """Write the benchmark as files of items; the folder, and the files of each index of about BLOCK_CHARS characters.

    Every task writes what it reads, at most BLOCK_CHARS to a file; small files are read together. Names and sizes of
    the files come to the driver, the items never do.
    """
    folder = files.new_folder(benchmark.sparkSession, "benchmark")
    source = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def close() -> pa.RecordBatch:
            out = files.NewFile(folder, ".npz")
            out.write(_packed(held))
            out.close()
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([out.name]), pa.array([size], pa.int64())], names=["file", "chars"])

        for batch in batches:
            for part in files.chunks_of([batch], "text", 1 << 20):
                held += _items(part["item_id"].to_pylist(), part["text"])
                size += sum(map(len, part["text"].to_pylist()))
                if held and size >= BLOCK_CHARS:
                    yield close()
                    size = 0
        if held:
            yield close()

    rows = files.written(source.mapInArrow(run, "file string, chars long"), "benchmark-files").orderBy("file").collect()
    groups: list[list[str]] = []
    room = 0
    for row in rows:
        if not groups or row.chars > room:
            groups.append([])
            room = BLOCK_CHARS
        groups[-1].append(row.file)
        room -= row.chars
    return folder, [tuple(g) for g in groups]


_indexes: dict[tuple[str, tuple[str, ...], int], Index] = {}


def _index(folder: str, names: tuple[str, ...], percent: int) -> Index:
    """The worker's index of some files; one at a time is held."""
    key = (folder, names, percent)
    if key not in _indexes:
        _indexes.clear()
        items = []
        for name in names:
            with files.open_input(folder, name) as source:
                items += _unpacked(source.read())
        _indexes[key] = Index(items, percent)
    return _indexes[key]


def matches(docs: DataFrame, benchmark: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row per document row and item: doc_id, item_id, similarity, first_word, n_words of the best window.

    Each index is one narrow pass over all documents, whole texts, however long. Null and empty texts match nothing; a
    text shorter than an item of five words and more is one window. Null ids are kept as null. Repeated items and
    documents are reported each, ties go to the first window. Other columns, whatever their names, are not read.
    """
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    folder, indexes = write_index(benchmark)
    out = None
    for names in indexes:
        part = source.mapInArrow(_scan(folder, names, percent), FOUND)
        out = part if out is None else out.unionByName(part)
    return docs.sparkSession.createDataFrame([], FOUND) if out is None else out


def _scan(folder: str, files_: tuple[str, ...], percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch["doc_id"].to_pylist()
            rows = [(ids[row], *match) for row, match in _index(folder, files_, percent).found(batch["text"])]
            if rows:
                kinds = (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64())
                names = [f.split()[0] for f in FOUND.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

    return run


def clean(docs: DataFrame, benchmark: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark passage; columns unchanged. Rows whose id is null are judged too."""
    folder, indexes = write_index(benchmark)
    rest = docs
    for names in indexes:
        rest = rest.mapInArrow(_keep(folder, names, percent), docs.schema)
    return rest


def _keep(folder: str, names: tuple[str, ...], percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in files.chunks_of(batches, "text"):
            keep = np.ones(batch.num_rows, dtype=bool)
            for row, _ in _index(folder, names, percent).found(batch["text"]):
                keep[row] = False
            yield batch.filter(pa.array(keep))

    return run

"""Byte-level BPE by ranks: whole pre-tokens through a minimal perfect hash, the others by a heap over linked bytes.

A text is split by the pattern of the rank file. Pre-tokens of many texts are looked up together: their hashes go
through a minimal perfect hash of the vocabulary, and what stands in the slot is compared byte by byte. A pre-token
that is not a token itself is merged from its bytes, which are a linked list; a heap gives the pair of least
rank, of equals the leftmost, and a merge pushes the two pairs it makes. So a pre-token of n bytes
takes n log n steps, however long it is.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from hashlib import sha256
from heapq import heapify, heappop, heappush
from itertools import compress

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
from pyspark.sql import DataFrame

from sluice.llm import files, hashing, tokens

DEFAULT_FILE = "byte_bpe_multi_50k.tiktoken"
SLICE_CHARS = 1 << 18  # a text is split by so many characters at a time, so its pre-tokens never stand all in memory
CHUNK_CHARS = 1 << 20  # text whose pre-tokens are looked up together
MERGED = 500_000  # merged pre-tokens that a worker remembers before it starts anew
ROOM = 2  # bits of a level of the perfect hash for each key that reaches it

# The pre-tokens on both sides of such a place never depend on each other: a run of letters or of numbers is taken
# to its end, no pre-token goes from other characters into white space, and the pattern looks ahead at white space only.
CUT = r"\S(?=\s)|\p{L}(?=\P{L})|\p{N}(?=\P{N})"


class PerfectHash:
    """A minimal perfect hash of 64-bit keys, a bitmap for each level.

    A key sets the bit that its hash names on the first level where no other key names it; its slot is the number of
    set bits before that one, from a rank directory of 64-bit blocks. So n keys have the slots 0 to n - 1.
    """

    def __init__(self, keys: np.ndarray):
        if len(np.unique(keys)) < len(keys):
            raise ValueError("two keys are equal")
        self.levels: list[tuple[int, int]] = []
        parts, first, rest = [], 0, keys
        while len(rest):
            size = -(-max(ROOM * len(rest), 64) // 64) * 64
            at = self._place(rest, len(self.levels), size)
            alone = np.bincount(at, minlength=size) == 1
            parts.append(alone)
            self.levels.append((first, size))
            first += size
            rest = rest[~alone[at]]
        bits = np.concatenate(parts) if parts else np.zeros(64, dtype=bool)
        self.words = np.packbits(bits, bitorder="little").view("<u8")
        self.ranks = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)))[:-1]

    @staticmethod
    def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (hashing.mix(keys + np.uint64((level + 1) * 0x9E3779B97F4A7C15 % (1 << 64))) % np.uint64(size)).astype(np.int64)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; any slot, or -1, for what is no key."""
        out, rest = np.full(len(keys), -1, dtype=np.int64), np.arange(len(keys))
        for level, (first, size) in enumerate(self.levels):
            at = first + self._place(keys[rest], level, size)
            word, bit = self.words[at >> 6], (at & 63).astype(np.uint64)
            here = (word >> bit) & np.uint64(1) > 0
            below = word[here] & ((np.uint64(1) << bit[here]) - np.uint64(1))
            out[rest[here]] = self.ranks[at[here] >> 6] + np.bitwise_count(below)
            rest = rest[~here]
            if not len(rest):
                break
        return out


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of the bytes of a pre-token after all merges, least rank first, of equals leftmost."""
    n, rank = len(piece), ranks.get
    after = list(range(1, n + 1))  # where the part that begins here ends; 0 once it is part of another
    before = list(range(-1, n - 1))
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank(piece[i : i + 2])) is not None]
    heapify(heap)
    while heap:
        _, i, end = heappop(heap)
        j = after[i]
        if not j or j >= n or after[j] != end:
            continue  # one of its parts has been merged with another since
        after[i], after[j] = end, 0
        if end < n:
            before[end] = i
            wide = rank(piece[i : after[end]])
            if wide is not None:
                heappush(heap, (wide, i, after[end]))
        k = before[i]
        if k >= 0:
            wide = rank(piece[k:end])
            if wide is not None:
                heappush(heap, (wide, k, end))
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i : after[i]]])
        i = after[i]
    return ids


class Merged(dict):
    """Ids, as bytes, of the pre-tokens merged so far."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks

    def __missing__(self, piece: bytes) -> bytes:
        self[piece] = ids = np.array(merge(piece, self.ranks), "<u4").tobytes()
        return ids


class Vocabulary:
    """Tokens by rank, their perfect hash, and the pattern that splits a text.

    ``public`` says that it is the public tokenizers' pattern; then Latin texts are split by the faster ``tokens.SPLIT``.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str, public: bool = False):
        import regex

        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("a byte has no rank")
        self.ranks = ranks
        self.tokens = {i: t for t, i in ranks.items()}
        self.names = {i: str(i) for i in self.tokens}
        self.pattern, self.cut = regex.compile(pattern), regex.compile(CUT)
        self.public = public
        self.merged = Merged(ranks)

        listed = list(ranks)
        self.words = -(-max(map(len, listed)) // 8)
        data = np.frombuffer(b"".join(listed), dtype=np.uint8)
        ends = np.cumsum([len(t) for t in listed])
        starts = np.concatenate(([0], ends[:-1]))
        keys = hashing.span_hashes(data, starts, ends)
        self.hash = PerfectHash(keys)
        slot = self.hash.slots(keys)
        self.sizes, self.ids = np.empty(len(listed), np.int64), np.empty(len(listed), "<u4")
        self.sizes[slot], self.ids[slot] = ends - starts, np.fromiter(ranks.values(), "<u4", len(listed))
        self.bytes = np.empty((self.words, len(listed)), dtype="<u8")
        for k in range(self.words):
            self.bytes[k, slot] = self._word(self._padded(data), starts, ends - starts, k)

    def _padded(self, data: np.ndarray) -> np.ndarray:
        """A view that has the eight bytes from each place on as one number."""
        whole = np.concatenate((data, np.zeros(8 * self.words + 8, np.uint8)))
        return np.ndarray(len(whole) - 7, "<u8", whole, strides=(1,))

    @staticmethod
    def _word(view: np.ndarray, starts: np.ndarray, sizes: np.ndarray, k: int) -> np.ndarray:
        """The k-th eight bytes of each span, zeros after its end."""
        own = np.clip(sizes - 8 * k, 0, 8)
        shift = (64 - 8 * np.maximum(own, 1)).astype(np.uint64)
        held = view[np.minimum(starts + 8 * k, len(view) - 1)]
        return np.where(own > 0, (held << shift) >> shift, np.uint64(0))

    def _known(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The slot of each span that is a token, byte for byte, else -1."""
        slot, sizes, view = self.hash.slots(hashing.span_hashes(data, starts, ends)), ends - starts, self._padded(data)
        same = (slot >= 0) & (self.sizes[slot] == sizes)
        for k in range(self.words):
            rows = np.flatnonzero(same & (sizes > 8 * k)) if k else np.flatnonzero(same)
            same[rows] = self._word(view, starts[rows], sizes[rows], k) == self.bytes[k, slot[rows]]
        return np.where(same, slot, -1)

    def _slices(self, text: str) -> Iterator[str]:
        first = 0
        while first < len(text):
            found = self.cut.search(text, first + SLICE_CHARS) if len(text) - first > SLICE_CHARS else None
            last = found.end() if found else len(text)
            yield text[first:last]
            first = last

    def _split(self, part: str) -> list[bytes]:
        if self.public and not tokens.OTHER.search(part):
            return tokens.SPLIT.findall(part.encode())
        return [piece.encode() for piece in self.pattern.findall(part)]

    def _ids(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces in a row, and where each piece's begin, with the end."""
        data = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        ends = np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)))
        slot = self._known(data, np.concatenate(([0], ends[:-1])), ends)
        one = slot >= 0
        if len(self.merged) > MERGED:
            self.merged.clear()
        rest = list(map(self.merged.__getitem__, compress(pieces, (~one).tolist())))
        counts = np.ones(len(pieces), np.int64)
        counts[~one] = np.fromiter(map(len, rest), np.int64, len(rest)) // 4
        offsets = np.concatenate(([0], np.cumsum(counts)))
        ids, whole = np.empty(offsets[-1], "<u4"), np.zeros(offsets[-1], dtype=bool)
        whole[offsets[:-1][one]] = True
        ids[whole] = self.ids[slot[one]]
        ids[~whole] = np.frombuffer(b"".join(rest), "<u4")
        return ids, offsets

    def encode(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        """The ids of each text, in order. Pre-tokens of neighbouring texts are looked up together."""
        pieces: list[bytes] = []
        marks: list[tuple[int, bool]] = []  # pieces after a slice, and whether its text ends there
        open_text: list[np.ndarray] = []
        chars = 0

        def flush() -> Iterator[np.ndarray]:
            nonlocal open_text, chars
            ids, offsets = self._ids(pieces)
            first = 0
            for last, ends in marks:
                open_text.append(ids[offsets[first] : offsets[last]])
                first = last
                if ends:
                    yield open_text[0] if len(open_text) == 1 else np.concatenate(open_text)
                    open_text = []
            pieces.clear()
            marks.clear()
            chars = 0

        for text in texts:
            for part in self._slices(text or ""):
                pieces += self._split(part)
                marks.append((len(pieces), False))
                chars += len(part)
                if chars >= CHUNK_CHARS:
                    yield from flush()
            marks.append((len(pieces), True))
        yield from flush()

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of the ids; an id that is no rank raises."""
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))

    def listed(self, ids: np.ndarray) -> str:
        """Decimal ids joined by commas."""
        return ",".join(map(self.names.__getitem__, ids.tolist()))


_vocabularies: dict[tuple[str, str | None], Vocabulary] = {}


def vocabulary(name_or_path: str = DEFAULT_FILE, pattern: str | None = None) -> Vocabulary:
    """The worker's vocabulary of a rank file (base64 token, space, rank by line); it lives as long as the worker.

    A name without a slash is a public tokenizer's file on this machine. Without a pattern theirs is taken.
    """
    key = (name_or_path, pattern)
    if key not in _vocabularies:
        path, split = name_or_path, pattern
        if "/" not in path or split is None:
            import public_tokenizers

            path = path if "/" in path else public_tokenizers.path(path)
            split = split or public_tokenizers.PATTERN
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        _vocabularies[key] = Vocabulary(ranks, split, public=pattern is None)
    return _vocabularies[key]


def encode(docs: DataFrame, name_or_path: str = DEFAULT_FILE, pattern: str | None = None) -> DataFrame:
    """One row per input row: doc_id, ids (array of int).

    Null and empty texts have no ids. Rows whose doc_id is null, repeated rows and repeated ids are kept each; other
    columns, whatever their names, are not read. A long text is split in slices; its ids alone are held whole.
    """
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(name_or_path, pattern)
        for batch in batches:
            for part in files.chunks_of([batch], "text"):
                made = list(words.encode(part["text"].to_pylist()))
                offsets = np.concatenate(([0], np.cumsum([len(m) for m in made]))).astype(np.int32)
                ids = pa.array(np.concatenate([*made, np.empty(0, "<u4")]).astype(np.int32))
                yield pa.RecordBatch.from_arrays([part["doc_id"], pa.ListArray.from_arrays(pa.array(offsets), ids)], names=["doc_id", "ids"])

    return source.mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, name_or_path: str = DEFAULT_FILE) -> DataFrame:
    """One row per row of ``encode``: doc_id, decoded (binary). Null ids are none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(name_or_path)
        for batch in batches:
            for doc, ids in _rows(batch):
                yield pa.RecordBatch.from_arrays([pa.array([doc], pa.int64()), pa.array([words.decode(ids)], pa.large_binary()).cast(pa.binary())], names=["doc_id", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, decoded binary")


DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
DIGEST_IDS = 1 << 18


def digests(encoded: DataFrame, name_or_path: str = DEFAULT_FILE) -> DataFrame:
    """One row per row of ``encode``: doc_id, n_tokens, and SHA-256 of the listed ids and of the decoded bytes, run by run."""
    names = [f.split()[0] for f in DIGESTS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(name_or_path)
        for batch in batches:
            rows = []
            for doc, ids in _rows(batch):
                listed, decoded = sha256(), sha256()
                for k in range(0, len(ids), DIGEST_IDS):
                    part = ids[k : k + DIGEST_IDS]
                    listed.update((("," if k else "") + words.listed(part)).encode())
                    decoded.update(words.decode(part))
                rows.append((doc, len(ids), listed.hexdigest(), decoded.hexdigest()))
            if rows:
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    return encoded.select("doc_id", "ids").mapInArrow(run, DIGESTS)


def _rows(batch: pa.RecordBatch) -> Iterator[tuple[int | None, np.ndarray]]:
    lists = batch["ids"]
    ids = lists.values.to_numpy(zero_copy_only=False)
    offsets = lists.offsets.to_numpy()
    for doc, first, last in zip(batch["doc_id"].to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist()):
        yield doc, ids[first:last]

"""Word and shingle hashes of whole text columns, computed on the column's UTF-8 bytes.

A word's hash is a polynomial over a random table of its bytes, taken from running sums, so a batch of
texts is hashed by a few vector operations and no Python loop over words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SEGMENT = 1 << 18  # bytes hashed at once, with some 60 bytes of working memory each; a longer text is cut between words
SPACES = b" \t\n\x0b\x0c\r"
SHINGLE = 5

_rng = np.random.default_rng(20240607)
_TABLE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MULTIPLIERS = _rng.integers(1, 1 << 63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[list(SPACES)] = True
_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every input bit over the result."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_table(base: int, size: int) -> np.ndarray:
    table = _powers.get(base)
    if table is None or len(table) < size:
        steps = np.full(max(size, SEGMENT + 1), base, dtype=np.uint64)
        steps[0] = 1
        table = _powers[base] = np.multiply.accumulate(steps)
    return table


def _hash_words(data: np.ndarray, row_starts: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word and its row. ``row_starts`` are the rows' byte offsets with the end."""
    if not len(data):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    if lower:
        data = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
    space = _SPACE[data]
    breaks = np.zeros(len(data) + 1, dtype=bool)
    breaks[row_starts] = True
    before = np.concatenate(([True], space[:-1])) | breaks[:-1]
    after = np.concatenate((space[1:], [True])) | breaks[1:]
    starts = np.flatnonzero(~space & before)
    ends = np.flatnonzero(~space & after)
    sums = np.cumsum(_TABLE[data] * _power_table(_BASE, len(data))[: len(data)], dtype=np.uint64)
    low = np.where(starts > 0, sums[starts - 1], np.uint64(0))
    hashes = mix((sums[ends] - low) * _power_table(_INVERSE, len(data))[starts] + (ends - starts).astype(np.uint64))
    return hashes, np.searchsorted(row_starts, starts, side="right") - 1


def _long_row(data: np.ndarray, lower: bool) -> np.ndarray:
    parts, at = [], 0
    while at < len(data):
        end = min(at + SEGMENT, len(data))
        while end < len(data) and not _SPACE[data[end]]:
            end += 1
        parts.append(_hash_words(data[at:end], np.array([0, end - at]), lower)[0])
        at = end
    return np.concatenate(parts)


def column_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column and the rows' offsets in them; null is empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8)[offsets[0] : offsets[-1]] if raw else np.empty(0, np.uint8)
    return data, offsets - offsets[0]


def word_chunks(texts: pa.Array, lower: bool = True) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, word hashes, word offsets by row) for runs of rows of bounded bytes."""
    data, offsets = column_bytes(texts)
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + SEGMENT, side="right")) - 1)
        part = data[offsets[first] : offsets[last]]
        if len(part) > SEGMENT:
            hashes = _long_row(part, lower)
            yield first, last, hashes, np.array([0, len(hashes)])
        else:
            hashes, of = _hash_words(part, offsets[first : last + 1] - offsets[first], lower)
            yield first, last, hashes, np.searchsorted(of, np.arange(last - first + 1))
        first = last


def shingles(words: np.ndarray, starts: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of ``size`` words within a row, and the rows' offsets.

    A row of fewer words has its whole sequence as one shingle, a row without words none.
    """
    counts = np.diff(starts)
    short = np.flatnonzero((counts > 0) & (counts < size))
    made = np.where(counts >= size, counts - size + 1, (counts > 0).astype(counts.dtype))
    offsets = np.concatenate(([0], np.cumsum(made)))
    out = np.empty(offsets[-1], dtype=np.uint64)
    if len(words) >= size:
        sums = np.zeros(len(words) - size + 1, dtype=np.uint64)
        for k in range(size):
            sums += words[k : k + len(sums)] * _MULTIPLIERS[k]
        row = np.repeat(np.arange(len(counts)), counts)
        long_rows = np.repeat(counts >= size, made)
        out[long_rows] = mix(sums[row[: len(sums)] == row[size - 1 :]])
    for r in short:
        own = words[starts[r] : starts[r + 1]]
        joined = np.append(own * _MULTIPLIERS[: len(own)], np.uint64(len(own)))
        out[offsets[r]] = mix(joined.sum(dtype=np.uint64, keepdims=True))[0]
    return out, offsets


def window_hashes(data: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` bytes from each start; equal bytes have equal hashes wherever they stand."""
    if not len(starts):
        return np.empty(0, np.uint64)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_TABLE[data] * _power_table(_BASE, len(data))[: len(data)], dtype=np.uint64)))
    return mix((sums[starts + size] - sums[starts]) * _power_table(_INVERSE, len(data))[starts])


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of the bytes of each span; equal bytes have equal hashes wherever they stand."""
    if not len(starts):
        return np.empty(0, np.uint64)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_TABLE[data] * _power_table(_BASE, len(data))[: len(data)], dtype=np.uint64)))
    return mix((sums[ends] - sums[starts]) * _power_table(_INVERSE, len(data) + 1)[starts] + (ends - starts).astype(np.uint64))

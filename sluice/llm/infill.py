"""Fill-in-middle over seekable compressed frames.

Texts are stored as independent zstandard frames in segment files: a frame holds whole short texts one after another,
or a part of one long text, so it is of bounded size. Each text's row names its frames with the units (lines) and
characters that end up to each, so a cut after any number of units is found by a search in these counts and the
decompression of the one frame where it lies. The output is a list of pieces, marks and ranges of frames in order, which
is streamed frame by frame: into a digest, or as text.

A text is cut after the lesser and the greater of two numbers of units, both drawn from a hash of its doc_id.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
from pyspark.sql import DataFrame

from sluice.llm import files

# Fixed values of the format.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
MARK = re.compile(rb"<[PSM]>")

SEED = 7
RATE = 100  # of a hundred texts are rearranged
SUFFIX_FIRST = 50  # of a hundred rearranged texts begin with their suffix
FRAME_BYTES = 1 << 18
SEGMENT_BYTES = 64 << 20
LEVEL = 3
HELD_FRAMES = 4  # decompressed frames that a reader keeps

FRAME = "struct<at:long,size:int,raw:int,end:long,units:long,chars:long>"
STORED = f"doc_id long, file string, first long, n_bytes long, n_units long, n_chars long, marked boolean, frames array<{FRAME}>"
_FRAME = pa.struct([("at", pa.int64()), ("size", pa.int32()), ("raw", pa.int32()), ("end", pa.int64()), ("units", pa.int64()), ("chars", pa.int64())])
_STORED = pa.schema(
    [("doc_id", pa.int64()), ("file", pa.string()), ("first", pa.int64()), ("n_bytes", pa.int64()), ("n_units", pa.int64()), ("n_chars", pa.int64()),
     ("marked", pa.bool_()), ("frames", pa.list_(_FRAME))]
)


def units_in(raw: bytes) -> int:
    """Units of a whole text: lines with their ends, and what stands after the last line end."""
    return raw.count(b"\n") + (len(raw) > 0 and raw[-1:] != b"\n")


def chars_in(raw: bytes) -> int:
    return len(raw) if raw.isascii() else int(np.count_nonzero((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80))


def parts_of(raw: bytes, size: int) -> Iterator[bytes]:
    """A long text's bytes in runs of about ``size``, never cut inside a character."""
    first = 0
    while first < len(raw):
        last = min(first + size, len(raw))
        while last < len(raw) and raw[last] & 0xC0 == 0x80:
            last += 1
        yield raw[first:last]
        first = last


class _Segment:
    """The file that a task is writing, its open frame and the rows that wait for it."""

    def __init__(self, folder: str, frame_bytes: int):
        import zstandard

        self.folder, self.frame_bytes = folder, frame_bytes
        self.compress = zstandard.ZstdCompressor(level=LEVEL).compress
        self.file: files.NewFile | None = None
        self.open: list[bytes] = []
        self.size = 0
        self.waiting: list[dict] = []

    def add(self, doc_id: int | None, raw: bytes) -> list[dict]:
        """Take one text; the rows that are complete now."""
        row = {"doc_id": doc_id, "n_bytes": len(raw), "n_units": units_in(raw), "n_chars": chars_in(raw), "marked": MARK.search(raw) is not None}
        if self.file is None:
            self.file = files.NewFile(self.folder, ".frames")
        done = []
        if len(raw) <= self.frame_bytes:
            if self.size and self.size + len(raw) > self.frame_bytes:
                done = self.close_frame()
            self.waiting.append(row | {"first": self.size})
            self.open.append(raw)
            self.size += len(raw)
            return done
        done = self.close_frame()
        frames, end, units, chars = [], 0, 0, 0
        for part in parts_of(raw, self.frame_bytes):
            end, units, chars = end + len(part), units + part.count(b"\n"), chars + chars_in(part)
            last = row["n_units"] if end == len(raw) else units
            frames.append(self._write(part) | {"end": end, "units": last, "chars": chars})
        return [*done, row | {"first": 0, "file": self.file.name, "frames": frames}]

    def _write(self, raw: bytes) -> dict:
        at, packed = self.file.size, self.compress(raw)
        self.file.write(packed)
        return {"at": at, "size": len(packed), "raw": len(raw)}

    def close_frame(self) -> list[dict]:
        if not self.waiting:
            return []
        frame = self._write(b"".join(self.open))
        made = [r | {"file": self.file.name, "frames": [frame | {"end": r["n_bytes"], "units": r["n_units"], "chars": r["n_chars"]}]} for r in self.waiting]
        self.open, self.size, self.waiting = [], 0, []
        return made

    def close_file(self) -> list[dict]:
        done = self.close_frame()
        if self.file is not None:
            self.file.close()
            self.file = None
        return done


def store(docs: DataFrame, frame_bytes: int = FRAME_BYTES, segment_bytes: int = SEGMENT_BYTES) -> tuple[str, DataFrame]:
    """Write all texts as frames; the folder, and a table with a row per input row (see ``STORED``).

    ``first`` is where a text begins in its first frame. A frame's ``end``, ``units`` and ``chars`` are the bytes,
    units and characters of the text up to its end. Null text is empty. Null and repeated ids are kept each; other
    columns are not read. Only files that the table names count, so a task that ran twice does no harm.
    """
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    folder = files.new_folder(docs.sparkSession, "frames")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment, rows = _Segment(folder, frame_bytes), []
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
                rows += segment.add(doc_id, text.as_buffer().to_pybytes())
                if segment.file.size >= segment_bytes:
                    rows += segment.close_file()
                if len(rows) >= 2000:
                    yield pa.RecordBatch.from_pylist(rows, schema=_STORED)
                    rows = []
        rows += segment.close_file()
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=_STORED)

    return folder, files.written(source.mapInArrow(run, STORED), "frames-index")


class Frames:
    """Decompressed frames of the files in a folder, read by offset; the last few are kept."""

    def __init__(self, folder: str):
        import zstandard

        self.folder = folder
        self.decompress = zstandard.ZstdDecompressor().decompress
        self.name, self.source = None, None
        self.held: OrderedDict[int, bytes] = OrderedDict()

    def frame(self, name: str, at: int, size: int, raw: int) -> bytes:
        if name != self.name:
            self.close()
            self.name, self.source = name, files.open_input(self.folder, name)
        if at not in self.held:
            self.source.seek(at)
            self.held[at] = self.decompress(self.source.read(size), max_output_size=raw)
            if len(self.held) > HELD_FRAMES:
                self.held.popitem(last=False)
        return self.held[at]

    def close(self) -> None:
        self.held.clear()
        if self.source is not None:
            self.source.close()
            self.name = self.source = None


@dataclass(frozen=True)
class Cut:
    """A place in a text: the frame where it lies, bytes and characters before it."""

    frame: int
    byte: int
    char: int


class Text:
    """One stored text: places after so many units, and its bytes as a stream of frames."""

    def __init__(self, frames: Frames, row: dict):
        self.frames, self.row = frames, row
        self.ends = [f["end"] for f in row["frames"]]

    def _bytes(self, k: int) -> bytes:
        frame = self.row["frames"][k]
        whole = self.frames.frame(self.row["file"], frame["at"], frame["size"], frame["raw"])
        if len(self.ends) > 1:
            return whole
        return whole[self.row["first"] : self.row["first"] + self.row["n_bytes"]]

    def cut(self, units: int) -> Cut:
        """The place after ``units`` units; no frame but the one where it lies is decompressed."""
        row = self.row
        if units <= 0:
            return Cut(0, 0, 0)
        if units >= row["n_units"]:
            return Cut(len(self.ends) - 1, row["n_bytes"], row["n_chars"])
        k = bisect_left([f["units"] for f in row["frames"]], units)
        before = row["frames"][k - 1] if k else {"end": 0, "units": 0, "chars": 0}
        raw = self._bytes(k)
        at = int(np.flatnonzero(np.frombuffer(raw, np.uint8) == 10)[units - before["units"] - 1]) + 1
        return Cut(k, before["end"] + at, before["chars"] + chars_in(raw[:at]))

    def stream(self, first: int, last: int) -> Iterator[bytes]:
        """The bytes from ``first`` to before ``last``, a frame at a time."""
        k = bisect_left(self.ends, first + 1)
        while first < last:
            start = self.ends[k - 1] if k else 0
            yield self._bytes(k)[first - start : last - start]
            first, k = self.ends[k], k + 1


def draws(doc_id: int | None, seed: int) -> tuple[int, int, int, int]:
    """Four numbers from the hash of seed and id; a null id is written as nothing."""
    digest = sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return tuple(int(digest[8 * k : 8 * k + 8], 16) for k in range(4))


@dataclass(frozen=True)
class Plan:
    """How a text is arranged: its form, and the places of its two cuts (none if it is plain)."""

    form: str
    low: Cut | None = None
    high: Cut | None = None

    def output(self, text: Text) -> Iterator[bytes]:
        """The arranged text as a stream."""
        n = text.row["n_bytes"]
        if self.form == "plain":
            yield from text.stream(0, n)
            return
        prefix, middle, suffix = (0, self.low.byte), (self.low.byte, self.high.byte), (self.high.byte, n)
        order = [(PREFIX, prefix), (SUFFIX, suffix), (MIDDLE, middle)] if self.form == "psm" else [(SUFFIX, suffix), (PREFIX, prefix), (MIDDLE, middle)]
        for mark, (first, last) in order:
            yield mark
            yield from text.stream(first, last)


def plan(text: Text, seed: int = SEED, rate: int = RATE, suffix_first: int = SUFFIX_FIRST) -> Plan:
    row = text.row
    h1, h2, h3, h4 = draws(row["doc_id"], seed)
    if not row["n_bytes"] or row["marked"] or h3 % 100 >= rate:
        return Plan("plain")
    low, high = sorted((h1 % (row["n_units"] + 1), h2 % (row["n_units"] + 1)))
    return Plan("spm" if h4 % 100 < suffix_first else "psm", text.cut(low), text.cut(high))


def restored(output: Iterator[bytes], form: str) -> Iterator[bytes]:
    """The text that an arranged one was made of, from the output and its form alone.

    The parts are found by their marks; they are kept compressed until all are there, since a suffix may come first.
    """
    if form == "plain":
        yield from output
        return
    import zstandard

    pack, unpack = zstandard.ZstdCompressor(level=1).compress, zstandard.ZstdDecompressor().decompress
    parts: dict[bytes, list[bytes]] = {PREFIX: [], SUFFIX: [], MIDDLE: []}
    held, own = b"", None
    for block in output:
        held += block
        first = 0
        for found in MARK.finditer(held):
            if own is not None and found.start() > first:
                parts[own].append(pack(held[first : found.start()]))
            own, first = found.group(), found.end()
        keep = max(first, len(held) - len(PREFIX) + 1)  # a mark may begin in the last two bytes
        if keep > first:
            parts[own].append(pack(held[first:keep]))
        held = held[keep:]
    if held:
        parts[own].append(pack(held))
    for own in (PREFIX, MIDDLE, SUFFIX):
        for packed in parts[own]:
            yield unpack(packed)


ARRANGED = "doc_id long, n long, form string, prefix_chars long, middle_chars long"


def _read(folder: str, index: DataFrame, extra: str, make, seed: int, rate: int, suffix_first: int) -> DataFrame:
    kind = f"{ARRANGED}, {extra}"
    names = [f.split()[0] for f in kind.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), *[pa.string()] * (len(names) - 5)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frames = Frames(folder)
        for batch in batches:
            rows, held = [], 0
            for row in batch.to_pylist():
                text = Text(frames, row)
                how = plan(text, seed, rate, suffix_first)
                chars = (how.low.char, how.high.char - how.low.char) if how.low else (None, None)
                rows.append((row["doc_id"], row["n_units"], how.form, *chars, *make(how, text)))
                held += row["n_bytes"]
                if held > 8 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
        frames.close()

    # neighbours in a file share frames: each task takes a run of texts in the order of the files
    tasks = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    at = F.get("frames", F.lit(0))["at"]
    return index.repartitionByRange(tasks, "file", at, "first").sortWithinPartitions("file", at, "first").mapInArrow(run, kind)


def arranged(folder: str, index: DataFrame, seed: int = SEED, rate: int = RATE, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """One row per stored text: doc_id, n (units), form, prefix_chars, middle_chars, output.

    An empty text, a text that holds a mark and one outside ``rate`` stay plain, with null counts of characters.
    """
    return _read(folder, index, "output string", lambda how, text: (b"".join(how.output(text)).decode(),), seed, rate, suffix_first)


def digests(folder: str, index: DataFrame, seed: int = SEED, rate: int = RATE, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """As ``arranged``, with SHA-256 of the output and of the text rebuilt from it; no text is ever whole in memory."""

    def make(how: Plan, text: Text) -> tuple[str, str]:
        output, back = sha256(), sha256()

        def seen() -> Iterator[bytes]:
            for block in how.output(text):
                output.update(block)
                yield block

        for block in restored(seen(), how.form):
            back.update(block)
        return output.hexdigest(), back.hexdigest()

    return _read(folder, index, "output_sha256 string, restored_sha256 string", make, seed, rate, suffix_first)

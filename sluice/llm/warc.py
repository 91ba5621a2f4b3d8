"""Web archives: one gzip member per record, written by Spark tasks and read back record by record.

The reader is sequential: it inflates one member after the other as bytes arrive, frames the record by its
Content-Length and checks the digests. It holds one record at a time.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyspark.sql.functions as F
from pyspark.sql import DataFrame

from sluice.llm import files

# Fixed values of the format and of the contract.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
LEAST_SHARED = 100  # payloads below this many bytes are always full responses
FILE_BYTES = 128 << 20
DATE = "2024-01-01T00:00:00Z"


def record_id(page_id: int | None) -> str:
    """A stable URN for a page's record; pages without id get a random one."""
    return f"<urn:sluice:page:{page_id}>" if page_id is not None else f"<urn:uuid:{uuid.uuid4()}>"


def _digest(data: bytes) -> str:
    return "sha256:" + hashlib.sha256(data).hexdigest()


def member(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One record as one gzip member."""
    block = HTTP_HEAD if revisit else HTTP_HEAD + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_id(page_id)),
        ("WARC-Date", DATE),
        # header fields hold no control characters, so the address is written as base64 beside its printable form
        ("WARC-Target-URI", "".join(c if c.isprintable() else "%20" for c in url or "") or "about:blank"),
        ("X-Target-URI-Base64", "" if url is None else "=" + base64.b64encode(url.encode()).decode()),
        ("X-Page-ID", "" if page_id is None else str(page_id)),
        ("X-Payload-Length", str(len(payload))),
        ("WARC-Payload-Digest", _digest(payload)),
        ("WARC-Block-Digest", _digest(block)),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if revisit:
        fields[2:2] = [("WARC-Refers-To", record_id(refers_to)), ("WARC-Profile", PROFILE)]
    head = VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(head + block + b"\r\n\r\n") + packer.flush()


def members(stream, step: int = 1 << 20) -> Iterator[bytes]:
    """The inflated members of a stream of gzip members, one at a time."""
    inflater, out, pending = zlib.decompressobj(31), [], b""
    begun = False
    while True:
        data = pending or stream.read(step)
        pending = b""
        if not data:
            if begun:
                raise ValueError("archive ends within a record")
            return
        begun = True
        out.append(inflater.decompress(data))
        if inflater.eof:
            yield b"".join(out)
            pending, out, begun = inflater.unused_data, [], False
            inflater = zlib.decompressobj(31)


def parse(record: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (lower-case names) and block of a record; raises where length or digest is wrong."""
    head, sep, rest = record.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not sep or lines[0] != VERSION:
        raise ValueError("not a record of this version")
    fields = {}
    for line in lines[1:]:
        name, _, value = line.decode().partition(":")
        fields[name.strip().lower()] = value.strip()
    length = int(fields["content-length"])
    block = rest[:length]
    if len(block) != length or rest[length:] != b"\r\n\r\n":
        raise ValueError("record's length is not its Content-Length")
    if _digest(block) != fields["warc-block-digest"]:
        raise ValueError("block digest differs")
    if fields["warc-type"] == "response":
        payload = block.partition(b"\r\n\r\n")[2]
        if _digest(payload) != fields["warc-payload-digest"]:
            raise ValueError("payload digest differs")
    return fields, block


def write(pages: DataFrame) -> tuple[str, DataFrame]:
    """Archive every page; the folder and the table of its files (file, records, bytes).

    Payload is the html in UTF-8, null is empty. Of equal payloads of LEAST_SHARED bytes or more the
    smallest page_id is a response and the others revisit it. Repeated rows of that id are responses too.
    Pages without an id are responses unless an id with the same payload exists. Only files in the table
    count, so a task that ran twice does no harm.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce("html", F.lit("")).alias("html")
    ).withColumn("digest", F.when(F.octet_length("html") >= LEAST_SHARED, F.sha2("html", 256)))
    # page and digest alone are grouped, partly before the shuffle; the join can split a hot digest
    shared = rows.where("digest IS NOT NULL AND page_id IS NOT NULL").groupBy("digest").agg(F.min("page_id").alias("original"))
    marked = rows.join(shared, "digest", "left").select("page_id", "url", "html", "original")
    folder = files.new_folder(pages.sparkSession, "warc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, records = None, 0

        def close():
            out.close()
            return pa.RecordBatch.from_pydict({"file": [out.name], "records": [records], "bytes": [out.size]})

        for batch in batches:
            for page, url, html, original in zip(*(batch[c] for c in ("page_id", "url", "html", "original"))):
                if out is None:
                    out, records = files.NewFile(folder, ".warc.gz"), 0
                page, original = page.as_py(), original.as_py()
                revisit = original is not None and original != page
                out.write(member(page, url.as_py(), html.as_py().encode(), original, revisit))
                records += 1
                if out.size >= FILE_BYTES:
                    yield close()
                    out = None
        if out is not None:
            yield close()

    return folder, files.written(marked.mapInArrow(run, "file string, records long, bytes long"), "warc-index")


READ = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary"


def read(folder: str, index: DataFrame, payloads: bool = True) -> DataFrame:
    """One row per record of the archives; payload is null for revisits, and where not asked for."""
    names = [f.split()[0] for f in READ.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch["file"].to_pylist():
                rows, held = [], 0
                with files.open_input(folder, name) as source:
                    for record in members(source):
                        rows.append(_row(*parse(record), payloads))
                        held += len(record)
                        if held > 8 << 20:
                            yield _batch(rows, names)
                            rows, held = [], 0
                if rows:
                    yield _batch(rows, names)

    tasks = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return index.select("file").repartition(tasks, "file").mapInArrow(run, READ)


def _row(fields: dict[str, str], block: bytes, payloads: bool) -> tuple:
    revisit = fields["warc-type"] == "revisit"
    url = fields["x-target-uri-base64"]
    return (
        int(fields["x-page-id"]) if fields["x-page-id"] else None,
        base64.b64decode(url[1:]).decode() if url else None,
        fields["warc-type"],
        int(fields["x-payload-length"]),
        fields["warc-payload-digest"].removeprefix("sha256:"),
        int(fields["warc-refers-to"].rstrip(">").rpartition(":")[2]) if revisit else None,
        block.partition(b"\r\n\r\n")[2] if payloads and not revisit else None,
    )


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

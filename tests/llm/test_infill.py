"""Fill-in-middle against a plain version, whatever the frames; and that only cut frames are opened for a cut."""

import hashlib
import random
import re

import pytest

from sluice.llm import infill
from sluice.llm.queries import QUERIES, SQL
from tests import compare

ODD = [
    None, "", "one", "one\n", "\n", "\n\n\n", "a\nb", "a\nb\n", "é\nß日\n\n🙂", "has <M> in it\nand more", "<P", "<\nP\n>", "a <P\n>", "x" * 700, ("y" * 90 + "\n") * 40,
    "\r\n\r a   b\n", "\n".join(f"line {i} é" for i in range(300)),
]


def plain(doc_id, text, rate=100, first=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * k : 8 * k + 8], 16) for k in range(4))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return n, "plain", None, None, text
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    spm = h4 % 100 < first
    whole = f"<S>{suffix}<P>{prefix}<M>{middle}" if spm else f"<P>{prefix}<S>{suffix}<M>{middle}"
    return n, "spm" if spm else "psm", len(prefix), len(middle), whole


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(12)
    made = [(k, t) for k, t in enumerate(ODD)] + [(None, "null id\n" * 3), (5, "again\nagain"), (5, "again\nagain"), (-(1 << 63), "least\nid")]
    for k in range(60):
        lines = ["".join(draw.choice("ab é<>PSM") for _ in range(draw.choice([0, 1, 5, 60]))) for _ in range(draw.choice([1, 2, 30, 200]))]
        made.append((100 + k, "\n".join(lines)))
    return made


@pytest.mark.parametrize(("frame", "segment"), [(1 << 18, 64 << 20), (50, 400), (1, 1)])
def test_any_frames(spark, rows, frame, segment):
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, frames string, first int").coalesce(2)
    folder, index = infill.store(docs, frame, segment)
    want = sorted(((d, *plain(d, t)) for d, t in rows), key=str)
    assert sorted((tuple(r) for r in infill.arranged(folder, index).collect()), key=str) == want
    texts = {(d, plain(d, t)[-1]): t or "" for d, t in rows}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    got = sorted((tuple(r) for r in infill.digests(folder, index).collect()), key=str)
    assert got == sorted(((*w[:5], sha(w[5]), sha(texts[w[0], w[5]])) for w in want), key=str)
    assert infill.digests(*infill.store(docs.limit(0))).count() == 0


def test_rate(spark, rows):
    folder, index = infill.store(spark.createDataFrame(rows, "doc_id long, text string"))
    got = sorted((tuple(r) for r in infill.arranged(folder, index, rate=40, suffix_first=10).collect()), key=str)
    assert got == sorted(((d, *plain(d, t, 40, 10)) for d, t in rows), key=str)
    assert {r[2] for r in got} == {"plain", "spm", "psm"}


def test_a_cut_opens_one_frame(spark, monkeypatch):
    text = "".join(f"line {i}\n" for i in range(5000))
    folder, index = infill.store(spark.createDataFrame([(1, text)], "doc_id long, text string"), 1000)
    row = index.first().asDict(recursive=True)
    assert len(row["frames"]) > 40
    opened = []
    frames = infill.Frames(folder)
    read = frames.frame
    monkeypatch.setattr(frames, "frame", lambda name, at, *rest: opened.append(at) or read(name, at, *rest))
    cut = infill.Text(frames, row).cut(2500)
    assert text[: cut.char] == "".join(f"line {i}\n" for i in range(2500)) and cut.byte == cut.char
    assert opened == [row["frames"][cut.frame]["at"]]
    ends = [infill.Text(frames, row).cut(k).char for k in (0, 5000, 9999)]
    assert ends == [0, len(text), len(text)] and len(opened) == 1


def test_restored_from_torn_blocks():
    whole = "<S>end\n<P>start<M>mid< dle<S".encode()
    blocks = [whole[k : k + 1] for k in range(len(whole))]
    assert b"".join(infill.restored(iter(blocks), "spm")) == b"startmid< dle<Send\n"


def test_registered_query(spark):
    folder = "/root/testdata/sf0.001"
    assert compare.spark_rows(QUERIES["op12_fill_in_middle"](spark, folder)) == compare.duck_rows(compare.duck(folder), SQL["op12_fill_in_middle"])

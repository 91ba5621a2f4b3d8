"""Queries without SQL against slow plain versions: main texts of generated pages, fingerprints window by window."""

import hashlib
import html as entities
import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from sluice.llm import codes, fingerprints, hashing, html, ordered
from sluice.llm.queries import QUERIES

SHARED = "/root/testdata/sf0.001"


def plain_article(page):
    """The text of a page's one article: block by block, without inner tags."""
    inner = re.search(r"<article>(.*?)</article>", page, re.S).group(1)
    blocks = [entities.unescape(re.sub(r"<br>", " ", b)) for b in re.split(r"</?(?:h1|p)>", inner)]
    lines = (" ".join(re.sub(r"<[^>]*>", "", b).split()) for b in blocks)
    return "\n".join(line for line in lines if line)


def test_op8_query(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SHARED}/pages.parquet").collect()}
    rows = QUERIES["op8_main_text"](spark, SHARED).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert (r.url, r.text, r.n_chars) == (pages[r.page_id].url, plain_article(pages[r.page_id].html), len(r.text))


WRAPPERS = ["content has-sidebar", "no-sidebar related-work", "market-share", "with-comments", "promo-page", "page", ""]
JUNK = [
    "<div class='ad'>buy this now</div>", "<section id='comments'><article>first comment here with words</article></section>", "<div class='share-buttons'>share it</div>",
    "<ul class='main-nav'><li>home<li>about</ul>", "<div id='cookie-notice'>we use cookies</div>", "<aside>more of it</aside>", "<div class='related'><p>read also this</div>",
    "<form>your name <button>go</button></form>",
]


def test_generated_pages(spark):
    """Articles in all kinds of wrappers, with boilerplate before, within and after them."""
    draw = random.Random(8)
    made = []
    for k in range(80):
        blocks = [" ".join(draw.choice(["word", "more", "text", "é &amp; x", "a <b>bold</b> one", "market"]) for _ in range(draw.randint(4, 40))) for _ in range(draw.randint(2, 6))]
        shown = [" ".join(re.sub("<[^>]*>", "", entities.unescape(b)).split()) for b in blocks]
        inner = [f"<p>{b}</p>" for b in blocks]
        if draw.random() < 0.5:
            inner.insert(draw.randrange(len(inner)), draw.choice(JUNK[:1] + JUNK[2:]))
        page = f"<html><head><title>t</title></head><body><nav><a href=x>menu</a></nav>{draw.choice(JUNK)}<div class='{WRAPPERS[k % len(WRAPPERS)]}'><article>{''.join(inner)}</article></div>{draw.choice(JUNK)}<footer>end</footer>"
        made.append((k, page, "\n".join(shown)))
    pages = spark.createDataFrame([(k, f"u{k}", page, "own") for k, page, _ in made], "page_id long, url string, html string, text string")
    got = {r.page_id: r.text for r in html.extract(pages, html.fit(pages)).collect()}
    assert [got[k] for k, _, _ in made] == [want for _, _, want in made]


def test_pages_without_an_article():
    """A class that says something of an element does not make it boilerplate; reader comments always are."""
    body = "<p>" + "word " * 50 + "</p>"
    sizes = {name: len(html.main_text(f"<div class='{name}'>{body}</div>", html.Weights({})).split()) for name in ("has-comments", "comments", "content", "market-share")}
    assert sizes == {"has-comments": 50, "comments": 0, "content": 50, "market-share": 50}


def test_html_of_odd_tables(spark):
    long = "<article><p>" + "long text " * 50_000 + "</p></article>"
    pages = spark.createDataFrame([(1, "u", long, "x"), (1, "u", long, "x"), (None, None, None, None), (2, "v", "", "y"), (3, "w", "<br><br>", "z")], "page_id long, url string, html string, text string")
    rows = sorted(((r.page_id, len(r.text)) for r in html.extract(pages, html.fit(pages)).collect()), key=str)
    assert rows == [(1, 499_999), (1, 499_999), (2, 0), (3, 0), (None, 0)]
    assert html.extract(pages.limit(0), html.Weights({})).count() == 0


def plain_digest(raw, ranks):
    """Features window by window, then filters bit by bit."""
    size, near = fingerprints.WINDOW, fingerprints.NEIGHBOURS
    levels = []
    for k in range(len(raw) - size + 1):
        counts = Counter(b & 15 for b in raw[k : k + size])
        term = sum(round(100 * c * math.log2(c)) for c in counts.values())
        levels.append(int(np.clip(round((math.log2(size) - term / (100.0 * size)) / 4 * 255), 0, 255)))
    keys = [(ranks[v], k) if v >= fingerprints.LEAST_ENTROPY / 4 * 255 else None for k, v in enumerate(levels)]
    points = Counter()
    for first in range(-near + 1, len(levels)):
        around = [k for k in keys[max(first, 0) : first + near] if k is not None]
        if around:
            points[min(around)[1]] += 1
    chosen = sorted(k for k, n in points.items() if n >= fingerprints.POINTS)
    data = np.frombuffer(raw, np.uint8)
    if raw and not chosen:
        values = hashing.window_hashes(data, np.array([0]), len(raw)).tolist()
    else:
        values = hashing.window_hashes(data, np.array(chosen, dtype=np.int64), size).tolist() if chosen else []
    chain = b""
    for first in range(0, len(values), fingerprints.FEATURES):
        bits = np.zeros(fingerprints.FILTER_BITS, np.uint8)
        for v in values[first : first + fingerprints.FEATURES]:
            for h in range(fingerprints.HASHES):
                bits[v >> 10 * h & fingerprints.FILTER_BITS - 1] = 1
        chain += np.packbits(bits).tobytes()
    return chain


def test_op5_query(spark):
    docs = spark.read.parquet(f"{SHARED}/documents.parquet")
    ranks = fingerprints.entropy_ranks(docs)
    texts = [(r.doc_id, r.text or "") for r in docs.orderBy("doc_id").collect()]
    got = {r.doc_id: r for r in QUERIES["op5_fingerprints"](spark, SHARED).collect()}
    assert len(got) == len(texts)
    made = {}
    for k, (doc_id, text) in enumerate(texts):
        following = texts[(k + 1) % len(texts)][1]
        n = len(text) // 4
        changed = text[: len(text) - n] + following[:n]
        r = got[doc_id]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(changed.encode()).hexdigest())
        if k % 5 == 0:  # the plain digest of a long text takes a while
            for t, found in ((text, r.fingerprint), (changed, r.edited_fingerprint)):
                if len(t) < 4000:
                    made[t] = plain_digest(t.encode(), ranks)
                    assert found == made[t].hex()
        assert r.near_edited == pytest.approx(fingerprints.likeness(bytes.fromhex(r.fingerprint), bytes.fromhex(r.edited_fingerprint)))
        assert r.near_next == pytest.approx(fingerprints.likeness(bytes.fromhex(r.fingerprint), bytes.fromhex(got[texts[(k + 1) % len(texts)][0]].fingerprint)))
    assert len(made) > 20


FLAT = ["=" * 200, "-" * 300, "0 " * 100, "=" * 201]


def test_flat_texts_differ(spark):
    rows = [(k, t, "x", "y") for k, t in enumerate([*FLAT, FLAT[0], "", None, "w" * 100_000])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fingerprint string, _fingerprint string")
    out = fingerprints.fingerprint(docs, fingerprints.entropy_ranks(docs))
    assert out.columns == [*docs.columns, "__fingerprint"]
    got = {r.doc_id: r["__fingerprint"] for r in out.collect()}
    assert len({got[k] for k in range(4)}) == 4 and got[0] == got[4] and got[5] == got[6] == "" and got[7]
    assert {r.fingerprint for r in out.collect()} == {"x"}
    assert all(fingerprints.likeness(bytes.fromhex(got[a]), bytes.fromhex(got[b])) < 0.5 for a in range(4) for b in range(a))


def test_least_ids(spark, monkeypatch):
    """The least number is an id like any other; null is none."""
    least = -(1 << 63)
    rows = [(least, "a text"), (None, "no id"), (least + 1, "b"), (0, None), ((1 << 63) - 1, "last")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(ordered, "ROWS_PER_BUCKET", 1)
    monkeypatch.setattr(fingerprints.ordered, "bounds", lambda df, key, rows_per_bucket=1: [least, least + 1, 0, (1 << 63) - 1])
    got = [r.doc_id for r in codes.read(*codes.write(docs)).orderBy("start").collect()]
    assert got == [None, least, least + 1, 0, (1 << 63) - 1]
    pairs = {r.doc_id: r.next_text for r in fingerprints.with_next(docs).collect()}
    assert pairs == {None: "a text", least: "b", least + 1: "", 0: "last", (1 << 63) - 1: "no id"}

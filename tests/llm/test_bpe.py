"""Ids by ranks against the library, and the lookups against plain ones."""

import base64
import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from sluice.llm import bpe
from sluice.llm.queries import QUERIES

WORDS = bpe.vocabulary()
PLAIN = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=WORDS.ranks, special_tokens={})
ODD = [
    None, "", " ", "  a", "a\n\n b", "it's 'S we'll 'llama", "été Ñandú_1 __", "\t\r\n", "a b", "日本語 text", "<|endoftext|> a", "é", "x²½ a",
    "a" * 5000, "1234 12a", "...!?  ''ll", "\x1c\x1f\x0b\x85", "🙂🙂 👩‍👩‍👧", "﻿\x00", "ab" * 3000 + " " * 700, "antidisestablishmentarianisms" * 9,
]


def plain(text):
    return PLAIN.encode_ordinary(text or "")


def test_odd_texts_together_and_alone():
    assert [i.tolist() for i in WORDS.encode(ODD)] == [plain(t) for t in ODD]
    for text in ODD:
        (ids,) = WORDS.encode([text])
        assert ids.tolist() == plain(text) and WORDS.decode(ids) == (text or "").encode()
    assert list(WORDS.encode([])) == []


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab Zé'sñ12_.\n\t!ſ×日́"), max_size=40) | st.text(max_size=30), max_size=4))
def test_any_texts(texts):
    assert [i.tolist() for i in WORDS.encode(texts)] == [plain(t) for t in texts]


def test_slices_change_nothing(monkeypatch):
    monkeypatch.setattr(bpe, "SLICE_CHARS", 3)
    monkeypatch.setattr(bpe, "CHUNK_CHARS", 11)
    texts = ["it's  we'll 12ab!?ñ\n\n x '' 's's 3.14,15 \t\t y", "   \n  a", *ODD]
    assert [i.tolist() for i in WORDS.encode(texts)] == [plain(t) for t in texts]


def test_merged_words_are_remembered_within_bounds(monkeypatch):
    monkeypatch.setattr(bpe, "MERGED", 2)
    words = bpe.Vocabulary(WORDS.ranks, public_tokenizers.PATTERN)
    text = "qzxv wvkq xxqz qzxv zzvq"
    for _ in range(3):
        assert next(iter(words.encode([text]))).tolist() == plain(text)
    next(iter(words.encode(["plain"])))
    assert not words.merged  # beyond the bound they go before the next chunk


def test_perfect_hash():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 5000):
        keys = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        made = bpe.PerfectHash(keys)
        assert sorted(made.slots(keys).tolist()) == list(range(len(keys)))
        assert (made.slots(rng.integers(0, 1 << 63, 100, dtype=np.uint64)) < max(len(keys), 1)).all()
    with pytest.raises(ValueError):
        bpe.PerfectHash(np.array([7, 7], dtype=np.uint64))


def test_what_is_no_token_is_merged():
    """Spans with the bytes of a token and more, and single bytes, whatever their slot says."""
    data = np.frombuffer(b"the thex \xff\xfe", dtype=np.uint8)
    spans = [(0, 3), (4, 8), (3, 7), (9, 10), (10, 11)]
    slots = WORDS._known(data, np.array([a for a, _ in spans]), np.array([b for _, b in spans]))
    found = [int(WORDS.ids[s]) if s >= 0 else None for s in slots]
    assert found == [WORDS.ranks.get(bytes(data[a:b])) for a, b in spans]


def expected(text):
    ids = plain(text)
    raw = (text or "").encode()
    return len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(raw).hexdigest()


def test_rows(spark, monkeypatch):
    rows = [(k, t, "x", 1.0, "y") for k, t in enumerate(ODD)] + [(None, "null id", None, None, None), (1, "again", "", 0.0, ""), (1, "again", "", 0.0, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, score double, decoded string")
    encoded = bpe.encode(docs)
    got = sorted(((r.doc_id, *tuple(r)[1:]) for r in bpe.digests(encoded).collect()), key=str)
    assert got == sorted(((r[0], *expected(r[1])) for r in rows), key=str)
    assert sorted(bytes(r.decoded) for r in bpe.decode(encoded).collect()) == sorted((r[1] or "").encode() for r in rows)
    assert bpe.digests(bpe.encode(docs.limit(0))).count() == 0


def test_registered_query(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op13_byte_bpe"](spark, folder).collect()}
    assert got == {k: expected(t) for k, t in texts.items()}
    with open(public_tokenizers.path(bpe.DEFAULT_FILE), "rb") as lines:
        assert len(WORDS.ranks) == sum(1 for line in lines if base64.b64decode(line.split()[0]))

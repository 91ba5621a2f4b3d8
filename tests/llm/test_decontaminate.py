"""Matches against a brute-force version: every window of every document with every item."""

import random
from collections import Counter

import pytest

from sluice.llm import decontaminate


def grams(words):
    return Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else Counter()


def best(text, item):
    words, wanted = (text or "").lower().split(), (item or "").lower().split()
    n, top = min(len(words), len(wanted)), (0.0, 0)
    for start in range(len(words) - n + 1 if n else 0):
        a, b = grams(words[start : start + n]), grams(wanted)
        top = max(top, ((a & b).total() / max(1, (a | b).total()), -start))
    return top[0], -top[1], n


def check(spark, docs, items):
    got = {
        (r.doc_id, r.item_id): (pytest.approx(r.similarity), r.first_word, r.n_words)
        for r in decontaminate.matches(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    }
    every = {(d, i): best(text, item) for d, text in docs for i, item in items}
    assert got == {k: v for k, v in every.items() if v[0] >= 0.75}
    return got


def test_long_item_with_a_repeated_shingle(spark):
    """620 words of 700 are the item's; the rest is one word again and again, which outweighs each fingerprint bit."""
    shared = [f"w{i}" for i in range(620)]
    item = " ".join(shared + [f"d{i}" for i in range(80)])
    docs = [(k, " ".join(shared + [word] * 80)) for k, word in enumerate(["x", "y", "z", "u", "v", "q"])]
    assert len(check(spark, docs, [(1, item)])) == 6


def test_brute_force(spark):
    draw = random.Random(3)
    few, many = [f"a{i}" for i in range(3)], [f"b{i}" for i in range(500)]
    items = [(i, " ".join(draw.choice(few if i % 3 == 0 else many) for _ in range(draw.choice([5, 6, 12, 40])))) for i in range(12)]
    docs = []
    for d in range(60):
        words = draw.choice(items)[1].split() * draw.choice([1, 1, 2])
        for _ in range(draw.choice([0, 1, 1, 2, 3])):  # near the threshold: each change breaks up to five shingles
            words[draw.randrange(len(words))] = draw.choice(few + many)
        around = [draw.choice(few + many) for _ in range(draw.choice([0, 3, 60]))]
        docs.append((d, " ".join(around + words + around)))
    assert len(check(spark, docs, items)) > 20


def test_short_items_are_found_within_texts(spark):
    docs = [(1, "say one two three"), (2, "one two"), (3, "one"), (4, None), (5, "two one"), (6, "x " * 5000 + "ONE Two y " * 3), (7, "")]
    items = [(1, "one two"), (2, "one"), (3, "a b c d"), (4, "say one two three"), (5, None), (6, ""), (1, "one two")]
    got = check(spark, docs, items)
    assert {k for k in got if k[1] == 1} == {(1, 1), (2, 1), (6, 1)} and (1, 4) in got
    assert got[1, 1][1:] == (1, 2) and (2, 1) in got and (6, 2) in got


def test_a_shingle_that_all_items_share(spark):
    """Items with the same beginning, in several index files; rare shingles find them, and no other item is tried."""
    common = " ".join(f"c{i}" for i in range(20))
    items = [(i, f"{common} " + " ".join(f"own{i}x{j}" for j in range(12))) for i in range(40)]
    docs = [(i, f"before {items[i][1]} after") for i in range(0, 40, 7)] + [(100, common + " and else nothing of theirs")]
    assert {k for k in check(spark, docs, items)} == {(i, i) for i in range(0, 40, 7)}


def test_many_index_files(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 300)
    items = [(i, " ".join(f"w{i}y{j}" for j in range(20))) for i in range(12)] + [(None, "null item of five words"), (50, None)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    assert len(decontaminate.write_index(benchmark)[1]) > 3
    with monkeypatch.context() as patch:  # as many files as partitions make one index
        patch.setattr(decontaminate, "BLOCK_CHARS", 1 << 20)
        ((names),) = decontaminate.write_index(benchmark.repartition(7))[1]
        assert len(names) > 3
    docs = [(i, f"x {items[i][1]} y", "own") for i in range(12)] + [(70, "a null item of five words", "own"), (71, "clean", "own")]
    table = spark.createDataFrame(docs, "doc_id long, text string, item_id string")
    found = {(r.doc_id, r.item_id) for r in decontaminate.matches(table, benchmark).collect()}
    assert found == {(i, i) for i in range(12)} | {(70, None)}
    kept = decontaminate.clean(table, benchmark)
    assert kept.columns == table.columns and [tuple(r) for r in kept.collect()] == [(71, "clean", "own")]
    assert decontaminate.clean(table, benchmark.limit(0)).count() == len(docs) and decontaminate.matches(table.limit(0), benchmark).count() == 0

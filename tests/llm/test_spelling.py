"""Near words and forms against brute force, whatever the blocks."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from sluice.llm import spelling
from sluice.llm.queries import QUERIES, SQL
from tests import compare


def near(a, b):
    """One inserted, deleted or replaced character, by trying."""
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    long, short = (a, b) if len(a) > len(b) else (b, a)
    return any(long[:k] + long[k + 1 :] == short for k in range(len(long)))


def pairs_of(counts):
    return sorted((a, n, b, m) for a, n in counts.items() for b, m in counts.items() if near(a, b))


def forms_of(counts, times=10):
    form = {}
    for a, n in counts.items():
        others = sorted((-m, b) for b, m in counts.items() if near(a, b))
        form[a] = (len(others), *((others[0][1], -others[0][0]) if others and -others[0][0] >= times * n else (None, None)))
    rows = []
    for a, n in counts.items():
        root = a
        while form[root][1] is not None:
            root = form[root][1]
        rows.append((a, n, *form[a], root))
    return sorted(rows, key=str)


def words_like(draw, n, letters, least=7, most=11):
    found = {}
    while len(found) < n:
        word = "".join(draw.choice(letters) for _ in range(draw.randint(least, most)))
        found[word] = draw.choice([2, 3, 30, 400, 5000])
        for _ in range(draw.randint(0, 3)):  # and some spelled otherwise
            k, c = draw.randrange(len(word)), draw.choice(letters)
            other = draw.choice([word[:k] + word[k + 1 :], word[:k] + c + word[k:], word[:k] + c + word[k + 1 :], word + c, c + word, word[:-1]])
            if len(other) >= least:
                found[other] = draw.choice([2, 3, 30, 400, 5000])
    return found


@pytest.mark.parametrize(("letters", "n", "block"), [("ab", 120, 20_000), ("ab", 150, 7), ("abcdéß", 300, 40), ("abcdefghijkl", 250, 1)])
def test_near_words(spark, letters, n, block):
    counts = words_like(random.Random(n), n, letters)
    table = spark.createDataFrame([(*w, "x") for w in counts.items()], "word string, n long, half string")
    assert sorted(tuple(r) for r in spelling.near_words(table, block_rows=block).collect()) == pairs_of(counts)
    got = spelling.variants(table, block_rows=block)
    assert sorted((tuple(r) for r in got.collect()), key=str) == forms_of(counts)


def test_a_half_that_most_words_share(spark):
    """Split over blocks of its own; every one is asked."""
    draw = random.Random(8)
    counts = {"constan" + w: n for w, n in words_like(draw, 200, "abc", 3, 7).items()}
    counts |= {w + "ations": n for w, n in words_like(draw, 100, "abc", 4, 6).items()}
    table = spark.createDataFrame(list(counts.items()), "word string, n long")
    blocks = spelling.dealt(table, 50).where("asked = 0").groupBy("block").count().collect()
    assert max(r["count"] for r in blocks) < 200 and any(":constan:" in r.block for r in blocks)
    assert sorted(tuple(r) for r in spelling.near_words(table, block_rows=50).collect()) == pairs_of(counts)


def test_index():
    words = ["banana", "ananas", "a", "bandana", "nab", "x" * 300]
    index = spelling.Index(words)
    text = "".join(w + chr(k) for k, w in enumerate(words))  # delimiters below all letters, in order
    suffixes = sorted(range(len(text)), key=lambda k: (text[k] >= " ", [ord(c) for c in text[k:]]))
    assert index.start.tolist() == suffixes
    of, found = index.search(["banana", "anana", "zanana", "", "y" * 300], np.zeros(5, dtype=np.int64))
    assert sorted(zip(of.tolist(), [words[k] for k in found])) == [(0, "bandana"), (1, "ananas"), (1, "banana"), (2, "banana"), (3, "a")]


def test_path_of_forms(spark):
    counts = {"abcdefghijkl"[: 12 - k]: 10**k + 1 for k in range(5)}
    counts = {w: 2 * 10 ** (k + 1) for k, w in enumerate(counts)}
    got = {r.word: r.root for r in spelling.variants(spark.createDataFrame(list(counts.items()), "word string, n long")).collect()}
    assert set(got.values()) == {"abcdefgh"}


def plain_vocabulary(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c < "\x80" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 2}


def test_vocabulary(spark):
    long = "Überaus " + "y" * 20_000 + " "
    rows = [(1, "Ägypten ÉCOLES école×÷ cafeteria"), (1, "Ägypten ÉCOLES école×÷ cafeteria"), (None, "cafeteria CAFETERIA"), (2, None), (3, ""), (4, long * 3)]
    rows += [(10 + k, " ".join(f"Lettering{chr(97 + j)} abstract_fortune" for j in range(9))) for k in range(60)]
    docs = spark.createDataFrame([(*r, "x", 7) for r in rows], "doc_id long, text string, word string, n int")
    want = plain_vocabulary(rows)
    assert {r.word: r.n for r in spelling.vocabulary(docs).collect()} == want and len(want) > 15
    got = sorted((tuple(r) for r in spelling.variants(spelling.vocabulary(docs)).collect()), key=str)
    assert got == forms_of(want)
    assert spelling.variants(spelling.vocabulary(docs.limit(0))).count() == 0


def test_registered_query(spark):
    folder = "/root/testdata/sf0.001"
    assert compare.spark_rows(QUERIES["op11_spelling_variants"](spark, folder)) == compare.duck_rows(compare.duck(folder), SQL["op11_spelling_variants"])

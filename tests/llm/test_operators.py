"""Small tables with nulls, empty and long texts, ties, repeated rows and clashing columns."""

import hashlib
import io
import zlib

import numpy as np
import pytest

from sluice.llm import chat, codes, decontaminate, fingerprints, html, labels, minmax, packing, quality, toxicity, warc
from sluice.llm.queries import QUERIES

WORDS = [f"word{i}" for i in range(40)]
BODY = " ".join(WORDS)
ROWS = [
    (1, BODY, "x"), (2, BODY, "x"), (2, BODY, "x"), (3, BODY + " tail", "x"), (4, None, None), (5, "", "x"),
    (6, "one two", "x"), (7, "é " * 3000, "x"), (None, BODY, "x"), (8, "you idiot are a moron", "x"),
]
SCHEMA = "doc_id long, text string, bucket_no string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def test_link_classes(docs):
    got = sorted((r.doc_id or -1, r.n_shingles, r.component_id, r.kept) for r in minmax.link_classes(docs).collect())
    found = {(d, c, k) for d, _, c, k in got}
    assert len(got) == len(ROWS)
    assert {(1, 1, True), (2, 1, False), (3, 1, False), (4, 4, True), (5, 5, True), (6, 6, True), (-1, None, True)} <= found
    assert minmax.link_classes(docs.limit(0)).count() == 0
    kept = minmax.deduplicate(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id or -1 for r in kept.collect()) == [-1, 1, 4, 5, 6, 7, 8]


def test_packing(docs):
    rows = packing.pack(docs).collect()
    assert sum(r.length for r in rows) == sum(r.doc_tokens for r in rows if r.start == 0)
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
        assert len(r.ids) == 4 * r.length
    for parts in by.values():
        assert [o for o, _ in sorted(parts)] == [0, *np.cumsum([n for _, n in sorted(parts)])[:-1]]
        assert sum(n for _, n in parts) <= packing.CAPACITY
    assert packing.pack(docs.limit(0)).count() == 0
    assert sorted(i for w in packing.windows([5, 5, 5, 3, 3, 3], 8) for i in w) == list(range(6))
    assert packing.windows([8, 8], 8) == [[0], [1]] or packing.windows([8, 8], 8) == [[1], [0]]


def test_codes(docs):
    ids = np.array([0, 255, 256, 65535, 65536, 2**32 - 1, 7] * 300, dtype=np.uint32)
    segment = codes.Segment(codes.encode(ids, np.array([3, len(ids)]), np.array([1, 2])))
    assert [segment[i] for i in range(len(ids))] == ids.tolist()
    assert segment.read(100, 1999).tolist() == ids[100:1999].tolist()
    rows = codes.read(*codes.write(docs)).orderBy("start").collect()
    assert [r.doc_id for r in rows] == [None, 1, 2, 2, 3, 4, 5, 6, 7, 8]
    assert rows[5].n_tokens == 1 and rows[5].ids_crc32 == zlib.crc32(b"\2\0\0\0")
    assert codes.read(*codes.write(docs.limit(0))).count() == 0


def test_fingerprints(docs):
    ranks = fingerprints.entropy_ranks(docs)
    rows = fingerprints.compare_edits(fingerprints.with_next(docs), ranks).collect()
    assert len(rows) == len(ROWS)
    texts = {}
    for r in rows:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        texts.setdefault(r.n_chars, set()).add(r.fingerprint)
    assert all(len(v) == 1 for n, v in texts.items() if n == len(BODY))
    assert fingerprints.edited("abcdefgh", "X") == "abcdefX"
    assert fingerprints.with_next(docs.limit(0)).count() == 0


def test_decontamination(spark, docs):
    bench = spark.createDataFrame([(1, " ".join(WORDS[5:30])), (2, None), (3, "one two"), (4, "no such words at all here")], "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontaminate.matches(docs, bench).collect()}
    assert found == {(1, 1), (2, 1), (3, 1), (None, 1), (6, 3)}
    assert sorted(r.doc_id for r in decontaminate.clean(docs, bench).collect()) == [4, 5, 7, 8]
    assert decontaminate.matches(docs, bench.limit(0)).count() == 0


def test_classifiers(spark, docs):
    # an insult beside ever other words: what stands in copies of one passage is not learned
    name = "translate(CAST(id * 7919 AS STRING), '0123456789', 'abcdefghij')"
    many = spark.range(400).selectExpr(
        "id AS doc_id",
        f"CASE WHEN id % 4 = 0 THEN concat('plain ', {name}, ' stupid ', reverse({name}), ' more') ELSE concat('a plain text ', {name}, ' of words.') END AS text",
    )
    marks = many.selectExpr("doc_id", "CAST(doc_id % 4 <> 0 AS INT) AS quality", "CAST(doc_id % 4 = 0 AS INT) AS toxic")
    for module, label in ((toxicity, "toxic"), (quality, "quality")):
        model = module.fit(many, marks)
        rows = module.scored(many.withColumn("held", labels.held_out(many.doc_id)), model).where("held").join(marks, "doc_id").collect()
        assert np.mean([(r.score >= 0.5) == r[label] for r in rows]) > 0.95
        assert all(0 <= r.score <= 1 for r in module.scored(docs, model).collect())
        assert module.scored(docs, module.fit(docs.limit(0), marks.limit(0))).count() == len(ROWS)


def test_grammar():
    lexicon = toxicity.Lexicon({"idiot": 3.0, "moro*": 2.0})

    def kinds(text):
        return {(unit, *kind) for kind, units in lexicon.matches(text).items() for unit in units}

    assert kinds("You are an idiot. He said it.") == {("idiot", "insult", True, True, False, False)}
    assert kinds("not an idiot") == {("idiot", "insult", False, False, True, False)}
    assert kinds("she said morons") == {("moro*", "insult", True, True, False, True)}
    assert not kinds("") and not kinds("humoros idiotic")
    # threats: announced by a modal or a future, of a target before or after, negated, reported
    assert kinds("i will kill you") == {("kill", "threat", True, True, False, False)}
    assert kinds("the frost may kill plants") == {("kill", "threat", False, False, False, False)}
    assert kinds("we will never hurt them") == {("hurt", "threat", True, True, True, False)}
    assert kinds("he wrote they would destroy it") == {("destroy", "threat", True, True, False, True)}
    # a unit counts once for each kind of clause
    assert kinds("an idiot! you are an idiot; you are an idiot") == {("idiot", "insult", False, False, False, False), ("idiot", "insult", True, True, False, False)}
    assert sum(lexicon.features("an idiot; an idiot")) == 3.0 and sum(lexicon.features("morons kill")) == 2.0 + toxicity.THREAT_WEIGHT


def test_composed_machine_equals_the_five():
    """Every state of the composition says what the machines say one by one."""
    import random

    draw = random.Random(6)
    machines = (toxicity.TARGETED, toxicity.NEGATED, toxicity.REPORTED, toxicity.INSULTING, toxicity.THREATENING)
    for _ in range(300):
        one, five = 0, [0] * 5
        for _ in range(12):
            word = draw.randrange(len(toxicity.CLASSES))
            one, five = toxicity.GRAMMAR.table[one][word], [m.table[s][word] for m, s in zip(machines, five)]
            assert toxicity.GRAMMAR.says[one] == tuple(x for m, s in zip(machines, five) for x in m.says[s])


def plain_kind(words, k, lexicon):
    """The kind of the match at a word, by looking at the clause around it."""
    kinds = [toxicity.CLASSES[lexicon.kind(w)] for w in words]
    insult = kinds[k] == "insult"
    near = kinds[max(0, k - toxicity.SAID_WORDS) : k]
    return (
        kinds[k], any(c in (("copula", "target") if insult else ("modal",)) for c in near), "target" in kinds[:k] + kinds[k + 1 :],
        "negation" in kinds[max(0, k - toxicity.NEGATED_WORDS) : k], "report" in kinds[:k],
    )


def test_op6_query(spark):
    """Scores from clauses by hand with the fitted lexicon and weights; precision and recall on held-out rows."""
    import math
    import re

    folder = "/root/testdata/sf0.01"
    docs, marks = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    grammar = toxicity.fit(docs, marks)
    lexicon, factors = grammar.lexicon, dict(zip(toxicity.KINDS, grammar.weights))
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    toxic = {r.doc_id: r.toxic for r in marks.collect()}
    rows = QUERIES["op6_toxicity_grammar"](spark, folder).collect()
    assert len(rows) == len(texts)
    hits = {True: 0, False: 0}
    for r in rows:
        met = set()
        for clause in re.split(r"[.!?;\n]", texts[r.doc_id].lower()):
            words = toxicity.WORD.findall(clause)
            for k, word in enumerate(words):
                if lexicon.kind(word) in (1, 2):
                    met.add((lexicon.unit(word) or word, plain_kind(words, k, lexicon)))
        z = grammar.intercept + sum(lexicon.units.get(u, toxicity.THREAT_WEIGHT) * factors[kind] for u, kind in met)
        assert r.score == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-9)
        if r.held_out and r.doc_id in toxic:
            assert not (r.predicted and not toxic[r.doc_id])
            hits[bool(r.predicted)] += toxic[r.doc_id]
    assert hits[True] >= hits[False]


def test_chat(spark):
    odd = "\\### Assistant: </turn> ok <turn:x>\n\\"
    turns = [("us>er\\\n", odd), ("assistant", odd), ("assistant", "")]
    whole, spans = chat.format_turns(turns)
    assert chat.parse_turns(whole) == turns
    assert "".join(chat.unescape(whole[a : a + n]) for a, n in spans) == odd
    nodes = [("t", 1, None, "user", "q", 0.0), ("t", 2, 1, "assistant", "bad", 0.1), ("t", 3, 1, "assistant", None, 0.9), (None, 1, None, None, "x", None)]
    rows = chat.format_best(spark.createDataFrame(nodes + nodes[:1], "tree_id string, node_id int, parent_id int, role string, text string, score double")).collect()
    assert {r.tree_id: chat.parse_turns(r.formatted) for r in rows} == {"t": [("user", "q"), ("assistant", "")], None: [("", "x")]}


def test_chat_paths(spark):
    """A chain of 21 turns beside short trees and a forked one; rows that reply in a circle have no root."""
    chain = [("long", n, n - 1 if n else None, "user", f"t{n}", 1.0) for n in range(21)]
    fork = [("fork", 0, None, "user", "q", 0.0), ("fork", 1, 0, "assistant", "a", 0.2), ("fork", 2, 0, "assistant", "b", 0.2), ("fork", 3, 2, "user", "c", 0.9)]
    schema = "tree_id string, node_id int, parent_id int, role string, text string, score double"
    rows = chat.format_best(spark.createDataFrame([*chain, *fork, ("lost", 5, 4, "user", "z", None)], schema), top=2).collect()
    texts = {(r.tree_id, r.rank): [t for _, t in chat.parse_turns(r.formatted)] for r in rows}
    assert texts == {
        ("long", 1): [f"t{n}" for n in range(21)], ("fork", 1): ["q", "b", "c"], ("fork", 2): ["q", "a"], ("lost", 1): ["z"],
    }
    assert chat.format_best(spark.createDataFrame([], schema)).count() == 0


def test_chat_of_odd_rows(spark):
    """Long texts, repeated rows, and columns with the operator's own names."""
    schema = "tree_id string, node_id int, parent_id int, role string, text string, score double, row string, node string, path string, formatted string"
    long = "long <turn:x> \\ text " * 20_000
    rows = [("t", 1, None, "user", long, 0.0), ("t", 2, 1, "assistant", long[::-1], 0.5), ("t", 2, 1, "assistant", long[::-1], 0.5)]
    made = chat.format_best(spark.createDataFrame([(*r, "a", "b", "c", "d") for r in rows], schema)).collect()
    (one,) = made
    assert chat.parse_turns(one.formatted) == [("user", long), ("assistant", long[::-1])]


def test_warc_of_odd_rows(spark):
    """A long page, repeated rows, columns with the operator's own names, an empty table."""
    schema = "page_id long, url string, html string, file string, payload string, original long"
    long = "<p>ö long page" * 50_000
    rows = [(2, "u", long), (1, "u", long), (1, "u", long), (5, "", "")]
    pages = spark.createDataFrame([(*r, "x", "y", 7) for r in rows], schema)
    got = sorted((r.page_id, r.record_type, r.refers_to, r.payload_bytes) for r in warc.read(*warc.write(pages)).collect())
    size = len(long.encode())
    assert [g[0] for g in got] == [1, 1, 2, 5] and got[2] == (2, "revisit", 1, size) and {g[3] for g in got[:3]} == {size}
    assert warc.read(*warc.write(pages.limit(0))).count() == 0


def test_html():
    page = "<nav><a href='/'>menu</a></nav><article><h1>T &amp; x</h1><p>one<br>two  <b>three<p>four</article><footer>foot</footer><script>var a='</p>'</script>"
    weights = html.Weights({k: n for k, n in html.count_labels(page * 1).items()})
    assert html.main_text(page, weights) == "T & x\none two three\nfour"
    assert html.main_text(None, weights) == "" and html.main_text("", html.Weights({})) == ""


def test_warc(spark):
    big = "ä" * 60
    pages = [(3, "http://a", big), (1, None, big), (2, "u", "short"), (4, "u", "short"), (5, "u", None), (None, "u", big)]
    rows = warc.read(*warc.write(spark.createDataFrame(pages, "page_id long, url string, html string"))).collect()
    got = {r.page_id: (r.record_type, r.refers_to, r.payload_bytes, r.payload_digest) for r in rows}
    digest = hashlib.sha256(big.encode()).hexdigest()
    assert got[1] == ("response", None, 120, digest) and got[3] == ("revisit", 1, 120, digest) and got[None][:2] == ("revisit", 1)
    assert got[2][0] == got[4][0] == got[5][0] == "response" and got[5][2] == 0
    torn = warc.member(1, "u", b"x", None, False)[:-4]
    with pytest.raises(ValueError):
        list(warc.members(io.BytesIO(torn)))

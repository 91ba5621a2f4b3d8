import pytest
from pyspark.sql import functions as F

from sluice.functions import detect, labels, masking

# text, entities as (type, value), label
TEXTS = [
    ("My name is Ann, SSN is 555-22-1234.", [("SSN", "555-22-1234")], "restricted_pii"),
    ("Notes of the quarterly revenue meeting", [], "internal"),
    ("The depot is at 72 Willow Ave now", [], "internal"),
    ("The patient was diagnosed and takes medication", [("PHI_HINT", "medical_context")], "phi"),
    ("Book a limo for tomorrow", [], "internal"),
    ("A patient with MRN 402138 rests", [("MRN", "unknown"), ("PHI_HINT", "medical_context")], "phi"),
    ("routing number 0210000219", [("ROUTING", "021000021")], "restricted_pii"),
    ("Routing 021000021", [("ROUTING", "021000021")], "restricted_pii"),
    ("passport number is X1234567", [("PASSPORT", "number")], "internal"),
    ("classname", [], "internal"),
    ("123-45-6789 and mrn", [("SSN", "123-45-6789"), ("MRN", "unknown")], "phi"),
    ("passport\rAB12345", [("PASSPORT", "AB12345")], "internal"),
    ("passport\nAB12345", [], "internal"),
    ("ümrn", [], "internal"),
    ("111-22-3333 then 444-55-6666", [("SSN", "111-22-3333")], "restricted_pii"),
    ("x123-45-6789 or 123-45-67890 or _123-45-6789", [], "internal"),
    ("patients and tests positive", [], "internal"),
    ("He tested positive", [("PHI_HINT", "medical_context")], "phi"),
    ("١٢٣-٤٥-٦٧٨٩", [("SSN", "١٢٣-٤٥-٦٧٨٩")], "restricted_pii"),
    ("PAſSPORT abcdef", [("PASSPORT", "abcdef")], "internal"),
    ("", [], "internal"),
    (None, [], "internal"),
]


@pytest.fixture(scope="module")
def scanned(spark):
    rows = [(i, text) for i, (text, _, _) in enumerate(TEXTS)]
    df = spark.createDataFrame(rows, "id int, text string")
    out = detect.with_hits(df).select(
        "id", detect.entities().alias("entities"), labels.label_from_hits().alias("label"),
        labels.label_from_types(labels.entity_types(detect.entities())).alias("again"),
        labels.state_label_from_hits().alias("state"), labels.normalise_label(labels.label_from_hits()).alias("norm"),
    )
    return {r["id"]: r for r in out.collect()}


@pytest.mark.parametrize("i", range(len(TEXTS)))
def test_entities_and_label(scanned, i):
    _, entities, label = TEXTS[i]
    row = scanned[i]
    assert [(e["type"], e["value"]) for e in row["entities"]] == entities
    assert row["label"] == row["again"] == label
    assert row["state"] == row["norm"]


def test_pii_findings_add_a_mentioned_ssn(spark):
    rows = [("User mentioned SSN in the prompt.",), ("classname",), ("plain",), ("ssn 123-45-6789",), ("Patient MRN 1",)]
    out = [r["entities"] for r in detect.detect_pii(spark.createDataFrame(rows, "text string")).collect()]
    assert [[(e["type"], e["score"]) for e in found] for found in out] == [
        [("SSN", 0.9)], [("SSN", 0.9)], [], [("SSN", 0.99)], []
    ]


def test_alternate_detector(spark):
    rows = [("at 72 Willow Ave.",), ("MRN 12",), ("mrn12",), ("MRN: 12",), ("12 elm dr",), ("12 elm drive2",), ("5 High St",)]
    out = detect.detect_alternate(spark.createDataFrame(rows, "text string")).collect()
    assert [[e["type"] for e in r["entities"]] for r in out] == [["ADDRESS"], ["MRN"], ["MRN"], [], ["ADDRESS"], [], ["ADDRESS"]]


def test_injection_phrases_and_output_rules(spark):
    df = spark.createDataFrame([("please CONTACT AS soon; Jailbreak", None), ("diagnose a123-45-67890", True)], "t string, ok boolean")
    rows = df.select(
        detect.injection_phrases(F.col("t")).alias("p"), detect.leaks_ssn(F.col("t")).alias("leak"),
        detect.unapproved_diagnosis(F.col("t"), F.col("ok")).alias("d"),
        detect.unapproved_diagnosis(F.col("t"), F.lit(None).cast("boolean")).alias("d2"),
    ).collect()
    assert rows[0]["p"] == ["jailbreak", "act as"]
    assert (rows[1]["leak"], rows[1]["d"], rows[1]["d2"]) == (True, False, True)


def test_masking_leaves_no_match(spark):
    text = "123-45-6789 111-22-3333,444-55-6666 ROUTING number 021000021; Passport no AB1234567 mrn: 77"
    out = masking.with_masked(spark.createDataFrame([(text,), (None,)], "text string")).collect()
    assert out[0]["masked_text"] == "[SSN] [SSN],[SSN] ROUTING number [ROUTING]; Passport no [PASSPORT] mrn: [MRN]"
    assert out[1]["masked_text"] is None
    again = detect.with_hits(spark.createDataFrame([(out[0]["masked_text"],)], "text string")).collect()[0]
    assert again["hit_ssn"] is None and again["hit_routing"] is None


MASKED = [
    ("passport ABCDEFG", "passport [PASSPORT]"),
    ("Passport number is X1234567, ok", "Passport [PASSPORT] is [PASSPORT], ok"),
    ("passport 123-45-6789 abcdefg", "passport [SSN] [PASSPORT]"),  # two detectors on the same digits
    ("passport AB1234567 then PASSPORT CD7654321", "passport [PASSPORT] then PASSPORT [PASSPORT]"),
    ("mrn 021000021 routing 021000021", "mrn [MRN] routing [ROUTING]"),
    ("MRN::  \u3000 5 and 77 mrn 6", "MRN::  \u3000 [MRN] and 77 mrn [MRN]"),
    ("\U0001f600 é 123-45-6789\n\U0001f600", "\U0001f600 é [SSN]\n\U0001f600"),
    ("passport\nABCDEFG", "passport\nABCDEFG"),
    ("123-45-6789" * 2, "123-45-6789" * 2),
    ("", ""), ("classname - port routing mrn", "classname - port routing mrn"),
    ("x" * 50_000 + " 123-45-6789 " + "y" * 50_000, "x" * 50_000 + " [SSN] " + "y" * 50_000),
    ("111-22-3333 " * 300, "[SSN] " * 300),
]


def test_span_masking(spark):
    rows = [(k, text, "x", 1) for k, (text, _) in enumerate(MASKED)]
    df = spark.createDataFrame(rows, "id int, text string, _spans string, _low int")
    out = masking.with_masked(df)
    assert out.columns == [*df.columns, "masked_text"]
    got = {r["id"]: r for r in out.collect()}
    assert [got[k]["masked_text"] for k in range(len(MASKED))] == [want for _, want in MASKED]
    assert {(r["_spans"], r["_low"]) for r in got.values()} == {("x", 1)}
    assert masking.with_masked(df.limit(0)).count() == 0
    # no value that a detector gives is left, but for the mask's own name
    again = detect.with_hits(out.select("masked_text"), "masked_text").collect()
    assert all(r["hit_ssn"] is None and r["hit_routing"] is None and r["hit_passport"] in (None, "PASSPORT") for r in again)


def test_united_spans(spark):
    spans = [(5, 9, "b"), (0, 3, "a"), (3, 4, "c"), (5, 12, "d"), (11, 13, "e"), (20, 21, "f")]
    df = spark.createDataFrame([(spans,), ([],)], "s array<struct<start:int,end:int,type:string>>").select(masking.united(F.col("s")).alias("s"))
    assert [[tuple(x) for x in r["s"]] for r in df.collect()] == [[(0, 3, "a"), (3, 4, "c"), (5, 13, "d"), (20, 21, "f")], []]


def test_phrase_table(spark):
    """Substrings, not words: overlapping, short, empty, of other planes; every text and phrase pair against ``in``."""
    phrases = ["act as", "jailbreak", "a", "", "é\n", "ignore previous instructions", "aaaaaa", "\U0001f600x", "act as", "ACT AS", None, "aaaa", "zzzzz9"]
    texts = ["Contact asks", "JAILBREAK now", "", None, "cafÉ\nx", "aaaaaaa", "\U0001f600X y", "please Ignore previous instructions" + " and more" * 3000, "a a a", "Contact asks"]
    rows = [(k if k < 9 else 0, t, "x") for k, t in enumerate(texts)] + [(None, "act as", "x")]
    df = spark.createDataFrame(rows, "id int, text string, phrase string")
    table = spark.createDataFrame([(p,) for p in phrases], "phrase string")
    got = sorted(map(tuple, detect.phrase_hits(df, table, "id").collect()), key=str)
    want = {(k, p) for k, t, _ in rows for p in phrases if p is not None and p in (t or "").lower()}
    assert got == sorted(want, key=str)
    assert detect.phrase_hits(df, table.limit(0), "id").count() == 0 and detect.phrase_hits(df.limit(0), table, "id").count() == 0


def test_many_phrases_make_no_pairs(spark):
    phrases = spark.range(100_000).select(F.concat(F.lit("phrase "), F.md5(F.col("id").cast("string").cast("binary"))).alias("phrase"))
    texts = spark.range(400).select("id", F.concat(F.lit("so PHRASE "), F.upper(F.md5((F.col("id") * 3).cast("string").cast("binary"))), F.lit("!")).alias("text"))
    hits = detect.phrase_hits(texts, phrases, "id")
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert hits.count() == 400


def test_patterns_run_once_per_row(spark):
    df = detect.detect_entities(spark.createDataFrame([(1, "a")], "id int, text string"))
    plan = detect.explode_entities(df, "id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("{3}-") == 1


def test_adding_an_entity_never_lowers_the_label(spark):
    order = {"internal": 0, "restricted_pii": 1, "phi": 2}
    kinds = ["SSN", "routing", "PASSPORT", "MRN", "phi_hint", "ACCOUNT", "OTHER"]
    rows = [(a, b) for a in kinds for b in kinds]
    df = spark.createDataFrame(rows, "a string, b string").select(
        labels.label_from_types(F.array("a")).alias("one"), labels.label_from_types(F.array("a", "b")).alias("two")
    )
    assert all(order[r["two"]] >= order[r["one"]] for r in df.collect())

import pytest
from pyspark.sql import functions as F

from sluice.functions import decisions as D
from sluice.operators import gateway

SCHEMA = "direction string, role string, types array<string>, label string, ok boolean, why string"
CASES = [
    (("ingress", "member", ["MRN"], "RESTRICTED_PHI", True, ""), "block"),
    (("ingress", "member", ["SSN"], "RESTRICTED_PII", True, ""), "block"),
    (("egress", "member", ["EMAIL_ADDRESS"], "RESTRICTED_PII", True, ""), "mask"),
    (("ingress", "anonymous", [], "INTERNAL", True, ""), "allow"),
    (("ingress", "admin", [], "PUBLIC", False, "restricted PHI"), "block"),
    (("ingress", "professional", ["SSN"], "RESTRICTED_PII", True, ""), "block"),
    (("ingress", "professional", ["EMAIL_ADDRESS"], "INTERNAL", True, ""), "allow"),
    (("ingress", "admin", ["SSN"], "RESTRICTED_PII", True, ""), "allow"),
    (("egress", "admin", [], "CONFIDENTIAL", True, ""), "mask"),
    (("egress", "member", ["IP_ADDRESS"], "INTERNAL", True, ""), "allow"),
    (("ingress", None, ["SSN"], "RESTRICTED_PII", True, ""), "block"),
    (("ingress", "member", None, None, None, None), "allow"),
    (("ingress", "member", ["DOB", "PASSPORT", "SSN"], "INTERNAL", None, None), "block"),
]


def test_runtime_chain(spark):
    df = spark.createDataFrame([c[0] for c in CASES], SCHEMA)
    out = df.select(D.runtime_decision(*[F.col(c) for c in df.columns]).alias("d")).collect()
    assert [r["d"]["action"] for r in out] == [action for _, action in CASES]
    assert out[-1]["d"]["reason"] == "high-risk PII (PASSPORT) blocked for role member"
    assert out[10]["d"]["reason"] == "high-risk PII (SSN) blocked for role unknown"
    assert out[4]["d"]["reason"] == "data movement denied: restricted PHI"


@pytest.mark.parametrize("role,ssn,action", [("analyst", False, "allow"), ("analyst", True, "block"), ("dlp-admin", True, "mask"), ("admin", True, "block")])
def test_role_action(spark, role, ssn, action):
    assert spark.range(1).select(D.role_action(F.lit(role), F.lit(ssn))).first()[0] == action


def test_requests(spark):
    bodies = ['{"user_id":"1","role":"analyst","prompt":"hi"}', '{"prompt":""}', '{"prompt":5}', "{bad", None, "[]", '{"prompt":"x","role":null}']
    out = gateway.parse_requests(spark.createDataFrame([(b,) for b in bodies], "body string")).collect()
    assert [r["status"] for r in out] == [200, 400, 400, 400, 400, 400, 200]
    assert [r["role"] for r in out] == ["analyst"] + ["unknown"] * 6
    assert out[1]["error"] == "Missing 'prompt' in request body"


def test_mask_forwards_the_raw_prompt_and_offers_a_masked_one(spark):
    df = spark.createDataFrame([(1, "SSN 123-45-6789", "dlp-admin"), (2, "SSN 123-45-6789", "x"), (3, "hello", None)], "id int, prompt string, role string")
    a, b, c = gateway.ingress(df, "id").orderBy("id").collect()
    assert (a["action"], a["status"], a["forwarded_prompt"], a["masked_prompt"]) == ("mask", 200, "SSN 123-45-6789", "SSN [SSN]")
    assert (b["action"], b["status"], b["forwarded_prompt"]) == ("block", 400, None)
    assert (c["action"], c["forwarded_prompt"]) == ("allow", "hello")
    assert len({a["decision_id"], b["decision_id"], c["decision_id"]}) == 3


def test_egress_texts(spark):
    df = spark.createDataFrame([(1, "123-45-6789", "dlp-admin"), (2, "123-45-6789", "x"), (3, "ok", "x")], "id int, answer string, role string")
    out = gateway.egress(df, "id").orderBy("id").collect()
    assert [r["safe_answer"] for r in out] == ["[PII REDACTED] 123-45-6789", "Response blocked by DLP policy.", "ok"]


def test_handlers_fail_closed_unless_asked_not_to(spark):
    df = spark.createDataFrame([("routing 123456789", "member"), ("ssn 123-45-6789", "admin"), ("Patient", "member")], "text string, role string")
    safe = [r["decision"]["action"] for r in gateway.handle_ingress(df).collect()]
    raw = [r["decision"]["action"] for r in gateway.handle_ingress(df, normalise=False).collect()]
    assert [(r["decision"]["labels"], [e["type"] for e in r["decision"]["entities"]]) for r in gateway.handle_ingress(df).collect()] == [
        (["RESTRICTED_PII"], ["ROUTING"]), (["RESTRICTED_PII"], ["SSN"]), (["INTERNAL"], [])
    ]
    assert safe == ["block", "block", "allow"] and raw == ["allow", "allow", "allow"]
    assert {r["decision"]["reason"] for r in gateway.handle_egress(df).collect()} == {
        "data movement denied: no matching flow definition in policy"
    }

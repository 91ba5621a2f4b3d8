import json
import random

import pytest
from pyspark.sql import functions as F

from sluice.operators import plan_rules as P
from sluice.sources.plans import plan_resources, read_plans

ABSENT = object()


def resource(kind, after=ABSENT, name="n", address=None):
    change = {} if after is ABSENT else {"after": after}
    return {"type": kind, "name": name, "address": address or f"{kind}.{name}", "change": change}


def rows(spark, plans):
    docs = [(str(i), json.dumps({"resource_changes": items})) for i, items in enumerate(plans)]
    return plan_resources(spark.createDataFrame(docs, "plan_id string, body string"))


def sse(alg):
    return {"rule": [{"apply_server_side_encryption_by_default": {"sse_algorithm": alg}}]}


RULE_CASES = [
    ("iam_user", resource("aws_iam_user", {}), True), ("iam_user", resource("aws_iam_user", None), False),
    ("iam_user", resource("aws_iam_user"), False),
    ("admin_attachment", resource("aws_iam_policy_attachment", {"policy_arn": "x/AdministratorAccess"}), True),
    ("admin_attachment", resource("aws_iam_policy_attachment", {"policy_arn": "x"}), False),
    ("admin_attachment", resource("aws_iam_policy_attachment", {}), False),
    ("wildcard_action", resource("aws_iam_policy", {"policy": '{"Action": "*"}'}), True),
    ("wildcard_action", resource("aws_iam_policy", {"policy": '{"Action":"*"}'}), False),
    ("wildcard_action", resource("aws_iam_policy", {}), False),
    ("console_login", resource("aws_iam_user_login_profile", {}), True),
    ("console_login", resource("aws_iam_user_login_profile", None), False),
    ("sse_algorithm", resource(P.SSE_TYPE, sse("AES256")), True), ("sse_algorithm", resource(P.SSE_TYPE, sse("aws:kms")), False),
    ("sse_algorithm", resource(P.SSE_TYPE, {"rule": [{}]}), False), ("sse_algorithm", resource(P.SSE_TYPE, sse(None)), True),
    ("public_acls", resource("aws_s3_bucket_public_access_block", {"block_public_acls": False}), True),
    ("public_acls", resource("aws_s3_bucket_public_access_block", {"block_public_acls": True}), False),
    ("public_acls", resource("aws_s3_bucket_public_access_block", {}), True),
    ("public_acls", resource("aws_s3_bucket_public_access_block", {"block_public_acls": None}), False),
    ("multi_region_trail", resource("aws_cloudtrail", {"is_multi_region_trail": False}), True),
    ("multi_region_trail", resource("aws_cloudtrail", {"is_multi_region_trail": True}), False),
    ("multi_region_trail", resource("aws_cloudtrail", {}), False),
    ("multi_region_trail", resource("aws_cloudtrail", {"is_multi_region_trail": None}), True),
    ("multi_region_trail", resource("aws_cloudtrail", {"is_multi_region_trail": "true"}), True),
    ("object_lock", resource("aws_s3_bucket_object_lock_configuration", {"object_lock_enabled": "No"}), True),
    ("object_lock", resource("aws_s3_bucket_object_lock_configuration", {"object_lock_enabled": "Enabled"}), False),
    ("object_lock", resource("aws_s3_bucket_object_lock_configuration", {}), False),
    ("versioning_status", resource("aws_s3_bucket_versioning", {"versioning_configuration": {"status": "Off"}}), True),
    ("versioning_status", resource("aws_s3_bucket_versioning", {"versioning_configuration": {"status": "Enabled"}}), False),
    ("versioning_status", resource("aws_s3_bucket_versioning", {"versioning_configuration": {}}), False),
    ("enforce_https", resource("aws_opensearch_domain", {"endpoint_options": [{"enforce_https": True}, {"enforce_https": False}]}), True),
    ("enforce_https", resource("aws_opensearch_domain", {"endpoint_options": [{"enforce_https": True}]}), False),
    ("enforce_https", resource("aws_opensearch_domain", {"endpoint_options": [{}]}), False),
    ("enforce_https", resource("aws_opensearch_domain", {"endpoint_options": [{"enforce_https": None}]}), True),
    ("public_bucket", resource("aws_s3_bucket", {"acl": "public-read"}), True), ("public_bucket", resource("aws_s3_bucket", {}), False),
    ("public_bucket", resource("aws_s3_bucket", {"public_access_block_configuration": {"block_public_acls": False}}), True),
    ("bucket_kms", resource("aws_s3_bucket", {}), True),
    ("bucket_kms", resource("aws_s3_bucket", {"server_side_encryption_configuration": sse("aws:kms")}), False),
    ("function_logging", resource("aws_lambda_function", {"tracing_config": {"mode": ""}}), False),
    ("function_logging", resource("aws_lambda_function", {}), False),
    ("public_api", resource("aws_apigatewayv2_api", {"disable_execute_api_endpoint": False}), True),
    ("public_api", resource("aws_apigatewayv2_api", {"disable_execute_api_endpoint": True}), False),
    ("public_api", resource("aws_apigatewayv2_api", {}), False),
]


@pytest.fixture(scope="module")
def fired(spark):
    found = P.row_findings(rows(spark, [[case[1]] for case in RULE_CASES]), P.CONTROL_RULES + P.BUNDLE_RULES)
    return {(r["plan_id"], r["rule_id"]) for r in found.collect()}


@pytest.mark.parametrize("i", range(len(RULE_CASES)))
def test_rule(fired, i):
    rule, _, expected = RULE_CASES[i]
    assert ((str(i), rule) in fired) == expected


def test_messages_carry_the_control_and_count_once(spark):
    user = resource("aws_iam_user", {})
    out = P.row_findings(rows(spark, [[user, user]]), P.CONTROL_RULES).collect()
    assert [r["message"] for r in out] == ["[A.5.15] Block direct IAM user creation. Use roles/federation. Resource: aws_iam_user.n"]


def test_evidence_buckets_match_brute_force(spark):
    rng = random.Random(3)
    plans = []
    for _ in range(30):
        items = []
        for _ in range(rng.randint(1, 6)):
            name = rng.choice(["evidence", "my_evidence_x", "Evidence2", "logs", "e"])
            items.append(resource("aws_s3_bucket", {}, name, rng.choice([f"aws_s3_bucket.{name}", "b", f"module.m.aws_s3_bucket.{name}"])))
        for _ in range(rng.randint(0, 4)):
            inner = rng.choice([f"module.aws_s3_bucket.{n}" for n in ("evidence", "my_evidence_x", "evidence2")] + ["zz", "b"])
            items.append(resource(P.SSE_TYPE, sse(rng.choice(["aws:kms", "AES256"])), "s", f"{inner}.{P.SSE_TYPE}"))
        plans.append(items)
    expected = set()
    for i, items in enumerate(plans):
        kms = [r["address"] for r in items if r["type"] == P.SSE_TYPE
               and r["change"]["after"]["rule"][0]["apply_server_side_encryption_by_default"]["sse_algorithm"] == "aws:kms"]
        for r in items:
            if r["type"] == "aws_s3_bucket" and "evidence" in r["name"].lower() and not any(r["address"] in k for k in kms):
                expected.add((str(i), r["address"]))
    out = P.evidence_bucket_findings(rows(spark, plans)).collect()
    assert {(r["plan_id"], r["message"].split("Resource: ")[1]) for r in out} == expected and len(out) == len(expected)


def test_no_finding_without_an_address(spark):
    plan = [resource("aws_iam_user", {}), resource("aws_s3_bucket", {}, "evidence")]
    for item in plan:
        del item["address"]
    assert P.plan_denials(rows(spark, [plan])).count() == 0


def test_plain_addresses_are_never_covered(spark):
    plan = [resource("aws_s3_bucket", {}, "evidence"), resource(P.SSE_TYPE, sse("aws:kms"), "evidence")]
    assert P.evidence_bucket_findings(rows(spark, [plan])).count() == 1


def test_verdicts(spark):
    df = rows(spark, [[resource("aws_iam_user", {})], [resource("aws_cloudtrail", {})]])
    out = {r["plan_id"]: r["allow"] for r in P.plan_verdicts(df, P.plan_denials(df)).collect()}
    assert out == {"0": False, "1": True}


CHECK_CASES = [
    ("CKV_DLP_001", "aws_s3_bucket", {"bucket": "x"}, "PASSED"), ("CKV_DLP_001", "aws_s3_bucket", {"bucket": "my-evidence"}, "FAILED"),
    ("CKV_DLP_001", "aws_s3_bucket", {"bucket": ["dlp-evidence"], "server_side_encryption_configuration": [
        {"rule": [{}, {"apply_server_side_encryption_by_default": [{"sse_algorithm": ["aws:kms"]}]}]}]}, "PASSED"),
    ("CKV_DLP_002", "aws_s3_bucket", {"bucket": "evidence", "versioning": [{"enabled": [True]}]}, "PASSED"),
    ("CKV_DLP_002", "aws_s3_bucket", {"bucket": "evidence", "versioning": [{"enabled": False}]}, "FAILED"),
    ("CKV_DLP_002", "aws_s3_bucket", {"bucket": "evidence"}, "FAILED"),
    ("CKV_DLP_003", "aws_s3_bucket_public_access_block", {k: True for k in ("block_public_acls", "ignore_public_acls", "block_public_policy", "restrict_public_buckets")}, "PASSED"),
    ("CKV_DLP_003", "aws_s3_bucket_public_access_block", {"block_public_acls": [True]}, "FAILED"),
    ("CKV_DLP_004", "aws_lambda_function", {"function_name": "dlp-a"}, "FAILED"), ("CKV_DLP_004", "aws_lambda_function", {}, "PASSED"),
    ("CKV_DLP_004", "aws_lambda_function", {"function_name": "dlp-a", "environment": [{"variables": {"OPA_POLICY_PATH": "", "FLOWS_JSON_PATH": ""}}]}, "PASSED"),
    ("CKV_DLP_005", "aws_apigatewayv2_api", {}, "FAILED"), ("CKV_DLP_005", "aws_apigatewayv2_api", {"disable_execute_api_endpoint": True}, "PASSED"),
]


def test_checks(spark):
    df = rows(spark, [[resource(kind, after)] for _, kind, after, _ in CHECK_CASES])
    out = {(r["plan_id"], r["check_id"]): r["result"] for r in P.plan_checks(df).collect()}
    assert [out[(str(i), case[0])] for i, case in enumerate(CHECK_CASES)] == [case[3] for case in CHECK_CASES]


def test_artifact_check(spark):
    required = spark.createDataFrame([("a",), ("b",)], "path string")
    df = rows(spark, [[resource("aws_lambda_function", {})]])
    for held, result in (["a", "b"], "PASSED"), (["a"], "FAILED"):
        inventory = spark.createDataFrame([(h,) for h in held], "path string")
        out = P.plan_checks(df, P.artifacts_complete(required, inventory)).where("check_id = 'CKV_DLP_006'").collect()
        assert [r["result"] for r in out] == [result]


def test_read_plans(spark, tmp_path):
    (tmp_path / "p.json").write_text(json.dumps({"resource_changes": [resource("aws_iam_user", None)]}))
    (tmp_path / "q.json").write_text("not json")
    (tmp_path / "r.txt").write_text("{}")
    out = read_plans(spark, str(tmp_path)).select("plan_id", F.is_variant_null("after").alias("n")).collect()
    assert [(r["plan_id"], r["n"]) for r in out] == [("p.json", True)]


def scans(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("FileScan"), plan.count("SortAggregate"), plan.count("from_json"), plan.count("NestedLoop")


def test_two_scans(spark):
    """One for what the bucket addresses look like, one for everything else."""
    from sluice.plans import all_queries

    for name in ("plan_denies", "plan_allow"):
        assert scans(all_queries()[name].run(spark, "/root/testdata/sf0.001")) == (2, 0, 0, 0)


def test_verdicts_in_one_pass_equal_those_in_two(spark):
    plans = [
        ("p1", "aws_iam_user", "u", "a.u", "{}"), ("p2", "aws_iam_user", "u", "a.u", None), ("p3", "other", "x", "o.x", "{}"), (None, "other", "x", None, None),
        ("p1", P.BUCKET_TYPE, "Evidence", "b.e", "{}"), ("p1", P.SSE_TYPE, "s", "x/b.e/y", None),
        ("p4", P.BUCKET_TYPE, "evidence", "b.e", "{}"), ("p4", P.SSE_TYPE, "s", "x/b.e/y", '{"rule":[{"apply_server_side_encryption_by_default":{"sse_algorithm":"aws:kms"}}]}'),
    ]
    df = spark.createDataFrame(plans, "plan_id string, type string, name string, address string, t string").withColumn("after", F.try_parse_json("t")).drop("t")
    one = {(r.plan_id, r.n_findings, r.allow) for r in P.plan_verdicts(df).collect()}
    assert one == {(r.plan_id, r.n_findings, r.allow) for r in P.plan_verdicts(df, P.plan_denials(df)).collect()}
    assert one == {("p1", 2, False), ("p2", 0, True), ("p3", 0, True), (None, 0, True), ("p4", 0, True)}

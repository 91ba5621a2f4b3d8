"""Cloud-plan queries. Plan documents are spun from line items, one resource each."""

from __future__ import annotations

from pyspark.sql import functions as F

from sluice.operators import plan_rules as P
from sluice.plans.registry import query, table
from sluice.sources.plans import plan_resources

# (resource type, planned values or None where the plan does not state them)
TEMPLATES = [
    ("aws_iam_user", '{"name":"bob"}'), ("aws_iam_user", "null"), ("aws_iam_user", None),
    ("aws_iam_policy_attachment", '{"policy_arn":"arn:aws:iam::aws:policy/AdministratorAccess"}'),
    ("aws_iam_policy_attachment", '{"policy_arn":"arn:aws:iam::aws:policy/ReadOnly"}'),
    ("aws_iam_policy_attachment", "{}"),
    ("aws_iam_policy", '{"policy":"{\\"Action\\": \\"*\\"}"}'), ("aws_iam_policy", '{"policy":"{\\"Action\\":\\"*\\"}"}'),
    ("aws_iam_user_login_profile", "{}"), ("aws_iam_user_login_profile", "null"),
    ("SSE", '{"rule":[{"apply_server_side_encryption_by_default":{"sse_algorithm":"AES256"}}]}'),
    ("SSE", '{"rule":[{"apply_server_side_encryption_by_default":{"sse_algorithm":"aws:kms"}}]}'),
    ("SSE", '{"rule":[{"x":1},{"apply_server_side_encryption_by_default":{"sse_algorithm":null}}]}'),
    ("SSE", '{"rule":[]}'),
    ("aws_s3_bucket_public_access_block", '{"block_public_acls":false}'),
    ("aws_s3_bucket_public_access_block",
     '{"block_public_acls":true,"ignore_public_acls":true,"block_public_policy":true,"restrict_public_buckets":true}'),
    ("aws_s3_bucket_public_access_block", '{"block_public_acls":null}'), ("aws_s3_bucket_public_access_block", "{}"),
    ("aws_cloudtrail", '{"is_multi_region_trail":false}'), ("aws_cloudtrail", '{"is_multi_region_trail":true}'),
    ("aws_cloudtrail", '{"is_multi_region_trail":"true"}'), ("aws_cloudtrail", '{"is_multi_region_trail":null}'),
    ("aws_cloudtrail", "{}"),
    ("aws_s3_bucket_object_lock_configuration", '{"object_lock_enabled":"Disabled"}'),
    ("aws_s3_bucket_object_lock_configuration", '{"object_lock_enabled":"Enabled"}'),
    ("aws_s3_bucket_object_lock_configuration", "{}"),
    ("aws_s3_bucket_versioning", '{"versioning_configuration":{"status":"Suspended"}}'),
    ("aws_s3_bucket_versioning", '{"versioning_configuration":{"status":"Enabled"}}'),
    ("aws_opensearch_domain", '{"endpoint_options":[{"enforce_https":true},{"enforce_https":false}]}'),
    ("aws_opensearch_domain", '{"endpoint_options":[{"enforce_https":null}]}'),
    ("aws_opensearch_domain", '{"endpoint_options":[{"port":1}]}'),
    ("aws_s3_bucket", '{"acl":"public-read","bucket":"open-data"}'),
    ("aws_s3_bucket", '{"public_access_block_configuration":{"block_public_acls":false},"bucket":"evidence-a"}'),
    ("aws_s3_bucket",
     '{"server_side_encryption_configuration":{"rule":[{"apply_server_side_encryption_by_default":{"sse_algorithm":"aws:kms"}}]}}'),
    ("aws_s3_bucket",
     '{"bucket":"dlp-evidence","server_side_encryption_configuration":[{"rule":[{"apply_server_side_encryption_by_default":'
     '[{"sse_algorithm":"aws:kms"}]}]}],"versioning":[{"enabled":true}]}'),
    ("aws_s3_bucket", "{}"),
    ("aws_lambda_function", '{"function_name":"dlp-filter","environment":[{"variables":{"OPA_POLICY_PATH":"a","FLOWS_JSON_PATH":"b"}}]}'),
    ("aws_lambda_function", '{"function_name":"dlp-rag","environment":[{"variables":{"OPA_POLICY_PATH":"a"}}]}'),
    ("aws_lambda_function", '{"function_name":"other"}'), ("aws_lambda_function", '{"function_name":"dlp-x"}'),
    ("aws_apigatewayv2_api", '{"disable_execute_api_endpoint":false}'),
    ("aws_apigatewayv2_api", '{"disable_execute_api_endpoint":true}'), ("aws_apigatewayv2_api", "{}"),
]
TEMPLATES = [(P.SSE_TYPE if kind == "SSE" else kind, after) for kind, after in TEMPLATES]
_PICK = f"(l_partkey * 7 + l_orderkey) % {len(TEMPLATES)}"
_NAME = "concat(CASE WHEN l_partkey % 3 = 0 THEN 'Evidence_' ELSE 'data_' END, l_partkey % 40)"


def _sql_text(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def _address(concat_type: str, name: str) -> str:
    return (
        f"CASE WHEN {concat_type} = '{P.SSE_TYPE}' AND l_linenumber % 2 = 0 THEN concat('aws_s3_bucket.', {name}, '/', {concat_type}) "
        f"ELSE concat({concat_type}, '.', {name}) END"
    )


_RESOURCES_SQL = f"""WITH t(pick, type, after) AS (VALUES
    {', '.join(f"({i}, {_sql_text(kind)}, {_sql_text(after)}::JSON)" for i, (kind, after) in enumerate(TEMPLATES))}),
  l AS (SELECT l_suppkey AS plan_id, {_PICK} AS pick, {_NAME} AS name, l_linenumber FROM lineitem),
  r AS (SELECT plan_id, type, name, {_address('type', 'name')} AS address, after FROM l JOIN t USING (pick))"""


def _by_pick(values: list[str | None]):
    return F.get(F.array(*[F.lit(v).cast("string") for v in values]), F.col("pick").cast("int"))


def _shaped(spark, folder):
    picked = table(spark, folder, "lineitem").select(
        F.col("l_suppkey").alias("plan_id"), "l_linenumber", F.expr(_PICK).alias("pick"), F.expr(_NAME).alias("name")
    )
    typed = picked.withColumn("type", _by_pick([kind for kind, _ in TEMPLATES]))
    return typed.withColumn("address", F.expr(_address("type", "name"))).withColumn(
        "planned", _by_pick([after for _, after in TEMPLATES])
    )


def resources(spark, folder):
    """Resource rows as a written resource table would hold them."""
    return _shaped(spark, folder).select("plan_id", "type", "name", "address", F.try_parse_json("planned").alias("after"))


@query(
    "plan_rows",
    f"""{_RESOURCES_SQL} SELECT plan_id, type, name, address, after IS NULL AS unstated, coalesce(after::VARCHAR = 'null', false) AS is_null,
      after ->> '$.bucket' AS bucket FROM r""",
)
def plan_rows(spark, folder):
    change = F.coalesce(F.concat(F.lit('"after":'), "planned"), F.lit(""))
    body = F.concat(
        F.lit('{"resource_changes":[{"type":"'), "type", F.lit('","name":"'), "name", F.lit('","address":"'), "address",
        F.lit('","change":{'), change, F.lit("}}]}"),
    )
    rows = plan_resources(_shaped(spark, folder).select("plan_id", body.alias("body")))
    return rows.select(
        "plan_id", "type", "name", "address", F.col("after").isNull().alias("unstated"),
        F.coalesce(F.is_variant_null("after"), F.lit(False)).alias("is_null"),
        F.try_variant_get("after", "$.bucket", "string").alias("bucket"),
    )


def _sql_rule(rule: P.Rule, test: str) -> str:
    control = f"'{rule.control}'" if rule.control else "NULL::VARCHAR"
    prefix = f"[{rule.control}] " if rule.control else ""
    return (
        f"SELECT plan_id, '{rule.id}' AS rule_id, {control} AS control_ref, '{prefix}{rule.message}' || {rule.subject} AS message "
        f"FROM r WHERE type = '{rule.type}' AND ({test})"
    )


_BY_ID = {rule.id: rule for rule in [*P.CONTROL_RULES, P.EVIDENCE_BUCKET_RULE, *P.BUNDLE_RULES]}
_ALGS = "json_extract(after, '$.rule[*].apply_server_side_encryption_by_default.sse_algorithm')"
_CONTROL_SQL = {
    "iam_user": "after::VARCHAR <> 'null'",
    "admin_attachment": "contains(lower(after ->> '$.policy_arn'), 'administratoraccess')",
    "wildcard_action": "contains(after ->> '$.policy', '\"Action\": \"*\"')",
    "console_login": "after::VARCHAR <> 'null'",
    "sse_algorithm": f"len(list_filter({_ALGS}, lambda a: a::VARCHAR <> '\"aws:kms\"')) > 0",
    "public_acls": "after IS NOT NULL AND coalesce(json_extract(after, '$.block_public_acls')::VARCHAR = 'false', true)",
    "multi_region_trail": "json_extract(after, '$.is_multi_region_trail')::VARCHAR <> 'true'",
    "object_lock": "json_extract(after, '$.object_lock_enabled')::VARCHAR <> '\"Enabled\"'",
    "versioning_status": "json_extract(after, '$.versioning_configuration.status')::VARCHAR <> '\"Enabled\"'",
    "enforce_https": "len(list_filter(json_extract(after, '$.endpoint_options[*].enforce_https'), lambda e: e::VARCHAR <> 'true')) > 0",
    "evidence_bucket_kms": f"""contains(lower(name), 'evidence') AND NOT EXISTS (SELECT 1 FROM r e WHERE e.plan_id = r.plan_id
      AND e.type = '{P.SSE_TYPE}' AND contains(e.address, r.address)
      AND len(list_filter(json_extract(e.after, '$.rule[*].apply_server_side_encryption_by_default.sse_algorithm'),
        lambda a: a::VARCHAR = '\"aws:kms\"')) > 0)""",
}
_DENIED_SQL = "SELECT DISTINCT * FROM (" + " UNION ALL ".join(_sql_rule(_BY_ID[i], t) for i, t in _CONTROL_SQL.items()) + ")"
_BUNDLE_SQL = {
    "public_bucket": "coalesce(after ->> '$.acl' = 'public-read', false) OR coalesce(json_extract(after, '$.public_access_block_configuration.block_public_acls')::VARCHAR = 'false', false)",
    "bucket_kms": """len(list_filter(json_extract(after, '$.server_side_encryption_configuration.rule[*].apply_server_side_encryption_by_default.sse_algorithm'),
      lambda a: a::VARCHAR = '"aws:kms"')) = 0""",
    "public_api": "json_extract(after, '$.disable_execute_api_endpoint')::VARCHAR = 'false'",
}


@query("plan_denies", f"{_RESOURCES_SQL} {_DENIED_SQL}")
def plan_denies(spark, folder):
    return P.plan_denials(resources(spark, folder))


@query(
    "plan_allow",
    f"""{_RESOURCES_SQL}, d AS ({_DENIED_SQL}), n AS (SELECT plan_id, count(*) AS k FROM d GROUP BY 1)
    SELECT DISTINCT r.plan_id, coalesce(k, 0)::BIGINT AS n_findings, coalesce(k, 0) = 0 AS allow FROM r LEFT JOIN n USING (plan_id)""",
)
def plan_allow(spark, folder):
    return P.plan_verdicts(resources(spark, folder))


@query(
    "bundle_denies",
    f"{_RESOURCES_SQL} SELECT DISTINCT * FROM ("
    + " UNION ALL ".join(_sql_rule(_BY_ID[i], t) for i, t in _BUNDLE_SQL.items()) + ")",
)
def bundle_denies(spark, folder):
    return P.bundle_findings(resources(spark, folder))


_BUCKET = "coalesce(after ->> '$.bucket', '')"
_CHECKS_SQL = f"""c AS (
  SELECT plan_id, address, 'CKV_DLP_001' AS check_id, NOT contains({_BUCKET}, 'evidence') OR
    coalesce(after ->> '$.server_side_encryption_configuration[0].rule[0].apply_server_side_encryption_by_default[0].sse_algorithm' = 'aws:kms', false) AS ok
    FROM r WHERE type = 'aws_s3_bucket'
  UNION ALL SELECT plan_id, address, 'CKV_DLP_002', NOT contains({_BUCKET}, 'evidence') OR coalesce(after ->> '$.versioning[0].enabled' = 'true', false)
    FROM r WHERE type = 'aws_s3_bucket'
  UNION ALL SELECT plan_id, address, 'CKV_DLP_003', coalesce(after ->> '$.block_public_acls' = 'true' AND after ->> '$.ignore_public_acls' = 'true'
    AND after ->> '$.block_public_policy' = 'true' AND after ->> '$.restrict_public_buckets' = 'true', false)
    FROM r WHERE type = 'aws_s3_bucket_public_access_block'
  UNION ALL SELECT plan_id, address, 'CKV_DLP_004', NOT contains(coalesce(after ->> '$.function_name', ''), 'dlp') OR
    (json_extract(after, '$.environment[0].variables.OPA_POLICY_PATH') IS NOT NULL AND json_extract(after, '$.environment[0].variables.FLOWS_JSON_PATH') IS NOT NULL)
    FROM r WHERE type = 'aws_lambda_function'
  UNION ALL SELECT plan_id, address, 'CKV_DLP_005', coalesce(after ->> '$.disable_execute_api_endpoint' = 'true', false)
    FROM r WHERE type = 'aws_apigatewayv2_api')"""


@query(
    "plan_checks",
    f"{_RESOURCES_SQL}, {_CHECKS_SQL} SELECT plan_id, address, check_id, CASE WHEN ok THEN 'PASSED' ELSE 'FAILED' END AS result FROM c",
)
def plan_checks(spark, folder):
    return P.plan_checks(resources(spark, folder))


def artifact_paths(spark, folder):
    """Required paths from parts, inventory from the line items shipped in bulk."""
    required = table(spark, folder, "part").select(F.expr("concat('artifact/', p_partkey)").alias("path"))
    held = table(spark, folder, "lineitem").where("l_partkey % 7 <> 0").select(F.expr("concat('artifact/', l_partkey)").alias("path"))
    return required, held


@query(
    "missing_artifacts",
    """SELECT 'artifact/' || p_partkey AS path FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_partkey % 7 <> 0)""",
)
def missing_artifacts(spark, folder):
    return P.missing_artifacts(*artifact_paths(spark, folder))


@query(
    "artifact_check",
    f"""{_RESOURCES_SQL} SELECT plan_id, address, 'CKV_DLP_006' AS check_id, CASE WHEN EXISTS (SELECT 1 FROM part
      WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_partkey % 7 <> 0)) THEN 'FAILED' ELSE 'PASSED' END AS result
    FROM r WHERE type = 'aws_lambda_function'""",
)
def artifact_check(spark, folder):
    ok = P.artifacts_complete(*artifact_paths(spark, folder))
    return P.plan_checks(resources(spark, folder), ok).where("check_id = 'CKV_DLP_006'")

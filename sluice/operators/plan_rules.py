"""Guardrails over cloud-plan resources: one pass over the rows, one array of findings per row.

Input is one row per resource: ``plan_id, type, name, address, after`` with ``after`` a VARIANT.
Values are compared as JSON text, which keeps apart what the rules keep apart: a missing value
(NULL), JSON null, false, and strings that merely look like booleans.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.rows import explode_found
from sluice.plans.fixed_values import REQUIRED_ENV

AFTER = "after"
SSE_TYPE = "aws_s3_bucket_server_side_encryption_configuration"
BUCKET_TYPE = "aws_s3_bucket"
SSE_PATH = "$.apply_server_side_encryption_by_default"


def json_at(value: Column, path: str) -> Column:
    """JSON text at a path: NULL if missing, ``null`` for JSON null, strings in quotes."""
    return F.to_json(F.try_variant_get(value, path, "variant"))


def at(path: str) -> Column:
    return json_at(F.col(AFTER), path)


def text_at(path: str) -> Column:
    """String at a path; NULL if missing or of another kind."""
    return F.when(F.startswith(at(path), F.lit('"')), F.try_variant_get(AFTER, path, "string"))


def items_at(value: Column, path: str) -> Column:
    return F.try_variant_get(value, path, "array<variant>")


def any_item(items: Column, test: Callable[[Column], Column]) -> Column:
    """True if some item passes; false for missing lists and for undefined comparisons."""
    return F.coalesce(F.exists(items, lambda item: F.coalesce(test(item), F.lit(False))), F.lit(False))


def _present() -> Column:
    return F.col(AFTER).isNotNull() & ~F.is_variant_null(AFTER)


@dataclass(frozen=True)
class Rule:
    """A deny rule: resource type, predicate over ``after`` and message in front of the resource."""

    id: str
    type: str
    control: str | None
    test: Callable[[], Column]
    message: str
    subject: str = "address"

    def text(self) -> Column:
        prefix = f"[{self.control}] " if self.control else ""
        return F.concat(F.lit(prefix + self.message), F.col(self.subject))


# Rule order, resource types, control references and message texts.
CONTROL_RULES = [
    Rule("iam_user", "aws_iam_user", "A.5.15", _present,
         "Block direct IAM user creation. Use roles/federation. Resource: "),
    Rule("admin_attachment", "aws_iam_policy_attachment", "A.8.2",
         lambda: F.contains(F.lower(text_at("$.policy_arn")), F.lit("administratoraccess")),
         "Admin policy attachment prohibited. Resource: "),
    Rule("wildcard_action", "aws_iam_policy", "A.5.15",
         lambda: F.contains(text_at("$.policy"), F.lit('"Action": "*"')),
         "Wildcard IAM actions prohibited. Resource: "),
    Rule("console_login", "aws_iam_user_login_profile", "A.5.17", _present,
         "Console login profiles require MFA; disallow in lab. Resource: "),
    Rule("sse_algorithm", SSE_TYPE, "A.8.24",
         lambda: any_item(items_at(F.col(AFTER), "$.rule"),
                          lambda r: json_at(r, f"{SSE_PATH}.sse_algorithm") != '"aws:kms"'),
         "S3 encryption must use aws:kms. Resource: "),
    Rule("public_acls", "aws_s3_bucket_public_access_block", "A.8.15",
         lambda: F.col(AFTER).isNotNull() & F.coalesce(at("$.block_public_acls") == "false", F.lit(True)),
         "S3 must block public ACLs. Resource: "),
    Rule("multi_region_trail", "aws_cloudtrail", "A.8.16",
         lambda: at("$.is_multi_region_trail") != "true", "CloudTrail must be multi-region. Resource: "),
    Rule("object_lock", "aws_s3_bucket_object_lock_configuration", "A.8.32",
         lambda: at("$.object_lock_enabled") != '"Enabled"',
         "Evidence buckets require Object Lock enabled. Resource: "),
    Rule("versioning_status", "aws_s3_bucket_versioning", "A.8.32",
         lambda: at("$.versioning_configuration.status") != '"Enabled"',
         "Evidence buckets must keep versioning enabled. Resource: "),
    Rule("enforce_https", "aws_opensearch_domain", "8.4",
         lambda: any_item(items_at(F.col(AFTER), "$.endpoint_options"), lambda e: json_at(e, "$.enforce_https") != "true"),
         "AI data stores must enforce HTTPS private endpoints. Resource: "),
]
EVIDENCE_BUCKET_RULE = Rule(
    "evidence_bucket_kms", BUCKET_TYPE, "9.1", lambda: F.lit(True),
    "AI evidence/log buckets must be KMS-encrypted. Resource: ",
)
BUNDLE_RULES = [
    Rule("public_bucket", BUCKET_TYPE, None,
         lambda: F.coalesce(at("$.acl") == '"public-read"', F.lit(False))
         | F.coalesce(at("$.public_access_block_configuration.block_public_acls") == "false", F.lit(False)),
         "S3 bucket must not be public: ", "name"),
    Rule("bucket_kms", BUCKET_TYPE, None,
         lambda: ~any_item(items_at(F.col(AFTER), "$.server_side_encryption_configuration.rule"),
                           lambda r: json_at(r, f"{SSE_PATH}.sse_algorithm") == '"aws:kms"'),
         "Evidence/Demo bucket must use SSE-KMS: ", "name"),
    # The logging test of this rule accepts everything, so it never fires.
    Rule("function_logging", "aws_lambda_function", None, lambda: F.lit(False),
         "Lambda must have CloudWatch logging enabled: ", "name"),
    Rule("public_api", "aws_apigatewayv2_api", None,
         lambda: at("$.disable_execute_api_endpoint") == "false",
         "API Gateway must not be public without auth: ", "name"),
]

FINDING = "array<struct<rule_id:string,control_ref:string,message:string>>"
TAGGED = "array<struct<rule_id:string,control_ref:string,text:string,kind:int>>"
# A plan there is; a finding; a bucket's address; text that a KMS configuration's address holds.
PLAN, FOUND, BUCKET, COVERED = -1, 0, 1, 2
BEGINNING = 4


def _by_type(rules: list[Rule], fired: Callable[[Rule], Column]) -> tuple[Column, dict[str, list[Rule]]]:
    """What the rules of a row's type give; a CASE on the type picks them."""
    by_type: dict[str, list[Rule]] = {}
    for rule in rules:
        by_type.setdefault(rule.type, []).append(rule)
    chain = None
    for kind, group in by_type.items():
        found = F.concat(*[fired(r) for r in group]) if len(group) > 1 else fired(group[0])
        chain = F.when(F.col("type") == kind, found) if chain is None else chain.when(F.col("type") == kind, found)
    return chain, by_type


def row_findings(resources: DataFrame, rules: list[Rule]) -> DataFrame:
    """``plan_id, rule_id, control_ref, message`` of the rules that need one row only.

    Findings are a set, as in the rule language: equal messages of a plan count once.
    """
    none = F.array().cast(FINDING)

    def fired(rule: Rule) -> Column:
        row = F.struct(
            F.lit(rule.id).alias("rule_id"), F.lit(rule.control).cast("string").alias("control_ref"),
            rule.text().alias("message"),
        )
        # A message cannot be formed without its subject, and then the rule does not fire.
        return F.when(rule.test() & F.col(rule.subject).isNotNull(), F.array(row)).otherwise(none)

    chain, by_type = _by_type(rules, fired)
    some = resources.where(F.col("type").isin(*by_type))
    listed = explode_found(some, "plan_id", array=chain, alias="_found")
    return listed.select("plan_id", "_found.rule_id", "_found.control_ref", "_found.message").distinct()


def _is_evidence_bucket() -> Column:
    return (F.col("type") == BUCKET_TYPE) & F.contains(F.lower("name"), F.lit("evidence")) & F.col("address").isNotNull()


def _covered_texts(shape: Column) -> Column:
    """The texts within an address that can be a bucket's: they begin as one does and are as long as one is."""
    starts = F.filter(
        F.sequence(F.lit(1), F.length("address")),
        lambda i: F.exists(shape["beginnings"], lambda b: F.substring(F.col("address"), i, F.length(b)) == b),
    )
    return F.flatten(
        F.transform(
            starts,
            lambda i: F.transform(
                F.filter(shape["lengths"], lambda n: i + n - 1 <= F.length("address")), lambda n: F.substring(F.col("address"), i, n)
            ),
        )
    )


def _tagged(resources: DataFrame, plans: bool = False) -> DataFrame:
    """``plan_id, tags``: per resource its findings, its address if it is an evidence bucket, the texts that it covers.

    With ``plans`` every resource also says that there is its plan.

    Containment of addresses becomes equality of texts, so buckets and configurations of a plan are never
    paired up. Which texts a configuration gives is told by one small value, the lengths and the first characters
    of the bucket addresses, from a scan that reads no planned values.
    """
    none = F.array().cast(TAGGED)
    evidence = EVIDENCE_BUCKET_RULE

    def tag(rule: Rule, text: Column, kind: int) -> Column:
        return F.struct(
            F.lit(rule.id).alias("rule_id"), F.lit(rule.control).cast("string").alias("control_ref"), text.alias("text"), F.lit(kind).alias("kind")
        )

    def fired(rule: Rule) -> Column:
        return F.when(rule.test() & F.col(rule.subject).isNotNull(), F.array(tag(rule, rule.text(), FOUND))).otherwise(none)

    shape = resources.where(_is_evidence_bucket()).agg(
        F.struct(
            F.collect_set(F.length("address")).alias("lengths"), F.collect_set(F.substring("address", 1, BEGINNING)).alias("beginnings")
        )
    ).scalar()
    kms = any_item(items_at(F.col(AFTER), "$.rule"), lambda r: json_at(r, f"{SSE_PATH}.sse_algorithm") == '"aws:kms"')
    covers = (F.col("type") == SSE_TYPE) & F.col("address").isNotNull() & kms
    chain, by_type = _by_type(CONTROL_RULES, fired)
    some = resources if plans else resources.where(F.col("type").isin(*by_type, BUCKET_TYPE))
    there = F.struct(F.lit(None).cast("string").alias("rule_id"), F.lit(None).cast("string").alias("control_ref"), F.lit(None).cast("string").alias("text"), F.lit(PLAN).alias("kind"))
    return some.withColumn("_shape", shape).select(
        "plan_id",
        F.concat(
            *([F.array(there)] if plans else []),
            F.coalesce(chain, none),
            F.when(_is_evidence_bucket(), F.array(tag(evidence, F.col("address"), BUCKET))).otherwise(none),
            F.when(covers, F.transform(_covered_texts(F.col("_shape")), lambda t: tag(evidence, t, COVERED))).otherwise(none),
        ).cast(TAGGED).alias("tags"),
    )


def _denials(tagged: DataFrame) -> DataFrame:
    """Findings, and the plans there are, from tagged rows: one grouping by plan and text."""
    rows = explode_found(tagged, "plan_id", array="tags", alias="_t").select("plan_id", "_t.*")
    met = rows.groupBy("plan_id", "rule_id", "control_ref", "text").agg(F.min("kind").alias("kind"), F.max("kind").alias("most"))
    message = F.concat(F.lit(f"[{EVIDENCE_BUCKET_RULE.control}] {EVIDENCE_BUCKET_RULE.message}"), "text")
    return met.where(F.col("most") < COVERED).select(
        "plan_id", "kind", "rule_id", "control_ref", F.when(F.col("kind") == BUCKET, message).otherwise(F.col("text")).alias("message")
    )


def plan_denials(resources: DataFrame) -> DataFrame:
    """All findings of the control rules, per plan: ``plan_id, rule_id, control_ref, message``.

    One pass tags the resources, and one grouping by plan and text makes findings a set and drops the evidence buckets
    whose address a KMS configuration of their plan holds.
    """
    return _denials(_tagged(resources)).drop("kind")


def evidence_bucket_findings(resources: DataFrame) -> DataFrame:
    """Evidence buckets with no KMS configuration in the plan whose address contains theirs."""
    return plan_denials(resources).where(F.col("rule_id") == EVIDENCE_BUCKET_RULE.id)


def plan_verdicts(resources: DataFrame, denials: DataFrame | None = None) -> DataFrame:
    """One row per plan: number of findings, and allowed if there are none.

    Without ``denials`` the control rules are run here, in the same pass that lists the plans.
    """
    if denials is None:
        marked = _denials(_tagged(resources, plans=True)).select("plan_id", (F.col("kind") != PLAN).cast("bigint").alias("_n"))
    else:
        marked = resources.select("plan_id", F.lit(0).cast("bigint").alias("_n")).unionByName(
            denials.select("plan_id", F.lit(1).cast("bigint").alias("_n"))
        )
    counts = marked.groupBy("plan_id").agg(F.sum("_n").alias("n_findings"))
    return counts.withColumn("allow", F.col("n_findings") == 0)


def bundle_findings(resources: DataFrame) -> DataFrame:
    """Findings of the stand-alone guardrail bundle."""
    return row_findings(resources, BUNDLE_RULES)


def scalar_at(path: str) -> Column:
    """JSON text of a value that may come wrapped in a one-item list."""
    return F.coalesce(at(f"{path}[0]"), at(path))


def _flag(path: str) -> Column:
    return F.coalesce(scalar_at(path) == "true", F.lit(False))


def _evidence_named() -> Column:
    return F.contains(F.coalesce(scalar_at("$.bucket"), F.lit("")), F.lit("evidence"))


def _kms_rule(rule: Column) -> Column:
    listed = json_at(rule, "$.apply_server_side_encryption_by_default[0].sse_algorithm[0]")
    plain = json_at(rule, "$.apply_server_side_encryption_by_default[0].sse_algorithm")
    return F.coalesce(listed, plain) == '"aws:kms"'


def _passes_bucket_kms() -> Column:
    rules = items_at(F.col(AFTER), "$.server_side_encryption_configuration[0].rule")
    return ~_evidence_named() | any_item(rules, _kms_rule)


def _passes_versioning() -> Column:
    listed, plain = at("$.versioning[0].enabled[0]"), at("$.versioning[0].enabled")
    return ~_evidence_named() | F.coalesce(F.coalesce(listed, plain) == "true", F.lit(False))


def _passes_public_block() -> Column:
    return _flag("$.block_public_acls") & _flag("$.ignore_public_acls") & _flag("$.block_public_policy") & _flag(
        "$.restrict_public_buckets"
    )


def _passes_env() -> Column:
    named = F.contains(F.coalesce(scalar_at("$.function_name"), F.lit("")), F.lit("dlp"))
    held = F.lit(True)
    for name in REQUIRED_ENV:
        inner = F.coalesce(at(f"$.environment[0].variables[0].{name}"), at(f"$.environment[0].variables.{name}"))
        held = held & inner.isNotNull()
    return ~named | held


# Check ids and the resource types they look at.
CHECKS = [
    ("CKV_DLP_001", BUCKET_TYPE, _passes_bucket_kms),
    ("CKV_DLP_002", BUCKET_TYPE, _passes_versioning),
    ("CKV_DLP_003", "aws_s3_bucket_public_access_block", _passes_public_block),
    ("CKV_DLP_004", "aws_lambda_function", _passes_env),
    ("CKV_DLP_005", "aws_apigatewayv2_api", lambda: _flag("$.disable_execute_api_endpoint")),
]
ARTIFACT_CHECK = ("CKV_DLP_006", "aws_lambda_function")


def plan_checks(resources: DataFrame, artifacts_complete: Column | None = None) -> DataFrame:
    """``check_id, result`` per resource. ``artifacts_complete`` adds the required-artifact check."""
    checks = [(i, kind, build()) for i, kind, build in CHECKS]
    if artifacts_complete is not None:
        checks.append((*ARTIFACT_CHECK, artifacts_complete))
    none = F.array().cast("array<struct<check_id:string,result:string>>")
    chain = None
    for kind in dict.fromkeys(kind for _, kind, _ in checks):
        rows = F.array(
            *[
                F.struct(F.lit(i).alias("check_id"), F.when(ok, "PASSED").otherwise("FAILED").alias("result"))
                for i, of, ok in checks if of == kind
            ]
        )
        test = F.col("type") == kind
        chain = F.when(test, rows) if chain is None else chain.when(test, rows)
    some = resources.where(F.col("type").isin(*{kind for _, kind, _ in checks}))
    listed = explode_found(some, "plan_id", "address", array=chain.otherwise(none), alias="_check")
    return listed.select("plan_id", "address", "_check.check_id", "_check.result")


def missing_artifacts(required: DataFrame, inventory: DataFrame, path: str = "path") -> DataFrame:
    """Required paths that the inventory does not hold."""
    return required.join(inventory.select(path).distinct(), path, "left_anti")


def artifacts_complete(required: DataFrame, inventory: DataFrame, path: str = "path") -> Column:
    """One truth value for the run, as a scalar subquery."""
    return missing_artifacts(required, inventory, path).agg((F.count(F.lit(1)) == 0).alias("ok")).scalar()

"""Control and risk queries. Catalogs are read off the parts table: a part is a control, a line
item links its supplier's policy to it, so the catalogs grow with the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from sluice.operators import evidence as E
from sluice.operators import plan_rules as P
from sluice.plans import fixed_values as V
from sluice.plans.cloud_queries import _CHECKS_SQL, _RESOURCES_SQL, resources
from sluice.plans.registry import query, table

# Parts whose key ends in 7 share the id of the part before; keys ending in 9 have a blank id.
_ID = "CASE WHEN p_partkey % 10 = 7 THEN concat('C-', p_partkey - 1) WHEN p_partkey % 10 = 9 THEN '' ELSE concat('C-', p_partkey) END"


def controls(spark, folder):
    kind = F.col("p_partkey") % 4

    def listed(test, *values):
        return F.when(test, F.array(*values)).otherwise(F.array().cast("array<string>"))

    def numbered(prefix, column="p_size"):
        return F.concat(F.lit(prefix), F.col(column))

    frameworks = F.array(
        F.struct(F.col("p_brand").alias("name"), F.expr("concat('A.', p_size, ', A.', p_size + 1)").alias("ref")),
        F.struct(F.col("p_type").alias("name"), numbered("B.").alias("ref")),
    )
    tools = F.struct(
        listed(kind == 1, F.lit("policy/a"), numbered("policy/")).alias("opa_policies"),
        listed(kind == 2, numbered("CKV_")).alias("checkov_checks"),
        listed(kind >= 2, numbered("artifact/", "p_partkey")).alias("evidence_sources"),
    )
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("ordinal"), F.expr(_ID).alias("id"), F.col("p_name").alias("name"),
        F.col("p_brand").alias("domain"), frameworks.alias("frameworks"), tools.alias("tools"),
    )


def policies(spark, folder):
    return table(spark, folder, "lineitem").where("l_returnflag <> 'R'").select(
        F.expr("concat('P-', l_suppkey)").alias("id"), F.lit("pkg").alias("package"), F.col("l_linestatus").alias("rule"),
        F.array(F.expr("concat(CASE WHEN l_partkey % 6 = 0 THEN 'M-' ELSE 'C-' END, l_partkey)")).alias("unified_controls"),
    )


def checks(spark, folder):
    return table(spark, folder, "lineitem").where("l_returnflag = 'R'").select(
        F.expr("concat('K-', l_suppkey)").alias("check_id"),
        F.array(F.expr("concat('C-', l_partkey)"), F.expr("concat('M-', l_linenumber)")).alias("unified_controls"),
    )


_CURRENT_SQL = f"""raw AS (SELECT p_partkey AS ordinal, {_ID} AS id, p_name AS name, p_brand AS domain, p_type, p_size FROM part),
  cur AS (SELECT * FROM raw WHERE id <> '' QUALIFY row_number() OVER (PARTITION BY id ORDER BY ordinal DESC) = 1),
  own AS (SELECT id AS control_id, 'opa_policies' AS kind, unnest(['policy/a', 'policy/' || p_size]) AS tool_id FROM cur WHERE ordinal % 4 = 1
    UNION ALL SELECT id, 'checkov_checks', 'CKV_' || p_size FROM cur WHERE ordinal % 4 = 2
    UNION ALL SELECT id, 'evidence_sources', 'artifact/' || ordinal FROM cur WHERE ordinal % 4 >= 2),
  links AS (SELECT control_id, kind, tool_id, NULL::VARCHAR AS rule FROM own
    UNION ALL SELECT CASE WHEN l_partkey % 6 = 0 THEN 'M-' ELSE 'C-' END || l_partkey, 'opa_policies', 'P-' || l_suppkey, l_linestatus
      FROM lineitem WHERE l_returnflag <> 'R'
    UNION ALL SELECT unnest(['C-' || l_partkey, 'M-' || l_linenumber]), 'checkov_checks', 'K-' || l_suppkey, NULL
      FROM lineitem WHERE l_returnflag = 'R'),
  idx AS (SELECT coalesce(cur.id, c.control_id) AS id, ordinal, name, domain, coalesce(n1, 0)::BIGINT AS n_opa_policies,
      coalesce(n2, 0)::BIGINT AS n_checkov_checks, coalesce(n3, 0)::BIGINT AS n_evidence_sources, cur.id IS NOT NULL AS in_catalog
    FROM cur FULL OUTER JOIN (SELECT control_id, count(*) FILTER (kind = 'opa_policies') AS n1,
      count(*) FILTER (kind = 'checkov_checks') AS n2, count(*) FILTER (kind = 'evidence_sources') AS n3
      FROM links GROUP BY 1) c ON cur.id = c.control_id)"""


def _index(spark, folder):
    current = E.current_controls(controls(spark, folder))
    links = E.all_links(current, policies(spark, folder), checks(spark, folder))
    return current, links


@query(
    "control_index",
    f"WITH {_CURRENT_SQL} SELECT id, name, domain, n_opa_policies, n_checkov_checks, n_evidence_sources, in_catalog FROM idx",
)
def control_index(spark, folder):
    return E.control_index(*_index(spark, folder)).select(
        "id", "name", "domain", "n_opa_policies", "n_checkov_checks", "n_evidence_sources", "in_catalog"
    )


@query("control_links", f"WITH {_CURRENT_SQL} SELECT control_id, kind, tool_id, rule FROM links")
def control_links(spark, folder):
    return _index(spark, folder)[1].select("control_id", "kind", "tool_id", "rule")


@query(
    "nested_links",
    f"""WITH {_CURRENT_SQL} SELECT control_id, count(*) AS n_links, min(kind || ' ' || tool_id) AS first_link FROM links GROUP BY 1""",
)
def nested_links(spark, folder):
    parts = E.nested_links(_index(spark, folder)[1], 50)
    first = F.array_min(F.transform("links", lambda x: F.concat(x["kind"], F.lit(" "), x["tool_id"])))
    total = F.aggregate("links", F.lit(0).cast("bigint"), lambda n, x: n + x["n"])
    return parts.select("control_id", total.alias("_n"), first.alias("_first")).groupBy("control_id").agg(
        F.sum("_n").alias("n_links"), F.array_min(F.collect_list("_first")).alias("first_link")
    )


@query(
    "dangling_artifacts",
    f"""WITH {_CURRENT_SQL} SELECT control_id, tool_id AS path FROM own
    WHERE kind = 'evidence_sources' AND tool_id NOT IN (SELECT 'artifact/' || l_partkey FROM lineitem WHERE l_partkey % 7 <> 0)""",
)
def dangling_artifacts(spark, folder):
    current = E.current_controls(controls(spark, folder))
    named = E.catalog_links(current).where("kind = 'evidence_sources'")
    held = table(spark, folder, "lineitem").where("l_partkey % 7 <> 0").select(F.expr("concat('artifact/', l_partkey)").alias("path"))
    return E.dangling(named, held)


_EVIDENCE = """CASE p_partkey % 3 WHEN 0 THEN NULL WHEN 1 THEN named_struct('opa_policy', array(), 'checkov_check', array(),
  'terraform_guardrail', '', 'test_case', CAST(NULL AS STRING))
  ELSE named_struct('opa_policy', array(), 'checkov_check', array('K'), 'terraform_guardrail', '', 'test_case', CAST(NULL AS STRING)) END"""
_VALID_SQL = """v AS (SELECT 'C-' || p_partkey AS id, p_brand AS domain, CASE p_partkey % 3 WHEN 0 THEN 'no evidence mapping'
  WHEN 1 THEN 'evidence fields empty' END AS reason FROM part)"""


def _validated(spark, folder):
    rows = table(spark, folder, "part").select(
        F.expr("concat('C-', p_partkey)").alias("id"), F.col("p_brand").alias("domain"), F.expr(_EVIDENCE).alias("evidence")
    )
    return E.validation(rows, F.col("evidence"))


@query("control_validation", f"WITH {_VALID_SQL} SELECT id, reason FROM v WHERE reason IS NOT NULL")
def control_validation(spark, folder):
    return E.missing_evidence(_validated(spark, folder))


@query(
    "tool_validation",
    f"""WITH {_CURRENT_SQL} SELECT id, CASE WHEN ordinal % 4 = 0 THEN 'evidence fields empty' END AS reason FROM cur""",
)
def tool_validation(spark, folder):
    return E.validation(E.current_controls(controls(spark, folder)), F.col("tools"), V.TOOL_KEYS)


@query(
    "coverage",
    f"""WITH {_VALID_SQL} SELECT count(*) AS total_controls, count(reason) AS missing_evidence_count FROM v""",
)
def coverage(spark, folder):
    return E.coverage(_validated(spark, folder))


@query(
    "finding_frameworks",
    f"""{_RESOURCES_SQL}, {_CHECKS_SQL}, fw(check_id, framework, ref) AS (VALUES
      {', '.join(f"('{i}', '{f}', '{r}')" for i, f, r, _ in V.CHECK_FRAMEWORKS)})
    SELECT plan_id, check_id, framework, ref, count(*) AS n FROM c LEFT JOIN fw USING (check_id) WHERE NOT ok GROUP BY ALL""",
)
def finding_frameworks(spark, folder):
    failed = P.plan_checks(resources(spark, folder)).where("result = 'FAILED'")
    counted = failed.groupBy("plan_id", "check_id").agg(F.count(F.lit(1)).alias("n"))
    return E.finding_frameworks(counted, E.framework_table(spark)).select("plan_id", "check_id", "framework", "ref", "n")


@query(
    "framework_counts",
    f"""WITH {_CURRENT_SQL}, f AS (SELECT id, domain AS framework, unnest(['A.' || p_size, 'A.' || (p_size + 1)]) AS ref FROM cur
      UNION ALL SELECT id, p_type, 'B.' || p_size FROM cur)
    SELECT framework, count(DISTINCT id) AS n_controls, count(*) AS n_refs FROM f GROUP BY 1""",
)
def framework_counts(spark, folder):
    return E.framework_counts(E.current_controls(controls(spark, folder)))


def risks(spark, folder):
    """A supplier is a risk: a part of them has no controls, a part no enforcement."""
    return table(spark, folder, "supplier").select(
        F.expr("concat('R-', s_suppkey)").alias("id"),
        F.when(F.col("s_acctbal") < 0, "High").otherwise("Medium").alias("likelihood"), F.lit("High").alias("impact"),
        F.expr("CASE WHEN s_suppkey % 5 = 0 THEN array() ELSE array(concat('C-', s_suppkey), concat('C-', s_suppkey * 30)) END").alias("controls"),
        F.expr("CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE array('ci_job', concat('nation ', s_nationkey)) END").alias("enforced_by"),
    )


_RISKS_SQL = """r AS (SELECT 'R-' || s_suppkey AS id, CASE WHEN s_acctbal < 0 THEN 'High' ELSE 'Medium' END AS likelihood, 'High' AS impact,
  CASE WHEN s_suppkey % 5 = 0 THEN [NULL] ELSE ['C-' || s_suppkey, 'C-' || (s_suppkey * 30)] END AS controls,
  CASE WHEN s_suppkey % 3 = 0 THEN [NULL] ELSE ['ci_job', 'nation ' || s_nationkey] END AS enforced FROM supplier)"""


@query(
    "risk_report",
    f"""WITH {_RISKS_SQL}, c AS (SELECT id, likelihood, impact, unnest(controls) AS control, enforced FROM r)
    SELECT id, likelihood, impact, control, unnest(enforced) AS enforced_by FROM c""",
)
def risk_report(spark, folder):
    return E.risk_report(risks(spark, folder))


@query(
    "uncontrolled_risks",
    f"""WITH {_RISKS_SQL} SELECT id FROM r WHERE NOT EXISTS (SELECT 1 FROM part WHERE list_contains(controls, 'C-' || p_partkey))""",
)
def uncontrolled_risks(spark, folder):
    known = table(spark, folder, "part").select(F.expr("concat('C-', p_partkey)").alias("id"))
    return E.uncontrolled_risks(risks(spark, folder), known)


@query(
    "first_controls",
    f"""WITH {_CURRENT_SQL} SELECT id, name, in_catalog FROM idx ORDER BY ordinal NULLS LAST, id LIMIT 10""",
)
def first_controls(spark, folder):
    return E.first_controls(E.control_index(*_index(spark, folder))).select("id", "name", "in_catalog")

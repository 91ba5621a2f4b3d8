from pyspark.sql import functions as F

from sluice.operators import evidence as E
from sluice.operators import taxonomy
from sluice.plans import fixed_values as V

TOOLS = "tools struct<opa_policies:array<string>,checkov_checks:array<string>,evidence_sources:array<string>>"
CONTROL = f"ordinal bigint, id string, name string, frameworks array<struct<name:string,ref:string>>, {TOOLS}"


def catalog(spark, n=16):
    rows = [(i, f"CTRL-{i:02d}", f"c{i}", [("F1", "a, b"), ("F2", "c")], (["p"], [], ["s1", "s2"])) for i in range(n)]
    extra = [(90, "CTRL-00", "again", [("F1", "a")], None), (91, "", "blank", [], None), (92, None, "none", [], None)]
    return spark.createDataFrame(rows + extra, CONTROL)


def test_fixed_link_sizes(spark):
    policies, checks = E.policy_links(E.fixed_policy_links(spark)), E.check_links(E.fixed_check_links(spark))
    assert (policies.count(), checks.count()) == (20, 16)
    assert policies.unionByName(checks).select("control_id").distinct().count() == 28


def test_index(spark):
    current = E.current_controls(catalog(spark))
    links = E.all_links(current, E.fixed_policy_links(spark), E.fixed_check_links(spark))
    rows = {r["id"]: r for r in E.control_index(current, links).collect()}
    assert len(rows) == 44
    assert rows["CTRL-00"]["name"] == "again" and rows["CTRL-00"]["n_evidence_sources"] == 0
    assert (rows["CTRL-01"]["n_opa_policies"], rows["CTRL-01"]["n_evidence_sources"]) == (1, 2)
    event = rows["ISO27001-A.12.4.1"]
    assert (event["name"], event["n_opa_policies"], event["n_checkov_checks"], event["in_catalog"]) == (None, 1, 4, False)
    first = E.first_controls(E.control_index(current, links)).collect()
    assert [r["id"] for r in first] == [f"CTRL-{i:02d}" for i in range(1, 11)]


def test_nested_links_split_a_hot_control(spark):
    none = F.lit(None).cast("string")
    links = spark.range(900).select(
        F.when(F.col("id") < 600, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 7)).alias("control_id"),
        F.lit("opa_policies").alias("kind"), F.col("id").cast("string").alias("tool_id"),
        none.alias("package"), none.alias("rule"), none.alias("description"),
    )
    rows = E.nested_links(links, 50).collect()
    assert sum(len(r["links"]) for r in rows) == 900
    assert max(len(r["links"]) for r in rows) < 120 and sum(r["control_id"] == "hot" for r in rows) > 6


def test_parts_hold_what_fits(spark):
    """A control with most of the links, one with a link above the bound, repeated links; no part is above the bound."""
    long = "x" * 900
    rows = [("hot", "opa_policies", f"P-{i:05d}", "pkg", "r", None) for i in range(5000)] + [("c1", "checkov_checks", "K", None, None, "d")] * 3
    rows += [("big", "opa_policies", n, None, None, d) for n, d in (("a", "s"), ("b", long), ("c", "s"), ("d", long), ("e", "s"))]
    links = spark.createDataFrame(rows, "control_id string, kind string, tool_id string, package string, rule string, description string")
    size = F.octet_length(F.to_json(F.struct("kind", "tool_id", "package", "rule", "description", "n")))
    out = E.link_parts(links, 600).withColumn("size", size).collect()
    assert sorted((r.control_id, r.tool_id) for r in out) == sorted({(r[0], r[2]) for r in rows})
    parts = {}
    for r in out:
        parts.setdefault((r.control_id, r.part), []).append(r)
    assert all(sum(r["size"] for r in p) <= 600 or len(p) == 1 for p in parts.values())
    hot = sorted(k for c, k in parts if c == "hot")
    assert hot == list(range(len(hot))) and len(hot) < 2 * sum(r["size"] for r in out if r.control_id == "hot") / 600 * 1.5
    assert {r.n for r in out if r.control_id == "c1"} == {3}
    assert len([1 for p in parts.values() if p[0].description == long]) == 2
    # within a stretch the links stand in order
    some = E.link_parts(links.where("tool_id < 'P-00100'"), 600).orderBy("part", "tool_id").where("control_id = 'hot'").collect()
    assert [r.tool_id for r in some] == [f"P-{i:05d}" for i in range(100)]


def test_control_parts(spark):
    current = E.current_controls(catalog(spark, 3))
    links = E.all_links(current, E.fixed_policy_links(spark), E.fixed_check_links(spark))
    rows = E.control_parts(current, links, 150).collect()
    assert {(r.id, r.in_catalog) for r in rows if r.part == 0} >= {("CTRL-00", True), ("CTRL-01", True), ("ISO27001-A.12.4.1", False)}
    assert all(r.name is None for r in rows if r.part or not r.in_catalog) and {r.name for r in rows if r.id == "CTRL-01" and not r.part} == {"c1"}
    event = [r for r in rows if r.id == "ISO27001-A.12.4.1"]
    assert len(event) > 1 and sum(len(r.tools.checkov_checks) for r in event) == 4 and sum(len(r.tools.opa_policies) for r in event) == 1
    assert [len(getattr(r.tools, k)) for r in rows if r.id == "CTRL-00" for k in V.TOOL_KEYS] == [0, 0, 0]
    assert len({(r.id, r.part) for r in rows}) == len(rows)


def test_validation(spark):
    ev = "evidence struct<opa_policy:array<string>,checkov_check:string,terraform_guardrail:string,test_case:string>"
    rows = [("a", None), ("b", ([], "", None, None)), ("c", (["x"], None, None, None)), ("d", ([], "y", None, None)), ("e", (None, None, None, None))]
    out = E.validation(spark.createDataFrame(rows, f"id string, {ev}"), F.col("evidence"))
    assert {r["id"]: r["reason"] for r in out.collect()} == {"a": "no evidence mapping", "b": "evidence fields empty", "c": None, "d": None, "e": "no evidence mapping"}
    assert tuple(E.coverage(out).first()) == (5, 3)


def test_frameworks(spark):
    found = spark.createDataFrame([("CKV_DLP_001",), ("CKV_DLP_003",), ("OTHER",)], "check_id string")
    rows = E.finding_frameworks(found, E.framework_table(spark)).collect()
    assert sorted((r["check_id"], r["framework"]) for r in rows if r["framework"]) == [
        ("CKV_DLP_001", "ISO27001"), ("CKV_DLP_001", "ISO42001"), ("CKV_DLP_001", "OWASP_LLM_TOP10"), ("CKV_DLP_003", "ISO27001")
    ]
    assert [r["check_id"] for r in rows if r["framework"] is None] == ["OTHER"]
    counts = {r["framework"]: (r["n_controls"], r["n_refs"]) for r in E.framework_counts(E.current_controls(catalog(spark))).collect()}
    assert counts == {"F1": (16, 31), "F2": (15, 15)}


def test_risks(spark):
    rows = [("R1", "L", "H", ["C1", "C2"], ["e"]), ("R2", "L", "H", ["X"], None), ("R3", "L", "H", [], ["e"])]
    risks = spark.createDataFrame(rows, "id string, likelihood string, impact string, controls array<string>, enforced_by array<string>")
    out = sorted((r["id"], r["control"] or "", r["enforced_by"] or "") for r in E.risk_report(risks).collect())
    assert out == [("R1", "C1", "e"), ("R1", "C2", "e"), ("R2", "X", ""), ("R3", "", "e")]
    known = spark.createDataFrame([("C2",)], "id string")
    assert sorted(r["id"] for r in E.uncontrolled_risks(risks, known).collect()) == ["R2", "R3"]


def test_taxonomy_labels_with_a_hot_subject(spark):
    rows = [(1, "EMAIL_ADDRESS")] * 300 + [(1, "MRN"), (2, "IP_ADDRESS"), (3, None), (4, "NICKNAME"), (5, "NICKNAME"), (5, "SSN")]
    df = spark.createDataFrame(rows, "id int, entity_type string")
    tax = taxonomy.taxonomy_table(spark, V.CATALOG_TAXONOMY, V.CATALOG_PRIORITY)
    out = {r["id"]: r["label"] for r in taxonomy.label_findings(df, tax, "id", fallback="PUBLIC").collect()}
    assert out == {1: "RESTRICTED_PHI", 2: "CONFIDENTIAL", 3: "INTERNAL", 4: "PUBLIC", 5: "RESTRICTED_PII"}
    flags = taxonomy.with_handling(spark.createDataFrame([("RESTRICTED_PHI",), ("ODD",)], "label string"), V.CATALOG_HANDLING).collect()
    assert tuple(flags[0])[1:] == (False, False, True, True, True) and tuple(flags[1])[1:] == (None,) * 5

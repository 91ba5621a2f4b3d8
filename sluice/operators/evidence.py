"""Control index, coverage and framework reports over control catalogs.

Links are kept in long form, one row per control and tool, because one control may carry most of
them; nested records are built in parts of bounded size only for writing a document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluice.functions.rows import first_by
from sluice.operators.tables import fixed_table
from sluice.plans import fixed_values as V

CONTROL_SCHEMA = (
    "ordinal bigint, id string, name string, description string, domain string, requirement string, "
    "frameworks array<struct<name:string,ref:string>>, "
    "tools struct<opa_policies:array<string>,checkov_checks:array<string>,evidence_sources:array<string>>"
)
PART_BYTES = 1 << 20  # of a control's links in one record of a document
STRETCH = 64  # parts that one task sums up
LINK_COLUMNS = ["control_id", "kind", "tool_id", "package", "rule", "description"]


def fixed_policy_links(spark: SparkSession) -> DataFrame:
    rows = [(i, package, rule, controls) for i, package, rule, controls in V.POLICY_CONTROL_LINKS]
    return fixed_table(spark, rows, "id string, package string, rule string, unified_controls array<string>")


def fixed_check_links(spark: SparkSession) -> DataFrame:
    return fixed_table(spark, V.CHECK_CONTROL_LINKS, "check_id string, unified_controls array<string>")


def policy_links(policies: DataFrame) -> DataFrame:
    """One row per policy and control it covers."""
    return policies.select(
        F.explode("unified_controls").alias("control_id"), F.lit("opa_policies").alias("kind"),
        F.col("id").alias("tool_id"), _optional(policies, "package"), _optional(policies, "rule"),
        _optional(policies, "description"),
    )


def check_links(checks: DataFrame) -> DataFrame:
    """One row per scanner check and control it covers."""
    none = F.lit(None).cast("string")
    return checks.select(
        F.explode("unified_controls").alias("control_id"), F.lit("checkov_checks").alias("kind"),
        F.col("check_id").alias("tool_id"), none.alias("package"), none.alias("rule"),
        _optional(checks, "description"),
    )


def catalog_links(controls: DataFrame) -> DataFrame:
    """Tools a control names itself, in the link columns."""
    none = F.lit(None).cast("string")
    named = F.concat(
        *[
            F.transform(
                F.coalesce(F.col(f"tools.{kind}"), F.array().cast("array<string>")),
                _tagged(kind),
            )
            for kind in V.TOOL_KEYS
        ]
    )
    return controls.select("id", F.explode(named).alias("_t")).select(
        F.col("id").alias("control_id"), "_t.kind", "_t.tool_id",
        none.alias("package"), none.alias("rule"), none.alias("description"),
    )


def _tagged(kind: str):
    return lambda tool: F.struct(F.lit(kind).alias("kind"), tool.alias("tool_id"))


def _optional(df: DataFrame, name: str) -> Column:
    return (F.col(name) if name in df.columns else F.lit(None).cast("string")).alias(name)


def current_controls(controls: DataFrame) -> DataFrame:
    """Catalog without blank ids; of repeated ids the last one stays."""
    rest = [c for c in controls.columns if c != "id"]
    kept = controls.where((F.col("id") != "") & F.col("id").isNotNull())
    return first_by(kept, ["id"], F.col("ordinal").desc_nulls_last(), F.xxhash64(*rest)).select("id", *rest)


def all_links(current: DataFrame, policies: DataFrame, checks: DataFrame) -> DataFrame:
    return catalog_links(current).unionByName(policy_links(policies)).unionByName(check_links(checks))


def control_index(current: DataFrame, links: DataFrame) -> DataFrame:
    """One row per control of the catalog or of a mapping, with the number of links of each kind.

    Ids that only a mapping knows become entries without catalog fields. Links are counted before
    the join, so a much-linked control is one row when it is shuffled.
    """
    counts = links.groupBy("control_id").agg(
        *[F.count_if(F.col("kind") == kind).alias(f"n_{kind}") for kind in V.TOOL_KEYS]
    )
    joined = current.join(counts, current["id"] == counts["control_id"], "full_outer")
    return joined.select(
        F.coalesce("id", "control_id").alias("id"),
        *[c for c in current.columns if c != "id"],
        *[F.coalesce(f"n_{kind}", F.lit(0).cast("bigint")).alias(f"n_{kind}") for kind in V.TOOL_KEYS],
        F.col("id").isNotNull().alias("in_catalog"),
    )


def nested_links(links: DataFrame, max_links: int = 1000) -> DataFrame:
    """Links as arrays for writing documents: ``control_id, part, links``.

    Equal links are counted first and carry their number ``n``; what is left differs, so a hash of the
    whole link spreads a control with more than about ``max_links`` of them over several parts and no
    task gathers an unbounded list.
    """
    columns = ["kind", "tool_id", "package", "rule", "description"]
    once = links.groupBy("control_id", *columns).agg(F.count(F.lit(1)).alias("n"))
    sizes = once.groupBy("control_id").agg(F.ceil(F.count(F.lit(1)) / max_links).alias("_parts"))
    placed = once.join(sizes, "control_id").withColumn("part", F.pmod(F.xxhash64(*columns), F.col("_parts")).cast("int"))
    return placed.groupBy("control_id", "part").agg(F.sort_array(F.collect_list(F.struct(*columns, "n"))).alias("links"))


def link_parts(links: DataFrame, max_bytes: int = PART_BYTES) -> DataFrame:
    """Distinct links with their number ``n`` and the ``part`` of their control that they go to.

    A control's links stand in order, and a part takes as many as fit: their JSON texts add up to ``max_bytes`` at most,
    or it is one link. Links of a control are summed up within stretches of about ``STRETCH`` parts, to which a hash
    deals them, so a control with most of the links is many tasks; up to one stretch they stay in order as a whole.
    """
    columns = ["kind", "tool_id", "package", "rule", "description"]
    once = links.groupBy("control_id", *columns).agg(F.count(F.lit(1)).alias("n"))
    sized = once.withColumn("_size", F.octet_length(F.to_json(F.struct(*columns, "n"))).cast("bigint"))
    stretches = sized.groupBy("control_id").agg(F.ceil(F.sum("_size") / (STRETCH * max_bytes)).alias("_stretches"))
    placed = sized.join(stretches, "control_id").withColumn("_stretch", F.pmod(F.xxhash64(*columns), F.col("_stretches")))
    order = Window.partitionBy("control_id", "_stretch").orderBy(*columns)
    # A link above half the bound stands alone; the others share runs of half the bound, by where they begin.
    alone = F.col("_size") > max_bytes / 2
    before = placed.withColumns(
        {
            "_begin": F.sum(F.when(alone, 0).otherwise(F.col("_size"))).over(order) - F.when(alone, 0).otherwise(F.col("_size")),
            "_large": F.when(alone, F.sum(F.when(alone, 1).otherwise(0)).over(order)).otherwise(0),
        }
    ).withColumn("_run", F.floor(F.col("_begin") / (max_bytes / 2)))
    ranked = before.withColumn("_local", F.dense_rank().over(Window.partitionBy("control_id", "_stretch").orderBy("_run", "_large")) - 1)
    counts = ranked.groupBy("control_id", "_stretch").agg((F.max("_local") + 1).alias("_parts"))
    starts = counts.select(
        "control_id", "_stretch",
        (F.sum("_parts").over(Window.partitionBy("control_id").orderBy("_stretch")) - F.col("_parts")).alias("_start"),
    )
    return ranked.join(starts, ["control_id", "_stretch"]).select(
        "control_id", (F.col("_start") + F.col("_local")).alias("part"), *columns, "n"
    )


def control_parts(current: DataFrame, links: DataFrame, max_bytes: int = PART_BYTES) -> DataFrame:
    """Controls of the catalog and of the mappings as records of a document: ``id``, catalog fields, ``in_catalog, part, tools``.

    Every control has a part 0, which alone carries the catalog fields; further parts carry further links.
    """
    parts = link_parts(links, max_bytes).groupBy("control_id", "part").agg(
        *[F.sort_array(F.collect_list(F.when(F.col("kind") == kind, _record(kind)))).alias(kind) for kind in V.TOOL_KEYS]
    )
    tools = F.struct(*[F.coalesce(F.col(kind), F.array()).alias(kind) for kind in V.TOOL_KEYS])
    rest = [c for c in current.columns if c not in ("id", "tools")]
    first = (F.col("id") == F.col("control_id")) & (F.col("_part") == F.col("part"))
    heads = current.withColumn("_part", F.lit(0).cast("bigint"))
    joined = heads.join(parts, first, "full_outer").withColumn("_id", F.coalesce("id", "control_id"))
    known = current.select(F.col("id").alias("_known")).distinct()
    marked = joined.join(known, F.col("_id") == F.col("_known"), "left")
    return marked.select(
        F.col("_id").alias("id"), *rest, F.col("_known").isNotNull().alias("in_catalog"), F.coalesce("part", "_part").alias("part"), tools.alias("tools")
    )


def _record(kind: str) -> Column:
    """A tool as a list item: checks have a ``check_id``, all others an ``id``; fields that are NULL are left out of JSON."""
    name = F.col("tool_id").alias("check_id" if kind == "checkov_checks" else "id")
    return F.struct(name, "package", "rule", "description", "n")


def dangling(links: DataFrame, inventory: DataFrame, path: str = "path") -> DataFrame:
    """Artifacts that controls refer to and the inventory does not hold."""
    return links.select("control_id", F.col("tool_id").alias(path)).join(
        inventory.select(path).distinct(), path, "left_anti"
    ).select("control_id", path)


def validation(controls: DataFrame, evidence: Column, keys: list[str] | None = None) -> DataFrame:
    """``id, reason``: why a control counts as lacking evidence, NULL if it does not.

    ``evidence`` is a struct of arrays or strings; NULL, or a struct of NULLs, means none at all.
    """
    fields = V.EVIDENCE_KEYS if keys is None else keys
    filled, stated = F.lit(False), F.lit(False)
    for name in fields:
        value = evidence.getField(name)
        stated = stated | value.isNotNull()
        filled = filled | F.coalesce(~F.to_json(F.struct(value.alias("v"))).isin('{"v":[]}', '{"v":""}', "{}"), F.lit(False))
    reason = F.when(~stated, V.REASON_NO_EVIDENCE).when(~filled, V.REASON_EMPTY_EVIDENCE)
    return controls.select("id", reason.alias("reason"))


def coverage(validated: DataFrame, *keys: str) -> DataFrame:
    """Totals of a validation, per key or overall."""
    return validated.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_controls"), F.count("reason").alias("missing_evidence_count")
    )


def missing_evidence(validated: DataFrame) -> DataFrame:
    return validated.where(F.col("reason").isNotNull())


def framework_table(spark: SparkSession) -> DataFrame:
    return fixed_table(spark, V.CHECK_FRAMEWORKS, "check_id string, framework string, ref string, name string")


def finding_frameworks(findings: DataFrame, frameworks: DataFrame) -> DataFrame:
    """Findings with each framework entry of their check; NULLs where the check is not mapped."""
    return findings.join(frameworks, "check_id", "left")


def framework_refs(controls: DataFrame) -> DataFrame:
    """One row per control, framework and reference; comma lists are split."""
    named = controls.select("id", F.inline("frameworks"))
    return named.select("id", "name", F.explode(F.split("ref", ",")).alias("ref")).select(
        "id", F.col("name").alias("framework"), F.trim("ref").alias("ref")
    )


def framework_counts(controls: DataFrame) -> DataFrame:
    """Controls and references per framework, without gathering the controls of a framework."""
    once = framework_refs(controls).groupBy("framework", "id").agg(F.count(F.lit(1)).alias("_n"))
    return once.groupBy("framework").agg(F.count(F.lit(1)).alias("n_controls"), F.sum("_n").alias("n_refs"))


def risk_report(risks: DataFrame) -> DataFrame:
    """One row per risk, control and enforcement; outer, so bare risks stay visible."""
    by_control = risks.select("id", "likelihood", "impact", "enforced_by", F.explode_outer("controls").alias("control"))
    return by_control.select("id", "likelihood", "impact", "control", F.explode_outer("enforced_by").alias("enforced_by"))


def uncontrolled_risks(risks: DataFrame, controls: DataFrame) -> DataFrame:
    """Risks none of whose controls is in the catalog."""
    met = risks.select("id", F.explode("controls").alias("_c")).join(
        controls.select(F.col("id").alias("_c")).distinct(), "_c", "left_semi"
    )
    return risks.select("id").join(met.select("id").distinct(), "id", "left_anti")


def first_controls(index: DataFrame, n: int = 10, order: str = "ordinal") -> DataFrame:
    """First controls in index order; ids known from mappings only come after the catalog."""
    return index.orderBy(F.asc_nulls_last(order), "id").limit(n)

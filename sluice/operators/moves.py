"""Data-movement verdicts where source, destination and state are all columns of a table.

Flow rules come as a table too. They are parsed once, folded to one row per pair of nodes and
joined to the moves; a move never meets more than one row, so nothing fans out and no move is
shuffled while the rules are small enough to broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions import movement as M
from sluice.functions.labels import label_from_hits, state_label_from_hits
from sluice.functions.patterns import SPACE_CHARS
from sluice.functions.rows import first_by
from sluice.operators.tables import fixed_table
from sluice.plans import fixed_values as V

FLOW_SCHEMA = (
    "ordinal int, id string, from string, to string, allowed boolean, "
    "conditions array<string>, requires array<string>"
)


def flow_table(spark: SparkSession, flows: list[M.Flow]) -> DataFrame:
    rows = [
        (i, f.id, f.src, f.dst, f.allowed, None if f.conditions is None else list(f.conditions), list(f.requires))
        for i, f in enumerate(flows)
    ]
    return fixed_table(spark, rows, FLOW_SCHEMA)


def parsed_rules(conditions: Column, mode: str = "first") -> Column:
    """Condition texts as structs ``raw, kind, items``; unknown forms get the kind ``other``.

    The first-match mode trims a condition and drops blank items. The any-flow mode reads a condition as it
    stands, so one with a leading space has an unknown form; it trims spaces from items and keeps blank ones.
    """
    loose = mode == "first"

    def one(text: Column) -> Column:
        raw = F.trim(text, F.lit(SPACE_CHARS)) if loose else text
        inner = F.regexp_extract(raw, M.BRACKETED, 1)
        items = F.transform(F.split(inner, ","), lambda i: F.trim(i, F.lit(SPACE_CHARS if loose else " ")))
        kind = (
            F.when(raw.startswith("classification_label not_in"), "label_not_in")
            .when(raw.startswith("policy_decision.action in"), "action_in")
            .when(raw == "redaction_applied == true", "redacted")
            .otherwise("other")
        )
        return F.struct(raw.alias("raw"), kind.alias("kind"), (F.array_remove(items, "") if loose else items).alias("items"))

    return F.transform(conditions, one)


def flows_by_pair(flows: DataFrame, mode: str = "first") -> DataFrame:
    """One row per ``(from, to)``: its first flow in file order, or for the any-flow mode the list of its flows.

    Of flows of a pair that say the same only the first can decide, so the list holds each form once.
    """
    flow = F.struct(
        "ordinal", F.coalesce("id", F.lit("<unknown>")).alias("id"),
        F.coalesce("allowed", F.lit(False)).alias("allowed"),
        parsed_rules(F.col("conditions"), mode).alias("rules"),
    )
    rows = flows.select(F.col("from").alias("_src"), F.col("to").alias("_dst"), flow.alias("_flow"))
    order = F.col("_flow.ordinal"), F.col("_flow.id")
    if mode == "first":
        return first_by(rows, ["_src", "_dst"], *order).withColumnRenamed("_flow", "_flows")
    keyed = rows.withColumns({"_allowed": F.col("_flow.allowed"), "_rules": F.col("_flow.rules")})
    forms = first_by(keyed, ["_src", "_dst", "_allowed", "_rules"], *order)
    return forms.groupBy("_src", "_dst").agg(F.sort_array(F.collect_list("_flow")).alias("_flows"))


def judge(
    moves: DataFrame, flows: DataFrame, *, mode: str = "first",
    src: str = "src", dst: str = "dst", label: str = "label", action: str = "action", redacted: str = "redacted",
    refusal: Column | str | None = None,
) -> DataFrame:
    """Append ``allow`` and ``reason``.

    ``refusal`` is a reason not to trust the policy (``readers.flow_refusal``). Where it is not null every
    move is denied for it before any rule is read, the one to the model too.

    ``mode='first'``: the first flow of the pair decides and absent state takes its default.
    ``mode='any'``: some allowed flow must pass; an absent action or redaction violates, and a
    flow with no condition list never allows.
    """
    if mode not in ("first", "any"):
        raise ValueError("mode is 'first' or 'any'")
    pairs = flows_by_pair(flows, mode)
    joined = moves.join(pairs, (F.col(src) == F.col("_src")) & (F.col(dst) == F.col("_dst")), "left")
    to_model = F.coalesce((F.col(src) == "rag_orchestrator") & (F.col(dst) == "llm"), F.lit(False))
    columns = F.col(label), F.col(action), F.col(redacted)
    build = _first_verdict if mode == "first" else _any_verdict
    judged = build(joined, to_model, F.col("_flows"), *columns)
    if refusal is not None:
        why = F.lit(refusal) if isinstance(refusal, str) else refusal
        judged = judged.withColumn("_verdict", F.when(why.isNotNull(), _verdict(False, why)).otherwise(F.col("_verdict")))
    return judged.select(*moves.columns, F.col("_verdict.allow").alias("allow"), F.col("_verdict.reason").alias("reason"))


def _verdict(allow, reason) -> Column:
    return F.struct(
        (F.lit(allow) if isinstance(allow, bool) else allow).alias("allow"),
        (F.lit(reason) if isinstance(reason, str) else reason).alias("reason"),
    )


def _first_verdict(joined, to_model, flow, label, action, redacted) -> DataFrame:
    st = M.state(label, action, redacted)

    def breaks(rule: Column) -> Column:
        return (
            F.when(rule["kind"] == "label_not_in", F.array_contains(rule["items"], st.label))
            .when(rule["kind"] == "action_in", ~F.array_contains(rule["items"], st.action))
            .when(rule["kind"] == "redacted", ~st.redacted)
            .otherwise(F.lit(False))
        )

    found = joined.withColumn("_broken", F.get(F.filter(flow["rules"], breaks), F.lit(0))["raw"])
    broken = F.col("_broken")
    named = lambda text: F.format_string(f"flow %s {text}", flow["id"])
    passes = M.passes_to_model(st)
    return found.withColumn(
        "_verdict",
        F.when(to_model, _verdict(passes, M.model_reason(st, passes)))
        .when(flow.isNull(), _verdict(False, V.REASON_NO_FLOW))
        .when(
            F.coalesce(F.size(flow["rules"]), F.lit(0)) <= 0,
            _verdict(
                flow["allowed"],
                F.when(flow["allowed"], named("allowed (no additional conditions)"))
                .otherwise(named("explicitly denied (no additional conditions)")),
            ),
        )
        .when(broken.isNotNull(), _verdict(False, F.concat(named("denied: "), broken)))
        .otherwise(
            _verdict(
                flow["allowed"],
                F.when(flow["allowed"], named("allowed (conditions satisfied)"))
                .otherwise(named("denied (allowed=false despite conditions passing)")),
            )
        ),
    )


def _any_verdict(joined, to_model, flows, label, action, redacted) -> DataFrame:
    def breaks(rule: Column) -> Column:
        acts = F.coalesce(F.array_contains(rule["items"], action), F.lit(False))
        held = F.coalesce(F.array_contains(rule["items"], label), F.lit(False))
        return (
            F.when(rule["kind"] == "label_not_in", held)
            .when(rule["kind"] == "action_in", ~acts)
            .when(rule["kind"] == "redacted", ~F.coalesce(redacted, F.lit(False)))
            .otherwise(F.lit(False))
        )

    def passes(flow: Column) -> Column:
        return flow["allowed"] & flow["rules"].isNotNull() & ~F.coalesce(F.exists(flow["rules"], breaks), F.lit(False))

    model_ok = to_model & F.coalesce(~label.isin(*M.RESTRICTED), F.lit(True)) & F.coalesce(
        action.isin(*M.PASSING_ACTIONS), F.lit(False)
    )
    failing = F.filter(flows, lambda f: F.coalesce(F.exists(f["rules"], breaks), F.lit(False)))
    found = joined.withColumns({"_good": F.get(F.filter(flows, passes), F.lit(0)), "_bad": F.get(failing, F.lit(0))})
    good, bad = F.col("_good"), F.col("_bad")
    broken = F.get(F.filter(bad["rules"], breaks), F.lit(0))["raw"]
    return found.withColumn(
        "_verdict",
        F.when(
            model_ok & label.isNotNull(),
            _verdict(True, F.format_string("rag_orchestrator → llm allowed (label=%s, action=%s)", label, action)),
        )
        .when(good.isNotNull(), _verdict(True, F.format_string("flow %s allowed", good["id"])))
        .when(bad.isNotNull(), _verdict(model_ok, F.format_string("flow %s denied: %s", bad["id"], broken)))
        .otherwise(_verdict(model_ok, "no matching flow")),
    )


def with_requirements(moves: DataFrame, flows: DataFrame, *, src: str = "src", dst: str = "dst", done: str = "done") -> DataFrame:
    """One row per move and flow of its pair: are the controls the flow requires all done?"""
    rules = flows.select(
        F.col("from").alias("_src"), F.col("to").alias("_dst"), F.col("id").alias("flow_id"),
        F.coalesce("requires", F.array().cast("array<string>")).alias("_requires"),
    )
    joined = moves.join(rules, (F.col(src) == F.col("_src")) & (F.col(dst) == F.col("_dst")))
    have = F.coalesce(F.col(done), F.array().cast("array<string>"))
    return joined.select(
        *moves.columns, "flow_id",
        M.requirements_met(F.col("_requires"), have).alias("met"),
        F.array_except("_requires", have).alias("missing"),
    )


def unapproved(df: DataFrame, allowed: str = "allowed") -> DataFrame:
    """Moves whose flow is not marked allowed; an absent mark counts as not allowed."""
    return df.where(~F.coalesce(F.col(allowed), F.lit(False)))


def any_approval(decisions: DataFrame, *keys: str, allow: str = "allow") -> DataFrame:
    """One row per key: approved as soon as one decision allows."""
    return decisions.groupBy(*keys).agg(F.coalesce(F.bool_or(allow), F.lit(False)).alias("approved"))


def check_cases(cases: DataFrame, flows: DataFrame, *, expected: str = "expected", wanted_text: str = "reason_contains") -> DataFrame:
    """Run expectation rows; only the verdict decides ``passed``, the reason text is reported."""
    judged = judge(cases, flows)
    return judged.withColumn("passed", F.col("allow") == F.col(expected)).withColumn(
        "reason_found", F.contains(F.col("reason"), F.col(wanted_text))
    )


def prompt_state() -> M.State:
    """Movement state of a scanned prompt: its label, with the action and redaction prompts start with."""
    return M.state(state_label_from_hits(), F.lit("allow"), F.lit(False))


def prompt_verdicts(scanned: DataFrame, *keys: str, flows: list[M.Flow] | None = None) -> DataFrame:
    """``label, hops, blocked`` per scanned prompt, from its hit columns. No shuffle."""
    return scanned.select(
        *keys, label_from_hits().alias("label"),
        M.prompt_hops(prompt_state(), flows).alias("hops"),
        M.chain_blocked(prompt_state(), flows).alias("blocked"),
    )


def hop_rows(
    scanned: DataFrame, *keys: str, flows: list[M.Flow] | None = None, hops: list[tuple[str, str]] | None = None
) -> DataFrame:
    """Long form: one row per scanned prompt and hop.

    Hop numbers are exploded first and the verdict is chosen by number, so that the rows carry a
    small CASE instead of an array of all verdicts.
    """
    book = M.DEFAULT_FLOWS if flows is None else flows
    chain = V.PROMPT_HOPS if hops is None else hops
    numbered = scanned.select(
        *keys, state_label_from_hits().alias("_label"),
        F.explode(F.array(*[F.lit(n) for n in range(1, len(chain) + 1)])).alias("hop_no"),
    )
    st = M.state(F.col("_label"), F.lit("allow"), F.lit(False))
    verdicts = [M.hop_verdict(book, src, dst, st) for src, dst in chain]

    def by_number(values: list) -> Column:
        picked = F.when(F.col("hop_no") == 1, values[0])
        for n, value in enumerate(values[1:], start=2):
            picked = picked.when(F.col("hop_no") == n, value)
        return picked

    return numbered.select(
        *keys, "hop_no",
        by_number([src for src, _ in chain]).alias("from"),
        by_number([dst for _, dst in chain]).alias("to"),
        by_number([v["allow"] for v in verdicts]).alias("allow"),
        by_number([v["reason"] for v in verdicts]).alias("reason"),
    )

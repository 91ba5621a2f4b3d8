"""Data-movement verdicts compiled from a flow list into columns.

A flow list is policy text: short, and known when the query is written. Compiling it makes
each hop a CASE over three state columns, so prompts need no join and no shuffle. Where source
and destination are themselves columns, use ``operators.moves``.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from sluice.plans import fixed_values as V

RESTRICTED = ["RESTRICTED_PII", "RESTRICTED_PHI"]
PASSING_ACTIONS = ["allow", "mask"]
BRACKETED = r"^[^\[\]]*\[([^\]]*)\]"


@dataclass(frozen=True)
class Flow:
    id: str
    src: str
    dst: str
    allowed: bool
    conditions: tuple[str, ...] | None = None
    requires: tuple[str, ...] = field(default=())


def flow_list(rows: list[tuple]) -> list[Flow]:
    return [
        Flow(r[0], r[1], r[2], r[3], None if r[4] is None else tuple(r[4]), tuple(r[5]) if len(r) > 5 else ())
        for r in rows
    ]


DEFAULT_FLOWS = flow_list(V.DEFAULT_FLOWS)
FULL_FLOWS = flow_list(V.FULL_FLOWS)


def bracket_items(condition: str) -> list[str]:
    """Items between the first pair of brackets, trimmed, blanks dropped."""
    found = re.search(BRACKETED, condition, re.S)
    return [item.strip() for item in found.group(1).split(",") if item.strip()] if found else []


@dataclass(frozen=True)
class State:
    """State columns with the defaults for what is absent."""

    label: Column
    action: Column
    redacted: Column


def state(label: Column | None = None, action: Column | None = None, redacted: Column | None = None) -> State:
    null = F.lit(None)
    return State(
        F.coalesce((null if label is None else label).cast("string"), F.lit("INTERNAL")),
        F.coalesce((null if action is None else action).cast("string"), F.lit("allow")),
        F.coalesce((null if redacted is None else redacted).cast("boolean"), F.lit(False)),
    )


def _violates(condition: str, st: State) -> Column | None:
    items = bracket_items(condition)
    if condition.startswith("classification_label not_in"):
        return st.label.isin(*items) if items else F.lit(False)
    if condition.startswith("policy_decision.action in"):
        return ~st.action.isin(*items) if items else F.lit(True)
    if condition == "redaction_applied == true":
        return ~st.redacted
    return None


def first_violation(conditions: tuple[str, ...], st: State) -> Column:
    """The first violated condition text, or NULL. Unknown forms never violate."""
    found = None
    for text in (c.strip() for c in conditions):
        test = _violates(text, st)
        if test is not None:
            found = F.when(test, text) if found is None else found.when(test, text)
    return F.lit(None).cast("string") if found is None else found


def passes_to_model(st: State) -> Column:
    return ~st.label.isin(*RESTRICTED) & st.action.isin(*PASSING_ACTIONS)


def model_reason(st: State, passes: Column) -> Column:
    verdict = F.when(passes, "allowed").otherwise("blocked due to label/action")
    return F.format_string("rag_orchestrator → llm %s (label=%s, action=%s)", verdict, st.label, st.action)


def hop_verdict(flows: list[Flow] | None, src: str, dst: str, st: State) -> Column:
    """Struct ``allow, reason`` for one fixed hop. The first flow of the pair decides.

    ``flows=None`` stands for a policy file that is not there: everything is denied.
    """
    if flows is None:
        return _verdict(F.lit(False), F.lit(V.REASON_NO_POLICY))
    if (src, dst) == ("rag_orchestrator", "llm"):
        passes = passes_to_model(st)
        return _verdict(passes, model_reason(st, passes))
    flow = next((f for f in flows if (f.src, f.dst) == (src, dst)), None)
    if flow is None:
        return _verdict(F.lit(False), F.lit(V.REASON_NO_FLOW))
    if not flow.conditions:
        text = "allowed" if flow.allowed else "explicitly denied"
        return _verdict(F.lit(flow.allowed), F.lit(f"flow {flow.id} {text} (no additional conditions)"))
    broken = first_violation(flow.conditions, st)
    passed = (
        f"flow {flow.id} allowed (conditions satisfied)"
        if flow.allowed
        else f"flow {flow.id} denied (allowed=false despite conditions passing)"
    )
    reason = F.when(broken.isNotNull(), F.concat(F.lit(f"flow {flow.id} denied: "), broken)).otherwise(passed)
    return _verdict(broken.isNull() & F.lit(flow.allowed), reason)


def _verdict(allow: Column, reason: Column) -> Column:
    return F.struct(allow.alias("allow"), reason.alias("reason"))


def prompt_hops(st: State, flows: list[Flow] | None = None, hops: list[tuple[str, str]] | None = None) -> Column:
    """Array of hop structs ``hop_no, from, to, allow, reason`` for the fixed chain of a prompt."""
    book = DEFAULT_FLOWS if flows is None else flows
    rows = []
    for number, (src, dst) in enumerate(V.PROMPT_HOPS if hops is None else hops, start=1):
        verdict = hop_verdict(book, src, dst, st)
        rows.append(
            F.struct(
                F.lit(number).alias("hop_no"), F.lit(src).alias("from"), F.lit(dst).alias("to"),
                verdict["allow"].alias("allow"), verdict["reason"].alias("reason"),
            )
        )
    return F.array(*rows)


def chain_blocked(st: State, flows: list[Flow] | None = None, hops: list[tuple[str, str]] | None = None) -> Column:
    """True where any hop of the chain is denied; decided inside the row."""
    book = DEFAULT_FLOWS if flows is None else flows
    denied = F.lit(False)
    for src, dst in V.PROMPT_HOPS if hops is None else hops:
        denied = denied | ~hop_verdict(book, src, dst, st)["allow"]
    return denied


def requirements_met(requires: Column, done: Column) -> Column:
    return F.size(F.array_except(requires, done)) == 0

"""Masking of matched spans, and the short preview kept with evidence.

The rule set this engine follows declares a mask action but never masks; this is what a
``mask`` verdict should do. The parity answer text is in ``functions.decisions``.

Every detector gives the spans of its values in the text as it came. Spans that overlap are united, and all are cut
out in one pass, so no mask hides what another detector would have found.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions import patterns as P
from sluice.functions.rows import fresh

PREVIEW_CHARS = 200
SPAN = "struct<start:int,end:int,type:string>"


def spans_of(text: Column, kind: str, pattern: str) -> Column:
    """Spans of all values of a pattern, as array of (start, end, type); positions count characters from 0.

    The pattern's one group is its value, which ends where the match ends. What stands between matches comes from
    a split at them, so lengths add up to the matches' ends.
    """
    gaps = F.transform(F.split(text, pattern, -1), lambda g: F.length(g))
    matches = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda m: F.length(m))
    values = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)), lambda v: F.length(v))
    lengths = F.zip_with(F.slice(gaps, 1, F.size(matches)), matches, lambda g, m: g + m)
    none = F.array().cast("array<struct<end:int,size:int>>")
    added = F.aggregate(
        F.arrays_zip(lengths.alias("match"), values.alias("value")), none,
        lambda found, m: F.concat(
            found,
            F.array(F.struct((F.coalesce(F.try_element_at(found, F.lit(-1))["end"], F.lit(0)) + m["match"]).alias("end"), m["value"].alias("size"))),
        ),
    )
    return F.transform(
        added, lambda m: F.struct((m["end"] - m["size"]).alias("start"), m["end"].alias("end"), F.lit(kind).alias("type"))
    ).cast(f"array<{SPAN}>")


def united(spans: Column) -> Column:
    """Ascending spans without overlaps. United ones have the type of the first; of equal starts, of the longest."""
    ordered = F.array_sort(
        spans,
        lambda a, b: F.when(a["start"] != b["start"], a["start"] - b["start"]).otherwise(b["end"] - a["end"]),
    )

    def add(found: Column, s: Column) -> Column:
        last = F.try_element_at(found, F.lit(-1))
        wider = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"), last["type"].alias("type"))
        return F.when((F.size(found) == 0) | (s["start"] >= last["end"]), F.concat(found, F.array(s))).otherwise(
            F.concat(F.slice(found, 1, F.size(found) - 1), F.array(wider))
        )

    return F.aggregate(ordered, F.array().cast(f"array<{SPAN}>"), add)


def cut_out(text: Column, spans: Column) -> Column:
    """The text with each of the ascending spans replaced by its type in brackets."""
    parts = F.transform(
        spans,
        lambda s, i: F.concat(
            F.substring(text, F.coalesce(F.get(spans, i - 1)["end"], F.lit(0)) + 1, s["start"] - F.coalesce(F.get(spans, i - 1)["end"], F.lit(0))),
            F.lit("["), s["type"], F.lit("]"),
        ),
    )
    rest = F.try_element_at(spans, F.lit(-1))["end"] + 1
    return F.concat(F.array_join(parts, ""), F.substring(text, rest, F.length(text)))


def with_spans(df: DataFrame, text: str = "text", out: str = "spans", detectors: list[tuple[str, str, str]] | None = None) -> DataFrame:
    """Append the united spans of all detectors; NULL where nothing is found.

    Each pattern is a projection of its own, run only on rows that hold its fixed word. The appended column
    replaces one of its name; all others stay.
    """
    low, every = fresh(df, "_low"), fresh(df, "_found")
    found = df.withColumns({low: F.lower(F.col(text)), every: F.array().cast(f"array<{SPAN}>")})
    for kind, pattern, needle in P.SPANS if detectors is None else detectors:
        more = F.concat(every, spans_of(F.col(text), kind, pattern))
        met = F.when(F.contains(low, F.lit(needle)), F.rlike(text, F.lit(pattern)))  # most texts with the word have no match
        found = found.withColumn(every, F.when(met, more).otherwise(F.col(every)))
    return found.withColumn(out, F.when(F.size(every) > 0, united(F.col(every)))).drop(low, every)


def with_masked(
    df: DataFrame, text: str = "text", out: str = "masked_text", detectors: list[tuple[str, str, str]] | None = None
) -> DataFrame:
    """Append the text with every matched span replaced by its type in brackets. NULL stays NULL.

    All values that the detectors find are gone from it: also a passport value without digits, and the
    second of two values that overlap.
    """
    spans = fresh(df, "_spans")
    marked = with_spans(df, text, spans, detectors)
    return marked.withColumn(out, F.when(F.col(spans).isNull(), F.col(text)).otherwise(cut_out(F.col(text), F.col(spans)))).drop(spans)


def safe_preview(masked: Column, chars: int = PREVIEW_CHARS) -> Column:
    """First characters of already masked text."""
    return F.substring(F.coalesce(masked, F.lit("")), 1, chars)


"""Entity detection over text: one flat column per detector, then cheap columns on top.

``with_hits`` runs every pattern once per row and names the outcome. All labels, entity
arrays and decisions are then derived from those columns, so a pattern is never repeated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.functions import patterns as P
from sluice.functions.rows import explode_found
from sluice.plans import fixed_values as V

ENTITY_DDL = "struct<type:string,value:string,score:double>"
HIT_COLUMNS = ["hit_ssn", "hit_routing", "hit_passport", "hit_mrn", "hit_phi", "hit_ssn_word"]


def _any_of(text: Column, needles: list[str]) -> Column:
    test = F.contains(text, F.lit(needles[0]))
    for needle in needles[1:]:
        test = test | F.contains(text, F.lit(needle))
    return test


def with_hits(df: DataFrame, text: str = "text") -> DataFrame:
    """Append the hit columns. Matched text is NULL and flags are false where nothing is found.

    The lower-cased text and then the raw matches are projections of their own: each is used more
    than once further up, and a separate projection keeps Catalyst from repeating it. Patterns
    with a fixed word in them are tried only on rows that hold that word.
    """
    raw, low = F.col("_raw"), F.col("_low")
    plain = F.coalesce(F.col(text), F.lit(""))
    read = df.withColumns({"_raw": plain, "_low": F.lower(plain)})

    def when_has(word: str, value: Column) -> Column:
        return F.when(F.contains(low, F.lit(word)), value)

    matched = read.withColumns(
        {
            "hit_ssn": F.when(F.contains(raw, F.lit("-")), F.regexp_extract(raw, P.SSN, 1)),
            "hit_routing": when_has("routing ", F.regexp_extract(low, P.ROUTING_LOWER, 1)),
            "hit_passport": when_has("port", F.regexp_extract(raw, P.PASSPORT, 1)),
            "hit_mrn": F.coalesce(when_has("mrn", F.rlike(low, F.lit(P.MRN_LOWER))), F.lit(False)),
            "hit_phi": F.coalesce(
                F.when(_any_of(low, P.PHI_STEMS), F.rlike(low, F.lit(P.PHI_LOWER))), F.lit(False)
            ),
            "hit_ssn_word": F.contains(low, F.lit("ssn")),
        }
    ).drop("_raw", "_low")
    values = ["hit_ssn", "hit_routing", "hit_passport"]
    return matched.withColumns({name: F.nullif(F.col(name), F.lit("")) for name in values})


def drop_hits(df: DataFrame) -> DataFrame:
    return df.drop(*HIT_COLUMNS)


def entity(kind: str, value: Column | str, score: float) -> Column:
    shown = F.lit(value) if isinstance(value, str) else value
    return F.struct(
        F.lit(kind).alias("type"), shown.cast("string").alias("value"), F.lit(score).alias("score")
    )


def entity_list(parts: list[tuple[Column, Column]]) -> Column:
    """Array of the entities whose condition holds, in the given order."""
    empty = F.array().cast(f"array<{ENTITY_DDL}>")
    return F.concat(*[F.when(test, F.array(item)).otherwise(empty) for test, item in parts])


def _identity_parts() -> list[tuple[Column, Column]]:
    return [
        (F.col("hit_ssn").isNotNull(), entity("SSN", F.col("hit_ssn"), V.DETECTOR_SCORES["SSN"])),
        (F.col("hit_routing").isNotNull(),
         entity("ROUTING", F.col("hit_routing"), V.DETECTOR_SCORES["ROUTING"])),
        (F.col("hit_passport").isNotNull(),
         entity("PASSPORT", F.col("hit_passport"), V.DETECTOR_SCORES["PASSPORT"])),
    ]


def entities() -> Column:
    """All detected entities, at most one of each type, from the hit columns."""
    return entity_list(
        _identity_parts()
        + [
            (F.col("hit_mrn"), entity("MRN", V.MRN_VALUE, V.DETECTOR_SCORES["MRN"])),
            (F.col("hit_phi"), entity("PHI_HINT", V.PHI_HINT_VALUE, V.DETECTOR_SCORES["PHI_HINT"])),
        ]
    )


def pii_entities() -> Column:
    """Identity entities only, plus a low-score SSN where the text just mentions the word."""
    mention = F.col("hit_ssn").isNull() & F.col("hit_ssn_word")
    return entity_list(
        _identity_parts() + [(mention, entity("SSN", V.SSN_WORD_VALUE, V.SSN_WORD_SCORE))]
    )


def has_ssn_finding() -> Column:
    """True where ``pii_entities`` holds an SSN entity."""
    return F.col("hit_ssn").isNotNull() | F.col("hit_ssn_word")


def detect_entities(df: DataFrame, text: str = "text", out: str = "entities") -> DataFrame:
    return drop_hits(with_hits(df, text).withColumn(out, entities()))


def detect_pii(df: DataFrame, text: str = "text", out: str = "entities") -> DataFrame:
    return drop_hits(with_hits(df, text).withColumn(out, pii_entities()))


def detect_alternate(df: DataFrame, text: str = "text", out: str = "entities") -> DataFrame:
    """The second detector: SSN, numbered MRN and street address; entities carry no value."""
    raw = F.coalesce(F.col(text), F.lit(""))
    flagged = df.withColumns(
        {
            "alt_ssn": F.rlike(raw, F.lit(P.SSN)),
            "alt_mrn": F.rlike(raw, F.lit(P.MRN_SPACED)),
            "alt_address": F.rlike(raw, F.lit(P.ADDRESS)),
        }
    )
    none = F.lit(None)
    parts = [
        (F.col("alt_ssn"), entity("SSN", none, V.ALT_DETECTOR_SCORES["SSN"])),
        (F.col("alt_mrn"), entity("MRN", none, V.ALT_DETECTOR_SCORES["MRN"])),
        (F.col("alt_address"), entity("ADDRESS", none, V.ALT_DETECTOR_SCORES["ADDRESS"])),
    ]
    return flagged.withColumn(out, entity_list(parts)).drop("alt_ssn", "alt_mrn", "alt_address")


def with_spare_flags(df: DataFrame, text: str = "text") -> DataFrame:
    """Optional detectors no rule uses: a bare nine-digit word and an MRN with punctuation."""
    raw = F.coalesce(F.col(text), F.lit(""))
    return df.withColumns(
        {
            "spare_ssn": F.rlike(raw, F.lit(P.SSN)),
            "spare_routing": F.rlike(raw, F.lit(P.NINE_DIGITS)),
            "spare_mrn": F.rlike(raw, F.lit(P.MRN_PUNCT)),
        }
    )


def explode_entities(df: DataFrame, *keys: str, entities_col: str = "entities") -> DataFrame:
    """Long form: one row per entity."""
    found = explode_found(df, *keys, array=entities_col, alias="_entity")
    return found.select(*keys, "_entity.type", "_entity.value", "_entity.score")


def injection_phrases(text: Column, phrases: list[str] | None = None) -> Column:
    """Array of the phrases found in the lower-cased text, in list order."""
    low = F.lower(F.coalesce(text, F.lit("")))
    wanted = V.INJECTION_PHRASES if phrases is None else phrases
    return F.concat(
        *[
            F.when(F.contains(low, F.lit(p)), F.array(F.lit(p))).otherwise(F.array().cast("array<string>"))
            for p in wanted
        ]
    )


GRAM = 5


def phrase_hits(texts: DataFrame, phrases: DataFrame, *keys: str, text: str = "text", phrase: str = "phrase") -> DataFrame:
    """``<keys>, phrase`` of every phrase that the lower-cased text contains, for phrase tables of any size.

    Every phrase has an anchor, a run of GRAM characters in it that few phrases hold: one that begins with a blank if the
    phrase has a blank before its last letters, else any; a phrase that is shorter is its own. Texts are joined with anchors
    by the runs of characters that they hold, those after blanks alone if that will do, and only such candidates
    are tested, so no text meets every phrase. Phrases are compared as they are; an empty one is in every text, a NULL
    one in none. ``keys`` tell texts apart: of rows with equal keys all texts count.
    """
    asked = phrases.select(F.col(phrase).alias("phrase")).where(F.col("phrase").isNotNull()).distinct()
    none = F.array().cast("array<string>")

    def runs_of(whole: str, n: int, first: str = "") -> Column:
        """All runs of n characters; the pattern looks ahead, so they may overlap and the text is read once."""
        return F.array(F.lit("")) if n == 0 else F.regexp_extract_all(whole, F.lit(f"(?s)(?=({first}.{{{n - len(first)}}}))"), F.lit(1))

    blank = [runs_of("phrase", n, " ") for n in range(GRAM, 2, -1)]
    held = F.when(F.size(blank[0]) > 0, blank[0])
    for runs in blank[1:]:
        held = held.when(F.size(runs) > 0, runs)
    held = held.when(F.length("phrase") >= GRAM, runs_of("phrase", GRAM)).otherwise(F.array("phrase"))
    runs = asked.select("phrase", F.explode(F.array_distinct(held)).alias("run"))
    rare = runs.groupBy("run").agg(F.count("*").alias("n"))
    order = Window.partitionBy("phrase").orderBy("n", "run")
    anchors = runs.join(rare, "run").withColumn("place", F.row_number().over(order)).where("place = 1").select("phrase", F.col("run").alias("anchor"))
    # which kinds of anchors there are: their lengths, negative for those that begin with a blank
    kind = F.length("anchor") * F.when((F.length("anchor") > 2) & F.startswith("anchor", F.lit(" ")), -1).otherwise(1)
    kinds = anchors.agg(F.coalesce(F.collect_set(kind), F.array().cast("array<int>"))).scalar()
    low = texts.select(*keys, F.lower(F.coalesce(F.col(text), F.lit(""))).alias("_text")).withColumn("_kinds", kinds)
    parts = F.concat(
        *[F.when(F.array_contains("_kinds", n), runs_of("_text", n)).otherwise(none) for n in range(GRAM + 1)],
        *[F.when(F.array_contains("_kinds", -n), runs_of("_text", n, " ")).otherwise(none) for n in range(3, GRAM + 1)],
    )
    placed = low.select(*keys, F.explode(F.array_distinct(parts)).alias("anchor"))
    met = placed.join(anchors, "anchor").select(*keys, "phrase").distinct()
    same = F.lit(True)
    for key in keys:
        same = same & F.col(f"t.{key}").eqNullSafe(F.col(f"m.{key}"))
    tested = low.alias("t").join(met.alias("m"), same).where(F.contains("t._text", "m.phrase"))
    return tested.select(*[F.col(f"m.{key}").alias(key) for key in keys], "m.phrase").distinct()


def leaks_ssn(text: Column) -> Column:
    """Model output holds an SSN-shaped run of digits, with no word edge required."""
    return F.rlike(F.coalesce(text, F.lit("")), F.lit(P.SSN_LOOSE))


def unapproved_diagnosis(text: Column, approved_provider: Column) -> Column:
    mentions = F.contains(F.lower(F.coalesce(text, F.lit(""))), F.lit("diagnose"))
    return mentions & ~F.coalesce(approved_provider, F.lit(False))

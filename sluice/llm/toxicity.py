"""Toxicity by a weighted finite-state pattern grammar.

Words of a clause become classes: insult, threat, target, negation, report, copula, modal, other. Five small machines
follow insults (is one said of somebody: after a copula or a target?), threats (is one announced: after a modal or a
future?), target, negation and reported speech, and are composed into one. Where it reads an insult or a threat it emits a match
with what holds there. A document scores by its matched clauses, with weights per kind of match, not by its words: a unit counts once
for each kind of clause that it stands in, however often. Insult words and stems and their weights are learned from labelled documents: a
unit counts by its distinct neighbours, so a word that stands in copies of one document is not taken.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from sluice.functions.rows import fresh
from sluice.llm import files
from sluice.llm import labels as L

LABEL = "toxic"
THRESHOLD = 0.5
STEMS = (4, 5, 6, 7)  # letters of a learned stem
LEAST_PRECISION = 0.6
CHANCE = 0.05  # units expected in the lexicon by chance alone
NEGATED_WORDS = 3
SAID_WORDS = 4  # words from a copula or target to its insult, and from a modal to its threat
THREAT_WEIGHT = 3.0

# Function words of four languages, and verbs of threat.
TARGET = set("you your you're u ur he she they them him her du dich dir ihr euch sie tu te toi vous tú usted ustedes él ella ellos".split())
NEGATION = set("not no never don't doesn't isn't aren't wasn't nor neither nicht kein keine nie pas jamais ni nunca".split())
REPORT = set("said says wrote called quoted claimed reported sagte schrieb nannte dit écrit déclaré dijo escribió llamó".split())
COPULA = set("is are am was were be being such ist bist sind war waren seid es êtes est sont était eres es son era fue".split())
MODAL = set("will would shall should must gonna going want i'll we'll werde werden wird sollte muss will vais va allons dois voy vamos debo quiero".split())
THREAT = set("kill murder hurt destroy stab shoot töten umbringen tuer matar".split())
CLASSES = ("other", "insult", "threat", "target", "negation", "report", "copula", "modal")
#: What a clause says: an insult or a threat; directed at somebody or announced; with a target, negated, reported.
KINDS = list(product(("insult", "threat"), (False, True), (False, True), (False, True), (False, True)))

WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?")
CLAUSE_END = re.compile(r"[.!?;\n]")


class Machine:
    """A deterministic machine over classes: a table of next states and what each state says."""

    def __init__(self, table: list[dict[str, int]], says: list[tuple[bool, ...]]):
        self.table = [[row.get(c, row["*"]) for c in CLASSES] for row in table]
        self.says = says


def within(words: int, *names: str) -> Machine:
    """The machine that says whether one of the classes was read at most so many words ago."""
    begin = {name: words for name in names}
    return Machine([begin | {"*": 0}] + [begin | {"*": k} for k in range(words)], [(False,)] + [(True,)] * words)


#: A target was read in this clause.
TARGETED = Machine([{"target": 1, "*": 0}, {"*": 1}], [(False,), (True,)])
#: A negation was read at most NEGATED_WORDS words ago.
NEGATED = within(NEGATED_WORDS, "negation")
#: A verb of speech was read in this clause.
REPORTED = Machine([{"report": 1, "*": 0}, {"*": 1}], [(False,), (True,)])
#: An insult here is said of somebody: a copula or a target was read shortly before.
INSULTING = within(SAID_WORDS, "copula", "target")
#: A threat here is announced: a modal or a future was read shortly before.
THREATENING = within(SAID_WORDS, "modal")


def compose(*machines: Machine) -> Machine:
    """The machine that runs all of them at once; its states are the reachable tuples of theirs."""
    states = {(0,) * len(machines): 0}
    table, says = [], []
    queue = list(states)
    for state in queue:
        row = {}
        for k, name in enumerate(CLASSES):
            following = tuple(m.table[s][k] for m, s in zip(machines, state))
            if following not in states:
                states[following] = len(states)
                queue.append(following)
            row[name] = states[following]
        table.append(row | {"*": 0})
        says.append(tuple(x for m, s in zip(machines, state) for x in m.says[s]))
    return Machine(table, says)


GRAMMAR = compose(TARGETED, NEGATED, REPORTED, INSULTING, THREATENING)


class Lexicon:
    """Weights of insult words and of stems (marked by a star), as learned, with the fixed classes."""

    def __init__(self, units: dict[str, float]):
        import ahocorasick

        self.units = units
        groups = ((7, MODAL), (6, COPULA), (5, REPORT), (4, NEGATION), (3, TARGET), (2, THREAT))
        self.fixed = {w: k for k, group in groups for w in group}
        self.search = ahocorasick.Automaton()
        for unit in {u.rstrip("*") for u in units} | THREAT:
            self.search.add_word(unit, len(unit))
        self.search.make_automaton()

    def unit(self, word: str) -> str | None:
        if word in self.units:
            return word
        return next((s for n in STEMS if len(word) > n and (s := word[:n] + "*") in self.units), None)

    def kind(self, word: str) -> int:
        return 1 if self.unit(word) else self.fixed.get(word, 0)

    def matches(self, text: str) -> dict[tuple, set[str]]:
        """The distinct units that the clauses of a text match, by kind of match."""
        low = text.lower()
        found: dict[tuple, set[str]] = defaultdict(set)
        done = -1
        for end, size in self.search.iter(low):
            start = end - size + 1
            if start <= done or (start and low[start - 1].isalpha()):
                continue
            first = max(low.rfind(c, 0, start) for c in ".!?;\n") + 1
            stop = CLAUSE_END.search(low, end)
            done = stop.start() if stop else len(low)
            for unit, kind in self.clause(low[first:done]):
                found[kind].add(unit)
        return found

    def clause(self, clause: str) -> Iterator[tuple[str, tuple]]:
        """(unit, kind) of each insult and threat that the composed machine reads in a clause."""
        words = WORD.findall(clause)
        kinds = [self.kind(w) for w in words]
        # a target may follow: the same machine is read from the end for it
        after, state = [False] * len(kinds), 0
        for k in range(len(kinds) - 1, -1, -1):
            after[k] = TARGETED.says[state][0]
            state = TARGETED.table[state][kinds[k]]
        state = 0
        for k, kind in enumerate(kinds):
            if kind in (1, 2):
                targeted, negated, reported, directed, announced = GRAMMAR.says[state]
                strong = directed if kind == 1 else announced
                yield self.unit(words[k]) or words[k], (CLASSES[kind], strong, targeted or after[k], negated, reported)
            state = GRAMMAR.table[state][kind]

    def features(self, text: str) -> list[float]:
        """By kind of match, the summed weights of its units."""
        found = self.matches(text)
        return [sum(self.units.get(u, THREAT_WEIGHT) for u in sorted(found[k])) if k in found else 0.0 for k in KINDS]


#: Where a kind's factor starts, and stays if no labelled document shows it.
PRIOR = {
    kind: 1.0 + 0.3 * kind[1] + 0.2 * kind[2] - 0.5 * kind[3] - 0.5 * kind[4] + (0.2 * (kind[1] and kind[2]) if kind[0] == "threat" else 0.0) for kind in KINDS
}


def prior_weights() -> np.ndarray:
    return np.array([PRIOR[k] for k in KINDS])


class Grammar:
    """A lexicon with the weights of its matches."""

    def __init__(self, lexicon: Lexicon, intercept: float, weights: np.ndarray):
        self.lexicon, self.intercept, self.weights = lexicon, intercept, weights

    def __getstate__(self):
        return self.lexicon.units, self.intercept, self.weights

    def __setstate__(self, state):
        self.__init__(Lexicon(state[0]), state[1], state[2])

    def score(self, text: str | None) -> float:
        return float(L.sigmoid(self.intercept + np.dot(self.lexicon.features(text or ""), self.weights)))


def likely(counts: DataFrame, toxic: int, clean: int, units: int) -> DataFrame:
    """The rows of (unit, toxic, clean, neighbours) that ``choose`` can take, by its bounds on precision and gain."""
    rate = (toxic + 0.5) / (toxic + clean + 1)
    seen = F.least("toxic", "neighbours")
    share = seen / (seen + F.col("clean"))
    lost = F.when(F.col("clean") > 0, F.col("clean") * F.ln((1 - share) / (1 - rate))).otherwise(0.0)
    gain = seen * F.ln(share / rate) + lost
    close = 1e-9  # logarithms may differ in their last digit
    return counts.where((seen > 0) & (share >= max(LEAST_PRECISION, rate) - close) & (gain >= math.log(max(units, 1) / CHANCE) - close))


def choose(counts: list[tuple[str, int, int, int]], toxic: int, clean: int, units: int) -> dict[str, float]:
    """Weights of the units that tell toxic documents apart; counts are (unit, toxic, clean, distinct neighbours).

    A unit counts by the toxic documents or its distinct neighbours there, whichever is less, and must beat
    chance among all units. Of units within each other the one that gains most is kept; of equals a word
    before a stem, a longer stem before a shorter one.
    """
    rate = (toxic + 0.5) / (toxic + clean + 1)
    able = []
    for unit, n_toxic, n_clean, neighbours in counts:
        seen = min(n_toxic, neighbours)
        share = seen / (seen + n_clean) if seen else 0.0
        gain = seen * math.log(share / rate) if share else 0.0
        gain += n_clean * math.log((1 - share) / (1 - rate)) if n_clean else 0.0
        if share >= max(LEAST_PRECISION, rate) and gain >= math.log(max(units, 1) / CHANCE):
            able.append((gain, unit, seen, n_clean))
    chosen: dict[str, tuple[float, int]] = {}
    for gain, unit, seen, n_clean in sorted(able, key=lambda x: (-x[0], x[1].endswith("*"), -len(x[1]), x[1])):
        bare = unit.rstrip("*")
        longer = sum(n for u, (_, n) in chosen.items() if u != bare and u.startswith(bare)) if unit.endswith("*") else 0
        if any(bare[:n] + "*" in chosen for n in STEMS if n <= len(bare)) or 1.1 * longer >= seen:
            continue
        weight = math.log((seen + 0.5) / (toxic + 1)) - math.log((n_clean + 0.5) / (clean + 1))
        chosen[unit] = (weight, seen)
    return {u: w for u, (w, _) in chosen.items()}


def _units(text: str) -> dict[str, str]:
    """A text's words, and its words' stems marked by a star, each with the neighbours of its first place."""
    words = WORD.findall(text.lower())
    found: dict[str, str] = {}
    for k, word in enumerate(words):
        if word not in found:
            beside = f"{words[k - 1] if k else ''} {words[k + 1] if k + 1 < len(words) else ''}"
            found[word] = beside
            for n in STEMS:
                if len(word) > n:
                    found.setdefault(word[:n] + "*", beside)
    return found


def fit(docs: DataFrame, labels: DataFrame, bound: int = L.SAMPLE) -> Grammar:
    """Lexicon and weights from at most ``bound`` labelled documents.

    Units are counted by Spark over the sample; only those that beat chance among all units come to the driver.
    """
    sample = files.written(L.labelled(docs, labels, LABEL, bound).select("text", F.col("y").cast("int").alias("y")), "labelled")

    def units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in files.chunks_of(batches, "text", 1 << 18):
            rows = [(u, beside, y) for t, y in zip(batch["text"].to_pylist(), batch["y"].to_pylist()) for u, beside in _units(t).items()]
            if rows:
                kinds = (pa.string(), pa.string(), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["unit", "beside", "y"])

    placed = sample.mapInArrow(units, "unit string, beside string, y int").groupBy("unit", F.xxhash64("beside").alias("beside")).agg(
        F.sum("y").alias("toxic"), F.count("*").alias("n")
    )
    counts = placed.groupBy("unit").agg(
        F.sum("toxic").alias("toxic"), F.sum(F.col("n") - F.col("toxic")).alias("clean"), F.sum((F.col("toxic") > 0).cast("int")).alias("neighbours")
    )
    # a unit of one toxic document cannot beat chance, so it is no trial either
    counts = files.written(counts.where("toxic > 1"), "units")
    ys = {r.y: r.n for r in sample.groupBy("y").agg(F.count("*").alias("n")).collect()}
    toxic, clean, units_n = ys.get(1, 0), ys.get(0, 0), counts.count()
    chosen = choose([(r.unit, r.toxic, r.clean, r.neighbours) for r in likely(counts, toxic, clean, units_n).collect()], toxic, clean, units_n)
    lexicon = Lexicon(chosen)
    blank = Grammar(lexicon, 0.0, prior_weights())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [blank.lexicon.features(t) for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["y"], pa.array(rows, pa.list_(pa.float64()))], names=["y", "x"])

    # most documents match nothing: equal features come as one row with its count
    rows = sample.mapInArrow(count, "y int, x array<double>").groupBy("y", "x").agg(F.count("*").alias("n")).orderBy("y", "x").collect()
    x = np.array([r.x for r in rows]).reshape(len(rows), len(KINDS))
    y = np.array([r.y for r in rows], dtype=float)
    intercept, weights = L.ridge_logistic(x, y, prior_weights(), counts=np.array([r.n for r in rows], dtype=float))
    if not rows:
        intercept = -3.0
    return Grammar(lexicon, intercept, weights)


def scored(docs: DataFrame, grammar: Grammar) -> DataFrame:
    """The rows with one more column, the score: ``score``, or ``fresh(docs, "score")`` where the rows have such a column.

    Null and empty texts match nothing and get the score of such texts. Texts are read whole, however long; every
    row is scored by itself, repeated ones too; an empty table gives none. All columns of ``docs`` stay as they are.
    """
    schema = StructType([*docs.schema.fields]).add(fresh(docs, "score"), "double")
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in files.chunks_of(batches, "text", 1 << 20):
            scores = pa.array([grammar.score(t) for t in batch["text"].to_pylist()], pa.float64())
            yield pa.RecordBatch.from_arrays([*(batch[n] for n in names[:-1]), scores], names=names)

    return docs.mapInArrow(run, schema)


def kept(docs: DataFrame, grammar: Grammar, threshold: float = THRESHOLD) -> DataFrame:
    """The rows that score below ``threshold``, columns unchanged."""
    name = fresh(docs, "score")
    return scored(docs, grammar).where(F.col(name) < threshold).drop(name)

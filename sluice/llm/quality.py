"""Quality scores by a sparse rule ensemble.

Statistics of a text are Spark columns. Shallow trees are grown on a bounded labelled sample; each path from
a root to a node is a rule, a conjunction of bounds on statistics. A lasso logistic fit keeps few of the
rules, and those are compiled back into one Spark column: scoring is a narrow projection without Python.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame

from sluice.functions.rows import fresh, keep_where
from sluice.llm import labels as L

LABEL = "quality"
THRESHOLD = 0.3
TREES = 24
DEPTH = 3
LEAST_ROWS = 20  # of a tree's node, or a hundredth of a small sample
BINS = 32
PENALTY = 5e-4


def with_statistics(docs: DataFrame, text: str = "text", out: str = "_stats") -> DataFrame:
    """The rows with a column ``out``, a struct of doubles. Null text is empty; ratios of nothing are 0.

    Texts are read whole, however long. All other columns stay as they are, whatever their names.
    """
    body, split_words, split_lines = (fresh(docs, n) for n in ("_text", "_words", "_lines"))
    split = docs.withColumn(body, F.coalesce(F.col(text), F.lit(""))).withColumns(
        {
            split_words: F.filter(F.split(body, r"\s+"), lambda w: w != ""),
            split_lines: F.filter(F.split(body, r"\n+"), lambda x: x != ""),
        }
    )

    def count(pattern: str) -> Column:
        return F.regexp_count(body, F.lit(pattern)).cast("double")

    def share(part: Column, whole: Column) -> Column:
        return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))

    chars = F.char_length(body).cast("double")
    words = F.size(split_words).cast("double")
    lines = F.size(split_lines).cast("double")
    stats = {
        "log_words": F.log1p(words),
        "symbols": share(count(r"[^\p{L}\p{N}\s.,;:'\"()-]"), chars),
        "capitals": share(count(r"\p{Lu}"), chars),
        "digits": share(count(r"\p{Nd}"), chars),
        "ends": share(count(r"[.!?](?=\s|$)"), words),
        "word_length": share(chars, words),
        "distinct_words": share(F.size(F.array_distinct(split_words)).cast("double"), words),
        "distinct_lines": share(F.size(F.array_distinct(split_lines)).cast("double"), lines),
        "words_a_line": share(words, lines),
        "short_words": share(count(r"(?<!\S)\S{1,2}(?!\S)"), words),
    }
    return split.withColumn(out, F.struct(*(c.alias(n) for n, c in stats.items()))).drop(body, split_words, split_lines)


STATISTICS = ["log_words", "symbols", "capitals", "digits", "ends", "word_length", "distinct_words", "distinct_lines", "words_a_line", "short_words"]

Rule = tuple[tuple[str, str, float], ...]


@dataclass(frozen=True)
class Ensemble:
    """An intercept and weighted rules; a rule is bounds ("<=" or ">") on statistics that all hold."""

    intercept: float
    rules: tuple[tuple[Rule, float], ...]

    def score(self, stats: str = "_stats") -> Column:
        """The probability of label 1 as a column over a struct of statistics."""
        z = F.lit(self.intercept)
        for rule, weight in self.rules:
            holds = F.lit(True)
            for name, sign, bound in rule:
                value = F.col(f"{stats}.{name}")
                holds = holds & ((value <= bound) if sign == "<=" else (value > bound))
            z = z + F.when(holds, F.lit(weight)).otherwise(F.lit(0.0))
        return 1.0 / (1.0 + F.exp(-z))


def _holds(rule: Rule, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), dtype=bool)
    for name, sign, bound in rule:
        column = x[:, STATISTICS.index(name)]
        out &= (column <= bound) if sign == "<=" else (column > bound)
    return out


def _grow(x, residual, rows, features, edges, depth, least, path, found):
    """Split where the residual's squared sums gain most; every node below the root is a rule."""
    if depth == 0 or len(rows) < 2 * least:
        return
    own, total = residual[rows], residual[rows].sum()
    best = (1e-9, None)
    for f in features:
        place = np.searchsorted(edges[f], x[rows, f], side="left")
        n = np.cumsum(np.bincount(place, minlength=len(edges[f]) + 1))[:-1]
        s = np.cumsum(np.bincount(place, weights=own, minlength=len(edges[f]) + 1))[:-1]
        ok = (n >= least) & (len(rows) - n >= least)
        if not ok.any():
            continue
        gain = np.where(ok, s**2 / np.maximum(n, 1) + (total - s) ** 2 / np.maximum(len(rows) - n, 1) - total**2 / len(rows), -1)
        k = int(gain.argmax())
        if gain[k] > best[0]:
            best = (gain[k], (f, float(edges[f][k])))
    if best[1] is None:
        return
    f, bound = best[1]
    low = x[rows, f] <= bound
    for sign, part in (("<=", rows[low]), (">", rows[~low])):
        rule = (*path, (STATISTICS[f], sign, bound))
        found.append(rule)
        _grow(x, residual, part, features, edges, depth - 1, least, rule, found)


def fit_rules(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, penalty: float = PENALTY) -> Ensemble:
    """Boosted shallow trees on random halves of rows and statistics, then a lasso over all their paths."""
    if len(y) == 0:
        return Ensemble(0.0, ())
    if y.min() == y.max():
        return Ensemble(float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))), ())
    rng = np.random.default_rng(2)
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
    least = max(2, min(LEAST_ROWS, len(y) // 100))
    z = np.full(len(y), np.log(y.mean() / (1 - y.mean())))
    rules: dict[Rule, None] = {}
    for _ in range(trees):
        rows = rng.choice(len(y), max(len(y) // 2, min(len(y), 200)), replace=False)
        features = np.sort(rng.choice(x.shape[1], max(1, 2 * x.shape[1] // 3), replace=False))
        found: list[Rule] = []
        residual = y - L.sigmoid(z)
        _grow(x, residual, rows, features, edges, depth, least, (), found)
        for rule in found:
            rules[rule] = None
        leaves = [r for r in found if not any(len(o) > len(r) and o[: len(r)] == r for o in found)]
        for leaf in leaves:
            at = _holds(leaf, x)
            z[at] += 0.5 * np.clip(residual[at].mean() / max((L.sigmoid(z[at]) * (1 - L.sigmoid(z[at]))).mean(), 1e-3), -4, 4)
    every = list(rules)
    matrix = np.array([_holds(r, x) for r in every], dtype=float).T if every else np.zeros((len(y), 0))
    intercept, weights = L.lasso_logistic(matrix, y.astype(float), penalty)
    return Ensemble(intercept, tuple((r, float(w)) for r, w in zip(every, weights) if w != 0))


def fit(docs: DataFrame, labels: DataFrame, bound: int = L.SAMPLE) -> Ensemble:
    """Rules from at most ``bound`` labelled documents; their statistics, ten numbers each, come to the driver."""
    sample = with_statistics(L.labelled(docs, labels, LABEL, bound)).orderBy("doc_id").select("y", "_stats.*").toPandas()
    return fit_rules(sample[STATISTICS].to_numpy(dtype=float), sample["y"].to_numpy(dtype=int))


def scored(docs: DataFrame, model: Ensemble) -> DataFrame:
    """The rows with one more column, the score: ``score``, or ``fresh(docs, "score")`` where the rows have such a column.

    Null and empty texts are scored by their statistics, all zero. Every row is scored by itself, repeated ones too;
    an empty table gives none. All columns of ``docs`` stay as they are.
    """
    stats = fresh(docs, "_stats")
    return with_statistics(docs, out=stats).withColumn(fresh(docs, "score"), model.score(stats)).drop(stats)


def kept(docs: DataFrame, model: Ensemble, threshold: float = THRESHOLD) -> DataFrame:
    """The rows that score ``threshold`` or more, columns unchanged. The statistics are computed once, not once a rule."""
    name = fresh(docs, "score")
    return keep_where(scored(docs, model), F.col(name) >= threshold).drop(name)

"""Labelled samples and the two logistic fits of the classifiers."""

from __future__ import annotations

import numpy as np
import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame

SAMPLE = 20_000  # bound of the labelled rows that a classifier is fitted on
FOLDS = 5


def held_out(doc_id: Column) -> Column:
    """The rows whose labels no fit may see; a null id is never held out, and has no label either."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(False))


def labelled(docs: DataFrame, labels: DataFrame, label: str, bound: int = SAMPLE) -> DataFrame:
    """(doc_id, text, y) of at most ``bound`` labelled ids outside the held-out fold, chosen by a hash of the id.

    Ids with both labels, null labels and null ids are left out. The chosen ids are at most ``bound`` rows,
    so they are broadcast, and the documents are read without a shuffle.
    """
    one = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy(F.col("doc_id").alias("labelled_id"))
        .agg(F.min(F.col(label).cast("int")).alias("y"), F.max(F.col(label).cast("int")).alias("y_max"))
        .where("y = y_max AND y IN (0, 1)")
        .select("labelled_id", "y")
        .orderBy(F.xxhash64("labelled_id"), "labelled_id")
        .limit(bound)
    )
    source = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return source.join(F.broadcast(one), F.col("doc_id") == F.col("labelled_id")).select("doc_id", "text", "y")


def sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -35, 35)))


def ridge_logistic(x: np.ndarray, y: np.ndarray, prior: np.ndarray, strength: float = 1.0, rounds: int = 50, counts: np.ndarray | None = None) -> tuple[float, np.ndarray]:
    """Intercept and weights by Newton steps; weights are drawn to ``prior``, the intercept to the base rate."""
    n = np.ones(len(y)) if counts is None else counts
    base = float(np.log((n @ y + 0.5) / (n @ (1 - y) + 0.5))) if len(y) else 0.0
    full = np.hstack([np.ones((len(x), 1)), x])
    centre = np.concatenate([[base], prior])
    pull = np.concatenate([[1e-3], np.full(x.shape[1], strength)])
    w = centre.copy()
    for _ in range(rounds):
        p = sigmoid(full @ w)
        gradient = full.T @ (n * (y - p)) - pull * (w - centre)
        step = np.linalg.solve((full * (n * p * (1 - p))[:, None]).T @ full + np.diag(pull + 1e-9), gradient)
        size = np.abs(step).max()
        w += step / max(1.0, size / 4.0)
        if size < 1e-8:
            break
    return float(w[0]), w[1:]


def lasso_logistic(x: np.ndarray, y: np.ndarray, penalty: float, rounds: int = 800) -> tuple[float, np.ndarray]:
    """Intercept and sparse weights by accelerated proximal gradient; mean loss plus penalty times the weights' sizes."""
    n, m = x.shape
    base = float(np.log((y.sum() + 0.5) / (n - y.sum() + 0.5)))
    if not m:
        return base, np.zeros(0)
    step = 4.0 / (np.linalg.norm(np.hstack([np.ones((n, 1)), x]), 2) ** 2 / n)
    w, b = np.zeros(m), base
    v, c, t = w, b, 1.0
    for _ in range(rounds):
        gap = (sigmoid(x @ v + c) - y) / n
        moved = v - step * (x.T @ gap)
        new_w = np.sign(moved) * np.maximum(np.abs(moved) - step * penalty, 0)
        new_b = c - step * gap.sum()
        new_t = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, c = new_w + (t - 1) / new_t * (new_w - w), new_b + (t - 1) / new_t * (new_b - b)
        done = max(np.abs(new_w - w).max(), abs(new_b - b)) < 1e-7
        w, b, t = new_w, new_b, new_t
        if done:
            break
    return float(b), w

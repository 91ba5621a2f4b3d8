import math

import pytest

from pyspark.sql import functions as F

from sluice.operators import drift as D
from sluice.operators import quality as Q


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_nulls_and_clean(spark):
    df = frame(spark, [(1.0, 1), (None, 2), (float("nan"), 3), (None, 4)], "a double, b int")
    assert {r["column"]: r["null_fraction"] for r in Q.null_fractions(df).collect()} == {"a": 0.75, "b": 0.0}
    gate = Q.check_nulls(df, 0.5).first()
    assert (gate["value"], gate["passed"]) == (0.75, False)
    assert [r["b"] for r in Q.basic_clean(df).collect()] == [1]


@pytest.mark.parametrize("labels,limit,passed", [([0, 0, 1, 1], 0.9, True), ([1, 1, 1, 1, 0], 0.8, True), ([1, 1, 1, 1, 0], 0.79, False), ([1, None, None], 0.9, False)])
def test_label_share(spark, labels, limit, passed):
    df = frame(spark, [(x,) for x in labels], "y int")
    assert Q.check_label_distribution(df, "y", limit).first()["passed"] == passed


def test_gate_raises_for_the_first_failed_check(spark):
    good = frame(spark, [(1, 0), (2, 1), (3, 0), (4, 1)], "f int, label int")
    Q.enforce(Q.training_gate(good, "label"))
    with pytest.raises(ValueError, match="Label imbalance"):
        Q.enforce(Q.training_gate(good, "label", max_share=0.4))
    assert Q.label_shares(good, "label").count() == 2


def test_drift(spark):
    rows = [(0, float(i)) for i in range(100)] + [(1, float(i)) for i in range(100)] + [(2, 95.0)] * 50 + [(2, -1.0)] * 50
    scores = {r["period"]: r["psi"] for r in Q.numeric_drift(frame(spark, rows, "p int, v double"), "p", "v", 0).collect()}
    assert scores[0] == 0 and scores[1] == 0 and scores[2] > 1
    alerts = Q.drift_alerts(Q.drift(frame(spark, [(0, "a"), (0, "b"), (1, "a"), (1, "a")], "p int, k string"), "p", "k", ["a", "b"], 0))
    row = {r["period"]: r for r in alerts.collect()}[1]
    expected = (1 - 0.5) * math.log(2) + (1e-4 - 0.5) * math.log(1e-4 / 0.5)
    assert row["psi"] == pytest.approx(expected) and row["alert"]


def test_baseline(spark):
    rows = [(i, [float(i % 2), float(i % 5)], i % 2) for i in range(400)]
    df = frame(spark, rows, "k bigint, x array<double>, y int")
    train, test = Q.hash_split(df, "k")
    assert train.count() + test.count() == 400 and 280 < train.count() < 360
    _, score = Q.train_baseline(df, "k", "x", "y")
    assert score.first()["accuracy"] == 1.0
    features, label = Q.split_features_labels(df, "y")
    assert (features.columns, label.columns) == (["k", "x"], ["y"])


def drifted(spark, rows, **more):
    df = spark.createDataFrame(rows, "day int, v double, k string, _bins int")
    return {(r.column, r.period): r for r in D.drift_columns(df, "day", 0, ["v", "_bins"], ["k"], **more).collect()}


def test_drift_without_known_bins(spark):
    base = [(0, float(i), "abc"[i % 3], 1) for i in range(300)]
    same = [(1, float(i) + 0.5, "abc"[i % 3], 1) for i in range(0, 300, 2)]
    moved = [(2, 1000.0 + i, "d", 1) for i in range(100)] + [(2, None, None, 2), (2, float("nan"), "a", None)]
    got = drifted(spark, base + same + moved)
    assert {k for k in got} == {(c, p) for c in ("v", "k", "_bins") for p in (0, 1, 2)}
    assert all(got[c, 0].psi == 0 and not got[c, 0].alert and got[c, 0].n == 300 for c in ("v", "k", "_bins"))
    assert got["v", 1].psi < 0.05 and not got["v", 1].alert and got["_bins", 1].psi == 0
    assert got["v", 2].alert and got["k", 2].alert and got["v", 2].n == 102 and got["_bins", 2].psi > 0
    # by hand: a third each, against one in 102, none, none, one missing and a hundred others
    shares = {"a": (1 / 3, 1 / 102), "b": (1 / 3, 1e-4), "c": (1 / 3, 1e-4), "null": (1e-4, 1 / 102), "other": (1e-4, 100 / 102)}
    assert got["k", 2].psi == pytest.approx(sum((h - b) * math.log(h / b) for b, h in shares.values()))


def test_drift_without_a_baseline_or_rows(spark):
    rows = [(1, 1.0, "a", 1), (2, 9.0, "b", 2)]
    assert all(r.psi is not None for r in drifted(spark, rows).values())
    assert drifted(spark, []) == {}


def test_sketches_unite(spark):
    """Sketches of days make those of weeks, with the same bins as the rows."""
    df = spark.createDataFrame([(i % 14, float(i * 7919 % 1000), f"k{i % 5}") for i in range(1400)], "day int, v double, k string")
    days = D.column_sketches(df, "day", ["v"], ["k"])
    week = (F.col("period") / 7).cast("int")
    weeks = D.united_sketches(days, week)
    whole = D.column_sketches(df.withColumn("week", (F.col("day") / 7).cast("int")), "week", ["v"], ["k"])
    bins = [{r.column: (r.edges, r.items and set(r.items)) for r in D.baseline_bins(s, 0).collect()} for s in (weeks, whole)]
    assert bins[0] == bins[1] and len(bins[0]["v"][0]) == 9 and bins[0]["k"][1] == {f"k{i}" for i in range(5)}
    values = sorted(float(i * 7919 % 1000) for i in range(1400) if i % 14 < 7)
    assert bins[0]["v"][0] == [values[math.ceil(k / 10 * len(values)) - 1] for k in range(1, 10)]
    scored = D.drift_columns(df, "day", 0, ["v"], ["k"], sketches=days)
    assert {r.period for r in scored.collect()} == set(range(14))
    assert D.baseline_bins(D.column_sketches(df, "day", ["v"], []), 3).count() == 1

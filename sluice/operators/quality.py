"""Training-data gate, drift and the baseline model."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAX_NULL_FRACTION = 0.3
MAX_LABEL_FRACTION = 0.9
EMPTY_SHARE = 1e-4


def basic_clean(df: DataFrame) -> DataFrame:
    """Rows without any NULL or NaN."""
    return df.na.drop()


def run_pipeline(frame: DataFrame, clean: Callable[[DataFrame], DataFrame] = basic_clean) -> DataFrame:
    """A frame as read (``readers.read_frame``, ``readers.csv_rows``), cleaned."""
    return clean(frame)


def _is_null(df: DataFrame, name: str) -> Column:
    test = F.col(name).isNull()
    return test | F.isnan(name) if dict(df.dtypes)[name] in ("double", "float") else test


def null_fractions(df: DataFrame) -> DataFrame:
    """``column, null_fraction`` of every column, from one aggregate over the rows."""
    one = df.agg(*[F.avg(_is_null(df, name).cast("int")).alias(name) for name in df.columns])
    pairs = [F.struct(F.lit(name).alias("column"), F.col(name).alias("null_fraction")) for name in df.columns]
    return one.select(F.inline(F.array(*pairs)))


def label_shares(df: DataFrame, label: str) -> DataFrame:
    """``label, n, share`` of the labels that are not NULL. The total is summed over the counts, not the rows."""
    counts = df.where(F.col(label).isNotNull()).groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("share", F.try_divide(F.col("n"), total))


def check_nulls(df: DataFrame, limit: float = MAX_NULL_FRACTION) -> DataFrame:
    worst = null_fractions(df).agg(F.max("null_fraction").alias("value"))
    return _verdict(worst, "null_fraction", limit)


def check_label_distribution(df: DataFrame, label: str, limit: float = MAX_LABEL_FRACTION) -> DataFrame:
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    worst = counts.agg(F.try_divide(F.max("n"), F.sum("n")).alias("value"))
    return _verdict(worst, "label_imbalance", limit)


def _verdict(worst: DataFrame, name: str, limit: float) -> DataFrame:
    """One row ``check, value, threshold, passed``; only a value above the threshold fails."""
    return worst.select(
        F.lit(name).alias("check"), "value", F.lit(limit).alias("threshold"),
        F.coalesce(F.col("value") <= limit, F.lit(True)).alias("passed"),
    )


def training_gate(
    df: DataFrame, label: str, max_null: float = MAX_NULL_FRACTION, max_share: float = MAX_LABEL_FRACTION
) -> DataFrame:
    return check_nulls(df, max_null).unionByName(check_label_distribution(df, label, max_share))


def enforce(gate: DataFrame) -> None:
    """Raise for the first failed check of a gate, which has one row per check."""
    for row in gate.where(~F.col("passed")).limit(1).collect():
        what = {
            "null_fraction": "High null fraction detected in at least one column",
            "label_imbalance": "Label imbalance detected",
        }[row["check"]]
        raise ValueError(f"{what}: {row['value']:.2f} > {row['threshold']}")


def binned(value: Column, low: Column, high: Column, bins: int) -> Column:
    """Bin number 1..bins between two edges, 0 below and bins + 1 from the upper edge on."""
    inside = F.floor((value - low) / (high - low) * bins) + 1
    return F.when(value < low, 0).when(value >= high, bins + 1).otherwise(inside).cast("int")


def drift(df: DataFrame, period: str, bin_column: str, bins: list, baseline) -> DataFrame:
    """``period, n, psi``: population stability of each period against the baseline period.

    All bins of a period are counted side by side in one aggregate, so nothing is joined bin by
    bin. Rows in none of the bins, null among them, are one last bin: a value that the baseline
    lacks is drift. An empty bin reads as a small share.
    """
    counted = df.groupBy(F.col(period).alias("period")).agg(
        F.array(
            *[F.count_if(F.col(bin_column) == b) for b in bins],
            F.count_if(~F.coalesce(F.col(bin_column).isin(bins), F.lit(False))),
        ).alias("_counts")
    )
    # one row per period, so all of them are few
    base = F.max(F.when(F.col("period") == baseline, F.col("_counts"))).over(Window.partitionBy())

    def share(counts: Column) -> Column:
        total = F.aggregate(counts, F.lit(0).cast("bigint"), lambda a, c: a + c)
        return F.transform(counts, lambda c: F.greatest(F.try_divide(c, total), F.lit(EMPTY_SHARE)))

    both = counted.withColumn("_base", base)
    shared = both.select("period", F.col("_counts"), share(F.col("_counts")).alias("_p"), share(F.col("_base")).alias("_q"))
    terms = F.zip_with("_p", "_q", lambda p, q: (p - q) * F.ln(p / q))
    return shared.select(
        "period", F.aggregate("_counts", F.lit(0).cast("bigint"), lambda a, c: a + c).alias("n"),
        F.aggregate(terms, F.lit(0.0), lambda a, t: a + t).alias("psi"),
    )


def drift_alerts(scores: DataFrame, threshold: float = 0.2) -> DataFrame:
    return scores.withColumn("alert", F.col("psi") > threshold)


def numeric_drift(df: DataFrame, period: str, value: str, baseline, bins: int = 10) -> DataFrame:
    """Drift of a number over equal bins between the smallest and largest baseline value."""
    of_base = df.where(F.col(period) == baseline)
    edges = of_base.agg(F.struct(F.min(value).alias("low"), F.max(value).alias("high"))).scalar()
    edged = df.withColumn("_edges", edges)
    placed = edged.withColumn("_bin", binned(F.col(value), F.col("_edges.low"), F.col("_edges.high"), bins))
    return drift(placed, period, "_bin", list(range(bins + 2)), baseline)


def hash_split(df: DataFrame, key: str, percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by a hash of the key: stable across runs, retries and row order."""
    return df.where(in_train(F.col(key), percent)), df.where(~in_train(F.col(key), percent))


def in_train(key: Column, percent: int = 80) -> Column:
    """Side of a row by the first eight hex digits of its key's MD5; a NULL key counts as empty text."""
    digits = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 8)
    return F.conv(digits, 16, 10).cast("bigint") % 100 < percent


def split_features_labels(df: DataFrame, label: str) -> tuple[DataFrame, DataFrame]:
    return df.drop(label), df.select(label)


def train_baseline(df: DataFrame, key: str, features: str, label: str, max_iter: int = 200):
    """Logistic baseline on an array column and labels 0 and 1.

    Returns the model and a frame of one row: rows of both sides, accuracy on the test rows and the
    share of their larger class, which a useful model exceeds.

    The penalty equals an unscaled L2 term of weight one over the number of rows.
    """
    vectors = df.select(key, array_to_vector(features).alias("features"), F.col(label).cast("double").alias("label"))
    train, test = hash_split(vectors, key)
    n_train = train.count()
    model = LogisticRegression(
        maxIter=max_iter, regParam=1.0 / max(n_train, 1), elasticNetParam=0.0, standardization=False
    ).fit(train)
    ones = F.avg("label")
    scores = model.transform(test).agg(
        F.lit(n_train).cast("bigint").alias("n_train"), F.count(F.lit(1)).alias("n_test"),
        F.avg((F.col("prediction") == F.col("label")).cast("int")).alias("accuracy"),
        F.greatest(ones, 1 - ones).alias("larger_class"),
    )
    return model, scores

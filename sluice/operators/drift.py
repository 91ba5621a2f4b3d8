"""Drift of many columns at once, over bins that the baseline itself gives.

A first pass sketches every column by period: quantile sketches of numbers, frequent-item sketches of texts. Sketches
are small, can be kept and united (days to weeks) without the rows. The baseline's sketch gives the bins: its quantiles, or its most
frequent items. A second pass counts all columns' rows in these bins, exactly, and compares periods by population stability.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.rows import fresh
from sluice.operators.quality import EMPTY_SHARE, drift_alerts

QUANTILE_K = 4096  # a period of at most so many values is sketched exactly; beyond it ranks are off by about 0.05 %
ITEMS_KEPT = 4096  # items that a sketch of texts follows
BINS = 10
TOP = 20
THRESHOLD = 0.2


def _number(name: str) -> Column:
    """A value to sketch: NaN is as missing as NULL."""
    value = F.col(name).cast("double")
    return F.when(~F.isnan(value), value)


def _top_k(function: str, *arguments) -> Column:
    return F.call_function(function, *arguments)


def column_sketches(df: DataFrame, period: str, numbers: list[str], texts: list[str]) -> DataFrame:
    """``period, column, quantiles, items``: one sketch per period and column, of all columns in one pass.

    NULL and NaN are left out. A task keeps one sketch per period and column, so rows are not shuffled.
    """
    made = [F.kll_sketch_agg_double(_number(c), F.lit(QUANTILE_K)).alias(f"q{k}") for k, c in enumerate(numbers)]
    made += [_top_k("approx_top_k_accumulate", F.col(c).cast("string"), F.lit(ITEMS_KEPT)).alias(f"t{k}") for k, c in enumerate(texts)]
    one = df.groupBy(F.col(period).alias("period")).agg(*made)
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"q{k}").alias("quantiles"), F.lit(None).alias("items")) for k, c in enumerate(numbers)]
    rows += [F.struct(F.lit(c).alias("column"), F.lit(None).cast("binary").alias("quantiles"), F.col(f"t{k}").alias("items")) for k, c in enumerate(texts)]
    if not texts:
        return one.select("period", F.inline(F.array(*rows))).select("period", "column", "quantiles")
    return one.select("period", F.inline(F.array(*rows)))


def united_sketches(sketches: DataFrame, period: Column) -> DataFrame:
    """Sketches of longer periods from those of shorter ones; ``period`` is computed from theirs."""
    def united(own: str, made: Column) -> DataFrame:
        return sketches.where(F.col(own).isNotNull()).groupBy(period.alias("period"), "column").agg(made.alias(own))

    numbers = united("quantiles", F.kll_merge_agg_double("quantiles", F.lit(QUANTILE_K)))
    if "items" not in sketches.columns:
        return numbers
    return numbers.unionByName(united("items", _top_k("approx_top_k_combine", F.col("items"), F.lit(ITEMS_KEPT))), allowMissingColumns=True)


def baseline_bins(sketches: DataFrame, baseline, bins: int = BINS, top: int = TOP) -> DataFrame:
    """``column, edges, items`` of the baseline period: inner edges ascending, or items by falling count.

    A number's bin holds what is above one edge and not above the next. At most one row per column.
    """
    ranks = F.array(*[F.lit(k / bins) for k in range(1, bins)])
    n = F.kll_sketch_get_n_double("quantiles")
    edges = F.when(n > 0, F.array_sort(F.array_distinct(F.kll_sketch_get_quantile_double("quantiles", ranks))))
    items = F.lit(None).cast("array<string>")
    if "items" in sketches.columns:
        found = F.when(F.col("items").isNotNull(), _top_k("approx_top_k_estimate", F.col("items"), F.lit(top)))
        items = F.transform(found, lambda x: x["item"])
    return sketches.where(F.col("period").eqNullSafe(F.lit(baseline))).select("column", edges.alias("edges"), items.alias("items"))


def bin_counts(df: DataFrame, period: str, numbers: list[str], texts: list[str], bins: DataFrame) -> DataFrame:
    """``period, column, bin, n``: rows of every period in the bins of every column, in one pass over the rows.

    Bin 0 holds missing values. Numbers are in bins 1 to edges + 1; texts have an item's place, and items + 1 for all
    others. ``bins`` has one row per column and is brought to every row as one value.
    """
    held = bins.agg(F.map_from_entries(F.collect_list(F.struct("column", F.struct("edges", "items")))).alias("bins")).scalar()
    given = [F.col(c) for c in dict.fromkeys([*numbers, *texts])]
    named = df.select(F.col(period).alias(fresh(df, "_period")), *given)
    period, at = named.columns[0], fresh(named, "_bins")
    placed = named.withColumn(at, held)

    def own(name: str) -> Column:
        return F.try_element_at(at, F.lit(name))

    def number_bin(name: str) -> Column:
        below = F.size(F.filter(own(name)["edges"], lambda e: e < _number(name)))
        return F.when(_number(name).isNotNull(), F.coalesce(F.greatest(below, F.lit(0)), F.lit(0)) + 1).otherwise(0)

    def text_bin(name: str) -> Column:
        value, items = F.col(name).cast("string"), own(name)["items"]
        place = F.coalesce(F.array_position(items, value), F.lit(0))
        return F.when(value.isNull(), 0).when(place > 0, place).otherwise(F.greatest(F.coalesce(F.size(items), F.lit(0)), F.lit(0)) + 1)

    cells = [F.struct(F.lit(c).alias("column"), number_bin(c).cast("int").alias("bin")) for c in numbers]
    cells += [F.struct(F.lit(c).alias("column"), text_bin(c).cast("int").alias("bin")) for c in texts]
    return placed.select(F.col(period).alias("period"), F.inline(F.array(*cells))).groupBy("period", "column", "bin").agg(F.count("*").alias("n"))


def stability(counts: DataFrame, baseline) -> DataFrame:
    """``column, period, n, psi`` from counts by bin. A bin that a period lacks reads as a small share.

    Only counts are joined: periods times columns times bins, however many rows were counted.
    """
    totals = counts.groupBy("column", "period").agg(F.sum("n").alias("total"))
    base = counts.where(F.col("period").eqNullSafe(F.lit(baseline))).select("column", "bin", F.col("n").alias("base_n"))
    cells = counts.select("column", "bin").distinct().join(totals, "column").join(base, ["column", "bin"], "left")
    here = counts.select(F.col("column").alias("c"), F.col("period").alias("p"), F.col("bin").alias("b"), "n")
    met = cells.join(here, (F.col("column") == F.col("c")) & F.col("period").eqNullSafe(F.col("p")) & (F.col("bin") == F.col("b")), "left")
    of_base = totals.where(F.col("period").eqNullSafe(F.lit(baseline))).select("column", F.col("total").alias("base_total"))
    shares = met.join(of_base, "column", "left").select(
        "column", "period", "total",
        F.greatest(F.coalesce(F.try_divide("n", "total"), F.lit(0.0)), F.lit(EMPTY_SHARE)).alias("here"),
        F.greatest(F.coalesce(F.try_divide("base_n", "base_total"), F.lit(0.0)), F.lit(EMPTY_SHARE)).alias("base"),
    )
    return shares.groupBy("column", "period").agg(
        F.max("total").alias("n"), F.sum((F.col("here") - F.col("base")) * F.ln(F.col("here") / F.col("base"))).alias("psi")
    )


def drift_columns(
    df: DataFrame, period: str, baseline, numbers: list[str], texts: list[str], *, bins: int = BINS, top: int = TOP, threshold: float = THRESHOLD,
    sketches: DataFrame | None = None,
) -> DataFrame:
    """``column, period, n, psi, alert`` of every column and period against the baseline.

    ``sketches`` of the baseline that were kept save the first pass. A column without baseline rows has no bins of its
    own, so all its values are alike there. NULL and NaN are a bin: if values go missing, that is drift.
    """
    known = column_sketches(df.where(F.col(period).eqNullSafe(F.lit(baseline))), period, numbers, texts) if sketches is None else sketches
    counts = bin_counts(df, period, numbers, texts, baseline_bins(known, baseline, bins, top))
    return drift_alerts(stability(counts, baseline), threshold)

"""Dropping rows by a computed column without computing it twice.

Catalyst moves a filter below the projection that builds its column, so a plain filter on the
outcome of costly expressions runs them once to test and once more for the output. Here the
outcome goes through an outer explode, which filters stay above.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def explode_found(df: DataFrame, *keys: str, array: Column | str, alias: str) -> DataFrame:
    """One row per array element that is not NULL, none for empty arrays."""
    return df.select(*keys, F.explode_outer(array).alias(alias)).where(F.col(alias).isNotNull())


def keep_where(df: DataFrame, condition: Column) -> DataFrame:
    """Rows whose condition, made of costly columns, is true."""
    kept = fresh(df, "_kept")
    held = F.when(condition, F.array(F.lit(True)))
    return df.select("*", F.explode_outer(held).alias(kept)).where(F.col(kept).isNotNull()).drop(kept)


def fresh(df: DataFrame, name: str) -> str:
    """The name, with underscores in front until no column has it; letter case does not tell names apart."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def first_by(rows: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The first row of each key. Every task keeps one row per key before the shuffle, so no key gathers its rows."""
    place = fresh(rows, "_place")
    ranked = rows.withColumn(place, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col(place) == 1).drop(place)

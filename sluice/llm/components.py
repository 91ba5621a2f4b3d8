"""Connected components of a table of links, by repeated least labels and label jumps."""

from __future__ import annotations

import pyspark.sql.functions as F
from pyspark.sql import DataFrame

from sluice.llm import files


def components(links: DataFrame) -> DataFrame:
    """(id, label): the least id reachable over links (a, b), for every id that has a link.

    Each round takes the least label among a node and its neighbours, then the label of that label, so
    paths shrink by doubling. Rounds are written tables; only a count of changes comes to the driver.
    Links of one hub are pre-aggregated before the shuffle.
    """
    both = files.written(
        links.where("a <> b").select("a", "b").union(links.where("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
        "links",
    )
    labels = files.written(both.groupBy(F.col("a").alias("id")).agg(F.least(F.col("id"), F.min("b")).alias("label")), "labels")
    while True:
        near = both.join(labels, both.b == labels.id).groupBy(F.col("a").alias("id")).agg(F.min("label").alias("near"))
        least = labels.join(near, "id", "left").select("id", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        up = labels.select(F.col("id").alias("label"), F.col("label").alias("above"))
        step = files.written(
            least.join(up, "label", "left").select("id", "old", F.least("label", F.coalesce("above", "label")).alias("label")), "labels"
        )
        labels = step.select("id", "label")
        if step.where("old <> label").isEmpty():
            return labels

"""The training-data pipeline over ``documents``: five stages, each on all that the one before it kept.

Every stage but the last returns the columns of its input unchanged, whatever further columns there are and whatever
their names. Null text is judged as empty text, texts are read whole however long, rows with a null doc_id and
repeated rows are judged each (near duplicates: one row of a repeated id stays, rows without id all stay), and an empty
table gives an empty table. tests/llm/test_pipeline.py holds every stage against a plain version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sluice.llm import decontaminate, files, minmax, packing, quality, toxicity


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity grammar does not reject."""
    return toxicity.kept(docs, toxicity.fit(docs, _table(spark, sf_dir, "labels")))


def low_quality_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules do not reject."""
    return quality.kept(docs, quality.fit(docs, _table(spark, sf_dir, "labels")))


def near_duplicates_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return minmax.deduplicate(docs)


def benchmark_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return decontaminate.clean(docs, _table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All that is left, as pieces of token sequences."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", toxic_out),
    ("quality", low_quality_out),
    ("near_duplicates", near_duplicates_out),
    ("decontamination", benchmark_out),
    ("packing", packed),
]
ORACLE_SQL = None  # fitted classifiers, near-duplicate classes and token ids have no SQL; tests use plain versions


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = files.written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

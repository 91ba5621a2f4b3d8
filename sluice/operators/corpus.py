"""Documents out of tolerant JSON records: text choice, id and metadata."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.rows import explode_found
from sluice.functions.patterns import SPACE_CHARS

EMPTY_JSON = ["null", "false", '""', "0", "0.0", "-0.0", "[]", "{}"]


TEXT_FIELDS = ["text", "content", "body"]
PAIRED_FIELDS = [("question", "prompt"), ("answer", "response")]


def _filled(value: Column) -> Column:
    """Whether a JSON value is other than null, false, zero or empty."""
    return F.coalesce(~F.to_json(value).isin(*EMPTY_JSON), F.lit(False))


def _strip(text: Column) -> Column:
    return F.nullif(F.trim(text, F.lit(SPACE_CHARS)), F.lit(""))


def with_record_text(raw: DataFrame, body: str = "body", out: str = "text") -> DataFrame:
    """Append the usable text of each record, or NULL: a single text field, else question and answer.

    Only JSON strings count as text. A filled question that is no string still hides the prompt,
    and likewise answer and response. The steps are projections of their own because each value is
    used more than once in the next.
    """
    pairs = [name for pair in PAIRED_FIELDS for name in pair]
    names = TEXT_FIELDS + pairs
    parts = raw.withColumns({f"_v_{n}": F.try_variant_get(body, f"$.{n}", "variant") for n in names})
    texts = parts.withColumns(
        {f"_t_{n}": F.when(F.schema_of_variant(f"_v_{n}") == "STRING", F.col(f"_v_{n}").cast("string")) for n in names}
    )
    chosen = texts.withColumns(
        {f"_s_{n}": _strip(F.col(f"_t_{n}")) for n in TEXT_FIELDS}
        | {
            f"_p_{first}": F.when(_filled(F.col(f"_v_{first}")), F.col(f"_t_{first}")).otherwise(F.col(f"_t_{second}"))
            for first, second in PAIRED_FIELDS
        }
    )
    pieces = [F.when(_strip(F.col(f"_p_{first}")).isNotNull(), F.col(f"_p_{first}")) for first, _ in PAIRED_FIELDS]
    joined = F.nullif(F.concat_ws("\n\n", *pieces), F.lit(""))
    picked = F.coalesce(*[F.col(f"_s_{n}") for n in TEXT_FIELDS], joined)
    return chosen.select(*raw.columns, picked.alias(out))


def usable_documents(raw: DataFrame, *keep: str, key: str = "s3_key", body: str = "body") -> DataFrame:
    """``doc_id, text, metadata`` of the records that hold usable text.

    ``body`` is VARIANT, NULL where the file was not JSON. The file key stands in for a missing id
    and is added to the metadata unless the record brings its own.
    """
    record = F.col(body)
    known = raw.select(
        *keep, body, F.col(key).alias("_key"),
        F.try_variant_get(record, "$.id", "variant").alias("_id"),
        F.coalesce(
            F.try_variant_get(record, "$.metadata", "map<string,string>"),
            F.create_map().cast("map<string,string>"),
        ).alias("_meta"),
    )
    read = with_record_text(known, body, "_text")
    with_key = F.when(F.map_contains_key("_meta", "s3_key"), F.col("_meta")).otherwise(
        F.map_concat("_meta", F.create_map(F.lit("s3_key"), F.col("_key")))
    )
    kept = explode_found(read, *keep, "_key", "_id", "_meta", array=F.array("_text"), alias="text")
    return kept.select(
        *keep,
        F.when(_filled(F.col("_id")), F.col("_id").cast("string")).otherwise(F.col("_key")).alias("doc_id"),
        "text", with_key.alias("metadata"),
    )


def with_embeddings(
    docs: DataFrame, embed: Callable[[list[str]], list[list[float]]], *, text: str = "text", out: str = "values",
    batch: int = 32,
) -> DataFrame:
    """Append vectors from the caller's embedding function, called on batches of texts in the tasks."""

    @F.pandas_udf("array<float>")
    def vectors(texts: pd.Series) -> pd.Series:
        listed = texts.tolist()
        return pd.Series([v for i in range(0, len(listed), batch) for v in embed(listed[i : i + batch])])

    return docs.withColumn(out, vectors(text))


def vector_rows(docs: DataFrame, namespace: str, seq: Column) -> DataFrame:
    """Embedded documents in the columns of a vector table; ``seq`` orders writes of the same id."""
    return docs.select(
        F.lit(namespace).alias("namespace"), F.col("doc_id").alias("id"), "values", "metadata", seq.alias("seq")
    )

"""Readers: JSON corpora, JSON-line logs, single artifacts, CSV frames, flow and catalog files."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.patterns import SPACE_CHARS
from sluice.functions.rows import keep_where
from sluice.operators.evidence import CONTROL_SCHEMA, PART_BYTES, control_parts
from sluice.operators.moves import FLOW_SCHEMA
from sluice.plans import fixed_values as V
from sluice.sources.local_files import binary_files, large_folder
from sluice.sources.paths import below
from sluice.sources.staging import replace_partitions, stored

DEFAULT_PREFIXES = "clean/,sensitive/"


def prefix_list(text: str = DEFAULT_PREFIXES) -> list[str]:
    return [part.strip() for part in text.split(",") if part.strip()]


def _existing(spark: SparkSession, path: str, kind: str = "text", **options) -> DataFrame | None:
    """Whole files, as ``value`` (text) or as ``content`` (binaryFile); None if there is no such path."""
    try:
        return spark.read.format(kind).options(**({"wholetext": True} if kind == "text" else {}), **options).load(path)
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_corpus(spark: SparkSession, root: str, prefixes: list[str] | None = None, digests: bool = False) -> DataFrame:
    """``prefix, s3_key, body`` of every ``*.json`` file under the prefixes, with ``digests`` also ``digest`` (SHA-256).

    ``body`` is NULL for files that are not JSON. A prefix with no files gives no rows. All files
    are read, however many a listing page would hold. They are read as binary files: the text reader copies Spark's
    whole configuration for each file, which takes longer than the reading. Spark's readers keep every file on the
    driver, so those of a large local or mounted folder are listed and read by tasks (``local_files``).
    """
    more = [F.sha2("content", 256).alias("digest")] if digests else []
    base = root.rstrip("/")
    found = None
    for prefix in prefix_list() if prefixes is None else prefixes:
        if folder := large_folder(spark, f"{base}/{prefix}"):
            files, name = binary_files(spark, folder, ".json"), F.col("below")
        else:
            files = _existing(spark, f"{base}/{prefix}", "binaryFile", recursiveFileLookup=True, pathGlobFilter="*.json")
            name = below(F.col("_metadata.file_path"), f"{base}/{prefix}")
        if files is None:
            continue
        key = F.concat(F.lit(prefix), name)
        rows = files.select(F.lit(prefix).alias("prefix"), key.alias("s3_key"), F.try_parse_json(F.col("content").cast("string")).alias("body"), *more)
        found = rows if found is None else found.unionByName(rows)
    if found is None:
        return spark.createDataFrame([], "prefix string, s3_key string, body variant" + (", digest string" if digests else ""))
    return found


MANIFEST = "s3_key string, digest string"


def corpus_changes(corpus: DataFrame, manifest: DataFrame) -> DataFrame:
    """The rows of a corpus (``s3_key, digest`` and more) that the manifest lacks or has with another digest, and what is gone.

    ``change`` is ``new``, ``changed`` or ``gone``; a vanished document is a row with its key alone, so that whatever
    was made of it can be taken out. Documents with the same digest give no row and go no further.
    """
    known = manifest.select(F.col("s3_key").alias("_key"), F.col("digest").alias("_digest"))
    met = corpus.join(known, F.col("s3_key") == F.col("_key"), "full_outer")
    change = (
        F.when(F.col("s3_key").isNull(), "gone").when(F.col("_key").isNull(), "new").when(~F.col("digest").eqNullSafe(F.col("_digest")), "changed")
    )
    rest = [c for c in corpus.columns if c != "s3_key"]
    named = met.select(F.coalesce("s3_key", "_key").alias("s3_key"), *rest, change.alias("change"))
    return named.where(F.col("change").isNotNull())


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """``s3_key, digest`` of the last run that was recorded at ``path``; no rows before the first."""
    runs = stored(spark, path, f"{MANIFEST}, run bigint")
    return runs.where(F.col("run") == runs.agg(F.max("run")).scalar()).select("s3_key", "digest")


def record_manifest(corpus: DataFrame, path: str, run: int) -> None:
    """Record the state of a corpus as that of ``run``, after its changes have been taken on.

    Until then the run before stays the last one, so a sync that fails is done again. A run recorded twice replaces itself.
    """
    replace_partitions(corpus.select("s3_key", "digest").withColumn("run", F.lit(run).cast("long")), path, "run")


def parsed_lines(lines: DataFrame, column: str = "value", out: str = "record") -> DataFrame:
    """JSON lines as VARIANT; blank and broken lines are skipped. Fits batch and stream sources."""
    cut = F.trim(F.col(column), F.lit(SPACE_CHARS))
    parsed = lines.withColumn("_line", F.nullif(cut, F.lit(""))).withColumn(out, F.try_parse_json("_line"))
    return keep_where(parsed.drop("_line", column), F.col(out).isNotNull())


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """Records of a JSON-line log; empty if the log is not there."""
    try:
        return parsed_lines(spark.read.text(path))
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], "record variant")
        raise


def stream_log(spark: SparkSession, folder: str) -> DataFrame:
    return parsed_lines(spark.readStream.text(folder))


def read_artifact(spark: SparkSession, path: str, default: str | None = None) -> DataFrame:
    """One row ``record``: a JSON file, or the first ``*.json`` of a folder by name, or the default.

    Without a default a missing artifact is an error.
    """
    # Names are listed without reading the files; then the chosen one is read.
    files = _existing(spark, path)
    name = F.element_at(F.split("_metadata.file_path", "/"), -1)
    listed = files and spark.read.format("binaryFile").load(path)
    chosen = files and listed.select("_metadata.file_path", name.alias("_name")).orderBy(~F.endswith("_name", F.lit(".json")), "_name").first()
    if chosen:
        only = files.where(F.col("_metadata.file_path") == chosen[0])
        return only.select(F.parse_json("value").alias("record"))
    if default is None:
        raise FileNotFoundError(f"required artifact not found: {path}")
    return spark.range(1).select(F.parse_json(F.lit(default)).alias("record"))


def read_frame(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with a header and a declared schema."""
    return spark.read.csv(path, header=True, schema=schema)


def csv_rows(lines: DataFrame, schema: str, column: str = "value") -> DataFrame:
    """Lines of CSV text without a header, in a declared schema; what does not parse is NULL."""
    return lines.select(F.from_csv(column, schema).alias("_row")).select("_row.*")


def read_flows(spark: SparkSession, path: str) -> DataFrame:
    """Flow rules of a ``{"flows": [...]}`` file, numbered in file order.

    A missing or malformed file gives no rows. ``flow_refusal`` says so: hand both to ``moves.judge``,
    which then denies every move.
    """
    columns = FLOW_SCHEMA.split(", ")[1:]
    fields = ",".join(column.replace(" ", ":", 1) for column in columns)
    files = _existing(spark, path)
    if files is None:
        return spark.createDataFrame([], FLOW_SCHEMA)
    flows = F.from_json("value", f"struct<flows:array<struct<{fields}>>>")["flows"]
    numbered = files.select(F.posexplode_outer(flows).alias("ordinal", "_f")).where(F.col("_f").isNotNull())
    return numbered.select("ordinal", "_f.*")


def policy_refusal(text: Column) -> Column:
    """Why a policy text cannot be used, or null.

    Only an object is a policy, and its ``flows``, if it has any, must be an array: JSON null, numbers, texts
    and objects in its place are refused. An object without ``flows`` is a policy without rules.
    """
    parsed = F.try_parse_json(text)
    flows = F.try_variant_get(parsed, "$.flows", "variant")
    return (
        F.when(text.isNull(), V.POLICY_MISSING)
        .when(parsed.isNull(), V.POLICY_UNREADABLE)
        .when(~F.startswith(F.schema_of_variant(parsed), F.lit("OBJECT<")), V.POLICY_NO_LIST)
        .when(flows.isNotNull() & ~F.startswith(F.schema_of_variant(flows), F.lit("ARRAY<")), V.POLICY_NO_LIST)
    )


def flow_refusal(spark: SparkSession, path: str) -> str | None:
    """``policy_refusal`` of the file at ``path``: one row, read when the job is planned. A folder without a file has none."""
    files = _existing(spark, path)
    found = files and files.select(policy_refusal(F.col("value"))).first()
    return found[0] if found else V.POLICY_MISSING


def read_catalog(spark: SparkSession, path: str, schema: str = CONTROL_SCHEMA) -> DataFrame:
    """A catalog table as JSON lines, with a declared schema."""
    return spark.read.schema(schema).json(path)


def evidence_document(
    controls: DataFrame, artifacts: dict[str, DataFrame], generated_at: str, tool: str, links: DataFrame | None = None, max_bytes: int = PART_BYTES
) -> DataFrame:
    """``section, payload`` rows of a unified evidence document, ready for ``write_report``.

    With ``links`` the controls come with the lists of their tools, and those that only a mapping knows come too; a
    control with many links is several rows of at most ``max_bytes`` of links. Without, they come as they are.
    Each artifact record is a row of its own, so the document has no size limit.
    """
    spark = controls.sparkSession
    head = spark.range(1).select(
        F.lit("run_metadata").alias("section"),
        F.to_json(F.struct(F.lit(generated_at).alias("generated_at_utc"), F.lit(tool).alias("tool"))).alias("payload"),
    )
    listed = controls if links is None else control_parts(controls, links, max_bytes)
    rows = head.unionByName(listed.select(F.lit("controls").alias("section"), F.to_json(F.struct("*")).alias("payload")))
    for name, records in artifacts.items():
        rows = rows.unionByName(
            records.select(F.lit(f"artifacts.{name}").alias("section"), F.to_json(F.struct("*")).alias("payload"))
        )
    return rows

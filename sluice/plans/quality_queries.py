"""Training-data queries over events, labels and embeddings."""

from __future__ import annotations

from pyspark.sql import functions as F

from sluice.functions import detect
from sluice.operators import drift as D
from sluice.operators import quality as Q
from sluice.operators import violations as R
from sluice.operators.tables import fixed_table
from sluice.plans import triggers as T
from sluice.plans.registry import query, table
from sluice.plans.text_queries import documents
from sluice.plans.violation_queries import _TRUSTED_SQL, TRUSTED
from sluice.sources.readers import csv_rows


def frame(spark, folder):
    """Training rows with gaps: NULL and NaN values, NULL labels."""
    return table(spark, folder, "events").select(
        "event_id", F.expr("CASE WHEN event_id % 50 = 0 THEN double('NaN') WHEN event_id % 20 = 1 THEN NULL ELSE value END").alias("value"),
        F.expr("CASE WHEN event_id % 3 = 0 THEN NULL ELSE user_id END").alias("user_id"),
        F.expr("CASE WHEN event_id % 40 = 2 THEN NULL ELSE event_type END").alias("label"),
    )


_FRAME_SQL = """WITH f AS (SELECT event_id, CASE WHEN event_id % 50 = 0 THEN 'NaN'::DOUBLE WHEN event_id % 20 = 1 THEN NULL ELSE value END AS value,
  CASE WHEN event_id % 3 = 0 THEN NULL ELSE user_id END AS user_id, CASE WHEN event_id % 40 = 2 THEN NULL ELSE event_type END AS label FROM events)"""
_NULLS_SQL = """nf AS (SELECT unnest(['event_id', 'value', 'user_id', 'label']) AS "column", unnest([
    avg((event_id IS NULL)::INT), avg((value IS NULL OR isnan(value))::INT), avg((user_id IS NULL)::INT), avg((label IS NULL)::INT)]) AS x FROM f)"""


@query("clean_rows", f"{_FRAME_SQL} SELECT * FROM f WHERE value IS NOT NULL AND NOT isnan(value) AND user_id IS NOT NULL AND label IS NOT NULL")
def clean_rows(spark, folder):
    return Q.basic_clean(frame(spark, folder))


@query("null_fraction", f'{_FRAME_SQL}, {_NULLS_SQL} SELECT "column", round(x, 9) AS null_fraction FROM nf')
def null_fraction(spark, folder):
    return Q.null_fractions(frame(spark, folder)).withColumn("null_fraction", F.round("null_fraction", 9))


@query(
    "label_share",
    f"{_FRAME_SQL} SELECT label, count(*) AS n, round(count(*) / (SELECT count(label) FROM f), 9) AS share FROM f WHERE label IS NOT NULL GROUP BY 1",
)
def label_share(spark, folder):
    return Q.label_shares(frame(spark, folder), "label").withColumn("share", F.round("share", 9))


@query(
    "training_gate",
    f"""{_FRAME_SQL}, {_NULLS_SQL}, s AS (SELECT count(*) AS n FROM f WHERE label IS NOT NULL GROUP BY label),
      g AS (SELECT 'null_fraction' AS "check", max(x) AS v, 0.3::DOUBLE AS threshold FROM nf
        UNION ALL SELECT 'label_imbalance', max(n) / sum(n), 0.9 FROM s)
    SELECT "check", round(v, 9) AS value, threshold, v <= threshold AS passed FROM g""",
)
def training_gate(spark, folder):
    return Q.training_gate(frame(spark, folder), "label").withColumn("value", F.round("value", 9))


@query(
    "training_scan",
    T.sql_docs() + f"""
    SELECT doc_id, quality, concat_ws(',', CASE WHEN ssn IS NOT NULL THEN 'SSN' END, CASE WHEN routing IS NOT NULL THEN 'ROUTING' END,
      CASE WHEN passport IS NOT NULL THEN 'PASSPORT' END, CASE WHEN mrn THEN 'MRN' END, CASE WHEN phi THEN 'PHI_HINT' END) AS types,
      source IN ({_TRUSTED_SQL}) AS trusted FROM hits JOIN labels USING (doc_id)""",
)
def training_scan(spark, folder):
    # Texts are scanned before the join, so that only their findings are shuffled.
    found = detect.detect_entities(documents(spark, folder).select("doc_id", "source", "text")).select(
        "doc_id", "source", F.array_join("entities.type", ",").alias("types")
    )
    marked = R.with_trust(found, fixed_table(spark, TRUSTED, "source string"))
    return marked.join(table(spark, folder, "labels"), "doc_id").select("doc_id", "quality", "types", "trusted")


# From the second week on there is a type that the baseline week lacks.
_LATER_TYPE = "CASE WHEN ts >= TIMESTAMP '2024-01-08 00:00:00' AND event_id % 7 = 0 THEN 'refund' ELSE event_type END"
_WEEK = "CAST(floor((epoch(ts) - 1704067200) / 604800) AS INTEGER)"


def weekly(spark, folder):
    week = F.expr("cast(floor(datediff(to_date(ts), date'2024-01-01') / 7) as int)")
    return table(spark, folder, "events").select(week.alias("week"), "value", F.expr(_LATER_TYPE).alias("event_type"))


def _psi_sql(bin_sql: str, bins: str, extra: str = "") -> str:
    return f"""WITH e AS (SELECT {_WEEK} AS week, value, {_LATER_TYPE} AS event_type FROM events){extra},
      u AS (SELECT bin::VARCHAR AS bin FROM {bins} k(bin) UNION ALL SELECT 'none of these'),
      b AS (SELECT week, CASE WHEN x IN (SELECT bin FROM u) THEN x ELSE 'none of these' END AS bin
        FROM (SELECT week, ({bin_sql})::VARCHAR AS x FROM e{', edge' if extra else ''})),
      c AS (SELECT w.week, u.bin, count(b.bin) AS n FROM (SELECT DISTINCT week FROM e) w CROSS JOIN u
        LEFT JOIN b ON b.week = w.week AND b.bin = u.bin GROUP BY 1, 2),
      p AS (SELECT week, bin, n, greatest(n / sum(n) OVER (PARTITION BY week), 0.0001) AS s FROM c)
    SELECT p.week AS period, sum(p.n)::BIGINT AS n, round(sum((p.s - q.s) * ln(p.s / q.s)), 6) AS psi
    FROM p JOIN p q ON q.bin = p.bin AND q.week = 0 GROUP BY 1"""


@query(
    "drift_psi",
    _psi_sql(
        "CASE WHEN value < lo THEN 0 WHEN value >= hi THEN 11 ELSE floor((value - lo) / (hi - lo) * 10)::INTEGER + 1 END",
        "(SELECT unnest(range(12)))", ", edge AS (SELECT min(value) AS lo, max(value) AS hi FROM e WHERE week = 0)",
    ),
)
def drift_psi(spark, folder):
    return Q.numeric_drift(weekly(spark, folder), "week", "value", 0).withColumn("psi", F.round("psi", 6))


EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


@query("drift_labels", _psi_sql("event_type", f"(SELECT unnest({EVENT_TYPES}))"))
def drift_labels(spark, folder):
    return Q.drift(weekly(spark, folder), "week", "event_type", EVENT_TYPES, 0).withColumn("psi", F.round("psi", 6))


_DRIFT_SQL = f"""WITH e AS (SELECT {_WEEK} AS week, {_LATER_TYPE} AS event_type,
      CASE WHEN event_id % 50 = 0 THEN 'NaN'::DOUBLE WHEN event_id % 20 = 1 THEN NULL ELSE value END AS value, user_id % 97 AS user_group FROM events),
    v AS (SELECT week, CASE WHEN isnan(value) THEN NULL ELSE value END AS value, user_group::DOUBLE AS user_group, event_type FROM e),
    q AS (SELECT quantile_disc(value, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS ve,
      quantile_disc(user_group, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS ue, list_distinct(list(event_type)) AS items FROM v WHERE week = 0),
    b AS (
      SELECT week, 'value' AS "column", CASE WHEN value IS NULL THEN '0' ELSE (len(list_filter(list_distinct(ve), lambda x: x < value)) + 1)::VARCHAR END AS bin FROM v, q
      UNION ALL SELECT week, 'user_group', CASE WHEN user_group IS NULL THEN '0' ELSE (len(list_filter(list_distinct(ue), lambda x: x < user_group)) + 1)::VARCHAR END FROM v, q
      UNION ALL SELECT week, 'event_type', CASE WHEN event_type IS NULL THEN '0' WHEN list_contains(items, event_type) THEN event_type ELSE 'other' END FROM v, q),
    c AS (SELECT week, "column", bin, count(*) AS n FROM b GROUP BY ALL),
    t AS (SELECT week, "column", sum(n) AS total FROM c GROUP BY ALL),
    g AS (SELECT t.week, t."column", total, greatest(coalesce(c.n / total, 0), 0.0001) AS s, x.bin
      FROM t JOIN (SELECT DISTINCT "column", bin FROM c) x USING ("column") LEFT JOIN c ON c.week = t.week AND c."column" = t."column" AND c.bin = x.bin)
    SELECT g."column", g.week AS period, any_value(g.total)::BIGINT AS n, round(sum((g.s - z.s) * ln(g.s / z.s)), 6) AS psi, sum((g.s - z.s) * ln(g.s / z.s)) > 0.2 AS alert
    FROM g JOIN g z ON z.week = 0 AND z."column" = g."column" AND z.bin = g.bin GROUP BY 1, 2"""


@query("drift_columns", _DRIFT_SQL)
def drift_columns(spark, folder):
    """Two numbers and a text at once, with missing values; no bins are known beforehand."""
    week = F.expr("cast(floor(datediff(to_date(ts), date'2024-01-01') / 7) as int)")
    rows = table(spark, folder, "events").select(
        week.alias("week"), F.expr("CASE WHEN event_id % 50 = 0 THEN double('NaN') WHEN event_id % 20 = 1 THEN NULL ELSE value END").alias("value"),
        F.expr("user_id % 97").alias("user_group"), F.expr(_LATER_TYPE).alias("event_type"),
    )
    return D.drift_columns(rows, "week", 0, ["value", "user_group"], ["event_type"]).withColumn("psi", F.round("psi", 6))


_TRAIN_SQL = "('0x' || md5(vec_id::VARCHAR)[1:8])::BIGINT % 100 < 80"


@query("split_rows", f"SELECT vec_id, CASE WHEN {_TRAIN_SQL} THEN 'train' ELSE 'test' END AS side FROM embeddings")
def split_rows(spark, folder):
    train, test = Q.hash_split(table(spark, folder, "embeddings").select("vec_id"), "vec_id")
    return train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test")))


@query("baseline_scores")
def baseline_scores(spark, folder):
    """The fit's accuracy on the test rows beside the share of their larger class. SQL cannot fit it."""
    rows = table(spark, folder, "embeddings").select("vec_id", "embedding", (F.col("label") < 5).alias("label"))
    return Q.train_baseline(rows, "vec_id", "embedding", "label")[1].select("n_train", "n_test", "accuracy", "larger_class")


@query(
    "pipeline_rows",
    """SELECT event_id, value, event_type FROM events WHERE event_id % 9 NOT IN (1, 2)""",
)
def pipeline_rows(spark, folder):
    """Lines of a CSV file, some with an empty field or text where a number belongs."""
    line = F.concat_ws(
        ",", "event_id", F.expr("CASE event_id % 9 WHEN 1 THEN '' WHEN 2 THEN 'n/a' ELSE cast(value AS STRING) END"), "event_type"
    )
    lines = table(spark, folder, "events").select(line.alias("value"))
    return Q.run_pipeline(csv_rows(lines, "event_id bigint, value double, event_type string"))

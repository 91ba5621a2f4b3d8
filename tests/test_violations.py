from pyspark.sql import functions as F

from sluice.operators import violations as R


def test_missing_fields_keep_null_and_false_apart(spark):
    full = '{"timestamp":1,"user":"u","action":"a","decision":null,"classification":"x"}'
    rows = [(1, full), (2, '{"timestamp":0,"user":"","action":false,"decision":[]}'), (3, "{}"), (4, None)]
    df = spark.createDataFrame(rows, "id int, t string").withColumn("log", F.try_parse_json("t"))
    out = {r["id"]: r["m"] for r in df.select("id", R.missing_fields(F.col("log")).alias("m")).collect()}
    assert out == {1: [], 2: ["action", "classification"], 3: ["timestamp", "user", "action", "decision", "classification"], 4: out[3]}
    one = df.select("id", F.size(R.evidence_messages(F.col("log"))).alias("n")).collect()
    assert [r["n"] for r in one] == [1, 1, 1, 1]


def test_sources_and_acl(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, source string")
    trusted = spark.createDataFrame([("a",), ("a",)], "s string")
    assert sorted(r["id"] for r in R.untrusted_sources(df, trusted).collect()) == [2, 3]
    assert {r["id"]: r["trusted"] for r in R.with_trust(df, trusted).collect()} == {1: True, 2: False, 3: False}
    asked = spark.createDataFrame([(1, "t", "r"), (2, "t", "x"), (3, "u", "r"), (4, None, None)], "id int, record_type string, role string")
    acl = spark.createDataFrame([("t", "r")], "record_type string, role string")
    assert [r["id"] for r in R.acl_allowed(asked, acl).collect()] == [1]


def test_agent_and_report(spark):
    df = spark.createDataFrame([(1, "api_call", None), (2, "api_call", True), (3, "read", None)], "id int, act string, ok boolean")
    found = R.long_report(df, "id", packs={"agent": R.agent_messages(F.col("act"), F.col("ok")), "all": R.messages((F.col("id") > 2, "big"))})
    assert sorted(map(tuple, found.collect())) == [(1, "agent", "Unauthorized agentic action"), (3, "all", "big")]

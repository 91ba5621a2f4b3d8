"""The sample that the weights of words and tags are fitted on."""

import pyspark.sql.functions as F

from sluice.llm import html


def test_copies_count_once(spark):
    pages = [f"<div class='c{i}'>menu {i}</div><article>text {i}</article>" for i in range(4)]
    made = spark.createDataFrame([(p,) for p in pages], "html string")
    first = made.orderBy(F.xxhash64("html")).first().html
    copies = spark.createDataFrame([(first,)] * 20 + [(p,) for p in pages] + [(None,), ("<p>no mark",)], "html string")
    weights = html.fit(copies, bound=4)
    assert {f"div.c{i}" for i in range(4)} <= set(weights.tag)
    assert weights.tag == html.fit(made, bound=4).tag and weights.word == html.fit(made, bound=4).word
    assert sum(f"div.c{i}" in html.fit(copies, bound=2).tag for i in range(4)) == 2
    assert html.fit(made.limit(0)).tag == {}

"""Every registered query against its check SQL, and the driver contract."""

import pytest

import __spark_entry__ as driver
from sluice.plans import all_queries
from tests import compare

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return compare.duck(FOLDER)


@pytest.mark.parametrize("name", list(all_queries()))
def test_query(spark, con, name):
    q = all_queries()[name]
    df = q.run(spark, FOLDER)
    rows = compare.spark_rows(df)
    assert rows[1]
    if q.sql is not None:
        assert rows == compare.duck_rows(con, q.sql)
        assert not compare.type_gaps(df, con, q.sql)


@pytest.mark.parametrize(
    ("name", "scans"),
    [("control_index", 4), ("first_controls", 4), ("nested_links", 6), ("evidence_document", 2), ("framework_counts", 1), ("tool_validation", 1),
     ("dangling_artifacts", 2), ("corpus_upsert", 2), ("drift_psi", 2), ("drift_labels", 1), ("plan_denies", 2), ("plan_allow", 2)],
)
def test_plans_sort_no_rows_to_aggregate(spark, name, scans):
    plan = all_queries()[name].run(spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortAggregate") == 0 and plan.count("FileScan") <= scans
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_driver_contract(spark):
    assert driver.entry(spark).count() == 600
    bare = {n for n in set(driver.queries()) - set(driver.oracle_sql()) if n != "pipeline" and not n.startswith("op")}
    assert bare == {"baseline_scores"}

from pathlib import Path

import duckdb
import pytest
from conftest import INGESTED  # noqa: F401  (puts the repository on the path)

import compare
from __spark_entry__ import entry, oracle_sql, queries
from gaugeline.plans.catalogue import build_queries

FOLDER = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="needs the generated tables")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW events AS FROM '{FOLDER}/events.parquet'")
    return connection


@pytest.mark.parametrize("name", build_queries())
def test_query_equals_its_sql(spark, database, name):
    frame = queries()[name](spark, str(FOLDER))
    cursor = database.execute(oracle_sql()[name])
    want = compare.table([part[0] for part in cursor.description], cursor.fetchall())
    assert compare.type_differences(frame, database.execute(oracle_sql()[name]).description) == []
    assert compare.table(frame.columns, frame.collect()) == want


def test_entry(spark):
    rows = entry(spark)
    assert rows.count() > 0
    assert rows.columns[:3] == ["source", "window_start", "window_end"]


def test_every_query_has_sql():
    assert build_queries().keys() <= oracle_sql().keys()
    assert oracle_sql().keys() <= queries().keys()


@pytest.mark.parametrize("name", ["window_5m", "source_kpis", "overview_kpis", "insights", "upsert_records"])
def test_plans_stay_distributed(spark, name):
    plan = queries()[name](spark, str(FOLDER))._jdf.queryExecution().executedPlan().toString()
    for operator in ["CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython"]:
        assert operator not in plan

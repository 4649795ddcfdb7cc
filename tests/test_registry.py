"""Every registered report against its SQL check, on the smallest test tables, and its plan."""

import glob
import os
import re

import duckdb
import pytest

import __spark_entry__ as registry

FOLDER = "/root/testdata/sf0.001"
# the optional subpackage tests its own queries
QUERIES, CHECKS = ({name: value for name, value in known.items() if not re.match(r"op\d+_|pipeline$", name)}
                   for known in (registry.queries(), registry.oracle_sql()))
FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython",
             "MapInPandas", "FlatMapGroupsInPandas"]


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def test_every_report_has_a_check():
    assert set(QUERIES) == set(CHECKS)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_report_equals_sql(spark, database, name):
    df = QUERIES[name](spark, FOLDER)
    relation = database.sql(CHECKS[name])
    columns = sorted(df.columns)
    assert columns == sorted(relation.columns)
    places = [relation.columns.index(c) for c in columns]
    got = sorted(str([row[c] for c in columns]) for row in df.collect())
    expected = sorted(str([row[i] for i in places]) for row in relation.fetchall())
    assert got == expected
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [node for node in FORBIDDEN if node in plan]

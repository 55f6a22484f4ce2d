"""Every registered query against its DuckDB twin, and what its plan must not contain."""

import math
import os
import subprocess
import sys

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from conftest import SF

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()
# plans that would not survive large inputs
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(SF):
        if name.endswith(".parquet"):
            con.sql(f"CREATE VIEW {name[:-8]} AS SELECT * FROM '{SF}/{name}'")
    return con


def cell(v):
    if v is None or v is pd.NaT:
        return "NULL"
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float):
        return "NULL" if math.isnan(v) else f"{v:.9g}"
    return str(v)


def rows_of(frame):
    names = sorted(frame.columns)
    return names, sorted(tuple(cell(v) for v in row) for row in frame[names].itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(name, spark, duck):
    df = QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in FORBIDDEN if x in plan]
    assert rows_of(df.toPandas()) == rows_of(duck.sql(ORACLES[name]).df())


def test_oracles_need_neither_jars_nor_session():
    """All SQL is built in a fresh process that cannot find Spark's jars, and none is missing."""
    code = (
        "import pyspark; pyspark.__file__ = '/nowhere/pyspark/__init__.py'\n"
        "import os, sys; os.environ.pop('JAVA_HOME', None); os.environ['PATH'] = '/nowhere'\n"
        f"sys.path.insert(0, {ROOT!r})\n"
        "import __spark_entry__ as e; print(len(e.oracle_sql()), len(e.ALL_ORACLES))"
    )
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True).stdout.split()
    assert out[0] == out[1] == str(len(ORACLES))


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_has_rows(spark):
    assert len(entry.entry(spark).head(5)) == 5


@pytest.mark.parametrize("name", ["bernoulli_sample", "distinct_users_approx", "tfidf_vectors", "topic_one_hot"])
def test_runs(name, spark):
    assert QUERIES[name](spark, SF).count() > 0

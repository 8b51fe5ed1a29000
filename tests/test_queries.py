"""Every registered query against its SQL in DuckDB."""

import glob
import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry
from lakestrata.queries import ORACLES, QUERIES
from tools.check_oracles import rows_of

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"create view {name} as select * from '{path}'")
    return connection


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, database, name):
    df = entry.queries()[name](spark, SF)
    got = rows_of(df.columns, df.collect())
    assert got
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return
    cursor = database.execute(sql)
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    assert got == rows_of(names, cursor.fetchall())


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "instituicao_financeira"
    assert df.count() > 0


@pytest.mark.parametrize("missing", ["public_tokenizers", "lakestrata.llm", "corpus_pipeline"])
def test_the_entry_without_what_the_optional_queries_need(missing):
    code = f"import sys; sys.modules[{missing!r}] = None; import __spark_entry__ as e; print(sorted(e.queries()) == {sorted(QUERIES)})"
    root = os.path.dirname(os.path.abspath(entry.__file__))
    done = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=120)
    assert done.stdout.strip().endswith("True"), done.stderr

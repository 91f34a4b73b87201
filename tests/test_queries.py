"""Every query of the reference's operators against its SQL in DuckDB, and the entry points with and without the llm folders."""

import os
import shutil
import subprocess
import sys

import duckdb
import pytest

from corpusloom import catalogue

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"create view {f.removesuffix('.parquet')} as select * from '{SF}/{f}'")
    return con


def lines(table):
    names = sorted(table.column_names)
    return sorted(repr([r[n] for n in names]) for r in table.to_pylist()), names


@pytest.mark.parametrize("name", sorted(catalogue.SQL))
def test_query_equals_its_sql(spark, duck, name):
    got, want = catalogue.QUERIES[name](spark, SF).toArrow(), duck.execute(catalogue.SQL[name]).to_arrow_table()
    assert lines(got) == lines(want) and got.num_rows
    assert {f.name: str(f.type) for f in got.schema} == {f.name: str(f.type) for f in want.schema}


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.SQL)))
def test_query_without_sql_finds_rows(spark, name):
    assert catalogue.QUERIES[name](spark, SF).toArrow().num_rows > 0


def test_entry_points_without_the_llm_folders(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    shutil.copytree(f"{root}/corpusloom", f"{tmp_path}/corpusloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; assert e.queries() and e.oracle_sql() and not [n for n in e.queries() if n.startswith('op') or n == 'pipeline']"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env=os.environ | {"PYTHONPATH": str(tmp_path)})

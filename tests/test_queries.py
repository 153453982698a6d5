"""Every query with a DuckDB twin, on the smallest driver tables, if they are there."""

import datetime as dt
import math
import os

import pytest

from citeloom import queries

SF = "/root/testdata/sf0.001"


def plain(v):
    v = v.item() if hasattr(v, "item") else v
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    return v.isoformat() if isinstance(v, (dt.date, dt.datetime)) else v


def rows(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([plain(r[i]) for i in order]) for r in records)


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    if not os.path.isdir(SF):
        pytest.skip("no driver tables")
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_twin(spark, duck, name):
    df = queries.QUERIES[name](spark, SF)
    other = duck.sql(queries.ORACLES[name])
    assert rows(df.columns, df.collect()) == rows(other.columns, other.fetchall())


def test_entry_imports_without_the_subpackage(tmp_path):
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    root = Path(__file__).parent.parent
    shutil.copytree(root / "citeloom", tmp_path / "citeloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; assert len(e.queries()) > 30 and set(e.oracle_sql()) <= set(e.queries()); assert 'pipeline' not in e.queries()"
    subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, check=True)

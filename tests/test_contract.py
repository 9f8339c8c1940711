"""Every query with SQL gives the SQL's rows; every query without gives a stable schema."""

import glob
import importlib.util
import math
import os
from collections import Counter

import pytest

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables are not here")


def _modules():
    from strandloom.plans import catalogue

    return catalogue.queries(), catalogue.oracle_sql()


def norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return round(v, 5)
    if hasattr(v, "isoformat"):
        return str(v)[:19]
    if isinstance(v, (list, tuple)):
        return tuple(map(norm, v))
    return v


def compare(spark, query, sql, data=DATA):
    import duckdb

    con = duckdb.connect()
    for path in glob.glob(f"{data}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    df = query(spark, data)
    cols = sorted(df.columns)
    got = Counter(tuple(map(norm, r)) for r in df.select(*(f"`{c}`" for c in cols)).collect())
    result = con.sql(sql)
    assert sorted(result.columns) == cols
    names = ", ".join(f'"{c}"' for c in cols)
    want = Counter(tuple(map(norm, r)) for r in con.sql(f"SELECT {names} FROM ({sql})").fetchall())
    assert got == want


@pytest.mark.parametrize("name", sorted(_modules()[0]))
def test_query(spark, name):
    queries, sql = _modules()
    if name in sql:
        compare(spark, queries[name], sql[name])
    else:
        assert queries[name](spark, DATA).columns


def test_core_does_not_import_llm():
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for path in glob.glob(f"{root}/strandloom/**/*.py", recursive=True):
        if os.sep + "llm" + os.sep not in path:
            assert "llm" not in open(path).read().replace("subpackage ``llm``", ""), path
    assert importlib.util.find_spec("strandloom")

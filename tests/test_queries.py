"""Every registered query against its oracle on the smallest tables; those without one must run."""

import math

import duckdb
import pytest

from fabulon.plans import registry

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUERIES, SQL = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{DIR}/{t}.parquet'")
    return c


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    return round(float(v), 5) if isinstance(v, float) or type(v).__name__ == "Decimal" else v


def rows(found, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in found), key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("name", sorted(SQL))
def test_oracle(spark, con, name):
    df = QUERIES[name](spark, DIR)
    rel = con.execute(SQL[name])
    names = [c[0] for c in rel.description]
    assert sorted(names) == sorted(df.columns)
    assert rows(df.collect(), df.columns) == rows(rel.fetchall(), names)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, name):
    assert QUERIES[name](spark, DIR).count() > 0


def test_llm_is_not_needed():
    import subprocess
    import sys

    code = "import sys; sys.modules['fabulon.llm'] = None; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; assert 'pipeline' not in e.queries() and len(e.queries()) > 90"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=str(__import__("pathlib").Path(__file__).resolve().parents[1]))

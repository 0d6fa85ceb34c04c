"""Every SQL-backed catalogue query against its DuckDB statement at sf0.001
(exact values, column order ignored, row order ignored)."""

import math

import duckdb
import pytest

from tests.conftest import SF

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    return repr(v)


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    yield con
    con.close()


def _names():
    import __spark_entry__ as E
    return sorted(E.oracle_sql())


@pytest.mark.parametrize("name", _names())
def test_matches_oracle(spark, duck, name):
    import __spark_entry__ as E
    sdf = E.queries()[name](spark, SF)
    srows = [tuple(r) for r in sdf.collect()]
    res = duck.execute(E.oracle_sql()[name])
    dcols = [c[0] for c in res.description]
    assert sorted(sdf.columns) == sorted(dcols)
    assert _canon(sdf.columns, srows) == _canon(dcols, res.fetchall())

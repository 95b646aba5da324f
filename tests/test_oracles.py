"""Every registered query against its DuckDB oracle on the smallest tables (the driver runs sf0.01)."""
import hashlib
import math
import re

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
KEYS = sorted(E.oracle_sql())


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        return "∅" if math.isnan(v) else repr(round(v, 6))
    return v.isoformat() if hasattr(v, "isoformat") else str(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.sha256("\n".join(sorted("\x1f".join(_norm(r[i]) for i in order) for r in rows)).encode()).hexdigest()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    core = {k for k in E.queries() if k != "pipeline" and not re.match(r"op\d+_", k)}
    missing = core - set(E.oracle_sql())
    assert not missing, missing


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[key])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(srows) == len(orows)
    assert _digest(df.columns, srows) == _digest(ocols, orows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["url", "message", "batch_id"]
    assert df.count() >= 0

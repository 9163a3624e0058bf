"""Every registered query against its DuckDB oracle on the smallest tables."""

import hashlib
import os

import duckdb
import pytest

import __spark_entry__ as se
from activity_engine.plans.catalog import QUERIES
from conftest import SF001

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = []
    for r in rows:
        vals = []
        for i in order:
            v = r[i]
            vals.append(repr(v + 0.0) if isinstance(v, float) else str(v))
        out.append("|".join(vals))
    return hashlib.md5("\n".join(sorted(out)).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF001}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(se.oracle_sql()) <= set(se.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = se.queries()[name](spark, SF001)
    rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(se.oracle_sql()[name])
    orows = cur.fetchall()
    ocols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert canon(df.columns, rows) == canon(ocols, orows)


def test_entry_smoke(spark):
    df = se.entry(spark)
    assert df.count() > 0
    assert "risk_level" in df.columns

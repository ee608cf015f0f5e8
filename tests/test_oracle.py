"""Every registered query against its DuckDB oracle on the smallest tables:
same row count, columns and order-insensitive value hash."""
from __future__ import annotations

import hashlib
import json
import math
import os

import duckdb
import pytest

import __spark_entry__ as se
from lifecorpus.plans import registry
from lifecorpus.plans.tables import TABLES

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
QUERIES = se.queries()
SQL = se.oracle_sql()


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v


def _digest(rows):
    hs = sorted(hashlib.sha1(json.dumps([_norm(x) for x in r], default=str).encode()).hexdigest() for r in rows)
    return hashlib.sha1("".join(hs).encode()).hexdigest()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(registry.QUERIES) <= set(SQL) <= set(QUERIES)


def test_entry_runs(spark):
    df = se.entry(spark)
    assert df.count() > 0 and "messages" not in df.columns


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_matches_oracle(spark, con, name):
    sdf = QUERIES[name](spark, SF)
    cols = sorted(sdf.columns)
    srows = [tuple(r[c] for c in cols) for r in sdf.collect()]
    rel = con.execute(SQL[name])
    dcols = [d[0] for d in rel.description]
    assert sorted(dcols) == cols
    idx = {c: i for i, c in enumerate(dcols)}
    drows = [tuple(r[idx[c]] for c in cols) for r in rel.fetchall()]
    assert len(srows) == len(drows)
    assert _digest(srows) == _digest(drows)

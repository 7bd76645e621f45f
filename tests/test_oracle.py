"""Every query that has SQL gives the SQL's rows."""

import math
import os

import duckdb
import pytest
from veritrail.plans import chain, day, network, registry, scoring, suites  # noqa: F401

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return ""
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float)) or type(v).__name__ == "Decimal":
        return f"{float(v):.9g}" if abs(float(v)) > 1e-12 else "0"
    return str(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_query_equals_sql(spark, duck, name):
    got = registry.QUERIES[name](spark, SF)
    want = duck.execute(registry.ORACLE[name])
    columns = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(columns)
    order = sorted(columns)
    ours = sorted(tuple(plain(r[c]) for c in order) for r in got.collect())
    theirs = sorted(tuple(plain(dict(zip(columns, r, strict=True))[c]) for c in order) for r in want.fetchall())
    assert len(ours) == len(theirs)
    assert [(a, b) for a, b in zip(ours, theirs, strict=True) if a != b][:5] == []


def test_every_query_has_sql():
    assert set(registry.QUERIES) == set(registry.ORACLE)

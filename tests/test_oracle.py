"""Every query against its SQL in DuckDB, over whole tables."""

import math
import os
import re

import duckdb
import pytest

import __spark_entry__ as entry

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")


def plain(v):
    if v is None:
        return ""
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    return str(v)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(n for n in entry.oracle_sql() if n in entry.queries() and not re.match(r"op\d|pipeline", n)))
def test_sql(spark, con, name):
    got = entry.queries()[name](spark, FOLDER)
    rel = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in rel.description]
    assert sorted(names) == sorted(got.columns)
    expected = [dict(zip(names, r)) for r in rel.fetchall()]
    order = sorted(names)
    assert sorted([plain(r[c]) for c in order] for r in got.collect()) == sorted([plain(r[c]) for c in order] for r in expected)


@pytest.mark.parametrize("name", sorted(n for n in entry.queries() if n not in entry.oracle_sql() and not re.match(r"op\d|pipeline", n)))
def test_rows(spark, name):
    assert entry.queries()[name](spark, FOLDER).count() > 0


def test_entry(spark):
    assert entry.entry(spark).columns == ["word", "n", "first_seen"]

"""Every registered query of the layer against its SQL, on the smallest tables."""

import os
from pathlib import Path

import duckdb
import pytest

from chunkscan.queries import KEYS, ORACLES, QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not Path(FOLDER).is_dir(), reason="no tables here")


def plain(value):
    if isinstance(value, float):
        return round(value, 9)
    return tuple(map(plain, value)) if isinstance(value, list) else bytes(value) if isinstance(value, (bytes, bytearray)) else value


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for t in KEYS:
        connection.sql(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return connection


def test_all_have_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    df = QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    got = df.select(*columns).toArrow()
    want = db.sql(ORACLES[name]).fetchall()
    names = [c[0] for c in db.sql(ORACLES[name]).description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    rows = lambda it: sorted(repr(tuple(plain(v) for v in r)) for r in it)
    assert rows(zip(*[got[c].to_pylist() for c in columns])) == rows(tuple(r[i] for i in order) for r in want)

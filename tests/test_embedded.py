"""Embedded databases: values survive the load, and executors in JVMs of their own read them."""

import datetime as dt
import decimal
import json
import os
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import chunkscan.sources.embedded as embedded
from chunkscan.operators.scan import ChunkedScan
from chunkscan.queries import ORACLES
from chunkscan.sources.options import ScanOptions
from tests.conftest import ROOT
from tests.test_queries import FOLDER, plain

ORDERS = Path(FOLDER, "orders.parquet")
#: Queries of the list, each in a cluster of two executors; results as lines of JSON.
CLUSTER = """
import json, sys
from pyspark.sql import SparkSession
from chunkscan.queries import QUERIES
spark = SparkSession.builder.master("local-cluster[2,1,1024]").config("spark.executor.memory", "700m").config("spark.ui.enabled", "false").config("spark.driver.host", "127.0.0.1").config("spark.sql.session.timeZone", "UTC").config("spark.checkpoint.dir", sys.argv[1]).getOrCreate()
for name in sys.argv[3:]:
    df = QUERIES[name](spark, sys.argv[2])
    print(json.dumps([name, df.columns, [repr(tuple(r)) for r in df.collect()]]))
"""


def test_values(spark, monkeypatch):
    monkeypatch.setattr(embedded, "ROWS", 3)
    odd = ["", "a,b", 'say "x"', "two\nlines\r\n", "it's", " blank ", "\\N", "é😀", None, "NULL", '"', "x" * 200]
    day = dt.datetime(2020, 1, 2, 3, 4, 5, 678901)
    rows = [(9 - i, x, i / 3, decimal.Decimal(-i) / 4, None if i % 2 else day, i % 3 == 0, day.date()) for i, x in enumerate(odd)]
    df = spark.createDataFrame(rows, "id long, name string, d double, p decimal(8,2), at timestamp_ntz, yes boolean, day date")
    url = embedded.database(df, "T", "id", "name VARCHAR(300)")
    back = ChunkedScan(ScanOptions(url=url, database="APP", table_list=("T",), dialect="derby", chunk_size=5)).load(spark)
    assert back.rdd.getNumPartitions() == 3
    assert sorted(map(tuple, back.collect())) == sorted(rows)


def test_no_rows(spark):
    url = embedded.database(spark.createDataFrame([], "id long, name string"), "T", "id", "name VARCHAR(3)")
    assert ChunkedScan(ScanOptions(url=url, database="APP", table_list=("T",), dialect="derby")).load(spark).count() == 0


@pytest.fixture(scope="module")
def on_cluster(tmp_path_factory):
    if not ORDERS.exists():
        pytest.skip("no tables here")
    home, here = tmp_path_factory.mktemp("home"), tmp_path_factory.mktemp("cwd")
    import pyspark

    for p in Path(pyspark.__file__).parent.iterdir():  # executors' logs go to work in Spark's home
        if p.name != "work":
            (home / p.name).symlink_to(p)
    env = os.environ | {"SPARK_HOME": str(home), "PYTHONPATH": str(ROOT), "PYSPARK_PYTHON": sys.executable, "SPARK_LOCAL_IP": "127.0.0.1", "TZ": "UTC"}
    for name in ("PYSPARK_GATEWAY_PORT", "PYSPARK_GATEWAY_SECRET", "PYSPARK_SUBMIT_ARGS"):
        env.pop(name, None)
    names = ["jdbc_roundtrip_orders", "jdbc_wide_types", "sql_view_database"]
    run = subprocess.run(["timeout", "600", sys.executable, "-c", CLUSTER, str(tmp_path_factory.mktemp("both")), FOLDER, *names], cwd=here, env=env, capture_output=True, text=True)
    found = {x[0]: x[1:] for x in map(json.loads, (line for line in run.stdout.splitlines() if line.startswith('["')))}
    return found, run.stderr[-3000:]


@pytest.mark.parametrize("name", ["jdbc_roundtrip_orders", "jdbc_wide_types", "sql_view_database"])
def test_cluster(on_cluster, name):
    found, errors = on_cluster
    assert name in found, errors
    columns, rows = found[name]
    db = duckdb.connect()
    db.sql(f"CREATE VIEW orders AS SELECT * FROM '{ORDERS}'")
    want = db.sql(ORACLES[name])
    assert sorted(want.columns) == sorted(columns)
    names = {"Decimal": decimal.Decimal, "datetime": dt}
    got = [eval(r, names) for r in rows]
    place = [want.columns.index(c) for c in columns]
    shown = lambda it: sorted(repr(tuple(plain(v) for v in r)) for r in it)
    assert shown(got) == shown(tuple(r[i] for i in place) for r in want.fetchall())

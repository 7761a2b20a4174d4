"""Options, dialects, discovery, databases, SQL."""

import datetime as dt
import decimal
import uuid

import pytest

from pyspark.sql import types

from chunkscan.functions.schema import typed_projection
from chunkscan.operators.scan import ChunkedScan, plan_splits, scan_splits, scan_table
from chunkscan.operators.splits import Split, merged, splits_of
from chunkscan.plans.manifest import Manifest
from chunkscan.plans.pruning import prune
from chunkscan.sources.datasource import create_view, sql
from chunkscan.sources.dialect import dialect_named
from chunkscan.sources.discovery import discover_tables, listed, matching
from chunkscan.sources.options import ScanBuilder, ScanOptions
from chunkscan.sources.relations import CatalogRelation, FrameRelation, JdbcRelation


def opts(**more):
    return ScanOptions(**{"url": "jdbc:mysql://h/db", "database": "db", "table_list": ("t",)} | more)


def test_options():
    o = opts()
    assert (o.chunk_size, o.fetch_size, o.connection_timeout_ms, o.max_retries) == (8096, 1024, 30000, 3)
    assert o.driver_class == "com.mysql.cj.jdbc.Driver"
    assert opts(table_list=(" a, b ", "", "c")).table_list == ("a", "b", "c")
    for bad in ({"table_list": ()}, {"table_pattern": "x"}, {"chunk_size": 0}, {"url": ""}, {"dialect": "nope"}, {"boundary_mode": "x"}, {"table_list": (",",)}):
        with pytest.raises(ValueError):
            opts(**bad)
    with pytest.raises(ValueError):
        opts(url="jdbc:unknown:x").driver_class
    assert "hidden" not in repr(opts(password="hidden"))


def test_ddl_and_builder():
    o = ScanOptions.from_ddl({"url": "u", "database": "d", "table-list": "a, b", "chunk-size": "3"})
    assert (o.table_list, o.chunk_size) == (("a", "b"), 3)
    for bad in ({"url": "u"}, {"url": "u", "database": "d", "table-list": "a", "colour": "x"}, {"url": "u", "database": "d", "table-list": "a", "table-pattern": "b"}):
        with pytest.raises(ValueError):
            ScanOptions.from_ddl(bad)
    whole = opts(chunk_size=7)
    built, schema = ScanBuilder().url("other").options(whole).schema("a int").build()
    assert built is whole and schema == "a int"
    built, _ = ScanBuilder().url("u").database("d").table_list("a", "b").chunk_size(2).schema("a int").build()
    assert built.table_list == ("a", "b") and built.chunk_size == 2
    with pytest.raises(ValueError):
        ScanBuilder().url("u").database("d").table_list("a").build()


def test_mysql_text():
    d = dialect_named("mysql")
    assert d.quote_identifier("a`b") == "`a``b`"
    assert [d.quote_table(t) for t in ("depot.parcels", "parcels", "x.y.z")] == ["`depot`.`parcels`", "`parcels`", "`x`.`y.z`"]
    # These texts are what the database is sent.
    assert d.min_max_query("depot.parcels", "no") == "SELECT MIN(`no`), MAX(`no`) FROM `depot`.`parcels`"
    assert d.next_boundary_query("depot.parcels", "no", None, 11) == "SELECT `no` FROM `depot`.`parcels` ORDER BY `no` LIMIT 11, 1"
    assert d.next_boundary_query("depot.parcels", "no", None, 11, True) == "SELECT `no` FROM `depot`.`parcels` WHERE `no` IS NOT NULL ORDER BY `no` LIMIT 11, 1"
    assert d.next_boundary_query("depot.towns", "zip", "08x", 3) == "SELECT `zip` FROM `depot`.`towns` WHERE `zip` > ? ORDER BY `zip` LIMIT 3, 1"
    scan = d.split_scan_query
    assert scan("depot.parcels", "no", None, None, limit=9) == "SELECT * FROM `depot`.`parcels` LIMIT 9"
    assert scan("depot.parcels", "no", 4, 8, limit=9, offset=2) == "SELECT * FROM `depot`.`parcels` WHERE `no` > ? AND `no` <= ? LIMIT 9 OFFSET 2"
    assert scan("depot.parcels", "no", 4, None, offset=6).endswith(f" WHERE `no` > ? LIMIT {2**63 - 1} OFFSET 6")
    assert scan("depot.parcels", "no", None, 5, "`no`, `weight`") == "SELECT `no`, `weight` FROM `depot`.`parcels` WHERE `no` <= ?"
    assert "TABLE_SCHEMA = ?" in d.table_list_query() and "BASE TABLE" in d.table_list_query()
    assert "d''or" in d.primary_key_query("depot", "d'or") and "d''or" in d.column_meta_query("depot", "d'or")
    assert d.literal("a'b\\") == "'a''b\\\\'"
    assert dialect_named("derby").literal(dt.datetime(2020, 1, 2, 3, 4, 5, 6)) == "TIMESTAMP('2020-01-02 03:04:05.000006')"
    with pytest.raises(TypeError):
        d.literal(b"x")


def frames(spark):
    df = lambda lo, hi: spark.range(lo, hi).selectExpr("id", "id * 2 AS twice")
    return FrameRelation(spark, "db", {"orders": df(0, 100), "orders_archive": df(1000, 1060), "other": df(0, 5)}, {"orders": ["id", "twice"]})


def test_discovery(spark):
    rel = frames(spark)
    assert listed(opts(table_list=("orders", "x.y"))) == ["db.orders", "x.y"]
    assert matching(rel, r"db\.orders.*") == ["db.orders", "db.orders_archive"]
    assert matching(rel, r"db\.orders") == ["db.orders"] and matching(rel, r"other\..*") == []
    with pytest.raises(ValueError):
        listed(opts(table_list=("a", "db.a")))
    with pytest.raises(ValueError):
        discover_tables(rel, opts(table_list=(), table_pattern="nothing"))
    infos = discover_tables(rel, opts(table_list=("orders", "other")))
    assert [(t.full_name, t.split_key) for t in infos] == [("db.orders", "id"), ("db.other", "id")]
    scan = ChunkedScan(opts(table_list=(), table_pattern=r"db\.orders.*", chunk_size=20, fetch_size=5), rel)
    assert scan.load(spark).count() == 160
    by = {r[0]: r[1] for r in scan.load(spark, "src", "chunk").groupBy("src").agg({"chunk": "max"}).collect()}
    assert by == {"db.orders": 4, "db.orders_archive": 2}


def test_typed_projection(spark):
    df = spark.createDataFrame([(1, "12.345", 3, 90000), (2, "x", 300, None)], "a int, b string, c int, d long")
    got = typed_projection(df, types._parse_datatype_string("id bigint, amount decimal(4,2), small tinyint, span interval day to second"))
    rows = got.collect()
    assert (rows[0]["id"], rows[0]["amount"], rows[0]["small"], rows[0]["span"]) == (1, decimal.Decimal("12.35"), 3, dt.timedelta(seconds=90))
    assert (rows[1]["amount"], rows[1]["small"], rows[1]["span"]) == (None, None, None)

    with pytest.raises(TypeError):
        typed_projection(df, types._parse_datatype_string("a array<int>"))
    with pytest.raises(ValueError):
        typed_projection(df.select("a"), types._parse_datatype_string("a int, b int"))


def test_manifest_and_pruning():
    splits = splits_of("db.t", "k", [dt.datetime(2020, 1, 1), dt.datetime(2021, 1, 1)])
    state = Manifest(splits, complete=True)
    first, second = state.take(), state.take()
    state.progress(second.split_id, 42)
    state.give_back([first.split_id, second.split_id])
    again = Manifest.loads(state.dumps())
    assert list(again.pending) == [first, second.advanced(42), splits[2]] and again.complete
    again.take()
    again.finish("db.t#0")
    assert [s.split_id for s in Manifest.loads(again.dumps()).pending] == ["db.t#1", "db.t#2"]
    with pytest.raises(ValueError):
        Manifest.loads('{"version": 9}')
    ints = splits_of("t", "k", [10, 20, 30])
    assert [s.split_id for s in prune(ints, 11, 20)] == ["t#1"]
    assert [s.split_id for s in prune(ints, 10, 21)] == ["t#0", "t#1", "t#2"]
    assert prune(ints) == ints


def test_null_keys_and_resume(spark):
    df = spark.createDataFrame([(None, 1), (1, 2), (1, 3), (2, 4), (3, 5), (None, 6)], "k int, v int")
    parts = [sorted(r["v"] for r in s.read(df).collect()) for s in splits_of("t", "k", [1, 2])]
    assert parts == [[1, 2, 3, 6], [4], [5]]
    assert [r["v"] for r in Split("t#0", "t", "k", None, 2, 3).read(df).collect()] == [3, 4]


def test_derby(spark):
    url, rows = f"jdbc:derby:memory:x{uuid.uuid4().hex}", [(i, f"n'{i}", i % 3) for i in [*range(1, 11), *range(1000001, 1000011)]]
    jvm = spark.sparkContext._jvm
    spark.createDataFrame(rows, "id long, name string, kind int").coalesce(1).write.format("jdbc").options(url=f"{url};create=true", driver="org.apache.derby.jdbc.EmbeddedDriver", dbtable="T", createTableColumnTypes="name VARCHAR(20)").save()
    connection = jvm.java.sql.DriverManager.getConnection(url)
    connection.createStatement().execute('ALTER TABLE T ALTER COLUMN "id" NOT NULL')
    connection.createStatement().execute('ALTER TABLE T ADD PRIMARY KEY ("id")')
    connection.close()
    o = ScanOptions(url=url, database="APP", table_list=(), table_pattern=r"APP\..*", dialect="derby", chunk_size=10, fetch_size=2)
    rel = JdbcRelation(spark, o)
    (info,) = discover_tables(rel, o)
    assert (info.full_name, info.split_key) == ("APP.T", "id")
    assert [c for c, _ in rel.columns("T")] == ["id", "name", "kind"]
    splits = plan_splits(rel, info, o)
    assert [(s.start, s.end) for s in splits] == [(None, 10), (10, None)]
    df = scan_splits(rel, info, splits)
    assert df.rdd.getNumPartitions() == 2
    assert sorted(map(tuple, df.collect())) == sorted(rows)
    assert scan_table(rel, info, o, low=11).count() == 10
    plan = scan_table(rel, info, o).where("kind = 1").select("name")._jdf.queryExecution().toString()
    assert "PushedFilters: [*IsNotNull(kind), *EqualTo(kind,1)]" in plan and "ReadSchema: struct<name:string>" in plan
    by_name = ScanOptions(url=url, database="APP", table_list=("T",), dialect="derby", split_key_column="name", chunk_size=7)
    assert ChunkedScan(by_name).load(spark).count() == 20
    create_view(spark, "derby_view", {"url": url, "database": "APP", "table-list": "T", "dialect": "derby", "chunk-size": "5"})
    assert spark.sql("SELECT count(*) FROM derby_view").first()[0] == 20
    statement = f"CREATE OR REPLACE TEMPORARY VIEW derby_view (n int, label string) USING chunkscan OPTIONS ('url' '{url}', 'database' 'APP', 'table-list' 'T', 'dialect' 'derby', 'chunk-size' '6')"
    sql(spark, statement)
    view = sql(spark, "SELECT n FROM derby_view WHERE label = 'n''3'")
    assert [tuple(r) for r in view.collect()] == [(3,)]
    assert "ReadSchema: struct<id:bigint>" in sql(spark, "SELECT max(n) FROM derby_view")._jdf.queryExecution().toString()
    with pytest.raises(Exception, match="unknown options"):
        sql(spark, statement.replace("chunk-size", "colour"))


def derby(spark, table, ddl, rows):
    url = f"jdbc:derby:memory:y{uuid.uuid4().hex}"
    connection = spark.sparkContext._jvm.java.sql.DriverManager.getConnection(f"{url};create=true")
    connection.createStatement().execute(f"CREATE TABLE {table} ({ddl})")
    for row in rows:
        connection.createStatement().execute(f"INSERT INTO {table} VALUES ({row})")
    return url, connection


def test_views_are_no_tables(spark):
    url, connection = derby(spark, "BASE", "ID INT", ["1", "2"])
    connection.createStatement().execute("CREATE VIEW SHOWN AS SELECT * FROM BASE")
    connection.close()
    rel = JdbcRelation(spark, ScanOptions(url=url, database="APP", table_pattern="APP.*", dialect="derby"))
    assert rel.tables() == ["BASE"]
    spark.sql("CREATE DATABASE IF NOT EXISTS held")
    spark.range(5).write.mode("overwrite").saveAsTable("held.base")
    spark.sql("CREATE OR REPLACE VIEW held.shown AS SELECT * FROM held.base")
    spark.range(1).createOrReplaceTempView("passing")
    rel = CatalogRelation(spark, "held", {"base": ["id"]})
    assert rel.tables() == ["base"]
    scan = ChunkedScan(ScanOptions(url="catalog", database="held", table_pattern=r"held\..*", chunk_size=2), rel)
    assert sorted(map(tuple, scan.load(spark, chunk_column="c").collect())) == [(0, 0), (1, 0), (2, 1), (3, 1), (4, 2)]
    spark.sql("DROP DATABASE held CASCADE")


@pytest.mark.parametrize(
    "kind, shown, want",
    [
        ("TIMESTAMP", lambda i: f"TIMESTAMP('2024-01-0{i} 00:00:00.250000')", lambda i: dt.datetime(2024, 1, i, 0, 0, 0, 250000)),
        ("DATE", lambda i: f"DATE('2024-01-0{i}')", lambda i: dt.date(2024, 1, i)),
        ("DECIMAL(20,0)", lambda i: f"1844674407370955161{i}", lambda i: decimal.Decimal(18446744073709551610 + i)),
        ("VARCHAR(9)", lambda i: f"'k''{i}'", lambda i: f"k'{i}"),
    ],
)
def test_database_keys(spark, kind, shown, want):
    """NULL keys do not count, are read once, and bounds are bound to statements in their own type."""
    url, connection = derby(spark, "T", f"K {kind}, V INT", [f"{shown(i)}, {i}" for i in range(1, 8)] + ["NULL, 0", "NULL, 9"])
    connection.close()
    o = ScanOptions(url=url, database="APP", table_list=("T",), dialect="derby", chunk_size=3)
    rel = JdbcRelation(spark, o)
    (info,) = discover_tables(rel, o)
    splits = plan_splits(rel, info, o)
    assert [s.end for s in splits] == [want(3), want(6), None]
    assert sorted(r["V"] for r in scan_splits(rel, info, splits).collect()) == [0, *range(1, 8), 9]
    few = scan_splits(rel, info, splits, tasks=2)
    assert few.rdd.getNumPartitions() == 2 and few.count() == 9
    rest = scan_splits(rel, info, [splits[0].advanced(4), splits[2]])
    assert sorted(r["V"] for r in rest.collect()) == [3, 7]
    assert scan_splits(rel, info, []).count() == 0
    assert rel._connection is None


def test_lost_connection(spark):
    url, connection = derby(spark, "T", "K INT", ["1", "2"])
    rel = JdbcRelation(spark, ScanOptions(url=url, database="APP", table_list=("T",), dialect="derby", max_retries=1))
    assert rel.min_max("T", "K") == (1, 2)
    rel._connection.close()
    assert rel.min_max("T", "K") == (1, 2)
    with pytest.raises(Exception, match="MISSING"):
        rel.min_max("MISSING", "K")


def test_merged():
    splits = splits_of("t", "k", [10, 20, 30])
    assert [(s.start, s.end) for s in merged([splits[3], splits[0], splits[1]])] == [(None, 20), (30, None)]
    assert [(s.start, s.end) for s in merged(splits)] == [(None, None)] and merged([]) == []
    with pytest.raises(ValueError):
        merged([splits[0].advanced(1)])


def test_resume_and_drain(spark):
    rel = frames(spark)
    scan = ChunkedScan(opts(table_list=("orders", "orders_archive"), chunk_size=20), rel)
    state = scan.manifest(spark)
    assert [s.split_id for s in state.pending] == [f"db.orders#{k}" for k in range(5)] + [f"db.orders_archive#{k}" for k in range(3)]
    seen, saved = [], []

    def sink(df):
        if len(saved) == 1:
            raise RuntimeError("no room")
        seen.extend(r["id"] for r in df.collect())

    with pytest.raises(RuntimeError):
        scan.drain(spark, state, sink, at_once=3, save=saved.append)
    assert sorted(seen) == list(range(60)) and len(saved) == 2
    again = Manifest.loads(saved[-1])
    assert [s.split_id for s in again.pending][:2] == ["db.orders#3", "db.orders#4"] and not again.taken
    rest = [*range(60, 100), *range(1000, 1060)]
    assert sorted(r["id"] for r in scan.resume(spark, again).collect()) == rest
    seen.clear()
    scan.drain(spark, again, lambda df: seen.extend(r["id"] for r in df.collect()), at_once=2)
    assert sorted(seen) == rest and not again.pending
    assert scan.resume(spark, again).count() == 0
    # Tables that were not wholly cut: the scan starts over.
    assert scan.resume(spark, Manifest(splits_of("db.orders", "id", [5]))).count() == 160
    seen.clear()
    scan.drain(spark, Manifest(), lambda df: seen.extend(r["id"] for r in df.collect()))
    assert len(seen) == 160
    with pytest.raises(ValueError):
        scan.resume(spark, Manifest(splits_of("db.strange", "id", []), complete=True))

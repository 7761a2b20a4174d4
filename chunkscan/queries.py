"""Queries of the table-reading layer and their SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chunkscan.functions.formatting import format_row
from chunkscan.functions.schema import typed_projection
from chunkscan.operators.boundaries import arithmetic_chunks, boundaries, boundaries_unique, key_min_max
from chunkscan.operators.scan import ChunkedScan, plan_splits, scan_splits, scan_table
from chunkscan.operators.splits import Split, assign_split, split_frame, split_row_counts, splits_of
from chunkscan.plans.manifest import Manifest
from chunkscan.plans.pruning import prune
from chunkscan.sources import discovery
from chunkscan.sources.datasource import register, sql
from chunkscan.sources.embedded import database
from chunkscan.sources.options import ScanOptions
from chunkscan.sources.relations import FrameRelation, JdbcRelation, ParquetRelation

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

DATABASE = "sf"
#: Split keys of the tables; those of composite keys are the first columns.
KEYS = {
    "region": ["r_regionkey"], "nation": ["n_nationkey"], "customer": ["c_custkey"], "supplier": ["s_suppkey"], "part": ["p_partkey"],
    "orders": ["o_orderkey"], "lineitem": ["l_orderkey", "l_linenumber"], "events": ["event_id"], "documents": ["doc_id"],
    "embeddings": ["vec_id"], "pages": ["page_id"], "benchmark": ["item_id"], "labels": ["doc_id"], "conversations": ["conv_id", "turn"],
}
CHUNK = 1024


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def put(f: Query) -> Query:
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return put


def relation(spark: SparkSession, sf_dir: str) -> ParquetRelation:
    return ParquetRelation(spark, sf_dir, DATABASE, KEYS, sorted(KEYS))


def options(**more) -> ScanOptions:
    more = {"url": "files", "database": DATABASE, "chunk_size": CHUNK} | more
    return ScanOptions(**({"table_list": ("orders",)} | more if "table_pattern" not in more else more))


def frame(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return relation(spark, sf_dir).df(table)


# Boundaries


def _min_max(table: str, key: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return key_min_max(frame(spark, sf_dir, table), key)


for _name, _table, _key in [("int", "orders", "o_orderkey"), ("string", "customer", "c_name"), ("timestamp", "events", "ts"), ("double", "orders", "o_totalprice")]:
    query(f"key_min_max_{_name}", f"SELECT min({_key}) AS min_key, max({_key}) AS max_key FROM {_table}")(partial(_min_max, _table, _key))


def walk_sql(table: str, key: str, n: int, mode: str, select: str = "SELECT CAST(idx AS BIGINT) AS idx, b AS boundary FROM ends") -> str:
    """The ends of chunks in SQL: ``ends`` (idx, b)."""
    off = n - 1 if mode == "exact" else n
    last = "AND p < (SELECT max(cum_n) FROM cum)" if mode == "exact" else ""
    return f"""
WITH RECURSIVE cum AS (SELECT k, CAST(sum(c) OVER (ORDER BY k) AS BIGINT) AS cum_n
                       FROM (SELECT {key} AS k, count(*) AS c FROM {table} WHERE {key} IS NOT NULL GROUP BY 1)),
  walk AS (SELECT 0 AS idx, min(k) AS b, min(cum_n) AS p FROM cum WHERE cum_n > {off}
           UNION ALL SELECT w.idx + 1, min(c.k), min(c.cum_n) FROM walk w JOIN cum c ON c.cum_n > w.p + {off} GROUP BY w.idx),
  ends AS (SELECT idx, b FROM walk WHERE b IS NOT NULL {last}),
  chunks AS (SELECT idx, lag(b) OVER (ORDER BY idx) AS lo, b AS hi FROM ends
             UNION ALL SELECT coalesce(max(idx) + 1, 0), max(b), NULL FROM ends)
{select}"""


# Scans


def _scan(table: str, spark: SparkSession, sf_dir: str, chunk: int = CHUNK) -> DataFrame:
    opts = options(table_list=(table,), chunk_size=chunk)
    return ChunkedScan(opts, relation(spark, sf_dir)).load(spark, chunk_column="chunk")


def scan_sql(table: str, chunk: int = CHUNK) -> str:
    """Each row of a table and the chunk that its key is in."""
    key = KEYS[table][0]
    return walk_sql(table, key, chunk, "exact", f"SELECT t.*, CAST(idx AS BIGINT) AS chunk FROM {table} t JOIN chunks ON (lo IS NULL OR {key} > lo) AND (hi IS NULL OR {key} <= hi)")


for _table in KEYS:
    query(f"chunked_scan_{_table}", scan_sql(_table))(partial(_scan, _table))
query("chunked_scan_default_sizes", scan_sql("orders", 8096))(partial(_scan, "orders", chunk=8096))


def _bounds(table: str, key: str, mode: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return boundaries(frame(spark, sf_dir, table), key, CHUNK, mode)


for _mode in ("exact", "skip"):
    for _name, _table, _key in [("unique_int", "orders", "o_orderkey"), ("dup_int", "lineitem", "l_orderkey"), ("string", "part", "p_name"), ("timestamp", "events", "ts"), ("double", "events", "value")]:
        query(f"boundaries_{_mode}_{_name}", walk_sql(_table, _key, CHUNK, _mode))(partial(_bounds, _table, _key, _mode))


@query("boundaries_by_row_number", walk_sql("orders", "o_orderkey", CHUNK, "exact"))
def _by_row_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    return boundaries_unique(frame(spark, sf_dir, "orders"), "o_orderkey", CHUNK)


# Splits

_SPLIT_COLUMNS = "SELECT '{t}#' || idx AS split_id, CAST(idx AS BIGINT) AS idx, '{t}' AS table_name, '{k}' AS split_key, lo AS split_start, hi AS split_end, CAST(0 AS BIGINT) AS split_offset FROM chunks"


def _splits(mode: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_frame(frame(spark, sf_dir, "orders"), "sf.orders", "o_orderkey", CHUNK, mode)


for _mode in ("exact", "skip"):
    query(f"splits_{_mode}_orders", walk_sql("orders", "o_orderkey", CHUNK, _mode, _SPLIT_COLUMNS.format(t="sf.orders", k="o_orderkey")))(partial(_splits, _mode))


def _few(where: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    df = frame(spark, sf_dir, "region").where(where)
    return split_frame(df, "sf.region", "r_regionkey", 5)


for _name, _where in [("empty", "r_regionkey < 0"), ("small", "r_regionkey < 3"), ("exact_multiple", "r_regionkey >= 0")]:
    query(f"splits_{_name}", "SELECT 'sf.region#0' AS split_id, CAST(0 AS BIGINT) AS idx, 'sf.region' AS table_name, 'r_regionkey' AS split_key, CAST(NULL AS INT) AS split_start, CAST(NULL AS INT) AS split_end, CAST(0 AS BIGINT) AS split_offset")(partial(_few, _where))


@query("splits_multi_table", walk_sql("nation", "n_nationkey", 5, "exact", _SPLIT_COLUMNS.format(t="sf.nation", k="n_nationkey")) + " UNION ALL SELECT 'sf.region#0', 0, 'sf.region', 'r_regionkey', NULL, NULL, 0")
def _splits_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    rel = relation(spark, sf_dir)
    found = discovery.discover_tables(rel, options(table_list=("nation", "sf.region")))
    one, two = (split_frame(rel.df(t.table), t.full_name, t.split_key, 5) for t in found)
    return one.union(two)


def _counts(table: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_row_counts(frame(spark, sf_dir, table), f"sf.{table}", KEYS[table][0], CHUNK)


for _table in ("orders", "lineitem"):
    _key = KEYS[_table][0]
    query(
        f"split_row_counts_{_table}",
        walk_sql(_table, _key, CHUNK, "exact", f"SELECT 'sf.{_table}#' || idx AS split_id, count(*) AS n_rows FROM chunks JOIN {_table} ON (lo IS NULL OR {_key} > lo) AND (hi IS NULL OR {_key} <= hi) GROUP BY idx"),
    )(partial(_counts, _table))


@query("assign_split_lineitem", walk_sql("lineitem", "l_orderkey", 100, "exact", "SELECT l_orderkey, l_linenumber, l_partkey, CAST(idx AS BIGINT) AS split_index FROM lineitem JOIN chunks ON (lo IS NULL OR l_orderkey > lo) AND (hi IS NULL OR l_orderkey <= hi)"))
def _assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = frame(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return assign_split(df, "l_orderkey", 100, name="split_index")


# Reading splits


def _split(start: int | None, end: int | None, spark: SparkSession, sf_dir: str) -> DataFrame:
    return Split("sf.orders#0", "sf.orders", "o_orderkey", start, end).read(frame(spark, sf_dir, "orders"))


for _name, _start, _end, _where in [("sole", None, None, "TRUE"), ("first", None, 1000, "o_orderkey <= 1000"), ("middle", 1000, 2000, "o_orderkey > 1000 AND o_orderkey <= 2000"), ("last", 9000, None, "o_orderkey > 9000")]:
    query(f"split_scan_{_name}", f"SELECT * FROM orders WHERE {_where}")(partial(_split, _start, _end))


@query("split_scan_columns", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey > 1000 AND o_orderkey <= 2000")
def _columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Split("sf.orders#1", "sf.orders", "o_orderkey", 1000, 2000).read(frame(spark, sf_dir, "orders"), ["o_orderkey", "o_orderstatus"])


@query("split_scan_limit", "SELECT * FROM orders WHERE o_orderkey > 1000 ORDER BY o_orderkey LIMIT 256")
def _limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Split("sf.orders#1", "sf.orders", "o_orderkey", 1000).read(frame(spark, sf_dir, "orders").orderBy("o_orderkey"), limit=256)


_LINE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]


@query("split_resume_offset", f"SELECT {', '.join(_LINE)} FROM lineitem WHERE l_orderkey > 1000 AND l_orderkey <= 5000 ORDER BY {', '.join(_LINE)} OFFSET 512")
def _resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Split("sf.lineitem#1", "sf.lineitem", "l_orderkey", 1000, 5000, 512).read(frame(spark, sf_dir, "lineitem").select(*_LINE))


_NULLED = "SELECT o_custkey, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderkey END AS k FROM orders"


@query("null_key_scan", _NULLED)
def _null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = frame(spark, sf_dir, "orders").selectExpr("o_custkey", "CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderkey END AS k")
    scan = ChunkedScan(options(split_key_column="k", chunk_size=4096), FrameRelation(spark, DATABASE, {"orders": df}))
    return scan.resume(spark, scan.manifest(spark))


# Discovery


@query("discover_list", "SELECT 0 AS place, 'sf.orders' AS full_name, count(*) AS n_rows FROM orders UNION ALL SELECT 1, 'sf.events', count(*) FROM events UNION ALL SELECT 2, 'sf.nation', count(*) FROM nation")
def _listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rel = relation(spark, sf_dir)
    found = discovery.discover_tables(rel, options(table_list=(" orders, sf.events ", "", "nation")))
    counts = [rel.df(t.table).agg(F.lit(k).alias("place"), F.lit(t.full_name).alias("full_name"), F.count(F.lit(1)).alias("n_rows")) for k, t in enumerate(found)]
    return reduce(DataFrame.union, counts)


def _matching(pattern: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    names = discovery.matching(relation(spark, sf_dir), pattern)
    return spark.createDataFrame([(n,) for n in names], "full_name string")


_ALL = ", ".join(f"('sf.{t}')" for t in KEYS)
for _name, _pattern in [("discover_regex", r"sf\..*n.*"), ("discover_regex_narrow", r"sf\.order.")]:
    query(_name, f"SELECT full_name FROM (VALUES {_ALL}) t(full_name) WHERE regexp_full_match(full_name, '{_pattern}')")(partial(_matching, _pattern))


@query("split_key_resolution", "SELECT * FROM (VALUES ('override', 'o_custkey'), ('primary', 'o_orderkey'), ('composite', 'l_orderkey'), ('first', 'event_id')) t(rule, split_key)")
def _keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    rel = relation(spark, sf_dir)
    bare = ParquetRelation(spark, sf_dir, DATABASE)
    rows = [
        ("override", discovery.split_key(rel, "orders", "o_custkey")), ("primary", discovery.split_key(rel, "orders")),
        ("composite", discovery.split_key(rel, "lineitem")), ("first", discovery.split_key(bare, "events")),
    ]
    return spark.createDataFrame(rows, "rule string, split_key string")


@query("table_info", "SELECT * FROM (VALUES ('sf', 'orders', 'sf.orders', 'o_orderkey', 'bigint'), ('sf', 'nation', 'sf.nation', 'n_nationkey', 'int')) t(database_name, table_name, full_name, split_key, key_type)")
def _info(spark: SparkSession, sf_dir: str) -> DataFrame:
    rel = relation(spark, sf_dir)
    return discovery.as_frame(rel, discovery.discover_tables(rel, options(table_list=("orders", "nation"))))


@query("column_metadata", "SELECT * FROM (VALUES (1, 'n_nationkey', 'int'), (2, 'n_name', 'string'), (3, 'n_regionkey', 'int')) t(ordinal, column_name, data_type)")
def _metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return discovery.column_metadata(relation(spark, sf_dir), "nation")


# Many tables


def _halves(spark: SparkSession, sf_dir: str) -> FrameRelation:
    df = frame(spark, sf_dir, "orders")
    old = F.col("o_orderdate") < F.lit("1995-01-01").cast("timestamp_ntz")
    frames = {"orders": df.where(~old), "orders_archive": df.where(old), "nation": frame(spark, sf_dir, "nation")}
    return FrameRelation(spark, DATABASE, frames, {"orders": ["o_orderkey"], "orders_archive": ["o_orderkey"]})


@query("multi_table_list", "SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '1995-01-01' UNION ALL SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1995-01-01'")
def _many(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ChunkedScan(options(table_list=("orders", "orders_archive")), _halves(spark, sf_dir)).load(spark)


@query("multi_table_regex", "SELECT *, CASE WHEN o_orderdate >= TIMESTAMP '1995-01-01' THEN 'sf.orders' ELSE 'sf.orders_archive' END AS _source_table FROM orders")
def _many_regex(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ChunkedScan(options(table_pattern=r"sf\.orders.*"), _halves(spark, sf_dir)).load(spark, source_column="_source_table")


# Types


def _typed(columns: list[str], declared: str, table: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return typed_projection(frame(spark, sf_dir, table).select(*columns), T._parse_datatype_string(declared))


for _name, _table, _columns_, _declared, _sql in [
    ("numeric", "lineitem", ["l_orderkey", "l_linenumber", "l_quantity", "l_tax"], "a int, b smallint, c bigint, d float", "SELECT CAST(l_orderkey AS INT) AS a, CAST(l_linenumber AS SMALLINT) AS b, CAST(trunc(l_quantity) AS BIGINT) AS c, CAST(l_tax AS FLOAT) AS d FROM lineitem"),
    ("decimal", "orders", ["o_orderkey", "o_totalprice"], "k bigint, price decimal(7,2)", "SELECT o_orderkey AS k, TRY_CAST(o_totalprice AS DECIMAL(7,2)) AS price FROM orders"),
    ("temporal", "events", ["event_id", "ts", "ts"], "id bigint, day date, at timestamp_ntz", "SELECT event_id AS id, CAST(ts AS DATE) AS day, ts AS at FROM events"),
    ("string_binary", "events", ["event_id", "event_type", "event_type"], "id string, kind string, raw binary", "SELECT CAST(event_id AS VARCHAR) AS id, event_type AS kind, encode(event_type) AS raw FROM events"),
]:
    query(f"typed_projection_{_name}", _sql)(partial(_typed, _columns_, _declared, _table))


@query("format_row", "SELECT n_nationkey || '|' || n_name || '|' || n_regionkey AS line FROM nation")
def _format(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = frame(spark, sf_dir, "nation")
    return df.select(format_row(df).alias("line"))


# SQL


def _ddl(sf_dir: str) -> tuple[str, str]:
    name = f"orders_{uuid.uuid4().hex}"
    return name, f"CREATE TEMPORARY VIEW {name} USING chunkscan OPTIONS ('url' '{sf_dir}', 'database' 'sf', 'table-list' 'orders', 'chunk-size' '{CHUNK}', 'split-key-column' 'o_orderkey')"


def _view(spark: SparkSession, sf_dir: str) -> str:
    name, ddl = _ddl(sf_dir)
    sql(spark, ddl)
    return name


_GROUPED = "SELECT o_orderstatus, count(*) AS n, min(o_orderkey) AS least FROM {} WHERE o_orderkey > 5000 GROUP BY 1"


@query("sql_python_source", _GROUPED.format("orders"))
def _python_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same statement given to Spark itself: chunks are read by Python workers."""
    register(spark)
    name, ddl = _ddl(sf_dir)
    spark.sql(ddl)
    return spark.sql(_GROUPED.format(name))


@query("sql_view_count", "SELECT count(*) AS n FROM orders")
def _view_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(f"SELECT count(*) AS n FROM {_view(spark, sf_dir)}")


@query("sql_view_group_by", _GROUPED.format("orders"))
def _view_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(_GROUPED.format(_view(spark, sf_dir)))


@query("sql_view_typed", "SELECT CAST(o_orderkey AS INT) AS k, CAST(o_custkey AS VARCHAR) AS customer FROM orders")
def _view_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, ddl = _ddl(sf_dir)
    sql(spark, ddl.replace(" USING", " (k int, customer string) USING"))
    return spark.table(name)


@query("pushdown_filter_project", "SELECT o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_orderkey BETWEEN 1000 AND 3000")
def _pushdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    rel = relation(spark, sf_dir)
    (info,) = discovery.discover_tables(rel, options())
    return scan_table(rel, info, options(), low=1000, high=3000).where("o_orderstatus = 'F'").select("o_custkey", "o_totalprice")


@query("pruned_splits", walk_sql("orders", "o_orderkey", CHUNK, "exact", "SELECT 'sf.orders#' || idx AS split_id FROM chunks WHERE (hi IS NULL OR hi >= 5000) AND (lo IS NULL OR lo < 9000)"))
def _pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    ends = [r["boundary"] for r in boundaries(frame(spark, sf_dir, "orders"), "o_orderkey", CHUNK).orderBy("idx").collect()]
    kept = prune(splits_of("sf.orders", "o_orderkey", ends), 5000, 9000)
    return spark.createDataFrame([(s.split_id,) for s in kept], "split_id string")


@query(
    "arith_vs_chunk_skew",
    walk_sql("(SELECT o_orderkey * o_orderkey AS k FROM orders)", "k", CHUNK, "exact", """, t AS (SELECT o_orderkey * o_orderkey AS k FROM orders),
  by_chunk AS (SELECT idx, count(k) AS n FROM chunks LEFT JOIN t ON (lo IS NULL OR k > lo) AND (hi IS NULL OR k <= hi) GROUP BY idx),
  m AS (SELECT min(k) AS lo, max(k) AS hi, (SELECT count(*) FROM chunks) AS c FROM t),
  by_width AS (SELECT least(CAST(floor((k - lo) / ((hi - lo) / c)) AS BIGINT), c - 1) AS i, count(*) AS n FROM t, m GROUP BY 1)
SELECT (SELECT count(*) FROM by_chunk) AS chunks, (SELECT max(n) FROM by_chunk) AS largest_by_rows, (SELECT max(n) FROM by_width) AS largest_by_width,
       (SELECT c FROM m) - (SELECT count(*) FROM by_width) AS empty_by_width"""),
)
def _skew(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = frame(spark, sf_dir, "orders").select((F.col("o_orderkey") * F.col("o_orderkey")).alias("k"))
    counts = split_row_counts(df, "t", "k", CHUNK)
    summary = counts.agg(F.count(F.lit(1)).alias("chunks"), F.max("n_rows").alias("largest_by_rows"))
    n = summary.first()["chunks"]
    width = arithmetic_chunks(df, "k", n).agg(F.max("n_rows").alias("largest_by_width"), F.count(F.when(F.col("n_rows") == 0, 1)).alias("empty_by_width"))
    (rows,), (widths,) = summary.collect(), width.collect()
    return spark.createDataFrame([(*rows, *widths)], "chunks long, largest_by_rows long, largest_by_width long, empty_by_width long")


@query(
    "resume_manifest",
    walk_sql("orders", "o_orderkey", 256, "exact", "SELECT o_orderkey, o_custkey FROM (SELECT o.*, idx, row_number() OVER (PARTITION BY idx ORDER BY o_orderkey) AS r FROM orders o JOIN chunks ON (lo IS NULL OR o_orderkey > lo) AND (hi IS NULL OR o_orderkey <= hi)) WHERE idx <> 1 AND (idx <> 2 OR r > 100)"),
)
def _manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A scan that stopped: one split is done, one is read to its hundredth row, one failed, the others were not begun."""
    scan = ChunkedScan(options(chunk_size=256), relation(spark, sf_dir))
    state = scan.manifest(spark)
    failed, done, begun = state.take(), state.take(), state.take()
    state.finish(done.split_id)
    state.progress(begun.split_id, 100)
    state.give_back([failed.split_id])
    return scan.resume(spark, Manifest.loads(state.dumps())).select("o_orderkey", "o_custkey")


# Databases


_ORDERS = "o_orderkey BIGINT, o_orderstatus VARCHAR(8), o_orderpriority VARCHAR(32)"


@query("jdbc_roundtrip_orders", "SELECT * FROM orders")
def _derby(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders into an embedded database, found by its key there, cut, read by one query a chunk."""
    url = database(frame(spark, sf_dir, "orders"), "ORDERS", "o_orderkey", _ORDERS)
    opts = ScanOptions(url=url, database="APP", table_list=("ORDERS",), dialect="derby", chunk_size=4096)
    rel = JdbcRelation(spark, opts)
    (info,) = discovery.discover_tables(rel, opts)
    return scan_splits(rel, info, plan_splits(rel, info, opts))


@query("sql_view_database", _GROUPED.format("orders"))
def _derby_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = database(frame(spark, sf_dir, "orders"), "ORDERS", "o_orderkey", _ORDERS)
    name = f"orders_{uuid.uuid4().hex}"
    sql(spark, f"CREATE TEMPORARY VIEW {name} USING chunkscan OPTIONS ('url' '{url}', 'database' 'APP', 'table-pattern' 'APP\\.ORD.*', 'dialect' 'derby', 'chunk-size' '4096')")
    return spark.sql(_GROUPED.format(name))


#: Column, expression on orders, its key ``id`` and a number ``n`` (both engines read it), type in the database (all but CHAR and
#: VARCHAR are those that the writer picks), declared type.
_WIDE = [
    ("id", "id", "BIGINT", "bigint"),
    ("tiny", "CAST(n AS TINYINT)", "SMALLINT", "tinyint"),
    ("small", "CAST(n * 100 AS SMALLINT)", "SMALLINT", "smallint"),
    ("whole", "CAST(o_custkey AS INT)", "INTEGER", "int"),
    ("big", "id * 1000003", "BIGINT", "bigint"),
    ("unsigned_big", "CAST(CAST(18446744073709551615 AS DECIMAL(20,0)) - CAST(id AS DECIMAL(19,0)) AS DECIMAL(20,0))", "DECIMAL(20,0)", "decimal(20,0)"),
    ("price", "CAST(o_totalprice AS DECIMAL(12,2))", "DECIMAL(12,2)", "decimal(12,2)"),
    ("ratio", "CAST(n / 4.0 AS FLOAT)", "REAL", "float"),
    ("share", "CAST(o_totalprice AS DOUBLE)", "DOUBLE", "double"),
    ("flag", "n = 1", "BOOLEAN", "boolean"),
    ("bits", "CAST(n % 2 AS SMALLINT)", "SMALLINT", "boolean"),
    ("code", "o_orderstatus", "CHAR(1)", "string"),
    ("name", "concat('line ', CAST(n AS STRING), ' it''s')", "VARCHAR(64)", "string"),
    ("note", "concat(o_orderstatus, '|', o_orderpriority)", "CLOB", "string"),
    ("doc", "concat('{\"n\":', CAST(n AS STRING), '}')", "CLOB", "string"),
    ("day", "CAST(o_orderdate AS DATE)", "DATE", "date"),
    ("at", "o_orderdate + INTERVAL 1 MINUTE", "TIMESTAMP", "timestamp_ntz"),
    ("nothing", "CAST(NULL AS INT)", "INTEGER", "int"),
    ("some", "CASE WHEN n = 2 THEN NULL ELSE o_orderpriority END", "CLOB", "string"),
    ("status", "o_orderpriority", "VARCHAR(32)", "string"),
]
_WIDE_FROM = ["*", "CAST(o_orderkey AS BIGINT) AS id", "CAST(o_custkey % 7 AS INT) AS n"]


@query("jdbc_wide_types", f"SELECT {', '.join(('(' + e + ') <> 0' if n == 'bits' else e) + ' AS ' + n for n, e, _, _ in _WIDE)} FROM (SELECT {', '.join(_WIDE_FROM)} FROM orders)")
def _wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A database table of twenty columns, read by declared types and cut by its key."""
    df = frame(spark, sf_dir, "orders").selectExpr(*_WIDE_FROM).selectExpr(*[f"{e} AS {n}" for n, e, _, _ in _WIDE])
    url = database(df, "WIDE", "id", ", ".join(f"{n} {t}" for n, _, t, _ in _WIDE if "CHAR" in t))
    opts = ScanOptions(url=url, database="APP", table_list=("WIDE",), dialect="derby", chunk_size=500)
    return ChunkedScan(opts, schema=T._parse_datatype_string(", ".join(f"{n} {t}" for n, _, _, t in _WIDE))).load(spark)

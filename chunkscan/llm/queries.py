"""The registered queries of the operators here, each over its whole table, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from chunkscan.llm.common import held_out, table
from chunkscan.llm.decontaminate import contamination
from chunkscan.llm.exact_dedup import exact_dedup
from chunkscan.llm.language_id import fit_language_model, predict_language
from chunkscan.llm.lm_score import score_texts
from chunkscan.llm.near_dedup import near_duplicates
from chunkscan.llm.packing import pack_documents
from chunkscan.llm.secrets import scan_secrets
from chunkscan.llm.sharding import extendible_shards
from chunkscan.llm.suffix_dedup import repeated_spans
from chunkscan.llm.toxicity import fit_toxicity, predict_toxicity

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@query
def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


ORACLES["op6_exact_dedup"] = r"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)
"""


SHARD_BYTES = 1 << 20


@query
def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extendible_shards(table(spark, sf_dir, "documents"), SHARD_BYTES)


ORACLES["op3_sharding"] = f"""
WITH t AS (SELECT doc_id, coalesce(strlen(text), 0) AS bytes,
                  CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 15) AS BIGINT) AS h FROM documents),
  sums AS (SELECT d AS depth, h >> CAST(60 - d AS INT) AS prefix, CAST(sum(bytes) AS BIGINT) AS shard_bytes, count(*) AS shard_rows
           FROM t, range(0, 41) r(d) GROUP BY ALL),
  picked AS (SELECT doc_id, depth, prefix, shard_bytes, shard_rows FROM t JOIN sums ON h >> CAST(60 - depth AS INT) = prefix
             WHERE shard_bytes <= {SHARD_BYTES} OR shard_rows = 1
             QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY depth) = 1)
SELECT doc_id, CASE WHEN depth = 0 THEN '' ELSE lpad(bin(prefix), CAST(depth AS INT), '0') END AS shard, CAST(depth AS INT) AS depth,
       shard_bytes, shard_rows, shard_bytes > {SHARD_BYTES} AS oversized FROM picked
"""


@query
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = held_out("doc_id", 3, 1)
    return predict_language(docs, fit_language_model(docs, ~held), held)


@query
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held = held_out("doc_id", 5, 0)
    return predict_toxicity(docs, fit_toxicity(docs, labels, ~held), held)


@query
def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLES["op10_decontaminate"] = r"""
WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
  b AS (SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
  win AS (SELECT DISTINCT item_id, array_to_string(w[i:i + 9], ' ') AS g, least(len(w), 10) AS k
          FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
  place AS (SELECT doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') AS g
         FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (SELECT DISTINCT k FROM win))),
  hit AS (SELECT doc_id, item_id, i, k FROM place JOIN win USING (g, k)),
  n AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hit) GROUP BY 1),
  its AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY 1)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN its USING (doc_id)
"""


@query
def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents"))


@query
def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


ORACLES["op4_near_dedup"] = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
  s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
        FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
  n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
  pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
  links AS (SELECT x, y FROM pairs p JOIN n m ON m.doc_id = x JOIN n o ON o.doc_id = y WHERE 100 * c >= 75 * (m.n + o.n - c)),
  edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
  reach AS (SELECT DISTINCT x AS doc_id, x AS r FROM edges UNION SELECT reach.doc_id, y FROM reach JOIN edges ON r = x)
SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(component_id, doc_id) AS component_id, coalesce(component_id, doc_id) = doc_id AS kept
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY 1) USING (doc_id)
"""


@query
def op5_packing(spark: SparkSession, sf_dir: str, tokenizer_path: str | None = None) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_path or TOKENIZER)


@query
def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_spans(table(spark, sf_dir, "documents")).drop("starts", "ends")


@query
def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"), held_out("doc_id", 7, 2))

"""From documents to packed training sequences, in five stages.

Toxic texts go, of equal texts one stays, of each near-duplicate group one stays, texts that hold a
benchmark passage go, and what is left is packed. Each stage sees all rows and whole texts that the
one before kept, and all but the last return the columns of ``documents``. Ids may be null or repeat:
verdicts are on rows, which get written keys in the order of their ids (null last).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkscan.llm.common import ROW, cut, held_out, numbered, table
from chunkscan.llm.decontaminate import contamination
from chunkscan.llm.exact_dedup import exact_dedup, keep_rows
from chunkscan.llm.near_dedup import near_duplicates
from chunkscan.llm.packing import pack_documents
from chunkscan.llm.queries import TOKENIZER
from chunkscan.llm.toxicity import drop_toxic, fit_toxicity


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts whose score is 0.5 or more; learns from the labels' training fold."""
    labels = table(spark, sf_dir, "labels")
    return drop_toxic(docs, fit_toxicity(docs, labels, ~held_out("doc_id", 5, 0)))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts keeps the one with the least id."""
    rows = numbered(docs)
    return keep_rows(rows, exact_dedup(rows, ROW).select("doc_id", "kept"), ROW).drop(ROW)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near duplicates keeps the one with the least id."""
    rows = numbered(docs)
    return keep_rows(rows, near_duplicates(rows, ROW).select("doc_id", "kept"), ROW).drop(ROW)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts in which a window of a benchmark item occurs."""
    rows = numbered(docs)
    found = contamination(rows, table(spark, sf_dir, "benchmark"), ROW)
    return keep_rows(rows, found.select("doc_id", (~F.col("contaminated")).alias("kept")), ROW).drop(ROW)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a text: its sequence and place there."""
    return pack_documents(docs, TOKENIZER)


STAGES = [("toxicity", toxicity), ("exact", exact), ("near", near), ("decontamination", decontamination), ("packing", packing)]

#: No SQL expresses the learnt first stage; the tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each one's rows written and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = cut(docs)
    return docs

"""Sharding by extendible hashing, DataFrame functions only.

The directory is indexed by leading bits of a hash. A bucket over the byte limit splits on its next
bit; all others stay as they are, so each shard's depth is local. One histogram at a depth somewhat
beyond the mean decides all shallower splits at once; only rows of buckets that are too large even
there are looked at again, deeper.

Odd cases: a null text has 0 bytes; a row larger than the limit ends in a shard marked
``oversized``, the shallowest in which it is alone; rows that share an id (null ids too) have the same first 60 bits, so an oversized
group of them goes on splitting on 60 bits drawn from text and row number; an empty table gives an
empty result; other columns are not looked at.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chunkscan.llm.common import cut

HASH_BITS = 60
#: Depth of a histogram beyond log2(bytes / limit), and how much deeper each further one goes.
EXTRA_BITS, STEP_BITS = 4, 12


def _bits(text: Column) -> Column:
    """The first 60 bits of the MD5 of ``text``."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("long")


def _name(prefix: Column, depth: Column) -> Column:
    return F.when(depth == 0, F.lit("")).otherwise(F.lpad(F.bin(prefix), depth, F.lit("0")))


def _leaves(rows: DataFrame, known: int, depth: int, limit: int) -> tuple[DataFrame, DataFrame]:
    """Of ``rows`` (h, bytes), whose buckets at ``known`` bits are too large (0: none is known yet):

    (fine, depth, prefix, shard_bytes, shard_rows) for buckets at ``depth`` bits that are in a shard
    now, and (fine, shard_rows) for those still too large.
    """
    fine = F.shiftright("h", HASH_BITS - depth)
    hist = cut(rows.groupBy(fine.alias("fine")).agg(F.sum("bytes").alias("b"), F.count(F.lit(1)).alias("n")))
    first = known if known == 0 else known + 1
    steps = F.sequence(F.lit(first), F.lit(depth))
    climbed = hist.select("fine", "b", "n", F.explode(steps).alias("depth"))
    climbed = climbed.withColumn("prefix", F.expr(f"shiftright(fine, {depth} - depth)"))
    sums = climbed.groupBy("depth", "prefix").agg(F.sum("b").alias("shard_bytes"), F.sum("n").alias("shard_rows"))
    fits = sums.where((F.col("shard_bytes") <= limit) | (F.col("shard_rows") == 1))
    over = sums.where((F.col("shard_bytes") > limit) & (F.col("shard_rows") > 1)).select((F.col("depth") + 1).alias("depth"), F.col("prefix").alias("parent"))
    # A bucket that fits is a shard if its parent is too large; known buckets are.
    under = fits.withColumn("parent", F.shiftright("prefix", 1)).join(over.withColumn("split", F.lit(True)).hint("merge"), ["depth", "parent"], "left")
    shards = under.where(F.col("split") | (F.col("depth") == first)).select("depth", "prefix", "shard_bytes", "shard_rows")
    found = climbed.select("fine", "depth", "prefix").join(shards.hint("merge"), ["depth", "prefix"])
    left = hist.join(found.select("fine").hint("merge"), "fine", "left_anti").select("fine", F.col("n").alias("shard_rows"))
    return found, left


def extendible_shards(docs: DataFrame, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, shard (its prefix bits), depth, shard_bytes, shard_rows, oversized."""
    if limit < 1:
        raise ValueError("the byte limit must be positive")
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = cut(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.octet_length(text).cast("long").alias("bytes"),
            _bits(F.coalesce(F.col(id_col).cast("string"), F.lit(""))).alias("h"),
            _bits(F.concat_ws(":", F.md5(text.cast("binary")), F.monotonically_increasing_id())).alias("h2"),
        )
    )
    total = rows.agg(F.sum("bytes")).first()[0] or 0
    mean = max(0, math.ceil(math.log2(max(1.0, total / limit))))
    done: list[DataFrame] = []
    todo, known, base = rows, 0, ""
    depth = min(HASH_BITS, mean + EXTRA_BITS)
    while True:
        found, left = _leaves(todo, known, depth, limit)
        found, left = cut(found), cut(left)
        tagged = todo.withColumn("fine", F.shiftright("h", HASH_BITS - depth))
        placed = tagged.join(found.hint("merge"), "fine").select(
            "doc_id",
            F.concat(F.col("base") if base else F.lit(""), _name(F.col("prefix"), F.col("depth"))).alias("shard"),
            (F.col("depth") + (HASH_BITS if base else 0)).cast("int").alias("depth"),
            "shard_bytes", "shard_rows", (F.col("shard_bytes") > limit).alias("oversized"),
        )
        done.append(placed)
        if left.limit(1).count() == 0:
            break
        todo = cut(tagged.join(left.select("fine").hint("merge"), "fine", "left_semi").drop("fine"))
        known = depth
        if depth == HASH_BITS:
            if base:
                raise ArithmeticError("rows agree in 120 hash bits")
            # One id on many rows: go on with the bits of text and row number.
            base, known, depth = "h", 0, 0
            todo = cut(todo.withColumn("base", _name(F.col("h"), F.lit(HASH_BITS))).withColumn("h", F.col("h2")))
        depth = min(HASH_BITS, depth + STEP_BITS)
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def write_shards(docs: DataFrame, placed: DataFrame, path: str, id_col: str = "doc_id") -> None:
    """Writes each shard's rows under ``path``/shard=<bits>; ids must be unique."""
    names = placed.select(F.col("doc_id").alias("_shard_id"), F.concat(F.lit("b"), "shard").alias("shard"))
    joined = docs.join(names, F.col(id_col) == F.col("_shard_id")).drop("_shard_id")
    joined.repartition("shard").write.partitionBy("shard").parquet(path)

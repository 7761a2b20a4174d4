"""Exact deduplication by exchange of Golomb-coded fingerprints.

1. Every row gets the SHA-256 of its normalised text; text itself stays where it is.
2. Senders (bounded runs of rows) sort their fingerprints, ``log2(rows) + 8`` bits each, and send
   each owner of a fingerprint range one Golomb-Rice coded list (about 11 bits a fingerprint).
3. Owners answer with one bitmap per sender: which of its fingerprints exist elsewhere.
4. Only rows with a set bit are suspects. At the source, texts first pass a bit table of the suspects'
   digests, of ``SLOTS`` words whatever the corpus; those that are left meet the suspects by id, so no
   text key is hot, and are grouped by the bytes themselves after a map-side combine. Two texts under
   one SHA-256, none of which are known, would be an error.

Results in odd cases: a null text counts as empty; a null id is kept only if no equal text has an
id, and ``keep_id`` is then null; of rows repeated with the same id exactly one is kept; other
columns, whatever their names, are not looked at; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkscan.llm.common import WORD_GAP, cut

ROWS_PER_SENDER = 1 << 20
ROWS_PER_OWNER = 1 << 21
#: Words of 64 bits of the table that texts pass before they are shuffled: its size is fixed, beyond some 10^7 suspects it passes most.
SLOTS = 1 << 18
#: Bits beyond log2(rows): one row in 2**SPARE_BITS is a false suspect.
SPARE_BITS = 8


def rice_encode(values: np.ndarray) -> bytes:
    """Sorted non-negative integers as Golomb-Rice coded gaps: a unary and a remainder stream."""
    gaps = np.diff(values, prepend=np.int64(0)).astype(np.int64)
    mean = float(gaps.mean()) if len(gaps) else 0.0
    k = max(0, int(math.log2(mean * 0.69))) if mean * 0.69 > 1 else 0
    quotient = gaps >> k
    ends = np.cumsum(quotient + 1)
    unary = np.ones(int(ends[-1]) if len(ends) else 0, np.uint8)
    unary[ends - 1] = 0
    low = ((gaps[:, None] >> np.arange(k - 1, -1, -1)) & 1).astype(np.uint8) if k else np.zeros((0, 0), np.uint8)
    head = np.array([len(values), k, len(unary)], np.int64).tobytes()
    return head + np.packbits(unary).tobytes() + np.packbits(low.ravel()).tobytes()


def rice_decode(blob: bytes) -> np.ndarray:
    n, k, bits = (int(x) for x in np.frombuffer(blob, np.int64, 3))
    body = np.frombuffer(blob, np.uint8, offset=24)
    cut_at = (bits + 7) // 8
    ends = np.flatnonzero(np.unpackbits(body[:cut_at], count=bits) == 0)
    gaps = (np.diff(ends, prepend=-1) - 1).astype(np.int64) << k
    if k:
        low = np.unpackbits(body[cut_at:], count=n * k).reshape(n, k).astype(np.int64)
        gaps |= low @ (np.int64(1) << np.arange(k - 1, -1, -1, dtype=np.int64))
    return np.cumsum(gaps)


def _fingerprints(sha: pd.Series, bits: int) -> np.ndarray:
    raw = np.frombuffer(b"".join(bytes(x)[:8] for x in sha), ">u8")
    return (raw >> np.uint64(64 - bits)).astype(np.int64)


def _owners(prints: np.ndarray, bits: int, owners: int) -> np.ndarray:
    return prints // -(-(1 << bits) // owners)


def find_suspects(prints: DataFrame, rows: int) -> DataFrame:
    """Rows (doc_id, sha, rid) of ``prints`` (sender, doc_id, sha, rid) whose fingerprint occurs elsewhere too."""
    bits = min(62, max(1, math.ceil(math.log2(max(rows, 2)))) + SPARE_BITS)
    slots = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    owners = max(slots, -(-rows // ROWS_PER_OWNER))

    def send(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        fp = np.sort(_fingerprints(pdf["sha"], bits))
        owner = _owners(fp, bits, owners)
        at = np.flatnonzero(np.diff(owner, prepend=-1))
        lists = np.split(fp, at[1:])
        return pd.DataFrame({"sender": key[0], "owner": owner[at], "blob": [rice_encode(x) for x in lists]})

    def answer(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        lists = [rice_decode(bytes(x)) for x in pdf["blob"]]
        every = np.sort(np.concatenate(lists))
        twice = np.unique(every[1:][every[1:] == every[:-1]])
        maps = [np.packbits(np.isin(x, twice, assume_unique=False)).tobytes() for x in lists]
        return pd.DataFrame({"sender": pdf["sender"], "owner": key[0], "bitmap": maps})

    def receive(key: tuple, mine: pd.DataFrame, maps: pd.DataFrame) -> pd.DataFrame:
        fp = _fingerprints(mine["sha"], bits)
        order = np.argsort(fp, kind="stable")
        owner = _owners(fp[order], bits, owners)
        hit = np.zeros(len(fp), bool)
        for o, bitmap in zip(maps["owner"], maps["bitmap"]):
            lo, hi = np.searchsorted(owner, [o, o + 1])
            hit[order[lo:hi]] = np.unpackbits(np.frombuffer(bytes(bitmap), np.uint8), count=hi - lo).astype(bool)
        return mine.loc[hit, ["doc_id", "sha", "rid"]]

    by_sender = prints.groupBy("sender")
    blobs = by_sender.applyInPandas(send, "sender long, owner long, blob binary")
    maps = blobs.groupBy("owner").applyInPandas(answer, "sender long, owner long, bitmap binary")
    id_type = prints.schema["doc_id"].dataType.simpleString()
    return by_sender.cogroup(maps.groupBy("sender")).applyInPandas(receive, f"doc_id {id_type}, sha binary, rid long")


def _passing(source: DataFrame, suspects: DataFrame) -> DataFrame:
    """Rows of ``source`` whose digest's bit is set in a table of all suspects' digests; ``SLOTS`` rows at most, hence broadcast."""
    # A mask, unlike a remainder, is never null, so that no filter on it is put in front and the digest is taken once.
    slot, bit = F.xxhash64("sha").bitwiseAND(F.lit(SLOTS - 1)), F.shiftright(F.xxhash64("sha"), 58).bitwiseAND(F.lit(63))
    table = suspects.select(slot.alias("slot"), F.expr("shiftleft(1L, CAST(shiftright(xxhash64(sha), 58) & 63 AS INT))").alias("bit")).groupBy("slot").agg(F.bit_or("bit").alias("bits"))
    met = source.withColumn("slot", slot).join(F.broadcast(table), "slot")
    return met.where(F.getbit("bits", bit.cast("int")) == 1).drop("slot", "bits")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256."""
    text = F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), WORD_GAP, " ")
    source = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    source = source.withColumn("sha", F.unhex(F.sha2("text", 256)))
    prints = cut(source.select("doc_id", "sha", F.monotonically_increasing_id().alias("rid")))
    rows = prints.count()
    slots = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    senders = max(slots, -(-rows // ROWS_PER_SENDER))
    dealt = prints.select(F.pmod(F.xxhash64("rid"), F.lit(senders)).alias("sender"), "doc_id", "sha", "rid")
    suspects = cut(find_suspects(dealt, rows))

    # Merge join at every size, so that the cost of fetching does not jump with the number of suspects. An inner join: a semi join would be
    # moved in front of the bit table.
    s = suspects.select(F.col("doc_id").alias("s_id"), F.col("sha").alias("s_sha")).distinct().hint("merge")
    fetched = _passing(source, suspects).join(s, F.col("doc_id").eqNullSafe(F.col("s_id")) & (F.col("sha") == F.col("s_sha")))
    classes = cut(fetched.groupBy("sha", "text").agg(F.count(F.lit(1)).alias("group_size")).select("sha", "group_size"))
    if classes.groupBy("sha").count().where("count > 1").limit(1).count():  # two texts under one SHA-256
        raise ArithmeticError("two different texts share a SHA-256; grouping by digest would be wrong")
    sizes = classes.where("group_size > 1").select("sha", "group_size")
    # Added up before the join, so that a large group is a few rows.
    first = suspects.groupBy("sha").agg(F.min(F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("d"), "rid")).alias("first"))
    # Cut, so that the last join reads both sides by shuffle and a large group can be split among tasks.
    keep = cut(sizes.join(first.hint("merge"), "sha").select("sha", "group_size", F.col("first.d").alias("keep_id"), F.col("first.rid").alias("keep_rid")))
    alone = F.col("keep_rid").isNull()
    return prints.join(keep.hint("merge"), "sha", "left").select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (alone | (F.col("rid") == F.col("keep_rid"))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def keep_rows(docs: DataFrame, verdict: DataFrame, row: str) -> DataFrame:
    """The rows of ``docs`` that ``verdict`` (doc_id, kept) keeps; its doc_id is ``row``, which tells all rows apart."""
    gone = verdict.where("NOT kept").select(F.col("doc_id").alias("_dropped"))
    return docs.join(gone.hint("merge"), F.col(row) == F.col("_dropped"), "left_anti")


def keep_first(docs: DataFrame, verdict: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As ``keep_rows``, by an id that may repeat or be null.

    Where one row of an id stays and another goes, the verdict does not say which; each of that id's texts then stays once.
    """
    dropped = verdict.where("NOT kept").select(F.col("doc_id").alias("_dropped")).distinct()
    kept = verdict.where("kept").select(F.col("doc_id").alias("_kept"))
    split = cut(dropped.join(kept, F.col("_dropped").eqNullSafe(F.col("_kept")), "left_semi"))
    out = docs.join(dropped.hint("merge"), F.col(id_col).eqNullSafe(F.col("_dropped")), "left_anti")
    if not split.limit(1).count():
        return out
    both = docs.join(split.hint("merge"), F.col(id_col).eqNullSafe(F.col("_dropped")), "left_semi")
    return out.unionByName(both.dropDuplicates([id_col, text_col]))

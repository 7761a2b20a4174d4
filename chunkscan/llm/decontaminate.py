"""Benchmark decontamination by a prefix-filtered set join, DataFrame functions only.

An item's windows are its runs of ``WINDOW`` words, or the whole item if it is shorter. Equal windows
are one, whatever items hold them. A window's tokens are its shingles of up to three words; a text
that holds the window holds all of them, so its rarest one suffices as join prefix.

1. Rarity: the corpus's counts of the benchmark's shingles, added up before any shuffle. A window with
   a shingle that the corpus lacks cannot occur.
2. Each text's shingles meet the prefixes only. A match is a candidate place; the place must leave room
   for the whole window inside the text (positional and length bounds).
3. Candidates are compared with the text word for word: where the prefixes are few, at once, as the
   text's words are at hand; else candidates go to the stretches of their texts, ``SEGMENT`` words each.
4. Verified places are rows. What they cover is counted by a running maximum over a text's places, and
   items join their windows last, so nothing is gathered for a text but the ids of its items.

Odd cases: null texts and items have no words and match nothing; an item id may repeat (its windows
join); items without an id count as one item, which the digest of ids leaves out; rows repeated with
one id each get the result; empty tables work; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chunkscan.llm.common import ascii_lower, cut

WINDOW, SHINGLE = 10, 3
WORD_ENDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Rows (some 300 bytes each) up to which shingles and prefixes are broadcast; beyond, shuffle joins.
BROADCAST_ROWS = 100_000
#: Words of a text that candidates meet at once, where they are not compared at once.
SEGMENT = 1024


def words_of(text: Column) -> Column:
    spaced = F.trim(F.regexp_replace(ascii_lower(F.coalesce(text, F.lit(""))), WORD_ENDS, " "))
    return F.when(spaced == "", F.array().cast("array<string>")).otherwise(F.split(spaced, " "))


def _hash(parts: list[Column]) -> Column:
    return F.xxhash64(F.lit(len(parts)), *parts)


def _windows(items: DataFrame) -> DataFrame:
    """(item, wid, win, k): distinct windows of the items; ``wid`` names equal windows."""
    words = items.select("item", words_of(F.col("text")).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - (WINDOW - 1), F.lit(1)))
    found = words.select("item", F.explode(F.transform(starts, lambda i: F.slice("w", i, WINDOW))).alias("win")).distinct()
    return found.select("item", F.sha2(F.array_join("win", " "), 256).alias("wid"), "win", F.size("win").alias("k"))


def _tokens(windows: DataFrame) -> DataFrame:
    """(wid, k, h, o): each window's shingles and where in it they first stand."""
    size = F.least("k", F.lit(SHINGLE))
    at = F.explode(F.sequence(F.lit(0), F.col("k") - size)).alias("o")
    placed = windows.select("wid", "k", "win", size.alias("size"), at)
    part = lambda n: _hash([F.get("win", F.col("o") + j) for j in range(n)])
    h = F.when(F.col("size") == 1, part(1)).when(F.col("size") == 2, part(2)).otherwise(part(3))
    return placed.select("wid", "k", h.alias("h"), "o").groupBy("wid", "k", "h").agg(F.min("o").alias("o"))


def _shingles(texts: DataFrame, sizes: list[int]) -> DataFrame:
    """All columns of ``texts`` with its words ``w``, place and hash of each shingle; one row at place -1 without a hash for each text."""
    empty = F.lit(None).cast("string")
    head = F.array(F.struct(*[empty.alias(f"s{j}") for j in range(SHINGLE)]))
    later = lambda j: F.slice("w", j + 1, F.greatest(F.size("w") - j, F.lit(0)))
    runs = F.arrays_zip(*[(F.col("w") if j == 0 else later(j)).alias(f"s{j}") for j in range(SHINGLE)])
    placed = texts.select("*", F.posexplode(F.concat(head, runs)).alias("place", "s")).withColumn("place", F.col("place") - 1)

    def of(size: int) -> Column:
        return F.when((F.col("place") >= 0) & F.col(f"s.s{size - 1}").isNotNull(), _hash([F.col(f"s.s{j}") for j in range(size)]))

    if len(sizes) == 1:
        return placed.withColumn("h", of(sizes[0])).drop("s").where("h IS NOT NULL OR place < 0")
    kinds = F.explode(F.array(*[F.struct(F.lit(n).alias("n"), of(n).alias("h")) for n in sizes]))
    return placed.withColumn("kind", kinds).withColumn("h", F.col("kind.h")).where(F.col("h").isNotNull() | ((F.col("place") < 0) & (F.col("kind.n") == sizes[0]))).drop("s", "kind")


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    items = cut(_windows(benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(item_text).alias("text"))))
    windows = items.select("wid", "win", "k").dropDuplicates(["wid"])
    tokens = cut(_tokens(windows))
    sizes = sorted(r[0] for r in windows.select(F.least("k", F.lit(SHINGLE))).distinct().collect())
    sizes = sizes or [SHINGLE]
    small = tokens.count() <= BROADCAST_ROWS
    hinted = F.broadcast if small else (lambda df: df.hint("merge"))

    words = docs.select(F.col(id_col).alias("doc_id"), words_of(F.col(text_col)).alias("w"))
    seen = _shingles(words.select("w"), sizes).where("place >= 0").select("h").join(hinted(tokens.select("h").distinct()), "h", "left_semi")
    counts = cut(seen.groupBy("h").count())
    ranked = tokens.join(counts.hint("merge"), "h", "left").groupBy("wid", "k").agg(
        F.min(F.struct(F.coalesce("count", F.lit(0).cast("long")).alias("n"), F.col("h"), F.col("o"))).alias("rare")
    )
    prefixes = ranked.where("rare.n > 0").select("wid", "k", F.col("rare.h").alias("h"), F.col("rare.o").alias("o"))
    prefixes = cut(prefixes.join(windows.select("wid", "win").hint("merge"), "wid"))

    # The row number is drawn in the same job that writes it.
    rows = words.select("doc_id", F.monotonically_increasing_id().alias("rid"), "w", F.size("w").alias("n"))
    start = F.col("place") - F.col("o")
    fits = (start >= 0) & (start + F.col("k") <= F.col("n"))
    if small:
        met = _shingles(rows, sizes).join(F.broadcast(prefixes), "h", "left")
        good = fits & (F.slice("w", start + 1, F.col("k")) == F.col("win"))
        told = cut(met.where((F.col("place") < 0) | good).select("rid", "doc_id", "n", F.col("place") < 0, start.alias("s"), "k", "wid").toDF("rid", "doc_id", "n", "whole", "s", "k", "wid"))
        texts, found = told.where("whole").select("rid", "doc_id", "n"), told.where("NOT whole").select("rid", "s", "k", "wid")
    else:
        texts = cut(rows.select("rid", "doc_id", "n", "w"))
        met = _shingles(texts.select("rid", "n", "w"), sizes).where("place >= 0").select("rid", "n", "place", "h")
        candidates = cut(met.join(prefixes.select("wid", "k", "h", "o").hint("merge"), "h").where(fits).select("rid", start.alias("s"), "k", "wid"))
        found = _compare(texts, candidates, windows)
    hit, ids = _covered(found), _items(found, items)
    out = texts.select("rid", "doc_id", "n").join(hit.hint("merge"), "rid", "left").join(ids.hint("merge"), "rid", "left")
    n_hit, none = F.coalesce("n_hit", F.lit(0).cast("long")), F.array().cast("array<string>")
    return out.select(
        "doc_id", F.col("n").cast("long").alias("n_words"), n_hit.alias("n_hit"), F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
        F.sha2(F.array_join(F.coalesce("ids", none), ",").cast("binary"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


def _compare(texts: DataFrame, candidates: DataFrame, windows: DataFrame) -> DataFrame:
    """The ``candidates`` (rid, s, k, wid) whose words stand in their texts, by stretches of texts that have any."""
    some = texts.join(candidates.select("rid").distinct().hint("merge"), "rid", "left_semi")
    cuts = F.sequence(F.lit(0), F.floor((F.size("w") - 1) / SEGMENT).cast("int"))
    stretches = some.select("rid", "w", F.explode(cuts).alias("seg")).select("rid", "seg", F.slice("w", F.col("seg") * SEGMENT + 1, SEGMENT + WINDOW).alias("w"))
    asked = candidates.withColumn("seg", F.floor(F.col("s") / SEGMENT).cast("int"))
    met = asked.join(stretches.hint("merge"), ["rid", "seg"]).select("rid", "s", "k", "wid", F.slice("w", F.col("s") % SEGMENT + 1, F.col("k")).alias("words"))
    known = windows.select(F.col("wid").alias("_wid"), "win").hint("merge")
    return cut(met.join(known, (F.col("wid") == F.col("_wid")) & (F.col("words") == F.col("win"))).select("rid", "s", "k", "wid"))


def _covered(found: DataFrame) -> DataFrame:
    """(rid, n_hit): words inside any of a text's verified places."""
    ends = found.groupBy("rid", "s").agg((F.col("s") + F.max("k")).alias("e"))
    before = F.max("e").over(Window.partitionBy("rid").orderBy("s").rowsBetween(Window.unboundedPreceding, -1))
    new = ends.select("rid", (F.col("e") - F.greatest("s", F.least("e", F.coalesce(before, F.lit(0))))).alias("new"))
    return new.groupBy("rid").agg(F.sum("new").alias("n_hit"))


def _items(found: DataFrame, items: DataFrame) -> DataFrame:
    """(rid, n_items, ids): the items with a window among a text's verified places; ids sorted, null left out."""
    held = found.select("rid", "wid").distinct().join(items.select("wid", "item").hint("merge"), "wid").select("rid", "item").distinct()
    return held.groupBy("rid").agg(F.count(F.lit(1)).alias("n_items"), F.array_sort(F.collect_list("item")).alias("ids"))

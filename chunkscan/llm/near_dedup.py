"""Near-duplicate groups by MinHash bands and sequential Bayesian verification.

A text's set is its distinct runs of five words. Texts with equal sets form one class, which enters
the rest once. Classes that agree in a band of their MinHash signature are candidates:

1. Each bucket's members meet its first member: one pair a member, not all pairs.
2. The two signatures are compared batch by batch. With m of n values equal and a uniform prior,
   the chance that the similarity is at least the threshold is a binomial tail; below ``MISS`` the
   pair is dropped. What passes is verified on the full sets. Links join classes into components.
3. Pairs that passed the signature test join classes into families. Where a family holds several
   components, its members meet across them in blocks of about ``BLOCK`` by ``BLOCK``: signatures
   first, full sets of what passes, and only links that join two components leave the task. Blocks
   within the largest component do not meet.
4. Members of one bucket but of different families, which chance seldom makes, meet by signature
   too; what passes is verified. So every pair that shares a bucket is tested unless its members
   are connected already, and rows stay in proportion to members.

Odd cases: null and empty texts have no set and stay alone; fewer than five words count as one run;
rows without an id are returned with a null component and kept; rows repeated with one id share its
result; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkscan.llm.common import cut, groups
from chunkscan.llm.graph import components
from chunkscan.llm.hashing import mix, word_hashes

RUN, NUMERATOR, DENOMINATOR = 5, 75, 100
BANDS, ROWS = 32, 3
HASHES = BANDS * ROWS
#: Signature values compared at once; chance at which a pair at the threshold may be dropped.
BATCH, MISS = 16, 1e-7
BLOCK = 1024
#: Bytes of text hashed at once.
CHUNK = 1 << 20

_rng = np.random.default_rng(20240501)
_PLACES = _rng.integers(1, 1 << 63, RUN, np.uint64) | np.uint64(1)
_MULTIPLY = _rng.integers(1, 1 << 63, HASHES, np.uint64) | np.uint64(1)
_ADD = _rng.integers(1, 1 << 63, HASHES, np.uint64)


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's runs of words."""
    out: list[np.ndarray] = []
    lo = 0
    raws = [(t or "").encode("utf-8", "surrogatepass").lower() for t in texts]
    while lo < len(raws):
        hi, size = lo, 0
        while hi < len(raws) and (hi == lo or size + len(raws[hi]) <= CHUNK):
            size += len(raws[hi]) + 1
            hi += 1
        hashes, counts = word_hashes(raws[lo:hi])
        run = sum((hashes[j : len(hashes) - RUN + 1 + j] * _PLACES[j] for j in range(RUN)), np.uint64(0)) if len(hashes) >= RUN else hashes[:0]
        run = mix(run)
        at = 0
        for n in counts:
            if n >= RUN:
                out.append(np.unique(run[at : at + n - RUN + 1]))
            elif n:
                out.append(mix((hashes[at : at + n] * _PLACES[:n]).sum(keepdims=True, dtype=np.uint64) + np.uint64(n)))
            else:
                out.append(hashes[:0])
            at += n
        lo = hi
    return out


def signature(found: np.ndarray) -> bytes:
    low = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for lo in range(0, len(found), 512):
        np.minimum(low, (found[lo : lo + 512, None] * _MULTIPLY + _ADD).min(0), out=low)
    return (low >> np.uint64(32)).astype("<u4").tobytes()


def digest(found: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(found.tobytes())


def least_matches(threshold: float = NUMERATOR / DENOMINATOR, miss: float = MISS) -> list[int]:
    """After each batch, the fewest equal values at which the posterior still exceeds ``miss``.

    With a uniform prior P(s >= t | m of n) is the binomial P(X <= m), X of n + 1 at t.
    """
    out = []
    for n in range(BATCH, HASHES + 1, BATCH):
        tail, m = 0.0, 0
        while True:
            tail += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if tail > miss:
                break
            m += 1
        out.append(m)
    return out


LEAST = least_matches()


def surviving(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which rows of two signature arrays pass every batch, and their equal values."""
    alive, equal = np.arange(len(a)), np.zeros(len(a), np.int32)
    for k, need in enumerate(LEAST):
        cols = slice(k * BATCH, (k + 1) * BATCH)
        equal[alive] += (a[alive, cols] == b[alive, cols]).sum(1, dtype=np.int32)
        alive = alive[equal[alive] >= need]
    return alive, equal


def _signatures(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(map(bytes, column)), "<u4").reshape(-1, HASHES)


def _prune(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in frames:
        if len(pdf):
            alive, _ = surviving(_signatures(pdf["sa"]), _signatures(pdf["sb"]))
            yield pdf.iloc[alive][["a", "b"]]


def _runs(g: np.ndarray) -> list[tuple[int, int]]:
    edges = [0, *(np.flatnonzero(np.diff(g)) + 1).tolist(), len(g)]
    return list(zip(edges[:-1], edges[1:]))


def _meeting(inverse: np.ndarray, own: np.ndarray, i: int, j: int) -> Iterator[tuple[int, np.ndarray]]:
    """Members of one block (or of the smaller components) and those of the other that each has to meet."""
    if i != j:
        for x in np.flatnonzero(own == i):
            yield x, np.flatnonzero((own == j) & (inverse != inverse[x]))
        return
    largest = np.bincount(inverse).argmax()
    for x in np.flatnonzero(inverse != largest):
        # A pair of two small components is met from its later member.
        yield x, np.flatnonzero((inverse != inverse[x]) & ((inverse == largest) | (np.arange(len(own)) < x)))


def _strangers(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pairs of a bucket from different families that pass the signature test (rows: g, i, j, own, cid, root, sig)."""
    for many in groups(frames, "g"):
        found_a, found_b = [], []
        for lo, hi in _runs(many["g"].to_numpy()):
            pdf = many.iloc[lo:hi]
            names, inverse = np.unique(pdf["root"].to_numpy(), return_inverse=True)
            if len(names) < 2:
                continue
            cid, sig = pdf["cid"].to_numpy(), _signatures(pdf["sig"])
            for x, ys in _meeting(inverse, pdf["own"].to_numpy(), int(pdf["i"].iloc[0]), int(pdf["j"].iloc[0])):
                alive, _ = surviving(np.broadcast_to(sig[x], (len(ys), HASHES)), sig[ys])
                found_a += [cid[x]] * len(alive)
                found_b += cid[ys[alive]].tolist()
        a, b = np.array(found_a, np.int64), np.array(found_b, np.int64)
        yield pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)})


def _relatives(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Links that join components within a family (rows: as before and found, the full sets)."""
    for many in groups(frames, "g"):
        found_a, found_b = [], []
        for lo, hi in _runs(many["g"].to_numpy()):
            pdf = many.iloc[lo:hi]
            names, inverse = np.unique(pdf["root"].to_numpy(), return_inverse=True)
            if len(names) < 2:
                continue
            cid, sig, own = pdf["cid"].to_numpy(), _signatures(pdf["sig"]), pdf["own"].to_numpy()
            sets = [np.asarray(x, np.int64) for x in pdf["found"]]
            size = np.array([len(x) for x in sets])
            _, flat = np.unique(np.concatenate(sets), return_inverse=True)
            start = np.cumsum(size) - size
            mark = np.zeros(flat.max() + 1, np.int64)
            parent = list(range(len(names)))

            def top(c: int) -> int:
                while parent[c] != c:
                    parent[c] = parent[parent[c]]
                    c = parent[c]
                return c

            for x, ys in _meeting(inverse, own, int(pdf["i"].iloc[0]), int(pdf["j"].iloc[0])):
                mine = top(int(inverse[x]))
                tops = np.array([top(c) for c in range(len(names))])
                ys = ys[tops[inverse[ys]] != mine]
                alive, _ = surviving(np.broadcast_to(sig[x], (len(ys), HASHES)), sig[ys])
                ys = ys[alive]
                if not len(ys):
                    continue
                mark[flat[start[x] : start[x] + size[x]]] = 1
                both = np.add.reduceat(mark[np.concatenate([flat[start[y] : start[y] + size[y]] for y in ys])], np.cumsum(size[ys]) - size[ys])
                mark[flat[start[x] : start[x] + size[x]]] = 0
                for y in ys[DENOMINATOR * both >= NUMERATOR * (size[x] + size[ys] - both)]:
                    other, mine = top(int(inverse[y])), top(int(inverse[x]))
                    if other != mine:
                        parent[other] = mine
                        found_a.append(cid[x])
                        found_b.append(cid[y])
        yield pd.DataFrame({"u": np.array(found_a, np.int64), "v": np.array(found_b, np.int64)})


def _blocks(members: DataFrame, group: str) -> DataFrame:
    """``members`` (``group``, cid, root) dealt to pairs of blocks: g, i, j, own, cid, root; those of the largest component do not meet."""
    counts = members.groupBy(group, "root").count()
    sizes = counts.groupBy(group).agg(F.max(F.struct("count", "root")).alias("most"), F.sum("count").alias("all"))
    sizes = sizes.select(group, F.col("most.root").alias("main"), F.ceil(F.col("most.count") / BLOCK).alias("mains"), F.ceil((F.col("all") - F.col("most.count")) / BLOCK).alias("rests"), "all")
    # Cut, so that the join reads both sides by shuffle and a large group can be split among tasks.
    sizes = cut(sizes)
    # A group that fits into one block is one; else the largest component has blocks of its own, after the others.
    one = F.col("all") <= 2 * BLOCK
    known = members.join(sizes.hint("merge"), group)
    main = F.col("root") == F.col("main")
    h = F.xxhash64("cid")
    own = F.when(one, F.lit(0).cast("long")).when(main, F.col("rests") + F.pmod(h, F.col("mains"))).otherwise(F.pmod(h, F.col("rests")))
    last = F.when(one, F.lit(0).cast("long")).when(main, F.col("rests") - 1).otherwise(F.col("rests") + F.col("mains") - 1)
    dealt = known.select(group, "cid", "root", own.alias("own"), F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("with"))
    dealt = dealt.select(F.least("own", "with").alias("i"), F.greatest("own", "with").alias("j"), "own", "cid", "root", group)
    return dealt.withColumn("g", F.xxhash64(group, "i", "j")).drop(group)


class _Corpus:
    """The classes of a table, their signatures and, as far as needed, their sets."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str):
        self.source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
        self.id_type = docs.schema[id_col].dataType.simpleString()

        def sign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in frames:
                for lo in range(0, len(pdf), 512):
                    part = pdf.iloc[lo : lo + 512]
                    sets = shingle_sets(part["text"].tolist())
                    yield pd.DataFrame({
                        "doc_id": part["doc_id"].to_numpy(), "n": [len(s) for s in sets],
                        "key": [digest(s) if len(s) else None for s in sets], "sig": [signature(s) if len(s) else None for s in sets],
                    })

        self.rows = cut(self.source.mapInPandas(sign, f"doc_id {self.id_type}, n long, key binary, sig binary"))
        named = self.rows.where("key IS NOT NULL AND doc_id IS NOT NULL")
        merged = named.groupBy("key").agg(F.min("doc_id").alias("id"), F.first("sig").alias("sig"), F.first("n").alias("n"))
        self.classes = cut(merged.withColumn("cid", F.monotonically_increasing_id()))
        self.sets: DataFrame | None = None

    def with_sets(self, cids: DataFrame) -> DataFrame:
        """(cid, n, found) for at least these classes; texts are read again for those not known yet."""
        missing = cids.select("cid").distinct()
        if self.sets is not None:
            missing = cut(missing.join(self.sets.select("cid"), "cid", "left_anti"))
            if missing.limit(1).count() == 0:
                return self.sets
        # Always a merge join: what is wanted grows with the corpus.
        wanted = self.classes.join(missing, "cid").select(F.col("id").alias("doc_id"), "cid", "key").hint("merge")

        def build(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in frames:
                for lo in range(0, len(pdf), 512):
                    part = pdf.iloc[lo : lo + 512]
                    sets = shingle_sets(part["text"].tolist())
                    # An id may stand on several texts: only the class's own counts.
                    own = [k for k, (s, key) in enumerate(zip(sets, part["key"])) if len(s) and digest(s) == bytes(key)]
                    yield pd.DataFrame({"cid": part["cid"].to_numpy()[own], "n": [len(sets[k]) for k in own], "found": [sets[k].view(np.int64) for k in own]})

        fetched = self.source.join(wanted, "doc_id").select("cid", "key", "text").mapInPandas(build, "cid long, n long, found array<long>")
        new = cut(fetched.dropDuplicates(["cid"]))
        self.sets = new if self.sets is None else self.sets.union(new)
        return self.sets

    def verify(self, pairs: DataFrame) -> DataFrame:
        """Of ``pairs`` (a, b; written, each once), the links (u, v): similarity on full sets at or over the threshold."""
        sets = self.with_sets(pairs.select(F.col("a").alias("cid")).union(pairs.select(F.col("b").alias("cid"))))
        side = lambda x: sets.select(F.col("cid").alias(x), F.col("n").alias(f"n{x}"), F.col("found").alias(f"s{x}"))
        size = F.size(F.array_intersect("sa", "sb")).cast("long")
        both = pairs.join(side("a").hint("merge"), "a").join(side("b").hint("merge"), "b")
        # The sizes alone rule some out.
        both = both.where(DENOMINATOR * F.least("na", "nb") >= NUMERATOR * F.greatest("na", "nb"))
        return both.withColumn("both", size).where(DENOMINATOR * F.col("both") >= NUMERATOR * (F.col("na") + F.col("nb") - F.col("both"))).select(F.col("a").alias("u"), F.col("b").alias("v"))


def _extended(comps: DataFrame, links: DataFrame) -> DataFrame:
    """Components (node, root) of those that are known and further links."""
    if links.limit(1).count() == 0:
        return comps
    return components(comps.select(F.col("node").alias("u"), F.col("root").alias("v")).union(links))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept."""
    corpus = _Corpus(docs, id_col, text_col)
    classes = corpus.classes
    bands = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda b: F.xxhash64(b, F.substring("sig", b * (4 * ROWS) + 1, F.lit(4 * ROWS))))
    placed = classes.select("cid", F.explode(bands).alias("bucket"))
    # Cut, like other sides below, so that the join reads both by shuffle and a large bucket can be split among tasks.
    heads = cut(placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("members"), F.min("cid").alias("head")).where("members > 1"))
    shared = cut(placed.join(heads.hint("merge"), "bucket"))

    sig = lambda c, s: classes.select(F.col("cid").alias(c), F.col("sig").alias(s)).hint("merge")
    stars = shared.where("cid <> head").select(F.col("head").alias("a"), F.col("cid").alias("b")).distinct()
    tested = stars.join(sig("a", "sa"), "a").join(sig("b", "sb"), "b").mapInPandas(_prune, "a long, b long")
    tested = cut(tested)
    comps = components(cut(corpus.verify(tested)))
    slots = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    families = components(tested.select(F.col("a").alias("u"), F.col("b").alias("v")), roots=True).select(F.col("node").alias("cid"), F.col("root").alias("family"))

    rooted = families.join(comps.withColumnRenamed("node", "cid").hint("merge"), "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    open_ = rooted.groupBy("family").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count(F.lit(1)).alias("m")).where("lo <> hi AND m > 2")
    met = _blocks(cut(rooted.join(open_.select("family").hint("merge"), "family")), "family")
    # Families are of tested pairs, whose sets are there.
    sets = corpus.sets.select("cid", "found").hint("merge")
    dealt = met.join(sig("cid", "sig"), "cid").join(sets, "cid").select("g", "i", "j", "own", "cid", "root", "sig", "found")
    joined = dealt.repartition(slots, "g").sortWithinPartitions("g").mapInPandas(_relatives, "u long, v long")
    comps = _extended(comps, cut(joined))

    # Buckets that hold several families; bands of one group give the same bucket again, one is enough.
    placed = shared.where("members > 2").select("bucket", "cid").join(families.hint("merge"), "cid", "left").withColumn("root", F.coalesce("family", "cid"))
    mixed = placed.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count(F.lit(1)).alias("m"), F.min("cid").alias("c"), F.sum(F.shiftright(F.xxhash64("cid"), 20)).alias("s"))
    mixed = cut(mixed.where("lo <> hi").groupBy("m", "c", "s").agg(F.min("bucket").alias("bucket")))
    members = cut(placed.join(mixed.select("bucket").hint("merge"), "bucket").select("bucket", "cid", "root"))
    dealt = _blocks(members, "bucket").join(sig("cid", "sig"), "cid").select("g", "i", "j", "own", "cid", "root", "sig")
    strange = cut(dealt.repartition(slots, "g").sortWithinPartitions("g").mapInPandas(_strangers, "a long, b long").distinct())
    if strange.limit(1).count():
        comps = _extended(comps, cut(corpus.verify(strange)))

    known = classes.join(comps.withColumnRenamed("node", "cid"), "cid", "left").select("key", "id", F.coalesce("root", "cid").alias("root"))
    least = known.groupBy("root").agg(F.min("id").alias("component_id"))
    named = cut(known.join(least, "root").select("key", "component_id")).hint("merge")
    out = corpus.rows.select("doc_id", "n", "key").join(named, "key", "left")
    comp = F.when(F.col("key").isNull() | F.col("doc_id").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), comp.alias("component_id"), F.coalesce(F.col("doc_id") == comp, F.lit(True)).alias("kept"))

"""Secret scan: fixed patterns and a randomness test battery, DataFrame functions only.

Base patterns give spans of kinds ``assign``, ``access`` and ``hex``. The battery looks at further
runs of at least ``LEAST`` key-like characters: those of base64 and those of its form for URLs, so that
a key beside ``/`` or ``-`` is also tested without what it hangs on. It infers the smallest encoding that
covers a run and tests its symbols. A run of one class of characters (only small letters, only digits)
cannot be told from a word or a number and is not tested. Tests of uniformity, all of which have to pass:

* chi-squared against the uniform alphabet (its upper tail);
* number of runs above and below the middle of the alphabet, and serial correlation at lag one:
  sequences and patterns that fill the alphabet evenly fail here.

Evidence against plain text, whose p values are joined by Fisher's method:

* the chi-squared value, which plain text makes noncentral by an effect for each character;
* the number of runs of one class (small, capital, digit, sign), by Chernoff's bound of a binomial.

Effect and rate of plain text are calibrated on the corpus: from all its runs that fail the chi-squared
test by far, by encoding, but never nearer to random than ``ENCODINGS`` says. The p values go through
Benjamini-Hochberg control at rate ``RATE``, separately by encoding and length class, over all runs of
the corpus that pass the tests of uniformity; the counts for it are a histogram of p values. What remains
is a span of kind ``random`` unless a base span or a span with a smaller p value overlaps it. Places are
code points.

Odd cases: null and empty texts have no spans; very long runs are tested whole; repeated rows each
get their spans; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chunkscan.llm.common import cut

#: Base patterns: kind, pattern, the group whose length counts, its least length (fixed values).
BASE = [
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    ("access", r"AKIA[A-Z0-9]+", 0, 18),
    ("hex", r"[0-9a-f]{16,}", 0, 16),
]
LEAST, RATE = 16, 0.01
CANDIDATES = [rf"(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{{{LEAST},}}={{0,2}}", rf"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{{{LEAST},}}"]
#: Encodings, smallest first: pattern, alphabet (fixed values); effect of plain text on chi-squared for each character, and its rate of changes of class.
UPPER, LOWER, DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
ENCODINGS = [
    ("^[0-9a-f]+$", DIGITS + "abcdef", 0.6, 0.15),
    ("^[0-9A-F]+$", DIGITS + "ABCDEF", 0.6, 0.15),
    ("^[A-Z2-7]+$", UPPER + "234567", 1.2, 0.05),
    ("^[a-z0-9]+$", DIGITS + LOWER, 1.2, 0.10),
    ("^[A-Z0-9]+$", DIGITS + UPPER, 1.2, 0.10),
    ("^[A-Za-z]+$", UPPER + LOWER, 1.8, 0.12),
    ("^[A-Za-z0-9]+$", UPPER + LOWER + DIGITS, 2.2, 0.15),
    ("^[A-Za-z0-9+/]+$", UPPER + LOWER + DIGITS + "+/", 2.2, 0.15),
    ("^[A-Za-z0-9_-]+$", UPPER + LOWER + DIGITS + "-_", 2.2, 0.20),
]
#: Bound on the z values of the tests of uniformity; chi-squared's beyond which a run counts as text.
BOUND, TEXT = 3.3, 6.0
#: Changes of class, or characters, that what is known beforehand of plain text counts for.
PRIOR = 1000.0
#: Steps of -log10 p in the histogram.
STEPS_PER_DECADE = 20


def _spans(text: Column, pattern: str, group: int, least: int) -> Column:
    """array<struct<s, e, v>> of matches long enough; between matches lie the pieces of split()."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    size = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    before = F.split(text, pattern, -1)
    rows = F.arrays_zip(F.slice(before, 1, F.size(found)).alias("b"), found.alias("v"), size.alias("g"))
    kind = "struct<at:int,out:array<struct<s:int,e:int,v:string>>>"
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<s:int,e:int,v:string>>").alias("out")).cast(kind)

    def step(a: Column, x: Column) -> Column:
        s = a["at"] + F.length(x["b"])
        e = s + F.length(x["v"])
        one = F.array(F.struct(s.alias("s"), e.alias("e"), x["v"].alias("v")))
        return F.struct(e.alias("at"), F.when(F.length(x["g"]) >= least, F.concat(a["out"], one)).otherwise(a["out"]).alias("out")).cast(kind)

    none = F.array().cast("array<struct<s:int,e:int,v:string>>")
    return F.when(text.rlike(pattern), F.aggregate(rows, start, step, lambda a: a["out"])).otherwise(none)


def _slim(spans: str, kind: int) -> Column:
    return F.transform(spans, lambda c: F.struct(c["s"].alias("s"), F.lit(kind).alias("k"), c["e"].alias("e")))


def _tail(z: Column) -> Column:
    """Upper bound of the normal distribution function at ``z`` below -1, else 1."""
    x = -z
    return F.when(x <= 1, F.lit(1.0)).otherwise(F.exp(-x * x / 2) / (x * math.sqrt(2 * math.pi)))


def _chosen(encoding: Column, values: list) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), encoding)


def _battery(v: Column) -> Column:
    """struct<enc, n, chi, changes, text, even>: encoding from 1 (0: none), length, chi-squared, changes of class; whether chi-squared calls it text, and whether all tests call it uniform."""
    classes = F.translate(v, UPPER + LOWER + DIGITS + "+/-_", "A" * 26 + "a" * 26 + "0" * 10 + "....")
    known = F.lit(0)
    for k, (pattern, *_) in reversed(list(enumerate(ENCODINGS, 1))):
        known = F.when(v.rlike(pattern), F.lit(k)).otherwise(known)
    return F.transform(F.array(F.struct(known.alias("enc"), v.alias("v"), classes.alias("c"))), _tests)[0]


def _tests(x: Column) -> Column:
    v, enc = x["v"], F.greatest(x["enc"], F.lit(1))
    n = F.length(v).cast("double")
    alphabet = _chosen(enc, [a for _, a, *_ in ENCODINGS])
    k = F.length(alphabet).cast("double")
    count = lambda c: (F.length(v) - F.length(F.replace(v, c, F.lit("")))).cast("double")
    squares = F.aggregate(F.split(alphabet, ""), F.lit(0.0), lambda a, c: a + count(c) * count(c))
    chi = k / n * squares - n
    z_chi = (chi - (k - 1)) / F.sqrt(2 * (k - 1) * (n - 1) / n)
    side = F.call_function("translate", v, alphabet, _chosen(enc, ["a" * (len(a) // 2) + "b" * (len(a) // 2) for _, a, *_ in ENCODINGS]))
    runs = F.length(F.regexp_replace(side, r"(.)\1+", "$1")).cast("double")
    z_runs = (runs - (n + 1) / 2) / F.sqrt((n - 1) / 4)
    value = F.transform(F.split(v, ""), lambda c: F.instr(alphabet, c).cast("double") - (k + 1) / 2)
    pairs = F.zip_with(value, F.slice(value, 2, F.size(value)), lambda a, b: F.coalesce(a * b, F.lit(0.0)))
    z_serial = F.aggregate(pairs, F.lit(0.0), lambda a, y: a + y) / ((k * k - 1) / 12.0) / F.sqrt(n - 1)
    changes = F.length(F.regexp_replace(x["c"], r"(.)\1+", "$1")) - 1
    text = z_chi > TEXT
    even = (x["enc"] > 0) & (changes > 0) & (z_chi <= BOUND) & (F.abs(z_runs) <= BOUND) & (F.abs(z_serial) <= BOUND)
    return F.struct(x["enc"].alias("enc"), n.alias("n"), chi.alias("chi"), changes.alias("changes"), (text & (x["enc"] > 0)).alias("text"), even.alias("even"))


def _plain(tests: DataFrame) -> list[tuple[float, float]]:
    """By encoding, effect and rate of plain text: what is known beforehand and all runs of the corpus that look like text; 9 rows at most."""
    df = _chosen(F.greatest("enc", F.lit(1)), [len(a) - 1.0 for _, a, *_ in ENCODINGS])
    sums = tests.where("text").groupBy("enc").agg(F.sum(F.col("chi") - df).alias("effect"), F.sum("n").alias("n"), F.sum("changes").alias("changes"), F.sum(F.col("n") - 1).alias("places"))
    got = {r["enc"]: r for r in sums.collect()}
    out = []
    for k, (_, _, effect, rate) in enumerate(ENCODINGS, 1):
        if k in got:
            r = got[k]
            # Half the mean effect, since runs that chi-squared rejects are not all runs of text.
            effect = min(effect, (effect * PRIOR + r["effect"] / 2) / (PRIOR + r["n"]))
            rate = max(rate, min(0.9, (rate * PRIOR + r["changes"]) / (PRIOR + r["places"])))
        out.append((max(0.1, effect), rate))
    return out


def _p_value(c: Column, plain: list[tuple[float, float]]) -> Column:
    """p value of a run against plain text."""
    enc = F.greatest(c["enc"], F.lit(1))
    df = _chosen(enc, [len(a) - 1.0 for _, a, *_ in ENCODINGS])
    shift, rate = c["n"] * _chosen(enc, [e for e, _ in plain]), _chosen(enc, [q for _, q in plain])
    p_chi = _tail((c["chi"] - (df + shift)) / F.sqrt(2 * (df + 2 * shift)))
    share = c["changes"] / (c["n"] - 1)
    gain = share * F.log(share / rate) + F.when(share < 1, (1 - share) * F.log((1 - share) / (1 - rate))).otherwise(F.lit(0.0))
    p_changes = F.when(share > rate, F.exp(-(c["n"] - 1) * gain)).otherwise(F.lit(1.0))
    both = F.greatest(p_chi * p_changes, F.lit(1e-300))
    return F.least(both * (1 - F.log(both)), F.lit(1.0))


def _stratum(c: Column) -> Column:
    """Encoding and length class as one number."""
    return (c["enc"] * 64 + F.least(F.floor(F.log2(c["n"])), F.lit(40))).cast("int")


def _bucket(p: Column) -> Column:
    """Rounded so that a bucket's p value is an upper bound."""
    return F.floor(-F.log10(F.greatest(p, F.lit(1e-300))) * STEPS_PER_DECADE).cast("int")


def _thresholds(tests: DataFrame) -> dict[int, int]:
    """By encoding and length class, the least bucket that Benjamini-Hochberg accepts; at most 9 times 41 classes."""
    hist = tests.groupBy("stratum", "bucket").count()
    totals = hist.groupBy("stratum").agg(F.sum("count").alias("m"))
    # At most 369 classes of 6000 buckets each, whatever the corpus: pairs are within a class, and are numbers, not runs.
    above = hist.alias("x").join(hist.alias("y"), (F.col("x.stratum") == F.col("y.stratum")) & (F.col("y.bucket") >= F.col("x.bucket")))
    ranks = above.groupBy(F.col("x.stratum").alias("stratum"), F.col("x.bucket").alias("bucket")).agg(F.sum("y.count").alias("rank"))
    p = F.pow(F.lit(10.0), -F.col("bucket") / float(STEPS_PER_DECADE))
    passing = ranks.join(totals, "stratum").where(p * F.col("m") <= RATE * F.col("rank"))
    return {r[0]: r[1] for r in passing.groupBy("stratum").agg(F.min("bucket")).collect()}


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    source = docs.select(F.col(id_col).alias("doc_id"), text.alias("t"))
    by_kind = [_spans(F.col("t"), pattern, group, least).alias(kind) for kind, pattern, group, least in BASE]
    tested = lambda c: F.struct(c["s"].alias("s"), c["e"].alias("e"), _battery(F.rtrim(c["v"], F.lit("="))).alias("b"))
    tried = F.transform(F.array_distinct(F.concat(*[_spans(F.col("t"), pattern, 0, LEAST) for pattern in CANDIDATES])), tested)
    slim = [_slim(kind, i).alias(kind) for i, (kind, *_) in enumerate(BASE)]
    kept = cut(source.select("doc_id", *by_kind, tried.alias("tried")).select("doc_id", *slim, "tried"))
    every = kept.select(F.explode("tried").alias("c"))
    plain = _plain(every.select("c.b.*"))
    limits = _thresholds(every.where("c.b.even").select(_stratum(F.col("c.b")).alias("stratum"), _bucket(_p_value(F.col("c.b"), plain)).alias("bucket")))
    base = F.array_sort(F.concat(*[kind for kind, *_ in BASE]))
    marked = kept.withColumn("base", base)
    if limits:
        limit = F.create_map(*[F.lit(x) for pair in limits.items() for x in pair])
        meets = lambda a, b: (a["s"] < b["e"]) & (b["s"] < a["e"])
        told_p = lambda c: F.struct(c["s"].alias("s"), c["e"].alias("e"), _stratum(c["b"]).alias("stratum"), _bucket(_p_value(c["b"], plain)).alias("bucket"))
        marked = marked.withColumn("random", F.transform(F.filter("tried", lambda c: c["b"]["even"]), told_p))
        ok = lambda c: F.coalesce(c["bucket"] >= limit[c["stratum"]], F.lit(False)) & ~F.exists("base", lambda b: meets(b, c))
        marked = marked.withColumn("random", F.filter("random", ok))
        # Of spans that overlap, the one with the least p value, then the shortest, then the first.
        rank = lambda c: F.struct(-c["bucket"], c["e"] - c["s"], c["s"])
        first = lambda c: ~F.exists("random", lambda d: meets(c, d) & (rank(d) < rank(c)))
        more = F.transform(F.filter("random", first), lambda c: F.struct(c["s"].alias("s"), F.lit(len(BASE)).alias("k"), c["e"].alias("e")))
    else:
        more = F.array().cast("array<struct<s:int,k:int,e:int>>")
    marked = marked.withColumn("random", more)
    names = F.array(*[F.lit(kind) for kind, *_ in BASE], F.lit("random"))
    told = lambda spans: F.array_join(F.transform(spans, lambda c: F.concat_ws(":", F.element_at(names, c["k"] + 1), c["s"].cast("string"), c["e"].cast("string"))), ",")
    return marked.select(
        "doc_id", *[F.size(kind).cast("long").alias(f"n_{kind}") for kind, *_ in BASE],
        F.sha2(told(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        told(F.array_sort(F.concat("base", "random"))).alias("spans"), F.size("random").cast("long").alias("n_random"),
    )

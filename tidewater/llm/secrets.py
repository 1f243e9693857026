"""Secret scans in DataFrame expressions only.

Base spans: keyword assignments, access key ids and long runs of hex digits.
Added spans: words that pass a battery of randomness tests for the alphabet they
seem to be written in (decimal, hex, base 32, base 62, base 64 and its variant for
addresses; padding at the end is no part of the test):
  * chi-squared uniformity over the alphabet (Wilson-Hilferty normal score),
  * runs above and below the middle of the alphabet,
  * lag-one serial correlation.
The least p-value, times three, is a word's p; p >= ``ALPHA`` passes.  Ordinary
words can pass when they are short, so passing is not enough.  Letter-only words are
decoys: the share of them that passes, over the whole corpus, among those of a stratum
of length and of all shorter ones (which pass rather more often), one added to both
counts, is the rate at which ordinary words pass.  That rate times the number of
tested words that mix digits with letters estimates the false ones among those that
pass; a stratum whose estimate is over ``FDR`` of them reports nothing.  Only mixed
words can be reported, and none that touches a base span.

Defined cases: a null text counts as empty and has no spans; repeated rows get the
same spans; positions count code points, ends exclusive; on an empty table or without
decoys nothing is reported; columns named base or added of the table are replaced;
very long texts cost time a little over linear in their matches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import materialise

ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
WORD = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}"
KINDS = ("assign", "access", "hex", "random")
ALPHA = 0.01
FDR = 0.05
STRATA = (24, 28, 32, 40, 48, 64, 96, 128)

# fixed values: alphabets in the order of their digits
ALPHABETS = {
    "decimal": "0123456789",
    "hex": "0123456789abcdef",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base62": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "base64url": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_",
}


def running(values: Column) -> Column:
    """Running sums of an array of one value or more, by parts of about the root of its length, so that n values cost n * sqrt(n) additions."""

    def parts(v: Column, width: Column) -> Column:
        cut = F.transform(F.sequence(F.lit(1), F.size(v), width), lambda i: F.slice(v, i, width))
        inner = lambda part, start: F.transform(part, lambda _, j: start + _total(F.slice(part, F.lit(1), j + 1)))
        every = lambda held, sums: F.flatten(F.transform(held, lambda part, k: _let(_total(F.slice(sums, F.lit(1), k)), lambda start: inner(part, start))))
        return _let(cut, lambda held: _let(F.transform(held, _total), lambda sums: every(held, sums)))

    return _let(values, lambda v: _let(F.ceil(F.sqrt(F.size(v))).cast("int"), lambda width: parts(v, width)))


def find_all(text: Column, pattern: str, kind: int, group: int | None = None, least: int = 0) -> Column:
    """Leftmost matches without overlaps as array<struct<s, k, e, word>>.

    A match starts where the gaps and matches before it end.  With ``group``, only
    matches whose group has at least ``least`` characters stay.
    """
    rule = F.lit(pattern)
    empty = F.array().cast("array<struct<s:int,k:int,e:int,word:string>>")

    def placed(hits: Column) -> Column:
        gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(hits))
        ends = running(F.zip_with(gaps, hits, lambda gap, hit: F.length(gap) + F.length(hit)))
        return F.zip_with(ends, hits, lambda e, hit: F.struct((e - F.length(hit)).alias("s"), F.lit(kind).alias("k"), e.alias("e"), hit.alias("word")))

    def long_enough(spans: Column, held: Column) -> Column:
        return F.filter(spans, lambda x, i: F.length(F.get(held, i)) >= least)

    every = _let(F.regexp_extract_all(text, rule, F.lit(0)), placed)
    if group:
        every = _let(F.regexp_extract_all(text, rule, F.lit(group)), lambda held: long_enough(every, held))
    return F.when(text.rlike(pattern), every).otherwise(empty)


def _tail(z: Column) -> Column:
    """Upper tail of the normal distribution (logistic form, error below 2e-4)."""
    z = F.least(F.greatest(z, F.lit(-8.0)), F.lit(8.0))
    return 1 / (1 + F.exp(1.5976 * z + 0.070565992 * z * z * z))


def body(word: Column) -> Column:
    """A word without the padding at its end."""
    return F.regexp_replace(word, "=+$", "")


def encoding(text: Column) -> Column:
    """The smallest alphabet that spells a word's body, null if none does."""
    return (
        F.when(text.rlike("^[0-9]+$"), "decimal").when(text.rlike("^([0-9a-f]+|[0-9A-F]+)$"), "hex")
        .when(text.rlike("^[A-Z2-7]+$"), "base32").when(text.rlike("^[A-Za-z0-9]+$"), "base62")
        .when(text.rlike("^[A-Za-z0-9+/]+$"), "base64").when(text.rlike("^[A-Za-z0-9_-]+$"), "base64url")
    )


def _let(value: Column, use) -> Column:
    """``use`` of ``value``, which is computed once: inside ``use`` it is a lambda variable."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda p, q: p + q)


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda p, q: p + q)


def battery(word: Column) -> Column:
    """Combined p-value of a word under uniform random characters of its alphabet; 0 if it is in none.

    Each array is bound once, so a word costs time linear in its length.
    """

    def tested(text: Column) -> Column:
        kind = encoding(text)
        letters = F.coalesce(*[F.when(kind == k, F.lit(a)) for k, a in ALPHABETS.items()])
        spelt = F.when(kind == "hex", F.lower(text)).otherwise(text)
        places = lambda abc: F.transform(F.filter(F.split(spelt, ""), lambda c: c != ""), lambda c: (F.position(c, abc) - 1).cast("double"))
        return _let(letters, lambda abc: F.when(abc.isNull(), 0.0).otherwise(_let(places(abc), lambda x: _let(F.length(abc).cast("double"), lambda m: _least(x, m)))))

    return _let(body(word), tested)


def _least(x: Column, m: Column) -> Column:
    """Three times the least p-value of places ``x`` in an alphabet of ``m`` characters."""
    n = F.size(x).cast("double")
    df = m - 1

    def uniformity(counts):
        chi = m / n * _sum(F.transform(counts, lambda c: c * c)) - n
        return (F.pow(F.greatest(chi, F.lit(0.0)) / df, F.lit(1 / 3)) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df))

    def runs(high):
        up = _sum(high)
        expect = 2 * up * (n - up) / n + 1
        spread = F.sqrt(F.greatest((expect - 1) * (expect - 2) / (n - 1), F.lit(1e-9)))
        seen = 1 + _sum(F.zip_with(F.slice(high, 1, F.size(high) - 1), F.slice(high, 2, F.size(high) - 1), lambda a, b: F.abs(a - b)))
        return F.abs((seen - expect) / spread)

    def serial(mean):
        var = _sum(F.transform(x, lambda v: (v - mean) * (v - mean)))
        lag = _sum(F.zip_with(F.slice(x, 1, F.size(x) - 1), F.slice(x, 2, F.size(x) - 1), lambda a, b: (a - mean) * (b - mean)))
        return F.abs(lag / F.greatest(var, F.lit(1e-9)) * F.sqrt(n))

    counts = F.transform(F.array_distinct(x), lambda v: F.size(F.filter(x, lambda w: w == v)).cast("double"))  # at most m of them
    z1 = _let(counts, uniformity)
    z2 = _let(F.transform(x, lambda v: F.when(v >= m / 2, 1.0).otherwise(0.0)), runs)
    z3 = _let(_sum(x) / n, serial)
    return _let(F.least(_tail(z1), 2 * _tail(z2), 2 * _tail(z3)), lambda p: F.least(F.lit(1.0), 3 * p))


def stratum(n: Column) -> Column:
    out = F.lit(len(STRATA))
    for k in reversed(range(len(STRATA))):
        out = F.when(n < STRATA[k], k).otherwise(out)
    return out


def _tested(words: Column) -> Column:
    """Each word's place, stratum of length, whether letters only, whether mixed, and its verdict."""
    return F.transform(words, lambda w: F.struct(
        w["s"].alias("s"), w["e"].alias("e"), stratum(w["e"] - w["s"]).alias("stratum"),
        w["word"].rlike("^[A-Za-z]+$").alias("decoy"), (w["word"].rlike("[0-9]") & w["word"].rlike("[A-Za-z]")).alias("mixed"),
        (battery(w["word"]) >= ALPHA).alias("passed"),
    ))


def trusted_strata(counts: list) -> list[int]:
    """The strata that may report, from rows (stratum, decoys, decoys_passed, mixed, mixed_passed)."""
    good, decoys, passed = [], 0, 0
    for row in sorted(counts, key=lambda r: r["stratum"]):
        decoys, passed = decoys + row["decoys"], passed + row["decoys_passed"]
        if row["mixed_passed"] and row["mixed"] * (passed + 1) / (decoys + 1) <= FDR * row["mixed_passed"]:
            good.append(row["stratum"])
    return good


def scan_secrets(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` (default: all columns) and ``base``, ``added``: arrays of struct<s, k, e>, by start and kind."""
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ("base", "added")]
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    found = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"),
        F.concat(find_all(whole, ASSIGN, 0, 2, 6), find_all(whole, ACCESS, 1), find_all(whole, HEX, 2)).alias("base"),
        find_all(whole, WORD, 3).alias("words"),
    )
    found = materialise(found.select("row", F.transform("base", lambda b: b.dropFields("word")).alias("base"), _tested(F.col("words")).alias("words")), "scanned")
    number = lambda x: F.sum(x.cast("int"))
    counted = found.select(F.explode("words").alias("w")).groupBy("w.stratum").agg(
        number(F.col("w.decoy")).alias("decoys"), number(F.col("w.decoy") & F.col("w.passed")).alias("decoys_passed"),
        number(F.col("w.mixed")).alias("mixed"), number(F.col("w.mixed") & F.col("w.passed")).alias("mixed_passed"),
    )
    good = trusted_strata(counted.collect())  # a row per stratum
    clear = lambda w: ~F.exists("base", lambda b: (b["s"] < w["e"]) & (w["s"] < b["e"]))
    chosen = F.filter("words", lambda w: w["passed"] & w["mixed"] & w["stratum"].isin(good) & clear(w)) if good else F.filter("words", lambda w: F.lit(False))
    added = F.transform(chosen, lambda w: F.struct(w["s"].alias("s"), F.lit(3).alias("k"), w["e"].alias("e")))
    return found.select("row.*", F.array_sort("base").alias("base"), F.array_sort(added).alias("added"))


def spell(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    name = lambda k: F.element_at(F.array(*[F.lit(x) for x in KINDS]), k + 1)
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", name(x["k"]), x["s"], x["e"])), ",")


def secret_digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256 and spans for each document."""
    found = scan_secrets(docs.select("doc_id", "text"), keep=["doc_id"])
    count = lambda k: F.size(F.filter("base", lambda b: b["k"] == k)).cast("long")
    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(spell(F.col("base")), 256).alias("base_sha256"), spell(F.array_sort(F.concat("base", "added"))).alias("spans"),
    )

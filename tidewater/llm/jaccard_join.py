"""N-gram Jaccard join by grouped prefixes.

1.  Words and shingles are hashed where the texts are read.  A table of counters of
    fixed size gives each shingle an approximate frequency; (frequency, hash) is the
    global order, rare first.  Any fixed order is exact; this one keeps passages
    that many documents share out of the prefixes.
2.  Documents with the same set are one class; classes with the same prefix and set
    size are one group.  Postings of a prefix shingle (its bucket) name groups, and
    only shingles of two groups or more have any: they are found by a count and kept
    in a Bloom filter of fixed size.
3.  Group pairs are formed in the buckets and filtered by size and position.  The
    first round pairs each group with hubs of its buckets (the groups with the least
    seeded hash; in crowded buckets several), so a large cluster of near copies costs
    a number of pairs linear in its size.  A second round pairs what is still outside of
    a bucket's main component with hubs from inside it.
4.  Group pairs expand to pairs of classes.  A parity bitmap of each set, whose width
    follows the set's size, bounds the intersection from above; pairs that cannot
    link go.  The rest are verified on the words of the texts themselves, a hub's
    text once for many partners; links become components.
5.  The last round finishes exactly: in every bucket that still holds several
    components, the group pairs of different components are formed, filtered,
    expanded and verified in the same way.

Pairs inside one component need no check, since they cannot change the result; no
bucket, partner list or candidate list has a cap.  Tables of a run are deleted after
their last reader.

Defined cases: a text without words (null, empty, white space) has an empty set and
links with nothing; fewer words than a shingle make one shingle; every row is a
document, rows that share an id too; rows with a null id link like others, and get
the smallest non-null id of their component, or null if it has none; ids may have
any type with an order; other columns, whatever their names, play no part; very long
texts cost memory of their own length times a constant, one or two at a time.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm.common import ASCII_SPACE, Tables, annotate, bloom, bloom_has, bytes_of, slices, texts_of, tidy
from tidewater.llm.components import connected_components, joined_components

WORDS = 5
PERCENT = 80
COUNTER_BITS = 20
FILTER_BITS = 26  # of shared shingles; texts to verify are picked by a filter of a quarter of that
HUBS = 3
LATE_HUBS = 24
AT_ONCE = 8  # seeds of one aggregation
CROWDED = 16  # postings of a bucket from which more hubs pay
PARTNERS = 256  # that share one copy of a hub's text
CHUNK = 1 << 18  # bytes hashed at a time
BROADCAST_BYTES = 16 << 20  # of ids that keep_one may broadcast, as text and 24 bytes each

_SPACE = np.zeros(256, bool)
_SPACE[list(ASCII_SPACE)] = True


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Hashed word shingles of many texts at once; one per worker.

    The hash of a word is a polynomial of its bytes modulo 2**64, read off running sums.
    """

    def __init__(self, words: int):
        self.words = words
        self.odd = _mix(np.arange(1, words + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
        self.power, self.inverse = self._powers(CHUNK)

    @staticmethod
    def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
        base = 0x9E3779B97F4A7C15 | 1
        out = []
        for p in (base, pow(base, -1, 1 << 64)):
            held = np.full(n, p, np.uint64)
            held[0] = 1
            out.append(np.cumprod(held))
        return out[0], out[1]

    def _word_hashes(self, flat: np.ndarray, space: np.ndarray) -> np.ndarray:
        if len(flat) > len(self.power):
            power, inverse = self._powers(len(flat))
        else:
            power, inverse = self.power, self.inverse
        edge = np.diff(np.r_[True, space, True].astype(np.int8))
        starts, ends = np.flatnonzero(edge < 0), np.flatnonzero(edge > 0)
        sums = np.zeros(len(flat) + 1, np.uint64)
        np.cumsum((flat.astype(np.uint64) + np.uint64(1)) * power[: len(flat)], out=sums[1:])
        return _mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))

    def word_hashes(self, texts: list[bytes], fold: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """The hashes of all words in a row, A-Z in lower case if ``fold``, and the number of words of each text."""
        held = b" ".join([*texts, b""])
        flat = np.frombuffer(held.lower() if fold else held, np.uint8)
        space = _SPACE[flat]
        size = np.array([len(t) + 1 for t in texts], np.int64)
        words = (~space[1:] & space[:-1]).astype(np.int32)  # a word begins after a space
        begins = np.concatenate([[0], np.cumsum(np.r_[not space[0], words])]) if len(flat) else np.zeros(1, np.int64)
        per = np.diff(begins[np.r_[0, np.cumsum(size)]]) if len(texts) else np.zeros(0, np.int64)
        out, at = [], 0
        while at < len(flat):  # a chunk ends at white space
            stop = min(len(flat), at + CHUNK)
            if stop < len(flat) and not space[stop]:
                back = np.flatnonzero(space[at:stop])
                if len(back):
                    stop = at + int(back[-1]) + 1
                else:
                    on = np.flatnonzero(space[stop:])
                    stop = stop + int(on[0]) if len(on) else len(flat)
            out.append(self._word_hashes(flat[at:stop], space[at:stop]))
            at = stop
        return np.concatenate([np.zeros(0, np.uint64), *out]), per

    def grams(self, texts: list[bytes]) -> list[np.ndarray]:
        """The shingle hashes (uint64) of each text, in order."""
        hashed, per = self.word_hashes(texts)
        total, w = len(hashed), self.words
        gram = hashed[: max(0, total - w + 1)] * self.odd[0]
        for k in range(1, w):
            gram = (gram ^ (gram >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + hashed[k : total - w + 1 + k] * self.odd[k]
        gram = _mix(gram)
        out, at = [], 0
        for n in per.tolist():
            if n >= w:
                out.append(gram[at : at + n - w + 1])
            elif n:
                one = np.array([n], np.uint64)
                for k in range(at, at + n):
                    one = _mix(one * self.odd[1] ^ hashed[k : k + 1])
                out.append(one)
            else:
                out.append(np.zeros(0, np.uint64))
            at += n
        return out

    def sets(self, texts: list[bytes]) -> list[np.ndarray]:
        """The sorted distinct shingle hashes of each text."""
        out = []
        for g in self.grams(texts):
            g = np.sort(g)
            out.append(g[np.r_[True, g[1:] != g[:-1]]] if len(g) else g)
        return out


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1 if n else 0


def _plain(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    own = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    return own.select("id", F.xxhash64("id", "text").alias("row_key"), "text")


def shingle_counts(plain: DataFrame, words: int = WORDS, bits: int = COUNTER_BITS) -> np.ndarray:
    """How often shingles of each of 2**bits cells of the hash range occur in all documents.

    Each task adds into one table and sends its pieces; the pieces of a cell range
    are added up as they stream in; the driver gets 2**bits numbers.
    """
    chunk = 1 << 12

    def count(batches):
        shingler, mine, held, n = Shingler(words), np.zeros(1 << bits, np.uint32), [], 0

        def flush():
            mine[:] += np.bincount(np.concatenate(held), minlength=1 << bits).astype(np.uint32)
            held.clear()

        for batch in batches:
            for cut in slices(batch, "text"):
                for g in shingler.grams(bytes_of(cut, "text")):
                    held.append((g >> np.uint64(64 - bits)).astype(np.int32))
                    n += len(g)
                if n > 1 << bits:
                    flush()
                    n = 0
        if held:
            flush()
        for at in np.flatnonzero(mine.reshape(-1, chunk).any(axis=1)).tolist():
            part = mine[at * chunk : (at + 1) * chunk]
            small = part.max() < 256
            yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([part.astype(np.uint8 if small else np.uint32).tobytes()])], names=["chunk", "cells"])

    def add(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for at, cells in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                held[at] = held.get(at, 0) + np.frombuffer(cells, np.uint8 if len(cells) == chunk else np.uint32).astype(np.int64)
        for at, cells in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([np.minimum(cells, 2**32 - 1).astype(np.uint32).tobytes()])], names=["chunk", "cells"])

    pieces = plain.select("text").mapInArrow(tidy(count), "chunk int, cells binary").repartition("chunk").mapInArrow(tidy(add), "chunk int, cells binary").toArrow()
    out = np.zeros(1 << bits, np.uint32)
    for at, cells in zip(pieces["chunk"].to_pylist(), pieces["cells"].to_pylist(), strict=True):
        out[at * chunk : (at + 1) * chunk] = np.frombuffer(cells, np.uint32)
    return out


def parity_bits(s: np.ndarray) -> bytes:
    """Which of w places hold an odd number of the set's hashes; w is the power of two from twice the set's size on."""
    w = max(64, 1 << int(2 * len(s) - 1).bit_length())
    return np.packbits((np.bincount((s & np.uint64(w - 1)).astype(np.int64), minlength=w) & 1).astype(np.uint8), bitorder="little").tobytes()


def most_common(na: int, a: bytes, nb: int, b: bytes) -> int:
    """An upper bound of the intersection: every odd place is a hash that only one set has."""
    if len(a) > len(b):
        a, b = b, a
    x, y, w = int.from_bytes(a, "little"), int.from_bytes(b, "little"), 8 * len(b)
    while w > 8 * len(a):
        w >>= 1
        y = (y & ((1 << w) - 1)) ^ (y >> w)
    return min(na, nb, (na + nb - (x ^ y).bit_count()) // 2)


def prefixes(plain: DataFrame, counts: np.ndarray, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """id, row_key, n, digest of the set, digest of the prefix, the prefix in the global order, and the parity bitmap."""
    bits = int(len(counts)).bit_length() - 1
    shared = plain.sparkSession.sparkContext.broadcast(counts)  # 2**bits numbers of 4 bytes

    def start():
        shingler, often = Shingler(words), shared.value

        def run(batch):
            sets = shingler.sets(bytes_of(batch, "text"))
            heads = []
            for s in sets:
                rank = np.minimum(often[(s >> np.uint64(64 - bits)).astype(np.int64)], 2**20 - 1).astype(np.uint64) << np.uint64(44) | s >> np.uint64(20)
                heads.append(s[np.argsort(rank, kind="stable")[: prefix_length(len(s), percent)]])
            ends = np.cumsum([0, *map(len, heads)], dtype=np.int32)
            prefix = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.uint64), *heads]).view(np.int64)))
            return [[len(s) for s in sets], [xxhash.xxh3_128_digest(s.tobytes()) for s in sets], [xxhash.xxh3_128_digest(h.tobytes()) for h in heads], prefix, [parity_bits(s) for s in sets]]

        return run

    fields = [("n", T.LongType()), ("digest", T.BinaryType()), ("mark", T.BinaryType()), ("prefix", T.ArrayType(T.LongType())), ("bits", T.BinaryType())]
    return annotate(plain, fields, start, "text", ["id", "row_key"])


def _postings(groups: DataFrame, bits: int) -> DataFrame:
    """(token, gid, n, at) for the prefix shingles that pass the filter of shared ones."""
    tokens = groups.select(F.explode("prefix").alias("token"))
    shared = groups.sparkSession.sparkContext.broadcast(bloom(tokens.groupBy("token").agg(F.count("*").alias("k")).where("k > 1"), "token", bits))

    def pick(batches):
        table = shared.value
        for batch in batches:
            prefix = batch.column(2)
            size = pc.list_value_length(prefix).to_numpy()
            token = prefix.flatten().to_numpy()
            row = np.repeat(np.arange(len(size)), size)
            at = np.arange(len(token)) - np.repeat(np.cumsum(size) - size, size)
            ok = np.flatnonzero(bloom_has(table, token))
            yield pa.RecordBatch.from_arrays([pa.array(token[ok]), batch.column(0).take(pa.array(row[ok])), batch.column(1).take(pa.array(row[ok])), pa.array(at[ok].astype(np.int32))], names=["token", "gid", "n", "at"])

    return groups.select("gid", "n", "prefix").mapInArrow(tidy(pick), "token long, gid long, n long, at int")


def _may_link(na, nb, pa_, pb, percent: int):
    """Size and position filters: can sets of these sizes that meet at these prefix places still link?"""
    bound = F.least(na - pa_, nb - pb)
    return (100 * F.least(na, nb) >= percent * F.greatest(na, nb)) & ((100 + percent) * bound >= percent * (na + nb))


def _in_order(pairs: DataFrame, a: str, b: str) -> DataFrame:
    return pairs.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))


def _nearest_hubs(seekers: DataFrame, hosts: DataFrame, seeds: range, percent: int) -> DataFrame:
    """Group pairs: for each seed, a seeker with the host of least seeded hash in all its buckets that may link with it.

    Seeds other than the first ask only in crowded buckets.
    """
    best = [F.min(F.struct(F.xxhash64(F.lit(s), "gid").alias("h"), F.col("gid").alias("hub"), F.col("n").alias("hn"), F.col("at").alias("hat"))).alias(f"h{s}") for s in seeds]
    met = seekers.select("token", "gid", "n", "at").join(hosts.groupBy("token").agg(F.count("*").alias("size"), *best), "token")

    def ok(s):
        fits = (F.col(f"h{s}.hub") != F.col("gid")) & _may_link(F.col("n"), F.col(f"h{s}.hn"), F.col("at"), F.col(f"h{s}.hat"), percent)
        return fits & (F.col("size") >= CROWDED) if s != seeds[0] else fits

    chosen = met.groupBy("gid").agg(*[F.min(F.when(ok(s), F.struct(F.col(f"h{s}.h").alias("h"), F.col(f"h{s}.hub").alias("hub")))).alias(f"h{s}") for s in seeds])
    pairs = chosen.select("gid", F.explode(F.array_distinct(F.filter(F.array(*[F.col(f"h{s}.hub") for s in seeds]), lambda x: x.isNotNull()))).alias("hub"))
    return _in_order(pairs, "gid", "hub").distinct()


def _expand_hubs(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """Class pairs of group pairs: each member of a group with the first class of the other; and members with their own first class."""
    mine = members.select(F.col("gid").alias("a"), "uid")
    one = pairs.join(mine, "a", "left").select(F.coalesce("uid", "a").alias("a"), "b")
    two = pairs.join(mine.withColumnRenamed("a", "b"), "b", "left").select("a", F.coalesce("uid", "b").alias("b"))
    inside = members.where("uid != gid").select(F.col("gid").alias("a"), F.col("uid").alias("b"))
    return _in_order(one.unionAll(two).unionAll(inside), "a", "b").distinct()


def _open_groups(postings: DataFrame, members: DataFrame, components: DataFrame) -> DataFrame:
    """Postings of buckets that hold several components, with the group's component (negative: its own, as its classes differ) and the bucket's main one."""
    placed = members.join(components.withColumnRenamed("node", "uid"), "uid", "left").groupBy("gid").agg(F.min(F.coalesce("component", "uid")).alias("low"), F.max(F.coalesce("component", "uid")).alias("high"))
    torn = placed.select("gid", F.when(F.col("low") == F.col("high"), F.col("low")).otherwise(-1 - F.col("gid")).alias("torn"))
    own = postings.join(components.withColumnRenamed("node", "gid"), "gid", "left").join(torn, "gid", "left")
    own = own.select("token", "gid", "n", "at", F.coalesce("torn", "component", "gid").alias("c"))
    per = own.groupBy("token", "c").agg(F.count("*").alias("k"))
    main = per.groupBy("token").agg(F.count("*").alias("cs"), F.max(F.struct("k", "c"))["c"].alias("main")).where("cs > 1").drop("cs")
    return own.join(main, "token")


FOLDS = [f"fold{k}" for k in range(5)]


def _folded(classes: DataFrame, members: DataFrame) -> DataFrame:
    """gid and parity bitmap, folded to 64 places and, where it has as many, to 256, of groups of one class."""

    def fold(batches):
        for batch in batches:
            out = []
            for bits in batch.column(1).to_pylist():
                words = np.frombuffer(bits, np.int64)
                four = np.bitwise_xor.reduce(words.reshape(-1, 4), axis=0).tolist() if len(words) >= 4 else [None] * 4
                out.append([int(np.bitwise_xor.reduce(words)), *four])
            columns = [pa.array(c, pa.int64()) for c in zip(*out, strict=True)] or [pa.array([], pa.int64())] * 5
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["gid", *FOLDS])

    alone = classes.select(F.col("uid").alias("gid"), "bits").join(members.select("gid").distinct(), "gid", "left_anti")
    return alone.mapInArrow(tidy(fold), "gid long, " + ", ".join(f"{f} long" for f in FOLDS))


def _parity_allows(na, nb, a: str, b: str, percent: int):
    """Whether the places at which the folded bitmaps differ, each a shingle of one set alone, leave room for a link; unknown bitmaps do."""
    apart = [F.bit_count(F.col(f"{a}_{f}").bitwiseXOR(F.col(f"{b}_{f}"))) for f in FOLDS]
    most = F.coalesce(F.greatest(apart[0], sum(apart[2:], apart[1])), F.lit(0))
    return (100 + percent) * (na + nb - most) >= 2 * percent * (na + nb)


def _open_pairs(opened: DataFrame, members: DataFrame, components: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Class pairs of different components whose groups share a prefix shingle.

    Group pairs are formed and filtered first, those of single classes by their
    folded bitmaps too, before they leave the bucket; then they, and groups whose own
    classes are in several components, expand to classes.
    """
    opened = opened.join(_folded(classes, members), "gid", "left")
    side = lambda x: opened.select("token", *[F.col(c).alias(f"{x}_{c}") for c in ("gid", "n", "at", "c", "main", *FOLDS)])
    few, every = side("a").where("a_c != a_main"), side("b").drop("b_main")
    once = (F.col("b_c") == F.col("a_main")) | (F.col("a_gid") < F.col("b_gid"))
    rule = (few["token"] == every["token"]) & (F.col("a_c") != F.col("b_c")) & once & _may_link(F.col("a_n"), F.col("b_n"), F.col("a_at"), F.col("b_at"), percent) & _parity_allows(F.col("a_n"), F.col("b_n"), "a", "b", percent)
    groups = _in_order(few.join(every, rule), "a_gid", "b_gid").distinct()
    groups = groups.unionAll(members.where("uid != gid").select(F.col("gid").alias("a"), F.col("gid").alias("b")).distinct())
    mine = members.select(F.col("gid").alias("a"), "uid")
    one = groups.join(mine, "a", "left").select(F.coalesce("uid", "a").alias("a"), "b")
    two = one.join(mine.withColumnRenamed("a", "b"), "b", "left").select("a", F.coalesce("uid", "b").alias("b"))
    return _apart(_in_order(two.where("a != b"), "a", "b").distinct(), components)


def _apart(pairs: DataFrame, components: DataFrame) -> DataFrame:
    """The pairs whose ends are in different components."""
    for end in ("a", "b"):
        pairs = pairs.join(components.select(F.col("node").alias(end), F.col("component").alias(f"c{end}")), end, "left")
    return pairs.where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b")


def _bounded(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs whose bitmaps leave room for a link."""

    def run(batches):
        for batch in batches:
            a, b = batch.column(0), batch.column(1)
            ok = [(100 + percent) * most_common(na, x, nb, y) >= percent * (na + nb) for na, x, nb, y in zip(*(batch.column(k).to_pylist() for k in range(2, 6)), strict=True)]
            yield pa.RecordBatch.from_arrays([a.filter(pa.array(ok, pa.bool_())), b.filter(pa.array(ok, pa.bool_()))], names=["a", "b"])

    for end in ("a", "b"):
        pairs = pairs.join(classes.select(F.col("uid").alias(end), F.col("n").alias(f"n{end}"), F.col("bits").alias(f"bits{end}")), end)
    return pairs.select("a", "b", "na", "bitsa", "nb", "bitsb").mapInArrow(tidy(run), "a long, b long")


def word_shingles(text: bytes, words: int) -> set:
    """The distinct shingles of a text, as tuples of words."""
    held = text.lower().split()
    if len(held) < words:
        return {tuple(held)} if held else set()
    return set(zip(*[held[k:] for k in range(words)], strict=False))


def _verify(pairs: DataFrame, classes: DataFrame, plain: DataFrame, words: int, percent: int, bits: int):
    """The pairs whose sets link, decided on words; and the broadcast filter, to be destroyed when they are written.

    The end with more partners is the host; its text goes once to each lot of about
    ``PARTNERS`` guests, whose texts stream past it.  Texts are read again for the
    classes in pairs only (a filter lets a few others pass).
    """
    ends = pairs.select(F.col("a").alias("uid")).unionAll(pairs.select(F.col("b").alias("uid"))).groupBy("uid").agg(F.count("*").alias("k"))
    for end in ("a", "b"):
        pairs = pairs.join(ends.select(F.col("uid").alias(end), F.col("k").alias(f"k{end}")), end)
    first = (F.col("ka") > F.col("kb")) | ((F.col("ka") == F.col("kb")) & (F.col("a") < F.col("b")))
    pick_end = lambda x, y: F.when(first, F.col(x)).otherwise(F.col(y))
    lots = F.ceil(pick_end("ka", "kb") / PARTNERS)
    placed = pairs.select(pick_end("a", "b").alias("host"), pick_end("b", "a").alias("uid"), F.pmod(F.xxhash64(pick_end("b", "a")), lots).alias("lot"))
    roles = placed.select("uid", "host", "lot", F.lit(1).alias("side")).unionAll(placed.select(F.col("host").alias("uid"), "host", "lot", F.lit(0).alias("side")).distinct())
    keyed = roles.join(classes.select("uid", "digest"), "uid")
    wanted = classes.select("uid", "row_key").join(ends.select("uid"), "uid", "left_semi")
    shared = plain.sparkSession.sparkContext.broadcast(bloom(wanted, "row_key", bits))

    def pick(batches):
        table, shingler, seen = shared.value, Shingler(words), set()
        for batch in batches:
            ok = bloom_has(table, batch.column(0).to_numpy())
            for cut in slices(batch.filter(pa.array(ok)), "text"):
                held = texts_of(cut, "text")
                digests = [xxhash.xxh3_128_digest(s.tobytes()) for s in shingler.sets(bytes_of(cut, "text"))]
                new = [k for k, d in enumerate(digests) if not (d in seen or seen.add(d))]
                if len(seen) > 100_000:
                    seen.clear()
                yield pa.RecordBatch.from_arrays([pa.array([digests[k] for k in new], pa.binary()), pa.array([held[k] for k in new], pa.string())], names=["digest", "text"])

    def link(batches):
        at, host = None, set()
        for batch in batches:
            good_a, good_b = [], []
            for where, lot, side, uid, text in zip(*(batch.column(k).to_pylist() for k in range(4)), bytes_of(batch, "text"), strict=True):
                mine = word_shingles(text, words)
                if side == 0:
                    at, host = (where, lot), mine
                elif at == (where, lot):
                    both = len(host & mine)
                    if both and 100 * both >= percent * (len(host) + len(mine) - both):
                        good_a.append(min(where, uid))
                        good_b.append(max(where, uid))
            yield pa.RecordBatch.from_arrays([pa.array(good_a, pa.int64()), pa.array(good_b, pa.int64())], names=["a", "b"])

    texts = plain.select("row_key", "text").mapInArrow(tidy(pick), "digest binary, text string")
    dealt = keyed.join(texts, "digest").select("host", "lot", "side", "uid", "text").repartition("host", "lot").sortWithinPartitions("host", "lot", "side")
    return dealt.mapInArrow(tidy(link), "a long, b long").distinct(), shared


def _one_each(pairs: DataFrame) -> DataFrame:
    """One pair for each class in pairs, most of them with the same few partners."""
    both = pairs.select("a", "b").unionAll(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min(F.struct(F.xxhash64("b").alias("h"), "b"))["b"].alias("b"))
    return _in_order(least, "a", "b").distinct()


def similar_documents(docs: DataFrame, id_col: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT, hubs: int = HUBS, late_hubs: int = LATE_HUBS, counter_bits: int = COUNTER_BITS, filter_bits: int = FILTER_BITS) -> DataFrame:
    """doc_id, n_shingles and component_id, one row per row of ``docs``.

    Documents link when 100 * intersection >= percent * union of their shingle sets.
    """
    plain = _plain(docs, id_col, text)
    tables = Tables(docs.sparkSession, "jaccard")
    rows = tables.save(prefixes(plain, shingle_counts(plain, words, counter_bits), words, percent), "rows")
    own = [F.first(c).alias(c) for c in ("n", "mark", "prefix", "bits")]
    classes = rows.where("n > 0").groupBy("digest").agg(F.min("id").alias("least_id"), F.min("row_key").alias("row_key"), *own)
    classes = tables.save(classes.withColumn("uid", F.monotonically_increasing_id()), "classes")
    rows = tables.save(rows.select("id", "n", "digest"), "sizes")
    tables.drop("rows")
    several = classes.groupBy("mark", "n").agg(F.min("uid").alias("gid"), F.count("*").alias("of")).where("of > 1")
    members = tables.save(classes.select("uid", "mark", "n").join(several, ["mark", "n"]).select("uid", "gid"), "members")
    groups = classes.select(F.col("uid").alias("gid"), "n", "prefix").join(members.where("uid != gid").select(F.col("uid").alias("gid")), "gid", "left_anti")
    postings = tables.save(_postings(groups, filter_bits), "postings")

    def joined_by(pairs: DataFrame, name: str, components: DataFrame | None) -> DataFrame:
        """The components after verifying ``pairs``; without a new link they stay as they are."""
        pairs = tables.save(pairs, name)
        if components is not None and pairs.isEmpty():
            return components
        found, shared = _verify(pairs, classes, plain, words, percent, max(10, filter_bits - 2))
        links = tables.save(found, f"{name}_links")
        shared.destroy()
        if components is None:
            return connected_components(links)
        return components if links.isEmpty() else tables.save(joined_components(components, links), f"{name}_components")

    def expanded(hub_pairs: DataFrame, name: str) -> DataFrame:
        return tables.save(_bounded(_expand_hubs(hub_pairs, members), classes, percent), name)

    near = expanded(_nearest_hubs(postings, postings, range(max(1, hubs)), percent), "near")
    components = joined_by(_one_each(near), "near_one", None)
    components = joined_by(_apart(near, components), "near_rest", components)
    mixed = tables.save(_open_groups(postings, members, components), "mixed")
    asked = []
    for first in range(100, 100 + max(1, late_hubs), AT_ONCE):
        seeds = range(first, min(first + AT_ONCE, 100 + max(1, late_hubs)))
        asked.append(tables.save(_nearest_hubs(mixed.where("c != main"), mixed.where("c = main"), seeds, percent), f"asked{first}"))
    late = expanded(reduce(DataFrame.unionAll, asked).distinct(), "late")
    components = joined_by(_one_each(_apart(late, components)), "late_one", components)
    components = joined_by(_apart(late, components), "late_rest", components)
    mixed = tables.save(_open_groups(postings, members, components), "open")
    components = joined_by(_bounded(_open_pairs(mixed, members, components, classes, percent), classes, percent), "last", components)
    tables.drop("postings", "near", "mixed", *[f"asked{first}" for first in range(100, 100 + max(1, late_hubs), AT_ONCE)], "late", "open")
    tables.drop(*[name + part for name in ("near_one", "near_rest", "late_one", "late_rest", "last") for part in ("", "_links")])

    placed = classes.select("uid", "digest", "least_id").join(components.withColumnRenamed("node", "uid"), "uid", "left").select("digest", "least_id", F.coalesce("component", "uid").alias("c"))
    of = tables.save(placed.join(placed.groupBy("c").agg(F.min("least_id").alias("component_id")), "c").select("digest", "component_id"), "component_ids")
    tables.drop("classes", "members")
    joined = rows.join(of, "digest", "left")
    return joined.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("component_id")).alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row of each component: the smallest id, null after all others; then the smallest hash of the text.

    Rows are told apart by id and text (a hash of 64 bits), so texts of one id that are
    not similar both stay; of rows with words that agree in both, the least by all
    columns stays.  Rows without words are no copies.
    """
    key = F.struct(F.col(f"`{id_col}`").isNull().alias("none"), F.col(f"`{id_col}`").alias("id"), F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("hash"))
    tables = Tables(docs.sparkSession, "keep_one")
    found = tables.save(similar_documents(docs.select(key.alias("key"), F.col(f"`{text}`").alias("text")), "key", "text", **options).where("n_shingles > 0").select("doc_id", "component_id"), "similar")
    gone = tables.save(found.where("doc_id != component_id").select(F.col("doc_id").alias("__gone")).distinct(), "gone")
    if (gone.agg(F.sum(24 + F.coalesce(F.octet_length(F.col("__gone.id").cast("string")), F.lit(0)))).first()[0] or 0) <= BROADCAST_BYTES:
        gone = F.broadcast(gone)
    stay = docs.join(gone, key == gone["__gone"], "left_anti")
    again = tables.save(found.where("doc_id = component_id").groupBy(F.col("doc_id").alias("__again")).agg(F.count("*").alias("k")).where("k > 1").select("__again"), "again")
    tables.drop("similar")
    if again.isEmpty():
        return stay
    once = stay.join(again, key == again["__again"], "left_semi").groupBy(key.alias("__key")).agg(F.min(F.struct(*[F.col(f"`{c}`") for c in docs.columns])).alias("__row"))
    return stay.join(again, key == again["__again"], "left_anti").unionByName(once.select("__row.*"))

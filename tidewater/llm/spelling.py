"""Spelling variants: words one edit apart, found by an index of variable-length grams.

Counting: runs of Latin letters are counted where the texts are read, with a few
occurrences altered as the contract asks; partial counts are summed by word.

Gram dictionary: all grams of 2 to 5 letters that occur in the vocabulary more often
than a bound are *frequent*, and a gram is extended by one more letter exactly while
it is frequent.  The bound rises with the vocabulary so that at most ``FREQUENT``
grams are, and these alone are sent to the tasks.

Decomposition: at each place of a word stands the longest such gram, of at most half
the word's length and six letters; a gram inside an earlier one is left out.  An edit
at a place can only touch the grams over it, and hide those that end within reach
behind it; the most that any edit can affect is the word's bound.  Two words one edit
apart thus share their other grams, at places that differ by at most the one letter,
and as every word keeps at least one, each needs lists only for its rarest
``bound + 1`` grams.

Lists: a list holds the words with one gram at one place for one length: equal
lengths meet for replaced letters, and a length with the next for an inserted one.
Lists are merged in tasks that stream through sorted entries; a pair that shares a
list is compared letter by letter, at most ``PAIRS`` pairs at a time.  A list of over
``LIST`` entries is not compared: its words go on to lists keyed by the word with
one letter left out, whose members are neighbours by themselves and at most as
many as there are letters.

Defined cases: a null or empty text has no words; a null id counts as the empty text
in the altering hash; repeated rows count each; no words give an empty result; words
and texts of any length are taken whole; other columns are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import Tables, runs_of, slices, texts_of
from tidewater.llm.resample import JoinedCrc

SLICE = 8 << 20
HELD = 500_000  # distinct words that a task sums before it sends them on
FREQUENT = 1 << 17  # grams that are extended, at most
RARE = 30  # a gram of up to so many occurrences is never extended
SHORTEST, LONGEST = 2, 6  # letters of a gram
LIST = 4096
PAIRS = 1 << 18
_LATIN = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256))


# --- words -------------------------------------------------------------------

def altered(run: bytes, h: int) -> bytes:
    """``run`` without the letter that ``h`` chooses."""
    k = h % len(run)
    return run[:k] + run[k + 1 :]


def _count(texts: list[str | None], ids: list, every: int, joined: JoinedCrc) -> tuple[list[bytes], np.ndarray]:
    """Words (Latin-1) and counts of a slice, altered runs included."""
    doc, runs = runs_of([(t or "").encode("latin-1", "replace") for t in texts], _LATIN)
    coded = runs.dictionary_encode()
    distinct = coded.dictionary.to_pylist()
    d = max(1, len(distinct))
    key, n = np.unique(doc * d + coded.indices.to_numpy(), return_counts=True)
    doc, run = key // d, key % d
    plain = [w.decode("latin-1").encode() for w in distinct]
    crc, size = np.fromiter(map(zlib.crc32, plain), np.uint32, len(plain)), np.fromiter(map(len, plain), np.int64, len(plain))
    before = np.array([zlib.crc32(f"{'' if i is None else i}:".encode()) for i in ids], np.uint32)
    h = joined.ahead(before[doc], size[run]) ^ crc[run]
    hit = h % np.uint32(every) == 0
    count = np.bincount(run[~hit], n[~hit], len(distinct)).astype(np.int64)
    return distinct + [altered(distinct[r], int(x)) for r, x in zip(run[hit], h[hit], strict=True)], np.append(count, n[hit])


def word_counts(docs: DataFrame, id_col: str = "doc_id", text: str = "text", every: int = 199, min_chars: int = 6, min_n: int = 5) -> DataFrame:
    """(word, n): words of ``min_chars`` letters or more with at least ``min_n`` occurrences; ``word`` is Latin-1 bytes."""

    def run(batches):
        joined, total = JoinedCrc(), {}

        def rows():
            out = pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.binary()), pa.array(total.values(), pa.int64())], names=["word", "n"])
            total.clear()
            return out

        for batch in batches:
            for cut in slices(batch, "text", SLICE):
                for w, n in zip(*_count(texts_of(cut, "text"), cut.column(0).to_pylist(), every, joined), strict=True):
                    if n and len(w) >= min_chars:
                        total[w] = total.get(w, 0) + int(n)
                if len(total) > HELD:
                    yield rows()
        yield rows()

    parts = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text")).mapInArrow(run, "word binary, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_n)


# --- grams -------------------------------------------------------------------

def _by_length(words: list[bytes], cells: int = 1 << 20):
    """Rows of words of one length, and their letters as a matrix of about ``cells`` cells at most."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    for k in np.unique(size):
        own = np.flatnonzero(size == k)
        step = max(1, cells // max(1, int(k)))
        for a in range(0, len(own), step):
            rows = own[a : a + step]
            yield rows, np.frombuffer(b"".join(words[i] for i in rows), np.uint8).reshape(len(rows), int(k))


def _codes(letters: np.ndarray, longest: int) -> dict[int, np.ndarray]:
    """By gram length: a number for the gram at each place, its bytes and its length."""
    wide, out, code = letters.astype(np.int64), {}, None
    for q in range(1, longest + 1):
        places = letters.shape[1] - q + 1
        if places < 1:
            break
        code = (code[:, :places] if q > 1 else 0) | wide[:, q - 1 :] << 8 * (q - 1)
        out[q] = code | q << 56
    return out


def frequent_grams(words: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and counts of the grams that are extended, at most ``FREQUENT`` of them."""

    def run(batches):
        held, size = [], 0

        def rows():
            code, n = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(code), pa.array(n)], names=["gram", "n"])

        for batch in batches:
            for _, letters in _by_length(texts_of(batch, "word")):
                for q, code in _codes(letters, LONGEST - 1).items():
                    if q >= SHORTEST:
                        held.append(code.reshape(-1))
                        size += held[-1].size
                if size > 1 << 21:
                    yield rows()
                    size = 0
        if held:
            yield rows()

    grams = words.select("word").mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    grams = Tables(words.sparkSession, "grams").save(grams, "grams")
    bound = max(RARE, -(-(grams.agg(F.sum("n")).first()[0] or 0) // FREQUENT))
    found = grams.where(F.col("n") > bound).orderBy("gram").toArrow()
    return found["gram"].to_numpy(), found["n"].to_numpy()


class Decomposer:
    """Variable grams of words, and how many of them one edit can affect."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray):
        self.grams, self.counts = np.append(grams, np.int64(2**63 - 1)), np.append(counts, 0)

    def often(self, code: np.ndarray) -> np.ndarray:
        """Occurrences of frequent grams, 0 of others."""
        at = np.searchsorted(self.grams, code)
        return np.where(self.grams[at] == code, self.counts[at], 0)

    def grams_of(self, letters: np.ndarray, longest: int):
        """For each word and place: the gram's number, length and count, and whether it is in the decomposition."""
        codes = _codes(letters, longest)
        rows, size = letters.shape
        places = size - SHORTEST + 1
        code, length = codes[SHORTEST].copy(), np.full((rows, places), SHORTEST)
        n = self.often(code)
        for q in range(SHORTEST + 1, longest + 1):
            if q not in codes:
                break
            grow = np.flatnonzero(((n > 0) & (length == q - 1) & (np.arange(places) < size - q + 1)).reshape(-1))
            longer = codes[q][grow // places, grow % places]
            code.reshape(-1)[grow], length.reshape(-1)[grow] = longer, q
            n.reshape(-1)[grow] = self.often(longer)
        end = np.arange(places) + length
        stays = np.ones((rows, places), bool)
        stays[:, 1:] = end[:, 1:] > np.maximum.accumulate(end, axis=1)[:, :-1]
        return code, length, n, stays

    @staticmethod
    def affected(length: np.ndarray, n: np.ndarray, stays: np.ndarray, size: int, longest: int, insert: bool) -> np.ndarray:
        """The most grams of each word that one edit can affect: a letter put in, or one replaced or left out."""
        rows, places = length.shape
        spots = size + 1 if insert else size
        touched = np.zeros((rows, spots + longest), np.int64)
        for d in range(1 - longest, longest):  # place of the gram less place of the edit
            a, b = max(0, -d), min(spots, places - d)
            if a >= b:
                continue
            own = slice(a + d, b + d)
            size_, here = length[:, own], stays[:, own]
            if insert:
                ends = own.start + np.arange(b - a) + size_ == size
                last = np.arange(a, b) == size
                hit = (size_ > -d) if d < 0 else size_ + d <= longest - 1
                hit = hit | (last & ends & (n[:, own] > 0) & (size_ < longest)) if d < 0 else hit
            else:
                hit = (size_ > -d) if d <= 0 else size_ + d <= longest
            touched[:, a:b] += here & hit
        return touched[:, :spots].max(1)


_MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x + _MIX[0]) * _MIX[1]
    x = (x ^ x >> np.uint64(29)) * _MIX[2]
    return x ^ x >> np.uint64(32)


#: Roles of a word in a list: meets words of its length, is the shorter one, is the longer one.
SAME, SHORTER, LONGER = 0, 1, 2


def _entries(letters: np.ndarray, made: Decomposer, min_chars: int):
    """(row, key, role) for the lists of words of one length."""
    size = letters.shape[1]
    for role in (SAME, SHORTER, LONGER):
        band = size - 1 if role == LONGER else size
        if band < min_chars:
            continue
        longest = max(SHORTEST, min(LONGEST, band // 2))
        code, length, n, stays = made.grams_of(letters, longest)
        need = made.affected(length, n, stays, size, longest, role == SHORTER) + 1
        order = np.argsort(code, axis=1, kind="stable")
        order = np.take_along_axis(order, np.argsort(np.take_along_axis(np.where(stays, n, 2**62), order, 1), axis=1, kind="stable"), 1)
        least = np.arange(order.shape[1]) < np.minimum(need, stays.sum(1))[:, None]
        row, k = np.nonzero(least)
        place = order[row, k]
        gram = code[row, place].astype(np.uint64)
        for shift in (0, 1) if role == SHORTER else (0,):
            list_ = np.uint64(band << 1 | (role != SAME)) << np.uint64(32) | (place + shift).astype(np.uint64)
            yield row, _mixed(gram ^ _mixed(list_)).view(np.int64), role


def list_entries(words: DataFrame, grams: np.ndarray, counts: np.ndarray, min_chars: int) -> DataFrame:
    """(key, role, word, n): each word in the lists it needs."""

    def run(batches):
        made = Decomposer(grams, counts)
        for batch in batches:
            words, n = texts_of(batch, "word"), batch.column(1)
            for rows, letters in _by_length(words):
                for row, key, role in _entries(letters, made, min_chars):
                    at = pa.array(rows[row])
                    yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(np.full(len(row), role, np.int8)), batch.column(0).take(at), n.take(at)], names=["key", "role", "word", "n"])

    return words.select("word", "n").mapInArrow(run, "key long, role byte, word binary, n long")


# --- lists -------------------------------------------------------------------

def one_edit(a: bytes, b: bytes) -> bool:
    """Whether exactly one letter is put in, left out or replaced."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    k = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[k + (len(a) == len(b)) :] == b[k + 1 :]


class _Letters:
    """Words as rows of a byte matrix, compared pair by pair; words over 64 letters one by one."""

    WIDE = 64

    def __init__(self, words: list[bytes]):
        self.words, self.size = words, np.fromiter(map(len, words), np.int64, len(words))
        wide = min(self.WIDE, int(self.size.max(initial=1)))
        wide = -(-(wide + 1) // 8) * 8
        self.m = np.frombuffer(b"".join(w[:wide].ljust(wide, b"\0") for w in words), np.uint8).reshape(len(words), wide)
        self.lanes = self.m.view(np.uint64)
        self.long = self.size > self.WIDE

    def near(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether the words of the pairs (i, j) are one edit apart; a pair's first word is not the longer one."""
        gap = self.size[j] - self.size[i]
        out = np.zeros(len(i), bool)
        own = np.flatnonzero(gap == 0)
        low, top = np.uint64(0x7F7F7F7F7F7F7F7F), np.uint64(0x8080808080808080)
        differ = np.zeros(len(own), np.int64)
        for lane in range(self.lanes.shape[1]):
            x = self.lanes[i[own], lane] ^ self.lanes[j[own], lane]
            differ += np.bitwise_count(((x & low) + low | x) & top)
        out[own] = differ == 1
        own = np.flatnonzero(gap == 1)
        a, b = self.m[i[own]], self.m[j[own]]
        head = np.logical_and.accumulate(a == b, axis=1)
        inside = np.arange(a.shape[1] - 1) < self.size[i[own], None]
        out[own] = (head[:, :-1] | (a[:, :-1] == b[:, 1:]) | ~inside).all(1)
        for k in np.flatnonzero(self.long[i] | self.long[j]):
            out[k] = one_edit(self.words[i[k]], self.words[j[k]])
        return out


_FOUND = pa.schema([("a", pa.binary()), ("a_n", pa.int64()), ("b", pa.binary()), ("b_n", pa.int64()), ("role", pa.int8())])


def _compare(key: np.ndarray, role: np.ndarray, words: list[bytes], n: np.ndarray):
    """The near pairs of whole lists, sorted by key and role."""
    size = len(key)
    new = np.ones(size, bool)
    new[1:] = (key[1:] != key[:-1]) | (role[1:] != role[:-1])
    start = np.flatnonzero(new)
    end = np.append(start[1:], size)
    block = np.cumsum(new) - 1
    lo, hi = np.arange(size) + 1, end[block]
    after = np.minimum(block + 1, len(start) - 1)
    meets = (role == SHORTER) & (after > block) & (key[start[after]] == key) & (role[start[after]] == LONGER)
    lo, hi = np.where(role == SAME, lo, start[after]), np.where(role == SAME, hi, end[after])
    many = np.where((role == SAME) | meets, hi - lo, 0)
    matrix, total = None, np.cumsum(many)
    a = 0
    while a < size:
        b = max(a + 1, int(np.searchsorted(total, (total[a - 1] if a else 0) + PAIRS, "right")))
        if k := int(many[a:b].sum()):
            matrix = matrix or _Letters(words)
            i = np.repeat(np.arange(a, b), many[a:b])
            j = np.arange(k) - np.repeat(np.cumsum(many[a:b]) - many[a:b], many[a:b]) + np.repeat(lo[a:b], many[a:b])
            near = matrix.near(i, j)
            i, j = i[near], j[near]
            if len(i):
                yield pa.RecordBatch.from_arrays([pa.array([words[x] for x in i], pa.binary()), pa.array(n[i]), pa.array([words[x] for x in j], pa.binary()), pa.array(n[j]), pa.nulls(len(i), pa.int8())], schema=_FOUND)
        a = b


def merged_lists(entries: DataFrame, most: int = LIST) -> DataFrame:
    """Near pairs (a, a_n, b, b_n), pairs of several lists repeated; words of lists over ``most`` entries as (a, a_n, role)."""

    def run(batches):
        held = None  # the last list so far, which may go on
        crowded = None  # the key of a list that is over the bound

        def words_only(batch):
            return pa.RecordBatch.from_arrays([batch["word"], batch["n"], pa.nulls(len(batch), pa.binary()), pa.nulls(len(batch), pa.int64()), batch["role"]], schema=_FOUND)

        def whole(batch):
            """Compare the lists of a batch, but those over the bound."""
            key = batch["key"].to_numpy()
            size = np.diff(np.append(edges := np.flatnonzero(np.append(True, key[1:] != key[:-1])), len(key)))
            over = np.repeat(size > most, size)
            if over.any():
                yield words_only(batch.filter(pa.array(over)))
                batch = batch.filter(pa.array(~over))
                key = key[~over]
            alone = np.repeat(size == 1, size)[~over]
            if not alone.all():
                batch = batch.filter(pa.array(~alone))
                yield from _compare(key[~alone], batch["role"].to_numpy(), batch["word"].to_pylist(), batch["n"].to_numpy())

        for batch in batches:
            if crowded is not None:
                on = int(np.searchsorted(batch["key"].to_numpy(), crowded, "right"))
                if on:
                    yield words_only(batch.slice(0, on))
                    batch = batch.slice(on)
                if not len(batch):
                    continue
                crowded = None
            if held is not None:
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            key = batch["key"].to_numpy()
            last = int(np.searchsorted(key, key[-1])) if len(key) else 0
            if last:
                yield from whole(batch.slice(0, last))
            held = batch.slice(last)
            if len(held) > most:
                crowded = held["key"][0].as_py()
                yield words_only(held)
                held = None
        if held is not None and len(held):
            yield from whole(held)

    return entries.repartition("key").sortWithinPartitions("key", "role").mapInArrow(run, "a binary, a_n long, b binary, b_n long, role byte")


def _crowded_pairs(words: DataFrame) -> DataFrame:
    """Near pairs among the words of crowded lists, met by the word with one letter left out."""
    words = words.select(F.col("a").alias("w"), F.col("a_n").alias("n"), "role").distinct()
    at = words.withColumn("i", F.explode(F.sequence(F.lit(1), F.length("w"))))
    left = at.withColumn("key", F.concat(F.expr("substring(w, 1, i - 1)"), F.expr("substring(w, i + 1)")))
    one, two = (left.where(f"role = {SAME}").select("key", "i", F.col("w").alias(x), F.col("n").alias(f"{x}_n")) for x in "ab")
    same = one.join(two, ["key", "i"]).where("a < b").select("a", "a_n", "b", "b_n")
    longer = left.where(f"role = {LONGER}").select(F.col("key").alias("a"), F.col("w").alias("b"), F.col("n").alias("b_n")).distinct()
    return same.unionAll(words.where(f"role = {SHORTER}").select(F.col("w").alias("a"), F.col("n").alias("a_n")).join(longer, "a").select("a", "a_n", "b", "b_n"))


def near_pairs(words: DataFrame, min_chars: int = 6, most: int = LIST) -> DataFrame:
    """All pairs (a, a_n, b, b_n) of words exactly one edit apart, each once; words are Latin-1 bytes of ``min_chars`` letters or more."""
    if min_chars < 2 * SHORTEST:
        raise ValueError(f"words need {2 * SHORTEST} letters, so that an edit leaves one gram")
    tables = Tables(words.sparkSession, "spelling")
    found = tables.save(merged_lists(list_entries(words, *frequent_grams(words), min_chars), most), "lists")
    once = found.where("b is not null").select(*[F.when(F.col("a") < F.col("b"), F.col(x)).otherwise(F.col(y)).alias(x) for x, y in (("a", "b"), ("a_n", "b_n"), ("b", "a"), ("b_n", "a_n"))])
    crowded = found.where("b is null")
    if crowded.take(1):
        more = _crowded_pairs(crowded)
        once = once.unionAll(more.select(*[F.when(F.col("a") < F.col("b"), F.col(x)).otherwise(F.col(y)).alias(x) for x, y in (("a", "b"), ("a_n", "b_n"), ("b", "a"), ("b_n", "a_n"))]))
    return once.dropDuplicates(["a", "b"])


# --- forms -------------------------------------------------------------------

def _roots(forms: DataFrame, tables: Tables) -> DataFrame:
    """(word, root) by pointer doubling; chains end, as every form has a larger count."""
    at = tables.save(forms.select("word", F.col("form").alias("root")), "roots0")
    for k in range(1, 64):
        on = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        at, was = tables.save(at.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), f"roots{k}"), k - 1
        tables.drop(f"roots{was}")
        moved, at = bool(at.where("moved").take(1)), at.drop("moved")
        if not moved:
            return at
    raise ValueError("forms make a ring")


def spelling_groups(docs: DataFrame, id_col: str = "doc_id", text: str = "text", every: int = 199, min_chars: int = 6, min_n: int = 5, ratio: int = 5) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word.

    A word's form is its near word of largest count (ties: the smallest), if that
    count is ``ratio`` times its own or more; its root is the last form on the way.
    """
    tables = Tables(docs.sparkSession, "words")
    words = tables.save(word_counts(docs, id_col, text, every, min_chars, min_n), "words")
    pairs = near_pairs(words, min_chars)
    both = pairs.select(F.explode(F.array(*[F.struct(F.col(x).alias("word"), F.col(y).alias("other"), F.col(f"{y}_n").alias("m")) for x, y in ("ab", "ba")])).alias("p")).select("p.*")
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), "other")).alias("best"))
    held = words.join(best, "word", "left").withColumn("form_n", -F.col("best.m"))
    is_form = F.col("form_n") >= ratio * F.col("n")
    held = tables.save(held.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(is_form, F.col("best.other")).alias("form"), F.when(is_form, F.col("form_n")).alias("form_n")), "forms")
    rooted = held.join(_roots(held.where("form is not null"), tables), "word", "left")
    name = lambda c: F.decode(c, "ISO-8859-1")
    return rooted.select(name("word").alias("word"), name("form").alias("form"), name(F.coalesce("root", "word")).alias("root"), "n", "n_near", "form_n")

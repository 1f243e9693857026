"""Benchmark decontamination with suffix arrays over the training texts.

Each slice of documents is a shard.  Its words become numbers; a word that no
benchmark item has, and the end of a document, is a number of its own at every
place, so that no suffix runs on over it.  The suffix array of the shard holds all its
suffixes, sorted by prefix doubling; suffixes that differ stop taking part, and the
order goes as deep as the longest item, beyond which no match reaches.  Every
benchmark suffix of a window's length or more is looked up by binary search for the
range of places that begin with the window; matches on one diagonal join into the longest
verbatim matches, given with item and places.

Benchmark items are read in blocks of ``block_words`` words, longer items in
overlapping parts; a block, and nothing else, is broadcast.  Documents pass once for
each block, and what a block found is written before the next block is sent.

Defined cases: a null or empty text has no words and no hits; an item without
words has no window; an item of fewer words than ``window`` is one window;
repeated items all count; repeated documents are judged alike; a null item_id is
left out, a null doc_id is kept; without items nothing is hit; a very long text is a
shard of its own; columns n_words, n_hit, hit_words and matches of the documents are
replaced by ``annotate_hits`` and kept by ``decontaminate``.
"""

from __future__ import annotations

import itertools
import uuid

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm.common import annotate, bytes_of, kept, materialise, shielded

WINDOW = 10
BLOCK_WORDS = 1_000_000
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    """A-Z in lower case; words are runs of digits, letters a-z and non-ASCII characters."""
    return text.translate(_FOLD).split()


class Suffixes:
    """The suffixes of a block of benchmark items that have a window's length or more.

    A part of an item is (name, first word's place in the item, window, words).
    """

    def __init__(self, parts: list[tuple[str, int, int, list[bytes]]]):
        self.names = [p[0] for p in parts]
        self.vocab: dict[bytes, int] = {}
        numbered = [np.array([self.vocab.setdefault(w, len(self.vocab)) for w in ws], np.int64) for *_, ws in parts]
        self.longest = max(map(len, numbered), default=0)
        self.groups: list[dict] = []
        for size in sorted({p[2] for p in parts}):
            part = np.concatenate([np.full(len(ids) - size + 1, k) for k, ids in enumerate(numbered) if parts[k][2] == size])
            place = np.concatenate([np.arange(len(ids) - size + 1) for k, ids in enumerate(numbered) if parts[k][2] == size])
            base = np.cumsum([0, *map(len, numbered)])[:-1]
            rows = np.concatenate(numbered)[(base[part] + place)[:, None] + np.arange(size)]
            self.groups.append({"size": size, "rows": rows, "part": part, "place": place + np.array([p[1] for p in parts])[part]})


def suffix_array(ids: np.ndarray, depth: int) -> np.ndarray:
    """All places of ``ids`` in the order of what follows them, compared over ``depth`` numbers at least.

    Prefix doubling: places of equal rank are sorted again by the rank of what follows
    the part they share; places with a rank of their own take no part.
    """
    order = np.argsort(ids, kind="stable")
    held = ids[order]
    head = np.flatnonzero(np.r_[True, held[1:] != held[:-1]]) if len(ids) else np.zeros(0, np.int64)
    size = np.diff(np.r_[head, len(ids)])
    rank = np.empty(len(ids), np.int64)
    rank[order] = np.repeat(head, size)  # the first place in order of all that are equal so far
    open_ = np.repeat(size > 1, size)
    width = 1
    while width < depth and open_.any():
        slot = np.flatnonzero(open_)
        at = order[slot]
        then = np.where(at + width < len(ids), rank[np.minimum(at + width, len(ids) - 1)], -1)
        again = np.lexsort((then, rank[at]))
        at, then, first = at[again], then[again], rank[at][again]
        order[slot] = at
        new = np.flatnonzero(np.r_[True, (first[1:] != first[:-1]) | (then[1:] != then[:-1])])
        size = np.diff(np.r_[new, len(at)])
        rank[at] = np.repeat(slot[new], size)
        open_[slot] = np.repeat(size > 1, size)
        width *= 2
    return order


def search(ids: np.ndarray, order: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The range of ``order`` whose suffixes begin with each wanted row, by binary search."""
    first = ids[order]
    out = []
    for right in (False, True):
        low = np.searchsorted(first, wanted[:, 0], side="left")
        high = np.searchsorted(first, wanted[:, 0], side="right")
        live = np.flatnonzero(low < high)
        while len(live):
            mid = (low[live] + high[live]) // 2
            at, row = order[mid], wanted[live]
            sign = np.zeros(len(live), np.int8)  # of suffix against row
            same = np.arange(len(live))
            for k in range(1, wanted.shape[1]):
                there = at[same] + k
                seen = np.where(there < len(ids), ids[np.minimum(there, len(ids) - 1)], -1)
                sign[same] = np.sign(seen - row[same, k])
                same = same[sign[same] == 0]
                if not len(same):
                    break
            up = sign <= 0 if right else sign < 0
            low[live] = np.where(up, mid + 1, low[live])
            high[live] = np.where(up, high[live], mid)
            live = live[low[live] < high[live]]
        out.append(low)
    return out[0], out[1]


def find_matches(texts: list[bytes], suffixes: Suffixes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of each text, the hit mask over all words, and the longest matches.

    A match is a row (document, part, first word, item's first word, words).
    """
    split = [words_of(t) for t in texts]
    n_words = np.array([len(s) for s in split], np.int64)
    total = int(n_words.sum())
    known = np.fromiter(map(suffixes.vocab.get, itertools.chain.from_iterable(split), itertools.repeat(-1)), np.int64, total)
    ends = np.cumsum(n_words)
    # each document is followed by one place more, which ends its suffixes
    ids = np.full(total + len(texts), -1, np.int64)
    ids[np.arange(total) + np.repeat(np.arange(len(texts)), n_words)] = known
    own = np.flatnonzero(ids < 0)
    ids[own] = len(suffixes.vocab) + own
    cover = np.zeros(total + 1, np.int64)
    found = [np.zeros((0, 5), np.int64)]
    order = suffix_array(ids, suffixes.longest) if len(own) < len(ids) else np.zeros(0, np.int64)
    shift = np.repeat(np.arange(len(texts)), n_words + 1)
    for group in suffixes.groups if len(order) else ():
        size = group["size"]
        low, high = search(ids, order, group["rows"])
        which = np.flatnonzero(high > low)
        if not len(which):
            continue
        count = (high - low)[which]
        suffix = np.repeat(which, count)
        place = order[np.repeat(low[which] - (np.cumsum(count) - count), count) + np.arange(count.sum())]
        doc = shift[place]
        place = place - doc
        where = np.unique(place)
        np.add.at(cover, where, 1)
        np.add.at(cover, where + size, -1)
        part, first = group["part"][suffix], group["place"][suffix]
        order_ = np.lexsort((place, place - first, part, doc))
        doc, part, first, place = doc[order_], part[order_], first[order_], place[order_]
        new = np.r_[True, (np.diff(doc) != 0) | (np.diff(part) != 0) | (np.diff(place) != 1) | (np.diff(first) != 1)]
        run = np.flatnonzero(new)
        length = np.diff(np.r_[run, len(place)]) + size - 1
        found.append(np.stack([doc[run], part[run], place[run] - (ends - n_words)[doc[run]], first[run], length], axis=1))
    return n_words, np.cumsum(cover[:-1]) > 0, np.concatenate(found)


def benchmark_blocks(benchmark: DataFrame, item_id: str, text: str, window: int, block_words: int):
    """Parts of items on the driver, a block of about ``block_words`` words at a time."""
    held, words = [], 0
    rows = benchmark.where(F.col(item_id).isNotNull()).select(F.col(item_id).cast("string").alias("i"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    for row in rows.toLocalIterator():
        ws = words_of(row["t"].encode())
        size = min(window, len(ws))
        for a in range(0, len(ws) - size + 1 if size else 0, block_words):  # parts share all words of a window but one
            part = ws[a : a + block_words + size - 1]
            held.append((row["i"], a, size, part))
            words += len(part)
            if words >= block_words:
                yield held
                held, words = [], 0
    if held:
        yield held


MATCH = T.ArrayType(T.StructType([T.StructField(n, t) for n, t in (("item_id", T.StringType()), ("word", T.IntegerType()), ("item_word", T.IntegerType()), ("words", T.IntegerType()))]))


def _suffixes(shared, key: str) -> Suffixes:
    """The suffixes of a broadcast block, made once per worker; ``key`` names the block."""
    return kept((key,), lambda: Suffixes(shared.value))


def annotate_hits(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` with n_words, n_hit, hit_words (their places, packed bits) and matches.

    ``matches`` holds each longest verbatim match: item, first word in the
    document, first word in the item, and length in words.
    """
    out, last = docs, None
    fields = [("n_words", T.LongType()), ("n_hit", T.LongType()), ("hit_words", T.BinaryType()), ("matches", MATCH)]
    for k, block in enumerate(benchmark_blocks(benchmark, item_id, item_text, window, block_words)):
        if k:  # what the block before found is written, and its broadcast goes
            out = materialise(out, "hits")
            last.destroy()
        last = shared = docs.sparkSession.sparkContext.broadcast(block)

        def start(shared=shared, k=k, key=uuid.uuid4().hex):
            suffixes = _suffixes(shared, key)

            def run(batch):
                n_words, hit, matches = find_matches(bytes_of(batch, text), suffixes)
                bounds = np.r_[0, np.cumsum(n_words)]
                rows = [[] for _ in n_words]
                for doc, part, place, first, length in matches.tolist():
                    rows[doc].append({"item_id": suffixes.names[part], "word": place, "item_word": first, "words": length})
                bits = [np.packbits(hit[a:b]).tobytes() if hit[a:b].any() else b"" for a, b in zip(bounds, bounds[1:], strict=False)]
                if k:  # join with what earlier blocks found
                    old = {c: batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("matches", "hit_words")}
                    rows = [a + b for a, b in zip(old["matches"], rows, strict=True)]
                    bits = [_either(a, b) for a, b in zip(old["hit_words"], bits, strict=True)]
                return [n_words, [sum(map(int.bit_count, b)) for b in bits], bits, rows]

            return run

        out = annotate_over(out, fields, start, text) if k else annotate(out, fields, start, text)
    if last is None:
        def none():
            return lambda batch: [[len(words_of(t)) for t in bytes_of(batch, text)]]

        plain = docs.drop(*[n for n, _ in fields])
        out = annotate(plain, [("n_words", T.LongType())], none, text).withColumns({"n_hit": F.lit(0).cast("long"), "hit_words": F.lit(b""), "matches": F.array().cast(MATCH)})
    return out


def _either(a: bytes, b: bytes) -> bytes:
    if not a or not b:
        return a or b
    return np.bitwise_or(np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)).tobytes()


def annotate_over(df: DataFrame, fields, start, by: str) -> DataFrame:
    """Like ``annotate`` for fields that are there already and that ``start`` reads."""
    names = [n for n, _ in fields]
    made = annotate(df, [(f"__{n}", t) for n, t in fields], start, by)
    return made.drop(*names).withColumnsRenamed({f"__{n}": n for n in names})


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """The documents of ``docs`` that share no window with any benchmark item."""
    own, back = shielded(docs, text)
    return annotate_hits(own, benchmark, text, **options).where("n_hit = 0").select(*back)


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated for each document."""
    hits = annotate_hits(docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text")), benchmark, "text", **options)
    items = F.array_sort(F.array_distinct(F.col("matches.item_id")))
    return hits.select(
        "doc_id", "n_words", "n_hit", F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"), "matches",
    )

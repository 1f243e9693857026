"""Byte-level BPE encoding and decoding on padded numpy matrices.

Each text is cut by the tokenizer's pattern.  The distinct pieces of a slice of
rows that are not in the worker's bounded memo go to matrices, one per length
bucket: a row is a piece, a cell a token, short rows are padded.  In each round
every row merges its leftmost pair of least rank; pair ranks come from an
open-addressing hash table of numpy arrays, finished rows leave the matrix and
the others close the gap.  A piece beyond the widest bucket takes the same merges, the
leftmost pair of least rank each time, from a heap of its pairs, in time n log n, as
a matrix row would need time n * n.

Defined cases: a null text counts as empty; an empty text has no ids and decodes
to nothing; repeated rows are encoded alike; special-token strings are ordinary
text; an id outside the vocabulary fails the decoding with a ``ValueError``; a very
long text or piece costs memory of its own length times a constant; other columns pass
through, but for one that bears the name of an output, which is replaced.
"""

from __future__ import annotations

import base64
import heapq
import itertools
import uuid

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm.common import annotate, kept, ragged, texts_of

BUCKETS = (4, 6, 8, 12, 16, 24, 32, 64, 128, 256)
MEMO = 250_000  # distinct pieces that a Python worker remembers, and
MEMO_BYTES = 8 << 20  # their characters together
NONE = np.int32(2**31 - 1)


def read_ranks(path: str) -> list[bytes]:
    """Tokens by rank from a rank file (base64 token, rank); driver side, a fixed vocabulary."""
    with open(path, "rb") as file:
        pairs = [line.split() for line in file if line.strip()]
    out = [b""] * (max(int(r) for _, r in pairs) + 1)
    for token, rank in pairs:
        out[int(rank)] = base64.b64decode(token)
    return out


class PairTable:
    """(left id, right id) -> merged id, by open addressing over numpy arrays."""

    def __init__(self, tokens: list[bytes]):
        rank = {t: i for i, t in enumerate(tokens) if t}
        left, right, made = [], [], []
        for t, i in rank.items():
            for k in range(1, len(t)):
                a, b = rank.get(t[:k]), rank.get(t[k:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    made.append(i)
        key = (np.array(left, np.int64) << 32) | np.array(right, np.int64)
        value = np.array(made, np.int32)
        self.bits = max(4, int(len(key) * 4 - 1).bit_length()) if len(key) else 4
        self.mask = (1 << self.bits) - 1
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, NONE, np.int32)
        slot = self._slot(key)
        todo = np.arange(len(key))
        while len(todo):
            free = self.keys[slot[todo]] < 0
            at, first = np.unique(slot[todo[free]], return_index=True)
            put = todo[free][first]
            self.keys[at], self.values[at] = key[put], value[put]
            todo = todo[self.keys[slot[todo]] != key[todo]]
            slot[todo] = (slot[todo] + 1) & self.mask

    def _slot(self, key: np.ndarray) -> np.ndarray:
        h = key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (h >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merged ids, NONE where the pair does not merge or touches padding (-1)."""
        shape = left.shape
        left, right = left.ravel().astype(np.int64), right.ravel().astype(np.int64)
        out = np.full(len(left), NONE, np.int32)
        todo = np.flatnonzero((left >= 0) & (right >= 0))
        key = (left[todo] << 32) | right[todo]
        slot = self._slot(key)
        while len(todo):
            found = self.keys[slot]
            hit = found == key
            out[todo[hit]] = self.values[slot[hit]]
            on = ~hit & (found >= 0)
            todo, key, slot = todo[on], key[on], (slot[on] + 1) & self.mask
        return out.reshape(shape)


class Codec:
    """Encoder and decoder of one worker; built once per worker and vocabulary."""

    def __init__(self, tokens: list[bytes], pattern: str):
        self.tokens = tokens
        self.find = regex.compile(pattern).findall
        self.pairs = PairTable(tokens)
        self.byte_id = np.full(256, -1, np.int32)
        for i, t in enumerate(tokens):
            if len(t) == 1:
                self.byte_id[t[0]] = i
        if (self.byte_id < 0).any():
            raise ValueError("the vocabulary lacks single bytes")
        self.whole = {t: i for i, t in enumerate(tokens) if t}
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)
        self.size = np.array([len(t) for t in tokens], np.int64)
        self.at = np.cumsum(self.size) - self.size
        self._reset()

    def _reset(self) -> None:
        self.memo: dict[str, int] = {}
        self.ids = np.zeros(1 << 16, np.int32)
        self.used = self.held = 0
        self.start = np.zeros(1 << 12, np.int64)
        self.length = np.zeros(1 << 12, np.int64)

    # --- merging -----------------------------------------------------------

    def merge_rows(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Token ids of each piece."""
        out: list[np.ndarray] = [np.zeros(0, np.int32)] * len(pieces)
        size = np.array([len(p) for p in pieces], np.int64)
        low = 0
        for width in BUCKETS:
            rows = np.flatnonzero((size > low) & (size <= width))
            low = width
            if len(rows):
                flat = self.byte_id[np.frombuffer(b"".join([pieces[i] for i in rows]), np.uint8)]
                cells = np.full((len(rows), width), -1, np.int32)
                cells[np.arange(width) < size[rows, None]] = flat
                self._bucket(cells, rows, out)
        for i in np.flatnonzero(size > BUCKETS[-1]):
            out[i] = self._by_heap(self.byte_id[np.frombuffer(pieces[i], np.uint8)])
        return out

    def _bucket(self, cells: np.ndarray, rows: np.ndarray, out: list[np.ndarray]) -> None:
        rank = self.pairs.get(cells[:, :-1], cells[:, 1:])
        while len(rows):
            best = rank.argmin(axis=1)
            value = rank[np.arange(len(rows)), best]
            done = value == NONE
            if done.any():
                for row, line in zip(rows[done], cells[done], strict=True):
                    out[row] = line[line >= 0]
                live = ~done
                rows, cells, rank, best, value = rows[live], cells[live], rank[live], best[live], value[live]
                if not len(rows):
                    return
            n, width = cells.shape
            each = np.arange(n)
            cells[each, best] = value
            stay = np.ones((n, width), bool)
            stay[each, best + 1] = False
            cells = cells[stay].reshape(n, width - 1)
            if width == 2:
                for row, line in zip(rows, cells, strict=True):
                    out[row] = line[line >= 0]
                return
            stay = np.ones((n, width - 1), bool)
            stay[each, best] = False
            rank = rank[stay].reshape(n, width - 2)
            left = best > 0
            rank[each[left], best[left] - 1] = self.pairs.get(cells[each[left], best[left] - 1], value[left])
            right = best < width - 2
            rank[each[right], best[right]] = self.pairs.get(value[right], cells[each[right], best[right] + 1])

    def _by_heap(self, row: np.ndarray) -> np.ndarray:
        """The ids of one long piece; a heap entry is rank and place, stale ones are passed over."""
        rank = self.pairs.get(row[:-1], row[1:]).tolist()
        heap = [r << 32 | i for i, r in enumerate(rank) if r != NONE]
        heapq.heapify(heap)
        n, ids, tokens, find, none = len(row), row.tolist(), self.tokens, self.whole.get, int(NONE)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while heap:
            entry = heapq.heappop(heap)
            i = entry & 0xFFFFFFFF
            if rank[i] != entry >> 32:
                continue
            gone = after[i]
            ids[i], ids[gone] = rank[i], -1
            if gone < n - 1:
                rank[gone] = none
            after[i] = k = after[gone]
            if k < n:
                before[k] = i
                rank[i] = r = find(tokens[ids[i]] + tokens[ids[k]], none)
                if r != none:
                    heapq.heappush(heap, r << 32 | i)
            elif i < n - 1:
                rank[i] = none
            j = before[i]
            if j >= 0:
                rank[j] = r = find(tokens[ids[j]] + tokens[ids[i]], none)
                if r != none:
                    heapq.heappush(heap, r << 32 | j)
        return np.array([x for x in ids if x >= 0], np.int32)

    # --- texts -------------------------------------------------------------

    def _learn(self, pieces: list[str]) -> None:
        made = self.merge_rows([p.encode() for p in pieces])
        length = np.array([len(m) for m in made], np.int64)
        n, total, first = len(pieces), int(length.sum()), len(self.memo)
        if self.used + total > len(self.ids):
            self.ids = np.resize(self.ids, max(2 * len(self.ids), self.used + total))
        if first + n > len(self.start):
            self.start = np.resize(self.start, max(2 * len(self.start), first + n))
            self.length = np.resize(self.length, len(self.start))
        self.ids[self.used : self.used + total] = np.concatenate(made)
        self.start[first : first + n] = self.used + np.cumsum(length) - length
        self.length[first : first + n] = length
        self.used += total
        self.held += sum(map(len, pieces))
        self.memo.update(zip(pieces, range(first, first + n), strict=True))

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and the number of ids of each text."""
        found = [self.find(t) if t else [] for t in texts]
        new = set().union(*found).difference(self.memo) if found else set()
        if len(self.memo) + len(new) > MEMO or self.held > MEMO_BYTES:
            self._reset()
            new = set().union(*found)
        if new:
            self._learn(sorted(new))
        per = np.array([len(f) for f in found], np.int64)
        which = np.fromiter(map(self.memo.__getitem__, itertools.chain.from_iterable(found)), np.int64, int(per.sum()))
        length = self.length[which]
        ids = ragged(self.ids, self.start[which], length)
        ends = np.r_[0, np.cumsum(length)]
        bounds = np.r_[0, np.cumsum(per)]
        return ids, ends[bounds[1:]] - ends[bounds[:-1]]

    def decode(self, ids: np.ndarray, per: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All bytes in a row, and the number of bytes of each list of ids."""
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.size)):
            raise ValueError("an id is outside the vocabulary")
        length = self.size[ids]
        ends = np.r_[0, np.cumsum(length)]
        bounds = np.r_[0, np.cumsum(per)]
        return ragged(self.flat, self.at[ids], length), ends[bounds[1:]] - ends[bounds[:-1]]


class Ranks:
    """A vocabulary as a broadcast variable, with a name for the workers' codecs."""

    def __init__(self, shared):
        self.shared, self.key = shared, uuid.uuid4().hex


def _codec(ranks: Ranks, pattern: str) -> Codec:
    """The codec of a worker, made once for a vocabulary and pattern."""
    return kept((ranks.key, pattern), lambda: Codec(ranks.shared.value, pattern))


def _binary(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    offsets = np.r_[0, np.cumsum(sizes)].astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


def share_ranks(spark: SparkSession, path: str) -> Ranks:
    """The vocabulary as a broadcast variable: a fixed file, under 2 MB for 50,000 tokens."""
    return Ranks(spark.sparkContext.broadcast(read_ranks(path)))


def encode(df: DataFrame, text: str, ranks, pattern: str, out: str = "ids", count: str = "n_tokens", keep: list[str] | None = None) -> DataFrame:
    """Append ``out``, the ids as packed little-endian uint32, and ``count``."""

    def start():
        codec = _codec(ranks, pattern)

        def run(batch):
            ids, per = codec.encode(texts_of(batch, text))
            return [_binary(ids.astype("<u4").view(np.uint8), per * 4), pa.array(per)]

        return run

    return annotate(df, [(out, T.BinaryType()), (count, T.LongType())], start, text, keep)


def decode(df: DataFrame, ids: str, ranks, pattern: str, out: str = "decoded", keep: list[str] | None = None) -> DataFrame:
    """Append ``out``, the bytes of the packed ids in ``ids`` (null: none)."""

    def start():
        codec = _codec(ranks, pattern)

        def run(batch):
            packed = [x or b"" for x in texts_of(batch, ids)]
            per = np.array([len(x) // 4 for x in packed], np.int64)
            return [_binary(*codec.decode(np.frombuffer(b"".join(packed), "<u4").astype(np.int64), per))]

        return run

    return annotate(df, [(out, T.BinaryType())], start, ids, keep)


def round_trip(df: DataFrame, text: str, ranks, pattern: str, out: str = "ids", count: str = "n_tokens", decoded: str = "decoded", keep: list[str] | None = None) -> DataFrame:
    """Append the ids, their number and the bytes they decode to, in one pass of one worker."""

    def start():
        codec = _codec(ranks, pattern)

        def run(batch):
            ids, per = codec.encode(texts_of(batch, text))
            return [_binary(ids.astype("<u4").view(np.uint8), per * 4), pa.array(per), _binary(*codec.decode(ids, per))]

        return run

    return annotate(df, [(out, T.BinaryType()), (count, T.LongType()), (decoded, T.BinaryType())], start, text, keep)


def unpack(ids: str):
    """Packed ids as ``array<int>``, for readers who want them one by one."""
    size = F.length(ids)
    word = lambda i: F.conv(F.hex(F.reverse(F.substring(F.col(ids), i * 4 + 1, F.lit(4)))), 16, 10).cast("int")
    return F.when(size > 0, F.transform(F.sequence(F.lit(0), (size / 4).cast("int") - 1), word)).otherwise(F.array().cast("array<int>"))


def round_trip_digests(docs: DataFrame, ranks, pattern: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, SHA-256 of the packed ids and of the decoded bytes."""
    plain = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    done = round_trip(plain, "text", ranks, pattern, keep=["doc_id"])
    return done.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))

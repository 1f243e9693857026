"""Token ids in files of patched frame-of-reference blocks.

Documents are dealt by ranges of their ids, so each task holds one stretch of the
order; it encodes its texts and streams the ids into files of at most ``FILE_IDS``
ids.  A file is

    magic, blocks, block starts, documents, footer

* a block holds 256 ids (the last one the rest): the least id (u32), the width
  (u8), the number of exceptions (u16), every id less the least one packed to the
  width that ``SHARE`` of the block's values need, and the exceptions: their places
  (u8 each) and their values less the least (u32 each), whose low bits are packed too;
* block starts are u64 byte places, so any stretch of ids is read without the rest;
* documents are their ids (i64), a null mark (u8) and the place of their first
  token in the file (u64);
* the footer has the three lengths, the place of the index and its CRC-32.

Files are written in tasks to the shared folder under names of their own, and the
table of the files a job kept, with the number of ids before each, is the data set;
what a lost or repeated task wrote is in no table.  Tasks hold one run of
``CHUNK_IDS`` ids and the documents' places, never a file.

Defined cases: a null or empty text has the end id alone; null document ids come
first; rows with equal ids follow each other by a hash of the text, then as they were read;
special-token strings count as the tokenizer counts them; without rows there is no
file; a text of any length spans as many blocks as it needs, and files are closed
between documents, so one document is in one file; other columns are not stored.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidewater.llm.common import Tables, bytes_of, ragged, runs_of, slices
from tidewater.operators.panel import running_total

MAGIC = b"TWPFOR1\n"
BLOCK = 256
SHARE = 0.9  # of a block's values that the packed width must hold
CHUNK_IDS = 1 << 18
FILE_IDS = 1 << 26
MEMO = 250_000  # distinct chunks of one of the two generations that a Python worker remembers, and
MEMO_BYTES = 8 << 20  # their bytes together
JOINED = 8192  # new chunks that the library gets as one text
_FOOTER = np.dtype([("ids", "<u8"), ("blocks", "<u8"), ("docs", "<u8"), ("index", "<u8"), ("crc", "<u4"), ("magic", "S8")])
_HEAD = np.dtype([("least", "<u4"), ("width", "u1"), ("exceptions", "<u2")])
_SPACE = bytes(32 if b in b" \t\n\x0b\x0c\r" else b for b in range(256))
_FOLD = bytes(b + 32 if 65 <= b <= 90 else _SPACE[b] for b in range(256))


# --- blocks ------------------------------------------------------------------

def _bits(values: np.ndarray) -> np.ndarray:
    """How many bits each value needs."""
    return np.ceil(np.log2(values.astype(np.float64) + 1)).astype(np.int64)


def pack(ids: np.ndarray, share: float = SHARE) -> tuple[bytes, np.ndarray]:
    """The blocks of ``ids`` as bytes, and the length of each block."""
    count = -(-len(ids) // BLOCK)
    full = np.full(count * BLOCK, ids[-1] if len(ids) else 0, np.int64)
    full[: len(ids)] = ids
    rows = full.reshape(count, BLOCK)
    least = rows.min(1) if count else np.zeros(0, np.int64)
    rows = rows - least[:, None]
    at = min(BLOCK - 1, int(np.ceil(share * BLOCK)) - 1)
    width = _bits(np.partition(rows, at, axis=1)[:, at]) if count else least
    high = rows >> width[:, None] != 0
    beyond = high.sum(1)
    parts: list = [None] * count
    for w in np.unique(width):
        own = np.flatnonzero(width == w)
        if w:
            bits = np.unpackbits(rows[own].astype("<u4").view(np.uint8).reshape(len(own), BLOCK, 4), axis=2, count=int(w), bitorder="little")
            packed = np.packbits(bits.reshape(len(own), -1), axis=1, bitorder="little")
        for k, b in enumerate(own):
            parts[b] = packed[k].tobytes() if w else b""
    head = np.zeros(count, _HEAD)
    head["least"], head["width"], head["exceptions"] = least, width, beyond
    out = []
    for b in range(count):
        piece = head[b].tobytes() + parts[b]
        if beyond[b]:
            where = np.flatnonzero(high[b])
            piece += where.astype(np.uint8).tobytes() + rows[b, where].astype("<u4").tobytes()
        out.append(piece)
    return b"".join(out), np.fromiter(map(len, out), np.int64, count)


def unpack(data: bytes, starts: np.ndarray) -> np.ndarray:
    """The ids of the whole blocks that begin at ``starts`` in ``data``."""
    raw = np.frombuffer(data, np.uint8)
    head = raw[starts[:, None] + np.arange(_HEAD.itemsize)].copy().view(_HEAD).reshape(-1)
    rows = np.zeros((len(starts), BLOCK), np.int64)
    body = starts + _HEAD.itemsize
    for w in np.unique(head["width"]):
        own = np.flatnonzero(head["width"] == w)
        if w:
            size = BLOCK * int(w) // 8
            bits = np.unpackbits(raw[body[own][:, None] + np.arange(size)], axis=1, bitorder="little").reshape(len(own), BLOCK, int(w))
            rows[own] = bits.astype(np.int64) @ (1 << np.arange(int(w), dtype=np.int64))
    for b in np.flatnonzero(head["exceptions"]):
        at, k = int(body[b]) + BLOCK * int(head["width"][b]) // 8, int(head["exceptions"][b])
        rows[b, raw[at : at + k]] = np.frombuffer(data, "<u4", k, at + k)
    return (rows + head["least"].astype(np.int64)[:, None]).reshape(-1)


# --- files -------------------------------------------------------------------

def _open(uri: str) -> tuple[fs.FileSystem, str]:
    return (fs.LocalFileSystem(), uri) if "://" not in uri and not uri.startswith("file:") else fs.FileSystem.from_uri(uri.replace("file:/", "file:///", 1) if re.match("file:/[^/]", uri) else uri)


class Writer:
    """One file; ids come in stretches, documents are named when they begin."""

    def __init__(self, uri: str, share: float = SHARE):
        where, path = _open(uri)
        where.create_dir(os.path.dirname(path), recursive=True)
        self.out, self.share = where.open_output_stream(path, compression=None), share
        self.out.write(MAGIC)
        self.place, self.count, self.held, self.pending = len(MAGIC), 0, [], 0
        self.starts: list[np.ndarray] = []
        self.docs: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def add(self, doc_ids: np.ndarray, nulls: np.ndarray, per: np.ndarray, ids: np.ndarray) -> None:
        """Documents with the number of ids of each, and these ids one after another."""
        self.docs.append((doc_ids.astype("<i8"), nulls.astype(np.uint8), (self.count + np.cumsum(per) - per).astype("<u8")))
        self.count += len(ids)
        self.held.append(ids.astype("<u4"))
        self.pending += len(ids)
        if self.pending >= CHUNK_IDS:
            self._flush(self.pending // BLOCK * BLOCK)

    def _flush(self, most: int) -> None:
        ids = np.concatenate(self.held) if self.held else np.zeros(0, "<u4")
        for a in range(0, most, CHUNK_IDS):
            data, size = pack(ids[a : min(a + CHUNK_IDS, most)], self.share)
            self.starts.append(self.place + np.cumsum(size) - size)
            self.out.write(data)
            self.place += len(data)
        self.held, self.pending = [ids[most:]], len(ids) - most

    def close(self) -> int:
        """Write the rest and the index; the bytes of the file."""
        self._flush(self.pending)
        starts = np.concatenate([np.zeros(0, np.int64), *self.starts]).astype("<u8")
        columns = [np.concatenate(x) if x else np.zeros(0, t) for x, t in zip(zip(*self.docs, strict=True) if self.docs else ((), (), ()), ("<i8", np.uint8, "<u8"), strict=True)]
        index = starts.tobytes() + b"".join(x.tobytes() for x in columns)
        foot = np.zeros(1, _FOOTER)
        foot[0] = (self.count, len(starts), len(columns[0]), self.place, zlib.crc32(index), MAGIC)
        self.out.write(index + foot.tobytes())
        self.out.close()
        return self.place + len(index) + _FOOTER.itemsize


class Reader:
    """A file's documents, and any stretch of its ids."""

    def __init__(self, uri: str):
        where, path = _open(uri)
        self.file = where.open_input_file(path)
        size = self.file.size()
        foot = np.frombuffer(self.file.read_at(_FOOTER.itemsize, size - _FOOTER.itemsize), _FOOTER)[0] if size >= _FOOTER.itemsize else None
        if foot is None or foot["magic"] != MAGIC:
            raise ValueError(f"{uri} is no token file")
        at, blocks, docs = int(foot["index"]), int(foot["blocks"]), int(foot["docs"])
        index = self.file.read_at(size - _FOOTER.itemsize - at, at)
        if zlib.crc32(index) != foot["crc"]:
            raise ValueError(f"{uri}: the index is damaged")
        self.count = int(foot["ids"])
        self.blocks = np.append(np.frombuffer(index, "<u8", blocks).astype(np.int64), at)
        self.doc_ids = np.frombuffer(index, "<i8", docs, 8 * blocks)
        self.nulls = np.frombuffer(index, np.uint8, docs, 8 * (blocks + docs)).astype(bool)
        self.first = np.append(np.frombuffer(index, "<u8", docs, 8 * (blocks + docs) + docs).astype(np.int64), self.count)

    def ids(self, a: int, b: int) -> np.ndarray:
        """The ids from place ``a`` on, before ``b``; reads the blocks that hold them."""
        if a >= b:
            return np.zeros(0, np.int64)
        one, last = a // BLOCK, -(-b // BLOCK)
        at = self.blocks[one : last + 1]
        return unpack(self.file.read_at(int(at[-1] - at[0]), int(at[0])), at[:-1] - at[0])[a - one * BLOCK : b - one * BLOCK]

    def documents(self) -> Iterator[tuple[int, int, np.ndarray]]:
        """(first document, first place, ids) of stretches of at most ``CHUNK_IDS`` ids; a longer document is one stretch by itself."""
        k = 0
        while k < len(self.doc_ids):
            to = max(k + 1, int(np.searchsorted(self.first, self.first[k] + CHUNK_IDS, "right")) - 1)
            yield k, to, self.ids(int(self.first[k]), int(self.first[to]))
            k = to


# --- encoding ----------------------------------------------------------------

def _closing(raw: np.ndarray) -> np.ndarray:
    """Where a full stop or comma between an ASCII letter and white space stands: a piece of its own."""
    out = np.zeros(len(raw), bool)
    before = raw[:-2] | 32
    out[1:-1] = ((raw[1:-1] == 46) | (raw[1:-1] == 44)) & (raw[2:] == 32) & (before >= 97) & (before <= 122)
    return out


class Encoder:
    """Ids of texts by a tokenizer of the tokenizers library that drops white space and folds case.

    No token of such a tokenizer reaches over white space, so texts are cut at ASCII
    white space and the library sees each distinct chunk once while the worker
    remembers it, which it does for the chunks of the last ``MEMO`` new ones and those
    met again since.  A chunk of letters up to U+00FF, with or without other marks
    after them, is one or two pieces of the library's pattern.  Such chunks go to the
    library joined by spaces, as one text, and are told apart by the tokens that end
    a piece; the others, and all where the vocabulary has no such tokens, go one by one.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        suffix, vocabulary = getattr(self.tokenizer.model, "end_of_word_suffix", None), self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values(), default=-1) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if suffix and token.endswith(suffix)]] = True
        # neither apostrophes nor the marks of special tokens
        self.plain = re.compile(rb"((?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+)([!-&(-/:;=?@\[-`{}~]*)").fullmatch
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.bytes = 0

    def _joined(self, chunks: list[bytes], pieces: list[int]) -> list[bytes] | None:
        """The packed ids of chunks of so many pieces; none if a piece has no token that ends it."""
        ids = np.array(self.tokenizer.encode_batch_fast([b" ".join(chunks).decode()], add_special_tokens=False)[0].ids, np.uint32)
        after = np.flatnonzero(self.ends[ids]) + 1
        if len(after) != sum(pieces):
            return None
        data, at = ids.tobytes(), 4 * after[np.cumsum(pieces) - 1]
        return [data[a:b] for a, b in pairwise([0, *at.tolist()])]

    def _ids(self, chunks: list[bytes]) -> list[bytes]:
        """The packed ids of distinct chunks."""
        if len(self.young) > MEMO or self.bytes > MEMO_BYTES:
            self.young, self.old, self.bytes = {}, self.young, 0
        young, old, plain, new, pieces, late = self.young, self.old, self.plain, [], [], []
        out = [young.get(c) for c in chunks]
        for k, got in enumerate(out):
            if got is None:
                c = chunks[k]
                self.bytes += len(c)
                if (got := old.get(c)) is not None:
                    young[c] = out[k] = got
                elif m := plain(c):
                    new.append(k)
                    pieces.append(1 + (m.end(1) < len(c)))
                else:
                    late.append(k)
        for a in range(0, len(new), JOINED):
            own = new[a : a + JOINED]
            made = self._joined([chunks[k] for k in own], pieces[a : a + JOINED])
            if made is None:
                late += own
            else:
                for k, got in zip(own, made, strict=True):
                    young[chunks[k]] = out[k] = got
        for k, e in zip(late, self.tokenizer.encode_batch_fast([chunks[k].decode() for k in late], add_special_tokens=False), strict=True):
            young[chunks[k]] = out[k] = array("I", e.ids).tobytes()
        return out

    def encode(self, texts: list[bytes], end: int | None) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and the number of each text's; ``end`` follows each text."""
        folds = not any(b"<|" in t for t in texts)  # else special tokens, whose case counts, may be among them
        doc, chunks = runs_of(texts, _FOLD if folds else _SPACE, _closing)
        coded = chunks.dictionary_encode()
        made = self._ids(coded.dictionary.to_pylist())
        size = np.fromiter(map(len, made), np.int64, len(made)) // 4
        flat = np.frombuffer(b"".join(made), np.uint32)
        which = coded.indices.to_numpy()
        per = np.bincount(doc, size[which], len(texts)).astype(np.int64)
        ids = ragged(flat, (np.cumsum(size) - size)[which], size[which])
        return (ids, per) if end is None else (np.insert(ids, np.cumsum(per), end), per + 1)


@lru_cache(maxsize=1)
def worker_encoder(path: str) -> Encoder:
    """The encoder that a Python worker keeps, with what it remembers, from task to task."""
    return Encoder(path)


# --- data sets ---------------------------------------------------------------

_FILES = T.StructType([T.StructField(n, t) for n, t in (("shard", T.LongType()), ("path", T.StringType()), ("docs", T.LongType()), ("ids", T.LongType()), ("bytes", T.LongType()))])


def save_tokens(docs: DataFrame, tokenizer: str, end: int | None = 2, id_col: str = "doc_id", text: str = "text", file_ids: int = FILE_IDS, share: float = SHARE) -> DataFrame:
    """Encode ``docs`` into token files; returns the table of the files, in order.

    ``tokenizer`` is a file of the tokenizers library that every executor has.  The
    table has shard, path, docs, ids, bytes and ``before``, the ids of all files
    before; it is written, and its files are not written again when it is read.
    """
    if not isinstance(docs.schema[id_col].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        raise ValueError(f"{id_col} must be an integer")
    tables = Tables(docs.sparkSession, "tokens")
    root = f"{tables.root}/files-{uuid.uuid4().hex[:8]}"
    plain = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    dealt = plain.withColumns({"mark": F.xxhash64("text"), "row": F.monotonically_increasing_id()}).repartitionByRange("id", "mark", "row").sortWithinPartitions("id", "mark", "row")

    def write(batches):
        encoder, part, files, writer = None, TaskContext.get().partitionId(), [], None

        def close():
            n, k = writer.close(), len(files)
            files.append((part * (1 << 20) + k, path, sum(len(d[0]) for d in writer.docs), writer.count, n))

        for batch in batches:
            encoder = encoder or worker_encoder(tokenizer)
            for cut in slices(batch, "text", 8 << 20):
                ids, per = encoder.encode(bytes_of(cut, "text"), end)
                key = cut.column(0)
                names, nulls = key.fill_null(0).to_numpy(), key.is_null().to_numpy(zero_copy_only=False)
                ends = np.cumsum(per)
                a = 0
                while a < len(per):
                    if writer is None:
                        path = f"{root}/part-{part:06d}-{len(files):04d}-{uuid.uuid4().hex}.pfor"
                        writer = Writer(path, share)
                    base = int(ends[a] - per[a])
                    b = max(a + 1, int(np.searchsorted(ends, base + file_ids - writer.count, "right")))
                    writer.add(names[a:b], nulls[a:b], per[a:b], ids[base : int(ends[b - 1])])
                    if writer.count >= file_ids or b < len(per):
                        close()
                        writer = None
                    a = b
        if writer is not None:
            close()
        if files:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*files, strict=True), (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()), strict=True)], names=_FILES.names)

    files = tables.save(dealt.select("id", "text").mapInArrow(write, _FILES), "files")
    return tables.save(running_total(files, "shard", "ids", "before"), "table")


def _read(files: DataFrame, schema: str, rows) -> DataFrame:
    """One task a file: ``rows(reader, before)`` yields lists of columns."""

    def run(batches):
        for batch in batches:
            for path, before in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for columns in rows(Reader(path), before):
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    fields = T.StructType.fromDDL(schema)
    arrow = to_arrow_schema(fields)
    return files.select("path", "before").repartition(max(1, files.count())).mapInArrow(run, fields)


def _named(reader: Reader, a: int, b: int) -> pa.Array:
    return pa.array(reader.doc_ids[a:b], mask=reader.nulls[a:b])


def read_tokens(files: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before) and ``ids``, packed unsigned 32-bit integers, of every document."""

    def rows(reader, before):
        for a, b, ids in reader.documents():
            data, at = ids.astype("<u4").tobytes(), (reader.first[a : b + 1] - reader.first[a]) * 4
            yield [_named(reader, a, b), pa.array(before + reader.first[a:b]), [data[x:y] for x, y in zip(at[:-1], at[1:], strict=True)]]

    return _read(files, "doc_id long, start long, ids binary", rows)


def token_digests(files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and the CRC-32 of the packed ids of every document, from the files."""

    def rows(reader, before):
        for a, b, ids in reader.documents():
            data, first = memoryview(ids.astype("<u4").tobytes()), reader.first[a : b + 1]
            at = (first - first[0]) * 4
            yield [_named(reader, a, b), pa.array(before + first[:-1]), pa.array(np.diff(first)), [zlib.crc32(data[x:y]) for x, y in zip(at[:-1], at[1:], strict=True)]]

    return _read(files, "doc_id long, start long, n_tokens long, ids_crc32 long", rows)

"""Helpers that the corpus operators share.

Row-local work runs in ``mapInArrow`` through :func:`annotate`: every input row
stays a row, its columns pass through and new columns are appended.  Spark bounds
an Arrow batch (``spark.sql.execution.arrow.maxRecordsPerBatch`` rows, and
``maxBytesPerBatch`` where it is set); an operator works through a batch in slices
of ``SLICE_BYTES``, so what it holds beside the batch follows the slice and the
longest single text, never the partition.
"""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

SLICE_BYTES = 1 << 20
ASCII_SPACE = b" \t\n\x0b\x0c\r"


_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
_KEPT: dict[tuple, object] = {}
_ASKED: set[tuple] = set()


def kept(key: tuple, make: Callable[[], object]):
    """``make()``, which this worker keeps until a task asks for something else or for nothing."""
    _ASKED.add(key)
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = make()
    return _KEPT[key]


def begin(start: Callable[[], object] | None = None):
    """``start()``, after which this worker keeps only what that asked for.

    Module functions alone see the worker's own ``_KEPT``: nested ones are sent with copies.
    """
    _ASKED.clear()
    out = start() if start else None
    for key in _KEPT.keys() - _ASKED:
        del _KEPT[key]
    return out


def give_back() -> None:
    """Freed memory goes back to the system; workers live on, and allocators hold it."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def tidy(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` for mapInArrow, in a worker that lets go of what operators before kept there, and of what this task has freed."""

    def task(batches):
        begin()
        yield from run(batches)
        give_back()

    return task


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder under ``spark.checkpoint.dir``, which driver and executors share.

    Where that setting is absent, a local session gets a temporary folder; a
    cluster gets an error, as its executors do not share one.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tidewater-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back; lost executors cost no lineage."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Tables:
    """Named tables of one run, under one shared folder; ``drop`` deletes one after its last reader."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root = spark, shared_dir(spark, name)

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path
        for name in names:
            path = hadoop(f"{self.root}/{name}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows whose ``column`` holds about ``most`` bytes."""
    n = batch.num_rows
    if not n:
        return
    array = batch.column(batch.schema.get_field_index(column))
    if pa.types.is_null(array.type):
        yield batch
        return
    size = pc.binary_length(array).fill_null(0).to_numpy(zero_copy_only=False)
    part = np.cumsum(size, dtype=np.int64) // most
    cuts = np.flatnonzero(np.diff(part)) + 1
    for a, b in zip(np.r_[0, cuts], np.r_[cuts, n], strict=True):
        yield batch.slice(int(a), int(b - a))


def texts_of(batch: pa.RecordBatch, column: str) -> list[str | None]:
    return batch.column(batch.schema.get_field_index(column)).to_pylist()


def bytes_of(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """UTF-8 bytes of each text, null as empty, without decoding."""
    array = batch.column(batch.schema.get_field_index(column))
    return [x or b"" for x in array.cast(pa.binary()).to_pylist()]


def runs_of(texts: list[bytes], table: bytes, cut: Callable[[np.ndarray], np.ndarray] | None = None) -> tuple[np.ndarray, pa.Array]:
    """All maximal runs of bytes that ``table`` does not turn into a space: the text of each, and the runs, as ``table`` turns them, as an Arrow array.

    ``cut`` gets all bytes and tells those at which a new run begins besides.
    """
    raw = np.frombuffer(b" ".join([*texts, b""]).translate(table), np.uint8)
    inside = raw != 32
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    if cut is not None:
        begins |= cut(raw)
    start = np.flatnonzero(begins)
    offsets = np.append(np.cumsum(inside, dtype=np.int64)[start] - 1, np.count_nonzero(inside))
    owner = np.searchsorted(np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1), start, "right")
    return owner, pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(raw[inside])])


def annotate(
    df: DataFrame,
    fields: list[tuple[str, T.DataType]],
    start: Callable[[], Callable[[pa.RecordBatch], list]],
    by: str,
    keep: list[str] | None = None,
) -> DataFrame:
    """Append ``fields``, computed from each slice of rows by ``start()(slice)``.

    ``by`` is the text column that slices are cut by; ``keep`` limits the columns
    that pass through (all by default).  A column of ``df`` that bears the name of
    a new field is replaced by it.
    """
    new = [n for n, _ in fields]
    kept = [f for f in df.schema.fields if f.name not in new and (keep is None or f.name in keep)]
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in kept] + [T.StructField(n, t, True) for n, t in fields])
    arrow = to_arrow_schema(schema)
    names = [f.name for f in kept]
    types = [arrow.field(n).type for n in new]

    def run(batches):
        fn = begin(start)
        for batch in batches:
            for cut in slices(batch, by):
                made = fn(cut)
                columns = [cut.column(cut.schema.get_field_index(n)) for n in names]
                columns += [x if isinstance(x, pa.Array) and x.type == t else x.cast(t) if isinstance(x, pa.Array) else pa.array(x, t) for x, t in zip(made, types, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=names + new)
        fn = made = columns = batch = cut = None
        give_back()

    need = list(dict.fromkeys([*names, by, *(c for c in (keep or []) if c in df.columns)]))
    return df.select(*[F.col(f"`{c}`") for c in need]).mapInArrow(run, schema)


def shielded(df: DataFrame, *plain: str) -> tuple[DataFrame, list]:
    """``df`` with every column but ``plain`` under a name of its own, and the columns to select to get them back."""
    names = {c: c if c in plain else f"__col{i}" for i, c in enumerate(df.columns)}
    return df.toDF(*names.values()), [F.col(n).alias(c) for c, n in names.items()]


def ragged(values: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Concatenate ``values[start[i] : start[i] + length[i]]`` for every i."""
    end = np.cumsum(length)
    total = int(end[-1]) if len(end) else 0
    at = np.arange(total, dtype=np.int64)
    at += np.repeat(start - (end - length), length)
    return values[at]


def id_remainder(column: str, divisor: int):
    """``crc32`` of the id as text, modulo ``divisor``; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")), F.lit(divisor))


# --- fixed-size Bloom filter -------------------------------------------------

def _bloom_slots(keys: np.ndarray, bits: int) -> list[np.ndarray]:
    keys = keys.astype(np.int64).view(np.uint64)
    shift = np.uint64(64 - bits)
    return [(keys * np.uint64(c)) >> shift for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)]


def bloom(keys: DataFrame, column: str, bits: int = 24) -> np.ndarray:
    """A Bloom filter of 2**bits bits over the 64-bit integers in ``column``.

    Built where the keys are: each task sends at most one row per 64-bit word, the
    words are or-ed in a shuffle, and the driver receives at most 2**(bits-6) rows.
    Its size never grows with the input; a full filter only lets more rows pass.
    """

    def words(batches):
        mine = np.zeros(1 << (bits - 6), np.uint64)
        for batch in batches:
            k = batch.column(0).drop_null().to_numpy(zero_copy_only=False)
            for slot in _bloom_slots(k, bits):
                np.bitwise_or.at(mine, (slot >> np.uint64(6)).astype(np.int64), np.uint64(1) << (slot & np.uint64(63)))
        at = np.flatnonzero(mine)
        for a in range(0, len(at), 100_000):
            part = at[a : a + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(mine[part].view(np.int64))], names=["word", "bits"])

    rows = keys.select(F.col(column).cast("long")).mapInArrow(tidy(words), "word int, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[rows["word"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
    return out


def bloom_has(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    bits = int(len(table)).bit_length() - 1 + 6
    ok = np.ones(len(keys), bool)
    for slot in _bloom_slots(keys, bits):
        ok &= (table[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) == 1
    return ok

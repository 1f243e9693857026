"""Exact dedup with a log-structured merge index of text digests.

``postings``   one row per document: its digest, code points and id.
memtables      each task collects postings and flushes runs, sorted by digest, of
               (digest, best document, number); a hot digest is one entry of a run.
levels         a flush adds a table of runs to level 0; when a level holds ``FANOUT``
               tables they are merged into one table of the next level, whose tasks
               each write one run.
compaction     sorted runs stream through a merge: of the entries of a digest the
               smallest stays (most code points, then smallest id), the numbers add up.
filters        each run of a table has a Bloom filter of the digests that occur twice;
               all filters have one size, so their union is a filter of that size.
hits           documents that pass the filters carry their bytes to those of the kept
               document of their digest and are compared byte by byte; rows that
               differ go through an index again among themselves, so a digest
               that two texts share still ends in two groups.

The bytes of a group meet the kept document's in a join whose other side has one row
per digest: it is broadcast while small, else adaptive execution splits hot digests.

Defined cases: a null text counts as empty and equals other empty texts; a row
with a null id stays only if no equal text of its length has an id; repeated rows
with one id all name that id, and one that shares id and length with the row that
stays counts as kept too; on an empty table the result is empty; other columns, whatever
their names, play no part; a very long text costs a few times its own length.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidewater.llm.common import ASCII_SPACE, Tables, annotate, bloom, bloom_has, bytes_of, materialise

MEMTABLE_ROWS = 50_000
FANOUT = 4  # tables of a level that are merged into one of the next


def normalise(text: bytes) -> bytes:
    return text.translate(None, ASCII_SPACE)


def _slot(sha: bytes, size: int) -> int:
    return int.from_bytes(sha[: min(size, 8)], "little", signed=size >= 8)


def postings(docs: DataFrame, id_col: str = "doc_id", text: str = "text", digest_bytes: int = 32) -> DataFrame:
    """id, code points, digest (index key), its first eight bytes and the SHA-256 of each document."""
    plain = docs.select(F.col(id_col).alias("id"), F.coalesce(F.length(text), F.lit(0)).alias("points"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def start():
        def run(batch):
            sha = [hashlib.sha256(normalise(t)).digest() for t in bytes_of(batch, "text")]
            return [[s[:digest_bytes] for s in sha], [_slot(s, digest_bytes) for s in sha], sha]

        return run

    fields = [("digest", T.BinaryType()), ("slot", T.LongType()), ("sha", T.BinaryType())]
    return annotate(plain, fields, start, "text", ["id", "points"])


def flush_runs(posted: DataFrame, memtable_rows: int = MEMTABLE_ROWS) -> DataFrame:
    """A table of sorted runs of (digest, slot, keep_points, keep_id, n), one for each full memtable."""

    def flush(held):
        table = pa.Table.from_batches(held).sort_by([("digest", "ascending"), ("points", "descending"), ("id", "ascending")])
        run = table.group_by("digest", use_threads=False).aggregate([("slot", "first"), ("points", "first"), ("id", "first"), ([], "count_all")])
        run = run.rename_columns(["digest", "slot", "keep_points", "keep_id", "n"]).cast(pa.schema([("digest", pa.binary()), ("slot", pa.int64()), ("keep_points", pa.int32()), ("keep_id", table.schema.field("id").type), ("n", pa.int64())]))
        return run.combine_chunks().to_batches()

    def memtables(batches):
        held, rows = [], 0
        for batch in batches:
            for a in range(0, batch.num_rows, memtable_rows):
                part = batch.slice(a, memtable_rows)
                held.append(part)
                rows += part.num_rows
                if rows >= memtable_rows:
                    yield from flush(held)
                    held, rows = [], 0
        if rows:
            yield from flush(held)

    kind = posted.schema["id"].dataType.simpleString()
    return posted.select("digest", "slot", "points", "id").mapInArrow(memtables, f"digest binary, slot long, keep_points int, keep_id {kind}, n long")


def merge_runs(*tables: DataFrame) -> DataFrame:
    """Compaction: the runs of ``tables`` merged into sorted runs with one entry per digest over all."""
    every = tables[0]
    for t in tables[1:]:
        every = every.unionByName(t)
    schema = every.schema
    names = schema.names
    order = [F.col("digest"), F.col("keep_points").desc(), F.col("keep_id").asc_nulls_last()]
    kind = pa.schema([("digest", pa.binary()), ("slot", pa.int64()), ("keep_points", pa.int32()), ("keep_id", to_arrow_schema(schema).field("keep_id").type), ("n", pa.int64())])

    def merge(batches):
        last = None
        for batch in batches:
            out = []
            for digest, slot, points, keep, n in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in kind.names), strict=True):
                if last is not None and last[0] == digest:
                    last[4] += n
                else:
                    if last is not None:
                        out.append(last)
                    last = [digest, slot, points, keep, n]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kind.types, strict=True)] if out else [pa.array([], t) for t in kind.types], names=kind.names)
        if last is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(last, kind.types, strict=True)], names=kind.names)

    sorted_ = every.repartition("digest").sortWithinPartitions(*order)
    return sorted_.mapInArrow(merge, T.StructType([schema[n] for n in kind.names])).select(*names)


class DigestIndex:
    """Levels of sorted runs; ``add`` flushes postings, ``entries`` merges what the levels hold."""

    def __init__(self, spark, fanout: int = FANOUT, memtable_rows: int = MEMTABLE_ROWS):
        self.tables, self.fanout, self.memtable_rows = Tables(spark, "index"), fanout, memtable_rows
        self.levels: list[list[tuple[str, DataFrame]]] = [[]]
        self.made = 0

    def _put(self, level: int, df: DataFrame) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        name = f"level{level}-{self.made}"
        self.made += 1
        self.levels[level].append((name, self.tables.save(df, name)))

    def add(self, posted: DataFrame) -> None:
        """Flush the postings of documents; compact the levels that are full."""
        self._put(0, flush_runs(posted, self.memtable_rows))
        for level in range(len(self.levels)):
            if len(self.levels[level]) >= self.fanout:
                self.compact(level)

    def compact(self, level: int) -> None:
        held = self.levels[level]
        self._put(level + 1, merge_runs(*[t for _, t in held]))
        self.levels[level] = []
        self.tables.drop(*[n for n, _ in held])

    def entries(self) -> DataFrame:
        """One entry per digest: all tables merged into one of the highest level, if they are not yet."""
        held = [t for level in self.levels for t in level]
        if len(held) > 1 or self.levels[0]:
            top = max(1, len(self.levels) - 1)
            self.levels = [[] for _ in range(top)] + [held]
            self.compact(top)
        return next(level[0][1] for level in self.levels if level)


def _suspects(docs: DataFrame, id_col: str, text: str, digest_bytes: int, filter_table) -> DataFrame:
    """The normalised bytes of the documents that pass the filter."""
    import numpy as np

    shared = docs.sparkSession.sparkContext.broadcast(filter_table)  # 2**filter_bits bits
    plain = docs.select(F.col(id_col).alias("id"), F.coalesce(F.length(text), F.lit(0)).alias("points"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def start():
        table = shared.value

        def run(batch):
            norm = [normalise(t) for t in bytes_of(batch, "text")]
            sha = [hashlib.sha256(t).digest() for t in norm]
            ok = bloom_has(table, np.array([_slot(s, digest_bytes) for s in sha], np.int64))
            return [[s[:digest_bytes] for s in sha], sha, [t if k else None for t, k in zip(norm, ok, strict=True)]]

        return run

    fields = [("digest", T.BinaryType()), ("sha", T.BinaryType()), ("norm", T.BinaryType())]
    return annotate(plain, fields, start, "text", ["id", "points"]).where("norm is not null")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text: str = "text", digest_bytes: int = 32, filter_bits: int = 24, memtable_rows: int = MEMTABLE_ROWS) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256, one row per row of ``docs``.

    ``digest_bytes`` shortens the index key; tests use it to force two texts onto one digest.
    """
    posted = materialise(postings(docs, id_col, text, digest_bytes), "postings")
    built = DigestIndex(docs.sparkSession, memtable_rows=memtable_rows)
    built.add(posted)
    hits = built.entries().where("n > 1")
    suspects = materialise(_suspects(docs, id_col, text, digest_bytes, bloom(hits, "slot", filter_bits)), "suspects")

    parts, left, index = [], suspects, hits
    while True:
        held = index.select("digest", "keep_id", "keep_points")
        kept = (left["digest"] == held["digest"]) & left["id"].eqNullSafe(held["keep_id"]) & (left["points"] == held["keep_points"])
        keepers = left.join(held, kept).groupBy(left["digest"], "keep_id", "keep_points").agg(F.min("norm").alias("keep_norm"))
        checked = left.join(materialise(keepers, "keepers"), "digest").withColumn("equal", F.col("norm") == F.col("keep_norm")).drop("keep_norm")
        differ = materialise(checked.where("not equal").drop("equal", "keep_id", "keep_points"), "differ")
        if not parts and differ.isEmpty():
            break
        same = checked.where("equal").drop("norm")
        size = same.groupBy("digest").agg(F.count("*").alias("n"))
        parts.append(same.join(size, "digest").select("id", "points", "digest", "sha", "keep_id", "keep_points", "n"))
        if differ.isEmpty():
            break
        left = differ
        again = DigestIndex(docs.sparkSession, memtable_rows=memtable_rows)
        again.add(left.select("digest", F.lit(0).cast("long").alias("slot"), "points", "id"))
        index = again.entries()

    whole, shared = posted, hits.select("digest", "keep_id", "keep_points", "n")
    if parts:  # digests that several texts share take their rows from the rounds above
        several = parts[1].select("digest").distinct()
        whole, shared = posted.join(several, "digest", "left_anti"), shared.join(several, "digest", "left_anti")
    rows = whole.join(shared, "digest", "left").select(
        "id", "points", "sha",
        F.when(F.col("n").isNull(), F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("keep_points", "points").alias("keep_points"), F.coalesce("n", F.lit(1)).cast("long").alias("n"),
    )
    for k, part in enumerate(parts):
        part = part.join(several, "digest", "left_semi") if k == 0 else part
        rows = rows.unionByName(part.select(*rows.columns))
    return rows.select(
        F.col("id").alias("doc_id"), "keep_id", F.col("n").alias("group_size"),
        (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("points") == F.col("keep_points"))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )

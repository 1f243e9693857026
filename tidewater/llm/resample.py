"""Importance resampling of documents towards a target text distribution.

Every run of one to three words is a feature, counted in one of ``BUCKETS`` buckets
by its CRC-32.  Two count arrays, of all documents and of the target, give an array
of gains; a document's weight is the sum of its features' gains, and a weight plus
Gumbel noise that depends on the id alone makes the draw a weighted sample without
replacement.  CRCs of runs are put together from those of their words, as a CRC of a
joined text is a linear function of the CRCs of its parts, by array look-ups.

Ranks come from a distributed least-significant-digit radix sort.  A pass counts the
rows of each (block, digit), turns the counts into global offsets (all smaller digits,
then the same digit in the blocks before) and moves each row to its offset plus its
rank within block and digit, which keeps equal digits in order.  Keys are composite:
score downwards, then null ids last, then id.  Bits that all rows share make no pass.  Blocks hold
``BLOCK`` places, so no window holds more rows, and each pass is written and read
again.  A histogram of the scores first gives a score that enough rows reach; rows
below it cannot be drawn and take no part.

Defined cases: null and empty texts have no words and no features, weight 0; a null
id counts as the empty text in its noise and comes last among ties; rows with equal
ids and scores are drawn in the order they were read; without a document of
``min_words`` words nothing is drawn; without a target all gains are as for a
target of no features; other columns are not carried; a very long text costs a few
times its own length.
"""

from __future__ import annotations

import hashlib
import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm.common import Tables, annotate, bytes_of, runs_of, slices
from tidewater.llm.decontaminate import _FOLD

BUCKETS = 10_000
DIGIT = 11  # bits
BLOCK = 1 << 16
SLICE = 4 << 20
_TOP, _LOW = 2**63 - 1, -(2**63)


class JoinedCrc:
    """CRC-32 of joined byte strings from those of their parts."""

    NEAR = 64

    def __init__(self):
        step = np.array([zlib.crc32(bytes([b])) ^ zlib.crc32(b"\0") for b in range(256)], np.uint32)
        table = np.array([[b << 8 * k for b in range(256)] for k in range(4)], np.uint32)
        near = []
        for _ in range(self.NEAR):
            near.append(table)
            table = table >> np.uint32(8) ^ step[table & np.uint32(255)]
        self.near = np.stack(near)
        self.powers = [table]  # 64 bytes on, 128, ...
        for _ in range(32):
            self.powers.append(self._through(self.powers[-1], self.powers[-1]))

    @staticmethod
    def _through(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
        return table[0, crc & 255] ^ table[1, crc >> 8 & 255] ^ table[2, crc >> 16 & 255] ^ table[3, crc >> 24]

    def ahead(self, crc: np.ndarray, size: np.ndarray) -> np.ndarray:
        """``crc`` as it counts before ``size`` further bytes."""
        low, far = size % self.NEAR, size // self.NEAR
        flat = self.near.reshape(-1)
        at = low * 1024
        out = flat[at + (crc & 255)] ^ flat[at + 256 + (crc >> 8 & 255)] ^ flat[at + 512 + (crc >> 16 & 255)] ^ flat[at + 768 + (crc >> 24)]
        for k in range(int(far.max(initial=0)).bit_length()):
            own = np.flatnonzero(far >> k & 1)
            out[own] = self._through(self.powers[k], out[own])
        return out


class Features:
    """Buckets of the runs of one to three words of a slice of texts."""

    def __init__(self, buckets: int):
        self.buckets, self.joined = buckets, JoinedCrc()
        self.space = np.uint32(zlib.crc32(b" "))

    def __call__(self, texts: list[bytes]):
        """Document and bucket of every feature, and the number of words of each text."""
        doc, words = runs_of(texts, _FOLD)
        size = np.diff(np.frombuffer(words.buffers()[1], np.int64)[: len(words) + 1])
        coded = words.dictionary_encode()
        crc = np.fromiter(map(zlib.crc32, coded.dictionary.to_pylist()), np.uint32, len(coded.dictionary))[coded.indices.to_numpy()]
        docs, found = [doc], [crc]
        run = crc
        for _ in range(2):
            doc = doc[:-1]
            run = self.joined.ahead(run[:-1], np.ones(len(doc), np.int64)) ^ self.space if len(doc) else run[:-1]
            after = len(crc) - len(run)
            run = self.joined.ahead(run, size[after:]) ^ crc[after:]
            own = doc == docs[0][after:]
            docs.append(doc[own])
            found.append(run[own])
        return np.concatenate(docs), np.concatenate(found) % np.uint32(self.buckets), np.bincount(docs[0], minlength=len(texts))


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, text: str = "text") -> np.ndarray:
    """Features in each bucket over all rows; a task sends at most one row a bucket."""

    def run(batches):
        count, features = np.zeros(buckets, np.int64), Features(buckets)
        for batch in batches:
            for cut in slices(batch, "text", SLICE):
                count += np.bincount(features(bytes_of(cut, "text"))[1], minlength=buckets)
        at = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(count[at])], names=["bucket", "n"])

    plain = texts.select(F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = plain.mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(buckets, np.int64)
    out[rows["bucket"].to_numpy()] = rows["n"].to_numpy()
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln of the ratio of the smoothed shares of each bucket)."""
    n, s, t = len(source), int(source.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log(float(b + 1) * float(s + n) / (float(a + 1) * float(t + n)))) for a, b in zip(source.tolist(), target.tolist(), strict=True)], np.int64)


def noise(doc_id: int | None, seed: int) -> int:
    """floor(1000 times a standard Gumbel value) of an id."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def importance_scores(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text: str = "text", buckets: int = BUCKETS, seed: int = 42) -> DataFrame:
    """doc_id, n_words, n_features, weight and score of every document."""
    gain = gains(bucket_counts(docs, buckets, text), bucket_counts(target, buckets, text))

    def start():
        features = Features(buckets)

        def run(batch):
            doc, bucket, words = features(bytes_of(batch, "text"))
            n = len(words)
            per = np.bincount(doc, minlength=n)
            weight = np.zeros(n, np.int64)
            np.add.at(weight, doc, gain[bucket])
            score = weight + np.array([noise(i, seed) for i in batch.column(0).to_pylist()], np.int64)
            return [pa.array(words.astype(np.int64)), pa.array(per.astype(np.int64)), pa.array(weight), pa.array(score)]

        return run

    plain = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return annotate(plain, [(c, T.LongType()) for c in ("n_words", "n_features", "weight", "score")], start, "text", ["doc_id"])


# --- radix sort --------------------------------------------------------------

def _pass(rows: DataFrame, digit: Column) -> DataFrame:
    """One stable counting-sort pass: the rows with their places by ``digit``, and the order so far among equal digits."""
    rows = rows.withColumn("digit", digit)
    counts = rows.groupBy("digit", "block").agg(F.count("*").alias("n"))
    whole = counts.groupBy("digit").agg(F.sum("n").alias("n"))  # at most 2 ** DIGIT rows
    before = lambda over: F.coalesce(F.sum("n").over(over.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    smaller = whole.select("digit", before(Window.orderBy("digit")).alias("smaller"))
    offsets = counts.withColumn("earlier", before(Window.partitionBy("digit").orderBy("block"))).join(smaller, "digit").select("block", "digit", (F.col("smaller") + F.col("earlier")).alias("offset"))
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy("block", "digit").orderBy("place")))
    moved = ranked.join(offsets, ["block", "digit"]).withColumn("place", F.col("offset") + F.col("rank") - 1)
    return moved.withColumn("block", F.floor(F.col("place") / BLOCK)).select(*[c for c in rows.columns if c != "digit"])


def radix_places(rows: DataFrame, keys: list[str], order: str, tables: Tables) -> DataFrame:
    """``rows`` with ``place``, 0 for the first by ``keys`` (64-bit integers, the first one counts most), then by ``order``.

    ``order`` has distinct integers of at least 0.
    """
    flipped = rows.withColumns({k: F.col(k).bitwiseXOR(F.lit(_LOW)) for k in keys})  # order as unsigned numbers
    at = tables.save(flipped.withColumns({"place": F.col(order), "block": F.floor(F.col(order) / (BLOCK * 16))}), "radix")
    span = at.agg(*[F.expr(f"bit_or({k}) ^ bit_and({k})").alias(k) for k in keys]).first()
    last = "radix"
    if span[0] is None:
        return at.drop("block")
    for k in reversed(keys):
        for shift in range(0, (span[k] % 2**64).bit_length(), DIGIT):
            if span[k] >> shift & 2**DIGIT - 1:
                name = f"radix-{k}-{shift}"
                at = tables.save(_pass(at, F.shiftrightunsigned(k, shift).bitwiseAND(F.lit(2**DIGIT - 1)).cast("int")), name)
                tables.drop(last)
                last = name
    if last == "radix":  # one key for all
        at = tables.save(_pass(at, F.lit(0)), "radix-same")
    return at.withColumns({k: F.col(k).bitwiseXOR(F.lit(_LOW)) for k in keys}).drop("block")


def _reached(scores: DataFrame, least: int, most: int, k: int) -> int:
    """A score that at least ``k`` rows reach, close below the k-th highest."""
    shift = max(0, (most - least).bit_length() - 12)
    held = scores.groupBy(F.shiftright(F.col("score") - least, shift).alias("bin")).agg(F.count("*").alias("n")).orderBy(F.desc("bin")).collect()  # at most 4096
    total = 0
    for b, n in held:
        total += n
        if total >= k:
            return least + (b << shift)
    return least


def importance_resample(docs: DataFrame, target: DataFrame, percent: int = 5, min_words: int = 20, id_col: str = "doc_id", text: str = "text", buckets: int = BUCKETS, seed: int = 42) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every document; ``rank`` counts the drawn ones from 1, others have none.

    Of the documents with ``min_words`` words or more ``percent`` % are drawn, rounded down.
    """
    tables = Tables(docs.sparkSession, "resample")
    scored = tables.save(importance_scores(docs, target, id_col, text, buckets, seed).withColumn("row", F.monotonically_increasing_id()), "scored")
    able = scored.where(F.col("n_words") >= min_words)
    least, most, n = able.agg(F.min("score"), F.max("score"), F.count("*")).first()
    k = percent * n // 100
    out = ["doc_id", "n_features", "weight", "score"]
    if not k:
        return scored.select(*out, F.lit(None).cast("long").alias("rank"))
    near = able.where(F.col("score") >= _reached(able, least, most, k))
    keyed = near.select("row", (-F.col("score")).alias("down"), F.col("doc_id").isNull().cast("long").alias("last"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"))
    drawn = radix_places(keyed, ["down", "last", "id"], "row", tables).where(F.col("place") < k)
    return scored.join(drawn.select("row", (F.col("place") + 1).alias("rank")), "row", "left").select(*out, "rank")

"""Line dedup: drop the lines that many documents share.

Lines are normalised and hashed where the documents are read; only 128-bit
hashes and positions are exploded and shuffled.  A hash counts once per document,
partial counts combine before the shuffle, and the lines of frequent hashes are
found by a semi-join: frequent hashes are broadcast up to ``BROADCAST_KEYS`` of them, so
that no task gets all lines of one hash; beyond, adaptive execution splits the skewed
side.  Documents are then reassembled by position from what is left.

Defined cases: every row is a document, so repeated rows count each; a null or
empty text is one empty line; a line whose key is shorter than ``min_chars``
never goes; if all lines go the text is empty; null ids are kept apart by text;
without rows there are none; a very long text costs a few times its own length.
"""

from __future__ import annotations

import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm.common import ASCII_SPACE, annotate, bytes_of, materialise, shielded

BROADCAST_KEYS = 500_000  # hashes of 16 bytes


def line_key(line: bytes) -> bytes:
    """White space off both ends, A-Z in lower case (``bytes.lower`` leaves other bytes)."""
    return line.strip(ASCII_SPACE).lower()


def _hashes(text: bytes, min_chars: int) -> list[bytes | None]:
    out = []
    for line in text.split(b"\n"):
        key = line_key(line)
        short = len(key) < min_chars or len(key) < 4 * min_chars and len(key.decode()) < min_chars
        out.append(None if short else xxhash.xxh3_128_digest(key))
    return out


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text: str = "text", min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """``docs`` with ``text`` replaced by the kept lines, plus n_lines and n_dropped.

    Lines whose key is found in at least ``min_docs`` documents are dropped.
    Columns named n_lines or n_dropped are replaced.
    """
    texts = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("mark"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def start():
        return lambda batch: [[_hashes(t, min_chars) for t in bytes_of(batch, "text")]]

    lines = materialise(annotate(texts, [("keys", T.ArrayType(T.BinaryType()))], start, "text", ["id", "mark"]), "lines")
    frequent = (
        lines.select(F.explode(F.array_distinct("keys")).alias("key")).where("key is not null")
        .groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") >= min_docs).select("key")
    )
    frequent = materialise(frequent, "frequent")
    if frequent.count() <= BROADCAST_KEYS:
        frequent = F.broadcast(frequent)
    dropped = (
        lines.select("id", "mark", F.posexplode("keys").alias("at", "key")).where("key is not null")
        .join(frequent, "key", "left_semi")
        .groupBy(F.col("id").alias("__id"), F.col("mark").alias("__mark")).agg(F.collect_set("at").alias("__gone"))
    )
    full = docs.drop("n_lines", "n_dropped").withColumn("__key", F.xxhash64(text))
    joined = full.join(dropped, F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("__key") == F.col("__mark")), "left")
    parts = F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)
    stay = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col("__gone"))
    kept = F.array_join(F.transform(stay, lambda i: F.get(parts, i)), "\n")
    return joined.select(
        *[F.when(F.col("__gone").isNull(), F.coalesce(F.col(text), F.lit(""))).otherwise(kept).alias(text) if c == text else F.col(f"`{c}`") for c in full.columns if c != "__key"],
        F.size(parts).cast("long").alias("n_lines"),
        F.coalesce(F.size("__gone"), F.lit(0)).cast("long").alias("n_dropped"),
    )


def without_shared_lines(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with the kept lines as text; n_chars, if there, counts them."""
    own, back = shielded(docs, "doc_id", "text")
    done = dedup_lines(own, **options).select(*back)
    return done.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"])) if "n_chars" in docs.columns else done

"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes ratios.

Features say whether a hashed n-gram of 3 to 5 lower-cased characters occurs in
the text at least once, twice or three times.  Those whose rate differs between
the classes beyond chance are scaled by the log of the ratio of their smoothed
rates in the two classes, and a logistic model is fitted on top.

Defined cases: a null text counts as empty; an empty text has no feature and gets
the model's base rate; repeated rows score alike; without labels of both classes
every text gets the smoothed base rate; n-grams do not cross texts; an empty table
gives an empty one; a very long text costs memory of its own length times a constant;
a column named like the output is replaced, other columns pass through.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm.common import annotate, id_remainder, materialise, slices, texts_of
from tidewater.llm.learn import fit_logistic, labelled_sample, sample_features, sigmoid, sparse_rows

BITS = 18
ORDERS = (3, 4, 5)
LEVELS = 3
LEAST_DOCS = 5  # documents of the sample that must have a feature
LEAST_Z = 4.0  # standard errors by which its rate must differ
MAX_ROWS = 12_000  # labelled rows that are fitted on
COUNT_BYTES = 256 << 10  # text that is counted at a time, as every n-gram is sorted
_ODD = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F, 0x165667B1], np.uint32)


def ngram_features(texts: list[str | None], used: np.ndarray | None = None, orders=ORDERS, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Row and feature (level << bits | hashed n-gram) of lower-cased texts, level by level.

    ``used`` marks the hashes that matter; others are left out before sorting.
    """
    pad = "\x00" * (max(orders) - 1)
    lowered = [(t or "").lower() for t in texts]
    codes = np.frombuffer((pad.join(lowered) + pad).encode("utf-32-le", "surrogatepass"), np.uint32)
    size = np.array([len(t) for t in lowered], np.int64)
    begin = np.cumsum(size + len(pad)) - size - len(pad)
    doc = np.repeat(np.arange(len(texts), dtype=np.int64) << bits, size)
    at = np.arange(int(size.sum()), dtype=np.int64) + np.repeat(begin - (np.cumsum(size) - size), size)
    keys, mixed = [], codes * _ODD[0]
    for k in range(1, max(orders)):
        mixed = mixed[:-1] * np.uint32(31) + (codes[k:] * _ODD[k])
        if k + 1 in orders:
            h = mixed ^ (mixed >> np.uint32(15))
            h = (h * np.uint32(0x2C1B3C6D) + np.uint32(k)) >> np.uint32(32 - bits)
            inside = codes[np.minimum(at + k, len(codes) - 1)] != 0
            h = h[np.minimum(at, len(h) - 1)]
            if used is not None:
                inside &= used[h]
            keys.append(doc[inside] + h[inside])
    every = np.concatenate(keys)
    every.sort()
    first = np.flatnonzero(np.r_[True, every[1:] != every[:-1]]) if len(every) else np.zeros(0, np.int64)
    times = np.diff(np.r_[first, len(every)])
    keys = every[first]
    rows = np.concatenate([keys[times > k] >> bits for k in range(LEVELS)])
    index = np.concatenate([(keys[times > k] & ((1 << bits) - 1)) + (k << bits) for k in range(LEVELS)])
    return rows, index


def chosen_ratios(sample: DataFrame, label: str) -> tuple[np.ndarray, float]:
    """The log ratio of every feature, zero for those that do not tell the classes apart.

    Tasks send what they counted; the driver receives the chosen features, at most
    LEVELS << BITS rows.
    """

    def count(batches):
        pos, every = np.zeros(LEVELS << BITS, np.int64), np.zeros(LEVELS << BITS, np.int64)
        for batch in batches:
            for cut in slices(batch, "text", COUNT_BYTES):
                y = cut.column(cut.schema.get_field_index(label)).to_numpy(zero_copy_only=False)
                row, index = ngram_features(texts_of(cut, "text"))
                every += np.bincount(index, minlength=len(every))
                pos += np.bincount(index[y[row] == 1], minlength=len(pos))
        at = np.flatnonzero(every)
        for a in range(0, len(at), 100_000):
            part = at[a : a + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(pos[part]), pa.array(every[part])], names=["feature", "pos", "n"])

    total = sample.agg(F.count("*").alias("n"), F.coalesce(F.sum((F.col(label) == 1).cast("int")), F.lit(0)).alias("pos")).first()
    out, base = np.zeros(LEVELS << BITS), total["pos"] / max(1, total["n"])
    if 0 < base < 1:
        z = (F.col("pos") - F.col("n") * base) / F.sqrt(F.col("n") * base * (1 - base))
        sums = sample.select(label, "text").mapInArrow(count, "feature int, pos long, n long").groupBy("feature").agg(F.sum("pos").alias("pos"), F.sum("n").alias("n"))
        rows = sums.where((F.col("n") >= LEAST_DOCS) & (F.abs(z) >= LEAST_Z)).toArrow()
        pos, every = rows["pos"].to_numpy(), rows["n"].to_numpy()
        out[rows["feature"].to_numpy()] = np.log((pos + 1) / (total["pos"] + 2)) - np.log((every - pos + 1) / (total["n"] - total["pos"] + 2))
    return out, base


def _used(features: np.ndarray) -> np.ndarray:
    return (features.reshape(LEVELS, -1) != 0).any(axis=0)


def train(docs: DataFrame, labels: DataFrame, learn, label: str = "toxic", max_rows: int = MAX_ROWS) -> dict:
    """Fit on at most ``max_rows`` labelled documents; ``learn`` is a condition on doc_id.

    The model holds what each feature adds, which hashes have any, and the bias.
    """
    sample = materialise(labelled_sample(docs, labels, label, learn, max_rows, ["text"]).where(F.col(label).isNotNull()), "sample")
    ratio, _ = chosen_ratios(sample, label)
    shared = docs.sparkSession.sparkContext.broadcast(ratio.astype(np.float32))  # LEVELS << BITS numbers

    def start():
        own = shared.value
        used = _used(own)

        def run(batch):
            row, index = ngram_features(texts_of(batch, "text"), used)
            row, index = row[own[index] != 0], index[own[index] != 0]
            order = np.argsort(row, kind="stable")
            cuts = np.searchsorted(row[order], np.arange(1, batch.num_rows))
            return [np.split(index[order].astype(np.int32), cuts)]

        return run

    table = sample_features(sample, label, [("grams", T.ArrayType(T.IntegerType()))], start, "text", max_rows)
    y = np.array(table[label].to_pylist(), float)
    row, index = sparse_rows(table["grams"])
    weight, bias = fit_logistic(row, index, ratio[index], y, len(ratio), np.full(len(ratio), 0.3), 1e-4, 100, 0.02)
    add = (ratio * weight).astype(np.float32)
    return {"add": add, "used": _used(add), "bias": bias}


def score_texts(texts: list[str | None], model: dict) -> np.ndarray:
    row, index = ngram_features(texts, model["used"])
    return sigmoid(np.bincount(row, model["add"][index], len(texts)) + model["bias"])


def score(df: DataFrame, model: dict, text: str = "text", out: str = "score", keep: list[str] | None = None) -> DataFrame:
    """Append ``out``, the probability of the label; the model has a fixed size (under 4 MB) and is broadcast."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def start():
        own = shared.value
        return lambda batch: [score_texts(texts_of(batch, text), own)]

    return annotate(df, [(out, T.DoubleType())], start, text, keep)


def toxic_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, max_rows: int = MAX_ROWS) -> DataFrame:
    """doc_id, held_out, score and predicted, learned from rows that are not held out."""
    model = train(docs, labels, id_remainder("doc_id", 5) != 0, max_rows=max_rows)
    done = score(docs.select("doc_id", "text"), model, keep=["doc_id"])
    return done.select("doc_id", (id_remainder("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))

"""Quality: a factorisation machine on hashed words, text structure and metadata.

A text's features are its hashed words (share of the text, scaled to length one),
structure statistics (each as a number and as one of ten bins), and metadata: the
table's own character count against the text's.  The score is
    bias + sum w_i x_i + 1/2 sum_f ((sum v_if x_i)^2 - sum v_if^2 x_i^2)
so pairwise interactions of rank ``RANK`` cost time linear in the features.

Defined cases: a null text counts as empty; an empty text has statistics but no
words; an n_chars that is null, no number or absent is taken as the text's length;
repeated rows score alike; without labels of both classes every text gets the smoothed
base rate; an empty table gives an empty one; very long texts cost memory of their own
length times a constant; a column score of the input is replaced by ``score``, others
pass through.
"""

from __future__ import annotations

import itertools
from decimal import Decimal

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm.common import annotate, bytes_of, id_remainder
from tidewater.llm.learn import MAX_ROWS, Adam, labelled_sample, sample_features, sigmoid, sparse_rows

BITS = 14
RANK = 6
BINS = 10
MEMO = 60_000

# character classes of UTF-8 bytes
_CLASS = np.full(256, 4, np.int64)  # 4: other symbols
_CLASS[[9, 10, 11, 12, 13, 32]] = 0
_CLASS[97:123] = 1
_CLASS[128:256] = 1
_CLASS[65:91] = 2
_CLASS[48:58] = 3
_CLASS[[44, 46]] = 5
N_CLASS = 6
STATS = ("log_bytes", "log_words", "word_bytes", "upper", "digit", "symbol", "stop", "distinct", "repeat1", "repeat2", "top_word", "log_lines", "line_words", "same_lines", "marked_words", "capital_words", "count_gap")


class Extractor:
    """Word and structure features of many texts at once; one per worker."""

    def __init__(self):
        self.memo: dict[bytes, int] = {}

    def __call__(self, texts: list[bytes], n_chars: list[int | None]):
        """(row, bucket, value) of the words, and the statistics by row."""
        if len(self.memo) > MEMO:
            self.memo.clear()
        n = len(texts)
        split = [t.split() for t in texts]
        for w in set().union(*split).difference(self.memo):
            last = w.rstrip(b".,")[-1:]
            marked = bool(last) and last[0] < 128 and not last.isalnum()
            self.memo[w] = (xxhash.xxh3_64_intdigest(w.lower()) >> 4) << 2 | marked << 1 | w.isupper()
        words = np.array([len(s) for s in split], np.int64)
        code = np.fromiter(map(self.memo.__getitem__, itertools.chain.from_iterable(split)), np.int64, int(words.sum()))
        doc = np.repeat(np.arange(n), words)
        total = np.maximum(words, 1)
        hashed = code >> 2
        size = np.array([len(t) for t in texts], np.int64)
        flat = np.frombuffer(b"".join(texts), np.uint8)
        kinds = np.bincount(np.repeat(np.arange(n) * N_CLASS, size) + _CLASS[flat], minlength=n * N_CLASS).reshape(n, N_CLASS)
        inked = np.maximum(kinds[:, 1:].sum(1), 1)

        def repeats(lag):
            same = (hashed[lag:] == hashed[:-lag]) & (doc[lag:] == doc[:-lag]) if len(hashed) > lag else np.zeros(0, bool)
            return np.bincount(doc[lag:][same], minlength=n) / total

        order = np.lexsort((hashed, doc))
        d, h = doc[order], hashed[order]
        new = np.flatnonzero(np.r_[True, (d[1:] != d[:-1]) | (h[1:] != h[:-1])]) if len(d) else np.zeros(0, np.int64)
        times = np.diff(np.r_[new, len(d)])
        top = np.zeros(n)
        np.maximum.at(top, d[new], times)
        lines = [t.split(b"\n") for t in texts]
        n_lines = np.array([len(x) for x in lines])
        same_lines = np.array([1 - len(set(x)) / len(x) for x in lines])
        points = size - np.bincount(np.repeat(np.arange(n), size)[(flat & 0xC0) == 0x80], minlength=n)
        told = np.array([p if c is None else c for c, p in zip(n_chars, points, strict=True)], float)
        stats = np.stack([
            np.log1p(size), np.log1p(words), inked / total, kinds[:, 2] / inked, kinds[:, 3] / inked, kinds[:, 4] / inked, kinds[:, 5] / total,
            np.bincount(d[new], minlength=n) / total, repeats(1), repeats(2), top / total, np.log1p(n_lines), total / n_lines, same_lines,
            np.bincount(doc, code >> 1 & 1, n) / total, np.bincount(doc, code & 1, n) / total, np.abs(told - points) / (1 + points),
        ], axis=1) if n else np.zeros((0, len(STATS)))
        row, bucket = d[new], h[new] & ((1 << BITS) - 1)
        length = np.sqrt(np.bincount(row, times.astype(float) ** 2, n))
        return row, bucket, times / np.maximum(length, 1)[row], stats


def _batch_inputs(batch, text: str, count: str | None):
    """Texts and the table's own character counts, of any number type, None where it gives none."""
    counts = batch.column(batch.schema.get_field_index(count)).to_pylist() if count else [None] * batch.num_rows
    counts = [float(c) if isinstance(c, (int, float, Decimal)) and c == c else None for c in counts]
    return bytes_of(batch, text), counts


def machine_inputs(row, bucket, value, stats, model: dict):
    """All sparse features: words, statistics as numbers, statistics as bins."""
    n, k = stats.shape
    scaled = np.clip((stats - model["mean"]) / model["spread"], -3, 3)
    dim = 1 << BITS
    bins = np.stack([np.searchsorted(model["edges"][j], stats[:, j], side="right") for j in range(k)], axis=1) if k else np.zeros((n, 0), int)
    each = np.repeat(np.arange(n), k)
    rows = np.concatenate([row, each, each])
    index = np.concatenate([bucket, np.tile(dim + np.arange(k), n), (dim + k + np.arange(k) * BINS + bins).ravel()])
    return rows, index, np.concatenate([value, scaled.ravel() / 3, np.full(n * k, 0.5)])


def machine_scores(rows, index, value, n: int, model: dict) -> np.ndarray:
    """Raw scores, linear in the number of features by the sum-of-squares identity."""
    out = np.bincount(rows, model["w"][index] * value, n) + model["bias"]
    for f in range(model["v"].shape[1]):
        part = model["v"][index, f] * value
        out += 0.5 * (np.bincount(rows, part, n) ** 2 - np.bincount(rows, part * part, n))
    return out


def fit(row, bucket, value, stats, y: np.ndarray, rounds: int = 120, rate: float = 0.03, l2: float = 1e-4, enough: float = 0.006) -> dict:
    """Full-batch steps from the mean log loss down to ``enough``, at most ``rounds`` of them."""
    n, dim = len(y), (1 << BITS) + len(STATS) * (BINS + 1)
    good = float(y.sum())
    edges = np.quantile(stats, np.linspace(0, 1, BINS + 1)[1:-1], axis=0).T if n else np.zeros((len(STATS), BINS - 1))
    model = {
        "mean": stats.mean(0) if n else np.zeros(len(STATS)), "spread": np.maximum(stats.std(0), 1e-6) if n else np.ones(len(STATS)), "edges": edges,
        "w": np.zeros(dim), "v": np.zeros((dim, RANK)), "bias": float(np.log((good + 0.5) / (n - good + 0.5))),
    }
    if good in (0.0, float(n)):
        return model
    model["v"] = np.random.default_rng(7).normal(0, 0.02, (dim, RANK))
    r, i, x = machine_inputs(row, bucket, value, stats, model)
    move_w, move_v, move_b = Adam(dim, rate), Adam((dim, RANK), rate), Adam(1, rate)
    for _ in range(rounds):
        p = sigmoid(machine_scores(r, i, x, n, model))
        if -np.log(np.maximum(np.where(y > 0, p, 1 - p), 1e-12)).mean() < enough:
            break
        gap = (p - y) / n
        g = gap[r] * x
        grad_v = np.empty((dim, RANK))
        for f in range(RANK):
            part = model["v"][i, f] * x
            grad_v[:, f] = np.bincount(i, g * (np.bincount(r, part, n)[r] - part), dim)
        model["w"] += move_w.step(np.bincount(i, g, dim) + l2 * model["w"])
        model["v"] += move_v.step(grad_v + l2 * model["v"])
        model["bias"] += float(move_b.step(np.array([gap.sum()]))[0])
    return model


def train(docs: DataFrame, labels: DataFrame, learn, label: str = "quality", max_rows: int = MAX_ROWS) -> dict:
    """Fit on at most ``max_rows`` labelled documents; ``learn`` is a condition on doc_id."""
    carry = ["text", "n_chars"] if "n_chars" in docs.columns else ["text"]
    sample = labelled_sample(docs, labels, label, learn, max_rows, carry)
    count = "n_chars" if "n_chars" in carry else None

    def start():
        extract = Extractor()

        def run(batch):
            row, bucket, value, stats = extract(*_batch_inputs(batch, "text", count))
            cuts = np.searchsorted(row, np.arange(1, batch.num_rows))
            return [np.split(bucket.astype(np.int32), cuts), np.split(value, cuts), list(stats)]

        return run

    fields = [("bucket", T.ArrayType(T.IntegerType())), ("value", T.ArrayType(T.DoubleType())), ("stats", T.ArrayType(T.DoubleType()))]
    table = sample_features(sample, label, fields, start, "text", max_rows, (count,) if count else ())
    row, bucket = sparse_rows(table["bucket"])
    value = sparse_rows(table["value"])[1].astype(float)
    stats = np.array([v.as_py() for v in table["stats"]], float).reshape(-1, len(STATS))
    return fit(row, bucket, value, stats, np.array(table[label].to_pylist(), float))


def score(df: DataFrame, model: dict, text: str = "text", out: str = "score", keep: list[str] | None = None) -> DataFrame:
    """Append ``out``, the probability of good quality; the model has a fixed size and is broadcast."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    count = "n_chars" if "n_chars" in df.columns else None

    def start():
        own, extract = shared.value, Extractor()

        def run(batch):
            row, bucket, value, stats = extract(*_batch_inputs(batch, text, count))
            return [pa.array(sigmoid(machine_scores(*machine_inputs(row, bucket, value, stats, own), len(stats), own)))]

        return run

    if keep is not None and count:
        return annotate(df, [(out, T.DoubleType())], start, text, [*keep, count]).select(*keep, out)
    return annotate(df, [(out, T.DoubleType())], start, text, keep)


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, max_rows: int = MAX_ROWS) -> DataFrame:
    """doc_id, held_out, score and predicted, learned from rows that are not held out."""
    model = train(docs, labels, id_remainder("doc_id", 5) != 0, max_rows=max_rows)
    done = score(docs.select("doc_id", "text", *[c for c in ("n_chars",) if c in docs.columns]), model, keep=["doc_id"])
    return done.select("doc_id", (id_remainder("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, max_rows: int = MAX_ROWS) -> DataFrame:
    """The rows of ``docs`` whose score is at least ``threshold``."""
    model = train(docs, labels, id_remainder("doc_id", 5) != 0, max_rows=max_rows)
    return score(docs, model, out="__score").where(F.col("__score") >= threshold).drop("__score")

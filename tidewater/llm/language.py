"""Language identification with error-correcting output codes.

Each language has a codeword of bits; a logistic classifier on hashed character
n-grams (1 to 3 characters, square roots of their shares) predicts each bit.
Decoding adds the logistic losses of the bits against each codeword, weighted by
how well a bit was learned, and takes the nearest codeword.  ``score`` is the share
of the best codeword among all in exp(-loss); ``ambiguous`` marks texts where the
second codeword is nearly as near.

Defined cases: a null text and a text without a letter are ``und`` with score 0;
without learnable rows every text is ``und``; with one language every text with a
letter is that language with score 1; repeated rows are predicted alike; an empty table
gives an empty one; a very long text costs memory of its own length times a constant;
columns lang_pred, score and ambiguous of the input are replaced, others pass through.
"""

from __future__ import annotations

import itertools

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm.common import annotate, id_remainder, texts_of
from tidewater.llm.learn import MAX_ROWS, Adam, sample_features, sigmoid

BITS = 12
ORDERS = 3
GAP = 0.2
_ODD = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)


def codewords(n: int) -> np.ndarray:
    """A row of -1 and 1 for each of n languages.

    Up to five: every way to part the languages in two (exhaustive code).  More:
    the best of a fixed series of random codes by least distance.
    """
    if n <= 5:
        cuts = [c for c in itertools.product((1, -1), repeat=n) if c[0] == 1 and -1 in c]
        return np.array(cuts).T.reshape(n, -1) if cuts else np.ones((n, 1), int)
    width, best, least = int(np.ceil(10 * np.log2(n))), None, -1
    for seed in range(200):
        code = np.where(np.random.default_rng(seed).random((n, width)) < 0.5, -1, 1)
        apart = (width - code @ code.T) // 2 + np.eye(n, dtype=int) * width
        if apart.min() > least and (np.abs(code.sum(0)) < n).all():
            best, least = code, apart.min()
    return best


def features(texts: list[str | None]) -> np.ndarray:
    """A dense row of 2**BITS numbers for each text, of length one (zero if empty)."""
    dim, pad = 1 << BITS, "\x00" * ORDERS
    lowered = [(t or "").lower() for t in texts]
    out = np.zeros((len(texts), dim), np.float32)
    codes = np.frombuffer((pad + pad.join(lowered) + pad).encode("utf-32-le", "surrogatepass"), np.uint32)
    size = np.array([len(t) for t in lowered], np.int64)
    doc = np.repeat(np.arange(len(texts), dtype=np.int64) * dim, size)
    begin = np.cumsum(size + ORDERS) - size
    at = np.arange(int(size.sum()), dtype=np.int64) + np.repeat(begin - (np.cumsum(size) - size), size)
    flat, mixed = out.reshape(-1), np.zeros(len(codes), np.uint32)
    for k in range(ORDERS):
        mixed[k:] += codes[: len(codes) - k] * _ODD[k]  # the k characters before also count
        h = (mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x2C1B3C6D) + np.uint32(k * 0x3779)
        flat += np.bincount(doc + ((h * np.uint32(0x297A2D39)) >> np.uint32(32 - BITS))[at], minlength=len(flat)).astype(np.float32)
    np.sqrt(out, out)
    return out / np.maximum(np.sqrt(np.einsum("ij,ij->i", out, out)), 1e-12)[:, None].astype(np.float32)


def _blocks(texts, rows: int = 256):
    for a in range(0, len(texts), rows):
        yield features(texts[a : a + rows])


def fit(rows: np.ndarray, langs: list[str], rounds: int = 150, l2: float = 1e-5) -> dict:
    """Bit classifiers, bit weights and codewords from feature rows and their languages."""
    names = sorted(set(langs))
    code = codewords(len(names)) if names else np.zeros((0, 1), int)
    which = np.array([names.index(x) for x in langs], int)
    weight, bias = np.zeros((rows.shape[1], code.shape[1])), np.zeros(code.shape[1])
    if len(names) > 1:
        y = (code[which] > 0).astype(float)
        move_w, move_b = Adam(weight.shape, 0.3), Adam(bias.shape, 0.3)
        rows = np.ascontiguousarray(rows, np.float32)  # products in single precision; a mixed one would copy the rows each round
        for _ in range(rounds):
            gap = sigmoid(rows @ weight.astype(np.float32) + bias) - y
            weight += move_w.step(rows.T @ gap.astype(np.float32) / len(rows) + l2 * weight)
            bias += move_b.step(gap.mean(0))
        right = ((rows @ weight.astype(np.float32) + bias > 0) == (y > 0)).mean(0)
    else:
        right = np.ones(code.shape[1])
    trust = np.maximum(2 * right - 1, 0.01)
    return {"names": names, "code": code, "weight": weight.astype(np.float32), "bias": bias, "trust": trust / trust.mean()}


def predict(texts: list[str | None], model: dict) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, score and ambiguity of each text."""
    names = model["names"]
    if not names:
        return ["und"] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), bool)
    margins = np.concatenate([x @ model["weight"] for x in _blocks(texts)]) + model["bias"]
    loss = np.logaddexp(0.0, -margins[:, None, :] * model["code"][None]) @ model["trust"] / model["code"].shape[1]
    near = np.sort(loss, axis=1)
    share = np.exp(-(loss - near[:, :1]) * model["code"].shape[1])
    best = loss.argmin(axis=1)
    close = near[:, 1] - near[:, 0] < GAP if len(names) > 1 else np.zeros(len(texts), bool)
    lettered = [bool(t) and any(map(str.isalpha, t)) for t in texts]
    langs = [names[b] if ok else "und" for b, ok in zip(best, lettered, strict=True)]
    return langs, np.where(lettered, 1.0 / share.sum(axis=1), 0.0), close & np.array(lettered, bool)


def train(docs: DataFrame, learn, lang: str = "lang", max_rows: int = MAX_ROWS) -> dict:
    """Fit on at most ``max_rows`` documents with a language; ``learn`` is a condition on doc_id."""
    known = docs.where(F.col(lang).isNotNull() & F.col("text").isNotNull() & learn)
    lowest = known.select("doc_id", lang, F.xxhash64("doc_id").alias("h"))
    cut = lowest.select("h").orderBy("h").limit(max_rows).agg(F.max("h").alias("cut")).first()["cut"]
    sample = known.where(F.xxhash64("doc_id") <= (cut if cut is not None else 0)).select("text", lang)

    def start():
        return lambda batch: [[x.tobytes() for x in np.concatenate([*_blocks(texts_of(batch, "text"))]).astype(np.float16)]]

    table = sample_features(sample, lang, [("x", T.BinaryType())], start, "text", max_rows)
    rows = np.frombuffer(b"".join(table["x"].to_pylist()), np.float16).reshape(-1, 1 << BITS).astype(np.float32)
    return fit(rows, table[lang].to_pylist())


def identify(df: DataFrame, model: dict, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Append lang_pred, score and ambiguous; the model is 2**BITS rows of codeword length and is broadcast."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def start():
        own = shared.value
        return lambda batch: list(predict(texts_of(batch, text), own))

    fields = [("lang_pred", T.StringType()), ("score", T.DoubleType()), ("ambiguous", T.BooleanType())]
    return annotate(df, fields, start, text, keep)


def predicted_languages(docs: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """doc_id, held_out, lang_pred, score and ambiguous; rows with remainder 2 are held out."""
    model = train(docs, id_remainder("doc_id", 4) != 2, max_rows=max_rows)
    done = identify(docs.select("doc_id", "text"), model, keep=["doc_id"])
    return done.select("doc_id", (id_remainder("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score", "ambiguous")

import base64
import gc
import hashlib
import random
import time

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import types as T
from hypothesis import given, settings
from hypothesis import strategies as st

from tidewater.llm import bpe, queries
from tidewater.llm.common import annotate, tidy

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(bpe.read_ranks(PATH), public_tokenizers.PATTERN)


def lists(codec, texts):
    ids, per = codec.encode(texts)
    at = np.r_[0, np.cumsum(per)]
    return [ids[a:b].tolist() for a, b in zip(at, at[1:], strict=False)]


def test_hard_texts(codec, reference):
    rng = random.Random(3)
    texts = ["", None, "a" * 3000, " " * 2000, "ab" * 1500 + " x", "\n" * 99 + "  b", "日本語テキスト" * 99, "<|endoftext|> hi", "é" * 999, "😀👍" * 99]
    texts += ["".join(rng.choice("etaoinshr") for _ in range(2500)), "".join(chr(rng.randrange(32, 0x2FFF)) for _ in range(2000))]
    assert lists(codec, texts) == [reference.encode_ordinary(t or "") for t in texts]
    ids, per = codec.encode(texts)
    data, sizes = codec.decode(ids, per)
    assert data.tobytes() == "".join(t or "" for t in texts).encode()
    assert sizes.tolist() == [len((t or "").encode()) for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=80), max_size=8))
def test_any_text(codec, reference, texts):
    assert lists(codec, texts) == [reference.encode_ordinary(t) for t in texts]


def test_very_long_piece(codec, reference):
    """A piece of a million bytes takes n log n time; a text of that size in pieces is compared as a whole."""
    rng = random.Random(9)
    piece = "".join(rng.choice("etaoinshr") for _ in range(1_000_000))
    began = time.time()
    ids, per = codec.encode([piece])
    assert time.time() - began < 30 and codec.decode(ids, per)[0].tobytes() == piece.encode()
    assert lists(codec, [piece[:30_000]]) == [reference.encode_ordinary(piece[:30_000])]
    codec.encode(["x"])
    assert codec.held < bpe.MEMO_BYTES


@pytest.mark.parametrize("limit", ["MEMO", "MEMO_BYTES"])
def test_memo_may_overflow(codec, reference, monkeypatch, limit):
    monkeypatch.setattr(bpe, limit, 5)
    texts = [f"word{i} and more{i}" for i in range(20)]
    for a in range(0, 20, 2):
        assert lists(codec, texts[a : a + 2]) == [reference.encode_ordinary(t) for t in texts[a : a + 2]]


def test_unknown_id_fails(codec):
    with pytest.raises(ValueError):
        codec.decode(np.array([10**6]), np.array([1]))


def test_query(spark, sf_dir, documents, reference):
    rows = {r["doc_id"]: r for r in queries.op1_bpe(spark, sf_dir).collect()}
    texts = documents.select("doc_id", "text").collect()
    assert len(rows) == len(texts)
    for i, text in texts:
        ids = reference.encode_ordinary(text or "")
        assert rows[i]["n_tokens"] == len(ids)
        assert rows[i]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert rows[i]["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()


def test_edges(spark, make_docs):
    ranks = bpe.share_ranks(spark, PATH)
    docs = make_docs([None, "", "same", "same"]).selectExpr("*", "'x' ids", "1 n_tokens")
    rows = bpe.round_trip_digests(docs, ranks, public_tokenizers.PATTERN).orderBy("doc_id").collect()
    assert [r["n_tokens"] for r in rows][:2] == [0, 0] and rows[2]["ids_sha256"] == rows[3]["ids_sha256"]
    assert bpe.round_trip_digests(docs.limit(0), ranks, public_tokenizers.PATTERN).count() == 0
    lists_ = bpe.encode(docs.drop("ids"), "text", ranks, public_tokenizers.PATTERN).select(bpe.unpack("ids").alias("i"), "n_tokens").collect()
    assert all(len(r["i"]) == r["n_tokens"] for r in lists_)


def test_decode_alone(spark, make_docs):
    ranks = bpe.share_ranks(spark, PATH)
    coded = bpe.encode(make_docs(["one two", None, "drei vier"]), "text", ranks, public_tokenizers.PATTERN)
    rows = bpe.decode(coded, "ids", ranks, public_tokenizers.PATTERN).collect()
    assert sorted(bytes(r["decoded"]).decode() for r in rows) == ["", "drei vier", "one two"]


def test_workers_let_go_of_the_codec(spark, make_docs):
    """Tasks of other operators do not run beside the vocabulary and memo of the one before."""

    def held():
        return sum(type(x) is bpe.Codec for x in gc.get_objects())

    def count(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([held()], pa.int64())], names=["doc_id"])

    docs = make_docs([f"some text {i}" for i in range(64)]).repartition(16).select("doc_id", "text").cache()
    for other in ("annotate", "tidy"):
        assert bpe.round_trip(docs, "text", bpe.share_ranks(spark, PATH), public_tokenizers.PATTERN).count() == 64
        if other == "annotate":
            seen = annotate(docs, [("held", T.LongType())], lambda: lambda batch: [[held()] * batch.num_rows], "text").agg({"held": "max"}).first()[0]
        else:
            seen = docs.select("doc_id").mapInArrow(tidy(count), "doc_id long").agg({"doc_id": "max"}).first()[0]
        assert seen == 0, other

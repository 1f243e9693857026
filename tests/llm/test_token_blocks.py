import struct
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidewater.llm import queries, token_blocks

PATH = public_tokenizers.path(queries.WORDS)


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def brute(docs, tokenizer, end=2):
    out, start = [], 0
    for i, t in docs:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [end]
        out.append((i, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    return out


def test_query(spark, sf_dir, documents, tokenizer):
    docs = [tuple(r) for r in documents.select("doc_id", "text").orderBy("doc_id").collect()]
    got = queries.op13_token_blocks(spark, sf_dir)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(tuple(r) for r in got.collect()) == sorted(brute(docs, tokenizer))


def test_edges(spark, make_docs, tokenizer):
    docs = [(None, "no id"), (-3, "minus"), (0, None), (1, ""), (2, " \n\t"), (3, "Don't 'tis <|endoftext|>x a<|startoftext|>"), (4, "word. word, (word) " * 3000), (2**40, "ÉÈ ß ΑΣ İ 12a3 á a\x1cb\x85c d")]
    df = make_docs(docs[::-1]).selectExpr("*", "'x' ids", "1 start", "2 mark").repartition(3)
    for file_ids in (1 << 26, 5):
        files = token_blocks.save_tokens(df, PATH, file_ids=file_ids)
        assert [tuple(r) for r in token_blocks.token_digests(files).orderBy("start").collect()] == brute(docs, tokenizer)
        back = {r["start"]: (r["doc_id"], np.frombuffer(r["ids"], "<u4").tolist()) for r in token_blocks.read_tokens(files).collect()}
        assert back[0] == (None, tokenizer.encode("no id").ids + [2]) and len(back) == len(docs)
    assert len(files.collect()) == 5
    twice = token_blocks.token_digests(token_blocks.save_tokens(make_docs([(5, "a b"), (5, "c"), (5, "a b")]), PATH)).collect()
    assert Counter(r["n_tokens"] for r in twice) == {3: 2, 2: 1} and sorted(r["start"] for r in twice) in ([0, 2, 5], [0, 3, 6])
    assert token_blocks.token_digests(token_blocks.save_tokens(df.limit(0), PATH)).count() == 0
    with pytest.raises(ValueError):
        token_blocks.save_tokens(df.selectExpr("text doc_id", "text"), PATH)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 40), st.integers(0, 2**32 - 1)), max_size=700), st.sampled_from([0.5, 0.9, 1.0]))
def test_blocks_round_trip(ids, share):
    data, size = token_blocks.pack(np.array(ids, np.int64), share)
    assert token_blocks.unpack(data, np.cumsum(size) - size)[: len(ids)].tolist() == ids


def test_outliers_are_exceptions():
    ids = np.arange(512) % 16 + 100
    ids[[3, 300]] = 4_000_000_000
    data, size = token_blocks.pack(ids)
    assert size.tolist() == [7 + 256 * 4 // 8 + 5] * 2
    assert token_blocks.pack(ids, share=1.0)[1].min() > 7 + 256 * 31 // 8


def test_any_stretch_is_read_by_its_blocks(tmp_path):
    ids = np.random.default_rng(0).integers(0, 49408, 70_000)
    writer = token_blocks.Writer(f"file://{tmp_path}/a/one.pfor")
    for a in range(0, 70_000, 7_000):
        writer.add(np.array([a]), np.array([False]), np.array([7_000]), ids[a : a + 7_000])
    writer.close()
    reader = token_blocks.Reader(f"{tmp_path}/a/one.pfor")
    for a, b in ((0, 1), (255, 257), (511, 60_000), (69_999, 70_000), (5, 5)):
        assert (reader.ids(a, b) == ids[a:b]).all()
    assert [k for k, *_ in reader.documents()] == [0]
    (tmp_path / "bad").write_bytes(b"short")
    with pytest.raises(ValueError):
        token_blocks.Reader(f"{tmp_path}/bad")


texts = st.text(st.one_of(st.sampled_from(list("aZé'Éß .,!?<|>\n\t09-_σΣ́×\x1c")), st.characters(codec="utf-8")), max_size=60)


@settings(max_examples=150, deadline=None)
@given(st.lists(texts, max_size=6))
def test_encoder_agrees_with_the_library(tokenizer, docs):
    ids, per = token_blocks.Encoder(PATH).encode([t.encode() for t in docs], None) if docs else (np.zeros(0), np.zeros(0))
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in docs]
    assert ids.tolist() == [i for w in want for i in w] and per.tolist() == [len(w) for w in want]


def test_new_chunks_are_one_text_and_stay_known(tokenizer):
    texts = ["Wörter, die-- (zählen) Éa!! éa ×x don't x^2 a_b. " * 3, "", "straße qqqqzzzz... Qqqqzzzz"]
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    encoder = token_blocks.worker_encoder(PATH)
    assert encoder is token_blocks.worker_encoder(PATH)
    assert encoder._joined([b"straight", b"zzq...", b"a"], [1, 2, 1]) and encoder._joined([b"straight", b"zzq...", b"a"], [1, 1, 1]) is None
    fresh = token_blocks.Encoder(PATH)
    fresh.ends[:] = False  # a vocabulary without tokens that end a piece
    for e in (encoder, encoder, fresh):
        ids, per = e.encode([t.encode() for t in texts], None)
        assert per.tolist() == [len(w) for w in want] and ids.tolist() == sum(want, [])

import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.llm import queries, resample
from tidewater.llm.common import Tables

WORD = set("0123456789abcdefghijklmnopqrstuvwxyz")


def brute_features(text):
    folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = "".join(c if c in WORD or ord(c) >= 128 else " " for c in folded).split(" ")
    words = [w for w in words if w]
    grams = [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(g.encode()) % 10000 for g in grams]


def brute(docs, target, percent=5, least=20):
    made = [brute_features(t) for _, t in docs]
    s, t = Counter(b for _, bs in made for b in bs), Counter(b for x in target for b in brute_features(x)[1])
    S, U = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (S + 10000) / ((s[b] + 1) * (U + 10000)))) for b in range(10000)]
    rows = []
    for (i, _), (n, bs) in zip(docs, made, strict=True):
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        w = sum(gain[b] for b in bs)
        rows.append([i, len(bs), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n])
    able = sorted((k for k, r in enumerate(rows) if r[4] >= least), key=lambda k: (-rows[k][3], rows[k][0] is None, rows[k][0] or 0, k))
    rank = {k: p + 1 for p, k in enumerate(able[: percent * len(able) // 100])}
    return Counter((*r[:4], rank.get(k)) for k, r in enumerate(rows))


def test_query(spark, sf_dir, documents):
    docs = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    target = [r["text"] for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    got = queries.op12_resample(spark, sf_dir)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"] and {t for _, t in got.dtypes} == {"bigint"}
    assert Counter(tuple(r) for r in got.collect()) == brute(docs, target)


def test_edges(make_docs):
    rng = np.random.default_rng(1)
    words = [f"w{k}" for k in range(50)] + ["é" * 40, "x" * 300, "ÀB9"]
    docs = [(i, " ".join(rng.choice(words, rng.integers(0, 60)))) for i in range(60)]
    docs += [(None, docs[3][1]), (None, None), (7, docs[7][1]), (7, docs[7][1]), (-5, "a-b\x00c " * 2000), (2**62, ""), (-(2**62), "one two three " * 9)]
    target = make_docs(["w1 w2 w3 w1 w2", None, ""])
    df = make_docs(docs).selectExpr("*", "1 score", "2 row", "3 rank")
    for percent in (5, 50, 100):
        assert Counter(tuple(r) for r in resample.importance_resample(df, target, percent).collect()) == brute(docs, ["w1 w2 w3 w1 w2", None, ""], percent)
    assert resample.importance_resample(df.limit(0), target).count() == 0
    none = resample.importance_resample(df.where("doc_id = 2"), target.limit(0)).collect()
    assert [r["rank"] for r in none] == [None]


def test_crc_of_joined_words():
    joined, rng = resample.JoinedCrc(), np.random.default_rng(2)
    for _ in range(200):
        a, b = rng.bytes(int(rng.integers(0, 50))), rng.bytes(int(rng.choice([0, 1, 5, 63, 64, 65, 1000, 70000])))
        made = joined.ahead(np.array([zlib.crc32(a)], np.uint32), np.array([len(b)])) ^ np.uint32(zlib.crc32(b))
        assert int(made[0]) == zlib.crc32(a + b)


@pytest.mark.parametrize("block", [4, 1 << 16])
def test_radix_sort(spark, monkeypatch, block):
    """Many blocks and digits, ties in all keys: places are those of a stable sort."""
    monkeypatch.setattr(resample, "BLOCK", block)
    rng = np.random.default_rng(3)
    rows = [(int(k) * 3, int(a), int(b)) for k, a, b in zip(range(400), rng.integers(-5, 5, 400), rng.choice([-(2**62), -1, 0, 1, 4096, 2**61], 400), strict=True)]
    df = spark.createDataFrame(rows, "row long, a long, b long").repartition(5)
    got = {r["row"]: (r["place"], r["a"], r["b"]) for r in resample.radix_places(df, ["a", "b"], "row", Tables(spark, "t")).collect()}
    want = sorted(rows, key=lambda r: (r[1], r[2], r[0]))
    assert got == {r[0]: (k, r[1], r[2]) for k, r in enumerate(want)}
    same = df.withColumn("a", F.lit(1)).where("row < 9")
    assert sorted(r["place"] for r in resample.radix_places(same, ["a"], "row", Tables(spark, "t")).collect()) == [0, 1, 2]

import hashlib
import random
import re

import numpy as np

from tidewater.llm import decontaminate, queries


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(docs, items, window=10):
    wins = {}
    for i, t in items:
        ws = words(t)
        m = min(window, len(ws))
        for j in range(len(ws) - m + 1) if m else ():
            wins.setdefault(tuple(ws[j : j + m]), set()).add(str(i))
    out = {}
    for i, t in docs:
        ws, hit, found = words(t), set(), set()
        for m in {len(w) for w in wins}:
            for p in range(len(ws) - m + 1):
                w = tuple(ws[p : p + m])
                if w in wins:
                    hit |= set(range(p, p + m))
                    found |= wins[w]
        out[i] = (len(ws), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit))
    return out


def result(df):
    return {r["doc_id"]: (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in df.collect()}


def test_random(spark, make_docs):
    rng = random.Random(5)
    vocab = ["a", "B", "cé", "42", "d"]
    say = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    items = [(1, say(25)), (2, say(12)), (10, "Solo!"), (3, "two words"), (4, None), (5, " - "), (6, say(10)), (7, say(3))]
    texts = [say(rng.randrange(0, 60)) for _ in range(80)] + [items[0][1] + " x " + items[1][1], "SOLO two, words", None, ""]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = make_docs(texts)
    want = brute(list(enumerate(texts)), items)
    assert result(decontaminate.contamination(docs, bench)) == want
    assert result(decontaminate.contamination(docs, bench, block_words=20)) == want


def test_longest_match(spark, make_docs):
    item = " ".join(f"w{i}" for i in range(30))
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    row = decontaminate.contamination(make_docs(["x y " + " ".join(f"w{i}" for i in range(4, 20)) + " z"]), bench).first()
    assert [tuple(m) for m in row["matches"]] == [("1", 2, 4, 16)] and row["n_hit"] == 16


def test_suffix_array():
    rng = random.Random(2)
    for _ in range(200):
        ids = np.array([rng.randrange(3) for _ in range(rng.randrange(40))], np.int64)
        assert decontaminate.suffix_array(ids, 10**6).tolist() == sorted(range(len(ids)), key=lambda i: ids[i:].tolist())


def test_block_of_many_words():
    """More than 2**21 different words in a block, and a text that has none of its windows."""
    many = [b"w%d" % k for k in range(2_200_000)]
    made = decontaminate.Suffixes([("a", 0, 10, many)])
    text = b" ".join(many[2_100_000:2_100_012]) + b" " + b" ".join(many[k] for k in range(0, 40_000, 2000))
    n, hit, matches = decontaminate.find_matches([text, b" ".join(many[5:14])], made)
    assert n.tolist() == [32, 9] and hit.sum() == 12 and matches.tolist() == [[0, 0, 0, 2_100_000, 12]]


def test_parts_of_a_long_item(spark, make_docs):
    item = " ".join(f"w{k}" for k in range(100))
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    docs = make_docs([" ".join(f"w{k}" for k in range(a, a + 12)) for a in range(0, 88, 5)])
    assert {r["n_hit"] for r in decontaminate.contamination(docs, bench, block_words=30).collect()} == {12}


def test_very_long_text(spark, make_docs):
    bench = spark.createDataFrame([(1, " ".join(f"w{k}" for k in range(20)))], "item_id long, text string")
    docs = make_docs(["z w1 " * 400_000 + " ".join(f"w{k}" for k in range(3, 15))])
    assert decontaminate.contamination(docs, bench).first()["n_hit"] == 12


def test_edges(spark, make_docs):
    bench = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    docs = make_docs([(1, "ONE, two three"), (1, "ONE, two three"), (None, "clean"), (2, None)]).selectExpr("*", "'m' matches", "5 n_hit")
    kept = decontaminate.decontaminate(docs, bench)
    assert kept.columns == docs.columns and sorted(str(r["doc_id"]) for r in kept.collect()) == ["2", "None"]
    assert kept.first()["n_hit"] == 5
    assert decontaminate.contamination(docs.limit(0), bench).count() == 0
    assert {r["n_hit"] for r in decontaminate.contamination(docs, bench.limit(0)).collect()} == {0}
    assert decontaminate.contamination(docs, bench.limit(0)).where("n_words > 0").count() == 3


def test_query(spark, sf_dir, documents):
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()
    assert result(queries.op8_decontamination(spark, sf_dir)) == brute(documents.select("doc_id", "text").collect(), items)

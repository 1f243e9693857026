import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.llm import components, exact_dedup, jaccard_join, line_dedup, queries

SPACE = " \t\n\x0b\x0c\r"


def fold(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def brute_lines(texts, min_docs):
    count = Counter(k for t in texts for k in {fold(x.strip(SPACE)) for x in (t or "").split("\n")} if k)
    out = []
    for t in texts:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not count[fold(x.strip(SPACE))] >= min_docs]
        out.append((len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def test_lines(make_docs):
    texts = [f"Common LINE \nown {i}\n\t common line\n\nÉcole" for i in range(4)] + ["École\ncommon line", "école", None, "", "common line"]
    rows = line_dedup.dedup_lines(make_docs(texts), min_docs=5).orderBy("doc_id").collect()
    assert [(r["n_lines"], r["n_dropped"], r["text"]) for r in rows] == brute_lines(texts, 5)


def test_lines_edges(make_docs):
    docs = make_docs([(1, "a\nb"), (1, "a\nb"), (None, "a\nc"), (None, None), (2, "x\n" * 5000 + "a")]).selectExpr("*", "'k' key", "7 n_dropped")
    rows = line_dedup.dedup_lines(docs, min_docs=4).collect()
    assert sorted(r["text"] for r in rows) == sorted(["b", "b", "c", "", "x\n" * 4999 + "x"])
    assert line_dedup.dedup_lines(docs.limit(0)).count() == 0
    kept = line_dedup.without_shared_lines(docs, min_docs=4)
    assert kept.columns == docs.columns and {(r["text"], r["n_chars"]) for r in kept.collect()} >= {("b", 1), ("", 0)}


def test_lines_query(spark, sf_dir, documents):
    texts = documents.select("doc_id", "text").orderBy("doc_id").collect()
    want = [(i, a, b, hashlib.sha256(t.encode()).hexdigest()) for (i, _), (a, b, t) in zip(texts, brute_lines([t for _, t in texts], 10), strict=True)]
    assert [tuple(r) for r in queries.op3_line_dedup(spark, sf_dir).orderBy("doc_id").collect()] == want


def brute_exact(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), i))
    return {i: (min(g)[1], len(g), hashlib.sha256(n.encode()).hexdigest()) for n, g in groups.items() for _, i in g}


@pytest.mark.parametrize("digest_bytes", [32, 1])
def test_exact(make_docs, digest_bytes):
    texts = [f"text {i % 40}" + " " * (i % 3) for i in range(200)] + [None, "", "  "]
    docs = make_docs(texts)
    want = brute_exact(list(enumerate(texts)))
    got = exact_dedup.exact_groups(docs, digest_bytes=digest_bytes, memtable_rows=16).collect()
    assert len(got) == len(texts)
    for r in got:
        assert (r["keep_id"], r["group_size"], r["text_sha256"]) == want[r["doc_id"]]
        assert r["kept"] == (r["doc_id"] == r["keep_id"])


def test_exact_edges(make_docs):
    docs = make_docs([(None, "a"), (5, "a"), (5, "a"), (7, "b"), (None, "c")]).selectExpr("*", "'x' digest", "'y' id")
    rows = exact_dedup.exact_groups(docs).collect()
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in rows) == Counter({(5, 5, 3, True): 2, (None, 5, 3, False): 1, (7, 7, 1, True): 1, (None, None, 1, True): 1})
    assert exact_dedup.exact_groups(docs.limit(0)).count() == 0


def test_index_takes_documents_in_turns(spark, make_docs):
    """Levels fill, are merged and stay sorted runs; all at once or in turns the entries are the same."""
    texts = [f"text {i % 37}" for i in range(150)]
    whole = exact_dedup.DigestIndex(spark)
    whole.add(exact_dedup.postings(make_docs(texts)))
    turns = exact_dedup.DigestIndex(spark, fanout=2, memtable_rows=8)
    for a in range(0, 150, 30):
        turns.add(exact_dedup.postings(make_docs(texts[a : a + 30], first=a)))
    assert len(turns.levels) > 2
    read = lambda index: sorted((bytes(r["digest"]), r["keep_points"], r["keep_id"], r["n"]) for r in index.entries().collect())
    assert read(turns) == read(whole) and len(read(whole)) == 37
    for part in turns.entries().select("digest").rdd.glom().collect():
        held = [bytes(r[0]) for r in part]
        assert held == sorted(held)


def test_exact_query(spark, sf_dir, documents):
    want = brute_exact(documents.select("doc_id", "text").collect())
    got = queries.op5_exact_dedup(spark, sf_dir).collect()
    assert {r["doc_id"]: (r["keep_id"], r["group_size"], r["text_sha256"]) for r in got} == want


def brute_similar(rows, words=5, percent=80):
    sets = {}
    for i, t in rows:
        ws = re.findall(r"[^\x20\x09-\x0D]+", fold(t or ""))
        sets[i] = {tuple(ws[k : k + words]) for k in range(max(1, len(ws) - words + 1))} if ws else set()
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {i: (len(sets[i]), find(i)) for i in sets}


def near_texts(n=60):
    base = [f"w{k}" for k in range(60)]
    out = []
    for i in range(n):
        words = base.copy()
        for k in range(i % 4):
            words[(7 * i + 20 * k) % 60] = f"edit{i}x{k}"
        out.append(" ".join(words))
    return out


def test_similar(make_docs):
    texts = near_texts() + ["a b c", "A b  c", "a b c d", None, "", " \n", "solo words that nobody else has at all"] + [f"p q r s t {i}" for i in range(5)]
    got = jaccard_join.similar_documents(make_docs(texts)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute_similar(list(enumerate(texts)))


def test_similar_without_many_hubs(make_docs, monkeypatch):
    """The exact second step alone must find what the hubs miss."""
    monkeypatch.setattr(jaccard_join, "CROWDED", 10**9)
    texts = near_texts(40)
    got = jaccard_join.similar_documents(make_docs(texts), hubs=1, late_hubs=1).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute_similar(list(enumerate(texts)))


def test_similar_edges(make_docs):
    docs = make_docs([(None, "x y z"), (3, "x y z"), (3, "x y z"), (4, None)]).selectExpr("*", "'q' id", "1 n")
    rows = jaccard_join.similar_documents(docs).collect()
    assert Counter((r["doc_id"], r["component_id"]) for r in rows) == Counter({(3, 3): 2, (None, 3): 1, (4, 4): 1})
    assert jaccard_join.similar_documents(docs.limit(0)).count() == 0
    kept = jaccard_join.keep_one(docs)
    assert sorted(r["doc_id"] for r in kept.collect()) == [3, 4] and kept.columns == docs.columns


def test_similar_ids_of_any_type(spark, make_docs):
    """Ids beyond 2**62 and ids that are texts; a null id that links and one that does not."""
    text = lambda k: " ".join(f"w{k}x{j}" for j in range(30))
    big = 2**62 + 1
    docs = make_docs([(big, text(1)), (big + 5, text(1) + " end"), (None, text(1)), (None, text(2)), (7, text(3))])
    got = Counter((r["doc_id"], r["component_id"]) for r in jaccard_join.similar_documents(docs).collect())
    assert got == Counter([(big, big), (big + 5, big), (None, big), (None, None), (7, 7)])
    kept = Counter((r["doc_id"], r["text"]) for r in jaccard_join.keep_one(docs).collect())
    assert kept == Counter([(big, text(1)), (None, text(2)), (7, text(3))])
    named = docs.selectExpr("concat('d', doc_id) doc_id", "text")
    assert {(r["doc_id"], r["component_id"]) for r in jaccard_join.similar_documents(named).collect()} == {(f"d{big}", f"d{big}"), (f"d{big + 5}", f"d{big}"), (None, f"d{big}"), (None, None), ("d7", "d7")}


def test_groups_of_one_prefix(make_docs, monkeypatch):
    """Different sets of one prefix and size are a group; its pairs expand to classes and lose no link."""
    plain = jaccard_join.prefixes

    def same_mark(*args, **options):
        return plain(*args, **options).withColumn("mark", F.lit("m").cast("binary"))

    monkeypatch.setattr(jaccard_join, "prefixes", same_mark)
    monkeypatch.setattr(jaccard_join, "prefix_length", lambda n, percent: n)
    texts = near_texts(30) + [f"p q r s t u v w {i}" for i in range(6)]
    got = jaccard_join.similar_documents(make_docs(texts)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute_similar(list(enumerate(texts)))


def test_bitmap_bound():
    """The bound is never below the intersection, whatever the sizes, and folds wider maps."""
    rng = np.random.default_rng(1)
    for _ in range(300):
        pool = rng.integers(0, 2**63, 400).astype(np.uint64)
        a, b = (np.unique(rng.choice(pool, rng.integers(1, 400))) for _ in range(2))
        both = len(np.intersect1d(a, b))
        top = jaccard_join.most_common(len(a), jaccard_join.parity_bits(a), len(b), jaccard_join.parity_bits(b))
        assert both <= top <= min(len(a), len(b))
    assert jaccard_join.most_common(len(a), jaccard_join.parity_bits(a), len(a), jaccard_join.parity_bits(a)) == len(a)


def test_very_long_texts_link(make_docs):
    words = [f"w{k % 977}x{k}" for k in range(120_000)]
    texts = [" ".join(words), " ".join(words[:-3000]), "x" * 600_000, "x" * 600_000 + "y", " ".join(words[:60_000])]
    got = jaccard_join.similar_documents(make_docs(texts)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == {0: (119_996, 0), 1: (116_996, 0), 2: (1, 2), 3: (1, 3), 4: (59_996, 4)}


def test_similar_query(spark, sf_dir, documents):
    want = brute_similar(documents.select("doc_id", "text").collect())
    got = queries.op9_jaccard_join(spark, sf_dir).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want


def test_components(spark):
    links = [(i, i + 1) for i in range(30)] + [(100, 50), (50, 70), (9, 9), (50, 100)]
    got = components.connected_components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r["node"]: r["component"] for r in got} == {i: 0 for i in range(31)} | {50: 50, 70: 50, 100: 50}
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_keep_one_without_unique_ids(make_docs):
    """Null ids and repeated ids: only copies go, one row of each stays."""
    text = lambda k: " ".join(f"w{k}x{j}" for j in range(40))
    rows = [(1, text(1)), (None, text(1)), (None, text(2)), (None, text(3)), (None, text(3)), (5, text(5)), (5, text(6)), (7, text(6)), (None, ""), (None, None), (8, "")]
    got = Counter((r["doc_id"], r["text"]) for r in jaccard_join.keep_one(make_docs(rows)).collect())
    assert got == Counter([(1, text(1)), (None, text(2)), (None, text(3)), (5, text(5)), (5, text(6)), (None, ""), (None, None), (8, "")])


def test_components_of_further_links(spark):
    rng = random.Random(3)
    first = [(rng.randrange(60), rng.randrange(60)) for _ in range(30)]
    more = [(rng.randrange(100), rng.randrange(100)) for _ in range(30)] + [(200 + i, 201 + i) for i in range(9)]
    link = lambda rows: spark.createDataFrame(rows, "a long, b long")
    whole = components.connected_components(link(first + more)).collect()
    got = components.joined_components(components.connected_components(link(first)), link(more)).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, whole))
    assert sorted(map(tuple, components.joined_components(components.connected_components(link([])), link(more)).collect())) == sorted(map(tuple, components.connected_components(link(more)).collect()))

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tidewater.llm import queries, spelling

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_words(docs, every=199):
    count = Counter()
    for i, t in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            count[run] += 1
    return {w: n for w, n in count.items() if len(w) >= 6 and n >= 5}


def brute_pairs(words):
    """Words by what is left without one letter: replaced letters share it at one place, longer words leave the shorter one."""
    words, spots, out = set(words), defaultdict(list), set()
    for w in words:
        for i in range(len(w)):
            spots[i, w[:i] + w[i + 1 :]].append(w)
            if (v := w[:i] + w[i + 1 :]) in words:
                out.add((min(v, w), max(v, w)))
    return out | {(a, b) for own in spots.values() for a in own for b in own if a < b and len(a) == len(b)}


def brute(docs, every=199):
    n = brute_words(docs, every)
    near = defaultdict(list)
    for a, b in brute_pairs(n):
        near[a].append(b)
        near[b].append(a)
    best = {w: min(vs, key=lambda v: (-n[v], v)) for w, vs in near.items()}
    form = {w: v for w, v in best.items() if n[v] >= 5 * n[w]}

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {(w, form.get(w), root(w), k, len(near[w]), n[form[w]] if w in form else None) for w, k in n.items()}


def test_query(spark, sf_dir, documents):
    docs = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    got = queries.op11_spelling(spark, sf_dir)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == brute(docs)


def some_words(rng, letters, sizes, count):
    words = {"".join(rng.choice(list(letters), int(rng.choice(sizes)))) for _ in range(count)}
    for w in list(words)[: count // 2]:
        k = int(rng.integers(0, len(w)))
        words |= {w[:k] + w[k + 1 :], w[:k] + str(rng.choice(list(letters))) + w[k:], w[:k] + str(rng.choice(list(letters))) + w[k + 1 :]}
    return sorted(w for w in words if len(w) >= 6)


@pytest.mark.parametrize(("letters", "sizes", "rare", "most"), [("ab", range(6, 10), 3, 4096), ("abcdeé", range(6, 16), 0, 4096), ("abc", range(6, 12), 30, 3), ("ab", [6, 7, 8, 40, 64, 65, 66, 200], 5, 40)])
def test_near_pairs(spark, monkeypatch, letters, sizes, rare, most):
    """Few letters, so that grams repeat and are extended; short bounds, so that lists are crowded."""
    monkeypatch.setattr(spelling, "RARE", rare)
    words = some_words(np.random.default_rng(len(letters) + rare), letters, list(sizes), 600)
    df = spark.createDataFrame([(w.encode("latin-1"), k) for k, w in enumerate(words)], "word binary, n long").repartition(3)
    rows = spelling.near_pairs(df, most=most).collect()
    got = [(bytes(r["a"]).decode("latin-1"), bytes(r["b"]).decode("latin-1")) for r in rows]
    assert len(got) == len(set(got)) and set(got) == brute_pairs(words)
    place = {w: k for k, w in enumerate(words)}
    assert all((place[a], place[b]) == (r["a_n"], r["b_n"]) for (a, b), r in zip(got, rows, strict=True))


@pytest.mark.parametrize("rare", [0, 2, 10])
def test_bound_covers_every_edit(rare):
    """What an edit leaves of a decomposition is never less than the word's bound says."""
    rng = np.random.default_rng(rare)
    words = [w.encode("latin-1") for w in some_words(rng, "abcd", list(range(6, 14)), 300)]
    count = Counter(w[p : p + q] for w in words for q in range(2, 6) for p in range(len(w) - q + 1))
    often = sorted((sum(c << 8 * k for k, c in enumerate(g)) | len(g) << 56, n) for g, n in count.items() if n > rare)
    made = spelling.Decomposer(*(np.array(x, np.int64) for x in zip(*often, strict=True)))

    def grams(w, longest):
        code, _, _, stays = made.grams_of(np.frombuffer(w, np.uint8)[None], longest)
        return {(p, int(code[0, p])) for p in np.flatnonzero(stays[0])}

    for w in words[:120]:
        letters = np.frombuffer(w, np.uint8)[None]
        for longest, insert in ((min(6, len(w) // 2), True), (min(6, len(w) // 2), False), (max(3, min(6, (len(w) - 1) // 2)), False)):
            _, length, n, stays = made.grams_of(letters, longest)
            bound = int(made.affected(length, n, stays, len(w), longest, insert)[0])
            own = grams(w, longest)
            assert bound < len(own) or len(w) == 6
            for i in range(len(w) + insert):
                for c in b"abcd":
                    other = w[:i] + bytes([c]) + w[i + (not insert) :]
                    shared = sum((p, g) in (o := grams(other, longest)) or insert and (p + 1, g) in o for p, g in own)
                    assert shared >= len(own) - bound


def test_edges(make_docs):
    rng = np.random.default_rng(5)
    words = some_words(rng, "abÿÀ×", [6, 7, 8], 60) + ["x" * 500, "x" * 501]
    docs = [(i, " ".join(rng.choice(words, 200))) for i in range(12)] + [(None, "Word_WORDS 'wordssĀwordss " * 5), (None, None), (3, ""), (3, ""), (7, "abcdef " * 5000), (8, "z" * 70_000)]
    docs += [(9, " ".join(["x" * 500] * 40 + ["x" * 501] * 6)), (10, "€ãabcdefgƀhijklmn " * 6)]
    df = make_docs(docs).selectExpr("*", "'w' word", "1 n", "2 id")
    for every in (199, 3):
        assert {tuple(r) for r in spelling.spelling_groups(df, every=every).collect()} == brute(docs, every)
    assert spelling.spelling_groups(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        spelling.near_pairs(df.selectExpr("cast(text as binary) word", "n"), min_chars=3)


def test_chain_of_forms(make_docs):
    chain = ["aaaaaaaa"[:k] + "bbbbbbbb"[k:] for k in range(6)]
    docs = [(1, " ".join(w for k, w in enumerate(chain) for _ in range(5**(k + 1))))]
    rows = {r["word"]: r for r in spelling.spelling_groups(make_docs(docs), every=10**9 + 7).collect()}
    assert {r["root"] for r in rows.values()} == {chain[-1]} and [rows[w]["form"] for w in chain] == [*chain[1:], None]

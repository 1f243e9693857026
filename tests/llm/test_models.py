import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from tidewater.llm import language, quality, queries, toxicity
from tidewater.llm.learn import sigmoid

LABELS = "doc_id long, quality int, toxic int"


def held(i, n, r):
    return zlib.crc32(("" if i is None else str(i)).encode()) % n == r


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    rows = queries.op4_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    test = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == held(r["doc_id"], 5, 0) for r in rows)
    assert np.mean([r["predicted"] == r["toxic"] for r in test]) > 0.96
    assert np.mean([r["predicted"] for r in test if r["toxic"]]) > 0.8
    assert np.mean([r["predicted"] for r in test if not r["toxic"]]) < 0.01


def test_quality_held_out(spark):
    sf = "/root/testdata/sf0.1"
    rows = [r for r in queries.op6_quality(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect() if r["held_out"]]
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) > 0.97


def test_language_held_out(spark, sf_dir, documents):
    rows = queries.op10_language(spark, sf_dir).join(documents.select("doc_id", "lang"), "doc_id").collect()
    assert all(r["held_out"] == held(r["doc_id"], 4, 2) for r in rows)
    assert np.mean([r["lang_pred"] == r["lang"] for r in rows if r["held_out"]]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


@pytest.mark.parametrize("run", [toxicity.toxic_scores, quality.quality_scores])
def test_label_models_edges(spark, make_docs, run):
    docs = make_docs([(1, None), (2, ""), (2, ""), (None, "x" * 100_000), (3, "so bad"), (4, "fine é 😀\n\n")]).selectExpr("*", "'z' score", "1 held_out")
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(3, 9)] + [(1, None, None), (None, 1, 1)], LABELS)
    rows = run(docs, labels).collect()
    assert len(rows) == 6 and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] in (1, 2)}) == 1 or run is quality.quality_scores
    assert run(docs.limit(0), labels).count() == 0
    none = run(docs, labels.limit(0)).collect()
    assert {r["score"] for r in none} == {0.5}


def test_machine_identity():
    rng = np.random.default_rng(0)
    row, index, value = np.array([0, 0, 0, 1, 1]), np.array([0, 1, 2, 1, 3]), rng.random(5)
    model = {"w": rng.random(4), "v": rng.random((4, 3)), "bias": 0.1}
    got = quality.machine_scores(row, index, value, 2, model)
    for r in (0, 1):
        x = np.zeros(4)
        x[index[row == r]] = value[row == r]
        pairs = sum(model["v"][i] @ model["v"][j] * x[i] * x[j] for i in range(4) for j in range(i + 1, 4))
        assert np.isclose(got[r], 0.1 + model["w"] @ x + pairs)


def test_gram_features_do_not_depend_on_neighbours():
    texts = ["Abc abc", None, "", "xyz", "abc" * 50]
    row, index = toxicity.ngram_features(texts)
    for k, t in enumerate(texts):
        assert sorted(index[row == k]) == sorted(toxicity.ngram_features([t])[1])
    assert np.allclose(language.features(texts)[3], language.features(["xyz"])[0])


def test_language_edges(make_docs):
    docs = make_docs([(i, "der die das und nicht" if i % 2 else "the and that of with") for i in range(40)] + [(100, None), (101, ""), (102, "123 !!"), (None, "the of"), (103, "é" * 50_000)])
    docs = docs.selectExpr("doc_id", "text", "case when doc_id % 2 = 1 then 'de' else 'en' end lang", "'x' lang_pred")
    rows = {r["doc_id"]: r for r in language.predicted_languages(docs).collect()}
    assert len(rows) == 45 and rows[1]["lang_pred"] == "de" and rows[2]["lang_pred"] == "en"
    assert all(rows[i]["lang_pred"] == "und" and rows[i]["score"] == 0 for i in (100, 101, 102))
    assert language.predicted_languages(docs.limit(0)).count() == 0
    one = language.predicted_languages(docs.where("lang = 'en'")).where("doc_id = 2").first()
    assert one["lang_pred"] == "en" and one["score"] == 1
    assert {r["lang_pred"] for r in language.predicted_languages(docs.selectExpr("doc_id", "text", "cast(null as string) lang")).collect()} == {"und"}


@pytest.mark.parametrize("n", [2, 3, 4, 5, 9, 20])
def test_codewords_differ(n):
    code = language.codewords(n)
    assert min((code[a] != code[b]).sum() for a in range(n) for b in range(a)) >= (1 if n == 2 else 2)


def test_sigmoid_is_safe():
    assert sigmoid(np.array([-1e9, 1e9])).tolist() == [sigmoid(np.array([-40.0]))[0], sigmoid(np.array([40.0]))[0]]


def test_pipeline(spark, sf_dir, documents):
    from tests.llm.test_dedup import brute_lines, brute_similar
    from tests.llm.test_decontaminate import brute

    docs = documents
    for k, (_name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf_dir)
        rows = out.collect()
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        ids = sorted(before)
        if k < 4:
            assert out.columns == documents.columns
            after = {r["doc_id"]: r["text"] for r in rows}
        if k == 0:
            labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
            assert np.mean([labels[i] == (i in after) for i in ids if i in labels]) > 0.9
        if k == 1:
            assert [after[i] for i in ids] == [t for _, _, t in brute_lines([before[i] for i in ids], 10)]
        if k == 2:
            assert set(after) == {c for _, c in brute_similar(list(before.items())).values()}
        if k == 3:
            items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()
            assert set(after) == {i for i, r in brute(list(before.items()), items).items() if not r[4]}
        if k == 4:
            assert {r["doc_id"] for r in rows} == set(before) and all(r["round_trip"] for r in rows)
        else:
            docs = spark.createDataFrame(rows, out.schema)
    assert corpus_pipeline.run(spark, sf_dir).count() == len(rows)


# --- the same by plain loops ---------------------------------------------------

U32 = 2**32 - 1


def plain_grams(text):
    """Feature (level, hash) of a text by one character at a time."""
    codes = [ord(c) for c in (text or "").lower()]
    odd = [0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F, 0x165667B1]
    count = Counter()
    for p in range(len(codes)):
        mixed = codes[p] * odd[0] & U32
        for k in range(1, 5):
            if p + k >= len(codes):
                break
            mixed = (mixed * 31 + codes[p + k] * odd[k]) & U32
            if k >= 2:
                count[((mixed ^ mixed >> 15) * 0x2C1B3C6D + k & U32) >> (32 - toxicity.BITS)] += 1
    return {h + (level << toxicity.BITS) for h, n in count.items() for level in range(toxicity.LEVELS) if n > level}


def plain_logistic(rows, y, start, l2, rounds, rate):
    """Full-batch Adam steps over rows of {feature: value}."""
    weight, bias = dict.fromkeys(start, 0.3), math.log((sum(y) + 0.5) / (len(y) - sum(y) + 0.5))
    m, v = Counter(), Counter()
    for t in range(1, rounds + 1):
        gap = [1 / (1 + math.exp(-(sum(weight[f] * x for f, x in r.items()) + bias))) - label for r, label in zip(rows, y, strict=True)]
        grad = {f: l2 * w for f, w in weight.items()}
        for g, r in zip(gap, rows, strict=True):
            for f, x in r.items():
                grad[f] += g * x / len(y)
        grad["bias"] = sum(gap) / len(y)
        for f, g in grad.items():
            m[f] += 0.1 * (g - m[f])
            v[f] += 0.001 * (g * g - v[f])
            step = rate * (m[f] / (1 - 0.9**t)) / (math.sqrt(v[f] / (1 - 0.999**t)) + 1e-8)
            if f == "bias":
                bias -= step
            else:
                weight[f] -= step
    return weight, bias


def test_toxicity_by_plain_loops(spark, make_docs):
    rng = random.Random(3)
    say = lambda words, n: " ".join(rng.choice(words) for _ in range(n))
    texts = [say(["good", "day", "to", "you", "all"], 6) + (" you " + say(["vile", "rotten", "wretch"], 4) if i % 3 == 0 else "") for i in range(90)] + ["", None]
    docs = make_docs(texts)
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(90)], "doc_id long, quality int, toxic int")
    learned = [i for i in range(90) if zlib.crc32(str(i).encode()) % 5]
    y = [int(i % 3 == 0) for i in learned]
    grams = {i: plain_grams(t) for i, t in enumerate(texts)}
    base, ratio = sum(y) / len(y), {}
    for f in set().union(*(grams[i] for i in learned)):
        n = sum(f in grams[i] for i in learned)
        pos = sum(f in grams[i] for i, label in zip(learned, y, strict=True) if label)
        if n >= toxicity.LEAST_DOCS and abs((pos - n * base) / math.sqrt(n * base * (1 - base))) >= toxicity.LEAST_Z:
            ratio[f] = math.log((pos + 1) / (sum(y) + 2)) - math.log((n - pos + 1) / (len(y) - sum(y) + 2))
    assert len(ratio) > 20
    weight, bias = plain_logistic([{f: ratio[f] for f in grams[i] if f in ratio} for i in learned], y, ratio, 1e-4, 100, 0.02)
    for r in toxicity.toxic_scores(docs, labels).collect():
        want = 1 / (1 + math.exp(-(sum(ratio[f] * weight[f] for f in grams[r["doc_id"]] if f in ratio) + bias)))
        assert abs(r["score"] - want) < 1e-4 and r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)


def plain_stats(text, told):
    """The statistics of a text, each from its definition."""
    text = text or ""
    raw, words = text.encode(), text.encode().split()
    low = [w.lower() for w in words]
    total = max(1, len(words))
    ink = [b for b in raw if b not in b" \t\n\x0b\x0c\r"]
    inked = max(1, len(ink))
    share = lambda ok, of: sum(map(ok, ink)) / of
    letter = lambda b: 97 <= b < 123 or b >= 128
    upper, digit, stop = (lambda b: 65 <= b < 91), (lambda b: 48 <= b < 58), (lambda b: b in b",.")
    symbol = lambda b: not (letter(b) or upper(b) or digit(b) or stop(b))
    last = [w.rstrip(b".,")[-1:] for w in words]
    lines = raw.split(b"\n")
    return [
        math.log1p(len(raw)), math.log1p(len(words)), inked / total, share(upper, inked), share(digit, inked), share(symbol, inked), share(stop, total),
        len(set(low)) / total, sum(a == b for a, b in zip(low, low[1:], strict=False)) / total, sum(a == b for a, b in zip(low, low[2:], strict=False)) / total, max(Counter(low).values(), default=0) / total,
        math.log1p(len(lines)), total / len(lines), 1 - len(set(lines)) / len(lines), sum(bool(x) and x[0] < 128 and not x.isalnum() for x in last) / total, sum(w.isupper() for w in words) / total,
        abs((len(text) if told is None else told) - len(text)) / (1 + len(text)),
    ]


def test_quality_statistics_by_plain_loops():
    texts = ["One two, TWO three.\nOne two, TWO three.\n\n5% café!", "", None, "x " * 50, "a\nb\na", "ÀÉ 日本 3.5, $$ ok?"]
    told = [None, 7, 0, 100, 5, 3]
    *_, stats = quality.Extractor()([(t or "").encode() for t in texts], told)
    for row, t, c in zip(stats, texts, told, strict=True):
        assert np.allclose(row, plain_stats(t, c), atol=1e-12), t


def test_machine_fit_by_plain_loops():
    """Three steps from the definition: every pair of features interacts."""
    texts = [f"good calm text number {i} here" if i % 2 else f"BUY {i} !!! NOW {i * i} BUY" for i in range(10)]
    y = np.array([i % 2 for i in range(10)], float)
    row, bucket, value, stats = quality.Extractor()([t.encode() for t in texts], [None] * 10)
    made = quality.fit(row, bucket, value, stats, y, rounds=3)
    r, index, x = quality.machine_inputs(row, bucket, value, stats, made)
    docs = [[(int(i), float(v)) for d, i, v in zip(r, index, x, strict=True) if d == k] for k in range(10)]
    dim, rank = len(made["w"]), quality.RANK
    w, b, v = np.zeros(dim), float(np.log(5.5 / 5.5)), np.random.default_rng(7).normal(0, 0.02, (dim, rank))
    state = {k: [0.0, 0.0] for k in ("w", "v", "b")}

    def step(name, grad, t):
        state[name][0] = state[name][0] + 0.1 * (grad - state[name][0])
        state[name][1] = state[name][1] + 0.001 * (grad * grad - state[name][1])
        return 0.03 * (state[name][0] / (1 - 0.9**t)) / (np.sqrt(state[name][1] / (1 - 0.999**t)) + 1e-8)

    def raw(doc):
        return b + sum(w[i] * s for i, s in doc) + sum(float(v[i] @ v[j]) * s * u for k, (i, s) in enumerate(doc) for j, u in doc[k + 1 :])

    for t in range(1, 4):
        gap = [(1 / (1 + math.exp(-raw(d))) - label) / 10 for d, label in zip(docs, y, strict=True)]
        gw, gv = 1e-4 * w, 1e-4 * v
        for g, d in zip(gap, docs, strict=True):
            for k, (i, s) in enumerate(d):
                gw[i] += g * s
                for m, (j, u) in enumerate(d):
                    if m != k:
                        gv[i] += g * s * u * v[j]
        w, v, b = w - step("w", gw, t), v - step("v", gv, t), b - float(step("b", np.array([sum(gap)]), t)[0])
    assert np.allclose(made["w"], w, atol=1e-9) and np.allclose(made["v"], v, atol=1e-9) and abs(made["bias"] - b) < 1e-9
    got = quality.machine_scores(r, index, x, 10, made)
    assert np.allclose(got, [raw(d) for d in docs], atol=1e-9)


def test_quality_takes_counts_of_any_type(spark, sf_dir, documents):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    want = sorted((r["doc_id"], r["score"]) for r in quality.quality_scores(documents, labels, max_rows=60).collect())
    for kind in ("decimal(20,2)", "double", "int"):
        assert sorted((r["doc_id"], r["score"]) for r in quality.quality_scores(documents.withColumn("n_chars", documents["n_chars"].cast(kind)), labels, max_rows=60).collect()) == want


def plain_language_features(text):
    codes = [0, 0, 0, *(ord(c) for c in (text or "").lower())]
    odd = [0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D]
    out = [0.0] * (1 << language.BITS)
    for p in range(3, len(codes)):
        mixed = 0
        for k in range(3):
            mixed = (mixed + codes[p - k] * odd[k]) & U32
            h = ((mixed ^ mixed >> 15) * 0x2C1B3C6D + k * 0x3779) & U32
            out[(h * 0x297A2D39 & U32) >> (32 - language.BITS)] += 1
    out = [math.sqrt(x) for x in out]
    norm = math.sqrt(sum(x * x for x in out)) or 1
    return np.array([x / norm for x in out])


def test_language_by_plain_loops():
    texts = ["the cat and the dog", "der hund und die katze", "le chat et le chien", "el gato y el perro", "the end of it", "das ende von allem", "", None, "12 34"]
    langs = ["en", "de", "fr", "es", "en", "de"]
    feats = [plain_language_features(t) for t in texts]
    assert np.allclose(language.features(texts), feats, atol=1e-5)
    made = language.fit(np.array(feats[:6], np.float32), langs, rounds=4)
    names, code = sorted(set(langs)), language.codewords(4)
    assert made["names"] == names and len({tuple(c) for c in code.tolist()}) == 4
    margins = []
    for bit in range(code.shape[1]):  # each bit is a classifier of its own
        y = [int(code[names.index(x)][bit] > 0) for x in langs]
        w, b, m, v, mb, vb = np.zeros(len(feats[0])), 0.0, 0.0, 0.0, 0.0, 0.0
        for t in range(1, 5):
            gap = [1 / (1 + math.exp(-(w @ x + b))) - label for x, label in zip(feats, y, strict=False)]
            g, gb = sum(d * x for d, x in zip(gap, feats, strict=False)) / 6 + 1e-5 * w, sum(gap) / 6
            m, v, mb, vb = m + 0.1 * (g - m), v + 0.001 * (g * g - v), mb + 0.1 * (gb - mb), vb + 0.001 * (gb * gb - vb)
            w = w - 0.3 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
            b -= 0.3 * (mb / (1 - 0.9**t)) / (math.sqrt(vb / (1 - 0.999**t)) + 1e-8)
        right = sum((w @ x + b > 0) == bool(label) for x, label in zip(feats, y, strict=False)) / 6
        margins.append(([float(w @ x + b) for x in feats], max(0.01, 2 * right - 1)))
    mean = sum(trust for _, trust in margins) / len(margins)
    got = language.predict(texts, made)
    for k, text in enumerate(texts):
        loss = [sum(math.log1p(math.exp(-z[k] * c)) * trust / mean for (z, trust), c in zip(margins, word, strict=True)) for word in code.tolist()]
        order = sorted(range(4), key=lambda i: loss[i])
        lettered = any(c.isalpha() for c in text or "")
        assert got[0][k] == (names[order[0]] if lettered else "und")
        assert abs(got[1][k] - (1 / sum(math.exp(loss[order[0]] - x) for x in loss) if lettered else 0)) < 1e-3
        assert bool(got[2][k]) == (lettered and (loss[order[1]] - loss[order[0]]) / code.shape[1] < language.GAP)


# --- the stages of the pipeline on rows of every kind ---------------------------

def odd_rows(spark):
    """Null ids and texts, empty and repeated rows, a very long text, extra columns of names that operators use."""
    text = "Calm words about the sea and the land, told once more in the evening."
    rows = [(1, text), (1, text), (None, text + " Again."), (2, None), (3, ""), (None, None), (4, " \n "), (5, "word " * 60_000), (6, "\n".join(f"line {k} of its own" for k in range(40)))]
    docs = spark.createDataFrame([(i, t, None, "s", None if t is None else len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    return docs.selectExpr("*", "'k' key", "1 n_tokens", "2.5 score", "'d' digest", "array(1) ids", "'q' quality")


@pytest.mark.parametrize("k", range(5))
def test_stage_edges(spark, sf_dir, k):
    name, stage = corpus_pipeline.STAGES[k]
    docs = odd_rows(spark)
    done = stage(spark, docs, sf_dir)
    rows = done.collect()
    if k < 4:
        assert done.columns == docs.columns and len(rows) <= 9
    if name == "line_dedup":
        assert len(rows) == 9 and {r["n_chars"] for r in rows} == {len(r["text"]) for r in rows}
    if name == "near_duplicates":
        assert sorted(str(r["doc_id"]) for r in rows) == ["1", "2", "3", "4", "5", "6", "None"]
    if name == "decontaminate":
        assert len(rows) == 9
    if name == "tokens":
        assert len(rows) == 9 and all(r["round_trip"] for r in rows)
    assert stage(spark, docs.limit(0), sf_dir).count() == 0

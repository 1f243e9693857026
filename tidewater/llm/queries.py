"""The thin queries over the corpus tables, and their SQL where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import bpe, decontaminate, exact_dedup, html_text, jaccard_join, language, line_dedup, quality, resample, secrets, spelling, token_blocks, toxicity

RANKS = "byte_bpe_50k.tiktoken"
WORDS = "word_bpe_49k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.share_ranks(spark, public_tokenizers.path(RANKS))
    return bpe.round_trip_digests(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.page_texts(table(spark, sf_dir, "pages"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs, min_docs=10, min_chars=1).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxic_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.5)


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.3)


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_digests(table(spark, sf_dir, "documents"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar_documents(table(spark, sf_dir, "documents"))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.predicted_languages(table(spark, sf_dir, "documents"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_groups(table(spark, sf_dir, "documents"))


def op12_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.importance_resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_blocks.token_digests(token_blocks.save_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(WORDS), end=2))


QUERIES = {
    "op1_bpe": op1_bpe,
    "op2_html_text": op2_html_text,
    "op3_line_dedup": op3_line_dedup,
    "op4_toxicity": op4_toxicity,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_quality": op6_quality,
    "op7_secrets": op7_secrets,
    "op8_decontamination": op8_decontamination,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_language": op10_language,
    "op11_spelling": op11_spelling,
    "op12_resample": op12_resample,
    "op13_token_blocks": op13_token_blocks,
}

_FOLD = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

ORACLE = {
    "op3_line_dedup": f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
l AS (SELECT rid, doc_id, unnest(parts) AS line, unnest(range(1, len(parts) + 1)) AS pos FROM d),
k AS (SELECT *, {_FOLD.format(f"trim(line, {_SPACE})")} AS key FROM l),
f AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT rid) >= 10),
m AS (SELECT k.*, f.key IS NOT NULL AS gone FROM k LEFT JOIN f ON k.key = f.key)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY rid""",
    "op5_exact_dedup": r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS points, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents),
g AS (SELECT *, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size
      FROM d WINDOW w AS (PARTITION BY norm ORDER BY points DESC, doc_id))
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM g""",
    "op8_decontamination": rf"""
WITH iw AS (SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all({_FOLD.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
win AS (SELECT item_id, least(len(ws), 10) AS m, array_to_string(ws[j : j + least(len(ws), 10) - 1], ' ') AS key
        FROM (SELECT item_id, ws, unnest(range(1, len(ws) - least(len(ws), 10) + 2)) AS j FROM iw WHERE len(ws) > 0)),
dw AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({_FOLD.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
dwin AS (SELECT rid, m, p, array_to_string(ws[p : p + m - 1], ' ') AS key
         FROM (SELECT rid, ws, m, unnest(range(1, len(ws) - m + 2)) AS p FROM dw, (SELECT DISTINCT m FROM win) WHERE len(ws) >= m)),
hit AS (SELECT rid, p, d.m, item_id FROM dwin d JOIN (SELECT DISTINCT * FROM win) w ON d.m = w.m AND d.key = w.key),
cover AS (SELECT rid, count(DISTINCT q) AS n_hit FROM (SELECT rid, unnest(range(p, p + m)) AS q FROM hit) GROUP BY rid),
items AS (SELECT rid, count(DISTINCT item_id) AS n_items, sha256(array_to_string(list_sort(list(DISTINCT item_id)), ',')) AS s FROM hit GROUP BY rid)
SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(s, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN cover USING (rid) LEFT JOIN items USING (rid)""",
    "op9_jaccard_join": rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_FOLD.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN CAST([] AS VARCHAR[]) WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
      ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i : i + 4], ' ')) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT p.a, p.b FROM p JOIN n x ON p.a = x.doc_id JOIN n y ON p.b = y.doc_id WHERE 100 * common >= 80 * (x.n + y.n - common)),
r AS (SELECT DISTINCT a AS node, a AS seen FROM e UNION SELECT r.node, e.b FROM r JOIN e ON r.seen = e.a),
c AS (SELECT node, min(seen) AS component FROM r GROUP BY node)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(component, w.doc_id) AS component_id
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN c ON c.node = w.doc_id""",
}

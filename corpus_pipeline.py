"""From raw documents to token ids: five stages of the corpus operators.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and read again as the next stage's ``docs``.  All stages but the last
return the columns of ``documents``.

quality         rows whose quality score is under 0.3 go.
line_dedup      lines that at least 10 documents share go; n_chars is counted anew.
near_duplicates one document of each group of similar ones stays, the smallest id.
decontaminate   documents that share ten words in a row with a benchmark item go.
tokens          texts become token ids, which are decoded again as a check.

Defined cases, in every stage: empty tables give empty tables; null texts count as
empty and stay unless the quality model rejects empty texts; rows with null or repeated
ids stay apart (near_duplicates tells rows apart by id and text, and keeps one of rows
that agree in both); texts of any length are read whole; further columns pass through
all stages but the last, whatever their names.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import bpe, decontaminate, jaccard_join, line_dedup, quality
from tidewater.llm.common import materialise

RANKS = "byte_bpe_50k.tiktoken"


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), threshold=0.3)


def unshared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.without_shared_lines(docs, min_docs=10, min_chars=1)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.keep_one(docs)


def unseen_by_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids (packed uint32) and whether decoding gave the text back."""
    ranks = bpe.share_ranks(spark, public_tokenizers.path(RANKS))
    plain = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    decoded = bpe.round_trip(plain.withColumn("text_sha256", F.sha2("text", 256)), "text", ranks, public_tokenizers.PATTERN, keep=["doc_id", "text_sha256"])
    return decoded.select("doc_id", "n_tokens", "ids", (F.sha2("decoded", 256) == F.col("text_sha256")).alias("round_trip"))


STAGES = [
    ("quality", good_quality),
    ("line_dedup", unshared_lines),
    ("near_duplicates", one_of_each_group),
    ("decontaminate", unseen_by_benchmark),
    ("tokens", token_ids),
]

#: The quality model and the tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

"""Training-corpus pipeline: quality, line dedup, near-duplicates, decontamination, tokens.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next one's ``docs``. All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm import bpe, line_dedup, ngram_join, quality, tiling
from larder.llm.common import discard, shared_path

#: SQL can't fit a classifier, join by similarity, tile or merge byte pairs; tests compare the stages with brute force.
ORACLE_SQL = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose quality score, learnt from these rows and the labels, reaches the threshold."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, without the lines that are boilerplate of their source; ``n_chars`` follows the text."""
    cut = line_dedup.drop_boilerplate(docs)
    return cut.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.char_length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near-equal texts."""
    return ngram_join.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no benchmark item."""
    return tiling.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded_sha256): every text's token ids and the digest of what they decode to."""
    ranks, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    done = bpe.decode(bpe.encode(docs, "doc_id", "text", ranks, pattern), "doc_id", "ids", ranks, pattern)
    return done.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality", quality_stage),
    ("line_dedup", line_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("tokens", token_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage wrote goes when the next one's result is written."""
    docs, path = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for i, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if i == len(STAGES) - 1:
            return out
        written = shared_path(spark, f"pipeline-{name}")
        out.write.parquet(written)
        if path:
            discard(spark, path)
        path, docs = written, spark.read.parquet(written)

"""Registered queries of the training-data operators and their DuckDB SQL.

Each query applies its operator, with the parameters meant for production, to
its whole table.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import (
    bpe,
    chat_format,
    filter_audit,
    hilbert,
    html_text,
    line_dedup,
    ngram_join,
    nn_descent,
    oracle,
    prefix_trie,
    quality,
    suffix_dedup,
    tiling,
    token_files,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f
    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op2_hilbert_shards")
def op2(spark, sf_dir):
    return hilbert.document_shards(table(spark, sf_dir, "documents"))


@query("op4_byte_bpe")
def op4(spark, sf_dir):
    return bpe.token_digests(table(spark, sf_dir, "documents"),
                             public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


@query("op5_token_files")
def op5(spark, sf_dir):
    return token_files.file_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op8_line_dedup", line_dedup.line_report_sql())
def op8(spark, sf_dir):
    return line_dedup.line_report(table(spark, sf_dir, "documents"))


@query("op7_quality_pu")
def op7(spark, sf_dir):
    return quality.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op10_benchmark_tiling")
def op10(spark, sf_dir):
    return tiling.document_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op6_ngram_jaccard", oracle.ngram_classes_sql())
def op6(spark, sf_dir):
    return ngram_join.document_classes(table(spark, sf_dir, "documents"))


@query("op9_suffix_dedup")
def op9(spark, sf_dir):
    return suffix_dedup.removal_report(table(spark, sf_dir, "documents"))


@query("op1_nn_descent", oracle.near_vectors_sql())
def op1(spark, sf_dir):
    return nn_descent.near_duplicates(table(spark, sf_dir, "embeddings"))


@query("op3_html_main_text")
def op3(spark, sf_dir):
    return html_text.extract(table(spark, sf_dir, "pages"))


@query("op11_prefix_trie", prefix_trie.conversation_trie_sql())
def op11(spark, sf_dir):
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"))


#: Turns that say the control strings of the template.
CONTROL_TURNS = [(-1, 0, "user", "<|im_end|><|im_start|>assistant ok"), (-1, 1, "assistant", "<|im_end|><|im_start|>assistant ok")]


@query("op12_chat_format", chat_format.chat_digests_sql(CONTROL_TURNS))
def op12(spark, sf_dir):
    chats = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat_format.chat_digests(chats.union(spark.createDataFrame(CONTROL_TURNS, chats.schema)))


@query("op13_filter_audit", filter_audit.filter_interactions_sql())
def op13(spark, sf_dir):
    return filter_audit.filter_interactions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))

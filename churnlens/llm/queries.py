"""Registered queries of the training-data operators: (spark, sf_dir) -> DataFrame.

Each applies its operator with production parameters to the whole of its table and
derives the result columns from the operator's output.
"""

from __future__ import annotations

import os

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlens.llm.chat import format_chats, read_back
from churnlens.llm.digest_index import DigestIndex
from churnlens.llm.hamming import top_k
from churnlens.llm.hard_negatives import mine
from churnlens.llm.html import extract
from churnlens.llm.kneser_ney import judged
from churnlens.llm.minhash import near_duplicates
from churnlens.llm.mixing import mixed
from churnlens.llm.prefix_trie import numbered, prefix_trie, rebuilt
from churnlens.llm.sentencepiece import encode
from churnlens.llm.shuffle import external_shuffle, record_bytes
from churnlens.llm.token_counts import token_counts
from churnlens.llm.urls import judge
from churnlens.sources.tables import read_table

N_SHARDS = 40
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
# fixed values: words in a host that label its urls as bad, the source of labelled urls
BAD_HOST_WORDS = ["spam", "adult", "casino", "pills", "bets", "track", "ads"]
MIX = {
    "rate": 0.5,
    "seed": 4,
    "powers": {"source": 0.5},
    "wanted": {
        "lang": {"en": 0.4, "de": 0.2, "fr": 0.2, "es": 0.2},
        "topic": {"prose": 0.85, "license": 0.1, "table": 0.02, "symbols": 0.02, "shout": 0.01},
    },
}
COUNTED_BY = public_tokenizers.path("word_bpe_49k.json")
CONTEXT_TOKENS = 2048
PIECES = os.environ.get("CORPUS_PIECES", "/opt/tokenizers/piece_bpe_32k.model")


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(read_table(spark, sf_dir, "documents"), PIECES).withColumnRenamed("id", "doc_id")


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    probe = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return read_back(format_chats(turns.unionByName(spark.createDataFrame(probe, "conv_id long, turn long, role string, text string"))))


def op3_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def topic_of(text_col: str = "text") -> Column:
    """The kind of text, by what stands in it (null text: prose)."""
    has = lambda x: F.contains(F.col(text_col), F.lit(x))
    return (
        F.when(has("Licensed under"), "license").when(has(" | "), "table").when(has("!!"), "shout")
        .when(has("***") | has("%%%"), "symbols").otherwise("prose")
    )


def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    rows = mixed(docs, topic_of(), **MIX)
    return rows.select(
        F.col("id").alias("doc_id"), "source", "lang", "topic", "n_tokens",
        *[F.round(x, 6).alias(x) for x in ("factor", "p", "weight")], "sampled")


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = DigestIndex(spark)
    rows = index.report(read_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
    index.drop()  # the catalogue's name only
    return rows


def op6_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return extract(read_table(spark, sf_dir, "pages")).select(
        "page_id", "url", text.alias("text"), F.char_length(text).cast("long").alias("n_chars"))


def op7_quality_kn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    return judged(docs, labels).withColumnRenamed("id", "doc_id")


def op8_shuffle_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    written = external_shuffle(docs, N_SHARDS, seed=8).select("record.*", "shard", "slot")
    return written.select(
        "doc_id",
        record_bytes("text").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op9_hamming_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = top_k(read_table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, k=10)
    return found.withColumnRenamed("id", "vec_id")


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = F.col("host").rlike(f"(^|[^a-z0-9])({'|'.join(BAD_HOST_WORDS)})([^a-z0-9]|$)")
    found = judge(read_table(spark, sf_dir, "pages"), URL_RULES, bad)
    return found.select(F.col("id").alias("page_id"), "host", "path", "rule", "verdict", F.round("p", 6).alias("p_bad"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    rows = read_table(spark, sf_dir, "embeddings").withColumn("label", moved)
    return mine(rows, F.col("id") % 100 == 0)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = numbered(read_table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text")
    shared = F.crc32(F.col("conv").cast("string").cast("binary")) % 9
    return prefix_trie(rebuilt(turns, F.col("conv") - F.col("conv") % 5, shared, 8), turns)


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return token_counts(docs, COUNTED_BY, CONTEXT_TOKENS).withColumnRenamed("id", "doc_id")


QUERIES = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_chat_format": op2_chat_format,
    "op3_minhash_dedup": op3_minhash_dedup,
    "op4_source_mix": op4_source_mix,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_html_extract": op6_html_extract,
    "op7_quality_kn": op7_quality_kn,
    "op8_shuffle_shards": op8_shuffle_shards,
    "op9_hamming_topk": op9_hamming_topk,
    "op10_url_filter": op10_url_filter,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_token_counts": op13_token_counts,
}

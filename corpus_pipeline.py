"""The corpus pipeline: quality, exact dedup, near dedup, mixing, tokens.

Each stage takes (spark, docs, sf_dir), works on all rows that its predecessor kept and
returns a DataFrame; all but the last return the columns of documents. ``run`` writes
each stage's rows to the shared folder as Parquet and reads them back for the next, so a
lost executor never repeats more than one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from churnlens.llm.common import staged
from churnlens.llm.digest_index import DigestIndex
from churnlens.llm.kneser_ney import keep_good
from churnlens.llm.minhash import keep_one
from churnlens.llm.mixing import sample
from churnlens.llm.queries import PIECES, topic_of
from churnlens.llm.sentencepiece import encode
from churnlens.sources.tables import read_table


# What the quality stage keeps is prose, and license lines in it; the other kinds get what
# little is left of them, each document once at most.
MIX = {
    "rate": 0.5,
    "seed": 4,
    "max_repeats": 1,
    "powers": {"source": 0.5},
    "wanted": {
        "lang": {"en": 0.4, "de": 0.2, "fr": 0.2, "es": 0.2},
        "topic": {"prose": 0.88, "license": 0.1, "table": 0.01, "symbols": 0.005, "shout": 0.005},
    },
}


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the Kneser-Ney classifier keeps (operator 7)."""
    return keep_good(docs, read_table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest id (operator 5)."""
    index = DigestIndex(spark)
    kept = index.keep_new(docs)
    index.drop()
    return kept


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (operator 3)."""
    return keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn by raked factors, none of them twice (operator 4)."""
    return sample(docs, topic_of(), **MIX)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document (operator 1)."""
    return encode(docs, PIECES).withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality", quality),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mix", mix),
    ("tokens", tokens),
]

# SQL can't express the language model, the near-duplicate search and the encoder;
# tests/llm/test_pipeline.py holds every stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

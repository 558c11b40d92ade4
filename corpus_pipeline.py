"""A corpus pipeline of five stages, each one operator of ``trustgate.llm``.

Every stage takes (spark, docs, sf_dir), works on all rows that the stage before kept, and
returns a frame that is written as Parquet and read again for the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trustgate.llm import bpe, near_copies, quality, secrets, templates
from trustgate.llm.common import stored


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the risk-controlled cutoffs reject go."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, 0.8 or more) stays."""
    return near_copies.one_of_each(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return templates.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Reported secrets are replaced by a mark; all documents stay."""
    return secrets.redact_documents(docs)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every remaining text, and whether decoding them gives the text back."""
    coded = bpe.decode(bpe.encode(docs.select("doc_id", "lang", "source", "text")))
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return coded.select(
        "doc_id",
        "lang",
        "source",
        "ids",
        F.size("ids").cast("long").alias("n_tokens"),
        (F.col("decoded") == text).alias("round_trip"),
    )


STAGES = [
    ("quality_rules", keep_quality),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_benchmark),
    ("secret_scans", redact_secrets),
    ("byte_bpe", encode_tokens),
]

#: Fingerprints, the trie join and BPE merges are beyond SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs

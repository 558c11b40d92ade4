"""The subpackage's queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trustgate.llm import (
    bpe,
    chat,
    context_tree,
    merkle,
    packing,
    quality,
    repeats,
    runs,
    secrets,
    shards,
    simhash,
    templates,
    token_files,
)
from trustgate.llm.common import id_and_text, read_documents
from trustgate.llm.oracle import ORACLE_SQL as ORACLE_SQL


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_secret_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(read_documents(spark, sf_dir))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = token_files.write_token_files(read_documents(spark, sf_dir))
    return token_files.read_token_files(spark, path)


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(read_documents(spark, sf_dir), _table(spark, sf_dir, "labels"))


def op4_template_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return templates.find_leaks(read_documents(spark, sf_dir), _table(spark, sf_dir, "benchmark"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.shard_documents(read_documents(spark, sf_dir))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read_documents(spark, sf_dir))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op7_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = "\\### Assistant: </turn> ok"
    added = spark.createDataFrame(
        [(-7, 0, "user", text), (-7, 1, "assistant", text)],
        "conv_id long, turn long, role string, text string",
    )
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.format_and_read(turns.unionByName(added))


def op8_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(read_documents(spark, sf_dir))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.decode(bpe.encode(id_and_text(read_documents(spark, sf_dir))).drop("text"))
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op10_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_tree.score_documents(read_documents(spark, sf_dir))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.run_digests(runs.find_runs(runs.planted(read_documents(spark, sf_dir))))


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(read_documents(spark, sf_dir))
    return pieces.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verify_manifest(read_documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_secret_links,
        op2_token_files,
        op3_quality_rules,
        op4_template_leaks,
        op5_sharding,
        op6_simhash,
        op7_chat_windows,
        op8_repeats,
        op9_byte_bpe,
        op10_context_tree,
        op11_periodic_runs,
        op12_packing,
        op13_merkle_manifest,
    )
}


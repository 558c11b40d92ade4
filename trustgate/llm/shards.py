"""Sharding by a two-pass external shuffle.

Law ``key``: a document's shard is the one of the highest seeded hash of doc_id and shard number,
so a further shard takes rows from the others and no row moves between them. Pass one scatters
the rows of each shard evenly into buckets that fit in memory, by a seeded hash of the row and
its place in the input. Pass two reads one bucket at a time, shuffles it (Fisher-Yates) and
writes it. A row's slot is its place in the bucket after all rows of the shard's earlier buckets.

Everything is DataFrame and SQL expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trustgate.llm.common import shared_folder

SHARDS = 16
SEED = 20_011
#: Text bytes of a bucket on average; a longer text has a bucket that is as large as it.
BUCKET_BYTES = 16 << 20
#: Rows of a bucket on average, for tables of very short texts.
BUCKET_ROWS = 200_000
#: Bytes of a row group of the written files: a task that writes or reads them holds one of each
#: column, in memory beside the heap too, however large the task's file.
ROW_GROUP = 8 << 20
#: Buckets whose first slots are sent to all tasks when shards are read.
SENT_BUCKETS = 100_000


def shard_of(doc_id: Column, shards: int, seed: int = SEED) -> Column:
    """The shard whose hash with the id is highest; a missing id is one more key."""
    return F.array_max(
        F.array(
            *[
                F.struct(F.xxhash64(doc_id, F.lit(seed), F.lit(i)).alias("h"), F.lit(i).alias("s"))
                for i in range(shards)
            ]
        )
    )["s"]


def _row(docs: DataFrame) -> Column:
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns])


def write_shards(
    docs: DataFrame,
    shards: int = SHARDS,
    seed: int = SEED,
    bucket_bytes: int = BUCKET_BYTES,
    path: str | None = None,
) -> str:
    """Write all rows, shuffled, into one folder per shard; return the folder of folders.

    A file row has ``shard``, ``bucket``, ``place`` (in the bucket), ``size`` and ``row``, which
    holds all columns, whatever their names. A missing text has size 1. A doc_id that very many
    rows share lies in one shard by law, but its rows are spread over the shard's buckets, and
    so are wholly repeated rows: the scattering hash takes a row's place in the input along.
    An empty table writes no row.
    """
    spark = docs.sparkSession
    path = path or shared_folder(spark)
    sized = docs.select(
        _row(docs).alias("row"),
        F.col("doc_id").alias("id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.xxhash64("doc_id", "text").alias("mark"),
    ).withColumn("shard", shard_of(F.col("id"), shards, seed))
    # One row per shard comes to the driver.
    totals = sized.groupBy("shard").agg(F.sum("size").alias("b"), F.count("*").alias("n")).collect()
    buckets = [1] * shards
    for t in totals:
        buckets[t.shard] = max(1, -(-t.b // bucket_bytes), -(-t.n // BUCKET_ROWS))
    number = F.element_at(F.array(*[F.lit(b) for b in buckets]), F.col("shard") + 1)
    place = F.monotonically_increasing_id()
    scattered = (
        sized.withColumn("dealt", F.xxhash64("mark", place, F.lit(seed)))
        .withColumn("bucket", F.pmod("dealt", number).cast("int"))
        .repartition(max(1, sum(buckets)), "shard", "bucket")
    )
    gathered = scattered.groupBy("shard", "bucket").agg(
        F.sort_array(F.collect_list(F.struct("dealt", "mark", "size", "row"))).alias("rows")
    )
    # Buckets of a task in a fixed order: the seeded shuffle then gives the same each time.
    (
        gathered.sortWithinPartitions("shard", "bucket")
        .select("shard", "bucket", F.posexplode(F.shuffle("rows", F.lit(seed))))
        .select("shard", "bucket", F.col("pos").alias("place"), "col.size", "col.row")
        .write.partitionBy("shard")
        .option("parquet.block.size", ROW_GROUP)
        .parquet(path)
    )
    return path


def read_shards(docs: DataFrame, path: str) -> DataFrame:
    """Rows of written shards: shard, slot (from 0, without gaps), size and row.

    docs: the frame that was written, for its columns.
    """
    spark = docs.sparkSession
    row = docs.select(_row(docs).alias("row")).schema["row"].dataType.simpleString()
    schema = f"bucket int, place int, size long, row {row}, shard int"
    files = spark.read.schema(schema).parquet(path)
    counts = files.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        "shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")
    )
    # A few numbers per bucket: sent to the rows where they are few, else rows are dealt to them.
    if starts.count() <= SENT_BUCKETS:
        starts = F.broadcast(starts)
    return files.join(starts, ["shard", "bucket"]).select(
        "shard", (F.col("start") + F.col("place")).alias("slot"), "size", "row"
    )


def shard_documents(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """One row per document of shards that have been written and read back."""
    columns = docs.select("doc_id", "text")
    read = read_shards(columns, write_shards(columns, shards, seed))
    doc_id = F.col("row.doc_id")
    return read.select(
        doc_id.alias("doc_id"),
        "size",
        F.crc32(F.coalesce(F.col("row.text"), F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        "slot",
        shard_of(doc_id, shards + 1, seed).cast("int").alias("grown_shard"),
    )

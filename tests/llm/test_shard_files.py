"""Files of shards: what a reading task holds of one is bounded, however large the file."""

from pathlib import Path

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from trustgate.llm import shards


def test_row_groups_of_a_large_bucket_stay_small(spark, tmp_path):
    text = F.concat_ws(" ", *[F.sha2(F.concat("id", F.lit(f"-{i}")), 512) for i in range(64)])
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), text.alias("text"))
    path = shards.write_shards(docs, 1, bucket_bytes=64 << 20, path=str(tmp_path / "shards"))
    sizes = []
    for file in Path(path).rglob("*.parquet"):
        found = pq.ParquetFile(file).metadata
        sizes += [found.row_group(i).total_byte_size for i in range(found.num_row_groups)]
    assert sum(sizes) > 2 * shards.ROW_GROUP and max(sizes) < 1.5 * shards.ROW_GROUP
    read = shards.read_shards(docs, path)
    assert read.agg(F.count_distinct("slot"), F.max("slot")).first() == (3000, 2999)
    assert read.select("row.*").exceptAll(docs).isEmpty()

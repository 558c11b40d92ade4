"""Shared helpers: the folder for stored steps, Arrow batches cut by bytes, document input."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and text bytes handled at once inside a task; a longer text makes a batch of its own.
BATCH_ROWS = 2_000
BATCH_BYTES = 4 << 20


def shared_folder(spark: SparkSession) -> str:
    """A new folder under spark.checkpoint.dir, or under the warehouse where that is unset."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/llm-{uuid.uuid4().hex}"


def stored(df: DataFrame, *partition_by: str) -> DataFrame:
    """Write a frame to the shared folder and read it back, which cuts its lineage.

    Written tables survive the loss of an executor. They stay until the owner of
    spark.checkpoint.dir clears that folder.
    """
    path = shared_folder(df.sparkSession)
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def id_and_text(docs: DataFrame) -> DataFrame:
    """doc_id and text alone, a missing text as the empty one; other columns cannot clash."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )


def slices(
    batch: pa.RecordBatch, column: str = "text", most: int = BATCH_BYTES
) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that a slice holds ``most`` bytes of the column, or a single longer row."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start = held = 0
    for i, size in enumerate(sizes):
        if i > start and (held + size > most or i - start >= BATCH_ROWS):
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if len(sizes) > start:
        yield batch.slice(start)


def map_texts(
    df: DataFrame,
    make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]],
    schema: str,
    most: int = BATCH_BYTES,
) -> DataFrame:
    """Run ``make()``'s function over slices of a frame with a ``text`` column.

    ``make`` runs once per task, so what it loads or remembers lives in the Python worker.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for part in slices(batch, most=most):
                out = work(part)
                if out.num_rows:
                    yield out

    return df.mapInArrow(run, schema)


def texts_of(batch: pa.RecordBatch) -> list[str]:
    return batch.column("text").to_pylist()


def unused(df: DataFrame, name: str) -> str:
    """The name, with marks added until no column of the frame has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name

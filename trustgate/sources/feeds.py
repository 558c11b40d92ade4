"""Batch feeds: one Parquet part per feed and period, with drifting types and columns."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from urllib.parse import unquote, urlsplit

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trustgate.functions.expressions import instant, literal, quoted

def align_types(df: DataFrame, types: Mapping[str, str], strict: bool = True) -> DataFrame:
    """Cast the columns that drift between parts, in one projection.

    Only columns present under exactly the given spelling are cast. ``strict=False``
    turns text that does not parse into NULL instead of failing the job.
    """
    cast = "CAST" if strict else "TRY_CAST"
    return df.selectExpr(
        *[
            f"{cast}({quoted(c)} AS {types[c]}) AS {quoted(c)}" if c in types else quoted(c)
            for c in df.columns
        ]
    )


def union_parts(parts: Iterable[DataFrame]) -> DataFrame:
    """Union by name; a column a part lacks is NULL there."""
    parts = list(parts)
    if not parts:
        raise ValueError("no parts to union")
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), parts)


def part_path(template: str, feed: str, period: str) -> str:
    return template.format(feed=feed, period=period)


def _merged_schema(spark: SparkSession, paths: Sequence[str]) -> T.StructType | None:
    """The schema of all files under the paths, or None where types of one column differ.

    Spark reads the footers in tasks and brings back one schema per task.
    """
    try:
        return spark.read.option("mergeSchema", True).parquet(*paths).schema
    except Exception as error:
        if "CANNOT_MERGE_SCHEMAS" in str(error):
            return None
        raise


def _files(spark: SparkSession, path: str) -> list[str]:
    return sorted(spark.read.schema("_ INT").parquet(path).inputFiles())


def _agree(one: T.StructType, other: T.StructType) -> bool:
    types = {f.name.lower(): f.dataType for f in one}
    return all(types.get(f.name.lower(), f.dataType) == f.dataType for f in other)


def _joined(one: T.StructType, other: T.StructType) -> T.StructType:
    known = {f.name.lower() for f in one}
    return T.StructType([*one, *[f for f in other if f.name.lower() not in known]])


def layouts(spark: SparkSession, paths: Sequence[str]) -> list[tuple[T.StructType, list[str]]]:
    """Paths that one scan can read together, with the schema of that scan.

    A column that a file lacks is NULL in its rows, so files differ only where one column has
    several types. Paths whose schemas merge are one layout, found by one job however many files
    they hold. Where they don't, the list is halved, and a single path is taken file by file; so
    the number of jobs grows with the places where types change along the list, not with files.
    Halves of the same types share a scan again in the end.
    """
    found: list[tuple[T.StructType, list[str]]] = []

    def add(schema: T.StructType, some: Sequence[str]) -> None:
        for i, (known, members) in enumerate(found):
            if _agree(known, schema):
                found[i] = (_joined(known, schema), [*members, *some])
                return
        found.append((schema, list(some)))

    def look(some: Sequence[str], whole: bool) -> None:
        schema = _merged_schema(spark, some)
        if schema is not None:
            add(schema, some)
        elif len(some) > 1:
            middle = len(some) // 2
            look(some[:middle], whole)
            look(some[middle:], whole)
        elif whole:
            look(_files(spark, some[0]), False)
        else:
            raise ValueError(f"{some[0]} has no single schema")

    look(list(paths), True)
    return found


def _require_files(scans: Sequence[DataFrame], parts: Sequence[str]) -> None:
    """Every part has a file; a missing folder has raised before, an empty one would not."""
    files = [urlsplit(f).path for scan in scans for f in scan.inputFiles()]
    held = sorted(unquote(f) for f in files)
    for part in parts:
        path = urlsplit(part).path.rstrip("/")
        if any(sign in path for sign in "*?[{"):
            continue
        at = bisect_left(held, path)
        if at == len(held) or not held[at].startswith(path):
            raise FileNotFoundError(f"part {part} holds no file")


def read_feed(
    spark: SparkSession,
    template: str,
    feed: str,
    periods: Iterable[str],
    types: Mapping[str, str],
) -> DataFrame:
    """Scan one feed; a period without a part, or with an empty one, fails.

    Files whose columns agree in type are read by one scan (``layouts``), so neither the plan nor
    the work before it grows with the number of files. ``source_file`` is the file a row came
    from, taken before any cast.
    """
    parts = [part_path(template, feed, period) for period in periods]
    if not parts:
        raise ValueError(f"no periods to read of feed {feed}")
    found = layouts(spark, parts)
    scans = [spark.read.schema(schema).parquet(*paths) for schema, paths in found]
    _require_files(scans, parts)
    return union_parts(
        align_types(scan.withColumn("source_file", F.col("_metadata.file_path")), types)
        for scan in scans
    )


def with_provenance(
    df: DataFrame, feed: str, ingested_at: str | None = None, hint: str = "taxi_type_hint"
) -> DataFrame:
    """Stamp the feed a row belongs to, in the column ``hint``, and when it was taken in."""
    return df.selectExpr(
        "*", f"{instant(ingested_at)} AS ingest_ts", f"{literal(feed)} AS {quoted(hint)}"
    )

"""Quarantine triage: reasons, ageing, samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trustgate.functions.expressions import age_bucket, bucket_rank, literal


def incident_counts(quarantine: DataFrame) -> DataFrame:
    """Quarantined rows per run and failed rule; a row counts once for each rule in its trail.

    Equal trails are counted before they are exploded, so the explode sees one row per
    distinct trail and task instead of one per quarantined row.
    """
    trails = quarantine.groupBy("dq_run_id", "dq_failed_rules").agg(F.expr("count(1) AS n"))
    rules = trails.select(
        F.col("dq_run_id").alias("run_id"),
        F.explode(F.split("dq_failed_rules", ",")).alias("rule"),
        "n",
    ).withColumn("rule", F.trim("rule"))
    return (
        rules.where("rule <> ''").groupBy("run_id", "rule").agg(F.sum("n").alias("incident_count"))
    )


def top_reasons(incidents: DataFrame, k: int = 20) -> DataFrame:
    """The k most frequent reasons of every run; a run's window spans one row per rule."""
    order = Window.partitionBy("run_id").orderBy(F.desc("incident_count"), "rule")
    return (
        incidents.withColumn("_rank", F.row_number().over(order))
        .where(F.col("_rank") <= k)
        .drop("_rank")
        .orderBy(F.desc("incident_count"), "rule", "run_id")
    )


def enrich(incidents: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Dimension and severity of each reason; a dash for rules no longer declared.

    Both sides are short: incidents have one row per run and rule.
    """
    known = incidents.join(catalogue, "rule", "left")
    return known.withColumns(
        {c: F.coalesce(F.col(c), F.lit("—")) for c in ("dimension", "severity")}
    )


def run_captures(profiles: DataFrame) -> DataFrame:
    """When each run was captured: its newest profile fact."""
    return profiles.groupBy("run_id").agg(F.max("captured_at").alias("captured_at"))


def with_age(quarantine: DataFrame, captures: DataFrame, as_of: str | None) -> DataFrame:
    """Rows of known runs with the capture time and the days since.

    ``as_of`` is a date, today by default. All rows of a run share one join key, so
    callers count or sample first and join the few rows that are left.
    """
    today = "current_date()" if as_of is None else f"CAST({literal(as_of)} AS DATE)"
    runs = captures.selectExpr("run_id AS _run", "captured_at AS quarantined_at")
    joined = quarantine.join(runs, F.col("dq_run_id") == F.col("_run")).drop("_run")
    return joined.selectExpr(
        "*", f"datediff({today}, to_date(quarantined_at)) AS days_in_quarantine"
    )


def _counted_with_age(quarantine: DataFrame, captures: DataFrame, as_of: str | None) -> DataFrame:
    """Rows per run with the run's age: age belongs to the run, not to the row."""
    per_run = quarantine.groupBy("dq_run_id").agg(F.expr("count(1) AS n"))
    return with_age(per_run, captures, as_of)


def ageing(quarantine: DataFrame, captures: DataFrame, as_of: str | None = None) -> DataFrame:
    """Per run: rows, since when, and youngest, oldest and mean age in days."""
    runs = _counted_with_age(quarantine, captures, as_of).groupBy(
        F.col("dq_run_id").alias("run_id")
    )
    return runs.agg(
        F.expr("sum(n) AS quarantined_rows"),
        F.expr("min(quarantined_at) AS quarantined_since"),
        F.expr("min(days_in_quarantine) AS min_days"),
        F.expr("max(days_in_quarantine) AS max_days"),
        F.expr("sum(days_in_quarantine * n) / sum(n) AS avg_days"),
    )


def age_buckets(quarantine: DataFrame, captures: DataFrame, as_of: str | None = None) -> DataFrame:
    """Quarantined rows of every run per age bucket, youngest bucket first."""
    bucket = F.expr(age_bucket("days_in_quarantine")).alias("age_bucket")
    run = F.col("dq_run_id").alias("run_id")
    counted = _counted_with_age(quarantine, captures, as_of).groupBy(run, bucket)
    rows = counted.agg(F.expr("sum(n) AS row_count"))
    return rows.selectExpr("*", f"{bucket_rank('age_bucket')} AS bucket_rank").orderBy(
        "run_id", "bucket_rank"
    )


def random_rank(seed: str, identity: Sequence[str]) -> Column:
    """A repeatable random order: a hash of the seed and what identifies a row."""
    return F.md5(F.concat_ws("|", F.lit(seed), *[F.col(c).cast("string") for c in identity]))


def stratified_sample(
    quarantine: DataFrame, seed: str, identity: Sequence[str], k: int = 5
) -> DataFrame:
    """At most k rows per run and dominant dimension, drawn at random but repeatably.

    Spark limits each group inside every task before it shuffles, so the few groups never
    gather their rows in one place.
    """
    stratum = F.coalesce("dq_dominant_dimension", F.lit("unknown"))
    ranked = quarantine.withColumns({"_s": stratum, "_r": random_rank(seed, identity)})
    order = Window.partitionBy("dq_run_id", "_s").orderBy("_r", *identity)
    numbered = ranked.withColumn("_n", F.row_number().over(order))
    return numbered.where(F.col("_n") <= k).drop("_s", "_r", "_n")


def ordered_sample(df: DataFrame, order: Sequence[str], k: int) -> DataFrame:
    """The first k rows in a stated order."""
    return df.orderBy(*order).limit(k)

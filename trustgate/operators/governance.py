"""Views over the governance facts of all runs, and reads scoped to one run.

Facts are a few dozen rows per run. A run is "latest" by its newest ``captured_at``;
run ids are opaque and are compared only to break ties.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trustgate.functions.expressions import (
    gap_level,
    literal,
    quoted,
    rate_level,
    rounded,
    share_pct,
)
from trustgate.plans.spec import RowRule


def run_list(facts: DataFrame) -> DataFrame:
    """Runs with the time of their last fact, newest first."""
    return (
        facts.groupBy("run_id")
        .agg(F.max("captured_at").alias("last_captured"))
        .orderBy(F.desc("last_captured"), F.desc("run_id"))
    )


def latest_run(facts: DataFrame) -> DataFrame:
    """One row: the run with the newest fact."""
    newest = F.max(F.struct("captured_at", "run_id"))
    return facts.agg(newest.alias("newest")).select(F.col("newest.run_id").alias("run_id"))


def of_run(df: DataFrame, run: DataFrame, column: str = "run_id") -> DataFrame:
    """The rows of the run named by ``run``, a frame of one row.

    Its id is a scalar subquery: Spark works it out once, ahead of the scan, and compares a
    column to a value, which prunes partitions, is pushed below a union and needs no join.
    """
    return df.where(F.col(column) == run.select("run_id").scalar())


def _dimension_scores() -> list[Column]:
    return [
        F.expr("count(1) AS rules_evaluated"),
        F.expr("count_if(passed) AS rules_passed"),
        F.expr("avg(CAST(passed AS DOUBLE)) AS pass_rate"),
        F.expr("max(measured) FILTER (WHERE rule = 'hard_quarantine_rate') AS quarantine_rate"),
        F.expr("max(measured) FILTER (WHERE rule = 'uniqueness_rate') AS uniqueness_metric"),
    ]


def scorecard(validation: DataFrame) -> DataFrame:
    """Rules evaluated and passed, pass rate and key measures per run and dimension."""
    return validation.groupBy("run_id", "dimension").agg(*_dimension_scores())


def scorecard_of_run(validation: DataFrame, run: DataFrame) -> DataFrame:
    """A run's scorecard with rounded rates, by dimension."""
    scores = scorecard(of_run(validation, run))
    return scores.withColumns(
        {"pass_rate": F.round("pass_rate", 4), "quarantine_rate": F.round("quarantine_rate", 6)}
    ).orderBy("dimension")


def profile_latest(profiles: DataFrame) -> DataFrame:
    """The profile of the latest run."""
    return of_run(profiles, latest_run(profiles))


def fitness_summary(fitness: DataFrame) -> DataFrame:
    return fitness.select(
        "run_id", "use_case", "rule", "passed", "measured", "expected", "captured_at"
    )


def fitness_of_run(fitness: DataFrame, run: DataFrame) -> DataFrame:
    """A run's fitness results by use case."""
    results = of_run(fitness, run).select(
        "use_case", "rule", "passed", "measured", "expected", "run_id"
    )
    return results.orderBy("use_case", "rule")


def error_first(df: DataFrame, *then: str) -> DataFrame:
    return df.orderBy(F.when(F.col("severity") == "error", 0).otherwise(1), *then)


def failed_rules(validation: DataFrame, run: DataFrame) -> DataFrame:
    """Rules of a run that did not pass, error severity first."""
    failed = of_run(validation, run).where(~F.col("passed"))
    columns = failed.select("dimension", "rule", "severity", "passed", "measured", "threshold")
    return error_first(columns, "dimension", "rule")


# What each severity does to a row.
SEVERITY_EFFECT = {"error": "moves rows to quarantine", "warning": "scores only"}


def rule_detail(validation: DataFrame, run: DataFrame) -> DataFrame:
    """All rules of a run with the effect of their severity, error severity first."""
    cases = " ".join(
        f"WHEN {literal(severity)} THEN {literal(label)}"
        for severity, label in SEVERITY_EFFECT.items()
    )
    rows = of_run(validation, run).selectExpr(
        "rule",
        "dimension",
        "severity",
        "scope",
        "passed",
        "measured",
        "threshold",
        f"CASE severity {cases} ELSE '—' END AS effect",
    )
    return error_first(rows, "dimension", "rule")


def reliability(validation: DataFrame, cap: float) -> DataFrame:
    """Per run: mean of the dimensions' pass rates, quarantine rate, failures, level and verdict.

    A run above the quarantine cap is bad whatever its rates. It is trusted when the mean
    reaches 0.95, the cap holds and no rule of error severity failed.
    """
    dimensions = validation.groupBy("run_id", "dimension").agg(
        *_dimension_scores(),
        F.expr("count_if(severity = 'error' AND NOT passed) AS hard"),
        F.expr("count_if(severity = 'warning' AND NOT passed) AS soft"),
        F.expr("count_if(severity = 'error' AND NOT passed AND scope = 'row') AS hard_row"),
    )
    runs = dimensions.groupBy("run_id").agg(
        F.expr("avg(pass_rate) AS mean_pass_rate"),
        F.expr("coalesce(max(quarantine_rate), 0.0D) AS quarantine_rate"),
        F.expr("max(uniqueness_metric) AS duplicate_rate"),
        F.expr("sum(rules_evaluated) AS rules_evaluated"),
        F.expr("sum(rules_passed) AS rules_passed"),
        F.expr("sum(hard) AS hard_failures"),
        F.expr("sum(soft) AS soft_failures"),
        F.expr("sum(hard_row) AS hard_row_failures"),
    )
    return runs.selectExpr("*", f"quarantine_rate <= {literal(cap)} AS within_cap").selectExpr(
        "*",
        f"CASE WHEN within_cap THEN {rate_level('mean_pass_rate')} ELSE 'bad' END AS level",
        "mean_pass_rate >= 0.95D AND within_cap AND hard_failures = 0 AS trusted",
    )


def layer_counts(counted: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of every named table, one row each, as one union."""
    return reduce(
        DataFrame.unionByName,
        [
            df.agg(F.expr("count(1) AS row_count")).selectExpr(
                f"{literal(name)} AS object", "row_count"
            )
            for name, df in counted.items()
        ],
    )


def counts_where(df: DataFrame, parts: Mapping[str, str]) -> DataFrame:
    """Row count of every named part of one frame, one row each, in a single pass."""
    counts = [F.expr(f"count_if({where})").alias(f"n{i}") for i, where in enumerate(parts.values())]
    rows = ", ".join(
        f"struct({literal(name)} AS object, n{i} AS row_count)" for i, name in enumerate(parts)
    )
    return df.agg(*counts).selectExpr(f"inline(array({rows}))")


def _with_share(totals: DataFrame) -> DataFrame:
    share = share_pct("quarantine_rows", "(consumption_rows + quarantine_rows)", 4)
    return totals.selectExpr("*", f"{share} AS quarantine_pct")


def marked_share(marked: DataFrame) -> DataFrame:
    """``quarantine_share`` of marked rows, in a single pass over them."""
    return _with_share(
        marked.agg(
            F.expr("count_if(NOT dq_quarantined) AS consumption_rows"),
            F.expr("count_if(dq_quarantined) AS quarantine_rows"),
        )
    )


def quarantine_share(clean: DataFrame, quarantine: DataFrame) -> DataFrame:
    """Rows on both sides and the quarantined percentage; NULL when both are empty."""
    sides = clean.agg(F.expr("count(1) AS c"), F.expr("0L AS q")).unionByName(
        quarantine.agg(F.expr("0L AS c"), F.expr("count(1) AS q"))
    )
    return _with_share(
        sides.agg(F.expr("sum(c) AS consumption_rows"), F.expr("sum(q) AS quarantine_rows"))
    )


def kpi_of_run(kpi: DataFrame, run: DataFrame, value: str, digits: int, order: str) -> DataFrame:
    """A run's KPI rows with the value rounded, in key order."""
    return of_run(kpi, run).withColumn(value, F.expr(rounded(quoted(value), digits))).orderBy(order)


def kpi_null_share(kpi: DataFrame, run: DataFrame, value: str) -> DataFrame:
    """Hourly KPI of a run with the percentage of rows the average ignored."""
    share = share_pct(quoted(f"null_{value}"), "trip_count", 2)
    with_share = kpi.selectExpr("*", f"{share} AS null_pct")
    return kpi_of_run(with_share, run, f"avg_{value}", 4, "pickup_hour")


def fitness_rollup(fitness: DataFrame) -> DataFrame:
    """Per run: approved checks, all checks and use cases covered."""
    return fitness.groupBy("run_id").agg(
        F.expr("count_if(passed) AS approved"),
        F.expr("count(1) AS total"),
        F.expr("count(DISTINCT use_case) AS use_cases"),
    )


def _of_tables(profiles: DataFrame) -> DataFrame:
    """Facts of whole tables: those of single partitions lie beside them and are left out."""
    if "partition_key" not in profiles.columns:
        return profiles
    return profiles.where("partition_key IS NULL")


def _wide(profiles: DataFrame, metrics: Sequence[str]) -> DataFrame:
    return (
        _of_tables(profiles).groupBy("run_id", "layer", "table_name", "column_name")
        .pivot("metric", list(metrics))
        .agg(F.max("metric_value"))
    )


def profile_matrix(profiles: DataFrame) -> DataFrame:
    """One row per profiled column with its null rate, minimum, average and maximum."""
    return _wide(profiles.where("column_name <> '*'"), ["null_rate", "min", "avg", "max"])


def preferred_layer(profiles: DataFrame, layer: str = "clean") -> DataFrame:
    """Numeric ranges of one layer, or of all layers in runs that did not profile it.

    The window spans one run's facts, a few dozen rows.
    """
    numeric = _of_tables(profiles).where(F.col("metric").isin("min", "max", "avg"))
    wanted = F.col("layer") == layer
    in_run = F.max(wanted).over(Window.partitionBy("run_id"))
    ranges = _wide(numeric, ["min", "avg", "max"]).withColumn("_has", in_run)
    return ranges.where(wanted | ~F.col("_has")).drop("_has")


def layer_rows(profiles: DataFrame) -> DataFrame:
    """Row count per layer as profiled."""
    totals = _of_tables(profiles).where("column_name = '*' AND metric = 'row_count'")
    return totals.selectExpr(
        "run_id", "layer", "table_name", "CAST(metric_value AS BIGINT) AS row_count"
    )


def worst_gaps(profiles: DataFrame, k: int = 5) -> DataFrame:
    """The k highest null rates of every run with a level; ties by layer and column."""
    gaps = _of_tables(profiles).where("metric = 'null_rate'").selectExpr(
        "run_id",
        "layer",
        "table_name",
        "column_name",
        "metric_value AS null_rate",
        f"{gap_level('metric_value')} AS level",
    )
    worst = [F.desc("null_rate"), F.asc("layer"), F.asc("column_name")]
    rank = F.row_number().over(Window.partitionBy("run_id").orderBy(*worst))
    kept = gaps.withColumn("_rank", rank).where(F.col("_rank") <= k)
    return kept.drop("_rank").orderBy("run_id", *worst)


def rule_catalogue(spark: SparkSession, rules: Sequence[RowRule]) -> DataFrame:
    """The declared row rules as a small table."""
    return spark.createDataFrame(
        [(r.name, r.dimension, r.severity) for r in rules],
        "rule string, dimension string, severity string",
    )

"""Metrics of a gated table and the rules that judge them.

``measure`` turns a gated table into one wide row; ``validation_rows`` and
``aggregate_rows`` turn that row into validation facts. Input is read once however many
rules there are.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trustgate.functions.expressions import (
    as_rows,
    compare,
    fails,
    instant,
    literal,
    null,
    quoted,
    ratio,
)
from trustgate.operators.gate import row_rule_record, violations
from trustgate.plans.spec import (
    DECLARED_TYPES,
    ColumnSpec,
    FitnessRule,
    ProductSpec,
    RowRule,
)

logger = logging.getLogger(__name__)


def upper_median(column: str) -> str:
    """The middle value, the larger of the two when their number is even."""
    return f"CAST(percentile_disc(0.5) WITHIN GROUP (ORDER BY {column} DESC) AS BIGINT)"


def digest_of(columns: Sequence[str]) -> list[str]:
    """A value of several columns as two 64-bit hashes, in which NULLs are equal to each other.

    A hash skips a NULL, so which columns are NULL goes in ahead of them.
    """
    parts = [f"{quoted(c)} IS NULL" for c in columns] + [quoted(c) for c in columns]
    return [f"xxhash64({seed}, {', '.join(parts)})" for seed in (1, 2)]


def failure_pattern(rules: Sequence[RowRule]) -> str:
    """Which of the rules a row fails, as one letter for each."""
    flags = [f"CASE WHEN {fails(r)} THEN 'f' ELSE '-' END" for r in rules]
    return f"concat({', '.join(flags)})" if flags else "''"


def measure(
    df: DataFrame, spec: ProductSpec, accepted: str, rules: Sequence[RowRule] = ()
) -> DataFrame:
    """One row with the counts every aggregate rule needs, and violations of ``rules``.

    ``accepted`` tells clean rows from quarantined ones. One pass counts two things apart: rows by
    period and by the pattern of rules they fail, which are few, and rows by the digest of their
    key. A key crosses the shuffle as its digest alone, once for each task that has it, so a key
    held by a third of all rows leaves a task as one row, and no counter of a rule travels with a
    key. Rejected rows share one NULL key.
    """
    key = digest_of(spec.business_key) if spec.business_key else ["0L", "0L"]
    flat = df.selectExpr("*", f"{accepted} AS _ok").selectExpr(
        "_ok",
        f"CASE WHEN _ok THEN {quoted(spec.period)} END AS _period",
        f"{failure_pattern(rules)} AS _fails",
        *[f"CASE WHEN _ok THEN {sql} END AS _key{i}" for i, sql in enumerate(key)],
    )
    rows, keys = ["_ok", "_period", "_fails"], ["_key0", "_key1"]
    counted = flat.groupingSets(
        [[F.col(c) for c in rows], [F.col(c) for c in keys]], *rows, *keys
    ).agg(F.expr("count(1) AS n"), F.expr("grouping(_ok) = 1 AS _is_key"))
    failed = [f"substr(_fails, {i}, 1) = 'f'" for i, _ in enumerate(rules, 1)]
    # Few rows per period and task from here on, and one for all keys of a task.
    periods = counted.groupBy("_ok", "_period", "_is_key").agg(
        F.expr("sum(n) AS n"),
        F.expr("count(_key0) AS keys"),
        *[F.expr(f"sum(n) FILTER (WHERE {x}) AS {violations(r)}") for x, r in zip(failed, rules)],
    )
    has_key = literal(bool(spec.business_key))
    sums = {
        "total_rows": "sum(n) FILTER (WHERE NOT _is_key)",
        "clean_rows": "sum(_clean_n)",
        "distinct_keys": f"sum(keys) FILTER (WHERE _is_key AND {has_key})",
        **{violations(r): f"sum({violations(r)}) FILTER (WHERE NOT _is_key)" for r in rules},
    }
    return periods.selectExpr("*", "CASE WHEN _ok AND NOT _is_key THEN n END AS _clean_n").agg(
        *[F.expr(f"coalesce({total}, 0) AS {name}") for name, total in sums.items()],
        F.expr("count(_clean_n) AS periods"),
        F.expr("min(_clean_n) AS smallest_period"),
        F.expr(f"{upper_median('_clean_n')} AS median_period"),
    )


def aggregate_metrics(spec: ProductSpec) -> dict[str, str]:
    """The metrics an aggregate rule can name, over the row ``measure`` yields."""
    unique = ratio("distinct_keys", "clean_rows", 1.0)
    return {
        "distinct_year_month": "CAST(periods AS DOUBLE)",
        "quarantine_rate": ratio("(total_rows - clean_rows)", "total_rows"),
        "duplicate_rate": f"(1.0D - {unique})" if spec.business_key else literal(0.0),
        "volume_anomaly_ratio": ratio("smallest_period", "median_period", 1.0),
    }


def _fact(
    run_id: str,
    captured_at: str | None,
    rule: str,
    dimension: str,
    scope: str,
    severity: str,
    passed: str,
    measured: str,
    threshold: float | None,
) -> dict[str, str]:
    return {
        "run_id": literal(run_id),
        "rule": literal(rule),
        "dimension": literal(dimension),
        "scope": literal(scope),
        "severity": literal(severity),
        "passed": passed,
        "measured": measured,
        "threshold": null("DOUBLE") if threshold is None else literal(float(threshold)),
        "captured_at": instant(captured_at),
    }


def aggregate_records(
    spec: ProductSpec, run_id: str, captured_at: str | None
) -> list[dict[str, str]]:
    """One fact per aggregate rule, then the quarantine rate as information.

    A rule naming an unknown metric is skipped with a warning.
    """
    metrics = aggregate_metrics(spec)
    facts = []
    for rule in spec.aggregate_rules:
        measured = metrics.get(rule.metric)
        if measured is None:
            logger.warning("rule %s names unknown metric %s", rule.name, rule.metric)
            continue
        facts.append(
            _fact(
                run_id,
                captured_at,
                rule.name,
                rule.dimension,
                "aggregate",
                rule.severity,
                compare(measured, rule.threshold, rule.comparator),
                measured,
                rule.threshold,
            )
        )
    facts.append(
        _fact(
            run_id,
            captured_at,
            "hard_quarantine_rate",
            "accuracy",
            "aggregate",
            "warning",
            literal(True),
            metrics["quarantine_rate"],
            None,
        )
    )
    return facts


def soft_rate_records(
    rates: Mapping[str, str], spec: ProductSpec, run_id: str, captured_at: str | None
) -> list[dict[str, str]]:
    """Soft rules' pass rates as passed facts without a threshold, for runs without row results."""
    dimensions = {r.name: r.dimension for r in spec.row_rules}
    return [
        _fact(
            run_id,
            captured_at,
            name,
            dimensions.get(name, "validity"),
            "row",
            "warning",
            literal(True),
            rate,
            None,
        )
        for name, rate in rates.items()
    ]


def aggregate_rows(
    measures: DataFrame,
    spec: ProductSpec,
    run_id: str,
    captured_at: str | None = None,
    soft_rates: Mapping[str, str] | None = None,
) -> DataFrame:
    """Aggregate facts alone, with the soft pass rates when given."""
    return as_rows(
        measures,
        [
            *aggregate_records(spec, run_id, captured_at),
            *soft_rate_records(soft_rates or {}, spec, run_id, captured_at),
        ],
    )


def validation_rows(
    measures: DataFrame, spec: ProductSpec, run_id: str, captured_at: str | None = None
) -> DataFrame:
    """All facts of one run: every row rule, every aggregate rule, the quarantine rate.

    ``measures`` must hold the violations of ``spec.row_rules``.
    """
    return as_rows(
        measures,
        [
            *[row_rule_record(r, run_id, captured_at) for r in spec.row_rules],
            *aggregate_records(spec, run_id, captured_at),
        ],
    )


def merge_results(row_results: DataFrame, aggregate_results: DataFrame) -> DataFrame:
    """Stored facts of both kinds; a row result supersedes an aggregate one for the same rule.

    Both hold one row per rule and run.
    """
    keys = ["run_id", "rule"]
    kept = aggregate_results.join(row_results.select(keys), keys, "left_anti")
    return row_results.unionByName(kept)


def blocking(facts: DataFrame) -> DataFrame:
    """Failed aggregate rules of error severity: the ones that stop a run."""
    return facts.where("scope = 'aggregate' AND severity = 'error' AND NOT passed").select("rule")


def period_coverage(clean: DataFrame, period: str) -> DataFrame:
    """Number of distinct periods; NULL is a period of its own."""
    return clean.select(period).distinct().agg(F.expr("count(1) AS distinct_periods"))


def duplicate_rate(clean: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows, distinct keys and the share of rows beyond the first of their key; NULLs are equal.

    Keys are shuffled as their digests.
    """
    digest = clean.selectExpr(*[f"{sql} AS _key{i}" for i, sql in enumerate(digest_of(key))])
    keys = digest.groupBy("_key0", "_key1").agg(F.expr("count(1) AS n"))
    totals = keys.agg(
        F.expr("coalesce(sum(n), 0) AS clean_rows"), F.expr("count(1) AS distinct_keys")
    )
    unique = ratio("distinct_keys", "clean_rows", 1.0)
    return totals.selectExpr("*", f"1.0D - {unique} AS duplicate_rate")


def volume_ratio(clean: DataFrame, period: str) -> DataFrame:
    """Smallest period against the upper median of all periods; 1 when there are none."""
    volumes = clean.groupBy(period).agg(F.expr("count(1) AS n"))
    sizes = volumes.agg(
        F.expr("min(n) AS smallest_period"), F.expr(f"{upper_median('n')} AS median_period")
    )
    return sizes.selectExpr(
        "*", f"{ratio('smallest_period', 'median_period', 1.0)} AS volume_anomaly_ratio"
    )


def category_presence(clean: DataFrame, column: str, expected: Sequence[str]) -> DataFrame:
    """Expected and found categories; one passes only if it is both.

    The expected list joins the counts as zero-row entries of a union, so found and
    missing values need one aggregate.
    """
    found = clean.groupBy(F.col(column).alias("category")).agg(
        F.expr("count(1) AS n"), F.lit(False).alias("listed")
    )
    declared = as_rows(
        clean.sparkSession.range(1),
        [{"category": literal(c), "n": "0L", "listed": literal(True)} for c in expected],
    )
    merged = found.unionByName(declared).groupBy("category")
    return merged.agg(
        F.expr("sum(n) AS row_count"),
        F.expr("max(listed) AS expected"),
        F.expr("max(listed) AND sum(n) > 0 AS passed"),
    )


def fitness_measures(
    consumption: DataFrame, spec: ProductSpec, hourly: DataFrame | None = None
) -> dict[str, DataFrame]:
    """Readiness metrics, each a one-row ``measured`` frame.

    ``hourly`` is the table the hour coverage looks at, the consumption table by default.
    """
    hourly = consumption if hourly is None else hourly
    months = hours = _constant(consumption, 0.0)
    if {spec.category, spec.period} <= set(consumption.columns):
        fleet = consumption.where(F.col(spec.category) == spec.monthly_category)
        months = _distinct_values(fleet, quoted(spec.period))
    if spec.event_time in hourly.columns:
        if spec.period in hourly.columns:
            window = F.col(spec.period) == spec.hourly_period
        else:
            window = F.month(spec.event_time) == int(spec.hourly_period[-2:])
        hours = _distinct_values(hourly.where(window), f"hour({quoted(spec.event_time)})")
    present = set(spec.critical_columns) <= set(consumption.columns)
    return {
        "q1_month_count": months,
        "q2_hour_count": hours,
        "cde_columns_present": _constant(consumption, 1.0 if present else 0.0),
    }


def _distinct_values(df: DataFrame, value: str) -> DataFrame:
    """Number of distinct values as a double; NULL is a value of its own."""
    return df.selectExpr(value).distinct().agg(F.expr("CAST(count(1) AS DOUBLE) AS measured"))


def _constant(df: DataFrame, value: float) -> DataFrame:
    return df.sparkSession.range(1).selectExpr(f"{literal(value)} AS measured")


def fitness_rows(
    measures: Mapping[str, DataFrame],
    rules: Sequence[FitnessRule],
    run_id: str,
    captured_at: str | None = None,
) -> DataFrame:
    """One fact per fitness rule. A metric nobody measures counts as 0."""
    unmeasured = _constant(next(iter(measures.values())), 0.0)
    return reduce(
        DataFrame.unionByName,
        [
            as_rows(
                measures.get(rule.metric, unmeasured),
                [
                    {
                        "run_id": literal(run_id),
                        "use_case": literal(rule.use_case),
                        "rule": literal(rule.name),
                        "passed": compare("measured", rule.threshold, rule.comparator),
                        "measured": "measured",
                        "expected": literal(float(rule.threshold)),
                        "captured_at": instant(captured_at),
                    }
                ],
            )
            for rule in rules
        ],
    )


def blocking_fitness(facts: DataFrame, rules: Sequence[FitnessRule]) -> DataFrame:
    """Failed fitness rules of error severity."""
    errors = [r.name for r in rules if r.severity == "error"]
    return facts.where(~F.col("passed") & F.col("rule").isin(errors)).select("rule")


def schema_conformance(df: DataFrame, columns: Sequence[ColumnSpec]) -> DataFrame:
    """Declared columns against the data: presence, type, missing values, values off the list.

    One aggregate covers all columns. A missing column has NULL counts.
    """
    types = dict(df.dtypes)
    checks, facts = ["count(1) AS rows_scanned"], []
    for c in columns:
        present = c.name in types
        counts = dict.fromkeys(("missing", "off_list"), "0L" if present else null("BIGINT"))
        conditions = {}
        if present and c.required:
            conditions["missing"] = f"{quoted(c.name)} IS NULL"
        if present and c.enum:
            allowed = ", ".join(literal(v) for v in c.enum)
            conditions["off_list"] = f"{quoted(c.name)} NOT IN ({allowed})"
        for kind, condition in conditions.items():
            counts[kind] = quoted(f"{kind}_{c.name}")
            checks.append(f"count_if({condition}) AS {counts[kind]}")
        facts.append(
            {
                "column_name": literal(c.name),
                "declared_type": literal(c.type),
                "present": literal(present),
                "type_match": literal(types.get(c.name) in DECLARED_TYPES[c.type]),
                "null_violations": counts["missing"],
                "enum_violations": counts["off_list"],
                "rows_scanned": "rows_scanned",
            }
        )
    return as_rows(df.agg(*[F.expr(check) for check in checks]), facts)


def undeclared_outputs(
    published: Mapping[str, DataFrame], models: Mapping[str, Sequence[ColumnSpec]]
) -> DataFrame:
    """Published columns no model declares, with how many rows carry a value in them.

    Objects without a model have every column listed.
    """
    declared = {name: {c.name for c in columns} for name, columns in models.items()}
    parts = []
    for name, df in published.items():
        unknown = [c for c in df.columns if c not in declared.get(name, ())]
        if not unknown:
            continue
        counts = df.agg(*[F.expr(f"count({quoted(c)}) AS {quoted(c)}") for c in unknown])
        parts.append(
            as_rows(
                counts,
                [
                    {
                        "object": literal(name),
                        "column_name": literal(c),
                        "filled_rows": quoted(c),
                        "object_declared": literal(name in declared),
                    }
                    for c in unknown
                ],
            )
        )
    if not parts:
        spark = next(iter(published.values())).sparkSession
        columns = "object string, column_name string, filled_rows bigint, object_declared boolean"
        return spark.createDataFrame([], columns)
    return reduce(DataFrame.unionByName, parts)

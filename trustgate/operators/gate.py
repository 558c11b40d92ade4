"""The row gate: hard rules split rows, every rule is counted, nothing is lost."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trustgate.functions.expressions import (
    as_rows,
    dominant_dimension,
    fails,
    instant,
    literal,
    null,
    passes_all,
    quoted,
    ratio,
    require_rows,
    trail,
)
from trustgate.plans.spec import FailedRowsCheck, RowRule, SpecError

ENGINE = "trustgate"


class Gate(NamedTuple):
    """Everything the gate says about one input; each frame is a plan of its own."""

    clean: DataFrame
    quarantine: DataFrame
    summary: DataFrame
    outcomes: DataFrame


def hard_rules(rules: Sequence[RowRule]) -> list[RowRule]:
    hard = [r for r in rules if r.hard]
    if not hard:
        raise SpecError("a gate needs at least one hard rule")
    return hard


def accepted(rules: Sequence[RowRule]) -> str:
    """True for rows that pass every hard rule, false otherwise."""
    return passes_all(hard_rules(rules))


def flag_rules(df: DataFrame, rules: Sequence[RowRule], prefix: str = "fail_") -> DataFrame:
    """One boolean column per rule; true means the rule failed or could not be decided."""
    return df.selectExpr("*", *[f"{fails(r)} AS {quoted(prefix + r.name)}" for r in rules])


def clean_rows(df: DataFrame, rules: Sequence[RowRule]) -> DataFrame:
    """Rows passing every hard rule, input columns only.

    A filter already drops unknown outcomes, so the bare expressions are enough and
    can be pushed down to the scan.
    """
    return df.where(" AND ".join(f"({r.expression})" for r in hard_rules(rules)))


def trail_columns(
    rules: Sequence[RowRule], run_id: str, quarantined_at: str | None = None
) -> dict[str, str]:
    hard = hard_rules(rules)
    return {
        "dq_failed_rules": trail(hard),
        "dq_dominant_dimension": dominant_dimension(hard),
        "dq_run_id": literal(run_id),
        "dq_engine": literal(ENGINE),
        "dq_quarantined_at": instant(quarantined_at),
    }


def quarantine_rows(
    df: DataFrame, rules: Sequence[RowRule], run_id: str, quarantined_at: str | None = None
) -> DataFrame:
    """Rows failing any hard rule, with every failed rule, the first one's dimension and the run."""
    columns = trail_columns(rules, run_id, quarantined_at)
    return df.where(f"NOT {accepted(rules)}").selectExpr(
        "*", *[f"{sql} AS {name}" for name, sql in columns.items()]
    )


def mark(
    df: DataFrame, rules: Sequence[RowRule], run_id: str, quarantined_at: str | None = None
) -> DataFrame:
    """All rows with ``dq_quarantined`` and the trail columns, NULL on accepted rows.

    Written once, partitioned by ``dq_quarantined``, this one table serves clean and
    quarantine from a single pass over the input.
    """
    columns = trail_columns(rules, run_id, quarantined_at).items()
    return df.selectExpr("*", f"NOT {accepted(rules)} AS dq_quarantined").selectExpr(
        "*", *[f"CASE WHEN dq_quarantined THEN {sql} END AS {name}" for name, sql in columns]
    )


def violation_counts(rules: Sequence[RowRule]) -> list[Column]:
    """One aggregate per rule, named ``n_<rule>``; all are filled by the same pass."""
    return [F.expr(f"count_if({fails(r)}) AS {violations(r)}") for r in rules]


def violations(rule: RowRule) -> str:
    return quoted(f"n_{rule.name}")


def pass_rate(rule: RowRule) -> str:
    return ratio(f"(total_rows - {violations(rule)})", "total_rows")


def outcome(count: str, hard: bool) -> str:
    """A rule passes on zero violations; otherwise hard rules fail and soft rules warn."""
    return f"CASE WHEN {count} = 0 THEN 'pass' ELSE '{'fail' if hard else 'warn'}' END"


def _counted(df: DataFrame, rules: Sequence[RowRule]) -> DataFrame:
    return df.agg(F.expr("count(1) AS total_rows"), *violation_counts(rules))


def rule_stats(df: DataFrame, rules: Sequence[RowRule]) -> DataFrame:
    """Rows seen, violations and pass rate of every rule, hard and soft, from one aggregate."""
    return as_rows(
        _counted(df, rules),
        [
            {
                "rule": literal(r.name),
                "severity": literal(r.severity),
                "total_rows": "total_rows",
                "failed_rows": violations(r),
                "pass_rate": pass_rate(r),
            }
            for r in rules
        ],
    )


def gate_summary(df: DataFrame, rules: Sequence[RowRule]) -> DataFrame:
    """One row: rows in, clean, quarantined, the rate, and each soft rule's pass rate.

    An empty input fails the job.
    """
    soft = [r for r in rules if not r.hard]
    counts = df.agg(
        F.expr("count(1) AS total_rows"),
        F.expr(f"count_if({accepted(rules)}) AS clean_rows"),
        *violation_counts(soft),
    )
    quarantined = "(total_rows - clean_rows)"
    return counts.selectExpr(
        f"{require_rows('total_rows', 'empty input to the gate')} AS input_rows",
        "clean_rows",
        f"{quarantined} AS quarantine_rows",
        f"{ratio(quarantined, 'total_rows')} AS quarantine_rate",
        *[f"{pass_rate(r)} AS {quoted('pass_rate_' + r.name)}" for r in soft],
    )


def rule_outcomes(df: DataFrame, rules: Sequence[RowRule]) -> DataFrame:
    """Pass, fail or warn per rule, measured as its pass rate against a threshold of 1."""
    return as_rows(
        _counted(df, rules),
        [
            {
                "rule": literal(r.name),
                "dimension": literal(r.dimension),
                "severity": literal(r.severity),
                "outcome": outcome(violations(r), r.hard),
                "measured": pass_rate(r),
                "threshold": literal(1.0),
            }
            for r in rules
        ],
    )


def apply_gate(
    df: DataFrame, rules: Sequence[RowRule], run_id: str, quarantined_at: str | None = None
) -> Gate:
    """Clean and quarantined rows, which together are the input, its counts and each rule's outcome.

    A caller that uses several of the frames writes ``mark`` to a table and reads that.
    """
    return Gate(
        clean_rows(df, rules),
        quarantine_rows(df, rules, run_id, quarantined_at),
        gate_summary(df, rules),
        rule_outcomes(df, rules),
    )


def row_rule_record(rule: RowRule, run_id: str, captured_at: str | None) -> dict[str, str]:
    """The validation fact of one row rule. Soft rules report a rate and never block."""
    return {
        "run_id": literal(run_id),
        "rule": literal(rule.name),
        "dimension": literal(rule.dimension),
        "scope": literal("row"),
        "severity": literal(rule.severity),
        "passed": f"({violations(rule)} = 0)" if rule.hard else literal(True),
        "measured": pass_rate(rule),
        "threshold": literal(1.0),
        "captured_at": instant(captured_at),
    }


def failed_rows_scan(df: DataFrame, checks: Sequence[FailedRowsCheck]) -> DataFrame:
    """Rows matching each declared failure, all counted in one aggregate."""
    counts = df.agg(*[F.expr(f"count_if({c.condition}) AS {quoted(c.name)}") for c in checks])
    return as_rows(
        counts,
        [
            {
                "rule": literal(c.name),
                "severity": literal(c.severity),
                "failed_rows": quoted(c.name),
                "outcome": outcome(quoted(c.name), c.severity == "error"),
            }
            for c in checks
        ],
    )


def check_agreement(
    df: DataFrame, rules: Sequence[RowRule], checks: Sequence[FailedRowsCheck]
) -> DataFrame:
    """Per rule, rows on which the rule and the check of the same name disagree.

    A rule without a check, or a check without a rule, is reported with a NULL count.
    """
    by_rule = {r.name: r for r in rules}
    by_check = {c.name: c for c in checks}
    names = list(dict.fromkeys([*by_rule, *by_check]))
    paired = [n for n in names if n in by_rule and n in by_check]
    counts = df.agg(
        F.expr("count(1) AS total_rows"),
        *[
            F.expr(
                f"count_if(({fails(by_rule[n])}) <> coalesce(({by_check[n].condition}), false))"
                f" AS {quoted(n)}"
            )
            for n in paired
        ],
    )
    return as_rows(
        counts,
        [
            {
                "rule": literal(n),
                "has_rule": literal(n in by_rule),
                "has_check": literal(n in by_check),
                "compared_rows": "total_rows",
                "disagreeing_rows": quoted(n) if n in paired else null("BIGINT"),
            }
            for n in names
        ],
    )

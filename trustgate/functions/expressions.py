"""SQL expressions shared by the operators: rule outcomes, trails, comparators, rates, levels.

Rules are declared as SQL text, so what is built from them is SQL text too. One parsed
expression also costs the driver far less than the many calls that build the same tree.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame

from trustgate.plans.spec import COMPARATORS, RowRule, SpecError


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def literal(value: str | bool | int | float) -> str:
    match value:
        case bool():
            return "true" if value else "false"
        case int():
            return str(value)
        case float():
            return f"CAST({value!r} AS DOUBLE)"
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def null(kind: str) -> str:
    return f"CAST(NULL AS {kind})"


def instant(at: str | None) -> str:
    """The given instant, or the time of the query."""
    return "current_timestamp()" if at is None else f"CAST({literal(at)} AS TIMESTAMP)"


def passes(rule: RowRule) -> str:
    """True or false, never NULL: an unknown outcome does not pass."""
    return f"coalesce(({rule.expression}), false)"


def fails(rule: RowRule) -> str:
    return f"NOT {passes(rule)}"


def passes_all(rules: Sequence[RowRule]) -> str:
    return "(" + " AND ".join(passes(r) for r in rules) + ")"


def _per_failure(rules: Sequence[RowRule], values: Iterable[str]) -> str:
    return ", ".join(
        f"CASE WHEN {fails(r)} THEN {literal(v)} END" for r, v in zip(rules, values)
    )


def trail(rules: Sequence[RowRule]) -> str:
    """Names of the failing rules in declaration order, comma-separated."""
    return f"concat_ws(',', {_per_failure(rules, [r.name for r in rules])})"


def dominant_dimension(rules: Sequence[RowRule]) -> str:
    """Dimension of the first failing rule in declaration order."""
    return f"coalesce({_per_failure(rules, [r.dimension for r in rules])})"


# The sign of each comparator.
SIGNS = {"gte": ">=", "lte": "<=", "eq": "=", "gt": ">", "lt": "<"}


def compare(measured: str, threshold: float, comparator: str) -> str:
    if comparator not in COMPARATORS:
        raise SpecError(f"unknown comparator {comparator!r}")
    return f"({measured} {SIGNS[COMPARATORS[comparator]]} {literal(float(threshold))})"


def ratio(part: str, whole: str, empty: float = 0.0) -> str:
    """``part / whole`` as a double, ``empty`` when there is nothing to divide by."""
    quotient = f"try_divide(CAST({part} AS DOUBLE), CAST({whole} AS DOUBLE))"
    return f"coalesce({quotient}, {literal(empty)})"


def share_pct(part: str, whole: str, digits: int) -> str:
    """Rounded percentage, NULL when the whole is zero."""
    share = f"try_divide(CAST(100 AS DOUBLE) * {part}, CAST({whole} AS DOUBLE))"
    return f"round({share}, {digits})"


def rounded(value: str, digits: int) -> str:
    """Round half up, taking eight decimals first.

    The last digits of an average depend on the order of summation; they should not
    decide which way a tie goes.
    """
    return f"round(round({value}, 8), {digits})"


def require_rows(count: str, message: str) -> str:
    """The count itself; zero fails the job."""
    return (
        f"CASE WHEN {count} = 0 THEN CAST(raise_error({literal(message)}) AS BIGINT)"
        f" ELSE {count} END"
    )


def rate_level(rate: str) -> str:
    return f"CASE WHEN {rate} >= 0.95D THEN 'ok' WHEN {rate} >= 0.80D THEN 'warn' ELSE 'bad' END"


def gap_level(null_rate: str) -> str:
    return (
        f"CASE WHEN {null_rate} < 0.05D THEN 'ok' WHEN {null_rate} < 0.4D THEN 'warn'"
        " ELSE 'bad' END"
    )


# Age buckets of quarantined rows with their first and last day, youngest first.
# Whatever fits none of them falls into the last.
AGE_BUCKETS = (("today", 0, 0), ("1-3 days", 1, 3), ("4-7 days", 4, 7))
OLDEST_BUCKET = "8+ days"


def age_bucket(days: str) -> str:
    cases = " ".join(
        f"WHEN {days} BETWEEN {first} AND {last} THEN {literal(name)}"
        for name, first, last in AGE_BUCKETS
    )
    return f"CASE {cases} ELSE {literal(OLDEST_BUCKET)} END"


def bucket_rank(label: str) -> str:
    names = ", ".join(literal(name) for name in [*[b[0] for b in AGE_BUCKETS], OLDEST_BUCKET])
    return f"CAST(array_position(array({names}), {label}) AS INT)"


def as_rows(df: DataFrame, records: Iterable[Mapping[str, str]]) -> DataFrame:
    """One output row per record for every input row: a wide summary turned long.

    A record maps column names to SQL expressions; all records have the same columns.
    """
    structs = [
        "struct(" + ", ".join(f"{sql} AS {quoted(name)}" for name, sql in r.items()) + ")"
        for r in records
    ]
    return df.selectExpr(f"inline(array({', '.join(structs)}))")

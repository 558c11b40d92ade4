"""Consumer tables, the renamed interface and the two KPI tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trustgate.functions.expressions import instant, literal, quoted
from trustgate.plans.spec import KpiSpec, ProductSpec


def consumption(clean: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The published columns of the clean table."""
    return clean.select(*columns)


def renamed_interface(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """The same rows under other column names; no second copy."""
    return df.withColumnsRenamed(dict(names))


def _stamps(run_id: str, computed_at: str | None) -> list:
    return [
        F.expr(f"{literal(run_id)} AS run_id"),
        F.expr(f"{instant(computed_at)} AS computed_at"),
    ]


def monthly_average(
    df: DataFrame,
    value: str,
    run_id: str,
    period: str = "year_month",
    only: str = "true",
    computed_at: str | None = None,
) -> DataFrame:
    """Average and row count per period. Every row that cleared the gate counts, negatives too."""
    return (
        df.where(only)
        .groupBy(period)
        .agg(
            F.avg(value).alias(f"avg_{value}"),
            F.expr("count(1) AS trip_count"),
            *_stamps(run_id, computed_at),
        )
    )


def hourly_average(
    df: DataFrame,
    value: str,
    run_id: str,
    event_time: str = "pickup_datetime",
    only: str = "true",
    computed_at: str | None = None,
) -> DataFrame:
    """Average by hour of day, with the rows the average had to ignore."""
    return (
        df.where(only)
        .groupBy(F.hour(event_time).alias("pickup_hour"))
        .agg(
            F.avg(value).alias(f"avg_{value}"),
            F.expr("count(1) AS trip_count"),
            F.expr(f"count_if({quoted(value)} IS NULL) AS {quoted('null_' + value)}"),
            *_stamps(run_id, computed_at),
        )
    )


def kpi_cube(df: DataFrame, spec: ProductSpec) -> DataFrame:
    """All KPIs of a product from one scan: a grouping set for each, over the rows it asks for.

    ``kpi_rows`` takes a KPI's rows out of it. Groups are as few as the answers' rows, and one
    more for the rows that a KPI doesn't ask for.
    """
    columns, aggregates = [], []
    for i, kpi in enumerate(spec.kpis):
        columns.append(f"coalesce({kpi.condition(spec)}, false) AS _in{i}")
        aggregates += [
            F.expr(f"{sql} FILTER (WHERE _in{i}) AS {quoted(f'{i}_{name}')}")
            for name, sql in kpi.measures.items()
        ]
    keyed = df.selectExpr("*", *columns).selectExpr(
        "*",
        *[f"CASE WHEN _in{i} THEN {kpi.key} END AS _g{i}" for i, kpi in enumerate(spec.kpis)],
    )
    sets = [[F.col(f"_in{i}"), F.col(f"_g{i}")] for i in range(len(spec.kpis))]
    names = [name for i in range(len(spec.kpis)) for name in (f"_in{i}", f"_g{i}")]
    asked = " OR ".join(f"_in{i}" for i in range(len(spec.kpis)))
    return keyed.where(asked).groupingSets(sets, *names).agg(
        *aggregates,
        *[F.expr(f"grouping(_in{i}) = 0 AND _in{i} AS _of{i}") for i in range(len(spec.kpis))],
    )


def kpi_rows(
    cube: DataFrame, spec: ProductSpec, name: str, run_id: str, computed_at: str | None = None
) -> DataFrame:
    """One KPI's table from the cube, stamped with the run."""
    i, kpi = next((i, k) for i, k in enumerate(spec.kpis) if k.name == name)
    return cube.where(f"_of{i}").select(
        F.col(f"_g{i}").alias(kpi.grain),
        *[F.col(f"{i}_{measure}").alias(measure) for measure in kpi.measures],
        *_stamps(run_id, computed_at),
    )


def completeness(
    kpi: DataFrame, name: str, exactly: int | None = None, at_least: int | None = None
) -> DataFrame:
    """Row count of a KPI table against the count its question needs."""
    if (exactly is None) == (at_least is None):
        raise ValueError("give either the exact or the least number of rows")
    needed, sign = (exactly, "=") if at_least is None else (at_least, ">=")
    return kpi.agg(F.expr("count(1) AS row_count")).selectExpr(
        f"{literal(name)} AS kpi",
        "row_count",
        f"{needed}L AS needed",
        f"row_count {sign} {needed} AS passed",
    )


def extremes(kpi: DataFrame, value: str, key: str) -> DataFrame:
    """Unweighted mean of a KPI's rows and its highest and lowest row.

    Equal values go to the smaller key.
    """
    v, k = quoted(value), quoted(key)
    found = kpi.where(f"{v} IS NOT NULL").agg(
        F.expr(f"avg({v}) AS overall"),
        F.expr(f"min(struct(-{v} AS o, {k} AS key, {v} AS value)) AS high"),
        F.expr(f"min(struct({v} AS value, {k} AS key)) AS low"),
    )
    return found.selectExpr(
        "overall",
        "high.key AS high_key",
        "high.value AS high_value",
        "low.key AS low_key",
        "low.value AS low_value",
    )

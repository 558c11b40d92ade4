"""Profiles: row counts, null rates and numeric ranges of declared columns, in long form."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trustgate.functions.expressions import as_rows, instant, literal, null, quoted, ratio
from trustgate.plans.spec import ProfileSpec

NUMERIC = (T.IntegerType, T.LongType, T.FloatType, T.DoubleType)


@dataclass(frozen=True)
class Layer:
    """A layer of one table: the rows it keeps and, if narrower, the columns it shows."""

    name: str
    table: str
    keeps: str | None = None
    columns: tuple[str, ...] | None = None


#: Fixed value: the partition key of missing values, as in the folders of partitioned tables.
MISSING = "__HIVE_DEFAULT_PARTITION__"


def profile(
    df: DataFrame,
    spec: ProfileSpec,
    run_id: str,
    layer: str,
    table: str,
    captured_at: str | None = None,
    partition: str | None = None,
) -> DataFrame:
    """Profile one table; with ``partition``, one profile per value of that column."""
    return profile_layers(df, spec, run_id, [Layer(layer, table)], captured_at, partition)


def profile_layers(
    df: DataFrame,
    spec: ProfileSpec,
    run_id: str,
    layers: Sequence[Layer],
    captured_at: str | None = None,
    partition: str | None = None,
) -> DataFrame:
    """Profile several layers that are row subsets of one table, in one aggregate.

    Every layer's figures are filtered aggregates of the same pass; layers keeping the
    same rows share them. Declared columns a layer lacks are skipped and figures that are
    NULL are left out.
    """
    conditions = list(dict.fromkeys(layer.keeps for layer in layers))
    flags = {sql: f"_keep{i}" for i, sql in enumerate(conditions) if sql is not None}
    flagged = df.selectExpr("*", *[f"{sql} AS {flag}" for sql, flag in flags.items()])

    aggregates: dict[str, str] = {}

    def figure(function: str, argument: str, layer: Layer) -> str:
        """The name of an aggregate over a layer's rows, declared once for equal row sets."""
        condition = f" FILTER (WHERE {flags[layer.keeps]})" if layer.keeps is not None else ""
        sql = f"{function}({argument}){condition}"
        return aggregates.setdefault(sql, f"f{len(aggregates)}")

    facts = []
    for layer in layers:

        def fact(column: str, metric: str, value: str, layer: Layer = layer) -> None:
            facts.append(
                {
                    "run_id": literal(run_id),
                    "layer": literal(layer.name),
                    "table_name": literal(layer.table),
                    "column_name": literal(column),
                    "metric": literal(metric),
                    "metric_value": f"CAST({value} AS DOUBLE)",
                    "partition_key": "_partition" if partition else null("STRING"),
                    "captured_at": instant(captured_at),
                }
            )

        rows = figure("count", "1", layer)
        if "row_count" in spec.metrics:
            fact("*", "row_count", rows)
        shown = set(df.columns if layer.columns is None else layer.columns) & set(df.columns)
        for name in (c for c in spec.columns if c in shown):
            if "null_rate" in spec.metrics:
                filled = figure("count", quoted(name), layer)
                fact(name, "null_rate", ratio(f"({rows} - {filled})", rows))
            if isinstance(df.schema[name].dataType, NUMERIC):
                for metric in ("min", "max", "avg"):
                    if metric in spec.metrics:
                        fact(name, metric, figure(metric, quoted(name), layer))

    columns = [F.expr(f"{sql} AS {name}") for sql, name in aggregates.items()]
    if partition:
        # Without a name of its own, the missing value's profile would read as the whole table's.
        key = F.expr(f"coalesce(CAST({quoted(partition)} AS STRING), {literal(MISSING)})")
        key = key.alias("_partition")
        wide = flagged.groupBy(key).agg(*columns)
    else:
        wide = flagged.agg(*columns)
    return as_rows(wide, facts).where("metric_value IS NOT NULL")

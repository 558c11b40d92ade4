"""One pass over a gated table from which a run's counts, facts, profiles and presence follow.

``statistics`` yields a row per outcome, period, known category and pattern of failed rules: few
rows, whatever the table's size. Everything else sums those rows up. Only distinct keys and the
values of an unknown category need passes of their own, over their columns alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trustgate.functions.expressions import as_rows, instant, literal, null, quoted, ratio
from trustgate.operators.gate import violations
from trustgate.operators.metrics import digest_of, failure_pattern, upper_median
from trustgate.operators.profile import MISSING, NUMERIC, Layer
from trustgate.plans.spec import ProductSpec, ProfileSpec, RowRule

#: Rejected, period, the category if it is a declared one, failed rules.
GROUPS = ("dq_quarantined", "_period", "_category", "_fails")


def _columns(df: DataFrame, spec: ProfileSpec) -> list[str]:
    return [c for c in spec.columns if c in df.columns]


def statistics(gated: DataFrame, spec: ProductSpec) -> DataFrame:
    """Counts, filled values, smallest, largest and summed values per group (``GROUPS``).

    Categories that the product doesn't declare share one NULL, so a column full of wrong values
    yields no more groups than a clean one.
    """
    declared = ", ".join(literal(c) for c in spec.expected_categories)
    category = quoted(spec.category)
    known = f"CASE WHEN {category} IN ({declared}) THEN {category} END" if declared else null("STRING")
    numeric = [
        c for c in _columns(gated, spec.profile) if isinstance(gated.schema[c].dataType, NUMERIC)
    ]
    figures = ["count(1) AS n"]
    for i, column in enumerate(_columns(gated, spec.profile)):
        figures.append(f"count({quoted(column)}) AS filled{i}")
        if column in numeric:
            value = f"CAST({quoted(column)} AS DOUBLE)"
            figures += [f"{f}({value}) AS {f}{i}" for f in ("min", "max", "sum")]
    grouped = gated.selectExpr(
        "*",
        f"{quoted(spec.period)} AS _period",
        f"{known} AS _category",
        f"{failure_pattern(spec.row_rules)} AS _fails",
    ).groupBy(*GROUPS)
    return grouped.agg(*[F.expr(figure) for figure in figures])


def distinct_keys(gated: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row: the number of distinct keys of accepted rows. Only digests of keys are shuffled."""
    if not key:
        return gated.sparkSession.range(1).selectExpr("0L AS distinct_keys")
    clean = gated.where("NOT dq_quarantined")
    digests = clean.selectExpr(*[f"{sql} AS _key{i}" for i, sql in enumerate(digest_of(key))])
    return digests.distinct().agg(F.expr("count(1) AS distinct_keys"))


def as_measures(stats: DataFrame, keys: DataFrame, rules: Sequence[RowRule]) -> DataFrame:
    """The row that ``metrics.measure`` yields, from statistics and the number of distinct keys."""
    per_period = stats.groupBy("dq_quarantined", "_period").agg(
        F.expr("sum(n) AS n"),
        *[
            F.expr(f"sum(n) FILTER (WHERE substr(_fails, {i}, 1) = 'f') AS {violations(r)}")
            for i, r in enumerate(rules, 1)
        ],
    )
    sums = {
        "total_rows": "sum(n)",
        "clean_rows": "sum(_clean_n)",
        **{violations(r): f"sum({violations(r)})" for r in rules},
    }
    one = per_period.selectExpr("*", "CASE WHEN NOT dq_quarantined THEN n END AS _clean_n").agg(
        *[F.expr(f"coalesce({total}, 0) AS {name}") for name, total in sums.items()],
        F.expr("count(_clean_n) AS periods"),
        F.expr("min(_clean_n) AS smallest_period"),
        F.expr(f"{upper_median('_clean_n')} AS median_period"),
    )
    return one.withColumn("distinct_keys", keys.scalar())


def as_profile(
    stats: DataFrame,
    columns: Sequence[str],
    spec: ProfileSpec,
    run_id: str,
    layers: Sequence[Layer],
    captured_at: str | None = None,
    by_period: bool = False,
) -> DataFrame:
    """Profiles of layers, as ``profile.profile_layers`` gives them, from statistics.

    columns: those of the table the statistics are of. A layer's ``keeps`` may only ask for
    ``dq_quarantined``. With ``by_period`` a second grouping set adds every period's facts to
    those of the whole.
    """
    have = [c for c in spec.columns if c in columns]
    facts, figures = [], {}

    def figure(function: str, column: str, layer: Layer) -> str:
        keeps = f" FILTER (WHERE {layer.keeps})" if layer.keeps else ""
        return figures.setdefault(f"{function}({column}){keeps}", f"f{len(figures)}")

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
                    "partition_key": "_partition",
                    "captured_at": instant(captured_at),
                }
            )

        rows = f"coalesce({figure('sum', 'n', layer)}, 0)"
        if "row_count" in spec.metrics:
            fact("*", "row_count", rows)
        for i, name in enumerate(have):
            if layer.columns is not None and name not in layer.columns:
                continue
            filled = f"coalesce({figure('sum', f'filled{i}', layer)}, 0)"
            if "null_rate" in spec.metrics:
                fact(name, "null_rate", ratio(f"({rows} - {filled})", rows))
            if f"min{i}" in stats.columns:
                for metric in ("min", "max"):
                    if metric in spec.metrics:
                        fact(name, metric, figure(metric, f"{metric}{i}", layer))
                if "avg" in spec.metrics:
                    total = figure("sum", f"sum{i}", layer)
                    fact(name, "avg", f"try_divide({total}, {filled})")
    aggregates = [F.expr(f"{sql} AS {name}") for sql, name in figures.items()]
    if by_period:
        label = F.expr(f"coalesce(CAST(_period AS STRING), {literal(MISSING)})")
        period = stats.withColumn("_p", label)
        wide = period.groupingSets([[], [F.col("_p")]], "_p").agg(
            *aggregates, F.expr("CASE WHEN grouping(_p) = 0 THEN _p END AS _partition")
        )
    else:
        wide = stats.agg(*aggregates).withColumn("_partition", F.expr(null("STRING")))
    return as_rows(wide, facts).where("metric_value IS NOT NULL")


def wrong_categories(
    stats: DataFrame, gated: DataFrame, spec: ProductSpec, top: int = 10
) -> tuple[str, ...]:
    """What is wrong with the categories of accepted rows, in a report of bounded length.

    Declared categories without a row, then the ``top`` most frequent values that are not declared
    (NULL among them), then how many further values there are and in how many rows. The values
    are counted only where statistics show that there are any; each task passes on counts, and
    the driver gets ``top`` rows and two sums.
    """
    if not spec.expected_categories:
        return ()
    clean = stats.where("NOT dq_quarantined")
    held = {r["_category"]: r["n"] for r in clean.groupBy("_category").agg(F.sum("n").alias("n")).collect()}
    wrong = [c for c in spec.expected_categories if c not in held]
    if None in held:
        declared = [literal(c) for c in spec.expected_categories]
        off = f"{quoted(spec.category)} IS NULL OR {quoted(spec.category)} NOT IN ({', '.join(declared)})"
        values = (
            gated.where("NOT dq_quarantined")
            .where(off)
            .groupBy(F.col(spec.category).alias("category"))
            .agg(F.expr("count(1) AS n"))
        )
        most = values.orderBy(F.desc("n"), F.asc_nulls_first("category")).limit(top).collect()
        wrong += ["NULL" if r["category"] is None else str(r["category"]) for r in most]
        rest = held[None] - sum(r["n"] for r in most)
        if rest:
            distinct = values.agg(F.expr("count(1) AS n")).first()["n"]
            further = f"{spec.category}: {distinct - len(most)} further values in {rest} rows"
            return (*[f"{spec.category}={c}" for c in sorted(wrong)], further)
    return tuple(f"{spec.category}={c}" for c in sorted(wrong))

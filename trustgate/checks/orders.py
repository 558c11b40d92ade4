"""A second product over the order table: other columns, names, periods and questions."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trustgate.checks.binding import table
from trustgate.functions.expressions import literal, rounded
from trustgate.plans.run import Run, Store, lineage, run_product
from trustgate.plans.spec import (
    AggregateRule,
    FeedSpec,
    FitnessRule,
    KpiSpec,
    ProductSpec,
    ProfileSpec,
    RowRule,
)
from trustgate.sources import feeds, tables

COLUMNS = ("order_id", "customer", "amount", "ordered_at", "channel", "year")
YEARS = ("1995", "1996", "1997", "1998", "1999", "2000", "2001")
RUN, AT = "orders-1", "2024-02-08 06:00:00"

ORDERS = ProductSpec(
    table="orders",
    interface="orders_named",
    feeds=(
        FeedSpec(
            "store",
            {"order_id": "key", "customer": "buyer", "amount": "total", "ordered_at": "day"},
        ),
        FeedSpec(
            "web",
            {"order_id": "id", "customer": "account", "amount": "paid", "ordered_at": "placed"},
            table="web_orders",
        ),
    ),
    row_rules=(
        RowRule("customer_present", "completeness", "error", "customer IS NOT NULL"),
        RowRule("amount_positive", "accuracy", "error", "amount > 0"),
        RowRule("amount_usual", "validity", "warning", "amount < 300000"),
    ),
    aggregate_rules=(
        AggregateRule(
            "year_coverage", "completeness", "distinct_year_month", len(YEARS), "gte", "error"
        ),
        AggregateRule("repeats", "uniqueness", "duplicate_rate", 0.01, "lte", "warning"),
        AggregateRule("volume", "timeliness", "volume_anomaly_ratio", 0.9, "gte", "warning"),
    ),
    fitness_rules=(
        FitnessRule("columns_present", "cde_columns_present", 1.0, "eq"),
        FitnessRule("store_years", "q1_month_count", len(YEARS), "gte", use_case="yearly"),
    ),
    profile=ProfileSpec(COLUMNS, ("row_count", "null_rate", "max")),
    business_key=("customer", "ordered_at"),
    event_time="ordered_at",
    period="year",
    period_format="yyyy",
    category="channel",
    expected_categories=("store", "web"),
    critical_columns=("order_id", "amount"),
    consumption_columns=COLUMNS,
    renamed_columns={"order_id": "number"},
    periods=YEARS,
    drifting_types={"total": "double"},
    monthly_category="store",
    kpis=(
        KpiSpec(
            "amount_per_year",
            "year",
            {"avg_amount": "avg(amount)", "orders": "count(1)"},
            exactly="periods",
        ),
        KpiSpec(
            "web_per_month",
            "month",
            {"largest": "max(amount)", "orders": "count(1)"},
            grain_sql="month(ordered_at)",
            only="channel = 'web'",
            at_least=12,
        ),
    ),
)

# The canonical record in terms of the order table, and who orders on the web.
VALUES = {
    "order_id": "o_orderkey",
    "customer": "CASE WHEN o_orderkey % 97 <> 0 THEN o_custkey END",
    "amount": "CASE WHEN o_orderkey % 53 = 0 THEN -o_totalprice ELSE o_totalprice END",
    "ordered_at": "o_orderdate",
}
WEB = "o_custkey % 3 = 0"
TEXT_YEAR = "1997"


def landing(spark: SparkSession, sf_dir: str) -> str:
    """Both feeds as yearly parts; store totals are text in one year, and the others doubles."""
    orders = table(spark, sf_dir, "orders")
    root = tables.shared_dir(spark)
    for feed in ORDERS.feeds:
        rows = orders.where(WEB if feed.label == "web" else f"NOT ({WEB})").selectExpr(
            *[f"{VALUES[name]} AS {source}" for name, source in feed.columns.items()],
            "date_format(o_orderdate, 'yyyy') AS period",
        )
        odd = F.col("period") == TEXT_YEAR
        parts = [rows]
        if feed.label == "store":
            text = rows.where(odd).withColumn("total", F.col("total").cast("string"))
            parts = [rows.where(~odd), text]
        for part in parts:
            part.write.mode("append").partitionBy("period").parquet(f"{root}/{feed.label}")
    return root + "/{feed}/period={period}"


def _item(df: DataFrame, name: str, item: str, value: str, passed: str) -> DataFrame:
    return df.selectExpr(
        f"{literal(name)} AS object",
        f"CAST({item} AS STRING) AS item",
        f"CAST({value} AS DOUBLE) AS measured",
        f"CAST({passed} AS BOOLEAN) AS passed",
    )


def orders_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All jobs for the second product: the rows of each table, every fact, every KPI value."""
    store = Store(prefix=f"tg_{uuid.uuid4().hex}_", location=tables.shared_dir(spark))
    results = run_product(spark, ORDERS, store, RUN, landing(spark, sf_dir), AT)
    blocked = [(r.job, r.blocked_by) for r in results if not r.ok]
    if blocked:
        raise RuntimeError(f"run blocked: {blocked}")
    run = Run(spark, ORDERS, store, RUN)
    yearly, monthly = (run.table("consumption", kpi.name) for kpi in ORDERS.kpis)
    profiled = run.facts("data_profile").where("layer = 'consumption'")
    return feeds.union_parts(
        [
            _item(lineage(run), "rows", "object", "row_count", "NULL"),
            _item(run.facts("dq_validation_result"), "rule", "rule", "measured", "passed"),
            _item(run.facts("fitness_for_use_result"), "fitness", "rule", "measured", "passed"),
            _item(profiled, "profile", "concat_ws('.', column_name, metric)", "metric_value", "NULL"),
            _item(yearly, "avg_amount", "year", rounded("avg_amount", 4), "NULL"),
            _item(yearly, "year_orders", "year", "orders", "NULL"),
            _item(monthly, "largest", "month", "largest", "NULL"),
            _item(monthly, "web_orders", "month", "orders", "NULL"),
        ]
    )


def oracle_sql() -> str:
    """The same figures in one SQL text over the order table."""
    rows = """
feed AS MATERIALIZED (
  SELECT o_orderkey AS order_id, CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE o_custkey END AS customer,
         o_totalprice * (CASE WHEN o_orderkey % 53 = 0 THEN -1 ELSE 1 END) AS amount,
         o_orderdate AS ordered_at, if(o_custkey % 3 = 0, 'web', 'store') AS channel,
         strftime(o_orderdate, '%Y') AS year
  FROM orders),
clean AS MATERIALIZED (SELECT * FROM feed WHERE customer IS NOT NULL AND amount > 0),
years AS (SELECT year, count(*) AS n FROM clean GROUP BY year),
totals AS (
  SELECT (SELECT count(*) FROM feed)::DOUBLE AS f, (SELECT count(*) FROM clean)::DOUBLE AS c,
         (SELECT count(*) FROM (SELECT DISTINCT customer, ordered_at FROM clean))::DOUBLE AS k,
         (SELECT count(*) FROM years)::DOUBLE AS y, (SELECT min(n) FROM years)::DOUBLE AS low,
         (SELECT list_sort(list(n))[len(list(n)) // 2 + 1] FROM years)::DOUBLE AS mid)"""
    none = "NULL::BOOLEAN"
    counted = {
        "raw.store_raw": "feed WHERE channel = 'store'",
        "raw.web_orders": "feed WHERE channel = 'web'",
        "clean.orders": "clean",
        "clean.orders_quarantine": "feed WHERE customer IS NULL OR amount <= 0",
        "consumption.orders": "clean",
    }
    parts = [
        f"SELECT 'rows' AS object, '{name}' AS item, count(*)::DOUBLE AS measured, {none} AS passed FROM {source}"
        for name, source in counted.items()
    ]
    rules = {
        "customer_present": "customer IS NOT NULL",
        "amount_positive": "amount > 0",
        "amount_usual": "amount < 300000",
    }
    for name, holds in rules.items():
        share = f"count(*) FILTER (WHERE {holds}) / count(*)::DOUBLE"
        # A rule that only scores always counts as passed.
        passed = "true" if name == "amount_usual" else f"coalesce(bool_and({holds}), true)"
        parts.append(f"SELECT 'rule', '{name}', {share}, {passed} FROM feed")
    for name, value, passed in (
        ("year_coverage", "y", f"y >= {len(YEARS)}"),
        ("repeats", "1.0::DOUBLE - k / c", "1.0::DOUBLE - k / c <= 0.01"),
        ("volume", "low / mid", "low / mid >= 0.9"),
        ("hard_quarantine_rate", "(f - c) / f", "true"),
    ):
        parts.append(f"SELECT 'rule', '{name}', {value}, {passed} FROM totals")
    parts.append("SELECT 'fitness', 'columns_present', 1.0::DOUBLE, true")
    parts.append(
        "SELECT 'fitness', 'store_years', count(DISTINCT year)::DOUBLE, count(DISTINCT year) >= "
        f"{len(YEARS)} FROM clean WHERE channel = 'store'"
    )
    parts.append(f"SELECT 'profile', '*.row_count', count(*)::DOUBLE, {none} FROM clean")
    for column in COLUMNS:
        gap = f"count(*) FILTER (WHERE {column} IS NULL) / count(*)::DOUBLE"
        parts.append(f"SELECT 'profile', '{column}.null_rate', {gap}, {none} FROM clean")
    for column in ("order_id", "customer", "amount"):
        parts.append(f"SELECT 'profile', '{column}.max', max({column})::DOUBLE, {none} FROM clean")
    average = "round(round(avg(amount), 8), 4)"
    parts += [
        f"SELECT 'avg_amount', year, {average}, {none} FROM clean GROUP BY year",
        f"SELECT 'year_orders', year, n::DOUBLE, {none} FROM years",
        f"SELECT 'largest', month(ordered_at)::VARCHAR, max(amount), {none} FROM clean"
        " WHERE channel = 'web' GROUP BY 2",
        f"SELECT 'web_orders', month(ordered_at)::VARCHAR, count(*)::DOUBLE, {none} FROM clean"
        " WHERE channel = 'web' GROUP BY 2",
    ]
    return f"WITH {rows}\n" + "\nUNION ALL ".join(parts)

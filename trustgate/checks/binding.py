"""Trip feeds derived from the order tables, and ride hours derived from the event table.

The test tables hold no missing values, so key arithmetic puts some in. Every row of
``lineitem`` and ``events`` takes part.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trustgate.plans import taxi
from trustgate.plans.spec import AggregateRule, FeedSpec, FitnessRule, ProductSpec, ProfileSpec

# The window of the bound data and the two runs the governance queries look at.
WINDOW = "year_month BETWEEN '1995-01' AND '2001-07'"
EARLIER_WINDOW = "year_month BETWEEN '1995-01' AND '1999-12'"
PERIODS = tuple(
    f"{year}-{month:02d}" for year in range(1995, 2002) for month in range(1, 13)
    if (year, month) <= (2001, 7)
)
MONTHS = len(PERIODS)
HOURLY_PERIOD = "2024-01"
YEARS = ("1995", "1996", "1997", "1998", "1999", "2000", "2001")
RUN_EARLIER, RUN_LATEST = "run-9f", "run-2c"
AT_EARLIER, AT_LATEST = "2024-02-01 06:00:00", "2024-02-08 06:00:00"
RUN_UNVALIDATED, AT_UNVALIDATED = "run-7e", "2024-02-09 06:00:00"
AS_OF = "2024-02-10"
#: The hour that the full run's trips begin at, and the period whose hours it looks at.
HOUR = "(l_partkey + 5 * l_linenumber) % 24"
RUN_PERIOD = "1996-03"
SEED = "42"

STATUS = {"yellow": "F", "green": "O"}
LABEL = "CASE l_linestatus WHEN 'F' THEN 'yellow' WHEN 'O' THEN 'green' END"

FEEDS = tuple(
    replace(feed, carry=("trip_id",), label_override="fleet_override")
    for feed in (taxi.YELLOW, taxi.GREEN)
)

SPEC: ProductSpec = replace(
    taxi.TAXI_TRIPS.with_rule("year_month_in_window", WINDOW),
    feeds=FEEDS,
    aggregate_rules=(
        AggregateRule(
            "month_coverage", "completeness", "distinct_year_month", MONTHS, "gte", "error"
        ),
        *taxi.AGGREGATE_RULES[1:],
    ),
    fitness_rules=(
        FitnessRule(
            "q1_months_present",
            "q1_month_count",
            MONTHS,
            "eq",
            use_case="Q1_yellow_avg_total_amount_by_month",
        ),
        FitnessRule(
            "q2_hours_coverage",
            "q2_hour_count",
            20,
            "gte",
            use_case="Q2_avg_passenger_count_by_hour",
        ),
        taxi.FITNESS_RULES[2],
    ),
    checks=tuple(
        replace(c, condition=f"year_month IS NULL OR NOT ({WINDOW})")
        if c.name == "year_month_in_window"
        else c
        for c in taxi.CHECKS
    ),
    profile=ProfileSpec(taxi.CONSUMPTION_COLUMNS),
    business_key=("taxi_type", "vendor_id", "pickup_datetime"),
    periods=PERIODS,
    parts=YEARS,
    hourly_period=HOURLY_PERIOD,
)
EARLIER_SPEC: ProductSpec = SPEC.with_rule("year_month_in_window", EARLIER_WINDOW)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# The canonical record in terms of the joined order tables.
TRIP_VALUES = {
    "trip_id": "concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber)",
    "vendor_id": "CASE WHEN l_partkey % 211 <> 0 THEN CAST(l_linenumber AS BIGINT) END",
    "passenger_count": "CASE WHEN l_suppkey % 10 <> 0 THEN CAST(l_quantity % 8 AS DOUBLE) END",
    "total_amount": (
        "CASE WHEN l_partkey % 307 = 0 THEN NULL"
        " WHEN l_returnflag = 'R' THEN -l_extendedprice ELSE l_extendedprice END"
    ),
    "pickup_datetime": "CASE WHEN l_orderkey % 401 <> 0 THEN o_orderdate END",
    "dropoff_datetime": (
        "CASE WHEN l_orderkey % 503 = 0 THEN NULL WHEN l_orderkey % 20 = 0 THEN l_shipdate"
        " ELSE greatest(l_shipdate, o_orderdate) END"
    ),
    "fleet_override": "CASE WHEN l_partkey % 997 = 0 THEN 'pink' END",
}
#: The values that need no order.
OF_A_LINE = ("vendor_id", "passenger_count", "total_amount")


def joined(spark: SparkSession, sf_dir: str, *order_columns: str) -> DataFrame:
    """Lines with their orders, and with columns computed from the orders before the join."""
    orders = table(spark, sf_dir, "orders").selectExpr("o_orderkey", "o_orderdate", *order_columns)
    lineitem = table(spark, sf_dir, "lineitem")
    return lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))


def raw_feed(spark: SparkSession, sf_dir: str, feed: FeedSpec) -> DataFrame:
    """One feed under its own column names."""
    rows = joined(spark, sf_dir).where(F.col("l_linestatus") == STATUS[feed.label])
    values = rows.selectExpr(*[f"{sql} AS {name}" for name, sql in TRIP_VALUES.items()])
    return values.withColumnsRenamed(dict(feed.columns))


def raw_feeds(spark: SparkSession, sf_dir: str) -> list[tuple[DataFrame, FeedSpec]]:
    return [(raw_feed(spark, sf_dir, feed), feed) for feed in FEEDS]


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The canonical record of both feeds, reading and joining the tables once.

    Equal to the union of the two feeds; there both feeds are slices of one table, so
    the label is taken from the slice's own column. Formatting a date is the dearest
    expression here, so it is done once per order and not for each line and rule. What a
    line alone decides is worked out before the join: fewer columns cross its shuffle.
    """
    month = "date_format(o_orderdate, 'yyyy-MM') AS order_month"
    orders = table(spark, sf_dir, "orders").selectExpr("o_orderkey", "o_orderdate", month)
    lineitem = table(spark, sf_dir, "lineitem")
    lines = lineitem.where(F.col("l_linestatus").isin(*STATUS.values())).selectExpr(
        *("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate"),
        *[f"{TRIP_VALUES[name]} AS {name}" for name in OF_A_LINE],
        f"coalesce({TRIP_VALUES['fleet_override']}, {LABEL}) AS taxi_type",
    )
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).selectExpr(
        *[
            name if name in OF_A_LINE else f"{sql} AS {name}"
            for name, sql in TRIP_VALUES.items()
            if name != "fleet_override"
        ],
        "taxi_type",
        "CASE WHEN l_orderkey % 401 <> 0 THEN order_month END AS year_month",
    )


def rides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as rides with a time of day: order dates are all midnight."""
    return table(spark, sf_dir, "events").selectExpr(
        "event_id AS ride_id",
        "ts AS pickup_datetime",
        "CASE WHEN event_id % 9 <> 0 THEN CAST(event_id % 8 AS DOUBLE) END AS passenger_count",
        "date_format(ts, 'yyyy-MM') AS year_month",
    )

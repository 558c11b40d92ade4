"""Every operator as a query over the test tables, by key.

A query builds its plan from the tables it is given. Where several readers need one
result, or an operator is about writing, it goes through a table in shared storage.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from dataclasses import replace
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trustgate.checks import binding as b
from trustgate.checks import orders
from trustgate.functions import expressions
from trustgate.functions.expressions import as_rows, literal, require_rows
from trustgate.operators import gate, governance, harmonize, marts, metrics, profile, triage
from trustgate.plans import taxi
from trustgate.plans.run import Run, Store, lineage, run_product
from trustgate.plans.spec import ProductSpec, ProfileSpec
from trustgate.sources import feeds, tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

RULES = b.SPEC.row_rules
RUNS = (
    (b.EARLIER_SPEC, b.RUN_EARLIER, b.AT_EARLIER),
    (b.SPEC, b.RUN_LATEST, b.AT_LATEST),
)
#: KPIs and fitness facts also hold a newer run without validation facts: it must not be read.
WITH_UNVALIDATED = (*RUNS, (b.EARLIER_SPEC, b.RUN_UNVALIDATED, b.AT_UNVALIDATED))
MODELS = Path(__file__).with_name("models")


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.expr(expressions.rounded(c, digits)) for c in columns})


def instants_as_text(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in columns})


def union(parts: Iterable[DataFrame]) -> DataFrame:
    return feeds.union_parts(parts)


def contents(df: DataFrame, name: str, item: str, value: str) -> DataFrame:
    """A published table's cells: one row per item with its value."""
    return df.selectExpr(
        f"{literal(name)} AS object", f"{item} AS item", f"CAST({value} AS DOUBLE) AS measured"
    )


def kpi_contents(monthly: DataFrame, hourly: DataFrame) -> DataFrame:
    average = expressions.rounded
    return union(
        [
            contents(monthly, taxi.KPI_MONTHLY, "year_month", average("avg_total_amount", 4)),
            contents(
                hourly,
                taxi.KPI_HOURLY,
                "CAST(pickup_hour AS STRING)",
                average("avg_passenger_count", 6),
            ),
        ]
    )


def scratch_schema(spark: SparkSession) -> str:
    schema = f"tg_{uuid.uuid4().hex}"
    tables.ensure_namespaces(spark, [schema], tables.shared_dir(spark))
    return schema


def stored(runs: Iterable[DataFrame]) -> DataFrame:
    """The facts of several runs as a table, for reads that look at them more than once.

    They are written by one job, in which a later run reuses the first one's shuffles.
    """
    return tables.staged(union(runs))


def stored_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trips without their ids as a table, for queries that read them in many ways.

    Readers push filters and columns of their own below the join, so they can't share its
    shuffle; the table is written from one.
    """
    return tables.staged(b.trips(spark, sf_dir).drop("trip_id"))


def trips_or(rows: DataFrame | None, spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.trips(spark, sf_dir) if rows is None else rows


def clean(
    spark: SparkSession, sf_dir: str, spec: ProductSpec = b.SPEC, rows: DataFrame | None = None
) -> DataFrame:
    return gate.clean_rows(trips_or(rows, spark, sf_dir), spec.row_rules)


def published(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.consumption(clean(spark, sf_dir), b.SPEC.consumption_columns)


def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarantine of the latest run."""
    return gate.quarantine_rows(b.trips(spark, sf_dir), RULES, b.RUN_LATEST, b.AT_LATEST)


def quarantines(
    spark: SparkSession, sf_dir: str, rows: DataFrame | None = None
) -> DataFrame:
    """Quarantine of both runs."""
    return union(
        gate.quarantine_rows(trips_or(rows, spark, sf_dir), spec.row_rules, run, at)
        for spec, run, at in RUNS
    )


def validation_of(
    spark: SparkSession,
    sf_dir: str,
    spec: ProductSpec,
    run: str,
    at: str,
    rows: DataFrame | None = None,
) -> DataFrame:
    measures = metrics.measure(
        trips_or(rows, spark, sf_dir), spec, gate.accepted(spec.row_rules), spec.row_rules
    )
    return metrics.validation_rows(measures, spec, run, at)


def validations(
    spark: SparkSession, sf_dir: str, rows: DataFrame | None = None
) -> list[DataFrame]:
    return [validation_of(spark, sf_dir, *run, rows) for run in RUNS]


def profiles(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Profiles of the three layers for both runs."""
    return [
        profile.profile_layers(
            b.trips(spark, sf_dir),
            product.profile,
            run,
            [
                profile.Layer("raw", "taxi_trips_projected"),
                profile.Layer("clean", "taxi_trips", gate.accepted(product.row_rules)),
                profile.Layer(
                    "consumption",
                    "taxi_trips",
                    gate.accepted(product.row_rules),
                    product.consumption_columns,
                ),
            ],
            at,
        )
        for product, run, at in RUNS
    ]


def all_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles of both runs' layers and, in the same table, of the latest one by period."""
    by_period = profile.profile(
        b.trips(spark, sf_dir),
        b.SPEC.profile,
        b.RUN_LATEST,
        "raw",
        "taxi_trips_projected",
        b.AT_LATEST,
        "year_month",
    )
    return union([*profiles(spark, sf_dir), by_period])


def validated_run(
    spark: SparkSession, sf_dir: str, rows: DataFrame | None = None
) -> DataFrame:
    """The latest run by the validation facts, which all run-scoped reads go by."""
    return governance.latest_run(union(validations(spark, sf_dir, rows)))


def daily_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ride counts of a run per day, captured with the day's last ride; ids don't sort by time."""
    rides = b.rides(spark, sf_dir)
    run = F.reverse(F.date_format("pickup_datetime", "yyyyMMdd")).alias("run_id")
    return rides.groupBy(run).agg(
        F.count(F.lit(1)).alias("measured"), F.max("pickup_datetime").alias("captured_at")
    )


def ride_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row count of the rides in every run: the shortest profile, from file footers alone."""
    counted = ProfileSpec((), ("row_count",))
    return union(
        profile.profile(b.rides(spark, sf_dir), counted, run, "consumption", "rides", at)
        for _, run, at in RUNS
    )


def captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return triage.run_captures(ride_counts(spark, sf_dir))


def fitness_facts(spark: SparkSession, sf_dir: str, runs=RUNS) -> list[DataFrame]:
    return [
        metrics.fitness_rows(
            metrics.fitness_measures(
                marts.consumption(clean(spark, sf_dir, spec), spec.consumption_columns),
                spec,
                b.rides(spark, sf_dir),
            ),
            spec.fitness_rules,
            run,
            at,
        )
        for spec, run, at in runs
    ]


def monthly_kpi(
    spark: SparkSession,
    sf_dir: str,
    spec: ProductSpec = b.SPEC,
    run: str = b.RUN_LATEST,
    at: str = b.AT_LATEST,
    rows: DataFrame | None = None,
) -> DataFrame:
    return marts.monthly_average(
        clean(spark, sf_dir, spec, rows),
        "total_amount",
        run,
        only=f"taxi_type = '{spec.monthly_category}'",
        computed_at=at,
    )


def hourly_kpi(
    spark: SparkSession, sf_dir: str, run: str = b.RUN_LATEST, at: str = b.AT_LATEST
) -> DataFrame:
    return marts.hourly_average(
        b.rides(spark, sf_dir),
        "passenger_count",
        run,
        only=f"year_month = '{b.HOURLY_PERIOD}'",
        computed_at=at,
    )


# Feeds and tables


DRIFT_YEAR = "1998"


def landing(spark: SparkSession, sf_dir: str, hour: str = "0") -> str:
    """Write both feeds as yearly parts and return the path template of a part.

    ``hour`` is added to both ends of a trip: order dates alone are all midnight.

    Parts before 1998 hold vendors as doubles and whole passenger counts, and lack the
    surcharge; later parts hold the surcharge as text. The tables are joined once; the
    parts are written from the stored result, which lies in their order already.
    """
    keys = ["feed", "period"]
    values = dict(b.TRIP_VALUES)
    for end in ("pickup_datetime", "dropoff_datetime"):
        values[end] += f" + make_interval(0, 0, 0, 0, CAST({hour} AS INT))"
    rows = tables.staged(
        b.joined(spark, sf_dir).selectExpr(
            f"{b.LABEL} AS feed",
            "date_format(o_orderdate, 'yyyy') AS period",
            *[f"{sql} AS {name}" for name, sql in values.items()],
            "CAST(l_tax AS STRING) AS congestion_surcharge",
        ),
        keys,
    )
    root = tables.shared_dir(spark)
    for feed in b.FEEDS:
        own = rows.where(F.col("feed") == feed.label).withColumnsRenamed(dict(feed.columns))
        early = feeds.align_types(
            own.where(F.col("period") < DRIFT_YEAR).drop("congestion_surcharge"),
            {"VendorID": "double", "passenger_count": "bigint"},
        )
        late = own.where(F.col("period") >= DRIFT_YEAR)
        for part in (early, late):
            part.write.mode("append").partitionBy(*keys).parquet(root)
    return root + "/feed={feed}/period={period}"


def landed(spark: SparkSession, sf_dir: str) -> list[tuple[str, DataFrame]]:
    template = landing(spark, sf_dir)
    return [
        (
            feed.label,
            feeds.read_feed(spark, template, feed.label, b.YEARS, b.SPEC.drifting_types),
        )
        for feed in b.FEEDS
    ]


@query
def feed_scan(spark, sf_dir):
    return union(
        df.select(
            F.lit(name).alias("feed"),
            "trip_id",
            "VendorID",
            "passenger_count",
            "total_amount",
            "congestion_surcharge",
        )
        for name, df in landed(spark, sf_dir)
    )


@query
def feed_provenance(spark, sf_dir):
    raw = union(feeds.with_provenance(df, name) for name, df in landed(spark, sf_dir))
    part = F.regexp_extract("source_file", r"feed=\w+/period=\d+", 0)
    return raw.groupBy("taxi_type_hint", part.alias("part")).agg(
        F.count(F.lit(1)).alias("row_count"), F.count("ingest_ts").alias("stamped_rows")
    )


@query
def align_types(spark, sf_dir):
    drifted = b.table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        F.col("l_suppkey").cast("string").alias("VendorID"),
        F.col("l_quantity").cast("string").alias("passenger_count"),
        F.col("l_tax").cast("string").alias("Airport_fee"),
    )
    return feeds.align_types(drifted, taxi.DRIFTING_TYPES)


@query
def union_feeds(spark, sf_dir):
    return union(
        feeds.with_provenance(df, feed.label).drop("ingest_ts")
        for df, feed in b.raw_feeds(spark, sf_dir)
    )


@query
def feed_counts(spark, sf_dir):
    return union(
        df.agg(F.expr("count(1) AS n")).selectExpr(
            f"'{feed.label}' AS feed",
            require_rows("n", f"feed {feed.label} is empty") + " AS row_count",
        )
        for df, feed in b.raw_feeds(spark, sf_dir)
    )


@query
def write_roundtrip(spark, sf_dir):
    root = tables.shared_dir(spark)
    schema = f"tg_{uuid.uuid4().hex}"
    tables.ensure_namespaces(spark, [schema], root)
    name = tables.qualified(schema, "taxi_trips")
    tables.write_table(quarantine(spark, sf_dir), name)
    tables.write_table(clean(spark, sf_dir), name, ["year_month"])
    return spark.table(name)


@query
def governance_append(spark, sf_dir):
    facts = stored(validations(spark, sf_dir))
    earlier, latest = (facts.where(F.col("run_id") == run) for _, run, _ in RUNS)
    path = tables.shared_dir(spark)
    tables.append_facts(earlier.drop("threshold"), path)
    tables.append_facts(latest, path)
    return tables.read_facts(spark, path).drop("captured_at")


MONTHLY_SQL = """
SELECT year_month, COUNT(*) AS trip_count, MIN(total_amount) AS min_amount,
       MAX(total_amount) AS max_amount, :run_id AS run_id
FROM {trips}
WHERE taxi_type = :fleet
GROUP BY year_month
"""


@query
def model_params(spark, sf_dir):
    params = {"run_id": b.RUN_LATEST, "fleet": "green"}
    return tables.model_frame(spark, MONTHLY_SQL, params, {"trips": clean(spark, sf_dir)})


@query
def rerun_facts(spark, sf_dir):
    """The scorecard after a run was repeated under another rule: only its second attempt counts."""
    name = tables.qualified(scratch_schema(spark), "dq_validation_result")
    attempts = (RUNS[0], (b.EARLIER_SPEC, b.RUN_LATEST, b.AT_EARLIER), RUNS[1])
    facts = stored(
        validation_of(spark, sf_dir, *each).withColumn("attempt", F.lit(i))
        for i, each in enumerate(attempts)
    )
    for i, (_, run, _) in enumerate(attempts):
        own = facts.where(F.col("attempt") == i).drop("attempt")
        tables.replace_facts(own, name, {"run_id": run})
    return governance.scorecard(spark.table(name))


@query
def model_folder(spark, sf_dir):
    """The rows of every table published from a folder of SQL files."""
    params = {"run_id": b.RUN_LATEST, "fleet": "yellow"}
    frames = {"trips": clean(spark, sf_dir)}
    names = tables.publish_tables(
        spark, tables.load_models(MODELS), scratch_schema(spark), params, frames
    )
    return union(
        spark.table(n).withColumn("model", F.lit(n.rpartition(".")[2])) for n in names
    )


@query
def publish_all(spark, sf_dir):
    """Rows of all published tables and views, and every value of the KPI tables."""
    schema = scratch_schema(spark)
    base = tables.qualified(schema, "taxi_trips")
    tables.write_table(published(spark, sf_dir), base, ["year_month"])
    trips = spark.table(base)
    kpis = {
        taxi.KPI_MONTHLY: lambda: marts.monthly_average(
            trips, "total_amount", b.RUN_LATEST, only="taxi_type = 'yellow'"
        ),
        taxi.KPI_HOURLY: lambda: hourly_kpi(spark, sf_dir),
    }
    renamed = ", ".join(
        f"{c} AS {b.SPEC.renamed_columns.get(c, c)}" for c in b.SPEC.consumption_columns
    )
    tables.publish_tables(spark, kpis, schema)
    tables.publish_views(spark, {"vw_taxi_trips_tlc": f"SELECT {renamed} FROM {base}"}, schema)
    made = {
        name: spark.table(tables.qualified(schema, name))
        for name in ("taxi_trips", "vw_taxi_trips_tlc", *kpis)
    }
    counts = governance.layer_counts(made).selectExpr(
        "object", "'*' AS item", "CAST(row_count AS DOUBLE) AS measured"
    )
    return counts.unionByName(kpi_contents(made[taxi.KPI_MONTHLY], made[taxi.KPI_HOURLY]))


@query
def product_run(spark, sf_dir):
    """All jobs from landing parts to KPIs: the rows of each table, every fact, every KPI value."""
    spec = replace(b.SPEC, hourly_period=b.RUN_PERIOD)
    store = Store(prefix=f"tg_{uuid.uuid4().hex}_", location=tables.shared_dir(spark))
    template = landing(spark, sf_dir, b.HOUR)
    results = run_product(spark, spec, store, b.RUN_LATEST, template, captured_at=b.AT_LATEST)
    blocked = [(r.job, r.blocked_by) for r in results if not r.ok]
    if blocked:
        raise RuntimeError(f"run blocked: {blocked}")
    run = Run(spark, spec, store, b.RUN_LATEST)
    profiled, validated, fit = (
        run.facts(name)
        for name in ("data_profile", "dq_validation_result", "fitness_for_use_result")
    )
    kpis = [run.table("consumption", name) for name in (taxi.KPI_MONTHLY, taxi.KPI_HOURLY)]
    values = union(
        [
            lineage(run).selectExpr(
                "object", "'*' AS item", "CAST(row_count AS DOUBLE) AS measured"
            ),
            contents(
                profiled,
                "data_profile",
                "concat_ws('.', layer, column_name, metric)",
                expressions.rounded("metric_value", 5),
            ),
            kpi_contents(*kpis),
        ]
    ).withColumn("passed", F.lit(None).cast("boolean"))
    judged = [
        facts.select(F.lit(name).alias("object"), F.col("rule").alias("item"), "measured", "passed")
        for name, facts in (("dq_validation_result", validated), ("fitness_for_use_result", fit))
    ]
    return union([values, *judged])


QUERIES["orders_run"] = orders.orders_run


# Projection and the gate


@query
def canonical(spark, sf_dir):
    return harmonize.canonical(b.raw_feeds(spark, sf_dir), b.SPEC)


@query
def consumption(spark, sf_dir):
    return published(spark, sf_dir)


@query
def view_rename(spark, sf_dir):
    return marts.renamed_interface(published(spark, sf_dir), b.SPEC.renamed_columns)


@query
def interface_sample(spark, sf_dir):
    """Ten rows of the renamed interface; the values stand in the order of all columns."""
    names = b.SPEC.renamed_columns
    renamed = marts.renamed_interface(published(spark, sf_dir), names)
    order = [names.get(c, c) for c in ("total_amount", "pickup_datetime", "dropoff_datetime")]
    return triage.ordered_sample(renamed, [*order, "VendorID", "passenger_count"], 10).select(
        "VendorID", "passenger_count", "total_amount", *order[1:]
    )


@query
def rule_fail_flags(spark, sf_dir):
    flagged = gate.flag_rules(b.trips(spark, sf_dir), RULES)
    return flagged.select("trip_id", *[f"fail_{r.name}" for r in RULES])


@query
def gate_clean(spark, sf_dir):
    return clean(spark, sf_dir)


@query
def gate_quarantine(spark, sf_dir):
    return quarantine(spark, sf_dir).drop("dq_quarantined_at")


@query
def quarantine_trail(spark, sf_dir):
    return quarantine(spark, sf_dir).select("trip_id", "dq_failed_rules", "dq_dominant_dimension")


@query
def rule_stats(spark, sf_dir):
    return gate.rule_stats(b.trips(spark, sf_dir), RULES)


@query
def gate_summary(spark, sf_dir):
    return gate.gate_summary(b.trips(spark, sf_dir), RULES)


@query
def rule_outcomes(spark, sf_dir):
    return gate.rule_outcomes(b.trips(spark, sf_dir), RULES)


@query
def validation_result(spark, sf_dir):
    return validation_of(spark, sf_dir, *RUNS[1]).drop("captured_at")


@query
def merged_results(spark, sf_dir):
    """Row results and aggregate results stored apart, merged with the row results ahead."""
    measures = tables.staged(
        metrics.measure(b.trips(spark, sf_dir), b.SPEC, gate.accepted(RULES), RULES)
    )
    rates = {r.name: gate.pass_rate(r) for r in b.SPEC.soft_rules}
    rows = as_rows(
        measures, [gate.row_rule_record(r, b.RUN_LATEST, b.AT_LATEST) for r in RULES]
    )
    aggregate = metrics.aggregate_rows(measures, b.SPEC, b.RUN_LATEST, b.AT_LATEST, rates)
    return metrics.merge_results(rows, aggregate).drop("captured_at")


@query
def failed_rows_checks(spark, sf_dir):
    return gate.failed_rows_scan(b.trips(spark, sf_dir), b.SPEC.checks)


@query
def check_agreement(spark, sf_dir):
    return gate.check_agreement(b.trips(spark, sf_dir), RULES, b.SPEC.checks)


# Aggregate rules, fitness, schema


@query
def month_coverage(spark, sf_dir):
    return metrics.period_coverage(clean(spark, sf_dir), "year_month")


@query
def duplicate_rate(spark, sf_dir):
    return metrics.duplicate_rate(clean(spark, sf_dir), b.SPEC.business_key)


@query
def volume_sanity(spark, sf_dir):
    return metrics.volume_ratio(clean(spark, sf_dir), "year_month")


@query
def aggregate_rules(spark, sf_dir):
    soft = b.SPEC.soft_rules
    measures = metrics.measure(b.trips(spark, sf_dir), b.SPEC, gate.accepted(RULES), soft)
    rates = {r.name: gate.pass_rate(r) for r in soft}
    facts = metrics.aggregate_rows(measures, b.SPEC, b.RUN_LATEST, b.AT_LATEST, rates)
    return facts.drop("captured_at")


@query
def category_presence(spark, sf_dir):
    return metrics.category_presence(
        b.trips(spark, sf_dir), "taxi_type", b.SPEC.expected_categories
    )


@query
def fitness(spark, sf_dir):
    facts = governance.fitness_summary(union(fitness_facts(spark, sf_dir)))
    return instants_as_text(facts, "captured_at")


@query
def kpi_completeness(spark, sf_dir):
    return marts.completeness(
        monthly_kpi(spark, sf_dir), taxi.KPI_MONTHLY, exactly=b.MONTHS
    ).unionByName(
        marts.completeness(hourly_kpi(spark, sf_dir), taxi.KPI_HOURLY, at_least=b.SPEC.min_hours)
    )


@query
def schema_conformance(spark, sf_dir):
    return metrics.schema_conformance(b.trips(spark, sf_dir), taxi.TRIP_COLUMNS)


@query
def undeclared_outputs(spark, sf_dir):
    outputs = {
        "taxi_trips": clean(spark, sf_dir),
        "taxi_trips_quarantine": quarantine(spark, sf_dir),
        taxi.KPI_MONTHLY: monthly_kpi(spark, sf_dir),
    }
    return metrics.undeclared_outputs(outputs, b.SPEC.models)


# Profiles


def _profile_query(spark, sf_dir, partition=None):
    facts = profile.profile(
        b.trips(spark, sf_dir),
        b.SPEC.profile,
        b.RUN_LATEST,
        "raw",
        "taxi_trips_projected",
        b.AT_LATEST,
        partition,
    )
    return rounded(facts.drop("captured_at"), 5, "metric_value")


def profile_raw(spark, sf_dir):
    return _profile_query(spark, sf_dir)


QUERIES["profile"] = profile_raw


@query
def profile_layers(spark, sf_dir):
    latest = profiles(spark, sf_dir)[1]
    return rounded(latest.drop("captured_at"), 5, "metric_value")


@query
def profile_by_partition(spark, sf_dir):
    return _profile_query(spark, sf_dir, "year_month")


@query
def profile_latest(spark, sf_dir):
    facts = governance.profile_latest(stored(profiles(spark, sf_dir)))
    return instants_as_text(rounded(facts, 5, "metric_value"), "captured_at")


@query
def profile_matrix(spark, sf_dir):
    wide = governance.profile_matrix(all_profiles(spark, sf_dir))
    return rounded(wide, 5, "null_rate", "min", "avg", "max")


@query
def profile_preferred(spark, sf_dir):
    wide = governance.preferred_layer(all_profiles(spark, sf_dir))
    return rounded(wide, 5, "min", "avg", "max")


@query
def layer_rows(spark, sf_dir):
    return governance.layer_rows(all_profiles(spark, sf_dir))


@query
def worst_null_rates(spark, sf_dir):
    return governance.worst_gaps(all_profiles(spark, sf_dir))


# KPIs


@query
def kpi_monthly_avg(spark, sf_dir):
    kpi = monthly_kpi(spark, sf_dir).drop("computed_at")
    return rounded(kpi, 4, "avg_total_amount").orderBy("year_month")


@query
def kpi_hourly_avg(spark, sf_dir):
    kpi = hourly_kpi(spark, sf_dir).drop("computed_at")
    return rounded(kpi, 6, "avg_passenger_count").orderBy("pickup_hour")


@query
def kpi_latest_run(spark, sf_dir):
    kpis = union(monthly_kpi(spark, sf_dir, *run) for run in WITH_UNVALIDATED)
    found = governance.kpi_of_run(
        kpis, validated_run(spark, sf_dir), "avg_total_amount", 2, "year_month"
    )
    return instants_as_text(found, "computed_at")


@query
def kpi_null_share(spark, sf_dir):
    kpis = union(hourly_kpi(spark, sf_dir, run, at) for _, run, at in WITH_UNVALIDATED)
    run = validated_run(spark, sf_dir)
    return governance.kpi_null_share(kpis.drop("computed_at"), run, "passenger_count")


@query
def kpi_extremes(spark, sf_dir):
    monthly = marts.extremes(monthly_kpi(spark, sf_dir), "avg_total_amount", "year_month")
    hourly = marts.extremes(
        hourly_kpi(spark, sf_dir).withColumn(
            "pickup_hour", F.lpad(F.col("pickup_hour").cast("string"), 2, "0")
        ),
        "avg_passenger_count",
        "pickup_hour",
    )
    both = monthly.withColumn("kpi", F.lit(taxi.KPI_MONTHLY)).unionByName(
        hourly.withColumn("kpi", F.lit(taxi.KPI_HOURLY))
    )
    return rounded(both, 4, "overall", "high_value", "low_value")


# Governance views and run-scoped reads


@query
def scorecard(spark, sf_dir):
    return governance.scorecard(union(validations(spark, sf_dir)))


@query
def scorecard_latest_run(spark, sf_dir):
    facts = stored(validations(spark, sf_dir))
    return governance.scorecard_of_run(facts, governance.latest_run(facts))


@query
def latest_run(spark, sf_dir):
    return governance.latest_run(daily_facts(spark, sf_dir))


@query
def run_list(spark, sf_dir):
    runs = governance.run_list(daily_facts(spark, sf_dir))
    return instants_as_text(runs, "last_captured")


@query
def failed_rules(spark, sf_dir):
    facts = stored(validations(spark, sf_dir))
    return governance.failed_rules(facts, governance.latest_run(facts))


@query
def rule_detail(spark, sf_dir):
    facts = stored(validations(spark, sf_dir))
    return governance.rule_detail(facts, governance.latest_run(facts))


@query
def reliability_rollup(spark, sf_dir):
    facts = governance.reliability(union(validations(spark, sf_dir)), cap=0.05)
    return rounded(facts, 6, "mean_pass_rate")


@query
def fitness_latest_run(spark, sf_dir):
    facts = stored(fitness_facts(spark, sf_dir, WITH_UNVALIDATED))
    return governance.fitness_of_run(facts, validated_run(spark, sf_dir))


@query
def fitness_rollup(spark, sf_dir):
    return governance.fitness_rollup(union(fitness_facts(spark, sf_dir)))


@query
def layer_counts(spark, sf_dir):
    """Quarantine and KPI tables hold all runs; those of the latest validated one are counted."""
    rows = stored_trips(spark, sf_dir)
    run = validated_run(spark, sf_dir, rows)
    marked = gate.mark(rows, RULES, b.RUN_LATEST, b.AT_LATEST)
    parts = {
        "canonical.yellow": "taxi_type = 'yellow'",
        "canonical.green": "taxi_type = 'green'",
        "clean.taxi_trips": "NOT dq_quarantined",
        "consumption.taxi_trips": "NOT dq_quarantined",
    }
    monthly = union(monthly_kpi(spark, sf_dir, *each, rows) for each in WITH_UNVALIDATED)
    hourly = union(hourly_kpi(spark, sf_dir, each, at) for _, each, at in WITH_UNVALIDATED)
    scoped = {
        "clean.taxi_trips_quarantine": governance.of_run(
            quarantines(spark, sf_dir, rows), run, "dq_run_id"
        ),
        f"consumption.{taxi.KPI_MONTHLY}": governance.of_run(monthly, run),
        f"consumption.{taxi.KPI_HOURLY}": governance.of_run(hourly, run),
    }
    return governance.counts_where(marked, parts).unionByName(governance.layer_counts(scoped))


@query
def quarantine_pct(spark, sf_dir):
    rows = stored_trips(spark, sf_dir)
    run = validated_run(spark, sf_dir, rows)
    quarantined = governance.of_run(quarantines(spark, sf_dir, rows), run, "dq_run_id")
    return governance.quarantine_share(clean(spark, sf_dir, rows=rows), quarantined)


# Triage


@query
def incident_top_rules(spark, sf_dir):
    return triage.top_reasons(triage.incident_counts(quarantines(spark, sf_dir)), k=3)


@query
def reasons_latest_run(spark, sf_dir):
    own = governance.of_run(quarantines(spark, sf_dir), validated_run(spark, sf_dir), "dq_run_id")
    return triage.top_reasons(triage.incident_counts(own))


@query
def incident_enriched(spark, sf_dir):
    incidents = triage.incident_counts(quarantines(spark, sf_dir))
    declared = [r for r in RULES if r.name != "year_month_in_window"]
    return triage.enrich(incidents, governance.rule_catalogue(spark, declared))


@query
def incident_sample(spark, sf_dir):
    rows = triage.ordered_sample(quarantine(spark, sf_dir), ["trip_id"], 25)
    return rows.select(
        "trip_id",
        "taxi_type",
        "vendor_id",
        "pickup_datetime",
        "dropoff_datetime",
        "passenger_count",
        "total_amount",
        "dq_failed_rules",
        "dq_run_id",
    )


@query
def quarantine_ageing(spark, sf_dir):
    ages = triage.ageing(quarantines(spark, sf_dir), captures(spark, sf_dir), b.AS_OF)
    return instants_as_text(ages, "quarantined_since")


@query
def age_buckets(spark, sf_dir):
    return triage.age_buckets(quarantines(spark, sf_dir), captures(spark, sf_dir), b.AS_OF)


@query
def stratified_sample(spark, sf_dir):
    drawn = triage.stratified_sample(quarantines(spark, sf_dir), b.SEED, ["trip_id"])
    aged = triage.with_age(drawn, captures(spark, sf_dir), b.AS_OF)
    return instants_as_text(aged, "quarantined_at").select(
        "trip_id",
        *b.SPEC.consumption_columns,
        "dq_run_id",
        "dq_failed_rules",
        "dq_dominant_dimension",
        "quarantined_at",
        "days_in_quarantine",
    )

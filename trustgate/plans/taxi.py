"""The taxi trip product: two feeds, ten row rules, four aggregate rules, three fitness rules."""

from __future__ import annotations

from trustgate.plans.spec import (
    AggregateRule,
    ColumnSpec,
    FailedRowsCheck,
    FeedSpec,
    FitnessRule,
    KpiSpec,
    ProductSpec,
    ProfileSpec,
    RowRule,
)

# Everything below states the product's policy.

PERIODS = ("2023-01", "2023-02", "2023-03", "2023-04", "2023-05")

FEED_PATH = "{feed}_tripdata_{period}.parquet"

DRIFTING_TYPES = {
    "passenger_count": "double",
    "RatecodeID": "double",
    "congestion_surcharge": "double",
    "airport_fee": "double",
    "VendorID": "bigint",
    "PULocationID": "bigint",
    "DOLocationID": "bigint",
    "payment_type": "bigint",
    "trip_type": "bigint",
}

YELLOW = FeedSpec(
    label="yellow",
    table="yellow_tripdata",
    columns={
        "vendor_id": "VendorID",
        "passenger_count": "passenger_count",
        "total_amount": "total_amount",
        "pickup_datetime": "tpep_pickup_datetime",
        "dropoff_datetime": "tpep_dropoff_datetime",
    },
)
GREEN = FeedSpec(
    label="green",
    table="green_tripdata",
    columns={
        "vendor_id": "VendorID",
        "passenger_count": "passenger_count",
        "total_amount": "total_amount",
        "pickup_datetime": "lpep_pickup_datetime",
        "dropoff_datetime": "lpep_dropoff_datetime",
    },
)

ROW_RULES = (
    RowRule("total_amount_non_negative", "accuracy", "warning",
            "total_amount IS NOT NULL AND total_amount >= 0"),
    RowRule("dropoff_after_pickup", "consistency", "error", "dropoff_datetime >= pickup_datetime"),
    RowRule("vendor_id_not_null", "completeness", "error", "vendor_id IS NOT NULL"),
    RowRule("total_amount_not_null", "completeness", "error", "total_amount IS NOT NULL"),
    RowRule("pickup_not_null", "completeness", "error", "pickup_datetime IS NOT NULL"),
    RowRule("dropoff_not_null", "completeness", "error", "dropoff_datetime IS NOT NULL"),
    RowRule("taxi_type_valid", "validity", "error", "taxi_type IN ('yellow', 'green')"),
    RowRule("year_month_in_window", "completeness", "error",
            "year_month IN ('2023-01','2023-02','2023-03','2023-04','2023-05')"),
    RowRule("passenger_count_range", "validity", "warning",
            "passenger_count IS NOT NULL AND passenger_count BETWEEN 1 AND 6"),
    RowRule("vendor_id_enum", "validity", "warning", "vendor_id IN (1, 2)"),
)

# Amounts below zero may be refunds and missing passenger counts are common: removing those rows
# would bias the averages, so these two rules may never turn hard.
MANDATORY_RULES = {
    "dropoff_after_pickup": "error",
    "vendor_id_not_null": "error",
    "total_amount_not_null": "error",
    "pickup_not_null": "error",
    "dropoff_not_null": "error",
    "taxi_type_valid": "error",
    "year_month_in_window": "error",
    "passenger_count_range": "warning",
    "total_amount_non_negative": "warning",
}

CHECKS = (
    FailedRowsCheck("dropoff_after_pickup",
                    "dropoff_datetime IS NULL OR pickup_datetime IS NULL"
                    " OR dropoff_datetime < pickup_datetime"),
    FailedRowsCheck("vendor_id_not_null", "vendor_id IS NULL"),
    FailedRowsCheck("total_amount_not_null", "total_amount IS NULL"),
    FailedRowsCheck("pickup_not_null", "pickup_datetime IS NULL"),
    FailedRowsCheck("dropoff_not_null", "dropoff_datetime IS NULL"),
    FailedRowsCheck("taxi_type_valid",
                    "taxi_type IS NULL OR taxi_type NOT IN ('yellow', 'green')"),
    FailedRowsCheck("year_month_in_window",
                    "year_month IS NULL OR year_month NOT IN"
                    " ('2023-01','2023-02','2023-03','2023-04','2023-05')"),
    FailedRowsCheck("total_amount_non_negative",
                    "total_amount IS NULL OR total_amount < 0", "warning"),
    FailedRowsCheck("passenger_count_range",
                    "passenger_count IS NULL OR NOT (passenger_count BETWEEN 1 AND 6)", "warning"),
    FailedRowsCheck("vendor_id_enum", "vendor_id IS NULL OR vendor_id NOT IN (1, 2)", "warning"),
)

AGGREGATE_RULES = (
    AggregateRule("month_coverage", "completeness", "distinct_year_month", 5, "gte", "error"),
    AggregateRule("quarantine_rate_cap", "accuracy", "quarantine_rate", 0.05, "lte"),
    AggregateRule("uniqueness_rate", "uniqueness", "duplicate_rate", 0.01, "lte"),
    AggregateRule("volume_sanity", "completeness", "volume_anomaly_ratio", 0.5, "gte"),
)

FITNESS_RULES = (
    FitnessRule("q1_months_present", "q1_month_count", 5, "eq",
                use_case="Q1_yellow_avg_total_amount_by_month"),
    FitnessRule("q2_hours_coverage", "q2_hour_count", 20, "gte",
                use_case="Q2_may_avg_passenger_count_by_hour"),
    FitnessRule("consumption_schema_cdes", "cde_columns_present", 1, "eq",
                use_case="consumption_contract"),
)

CONSUMPTION_COLUMNS = (
    "vendor_id",
    "passenger_count",
    "total_amount",
    "pickup_datetime",
    "dropoff_datetime",
    "taxi_type",
    "year_month",
)

TRIP_COLUMNS = (
    ColumnSpec("vendor_id", "long", required=True),
    ColumnSpec("passenger_count", "double"),
    ColumnSpec("total_amount", "double", required=True),
    ColumnSpec("pickup_datetime", "timestamp", required=True),
    ColumnSpec("dropoff_datetime", "timestamp", required=True),
    ColumnSpec("taxi_type", "string", required=True, enum=("yellow", "green")),
    ColumnSpec("year_month", "string", required=True),
)

RENAMED = {
    "vendor_id": "VendorID",
    "pickup_datetime": "tpep_pickup_datetime",
    "dropoff_datetime": "tpep_dropoff_datetime",
}

KPI_MONTHLY = "kpi_yellow_avg_total_amount_monthly"
KPI_HOURLY = "kpi_fleet_avg_passenger_count_hourly"

MODELS = {
    "taxi_trips": TRIP_COLUMNS,
    "vw_taxi_trips_tlc": tuple(
        ColumnSpec(RENAMED.get(c.name, c.name), c.type, c.required, c.enum) for c in TRIP_COLUMNS
    ),
    KPI_MONTHLY: (
        ColumnSpec("year_month", "string", required=True),
        ColumnSpec("avg_total_amount", "double", required=True),
        ColumnSpec("trip_count", "long", required=True),
        ColumnSpec("run_id", "string", required=True),
        ColumnSpec("computed_at", "timestamp", required=True),
    ),
    KPI_HOURLY: (
        ColumnSpec("pickup_hour", "integer", required=True),
        ColumnSpec("avg_passenger_count", "double", required=True),
        ColumnSpec("trip_count", "long", required=True),
        ColumnSpec("null_passenger_count", "long", required=True),
        ColumnSpec("run_id", "string", required=True),
        ColumnSpec("computed_at", "timestamp", required=True),
    ),
}

KPIS = (
    KpiSpec(
        KPI_MONTHLY,
        "year_month",
        {"avg_total_amount": "avg(total_amount)", "trip_count": "count(1)"},
        only="taxi_type = '{monthly_category}'",
        exactly="periods",
    ),
    KpiSpec(
        KPI_HOURLY,
        "pickup_hour",
        {
            "avg_passenger_count": "avg(passenger_count)",
            "trip_count": "count(1)",
            "null_passenger_count": "count_if(passenger_count IS NULL)",
        },
        grain_sql="hour(pickup_datetime)",
        only="year_month = '{hourly_period}'",
        at_least="min_hours",
    ),
)

TAXI_TRIPS = ProductSpec(
    table="taxi_trips",
    interface="vw_taxi_trips_tlc",
    kpis=KPIS,
    feeds=(YELLOW, GREEN),
    row_rules=ROW_RULES,
    aggregate_rules=AGGREGATE_RULES,
    fitness_rules=FITNESS_RULES,
    checks=CHECKS,
    mandatory_rules=MANDATORY_RULES,
    profile=ProfileSpec(CONSUMPTION_COLUMNS),
    models=MODELS,
    business_key=(
        "taxi_type",
        "vendor_id",
        "pickup_datetime",
        "dropoff_datetime",
        "total_amount",
    ),
    expected_categories=("yellow", "green"),
    critical_columns=CONSUMPTION_COLUMNS[:-1],
    consumption_columns=CONSUMPTION_COLUMNS,
    renamed_columns=RENAMED,
    periods=PERIODS,
    drifting_types=DRIFTING_TYPES,
    monthly_category="yellow",
    hourly_period="2023-05",
    min_hours=20,
)

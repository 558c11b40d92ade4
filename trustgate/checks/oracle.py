"""SQL counterparts of the registered queries, for an independent engine over the same tables.

Each text stands alone: it derives the trips, applies the rules and aggregates on its own.
Only the declared rules, thresholds and run labels come from the product's declaration.
"""

from __future__ import annotations

from trustgate.checks import binding as b
from trustgate.checks import orders
from trustgate.operators.profile import MISSING
from trustgate.plans import taxi
from trustgate.plans.spec import COMPARATORS, ProductSpec

LATEST = (b.SPEC, b.RUN_LATEST, b.AT_LATEST)
EARLIER = (b.EARLIER_SPEC, b.RUN_EARLIER, b.AT_EARLIER)
BOTH = (EARLIER, LATEST)

def feed_rows(shift: str = "") -> str:
    """The feeds' rows; ``shift`` is added to both ends of a trip."""
    return f"""
feed_rows AS MATERIALIZED (
  SELECT
    concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber) AS trip_id,
    CASE WHEN l_partkey % 211 = 0 THEN NULL
         ELSE CAST(l_linenumber AS BIGINT) END AS vendor_id,
    CASE WHEN l_suppkey % 10 = 0 THEN NULL
         ELSE CAST(l_quantity % 8 AS DOUBLE) END AS passenger_count,
    CASE WHEN l_partkey % 307 = 0 THEN NULL
         WHEN l_returnflag = 'R' THEN -l_extendedprice
         ELSE l_extendedprice END AS total_amount,
    CASE WHEN l_orderkey % 401 = 0 THEN NULL ELSE o_orderdate{shift} END AS pickup_datetime,
    CASE WHEN l_orderkey % 503 = 0 THEN NULL
         WHEN l_orderkey % 20 = 0 THEN l_shipdate{shift}
         ELSE greatest(l_shipdate, o_orderdate){shift} END AS dropoff_datetime,
    CASE WHEN l_partkey % 997 = 0 THEN 'pink' END AS fleet_override,
    CASE l_linestatus WHEN 'F' THEN 'yellow' WHEN 'O' THEN 'green' END AS feed,
    strftime(o_orderdate, '%Y') AS order_year,
    l_tax
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)"""


FEED_ROWS = feed_rows()
TRIPS_OF = """,
trips AS MATERIALIZED (
  SELECT trip_id, vendor_id, passenger_count, total_amount, pickup_datetime, dropoff_datetime,
         coalesce(fleet_override, feed) AS taxi_type,
         strftime(pickup_datetime, '%Y-%m') AS year_month
  FROM feed_rows WHERE feed IS NOT NULL
)"""
TRIPS = FEED_ROWS + TRIPS_OF

RIDES = """
rides AS (
  SELECT event_id AS ride_id, ts AS pickup_datetime,
         CASE WHEN event_id % 9 = 0 THEN NULL ELSE CAST(event_id % 8 AS DOUBLE) END
           AS passenger_count,
         strftime(ts, '%Y-%m') AS year_month
  FROM events
)"""

TRIP_COLUMNS = (
    "trip_id, vendor_id, passenger_count, total_amount, pickup_datetime, dropoff_datetime,"
    " taxi_type, year_month"
)
PUBLISHED = ", ".join(taxi.CONSUMPTION_COLUMNS)


def failing(expression: str) -> str:
    return f"(NOT ({expression}) OR ({expression}) IS NULL)"


def hard(spec: ProductSpec):
    return [r for r in spec.row_rules if r.severity == "error"]


def any_hard(spec: ProductSpec) -> str:
    return "(" + " OR ".join(failing(r.expression) for r in hard(spec)) + ")"


def gated(spec: ProductSpec, run: str, at: str) -> str:
    """CTEs clean_<n> and quarantine_<n> of one run."""
    n = suffix(run)
    trail = " || ".join(
        f"CASE WHEN {failing(r.expression)} THEN '{r.name},' ELSE '' END" for r in hard(spec)
    )
    dominant = " ".join(
        f"WHEN {failing(r.expression)} THEN '{r.dimension}'" for r in hard(spec)
    )
    return f"""
clean_{n} AS MATERIALIZED (SELECT * FROM trips WHERE NOT {any_hard(spec)}),
quarantine_{n} AS MATERIALIZED (
  SELECT *, rtrim({trail}, ',') AS dq_failed_rules, CASE {dominant} END AS dq_dominant_dimension,
         '{run}' AS dq_run_id, 'trustgate' AS dq_engine
  FROM trips WHERE {any_hard(spec)}
)"""


def suffix(run: str) -> str:
    return run.replace("-", "_")


L, E = suffix(b.RUN_LATEST), suffix(b.RUN_EARLIER)
GATED = TRIPS + "," + gated(*LATEST)
GATED_BOTH = GATED + "," + gated(*EARLIER)


def rounded(value: str, digits: int) -> str:
    """Half up from eight decimals, exactly."""
    return f"CAST(round(CAST({value} AS DECIMAL(28, 8)), {digits}) AS DOUBLE)"


def violations(rule) -> str:
    return f"(SELECT CAST(count(*) AS BIGINT) FROM trips WHERE {failing(rule.expression)})"


N_TRIPS = "(SELECT count(*) FROM trips)"


def pass_rate(rule) -> str:
    return f"(({N_TRIPS} - {violations(rule)}) / CAST({N_TRIPS} AS DOUBLE))"


def metric(name: str, run: str) -> str:
    clean, quarantined = f"clean_{suffix(run)}", f"quarantine_{suffix(run)}"
    key = ", ".join(b.SPEC.business_key)
    return {
        "distinct_year_month": (
            f"(SELECT CAST(count(*) AS DOUBLE) FROM (SELECT DISTINCT year_month FROM {clean}))"
        ),
        "quarantine_rate": (
            f"((SELECT count(*) FROM {quarantined}) / CAST({N_TRIPS} AS DOUBLE))"
        ),
        "duplicate_rate": (
            f"(1.0::DOUBLE - (SELECT count(*) FROM (SELECT DISTINCT {key} FROM {clean}))"
            f" / CAST((SELECT count(*) FROM {clean}) AS DOUBLE))"
        ),
        "volume_anomaly_ratio": (
            f"(SELECT min(n) / CAST(list_sort(list(n))[len(list(n)) // 2 + 1] AS DOUBLE)"
            f" FROM (SELECT count(*) AS n FROM {clean} GROUP BY year_month))"
        ),
    }[name]


SIGNS = {"gte": ">=", "lte": "<=", "eq": "=", "gt": ">", "lt": "<"}


def judged(measured: str, rule) -> str:
    return f"{measured} {SIGNS[COMPARATORS[rule.comparator]]} {float(rule.threshold)}"


def fact(run, rule, dimension, scope, severity, passed, measured, threshold, at) -> str:
    return f"""SELECT '{run}' AS run_id, '{rule}' AS rule, '{dimension}' AS dimension,
  '{scope}' AS scope, '{severity}' AS severity, CAST({passed} AS BOOLEAN) AS passed,
  CAST({measured} AS DOUBLE) AS measured, CAST({threshold} AS DOUBLE) AS threshold,
  TIMESTAMP '{at}' AS captured_at"""


def row_facts(spec, run, at) -> list[str]:
    return [
        fact(run, r.name, r.dimension, "row", r.severity,
             "true" if r.severity == "warning" else f"{violations(r)} = 0",
             pass_rate(r), 1.0, at)
        for r in spec.row_rules
    ]


def aggregate_facts(spec, run, at) -> list[str]:
    return [
        *[
            fact(run, r.name, r.dimension, "aggregate", r.severity,
                 judged(metric(r.metric, run), r), metric(r.metric, run), r.threshold, at)
            for r in spec.aggregate_rules
        ],
        fact(run, "hard_quarantine_rate", "accuracy", "aggregate", "warning", "true",
             metric("quarantine_rate", run), "NULL", at),
    ]


def soft_facts(spec, run, at) -> list[str]:
    return [
        fact(run, r.name, r.dimension, "row", "warning", "true", pass_rate(r), "NULL", at)
        for r in spec.row_rules
        if r.severity == "warning"
    ]


UNION = "\nUNION ALL\n"
FACTS = f"""{GATED_BOTH},
facts AS MATERIALIZED (
{UNION.join(f for run in BOTH for f in row_facts(*run) + aggregate_facts(*run))}
)"""


def fitness_facts(spec, run, at, hours: str = "") -> list[str]:
    months = (
        f"(SELECT count(*) FROM (SELECT DISTINCT year_month FROM clean_{suffix(run)}"
        " WHERE taxi_type = 'yellow'))"
    )
    hours = hours or (
        "(SELECT count(*) FROM (SELECT DISTINCT hour(pickup_datetime) FROM rides"
        f" WHERE year_month = '{b.HOURLY_PERIOD}'))"
    )
    measured = {"q1_month_count": months, "q2_hour_count": hours, "cde_columns_present": "1"}
    return [
        f"""SELECT '{run}' AS run_id, '{r.use_case}' AS use_case, '{r.name}' AS rule,
  {judged(measured[r.metric], r)} AS passed, CAST({measured[r.metric]} AS DOUBLE) AS measured,
  CAST({r.threshold} AS DOUBLE) AS expected, '{at}' AS captured_at"""
        for r in spec.fitness_rules
    ]


FITNESS = f"""{GATED_BOTH},{RIDES},
fitness AS MATERIALIZED ({UNION.join(f for run in BOTH for f in fitness_facts(*run))})"""

NUMERIC = ("vendor_id", "passenger_count", "total_amount")


def profile_facts(
    source: str, run: str, layer: str, table: str, at: str, partition: str | None = None
) -> list[str]:
    head = f"'{run}' AS run_id, '{layer}' AS layer, '{table}' AS table_name"
    slot = f"coalesce({partition}, '{MISSING}')" if partition else "CAST(NULL AS VARCHAR)"
    tail = f"GROUP BY {partition}" if partition else ""

    def one(column: str, name: str, value: str) -> str:
        return (
            f"SELECT {head}, '{column}' AS column_name, '{name}' AS metric,"
            f" CAST({value} AS DOUBLE) AS metric_value, {slot} AS partition_key,"
            f" TIMESTAMP '{at}' AS captured_at FROM {source} {tail}"
        )

    return [
        one("*", "row_count", "count(*)"),
        *[
            one(c, "null_rate", f"(count(*) - count({c})) / CAST(count(*) AS DOUBLE)")
            for c in taxi.CONSUMPTION_COLUMNS
        ],
        *[one(c, m, f"{m}({c})") for c in NUMERIC for m in ("min", "max", "avg")],
    ]


def layered(run: str, at: str) -> list[str]:
    clean = f"clean_{suffix(run)}"
    return [
        *profile_facts("trips", run, "raw", "taxi_trips_projected", at),
        *profile_facts(clean, run, "clean", "taxi_trips", at),
        *profile_facts(clean, run, "consumption", "taxi_trips", at),
    ]


PROFILES = f"""{GATED_BOTH},
profiles AS MATERIALIZED (
{UNION.join(f for _, run, at in BOTH for f in layered(run, at))}
)"""

PROFILE_OUT = (
    f"run_id, layer, table_name, column_name, metric, {rounded('metric_value', 5)} AS metric_value,"
    " partition_key"
)


def matrix(metrics, source: str) -> str:
    columns = ", ".join(
        rounded(f"max(CASE WHEN metric = '{m}' THEN metric_value END)", 5) + f' AS "{m}"'
        for m in metrics
    )
    return f"""SELECT run_id, layer, table_name, column_name, {columns} FROM {source}
GROUP BY run_id, layer, table_name, column_name"""


def monthly(run: str) -> str:
    return f"""SELECT year_month, avg(total_amount) AS avg_total_amount, count(*) AS trip_count,
  '{run}' AS run_id FROM clean_{suffix(run)} WHERE taxi_type = 'yellow' GROUP BY year_month"""


def hourly(run: str) -> str:
    return f"""SELECT CAST(hour(pickup_datetime) AS INTEGER) AS pickup_hour,
  avg(passenger_count) AS avg_passenger_count, count(*) AS trip_count,
  CAST(sum(CASE WHEN passenger_count IS NULL THEN 1 ELSE 0 END) AS BIGINT)
    AS null_passenger_count, '{run}' AS run_id
FROM rides WHERE year_month = '{b.HOURLY_PERIOD}' GROUP BY 1"""


KPIS = f"""{GATED},{RIDES},
monthly AS ({monthly(b.RUN_LATEST)}),
hourly AS ({hourly(b.RUN_LATEST)})"""


def counts(objects: dict[str, str]) -> str:
    return UNION.join(
        f"SELECT '{name}' AS object, (SELECT count(*) FROM {source}) AS row_count"
        for name, source in objects.items()
    )


# Rules are counted by outcome first, then put side by side per dimension.
SCORECARD = """
SELECT run_id, dimension, CAST(sum(n) AS BIGINT) AS rules_evaluated,
       CAST(coalesce(sum(n) FILTER (WHERE ok), 0) AS BIGINT) AS rules_passed,
       coalesce(sum(n) FILTER (WHERE ok), 0) / sum(n)::DOUBLE AS pass_rate,
       max(rate) AS quarantine_rate, max(share) AS uniqueness_metric
FROM (SELECT run_id, dimension, coalesce(passed, false) AS ok, count(*) AS n,
             max(measured) FILTER (WHERE rule IN ('hard_quarantine_rate')) AS rate,
             max(measured) FILTER (WHERE rule IN ('uniqueness_rate')) AS share
      FROM facts GROUP BY ALL) GROUP BY ALL"""

INCIDENTS = f"""
quarantines AS (SELECT * FROM quarantine_{L} UNION ALL SELECT * FROM quarantine_{E}),
incidents AS (
  SELECT run_id, rule, count(*) AS incident_count FROM (
    SELECT dq_run_id AS run_id, trim(unnest(string_split(dq_failed_rules, ','))) AS rule
    FROM quarantines)
  WHERE rule <> '' GROUP BY run_id, rule
)"""

AGES = f"""
quarantines AS (SELECT * FROM quarantine_{L} UNION ALL SELECT * FROM quarantine_{E}),
captures(run_id, captured_at) AS (
  VALUES ('{b.RUN_LATEST}', TIMESTAMP '{b.AT_LATEST}'),
         ('{b.RUN_EARLIER}', TIMESTAMP '{b.AT_EARLIER}')),
aged AS (
  SELECT q.*, c.captured_at,
         CAST(datediff('day', CAST(c.captured_at AS DATE), DATE '{b.AS_OF}') AS INTEGER) AS days
  FROM quarantines q JOIN captures c ON q.dq_run_id = c.run_id)"""

DAYS = """days AS (
  SELECT reverse(strftime(ts, '%Y%m%d')) AS run_id, max(ts) AS captured_at
  FROM events GROUP BY 1)"""

BAD_CHECK = {c.name: f"coalesce({c.condition}, false)" for c in b.SPEC.checks}

DECLARED = [
    (model, column.name) for model, columns in b.SPEC.models.items() for column in columns
]


def fill_counts(name: str, source: str, columns: str) -> str:
    return UNION.join(
        f"SELECT '{name}' AS object, '{c}' AS column_name, count({c}) AS filled_rows FROM {source}"
        for c in (c.strip() for c in columns.split(","))
    )


def conformance(column) -> str:
    types = {
        "long": "typeof({c}) = 'BIGINT'",
        "double": "typeof({c}) = 'DOUBLE'",
        "string": "typeof({c}) = 'VARCHAR'",
        "timestamp": "typeof({c}) = 'TIMESTAMP'",
    }
    c = column.name
    nulls = f"count(*) - count({c})" if column.required else "0"
    listed = ", ".join(f"'{v}'" for v in column.enum)
    enum = f"count(CASE WHEN {c} NOT IN ({listed}) THEN 1 END)" if column.enum else "0"
    return f"""SELECT '{c}' AS column_name, '{column.type}' AS declared_type, true AS present,
  bool_and({types[column.type].format(c=c)}) AS type_match,
  CAST({nulls} AS BIGINT) AS null_violations, CAST({enum} AS BIGINT) AS enum_violations,
  count(*) AS rows_scanned FROM trips"""


def extremes(kpi: str, source: str, value: str, key: str) -> str:
    return f"""SELECT '{kpi}' AS kpi, {rounded(f'avg({value})', 4)} AS overall,
  (SELECT {key} FROM {source} ORDER BY {value} DESC, {key} LIMIT 1) AS high_key,
  {rounded(f'max({value})', 4)} AS high_value,
  (SELECT {key} FROM {source} ORDER BY {value}, {key} LIMIT 1) AS low_key,
  {rounded(f'min({value})', 4)} AS low_value FROM {source}"""


ALL_RULES = b.SPEC.row_rules

# The full run: trips with an hour, fitness of its own rows, and all that it stores.
HOURLY = f"{feed_rows(f' + to_hours(CAST({b.HOUR} AS INTEGER))')}{TRIPS_OF},{gated(*LATEST)}"
RUN_HOURS = f"""(SELECT count(*) FROM (SELECT DISTINCT hour(pickup_datetime) FROM clean_{L}
  WHERE year_month = '{b.RUN_PERIOD}'))"""
UNJUDGED = "CAST(NULL AS BOOLEAN) AS passed"


def kpi_values(unjudged: str = "") -> str:
    """Every value of the KPI tables, from CTEs monthly and hourly."""
    return f"""SELECT '{taxi.KPI_MONTHLY}' AS object, year_month AS item,
  {rounded('avg_total_amount', 4)} AS measured{unjudged} FROM monthly
UNION ALL
SELECT '{taxi.KPI_HOURLY}', CAST(pickup_hour AS VARCHAR),
  {rounded('avg_passenger_count', 6)}{unjudged} FROM hourly"""


def counted(objects: dict[str, str], unjudged: str = "") -> str:
    return f"""SELECT object, '*' AS item, CAST(row_count AS DOUBLE) AS measured{unjudged}
FROM ({counts(objects)})"""


ORACLE_SQL: dict[str, str] = {
    # feeds and tables
    "feed_scan": f"""WITH {FEED_ROWS}
SELECT feed, trip_id, vendor_id AS "VendorID", passenger_count, total_amount,
       CASE WHEN order_year >= '1998' THEN l_tax END AS congestion_surcharge
FROM feed_rows""",
    "feed_provenance": f"""WITH {FEED_ROWS}
SELECT feed AS taxi_type_hint, 'feed=' || feed || '/period=' || order_year AS part,
       count(*) AS row_count, count(*) AS stamped_rows
FROM feed_rows GROUP BY ALL""",
    "align_types": """
SELECT l_orderkey, l_partkey, l_linenumber, l_suppkey AS "VendorID",
       l_quantity AS passenger_count, CAST(l_tax AS VARCHAR) AS "Airport_fee"
FROM lineitem""",
    "union_feeds": f"""WITH {FEED_ROWS}
SELECT trip_id, vendor_id AS "VendorID", passenger_count, total_amount, fleet_override,
       CASE WHEN feed = 'yellow' THEN pickup_datetime END AS tpep_pickup_datetime,
       CASE WHEN feed = 'yellow' THEN dropoff_datetime END AS tpep_dropoff_datetime,
       CASE WHEN feed = 'green' THEN pickup_datetime END AS lpep_pickup_datetime,
       CASE WHEN feed = 'green' THEN dropoff_datetime END AS lpep_dropoff_datetime,
       feed AS taxi_type_hint
FROM feed_rows""",
    "feed_counts": f"""WITH {FEED_ROWS}
SELECT feed, count(*) AS row_count FROM feed_rows GROUP BY feed""",
    "write_roundtrip": f"WITH {GATED} SELECT {TRIP_COLUMNS} FROM clean_{L}",
    "governance_append": f"""WITH {FACTS}
SELECT * EXCLUDE (captured_at) REPLACE (
  CASE WHEN run_id = '{b.RUN_EARLIER}' THEN NULL ELSE threshold END AS threshold) FROM facts""",
    "model_params": f"""WITH {GATED}
SELECT year_month, count(*) AS trip_count, min(total_amount) AS min_amount,
       max(total_amount) AS max_amount, '{b.RUN_LATEST}' AS run_id
FROM clean_{L} WHERE taxi_type = 'green' GROUP BY year_month""",
    "rerun_facts": f"WITH {FACTS} {SCORECARD}",
    "model_folder": f"WITH {GATED} "
    + UNION.join(
        f"SELECT '{model}' AS model, {item} AS item, count(*) AS trip_count,"
        f" max(total_amount) AS top_amount, '{b.RUN_LATEST}' AS run_id"
        f" FROM clean_{L} WHERE taxi_type = 'yellow' GROUP BY {item}"
        for model, item in (
            ("fleet_months", "year_month"),
            ("fleet_vendors", "CAST(vendor_id AS VARCHAR)"),
        )
    ),
    "publish_all": f"WITH {KPIS} {kpi_values()} UNION ALL "
    + counted(
        {
            "taxi_trips": f"clean_{L}",
            "vw_taxi_trips_tlc": f"clean_{L}",
            taxi.KPI_MONTHLY: "monthly",
            taxi.KPI_HOURLY: "hourly",
        }
    ),
    "product_run": f"""WITH {HOURLY},
monthly AS ({monthly(b.RUN_LATEST)}),
hourly AS (
  SELECT hour(pickup_datetime) AS pickup_hour, avg(passenger_count) AS avg_passenger_count
  FROM clean_{L} WHERE year_month = '{b.RUN_PERIOD}' GROUP BY 1),
profiled AS (
{UNION.join(layered(b.RUN_LATEST, b.AT_LATEST))}),
validated AS ({UNION.join(row_facts(*LATEST) + aggregate_facts(*LATEST))}),
fit AS ({UNION.join(fitness_facts(*LATEST, RUN_HOURS))})
{kpi_values(", " + UNJUDGED)}
UNION ALL
SELECT 'data_profile', concat_ws('.', layer, column_name, metric),
       {rounded('metric_value', 5)}, {UNJUDGED} FROM profiled WHERE metric_value IS NOT NULL
UNION ALL SELECT 'dq_validation_result', rule, measured, passed FROM validated
UNION ALL SELECT 'fitness_for_use_result', rule, measured, passed FROM fit
UNION ALL """
    + counted(
        {
            "raw.yellow_tripdata": "feed_rows WHERE feed = 'yellow'",
            "raw.green_tripdata": "feed_rows WHERE feed = 'green'",
            "clean.taxi_trips": f"clean_{L}",
            "clean.taxi_trips_quarantine": f"quarantine_{L}",
            "consumption.taxi_trips": f"clean_{L}",
        },
        ", " + UNJUDGED,
    ),
    "orders_run": orders.oracle_sql(),
    # projection and gate
    "canonical": f"WITH {TRIPS} SELECT {TRIP_COLUMNS} FROM trips",
    "consumption": f"WITH {GATED} SELECT {PUBLISHED} FROM clean_{L}",
    "view_rename": f"""WITH {GATED}
SELECT vendor_id AS "VendorID", passenger_count, total_amount,
       pickup_datetime AS tpep_pickup_datetime, dropoff_datetime AS tpep_dropoff_datetime,
       taxi_type, year_month FROM clean_{L}""",
    "interface_sample": f"""WITH {GATED}
SELECT vendor_id AS "VendorID", passenger_count, total_amount,
       pickup_datetime AS tpep_pickup_datetime, dropoff_datetime AS tpep_dropoff_datetime
FROM clean_{L}
ORDER BY total_amount, pickup_datetime, dropoff_datetime, vendor_id, passenger_count NULLS FIRST
LIMIT 10""",
    "rule_fail_flags": f"WITH {TRIPS} SELECT trip_id, "
    + ", ".join(f"{failing(r.expression)} AS fail_{r.name}" for r in ALL_RULES)
    + " FROM trips",
    "gate_clean": f"WITH {GATED} SELECT {TRIP_COLUMNS} FROM clean_{L}",
    "gate_quarantine": f"WITH {GATED} SELECT * FROM quarantine_{L}",
    "quarantine_trail": f"""WITH {GATED}
SELECT trip_id, dq_failed_rules, dq_dominant_dimension FROM quarantine_{L}""",
    "rule_stats": f"WITH {TRIPS} "
    + UNION.join(
        f"SELECT '{r.name}' AS rule, '{r.severity}' AS severity, {N_TRIPS} AS total_rows,"
        f" {violations(r)} AS failed_rows, {pass_rate(r)} AS pass_rate"
        for r in ALL_RULES
    ),
    "gate_summary": f"""WITH {GATED}
SELECT {N_TRIPS} AS input_rows, (SELECT count(*) FROM clean_{L}) AS clean_rows,
       (SELECT count(*) FROM quarantine_{L}) AS quarantine_rows,
       {metric("quarantine_rate", b.RUN_LATEST)} AS quarantine_rate, """
    + ", ".join(
        f"{pass_rate(r)} AS pass_rate_{r.name}" for r in ALL_RULES if r.severity == "warning"
    ),
    "rule_outcomes": f"WITH {TRIPS} "
    + UNION.join(
        f"SELECT '{r.name}' AS rule, '{r.dimension}' AS dimension, '{r.severity}' AS severity,"
        f" CASE WHEN {violations(r)} = 0 THEN 'pass'"
        f" ELSE '{'fail' if r.severity == 'error' else 'warn'}' END AS outcome,"
        f" {pass_rate(r)} AS measured, 1.0::DOUBLE AS threshold"
        for r in ALL_RULES
    ),
    "validation_result": f"WITH {GATED} SELECT * EXCLUDE (captured_at) FROM ("
    + UNION.join(row_facts(*LATEST) + aggregate_facts(*LATEST))
    + ")",
    "merged_results": f"WITH {GATED} SELECT * EXCLUDE (captured_at) FROM ("
    + UNION.join(row_facts(*LATEST) + aggregate_facts(*LATEST))
    + ")",
    "failed_rows_checks": f"WITH {TRIPS} "
    + UNION.join(
        f"SELECT '{c.name}' AS rule, '{c.severity}' AS severity, count(*) AS failed_rows,"
        f" CASE WHEN count(*) = 0 THEN 'pass'"
        f" ELSE '{'fail' if c.severity == 'error' else 'warn'}' END AS outcome"
        f" FROM trips WHERE {c.condition}"
        for c in b.SPEC.checks
    ),
    "check_agreement": f"WITH {TRIPS} "
    + UNION.join(
        f"SELECT '{r.name}' AS rule, true AS has_rule, true AS has_check,"
        f" count(*) AS compared_rows,"
        f" count(CASE WHEN {failing(r.expression)} <> {BAD_CHECK[r.name]} THEN 1 END)"
        f" AS disagreeing_rows FROM trips"
        for r in ALL_RULES
    ),
    # aggregate rules, fitness, schema
    "month_coverage": f"""WITH {GATED}
SELECT count(*) AS distinct_periods FROM (SELECT DISTINCT year_month FROM clean_{L})""",
    "duplicate_rate": f"""WITH {GATED}
SELECT (SELECT count(*) FROM clean_{L}) AS clean_rows,
       (SELECT count(*) FROM (SELECT DISTINCT {", ".join(b.SPEC.business_key)} FROM clean_{L}))
         AS distinct_keys,
       {metric("duplicate_rate", b.RUN_LATEST)} AS duplicate_rate""",
    "volume_sanity": f"""WITH {GATED},
volumes AS (SELECT count(*) AS n FROM clean_{L} GROUP BY year_month)
SELECT min(n) AS smallest_period, list_sort(list(n))[len(list(n)) // 2 + 1] AS median_period,
       {metric("volume_anomaly_ratio", b.RUN_LATEST)} AS volume_anomaly_ratio FROM volumes""",
    "aggregate_rules": f"WITH {GATED} SELECT * EXCLUDE (captured_at) FROM ("
    + UNION.join(aggregate_facts(*LATEST) + soft_facts(*LATEST))
    + ")",
    "category_presence": f"""WITH {TRIPS},
expected(category) AS (VALUES ('yellow'), ('green')),
found AS (SELECT taxi_type AS category, count(*) AS n FROM trips GROUP BY taxi_type)
SELECT category, coalesce(n, 0) AS row_count, e.category IS NOT NULL AS expected,
       e.category IS NOT NULL AND n IS NOT NULL AS passed
FROM found f FULL JOIN expected e USING (category)""",
    "fitness": f"WITH {FITNESS} SELECT * FROM fitness",
    "kpi_completeness": f"""WITH {KPIS}
SELECT '{taxi.KPI_MONTHLY}' AS kpi, count(*) AS row_count, CAST({b.MONTHS} AS BIGINT) AS needed,
       count(*) = {b.MONTHS} AS passed FROM monthly
UNION ALL
SELECT '{taxi.KPI_HOURLY}', count(*), CAST(20 AS BIGINT), count(*) >= 20 FROM hourly""",
    "schema_conformance": f"WITH {TRIPS} "
    + UNION.join(conformance(c) for c in taxi.TRIP_COLUMNS),
    "undeclared_outputs": f"""WITH {KPIS},
monthly_table AS (SELECT *, TIMESTAMP '{b.AT_LATEST}' AS computed_at FROM monthly),
quarantine_table AS (
  SELECT *, TIMESTAMP '{b.AT_LATEST}' AS dq_quarantined_at FROM quarantine_{L}),
declared(object, column_name) AS (VALUES {", ".join(str(d) for d in DECLARED)}),
found AS (
{fill_counts("taxi_trips", f"clean_{L}", TRIP_COLUMNS)}
UNION ALL
{fill_counts("taxi_trips_quarantine", "quarantine_table",
             TRIP_COLUMNS + ", dq_failed_rules, dq_dominant_dimension, dq_run_id, dq_engine,"
             " dq_quarantined_at")}
UNION ALL
{fill_counts(taxi.KPI_MONTHLY, "monthly_table",
             "year_month, avg_total_amount, trip_count, run_id, computed_at")})
SELECT object, column_name, filled_rows,
       object IN (SELECT object FROM declared) AS object_declared
FROM found ANTI JOIN declared USING (object, column_name)""",
    # profiles
    "profile": f"WITH {TRIPS} SELECT {PROFILE_OUT} FROM ("
    + UNION.join(profile_facts("trips", b.RUN_LATEST, "raw", "taxi_trips_projected", b.AT_LATEST))
    + ") WHERE metric_value IS NOT NULL",
    "profile_layers": f"WITH {PROFILES} SELECT {PROFILE_OUT} FROM profiles"
    f" WHERE run_id = '{b.RUN_LATEST}' AND metric_value IS NOT NULL",
    "profile_by_partition": f"WITH {TRIPS} SELECT {PROFILE_OUT} FROM ("
    + UNION.join(
        profile_facts(
            "trips", b.RUN_LATEST, "raw", "taxi_trips_projected", b.AT_LATEST, "year_month"
        )
    )
    + ") WHERE metric_value IS NOT NULL",
    "profile_latest": f"""WITH {PROFILES.replace("profiles AS (", "profiles AS MATERIALIZED (")},
newest AS MATERIALIZED (SELECT max(captured_at) AS last_at FROM profiles)
SELECT {PROFILE_OUT}, strftime(captured_at, '%Y-%m-%d %H:%M:%S') AS captured_at
FROM profiles JOIN newest ON captured_at = last_at
WHERE metric_value IS NOT NULL""",
    "profile_matrix": f"WITH {PROFILES} "
    + matrix(
        ["null_rate", "min", "avg", "max"], "(SELECT * FROM profiles WHERE column_name <> '*')"
    ),
    "profile_preferred": f"WITH {PROFILES} "
    + matrix(
        ["min", "avg", "max"],
        "(SELECT * FROM profiles WHERE metric IN ('min', 'max', 'avg') AND layer = 'clean')",
    ),
    "layer_rows": f"""WITH {PROFILES}
SELECT run_id, layer, table_name, CAST(metric_value AS BIGINT) AS row_count
FROM profiles WHERE column_name = '*' AND metric = 'row_count'""",
    "worst_null_rates": f"""WITH {PROFILES}
SELECT run_id, layer, table_name, column_name, metric_value AS null_rate,
       CASE WHEN metric_value < 0.05 THEN 'ok' WHEN metric_value < 0.4 THEN 'warn' ELSE 'bad' END
         AS level
FROM profiles WHERE metric = 'null_rate'
QUALIFY row_number() OVER (
  PARTITION BY run_id ORDER BY metric_value DESC, layer, column_name) <= 5""",
    # KPIs
    "kpi_monthly_avg": f"""WITH {KPIS}
SELECT year_month, {rounded('avg_total_amount', 4)} AS avg_total_amount, trip_count, run_id
FROM monthly ORDER BY year_month""",
    "kpi_hourly_avg": f"""WITH {KPIS}
SELECT pickup_hour, {rounded('avg_passenger_count', 6)} AS avg_passenger_count, trip_count,
       null_passenger_count, run_id FROM hourly ORDER BY pickup_hour""",
    "kpi_latest_run": f"""WITH {KPIS}
SELECT year_month, {rounded('avg_total_amount', 2)} AS avg_total_amount, trip_count, run_id,
       '{b.AT_LATEST}' AS computed_at
FROM monthly ORDER BY year_month""",
    "kpi_null_share": f"""WITH {KPIS}
SELECT pickup_hour, {rounded('avg_passenger_count', 4)} AS avg_passenger_count, trip_count,
       null_passenger_count,
       round(100.0::DOUBLE * null_passenger_count / nullif(trip_count, 0), 2) AS null_pct, run_id
FROM hourly ORDER BY pickup_hour""",
    "kpi_extremes": f"""WITH {KPIS},
hours AS (SELECT lpad(CAST(pickup_hour AS VARCHAR), 2, '0') AS hour_key, * FROM hourly)
{extremes(taxi.KPI_MONTHLY, "monthly", "avg_total_amount", "year_month")}
UNION ALL
{extremes(taxi.KPI_HOURLY, "hours", "avg_passenger_count", "hour_key")}""",
    # governance views and run-scoped reads
    "scorecard": f"WITH {FACTS} {SCORECARD}",
    "scorecard_latest_run": f"""WITH {FACTS}, card AS ({SCORECARD})
SELECT run_id, dimension, rules_evaluated, rules_passed, round(pass_rate, 4) AS pass_rate,
       round(quarantine_rate, 6) AS quarantine_rate, uniqueness_metric
FROM card WHERE run_id = '{b.RUN_LATEST}' ORDER BY dimension""",
    "latest_run": f"WITH {DAYS} SELECT run_id FROM days ORDER BY captured_at DESC LIMIT 1",
    "run_list": f"""WITH {DAYS}
SELECT run_id, strftime(captured_at, '%Y-%m-%d %H:%M:%S') AS last_captured FROM days""",
    "failed_rules": f"""WITH {FACTS}
SELECT dimension, rule, severity, passed, measured, threshold FROM facts
WHERE run_id = '{b.RUN_LATEST}' AND passed = false
ORDER BY CASE WHEN severity = 'error' THEN 0 ELSE 1 END, dimension, rule""",
    "rule_detail": f"""WITH {FACTS}
SELECT rule, dimension, severity, scope, passed, measured, threshold,
       CASE severity WHEN 'error' THEN 'moves rows to quarantine' WHEN 'warning' THEN 'scores only'
         ELSE '—' END AS effect
FROM facts WHERE run_id = '{b.RUN_LATEST}'
ORDER BY CASE WHEN severity = 'error' THEN 0 ELSE 1 END, dimension, rule""",
    "reliability_rollup": f"""WITH {FACTS},
card AS ({SCORECARD}),
means AS (
  SELECT run_id, avg(pass_rate) AS mean_pass_rate,
         coalesce(max(quarantine_rate), 0.0) AS quarantine_rate,
         max(uniqueness_metric) AS duplicate_rate,
         CAST(sum(rules_evaluated) AS BIGINT) AS rules_evaluated,
         CAST(sum(rules_passed) AS BIGINT) AS rules_passed
  FROM card GROUP BY run_id),
failures AS (
  SELECT run_id,
         count(CASE WHEN severity = 'error' AND NOT passed THEN 1 END) AS hard_failures,
         count(CASE WHEN severity = 'warning' AND NOT passed THEN 1 END) AS soft_failures,
         count(CASE WHEN severity = 'error' AND NOT passed AND scope = 'row' THEN 1 END)
           AS hard_row_failures
  FROM facts GROUP BY run_id)
SELECT run_id, {rounded('mean_pass_rate', 6)} AS mean_pass_rate, quarantine_rate, duplicate_rate,
       rules_evaluated, rules_passed, hard_failures, soft_failures, hard_row_failures,
       quarantine_rate <= 0.05 AS within_cap,
       CASE WHEN quarantine_rate > 0.05 THEN 'bad' WHEN mean_pass_rate >= 0.95 THEN 'ok'
            WHEN mean_pass_rate >= 0.80 THEN 'warn' ELSE 'bad' END AS level,
       mean_pass_rate >= 0.95 AND quarantine_rate <= 0.05 AND hard_failures = 0 AS trusted
FROM means JOIN failures USING (run_id)""",
    "fitness_latest_run": f"""WITH {FITNESS}
SELECT use_case, rule, passed, measured, expected, run_id FROM fitness
WHERE run_id = '{b.RUN_LATEST}' ORDER BY use_case, rule""",
    "fitness_rollup": f"""WITH {FITNESS}
SELECT run_id, CAST(sum(CASE WHEN passed THEN 1 ELSE 0 END) AS BIGINT) AS approved,
       count(*) AS total, count(DISTINCT use_case) AS use_cases
FROM fitness GROUP BY run_id""",
    "layer_counts": f"WITH {KPIS} "
    + counts(
        {
            "canonical.yellow": "trips WHERE taxi_type = 'yellow'",
            "canonical.green": "trips WHERE taxi_type = 'green'",
            "clean.taxi_trips": f"clean_{L}",
            "clean.taxi_trips_quarantine": f"quarantine_{L}",
            "consumption.taxi_trips": f"clean_{L}",
            f"consumption.{taxi.KPI_MONTHLY}": "monthly",
            f"consumption.{taxi.KPI_HOURLY}": "hourly",
        }
    ),
    "quarantine_pct": f"""WITH {GATED},
n AS (SELECT (SELECT count(*) FROM clean_{L}) AS c, (SELECT count(*) FROM quarantine_{L}) AS q)
SELECT c AS consumption_rows, q AS quarantine_rows,
       round(100.0::DOUBLE * q / nullif(c + q, 0), 4) AS quarantine_pct FROM n""",
    # triage
    "incident_top_rules": f"""WITH {GATED_BOTH},{INCIDENTS}
SELECT run_id, rule, incident_count FROM incidents
QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY incident_count DESC, rule) <= 3""",
    "reasons_latest_run": f"""WITH {GATED_BOTH},{INCIDENTS}
SELECT run_id, rule, incident_count FROM incidents WHERE run_id = '{b.RUN_LATEST}'""",
    "incident_enriched": f"""WITH {GATED_BOTH},{INCIDENTS},
declared(rule, dimension, severity) AS (VALUES {", ".join(
    str((r.name, r.dimension, r.severity)) for r in ALL_RULES if r.name != "year_month_in_window")})
SELECT rule, run_id, incident_count, coalesce(dimension, '—') AS dimension,
       coalesce(severity, '—') AS severity
FROM incidents LEFT JOIN declared USING (rule)""",
    "incident_sample": f"""WITH {GATED}
SELECT trip_id, taxi_type, vendor_id, pickup_datetime, dropoff_datetime, passenger_count,
       total_amount, dq_failed_rules, dq_run_id
FROM quarantine_{L} ORDER BY trip_id LIMIT 25""",
    "quarantine_ageing": f"""WITH {GATED_BOTH},{AGES}
SELECT dq_run_id AS run_id, count(*) AS quarantined_rows,
       strftime(min(captured_at), '%Y-%m-%d %H:%M:%S') AS quarantined_since,
       min(days) AS min_days, max(days) AS max_days, avg(days) AS avg_days
FROM aged GROUP BY dq_run_id""",
    "age_buckets": f"""WITH {GATED_BOTH},{AGES}
SELECT dq_run_id AS run_id, CASE WHEN days = 0 THEN 'today' WHEN days BETWEEN 1 AND 3 THEN '1-3 days'
            WHEN days BETWEEN 4 AND 7 THEN '4-7 days' ELSE '8+ days' END AS age_bucket,
       count(*) AS row_count,
       CAST(CASE WHEN days = 0 THEN 1 WHEN days BETWEEN 1 AND 3 THEN 2
            WHEN days BETWEEN 4 AND 7 THEN 3 ELSE 4 END AS INTEGER) AS bucket_rank
FROM aged GROUP BY 1, 2, 4""",
    "stratified_sample": f"""WITH {GATED_BOTH},{AGES},
ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY dq_run_id, coalesce(dq_dominant_dimension, 'unknown')
    ORDER BY md5('{b.SEED}|' || trip_id), trip_id) AS rn
  FROM aged)
SELECT trip_id, {PUBLISHED}, dq_run_id, dq_failed_rules, dq_dominant_dimension,
       strftime(captured_at, '%Y-%m-%d %H:%M:%S') AS quarantined_at, days AS days_in_quarantine
FROM ranked WHERE rn <= 5""",
}

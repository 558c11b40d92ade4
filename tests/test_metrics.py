"""Aggregate rules, fitness and schema checks on small fixtures and against plain Python."""

from __future__ import annotations

import random
from dataclasses import replace
from datetime import datetime

import pytest

from tests.test_gate import ROWS, SCHEMA
from trustgate import ColumnSpec, FitnessRule, ProductSpec, SpecError
from trustgate.operators import gate, metrics
from trustgate.plans.taxi import (
    AGGREGATE_RULES,
    CONSUMPTION_COLUMNS,
    FITNESS_RULES,
    PERIODS,
    ROW_RULES,
    TAXI_TRIPS,
    TRIP_COLUMNS,
)


def month_rows():
    return [
        (1, 1.0, 10.0, datetime(2023, i, 1, 8), datetime(2023, i, 1, 8, 30), "yellow", p)
        for i, p in enumerate(PERIODS, 1)
    ]


def facts_of(df, spec=TAXI_TRIPS, **soft):
    measures = metrics.measure(df, spec, gate.accepted(ROW_RULES), spec.soft_rules)
    rows = metrics.aggregate_rows(measures, spec, "r", soft_rates=soft or None)
    return {r["rule"]: r for r in rows.collect()}


def test_five_months_pass(spark):
    facts = facts_of(spark.createDataFrame(month_rows(), SCHEMA), passenger_count_range="0.8D")
    assert facts["month_coverage"]["passed"] and facts["month_coverage"]["measured"] == 5.0
    assert facts["month_coverage"]["dimension"] == "completeness"
    assert facts["passenger_count_range"]["measured"] == 0.8
    assert facts["passenger_count_range"]["threshold"] is None
    assert facts["volume_sanity"]["measured"] == 1.0
    assert "timeliness" not in {f["dimension"] for f in facts.values()}


def test_empty_table_uses_the_defaults(spark):
    facts = facts_of(spark.createDataFrame([], SCHEMA))
    measured = {name: f["measured"] for name, f in facts.items()}
    assert measured == {
        "month_coverage": 0.0,
        "quarantine_rate_cap": 0.0,
        "uniqueness_rate": 0.0,
        "volume_sanity": 1.0,
        "hard_quarantine_rate": 0.0,
    }
    assert facts["month_coverage"]["passed"] is False


def test_unknown_metric_is_skipped(spark):
    spec = replace(
        TAXI_TRIPS,
        aggregate_rules=(*AGGREGATE_RULES, replace(AGGREGATE_RULES[0], name="x", metric="y")),
    )
    assert "x" not in facts_of(spark.createDataFrame(month_rows(), SCHEMA), spec)


def random_rows(n, seed):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        month = rng.choice([1, 1, 1, 2, 3, 4])
        day = datetime(2023, month, rng.randint(1, 3))
        vendor = rng.choice([1, 2, None])
        rows.append((vendor, 1.0, rng.choice([1.0, 2.0]), day, day, rng.choice(["yellow", "pink"]),
                     f"2023-{month:02d}"))
    return rows


@pytest.mark.parametrize(
    "key", [("taxi_type", "vendor_id", "pickup_datetime"), ("vendor_id", "total_amount"), ()]
)
def test_measure_matches_brute_force(spark, key):
    """Keys that fix the period, keys shared by many periods, and no key."""
    rows = random_rows(400, 7)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    spec: ProductSpec = replace(TAXI_TRIPS, business_key=key)
    rules = tuple(r for r in ROW_RULES if r.name != "vendor_id_not_null")
    got = metrics.measure(df, spec, gate.accepted(rules), rules).first()

    names = [c.split()[0] for c in SCHEMA.split(", ")]
    clean = [dict(zip(names, r)) for r in rows if r[5] != "pink"]
    sizes = sorted(
        sum(r["year_month"] == m for r in clean) for m in {r["year_month"] for r in clean}
    )
    assert got["total_rows"] == len(rows)
    assert got["clean_rows"] == len(clean)
    assert got["periods"] == len(sizes)
    assert got["smallest_period"] == sizes[0]
    assert got["median_period"] == sizes[len(sizes) // 2]
    assert got["n_taxi_type_valid"] == len(rows) - len(clean)
    assert got["n_vendor_id_enum"] == sum(r[0] is None for r in rows)
    distinct = {tuple(r[c] for c in key) for r in clean} if key else set()
    assert got["distinct_keys"] == len(distinct)


def test_missing_key_parts_are_equal(spark):
    df = spark.createDataFrame([(None, "a"), (None, "a"), (1, "a")], "v int, t string")
    row = metrics.duplicate_rate(df, ["v", "t"]).first()
    assert (row["clean_rows"], row["distinct_keys"]) == (3, 2)
    assert row["duplicate_rate"] == 1 - 2 / 3


@pytest.mark.parametrize("sizes", [[3], [1, 4], [1, 2, 3, 4], [5, 5, 1, 9, 2]])
def test_volume_ratio_uses_the_upper_median(spark, sizes):
    rows = [(str(i),) for i, n in enumerate(sizes) for _ in range(n)]
    df = spark.createDataFrame(rows, "m string")
    row = metrics.volume_ratio(df, "m").first()
    median = sorted(sizes)[len(sizes) // 2]
    assert row["median_period"] == median
    assert row["volume_anomaly_ratio"] == min(sizes) / median


def test_missing_period_is_a_period(spark):
    df = spark.createDataFrame([("a",), (None,), ("a",)], "m string")
    assert metrics.period_coverage(df, "m").first()["distinct_periods"] == 2


def test_row_results_supersede_aggregate_ones(spark):
    schema = "run_id string, rule string, measured double"
    rows = spark.createDataFrame([("r", "a", 1.0)], schema)
    aggregate = spark.createDataFrame([("r", "a", 0.5), ("r", "b", 0.2), ("s", "a", 0.1)], schema)
    merged = metrics.merge_results(rows, aggregate).collect()
    assert {(r["run_id"], r["rule"]): r["measured"] for r in merged} == {("r", "a"): 1.0, ("r", "b"): 0.2, ("s", "a"): 0.1}


def test_category_presence(spark):
    df = spark.createDataFrame([("yellow",), ("yellow",), ("pink",)], "t string")
    found = {
        r["category"]: (r["row_count"], r["expected"], r["passed"])
        for r in metrics.category_presence(df, "t", ["yellow", "green"]).collect()
    }
    assert found == {
        "yellow": (2, True, True),
        "green": (0, True, False),
        "pink": (1, False, False),
    }


def fitness_of(df, rules=FITNESS_RULES):
    measures = metrics.fitness_measures(df, TAXI_TRIPS)
    facts = metrics.fitness_rows(measures, rules, "r")
    blocked = {r["rule"] for r in metrics.blocking_fitness(facts, rules).collect()}
    return {r["rule"]: r for r in facts.collect()}, blocked


def hour_rows(hours, day, kind):
    return [
        (1, 1.0, 10.0, datetime(2023, 5, day, h), datetime(2023, 5, day, h, 30), kind, "2023-05")
        for h in range(hours)
    ]


def test_fitness_passes_with_five_months_and_twenty_hours(spark):
    df = spark.createDataFrame(month_rows() + hour_rows(20, 2, "green"), SCHEMA)
    facts, blocked = fitness_of(df)
    assert not blocked and all(f["passed"] for f in facts.values())
    assert facts["q2_hours_coverage"]["measured"] == 20.0


def test_fitness_counts_distinct_hours(spark):
    df = spark.createDataFrame(month_rows() + hour_rows(3, 1, "yellow"), SCHEMA)
    facts, blocked = fitness_of(df)
    assert facts["q2_hours_coverage"]["measured"] == 4.0
    assert blocked == {"q2_hours_coverage"}


def test_fitness_without_columns_or_metric(spark):
    df = spark.createDataFrame(month_rows(), SCHEMA).drop("taxi_type", "year_month")
    rules = (*FITNESS_RULES, FitnessRule("odd", "nobody_measures", 1, severity="warning"))
    facts, blocked = fitness_of(df, rules)
    assert facts["q1_months_present"]["measured"] == 0.0
    assert facts["q2_hours_coverage"]["measured"] == 1.0
    assert facts["consumption_schema_cdes"]["passed"] is False
    assert facts["odd"]["measured"] == 0.0 and "odd" not in blocked


def test_schema_conformance(spark):
    df = spark.createDataFrame(ROWS, SCHEMA).withColumnRenamed("passenger_count", "p")
    df = df.withColumn("total_amount", df.total_amount.cast("string"))
    found = {r["column_name"]: r for r in metrics.schema_conformance(df, TRIP_COLUMNS).collect()}
    assert found["passenger_count"]["present"] is False
    assert found["passenger_count"]["null_violations"] is None
    assert found["total_amount"]["type_match"] is False
    assert found["vendor_id"]["null_violations"] == 1
    assert found["taxi_type"]["enum_violations"] == 1


def test_undeclared_outputs(spark):
    models = {"a": (ColumnSpec("x", "long"),)}
    a = spark.createDataFrame([(1, None), (2, 3)], "x long, y long")
    found = metrics.undeclared_outputs({"a": a, "b": a.select("x")}, models).collect()
    names = ("object", "column_name", "filled_rows", "object_declared")
    assert {tuple(r[n] for n in names) for r in found} == {
        ("a", "y", 1, True),
        ("b", "x", 2, False),
    }
    assert metrics.undeclared_outputs({"a": a.select("x")}, models).count() == 0


def test_contract_mapping_builds_the_product():
    contract = {
        "quality": [
            {"name": r.name, "dimension": r.dimension, "scope": "row", "severity": r.severity,
             "expression": r.expression}
            for r in ROW_RULES
        ]
        + [
            {"name": r.name, "dimension": r.dimension, "scope": "aggregate",
             "severity": r.severity, "metric": r.metric, "threshold": r.threshold,
             "comparator": r.comparator}
            for r in AGGREGATE_RULES
        ],
        "fitness_for_use": [
            {"name": r.name, "use_case": r.use_case, "severity": r.severity, "metric": r.metric,
             "threshold": r.threshold, "comparator": r.comparator}
            for r in FITNESS_RULES
        ],
        "profiling": {"columns": list(CONSUMPTION_COLUMNS)},
        "models": {
            "taxi_trips": {
                "fields": {
                    c.name: {"type": c.type, "required": c.required, "enum": list(c.enum)}
                    for c in TRIP_COLUMNS
                }
            }
        },
    }
    checks = {
        "checks for trips": [
            {"failed rows": {"name": "a", "fail condition": "x IS NULL"}},
            {"failed rows": {"name": "b", "warn condition": "x < 0"}},
        ]
    }
    spec = ProductSpec.from_contract(contract, checks)
    assert spec.row_rules == ROW_RULES
    assert spec.aggregate_rules == AGGREGATE_RULES
    assert spec.fitness_rules == FITNESS_RULES
    assert spec.profile == TAXI_TRIPS.profile
    assert spec.models["taxi_trips"] == TRIP_COLUMNS
    assert [c.severity for c in spec.checks] == ["error", "warning"]
    for block in ("fitness_for_use", "profiling"):
        with pytest.raises(SpecError, match=block.split("_")[0]):
            ProductSpec.from_contract({**contract, block: None})
    with pytest.raises(SpecError, match="severity"):
        ProductSpec.from_contract({**contract, "quality": [{"name": "a", "scope": "row"}]})

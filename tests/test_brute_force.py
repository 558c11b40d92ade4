"""The gate against rules restated in plain Python, and the whole test binding against known totals."""

from __future__ import annotations

import math
import random
from collections import Counter
from datetime import datetime
from pathlib import Path

import pytest

import __spark_entry__ as entry
from tests.test_gate import SCHEMA
from trustgate.operators import gate
from trustgate.plans.taxi import PERIODS, ROW_RULES

NAMES = [c.split()[0] for c in SCHEMA.split(", ")]


def in_range(value):
    return value is not None and not math.isnan(value) and 1 <= value <= 6


def not_negative(value):
    return value is not None and (math.isnan(value) or value >= 0)


PASSES = {
    "total_amount_non_negative": lambda r: not_negative(r["total_amount"]),
    "dropoff_after_pickup": lambda r: (
        None not in (r["pickup_datetime"], r["dropoff_datetime"])
        and r["dropoff_datetime"] >= r["pickup_datetime"]
    ),
    "vendor_id_not_null": lambda r: r["vendor_id"] is not None,
    "total_amount_not_null": lambda r: r["total_amount"] is not None,
    "pickup_not_null": lambda r: r["pickup_datetime"] is not None,
    "dropoff_not_null": lambda r: r["dropoff_datetime"] is not None,
    "taxi_type_valid": lambda r: r["taxi_type"] in ("yellow", "green"),
    "year_month_in_window": lambda r: r["year_month"] in PERIODS,
    "passenger_count_range": lambda r: in_range(r["passenger_count"]),
    "vendor_id_enum": lambda r: r["vendor_id"] in (1, 2),
}


def random_rows(n):
    rng = random.Random(11)
    times = [None, *[datetime(2023, 1 + i, 3, i) for i in range(6)]]
    return [
        (
            rng.choice([None, 1, 2, 6]),
            rng.choice([None, 0.0, 1.0, 6.0, 7.0, float("nan")]),
            rng.choice([None, -1.0, 0.0, 5.0, float("nan")]),
            rng.choice(times),
            rng.choice(times),
            rng.choice([None, "yellow", "green", "pink", ""]),
            rng.choice([None, "2022-12", *PERIODS]),
        )
        for _ in range(n)
    ]


def test_gate_against_python(spark):
    rows = random_rows(1500)
    failed = [
        [r.name for r in ROW_RULES if not PASSES[r.name](dict(zip(NAMES, row)))] for row in rows
    ]
    hard = {r.name: r.dimension for r in ROW_RULES if r.hard}
    trails = [[n for n in names if n in hard] for names in failed]

    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    stats = {r["rule"]: r["failed_rows"] for r in gate.rule_stats(df, ROW_RULES).collect()}
    assert stats == {r.name: sum(r.name in names for names in failed) for r in ROW_RULES}

    assert gate.clean_rows(df, ROW_RULES).count() == sum(not t for t in trails)
    found = gate.quarantine_rows(df, ROW_RULES, "r").collect()
    assert Counter((r["dq_failed_rules"], r["dq_dominant_dimension"]) for r in found) == Counter(
        (",".join(t), hard[t[0]]) for t in trails if t
    )


SF = "/root/testdata/sf0.01"


@pytest.mark.skipif(not Path(SF).exists(), reason="test tables not present")
def test_known_totals(spark):
    queries = entry.queries()
    summary = queries["gate_summary"](spark, SF).first()
    assert (summary["input_rows"], summary["clean_rows"], summary["quarantine_rows"]) == (
        60_000,
        57_677,
        2_323,
    )
    stats = {r["rule"]: r["failed_rows"] for r in queries["rule_stats"](spark, SF).collect()}
    assert stats == {
        "dropoff_after_pickup": 1784,
        "vendor_id_not_null": 301,
        "total_amount_not_null": 213,
        "pickup_not_null": 140,
        "dropoff_not_null": 118,
        "taxi_type_valid": 99,
        "year_month_in_window": 150,
        "total_amount_non_negative": 20189,
        "passenger_count_range": 18871,
        "vendor_id_enum": 42917,
    }
    trail = queries["quarantine_trail"](spark, SF)
    assert trail.select("dq_failed_rules").distinct().count() == 14
    dimensions = {r[0]: r[1] for r in trail.groupBy("dq_dominant_dimension").count().collect()}
    assert dimensions == {"consistency": 1784, "completeness": 475, "validity": 64}
    keys = queries["duplicate_rate"](spark, SF).first()
    assert keys["distinct_keys"] == 26_276 and round(keys["duplicate_rate"], 6) == 0.544428
    volume = queries["volume_sanity"](spark, SF).first()
    assert (volume["smallest_period"], volume["median_period"]) == (585, 730)
    january = queries["kpi_monthly_avg"](spark, SF).first()
    assert (january["year_month"], january["avg_total_amount"], january["trip_count"]) == (
        "1995-01",
        20235.2668,
        378,
    )
    midnight = queries["kpi_hourly_avg"](spark, SF).first()
    assert (midnight["avg_passenger_count"], midnight["trip_count"]) == (3.646575, 405)
    assert midnight["null_passenger_count"] == 40

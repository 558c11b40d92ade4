"""Profiles, marts, governance reads and triage on small fixtures."""

from __future__ import annotations

from datetime import datetime

import pytest

from tests.test_gate import ROWS, SCHEMA
from trustgate import ProfileSpec
from trustgate.operators import gate, governance, harmonize, marts, profile, triage
from trustgate.plans.taxi import CONSUMPTION_COLUMNS, GREEN, ROW_RULES, TAXI_TRIPS, YELLOW

AT = "2024-02-01 06:00:00"


@pytest.fixture(scope="module")
def trips(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def as_map(profiles):
    return {(r["column_name"], r["metric"]): r["metric_value"] for r in profiles.collect()}


def test_profile_has_seventeen_rows(trips):
    facts = profile.profile(trips, TAXI_TRIPS.profile, "r", "clean", "t", AT)
    found = as_map(facts)
    assert len(found) == 17
    assert found["*", "row_count"] == 7.0
    assert found["vendor_id", "null_rate"] == 1 / 7
    assert (found["total_amount", "min"], found["total_amount", "max"]) == (-40.0, 55.5)
    assert found["passenger_count", "avg"] == pytest.approx(19.0 / 6)


def test_profile_of_nothing(spark, trips):
    found = as_map(profile.profile(trips.where("false"), TAXI_TRIPS.profile, "r", "raw", "t", AT))
    assert found["*", "row_count"] == 0.0
    assert found["vendor_id", "null_rate"] == 0.0
    assert ("vendor_id", "min") not in found


def test_profile_skips_absent_columns_and_other_types(spark):
    df = spark.createDataFrame([(1, 2, None)], "a smallint, b int, c decimal(9,2)")
    found = as_map(profile.profile(df, ProfileSpec(("a", "b", "c", "gone")), "r", "raw", "t", AT))
    assert {c for c, _ in found} == {"*", "a", "b", "c"}
    assert ("b", "max") in found and ("a", "max") not in found and ("c", "max") not in found
    only = as_map(profile.profile(df, ProfileSpec(("b",), ("max",)), "r", "raw", "t", AT))
    assert only == {("b", "max"): 2.0}


def test_fused_layers_equal_separate_profiles(trips):
    layers = [
        profile.Layer("raw", "t"),
        profile.Layer("clean", "t", gate.accepted(ROW_RULES)),
        profile.Layer("consumption", "t", gate.accepted(ROW_RULES), CONSUMPTION_COLUMNS[1:]),
    ]
    fused = profile.profile_layers(trips, TAXI_TRIPS.profile, "r", layers, AT)
    clean = gate.clean_rows(trips, ROW_RULES)
    apart = profile.profile(trips, TAXI_TRIPS.profile, "r", "raw", "t", AT)
    apart = apart.union(profile.profile(clean, TAXI_TRIPS.profile, "r", "clean", "t", AT))
    shown = clean.select(*CONSUMPTION_COLUMNS[1:])
    apart = apart.union(profile.profile(shown, TAXI_TRIPS.profile, "r", "consumption", "t", AT))
    assert fused.exceptAll(apart).isEmpty() and apart.exceptAll(fused).isEmpty()


def test_profile_per_partition(trips):
    facts = profile.profile(trips, TAXI_TRIPS.profile, "r", "raw", "t", AT, "taxi_type")
    counts = {
        r["partition_key"]: r["metric_value"] for r in facts.where("column_name = '*'").collect()
    }
    assert counts == {"yellow": 3.0, "green": 3.0, "black": 1.0}


def test_canonical_of_two_vocabularies(spark):
    t = datetime(2023, 3, 4, 5)
    ddl = (
        "VendorID bigint, passenger_count double, total_amount double,"
        " {0}_pickup_datetime timestamp, {0}_dropoff_datetime timestamp,"
        " source_file string, extra int"
    )
    yellow = spark.createDataFrame([(1, 1.0, 2.0, t, t, "f", 9)], ddl.format("tpep"))
    green = spark.createDataFrame([(2, 1.0, 3.0, None, t, "g", 9)], ddl.format("lpep"))
    out = harmonize.canonical([(yellow, YELLOW), (green, GREEN)], TAXI_TRIPS)
    assert out.columns == [*CONSUMPTION_COLUMNS[:5], "source_file", "taxi_type", "year_month"]
    rows = {r["taxi_type"]: r for r in out.collect()}
    assert rows["yellow"]["year_month"] == "2023-03"
    assert rows["green"]["year_month"] is None and rows["green"]["vendor_id"] == 2


def test_kpis(trips):
    clean = gate.clean_rows(trips, ROW_RULES)
    monthly = marts.monthly_average(clean, "total_amount", "r", only="taxi_type = 'yellow'").first()
    assert monthly["avg_total_amount"] == pytest.approx((55.5 - 0.01 + 1.5) / 3)
    assert monthly["trip_count"] == 3
    hourly = marts.hourly_average(clean, "passenger_count", "r", only="year_month = '2023-05'")
    rows = {r["pickup_hour"]: r for r in hourly.collect()}
    assert rows[23]["avg_passenger_count"] is None and rows[23]["null_passenger_count"] == 1
    best = marts.extremes(hourly, "avg_passenger_count", "pickup_hour").first()
    assert (best["high_key"], best["low_key"]) == (6, 0)
    assert marts.completeness(hourly, "k", at_least=5).first()["passed"] is False
    assert marts.completeness(hourly, "k", exactly=4).first()["passed"] is True


def test_extremes_break_ties_by_key(spark):
    rows = [("b", 2.0), ("a", 2.0), ("d", 1.0), ("c", 1.0), ("e", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    row = marts.extremes(df, "v", "k").first()
    assert (row["high_key"], row["low_key"], row["overall"]) == ("a", "c", 1.5)


FACTS = (
    "run_id string, rule string, dimension string, scope string, severity string,"
    " passed boolean, measured double, threshold double, captured_at timestamp"
)


@pytest.fixture(scope="module")
def facts(spark):
    old, new = datetime(2024, 1, 1), datetime(2024, 1, 8)
    return spark.createDataFrame(
        [
            ("z", "a", "accuracy", "row", "error", False, 0.9, 1.0, old),
            ("z", "hard_quarantine_rate", "accuracy", "aggregate", "warning", True, 0.2, None, old),
            ("m", "a", "accuracy", "row", "error", True, 1.0, 1.0, new),
            ("m", "b", "validity", "row", "warning", True, 0.5, 1.0, new),
            ("m", "uniqueness_rate", "uniqueness", "aggregate", "warning", False, 0.3, 0.01, new),
            ("m", "hard_quarantine_rate", "accuracy", "aggregate", "warning", True, 0.0, None, new),
        ],
        FACTS,
    )


def test_latest_is_by_time_not_by_name(facts):
    run = governance.latest_run(facts)
    assert [r["run_id"] for r in run.collect()] == ["m"]
    assert [r["run_id"] for r in governance.run_list(facts).collect()] == ["m", "z"]
    failed = governance.failed_rules(facts, run).collect()
    assert [r["rule"] for r in failed] == ["uniqueness_rate"]
    detail = governance.rule_detail(facts, run).collect()
    assert detail[0]["effect"] == "moves rows to quarantine" and len(detail) == 4


def test_scorecard_and_reliability(facts):
    card = {(r["run_id"], r["dimension"]): r for r in governance.scorecard(facts).collect()}
    assert card["z", "accuracy"]["pass_rate"] == 0.5
    assert card["m", "validity"]["quarantine_rate"] is None
    assert card["m", "uniqueness"]["uniqueness_metric"] == 0.3
    rolled = {r["run_id"]: r for r in governance.reliability(facts, 0.05).collect()}
    assert rolled["z"]["level"] == "bad" and rolled["z"]["hard_row_failures"] == 1
    assert rolled["m"]["mean_pass_rate"] == pytest.approx(2 / 3)
    assert rolled["m"]["within_cap"] and rolled["m"]["level"] == "bad"
    assert rolled["m"]["trusted"] is False and rolled["m"]["soft_failures"] == 1
    good = governance.reliability(facts.where("rule <> 'uniqueness_rate'"), 0.05)
    best = good.where("run_id = 'm'").first()
    assert best["level"] == "ok" and best["trusted"] is True


def test_preferred_layer_falls_back(spark):
    ddl = (
        "run_id string, layer string, table_name string, column_name string, metric string,"
        " metric_value double"
    )
    rows = [("a", layer, "t", "x", "max", 1.0) for layer in ("raw", "clean")]
    rows += [("b", layer, "t", "x", "max", 1.0) for layer in ("raw", "consumption")]
    out = governance.preferred_layer(spark.createDataFrame(rows, ddl)).collect()
    assert {(r["run_id"], r["layer"]) for r in out} == {
        ("a", "clean"),
        ("b", "raw"),
        ("b", "consumption"),
    }
    counted = spark.createDataFrame([("a", "raw", "t", "*", "row_count", 12.0)], ddl)
    assert governance.layer_rows(counted).first()["row_count"] == 12


def test_share_of_nothing_is_unknown(spark, trips):
    none = trips.where("false")
    assert governance.quarantine_share(none, none).first()["quarantine_pct"] is None
    quarantine = gate.quarantine_rows(trips, ROW_RULES, "r")
    assert governance.quarantine_share(gate.clean_rows(trips, ROW_RULES), quarantine).first()[
        "quarantine_pct"
    ] == round(300 / 7, 4)
    marked = gate.mark(trips, ROW_RULES, "r")
    assert governance.marked_share(marked.where("false")).first()["quarantine_pct"] is None
    assert governance.marked_share(marked).first()["quarantine_pct"] == round(300 / 7, 4)


def test_parts_of_one_frame_are_counted_in_one_pass(spark):
    df = spark.range(10)
    counted = governance.counts_where(df, {"it's even": "id % 2 = 0", "none": "id < 0"})
    assert {tuple(r) for r in counted.collect()} == {("it's even", 5), ("none", 0)}


@pytest.fixture(scope="module")
def quarantine(spark):
    rows = [
        (f"t{i}", "run", "a,b" if i % 2 else "b", "validity" if i % 3 else None)
        for i in range(60)
    ]
    rows += [("x1", "old", "c, ,a", "accuracy"), ("x2", "lost", "a", "accuracy")]
    ddl = "trip_id string, dq_run_id string, dq_failed_rules string, dq_dominant_dimension string"
    return spark.createDataFrame(rows, ddl)


@pytest.fixture(scope="module")
def captures(spark):
    ddl = "run_id string, captured_at timestamp"
    rows = [
        ("run", datetime(2024, 2, 8, 23)),
        ("old", datetime(2024, 2, 1)),
        ("run", datetime(2024, 2, 2)),
    ]
    return triage.run_captures(spark.createDataFrame(rows, ddl))


def test_incident_counts(spark, quarantine):
    counts = triage.incident_counts(quarantine)
    found = {(r["run_id"], r["rule"]): r["incident_count"] for r in counts.collect()}
    assert found == {
        ("run", "a"): 30, ("run", "b"): 60, ("old", "c"): 1, ("old", "a"): 1, ("lost", "a"): 1,
    }
    top = triage.top_reasons(counts, 2).collect()
    assert [r["rule"] for r in top][:2] == ["b", "a"]
    runs = [r["run_id"] for r in top]
    every = {r["run_id"] for r in counts.collect()}
    assert set(runs) == every and max(map(runs.count, runs)) <= 2
    known = triage.enrich(counts, governance.rule_catalogue(spark, ROW_RULES)).collect()
    assert {r["severity"] for r in known} == {"—"}


def test_ageing_counts_runs_with_a_capture(quarantine, captures):
    ages = {r["run_id"]: r for r in triage.ageing(quarantine, captures, "2024-02-10").collect()}
    assert set(ages) == {"run", "old"}
    assert (ages["run"]["quarantined_rows"], ages["run"]["max_days"]) == (60, 2)
    assert ages["old"]["avg_days"] == 9.0
    buckets = triage.age_buckets(quarantine, captures, "2024-02-10").collect()
    assert [(r["run_id"], r["age_bucket"], r["row_count"]) for r in buckets] == [
        ("old", "8+ days", 1),
        ("run", "1-3 days", 60),
    ]
    today = triage.age_buckets(quarantine, captures, "2024-02-08").collect()
    assert [r["age_bucket"] for r in today] == ["4-7 days", "today"]


def test_runs_of_the_same_age_keep_buckets_of_their_own(spark, quarantine):
    at = datetime(2024, 2, 8)
    same = spark.createDataFrame([("run", at), ("old", at)], "run_id string, captured_at timestamp")
    buckets = triage.age_buckets(quarantine, same, "2024-02-10").collect()
    assert [(r["run_id"], r["row_count"], r["bucket_rank"]) for r in buckets] == [
        ("old", 1, 2),
        ("run", 60, 2),
    ]


def test_a_run_is_read_by_value_and_not_by_a_join(spark, quarantine):
    """The id is a scalar subquery: no join, no nested loop, and branches of a union filter by it."""
    runs = spark.createDataFrame(
        [("old", datetime(2024, 2, 1)), ("run", datetime(2024, 2, 8))],
        "run_id string, captured_at timestamp",
    )
    both = quarantine.unionByName(quarantine)
    own = governance.of_run(both, governance.latest_run(runs), "dq_run_id")
    plan = own._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Subquery" in plan
    assert {r["dq_run_id"] for r in own.collect()} == {"run"} and own.count() == 120
    assert governance.of_run(both, governance.latest_run(runs.limit(0)), "dq_run_id").count() == 0


def test_sample_is_capped_repeatable_and_seeded(quarantine):
    def draw(seed):
        drawn = triage.stratified_sample(quarantine, seed, ["trip_id"], 5)
        return {r["trip_id"] for r in drawn.collect()}

    first = draw("1")
    assert len(first) == 5 + 5 + 1 + 1
    assert first == draw("1") and first != draw("2")

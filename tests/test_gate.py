"""The row gate on small fixtures: split, trail, counts, unknown values."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime

import pytest

from trustgate import FailedRowsCheck, RowRule, SpecError
from trustgate.functions.expressions import as_rows, compare, fails, trail
from trustgate.operators import gate, metrics
from trustgate.plans.taxi import CHECKS, ROW_RULES, TAXI_TRIPS

SCHEMA = (
    "vendor_id bigint, passenger_count double, total_amount double, pickup_datetime timestamp,"
    " dropoff_datetime timestamp, taxi_type string, year_month string"
)


def at(hour, minute=0):
    return datetime(2023, 5, 1, hour, minute)


# A dropoff at the pickup, an unknown vendor, a fleet outside the list, and amounts of either sign.
ROWS = [
    (7, 1.0, 0.0, at(3, 5), at(3, 6), "green", "2023-05"),
    (None, 4.0, 31.25, at(4, 40), at(5, 1), "green", "2023-05"),
    (3, 0.0, 55.5, at(0), at(0, 1), "yellow", "2023-05"),
    (3, 6.0, 18.75, at(21, 30), at(21, 29), "green", "2023-05"),
    (7, 3.0, -0.01, at(6, 59), at(7), "yellow", "2023-05"),
    (9, 5.0, -40.0, at(8), at(8, 45), "black", "2023-05"),
    (9, None, 1.5, at(23), at(23, 58), "yellow", "2023-05"),
]


@pytest.fixture(scope="module")
def trips(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def test_soft_rules_never_remove_rows(trips):
    clean = gate.clean_rows(trips, ROW_RULES)
    assert clean.columns == trips.columns
    assert clean.count() == 4
    assert clean.where("passenger_count IS NULL OR passenger_count = 0").count() == 2
    assert clean.where("total_amount < 0").count() == 1


def test_quarantine_lists_every_failed_hard_rule(trips):
    rows = gate.quarantine_rows(trips, ROW_RULES, "r1", "2023-06-01 00:00:00").collect()
    assert {(r["dq_failed_rules"], r["dq_dominant_dimension"]) for r in rows} == {
        ("dropoff_after_pickup", "consistency"),
        ("vendor_id_not_null", "completeness"),
        ("taxi_type_valid", "validity"),
    }
    assert {(r["dq_run_id"], r["dq_engine"]) for r in rows} == {("r1", "trustgate")}
    assert all("total_amount_non_negative" not in r["dq_failed_rules"] for r in rows)


def test_missing_pickup_trips_three_rules_in_declaration_order(spark):
    row = (1, 1.0, 8.0, None, at(9), "yellow", None)
    df = spark.createDataFrame([row], SCHEMA)
    found = gate.quarantine_rows(df, ROW_RULES, "r").first()
    assert found["dq_failed_rules"] == "dropoff_after_pickup,pickup_not_null,year_month_in_window"
    assert found["dq_dominant_dimension"] == "consistency"


def test_gate_and_mark_keep_every_row(trips):
    clean, quarantine, summary, outcomes = gate.apply_gate(trips, ROW_RULES, "r")
    assert clean.count() + quarantine.count() == trips.count() == summary.first()["input_rows"]
    assert outcomes.count() == len(ROW_RULES)
    marked = gate.mark(trips, ROW_RULES, "r", "2023-06-01 00:00:00")
    kept = marked.where("NOT dq_quarantined").select(*trips.columns)
    assert kept.exceptAll(clean).isEmpty() and clean.exceptAll(kept).isEmpty()
    assert marked.where("dq_quarantined <> (dq_failed_rules IS NOT NULL)").isEmpty()
    assert marked.where("dq_quarantined AND dq_failed_rules = ''").isEmpty()


def test_violations_equal_exploded_trail(trips):
    stats = {r["rule"]: r["failed_rows"] for r in gate.rule_stats(trips, ROW_RULES).collect()}
    quarantine = gate.quarantine_rows(trips, ROW_RULES, "r")
    named = quarantine.selectExpr("explode(split(dq_failed_rules, ',')) AS rule")
    trails = {r["rule"]: r["count"] for r in named.groupBy("rule").count().collect()}
    assert {r.name: stats[r.name] for r in ROW_RULES if r.hard and stats[r.name]} == trails


@pytest.mark.parametrize("rule", ROW_RULES, ids=lambda r: r.name)
def test_unknown_counts_as_failure(spark, rule):
    empty = spark.createDataFrame([(None,) * 7], SCHEMA)
    assert empty.selectExpr(f"{fails(rule)} AS failed").first()["failed"] is True


def test_nan_is_above_every_number(spark):
    nan = float("nan")
    df = spark.createDataFrame([(1, nan, nan, at(1), at(2), "green", "2023-05")], SCHEMA)
    flags = gate.flag_rules(df, ROW_RULES).first()
    assert flags["fail_passenger_count_range"] is True
    assert flags["fail_total_amount_non_negative"] is False


def test_outcomes_and_validation_facts(spark, trips):
    outcomes = {r["rule"]: r for r in gate.rule_outcomes(trips, ROW_RULES).collect()}
    assert outcomes["pickup_not_null"]["outcome"] == "pass"
    assert outcomes["dropoff_after_pickup"]["outcome"] == "fail"
    assert outcomes["passenger_count_range"]["outcome"] == "warn"
    assert outcomes["dropoff_after_pickup"]["measured"] == pytest.approx(6 / 7)
    measures = metrics.measure(trips, TAXI_TRIPS, gate.accepted(ROW_RULES), ROW_RULES)
    facts = {r["rule"]: r for r in metrics.validation_rows(measures, TAXI_TRIPS, "r").collect()}
    assert len(facts) == 15
    assert facts["passenger_count_range"]["passed"] is True
    assert facts["passenger_count_range"]["measured"] == pytest.approx(5 / 7)
    assert facts["dropoff_after_pickup"]["passed"] is False
    assert facts["pickup_not_null"]["passed"] is True
    assert facts["pickup_not_null"]["measured"] == 1.0
    assert facts["hard_quarantine_rate"]["measured"] == pytest.approx(3 / 7)


def test_rare_violation_keeps_its_rate(spark):
    """16,526,016 rows with 795 violations of one rule: that rule alone fails."""
    counts = ", ".join(
        f"{795 if r.name == 'dropoff_after_pickup' else 0}L AS n_{r.name}" for r in ROW_RULES
    )
    wide = spark.range(1).selectExpr("16526016L AS total_rows", *counts.split(", "))
    records = [gate.row_rule_record(r, "r", None) for r in ROW_RULES]
    facts = {r["rule"]: r for r in as_rows(wide, records).collect()}
    assert [n for n, f in facts.items() if not f["passed"]] == ["dropoff_after_pickup"]
    assert facts["dropoff_after_pickup"]["measured"] == pytest.approx(0.999952, abs=1e-6)
    assert facts["dropoff_after_pickup"]["threshold"] == 1.0
    assert facts["vendor_id_not_null"]["measured"] == 1.0


def test_summary(trips):
    row = gate.gate_summary(trips, ROW_RULES).first()
    assert (row["input_rows"], row["clean_rows"], row["quarantine_rows"]) == (7, 4, 3)
    assert row["quarantine_rate"] == 3 / 7
    assert row["pass_rate_total_amount_non_negative"] == 5 / 7


def test_empty_input_fails_the_summary(spark, trips):
    with pytest.raises(Exception, match="empty input"):
        gate.gate_summary(trips.where("false"), ROW_RULES).collect()


def test_gate_needs_a_hard_rule(trips):
    with pytest.raises(SpecError):
        gate.clean_rows(trips, [r for r in ROW_RULES if not r.hard])


def test_declared_checks_agree_with_rules(trips):
    found = gate.check_agreement(trips, ROW_RULES, CHECKS).collect()
    assert {r["rule"] for r in found} == {r.name for r in ROW_RULES}
    assert all(r["disagreeing_rows"] == 0 for r in found)


def test_disagreement_and_missing_checks_are_reported(trips):
    checks = [FailedRowsCheck("vendor_id_enum", "vendor_id = 2"), FailedRowsCheck("extra", "true")]
    found = {r["rule"]: r for r in gate.check_agreement(trips, ROW_RULES, checks).collect()}
    # The rule knows none of the vendors, and no row has the one that the check looks for.
    assert found["vendor_id_enum"]["disagreeing_rows"] == 7
    assert found["extra"]["has_rule"] is False and found["extra"]["disagreeing_rows"] is None
    assert found["taxi_type_valid"]["has_check"] is False


def test_failed_rows_scan_ignores_unknown(trips):
    checks = [
        FailedRowsCheck("few", "passenger_count < 2"),
        FailedRowsCheck("soft", "total_amount < 0", "warning"),
    ]
    found = {r["rule"]: r for r in gate.failed_rows_scan(trips, checks).collect()}
    assert (found["few"]["failed_rows"], found["few"]["outcome"]) == (2, "fail")
    assert (found["soft"]["failed_rows"], found["soft"]["outcome"]) == (2, "warn")


def test_names_with_quotes_survive(spark):
    rule = RowRule("it's", "validity", "error", "id > 0")
    df = spark.range(2)
    assert df.selectExpr(f"{trail([rule])} AS t").first()["t"] == "it's"
    assert gate.rule_stats(df, [rule]).first()["failed_rows"] == 1


def test_bad_specs_raise():
    with pytest.raises(SpecError):
        RowRule("a,b", "validity", "error", "true")
    with pytest.raises(SpecError):
        RowRule("a", "beauty", "error", "true")
    with pytest.raises(SpecError):
        RowRule("a", "validity", "fatal", "true")
    with pytest.raises(SpecError):
        compare("x", 1, "near")
    with pytest.raises(SpecError):
        replace(TAXI_TRIPS, row_rules=ROW_RULES + ROW_RULES[:1])


@pytest.mark.parametrize("name", ["passenger_count_range", "vendor_id_not_null"])
def test_mandatory_rules_keep_their_severity(name):
    other = {"error": "warning", "warning": "error"}
    changed = tuple(
        replace(r, severity=other[r.severity]) if r.name == name else r for r in ROW_RULES
    )
    with pytest.raises(SpecError, match=name):
        replace(TAXI_TRIPS, row_rules=changed)
    with pytest.raises(SpecError, match=name):
        replace(TAXI_TRIPS, row_rules=tuple(r for r in ROW_RULES if r.name != name))

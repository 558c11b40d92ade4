"""A product with other columns, names and questions through the same jobs."""

from __future__ import annotations

import uuid
from dataclasses import replace
from datetime import datetime, timedelta

import pytest

from trustgate import (
    AggregateRule,
    FeedSpec,
    FitnessRule,
    KpiSpec,
    ProductSpec,
    ProfileSpec,
    RowRule,
)
from trustgate.plans.run import Run, Store, lineage, run_product
from trustgate.plans.spec import ColumnSpec

AT = "2024-06-01 08:00:00"
COLUMNS = ("meter", "kwh", "read_at", "site", "day")
READINGS = ProductSpec(
    table="readings",
    interface="readings_v1",
    feeds=(
        FeedSpec("north", {"meter": "id", "kwh": "energy", "read_at": "ts"}),
        FeedSpec("south", {"meter": "meter_id", "kwh": "used", "read_at": "at"}),
    ),
    row_rules=(
        RowRule("meter_present", "completeness", "error", "meter IS NOT NULL"),
        RowRule("kwh_sign", "accuracy", "error", "kwh >= 0"),
        RowRule("kwh_small", "validity", "warning", "kwh < 50"),
    ),
    aggregate_rules=(
        AggregateRule("day_coverage", "completeness", "distinct_year_month", 3, "gte", "error"),
        AggregateRule("repeats", "uniqueness", "duplicate_rate", 0.2, "lte", "warning"),
    ),
    fitness_rules=(FitnessRule("columns", "cde_columns_present", 1.0, "eq"),),
    profile=ProfileSpec(COLUMNS),
    models={"readings": tuple(ColumnSpec(c, "string") for c in COLUMNS)},
    business_key=("meter", "read_at"),
    event_time="read_at",
    period="day",
    period_format="yyyy-MM-dd",
    category="site",
    expected_categories=("north", "south"),
    critical_columns=("meter", "kwh"),
    consumption_columns=COLUMNS,
    renamed_columns={"kwh": "energy_kwh"},
    periods=("2024-05-01", "2024-05-02", "2024-05-03"),
    kpis=(
        KpiSpec(
            "kwh_per_day",
            "day",
            {"total_kwh": "sum(kwh)", "readings": "count(1)"},
            exactly="periods",
        ),
        KpiSpec(
            "largest_per_meter",
            "meter",
            {"largest": "max(kwh)"},
            only="site = 'south'",
            at_least=2,
        ),
    ),
)


def land(spark, folder):
    for d, day in enumerate(READINGS.periods):
        start = datetime.fromisoformat(day)
        for feed, names in (("north", "id, energy, ts"), ("south", "meter_id, used, at")):
            data = [(m, 1.5 * m + d, start + timedelta(hours=m)) for m in range(1, 6)]
            data += [(None, 1.0, start), (9, -4.0, start), (1, 60.0, start)]
            a, b, c = names.split(", ")
            df = spark.createDataFrame(data, f"{a} bigint, {b} double, {c} timestamp")
            df.write.parquet(f"{folder}/{feed}/{day}")


def test_a_second_product(spark, tmp_path):
    land(spark, tmp_path / "landing")
    store = Store(prefix=f"p{uuid.uuid4().hex[:8]}_", location=str(tmp_path / "warehouse"))
    template = f"{tmp_path}/landing/{{feed}}/{{period}}"
    results = run_product(spark, READINGS, store, "r1", template, AT)
    assert [(r.job, r.blocked_by) for r in results] == [
        ("ingest", ()),
        ("build_clean", ()),
        ("publish_consumption", ()),
        ("analyse", ()),
    ]
    run = Run(spark, READINGS, store, "r1")
    counts = {r["object"]: r["row_count"] for r in lineage(run).collect()}
    assert counts == {
        "raw.north_raw": 24,
        "raw.south_raw": 24,
        "clean.readings": 36,
        "clean.readings_quarantine": 12,
        "consumption.readings": 36,
    }
    days = run.table("consumption", "kwh_per_day").orderBy("day").collect()
    assert [(r["day"], r["readings"]) for r in days] == [(p, 12) for p in READINGS.periods]
    assert days[0]["total_kwh"] == pytest.approx(2 * (1.5 * 15 + 60))
    meters = run.table("consumption", "largest_per_meter").collect()
    assert {r["meter"]: r["largest"] for r in meters} == {1: 60.0, 2: 5.0, 3: 6.5, 4: 8.0, 5: 9.5}
    renamed = run.table("consumption", "readings_v1")
    assert renamed.columns == ["meter", "energy_kwh", "read_at", "site", "day"]
    assert run.table("raw", "north_raw").where("site_hint = 'north'").count() == 24
    rules = {r["rule"]: r for r in run.facts("dq_validation_result").collect()}
    assert rules["day_coverage"]["measured"] == 3.0
    assert rules["kwh_small"]["measured"] == 42 / 48
    reasons = run.table("governance", "vw_incident_quarantine_top_rules").collect()
    assert {(r["rule"], r["incident_count"]) for r in reasons} == {
        ("meter_present", 6),
        ("kwh_sign", 6),
    }


def test_a_question_without_its_rows_blocks(spark, tmp_path):
    land(spark, tmp_path / "landing")
    store = Store(prefix=f"p{uuid.uuid4().hex[:8]}_", location=str(tmp_path / "warehouse"))
    kpis = (replace(READINGS.kpis[1], at_least=6), READINGS.kpis[0])
    template = f"{tmp_path}/landing/{{feed}}/{{period}}"
    results = run_product(spark, replace(READINGS, kpis=kpis), store, "r1", template, AT)
    assert results[-1].job == "analyse" and results[-1].blocked_by == ("largest_per_meter",)
    assert not spark.catalog.tableExists(store.name("consumption", "kwh_per_day"))
    none = run_product(spark, replace(READINGS, kpis=()), store, "r2", template, AT)
    assert none[-1].ok


def test_facts_of_a_run_are_sums_of_its_statistics(spark, tmp_path):
    """Row counts of all layers follow from one stored pass over the gated rows."""
    land(spark, tmp_path / "landing")
    store = Store(prefix=f"p{uuid.uuid4().hex[:8]}_", location=str(tmp_path / "warehouse"))
    template = f"{tmp_path}/landing/{{feed}}/{{period}}"
    run_product(spark, READINGS, store, "r1", template, AT)
    run = Run(spark, READINGS, store, "r1")
    facts = run.facts("run_statistics")
    assert facts.agg({"n": "sum"}).first()[0] == 48
    # Facts of the clean and the published rows are sums of the statistics.
    for layer in ("clean", "consumption"):
        own = run.facts("data_profile").where(f"layer = '{layer}' AND metric = 'row_count'")
        assert own.first()["metric_value"] == 36.0

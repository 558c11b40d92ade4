"""The product's jobs end to end on small landing files with drifting layouts."""

from __future__ import annotations

import uuid
from dataclasses import replace
from datetime import datetime, timedelta

import pytest

from trustgate.operators import metrics
from trustgate.plans import taxi
from trustgate.plans.run import Run, Store, lineage, run_product

AT = "2023-06-01 08:00:00"


def land(spark, folder, skip_green_late_hours=False):
    """Five months of both feeds; types and columns change in the third month."""
    for i, period in enumerate(taxi.PERIODS):
        start = datetime(2023, i + 1, 1)
        for feed, prefix in (("yellow", "tpep"), ("green", "lpep")):
            hours = 4 if feed == "yellow" or skip_green_late_hours else 24
            rows = [
                (
                    1 + h % 2,
                    1.0 + h % 3,
                    10.0 + i + h,
                    start + timedelta(hours=h),
                    start + timedelta(hours=h, minutes=10),
                )
                for h in range(hours)
            ]
            rows.append((1, None, -5.0, start, start + timedelta(minutes=5)))
            if feed == "yellow" and i == 0:
                rows.append((None, 1.0, 3.0, start, start + timedelta(minutes=5)))
                rows.append((1, 1.0, 3.0, start, start - timedelta(minutes=5)))
            df = spark.createDataFrame(
                rows,
                f"VendorID bigint, passenger_count double, total_amount double,"
                f" {prefix}_pickup_datetime timestamp, {prefix}_dropoff_datetime timestamp",
            )
            if i < 2:
                df = df.selectExpr(
                    "CAST(VendorID AS DOUBLE) AS VendorID",
                    "CAST(passenger_count AS BIGINT) AS passenger_count",
                    *df.columns[2:],
                )
            else:
                df = df.selectExpr("*", "'0.5' AS congestion_surcharge")
            df.coalesce(1).write.parquet(f"{folder}/{feed}_tripdata_{period}.parquet")


def new_store(tmp_path):
    return Store(prefix=f"t{uuid.uuid4().hex[:8]}_", location=str(tmp_path / "warehouse"))


def test_two_runs_end_to_end(spark, tmp_path):
    land(spark, tmp_path / "landing")
    store = new_store(tmp_path)
    landing = f"{tmp_path}/landing/{taxi.FEED_PATH}"
    spec = replace(
        taxi.TAXI_TRIPS,
        aggregate_rules=tuple(
            r if r.name != "volume_sanity" else replace(r, threshold=0.1)
            for r in taxi.AGGREGATE_RULES
        ),
    )
    first = run_product(spark, spec, store, "z-first", landing, AT)
    assert [r.job for r in first] == ["ingest", "build_clean", "publish_consumption", "analyse"]
    assert all(r.ok for r in first), first
    second = run_product(spark, spec, store, "a-second", landing, "2023-06-02 08:00:00")
    assert all(r.ok for r in second)

    total = 5 * (5 + 25) + 2
    counts = {r["object"]: r["row_count"] for r in lineage(Run(spark, spec, store, "x")).collect()}
    assert counts["raw.yellow_tripdata"] + counts["raw.green_tripdata"] == total
    assert counts["clean.taxi_trips_quarantine"] == 2
    assert counts["clean.taxi_trips"] == counts["consumption.taxi_trips"] == total - 2

    raw = spark.table(store.name("raw", "yellow_tripdata"))
    assert dict(raw.dtypes)["VendorID"] == "bigint"
    assert dict(raw.dtypes)["congestion_surcharge"] == "double"
    assert raw.where("source_file IS NULL OR ingest_ts IS NULL").count() == 0
    assert raw.where("congestion_surcharge IS NULL").count() == 5 * 2 + 2

    facts = spark.table(store.name("governance", "dq_validation_result"))
    assert facts.groupBy("run_id").count().collect()[0]["count"] == 15
    trails = spark.table(store.name("governance", "vw_incident_quarantine_top_rules")).collect()
    assert {(r["rule"], r["incident_count"]) for r in trails} == {
        ("vendor_id_not_null", 1),
        ("dropoff_after_pickup", 1),
    }
    latest = spark.table(store.name("governance", "vw_profile_latest"))
    assert {r["run_id"] for r in latest.select("run_id").distinct().collect()} == {"a-second"}
    assert latest.count() == 3 * 17
    card = spark.table(store.name("governance", "vw_dq_scorecard")).where("run_id = 'a-second'")
    evaluated = {r["dimension"]: r["rules_evaluated"] for r in card.collect()}
    assert evaluated == {
        "completeness": 7,
        "accuracy": 3,
        "validity": 3,
        "consistency": 1,
        "uniqueness": 1,
    }
    assert spark.table(store.name("governance", "vw_fitness_summary")).count() == 6
    renamed = spark.table(store.name("consumption", "vw_taxi_trips_tlc"))
    assert renamed.columns[0] == "VendorID" and "tpep_pickup_datetime" in renamed.columns
    monthly = spark.table(store.name("consumption", taxi.KPI_MONTHLY)).orderBy("year_month")
    january = monthly.first()
    assert january["trip_count"] == 5
    assert january["avg_total_amount"] == pytest.approx((10 + 11 + 12 + 13 - 5) / 5)


@pytest.mark.parametrize("publish_blocked", [False, True])
def test_run_stops_at_the_job_that_blocks(spark, tmp_path, publish_blocked):
    land(spark, tmp_path / "landing", skip_green_late_hours=True)
    store = replace(new_store(tmp_path), publish_blocked=publish_blocked)
    template = f"{tmp_path}/landing/{taxi.FEED_PATH}"
    results = run_product(spark, taxi.TAXI_TRIPS, store, "r", template, AT)
    assert [r.job for r in results] == ["ingest", "build_clean", "publish_consumption"]
    assert results[-1].blocked_by == ("q2_hours_coverage",)
    assert spark.table(store.name("governance", "vw_fitness_summary")).count() == 3
    assert spark.catalog.tableExists(store.name("consumption", "taxi_trips")) is publish_blocked


def test_blocked_gate_leaves_the_published_rows(spark, tmp_path):
    land(spark, tmp_path / "landing")
    store = new_store(tmp_path)
    template = f"{tmp_path}/landing/{taxi.FEED_PATH}"
    run_product(spark, taxi.TAXI_TRIPS, store, "good", template, AT)
    clean = store.name("clean", "taxi_trips")
    before = spark.table(clean).count()
    strict = taxi.TAXI_TRIPS.with_rule("year_month_in_window", "year_month = '2023-01'")
    results = run_product(spark, strict, store, "bad-1", template, AT)
    assert results[-1].blocked_by == ("month_coverage",)
    assert spark.table(clean).count() == before
    runs = spark.table(store.name("clean", "taxi_trips_quarantine")).select("dq_run_id").distinct()
    assert [r[0] for r in runs.collect()] == ["good"]
    tables = [t.name for t in spark.catalog.listTables(store.schema("clean"))]
    (gated,) = [t for t in tables if t.startswith(f"taxi_trips_gated_{b'bad-1'.hex()}_")]
    kept = spark.table(store.name("clean", gated))
    assert kept.where("dq_quarantined").count() > 2


def test_missing_part_fails(spark, tmp_path):
    land(spark, tmp_path / "landing")
    spec = replace(taxi.TAXI_TRIPS, periods=(*taxi.PERIODS, "2023-06"))
    with pytest.raises(Exception, match="2023-06"):
        template = f"{tmp_path}/landing/{taxi.FEED_PATH}"
        run_product(spark, spec, new_store(tmp_path), "r", template, AT)


def test_missing_category_and_month_block_the_gate(spark, tmp_path):
    land(spark, tmp_path / "landing")
    spec = replace(
        taxi.TAXI_TRIPS.with_rule("year_month_in_window", "year_month IN ('2023-01')"),
        expected_categories=("yellow", "green", "blue"),
    )
    store = new_store(tmp_path)
    template = f"{tmp_path}/landing/{taxi.FEED_PATH}"
    results = run_product(spark, spec, store, "r", template, AT)
    assert results[-1].job == "build_clean"
    assert results[-1].blocked_by == ("month_coverage", "taxi_type=blue")
    stored = spark.table(store.name("governance", "dq_validation_result"))
    assert metrics.blocking(stored).count() == 1


def test_repeated_and_similar_run_ids_stay_apart(spark, tmp_path):
    """A blocked run changes no published row, a repeated one replaces its own facts."""
    land(spark, tmp_path / "landing")
    store = new_store(tmp_path)
    template = f"{tmp_path}/landing/{taxi.FEED_PATH}"
    spec = replace(taxi.TAXI_TRIPS, min_hours=1)
    first = run_product(spark, spec, store, "run-1", template, AT)
    assert first[1].ok
    before = spark.table(store.name("clean", "taxi_trips")).count()
    facts = spark.table(store.name("governance", "dq_validation_result")).count()
    run_product(spark, spec, store, "run-1", template, AT)
    assert spark.table(store.name("governance", "dq_validation_result")).count() == facts
    wrong = spec.with_rule("year_month_in_window", "year_month = '2023-01'")
    blocked = run_product(spark, wrong, store, "run_1", template, AT)
    assert not blocked[1].ok
    assert spark.table(store.name("clean", "taxi_trips")).count() == before


def test_a_blocked_first_run_with_a_quote_shows_its_scorecard(spark, tmp_path):
    land(spark, tmp_path / "landing")
    store = new_store(tmp_path)
    template = f"{tmp_path}/landing/{taxi.FEED_PATH}"
    wrong = taxi.TAXI_TRIPS.with_rule("year_month_in_window", "year_month = '2023-01'")
    results = run_product(spark, wrong, store, "o'x", template, AT)
    assert [r.ok for r in results] == [True, False]
    views = [v.name for v in spark.catalog.listTables(store.schema("governance"))]
    cards = [v for v in views if "scorecard" in v]
    assert cards and spark.table(store.name("governance", cards[0])).count() > 0


def test_a_blocked_repeat_leaves_the_facts_of_the_published_rows(spark, tmp_path):
    """Facts of the repeat are kept under its attempt; the run's go on describing what is shown."""
    land(spark, tmp_path / "landing")
    store = new_store(tmp_path)
    template = f"{tmp_path}/landing/{taxi.FEED_PATH}"
    spec = replace(taxi.TAXI_TRIPS, min_hours=1)
    assert all(r.ok for r in run_product(spark, spec, store, "run-1", template, AT))

    def facts(name, run):
        rows = Run(spark, spec, store, run).facts(name).drop("facts_part").collect()
        return sorted(map(str, rows))

    names = ("dq_validation_result", "data_profile", "fitness_for_use_result")
    before = {name: facts(name, "run-1") for name in names}
    wrong = spec.with_rule("year_month_in_window", "year_month = '2023-01'")
    blocked = run_product(spark, wrong, store, "run-1", template, AT)
    assert blocked[-1].job == "build_clean" and not blocked[-1].ok
    raw = [x for x in before["data_profile"] if "layer='raw'" in x]
    assert raw and {name: facts(name, "run-1") for name in names} == before
    runs = spark.table(store.name("governance", "dq_validation_result")).select("run_id").distinct()
    (attempt,) = {r[0] for r in runs.collect()} - {"run-1"}
    assert attempt.startswith("run-1/")
    # A fitness rule that blocks leaves the facts about the published table likewise.
    late = replace(spec, hourly_period="2031-01")
    assert run_product(spark, late, store, "run-1", template, AT)[-1].job == "publish_consumption"
    assert facts("fitness_for_use_result", "run-1") == before["fitness_for_use_result"]

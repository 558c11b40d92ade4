"""Facts summed up from one pass over a gated table, against operators that read it each."""

from __future__ import annotations

import random
from dataclasses import replace
from datetime import datetime

import pytest

from trustgate.operators import gate, marts, metrics, profile, statistics
from trustgate.plans.spec import KpiSpec, SpecError
from trustgate.plans.taxi import ROW_RULES, TAXI_TRIPS

AT = "2024-02-08 06:00:00"
SCHEMA = (
    "vendor_id bigint, passenger_count double, total_amount double, pickup_datetime timestamp,"
    " dropoff_datetime timestamp, taxi_type string, year_month string"
)


def rows(n=500, seed=3):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        month = rng.choice([1, 1, 1, 2, 3, 4])
        start = datetime(2023, month, rng.randint(1, 3), rng.randint(0, 23))
        end = start if rng.random() < 0.9 else datetime(2022, 1, 1)
        kind = rng.choice(["yellow", "green", "green", "pink", f"odd{i}", None])
        out.append(
            (
                rng.choice([1, 2, None]),
                rng.choice([1.0, 9.0, None]),
                rng.choice([1.5, -2.25, None, 40.0]),
                start,
                end,
                kind,
                f"2023-{month:02d}",
            )
        )
    return out


@pytest.fixture(scope="module")
def loose():
    """The product without its rule on categories, so that odd ones reach the clean rows."""
    rules = tuple(r for r in ROW_RULES if r.name != "taxi_type_valid")
    return replace(TAXI_TRIPS, row_rules=rules, mandatory_rules={})


@pytest.fixture(scope="module")
def gated(spark, loose):
    df = spark.createDataFrame(rows(), SCHEMA).repartition(5)
    return gate.mark(df, loose.row_rules, "r", AT)


def test_measures_are_those_of_the_rows(gated, loose):
    stats = statistics.statistics(gated, loose)
    keys = statistics.distinct_keys(gated, loose.business_key)
    got = statistics.as_measures(stats, keys, loose.row_rules).first().asDict()
    rules = loose.row_rules
    want = metrics.measure(gated, loose, gate.accepted(rules), rules).first().asDict()
    assert got == want and want["clean_rows"] > 50


def as_set(facts):
    return {
        tuple(round(v, 9) if isinstance(v, float) else v for v in r)
        for r in facts.drop("captured_at").collect()
    }


def test_profiles_are_those_of_the_rows(gated, loose):
    stats = statistics.statistics(gated, loose)
    layers = [
        profile.Layer("raw", "t"),
        profile.Layer("clean", "t", "NOT dq_quarantined"),
        profile.Layer("consumption", "t", "NOT dq_quarantined", ("vendor_id", "year_month")),
    ]
    args = (loose.profile, "r", layers, AT)
    got = statistics.as_profile(stats, gated.columns, *args)
    want = profile.profile_layers(gated, *args)
    assert got.columns == want.columns and as_set(got) == as_set(want)
    both = as_set(statistics.as_profile(stats, gated.columns, *args, by_period=True))
    by_period = as_set(profile.profile_layers(gated, *args, "year_month"))
    # A layer without a row in a period has no figures there either way, but for its count.
    assert as_set(want) <= both and by_period <= both


def test_an_empty_table_has_no_statistics(spark, loose):
    df = gate.mark(spark.createDataFrame([], SCHEMA), loose.row_rules, "r", AT)
    stats = statistics.statistics(df, loose)
    assert stats.count() == 0
    keys = statistics.distinct_keys(df, loose.business_key)
    one = statistics.as_measures(stats, keys, loose.row_rules).first()
    assert (one["total_rows"], one["distinct_keys"], one["periods"]) == (0, 0, 0)


def test_the_report_on_categories_is_bounded_and_exact(spark, loose):
    """A column full of wrong values: the most frequent by name, the others by number."""
    start = datetime(2023, 1, 1)
    kinds = [f"wrong {i}" for i in range(3000)] + ["pink"] * 40 + [None] * 30 + ["yellow"] * 5
    data = [(1, 1.0, 2.0, start, start, kind, "2023-01") for kind in kinds]
    df = gate.mark(spark.createDataFrame(data, SCHEMA), loose.row_rules, "r", AT)
    stats = statistics.statistics(df, loose)
    assert stats.count() <= 4
    found = statistics.wrong_categories(stats, df, loose, top=3)
    assert found[-1] == "taxi_type: 2999 further values in 2999 rows"
    assert set(found[:-1]) == {
        "taxi_type=NULL",
        "taxi_type=green",
        "taxi_type=pink",
        "taxi_type=wrong 0",
    }
    clean = df.where("taxi_type IN ('yellow')")
    (missing,) = statistics.wrong_categories(statistics.statistics(clean, loose), clean, loose)
    assert missing == "taxi_type=green"


def test_all_kpis_come_from_one_scan(spark, tmp_path):
    spark.createDataFrame(rows(), SCHEMA).write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    spec = replace(TAXI_TRIPS, hourly_period="2023-02")
    cube = marts.kpi_cube(df, spec)
    assert cube._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    monthly, hourly = (
        marts.kpi_rows(cube, spec, kpi.name, "r", AT).drop("run_id", "computed_at")
        for kpi in spec.kpis
    )
    own = marts.monthly_average(df, "total_amount", "r", only="taxi_type = 'yellow'")
    assert as_set(monthly.withColumn("captured_at", monthly[0])) == as_set(
        own.drop("run_id", "computed_at").withColumn("captured_at", own[0])
    )
    own = marts.hourly_average(df, "passenger_count", "r", only="year_month = '2023-02'")
    assert as_set(hourly.withColumn("captured_at", hourly[0])) == as_set(
        own.drop("run_id", "computed_at").withColumn("captured_at", own[0])
    )
    assert [k.needed(spec) for k in spec.kpis] == [{"exactly": 5}, {"at_least": 20}]


@pytest.mark.parametrize(
    "change", [{"measures": {}}, {"measures": {"a": "x + 1"}}, {"at_least": 2}, {"exactly": None}]
)
def test_a_kpi_that_cannot_be_answered_is_refused(change):
    kpi = {"name": "k", "grain": "g", "measures": {"n": "count(1)"}, "exactly": 1}
    with pytest.raises(SpecError):
        KpiSpec(**(kpi | change))

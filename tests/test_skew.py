"""Tables in which one order holds a third of all lines, and with it one month and one key."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from tests.test_queries import multiset

SOURCE = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not Path(SOURCE).exists(), reason="test tables not present")

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("skewed"))
    lines = spark.read.parquet(f"{SOURCE}/lineitem.parquet").repartition(12, "l_partkey")
    hot = lines.selectExpr(
        "IF(l_partkey % 3 = 0, 7L, l_orderkey) AS l_orderkey",
        *[c for c in lines.columns if c != "l_orderkey"],
    )
    hot.write.parquet(f"{folder}/lineitem.parquet")
    for name in ("orders", "events"):
        spark.read.parquet(f"{SOURCE}/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    yield folder
    for key in SETTINGS:
        spark.conf.unset(key)


@pytest.fixture(scope="module")
def duck(skewed):
    connection = duckdb.connect()
    for name in ("lineitem", "orders", "events"):
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{skewed}/{name}.parquet/*.parquet')"
        )
    yield connection
    connection.close()


@pytest.mark.parametrize(
    "name",
    [
        "validation_result",
        "duplicate_rate",
        "gate_quarantine",
        "gate_clean",
        "write_roundtrip",
        "incident_top_rules",
        "stratified_sample",
        "profile_by_partition",
        "kpi_monthly_avg",
    ],
)
def test_skewed_tables_give_whole_results(name, spark, skewed, duck):
    got = entry.queries()[name](spark, skewed)
    want = duck.sql(entry.oracle_sql()[name])
    assert multiset(got.columns, got.collect()) == multiset(want.columns, want.fetchall())


def test_the_hot_order_is_split_in_the_join(spark, skewed):
    df = entry.queries()["validation_result"](spark, skewed)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "SortMergeJoin(skew=true)" in final


def test_the_hot_key_leaves_each_task_as_one_row(spark, skewed):
    """Rows entering the key shuffle: at most one per task and distinct key."""
    df = entry.queries()["duplicate_rate"](spark, skewed)
    row = df.first()
    assert row["clean_rows"] > 2 * row["distinct_keys"]
    plan = df._jdf.queryExecution().executedPlan().toString()
    shuffle = plan.index("Exchange hashpartitioning(_key0")
    assert "partial_count(1)" in plan[shuffle:]

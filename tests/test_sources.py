"""Feeds with drifting layouts, and tables written, appended, published and read back."""

from __future__ import annotations

import glob
import os
import threading
import uuid

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from trustgate.sources import feeds, tables


@pytest.fixture
def schema(spark, tmp_path):
    name = f"s{uuid.uuid4().hex[:10]}"
    tables.ensure_namespaces(spark, [name], str(tmp_path))
    return name


def test_align_types_matches_the_exact_spelling(spark):
    ddl = "VendorID string, fee string, Airport_fee string"
    df = spark.createDataFrame([("1", "2.5", "0.1")], ddl)
    out = feeds.align_types(df, {"VendorID": "bigint", "fee": "double", "airport_fee": "double"})
    assert out.dtypes == [("VendorID", "bigint"), ("fee", "double"), ("Airport_fee", "string")]


def test_text_that_does_not_parse(spark):
    df = spark.createDataFrame([("x",)], "n string")
    assert feeds.align_types(df, {"n": "bigint"}, strict=False).first()["n"] is None
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        feeds.align_types(df, {"n": "bigint"}).collect()


def test_union_fills_absent_columns_and_ignores_case(spark):
    a = spark.createDataFrame([(1, 0.5)], "id int, airport_fee double")
    c = spark.createDataFrame([(2, 0.7, "x")], "id int, Airport_fee double, note string")
    out = feeds.union_parts([a, c])
    assert [x.lower() for x in out.columns] == ["id", "airport_fee", "note"]
    assert sorted(tuple(r) for r in out.collect()) == [(1, 0.5, None), (2, 0.7, "x")]
    with pytest.raises(ValueError):
        feeds.union_parts([])


def test_read_feed_scans_once_per_layout(spark, tmp_path):
    for period, ddl in (("01", "v bigint"), ("02", "v bigint"), ("03", "v double, extra string")):
        row = (3.0, "e") if "extra" in ddl else (int(period),)
        spark.createDataFrame([row], ddl).write.parquet(f"{tmp_path}/y_{period}")
    template = f"{tmp_path}/{{feed}}_{{period}}"
    df = feeds.read_feed(spark, template, "y", ["01", "02", "03"], {"v": "double"})
    assert dict(df.dtypes) == {"v": "double", "source_file": "string", "extra": "string"}
    rows = {r["v"]: (r["extra"], r["source_file"].split("/")[-2]) for r in df.collect()}
    assert rows == {1.0: (None, "y_01"), 2.0: (None, "y_02"), 3.0: ("e", "y_03")}
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parquet") == 2
    stamped = feeds.with_provenance(df, "y", "2024-01-01 00:00:00").first()
    assert stamped["taxi_type_hint"] == "y" and stamped["ingest_ts"].year == 2024


def test_missing_part_fails(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        feeds.read_feed(spark, f"{tmp_path}/{{feed}}_{{period}}", "y", ["01"], {})


def test_overwrite_replaces_rows_partitions_and_schema(spark, schema):
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        name = tables.qualified(schema, "t")
        first = spark.createDataFrame([(1, "2023-01"), (2, "2023-02")], "id int, m string")
        tables.write_table(first, name, ["m"])
        second = spark.createDataFrame([(3, "2023-02", True)], "id int, m string, flag boolean")
        tables.write_table(second, name, ["m"])
        assert [tuple(r) for r in spark.table(name).select("id", "m", "flag").collect()] == [
            (3, "2023-02", True)
        ]
        assert dict(spark.table(name).dtypes)["m"] == "string"
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")


def test_failed_overwrite_leaves_the_old_table(spark, schema):
    name = tables.qualified(schema, "t")
    df = spark.createDataFrame([(1, "a", True), (2, "b", None)], "id int, m string, f boolean")
    tables.write_table(df, name, ["m", "f"])
    assert spark.table(name).dtypes == [("id", "int"), ("m", "string"), ("f", "boolean")]
    broken = df.selectExpr("id", "m", "CAST(raise_error('stop') AS BOOLEAN) AS f")
    with pytest.raises(Exception, match="stop"):
        tables.write_table(broken, name, ["m"])
    assert sorted(tuple(r) for r in spark.table(name).collect()) == [
        (1, "a", True),
        (2, "b", None),
    ]


def test_a_table_may_be_replaced_from_itself(spark, schema):
    name = tables.qualified(schema, "t")
    tables.write_table(spark.range(5).toDF("id"), name)
    tables.write_table(spark.table(name).where("id > 2"), name)
    assert spark.table(name).count() == 2


def test_hot_partition_is_written_by_several_tasks(spark, tmp_path):
    """Two thirds of the rows share a month; no task writes them all, small months stay whole."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200KB")
    try:
        df = spark.range(0, 400_000, 1, 16).selectExpr(
            "id", "md5(CAST(id AS STRING)) AS h",
            "IF(id % 3 < 2, '2023-01', concat('2023-0', 2 + id % 4)) AS m",
        )
        tables.by_partition(df, ["m"]).write.partitionBy("m").parquet(f"{tmp_path}/hot")
        hot, small = (len(glob.glob(f"{tmp_path}/hot/m=2023-0{m}/*.parquet")) for m in (1, 2))
        assert hot >= 8 and small < hot
        assert spark.read.parquet(f"{tmp_path}/hot").count() == 400_000
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_append_merges_columns(spark, schema, tmp_path):
    old = spark.createDataFrame([("a", 1.0)], "run_id string, measured double")
    ddl = "run_id string, measured double, threshold double"
    new = spark.createDataFrame([("b", 2.0, 0.5)], ddl)
    path = f"{tmp_path}/facts"
    tables.append_facts(old, path)
    tables.append_facts(new, path)
    want = [("a", 1.0, None), ("b", 2.0, 0.5)]
    columns = ["run_id", "measured", "threshold"]
    read = tables.read_facts(spark, path).select(columns)
    assert sorted(tuple(r) for r in read.collect()) == want

    name = tables.qualified(schema, "facts")
    for facts in (old, new, old.selectExpr("'c' AS run_id")):
        tables.append_table(facts, name)
    got = sorted(tuple(r) for r in spark.table(name).select(columns).collect())
    assert got == [*want, ("c", None, None)]


def test_models_bind_parameters_and_frames(spark):
    df = spark.createDataFrame([("yellow", 1), ("green", 2)], "t string, n int")
    sql = "SELECT sum(n) AS n, :run_id AS run_id FROM {trips} WHERE t = :fleet"
    params = {"run_id": "it's", "fleet": "green"}
    row = tables.model_frame(spark, sql, params, {"trips": df}).first()
    assert (row["n"], row["run_id"]) == (2, "it's")
    with pytest.raises(Exception, match="UNBOUND_SQL_PARAMETER"):
        tables.model_frame(spark, sql, {"run_id": "r"}, {"trips": df}).collect()


def test_models_from_a_folder_become_tables_and_views(spark, schema, tmp_path):
    folder = tmp_path / "models"
    folder.mkdir()
    with pytest.raises(FileNotFoundError):
        tables.load_models(folder)
    (folder / "b.sql").write_text("SELECT :run_id AS run_id")
    (folder / "a.sql").write_text("SELECT 1 AS x")
    models = tables.load_models(folder)
    assert list(models) == ["a", "b"]
    made = tables.publish_tables(spark, models, schema, {"run_id": "r9"})
    assert made == [f"{schema}.a", f"{schema}.b"]
    assert spark.table(f"{schema}.b").first()["run_id"] == "r9"
    views = tables.publish_views(spark, {"v": f"SELECT x AS y FROM {schema}.a"}, schema)
    assert spark.table(views[0]).first()["y"] == 1
    for publish in (tables.publish_tables, tables.publish_views):
        with pytest.raises(ValueError):
            publish(spark, {}, schema)


def test_names():
    assert tables.qualified("clean", "t") == "clean.t"
    assert tables.qualified("clean", "t", "main") == "main.clean.t"


def test_staged_copy_lies_under_the_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    df = spark.createDataFrame([(1, "2023-01", None)], "id int, m string, x double")
    copy = tables.staged(df, ["m"])
    assert copy.schema.simpleString() == df.schema.simpleString()
    assert base in copy.inputFiles()[0]
    assert [tuple(r) for r in copy.collect()] == [(1, "2023-01", None)]


def test_managed_and_appended_tables_are_replaced_whole(spark, schema):
    managed, appended = tables.qualified(schema, "managed"), tables.qualified(schema, "appended")
    spark.range(5).toDF("id").write.saveAsTable(managed)
    tables.append_table(spark.range(5).toDF("id"), appended)
    for name in (managed, appended):
        for n in (100, 7):
            tables.write_table(spark.range(n).toDF("id"), name)
            assert spark.table(name).count() == n
        assert len(tables.drop_old_versions(spark, name)) == 1
        assert spark.table(name).count() == 7


def test_repeated_facts_take_the_place_of_the_earlier_ones(spark, schema):
    name = tables.qualified(schema, "repeated")
    for run, value in (("o'x", 1), ("run-1", 2), ("o'x", 3)):
        df = spark.createDataFrame([(run, value)], "run_id string, v int")
        tables.replace_facts(df, name, {"run_id": run})
    got = sorted(tuple(r) for r in spark.table(name).select("run_id", "v").collect())
    assert got == [("o'x", 3), ("run-1", 2)]


def test_a_part_with_files_of_two_layouts_keeps_all_columns(spark, tmp_path):
    part = f"{tmp_path}/f_p.parquet"
    spark.createDataFrame([(1,)], "a int").coalesce(1).write.parquet(part)
    more = spark.createDataFrame([(2, "x")], "a int, b string")
    more.coalesce(1).write.mode("append").parquet(part)
    df = feeds.read_feed(spark, f"{tmp_path}/{{feed}}_{{period}}.parquet", "f", ["p"], {})
    assert sorted(tuple(r) for r in df.select("a", "b").collect()) == [(1, None), (2, "x")]


def _jobs(spark, work):
    """What ``work`` returns, and how many jobs it ran."""
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, "counted")
    try:
        out = work()
        return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def _many_files(folder, parts, files):
    """Parts of tiny files; the type of ``v`` changes halfway, later parts have one more column."""
    for p in range(parts):
        late = p >= parts // 2
        os.makedirs(f"{folder}/y_{p:03d}")
        table = pa.table({"v": pa.array([p], pa.float64() if late else pa.int64())})
        if late:
            table = table.append_column("extra", pa.array(["e"]))
        for f in range(files):
            pq.write_table(table, f"{folder}/y_{p:03d}/part-{f:05d}.parquet")


def test_planning_a_feed_does_not_grow_with_its_files(spark, tmp_path):
    """Two thousand files take as many jobs to look at as twenty, and as many scans."""
    seen = {}
    for files in (1, 100):
        folder = f"{tmp_path}/{files}"
        _many_files(folder, 20, files)
        periods = [f"{p:03d}" for p in range(20)]
        df, jobs = _jobs(
            spark, lambda: feeds.read_feed(spark, folder + "/{feed}_{period}", "y", periods, {"v": "double"})
        )
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        seen[files] = (jobs, plan.count("parquet"))
        assert df.count() == 20 * files and df.where("extra = 'e'").count() == 10 * files
    assert seen[1][1] == seen[100][1] == 2
    # Listing many files is a job of its own, at most one for each look.
    assert seen[100][0] <= 2 * seen[1][0]


def test_types_that_alternate_take_one_scan_each(spark, tmp_path):
    for i, kind in enumerate(("bigint", "double", "bigint", "double", "bigint")):
        spark.range(1).selectExpr(f"CAST({i} AS {kind}) AS v").write.parquet(f"{tmp_path}/y_{i}")
    periods = [str(i) for i in range(5)]
    df = feeds.read_feed(spark, f"{tmp_path}/{{feed}}_{{period}}", "y", periods, {"v": "bigint"})
    assert df._jdf.queryExecution().optimizedPlan().toString().count("parquet") == 2
    assert sorted(r["v"] for r in df.collect()) == [0, 1, 2, 3, 4]


def test_an_empty_part_fails(spark, tmp_path):
    spark.range(1).write.parquet(f"{tmp_path}/y_1")
    os.makedirs(f"{tmp_path}/y_2")
    with pytest.raises(FileNotFoundError, match="y_2"):
        feeds.read_feed(spark, f"{tmp_path}/{{feed}}_{{period}}", "y", ["1", "2"], {})


def test_a_reader_never_misses_a_table_that_is_replaced(spark, schema):
    """While a table is replaced again and again, a reader sees one version or another, whole."""
    name = tables.qualified(schema, "t")
    rows = lambda n: spark.range(n).selectExpr("id", "id % 3 AS part")
    tables.write_table(rows(30), name, ["part"])
    seen, failed, stop = set(), [], threading.Event()

    def read():
        while not stop.is_set():
            try:
                seen.add(spark.table(name).count())
            except Exception as error:
                failed.append(error)

    reader = threading.Thread(target=read)
    reader.start()
    try:
        for n in (60, 90, 30, 60, 90):
            tables.write_table(rows(n), name, ["part"])
    finally:
        stop.set()
        reader.join()
    assert not failed and seen <= {30, 60, 90} and spark.table(name).count() == 90
    assert sorted(r[0] for r in spark.table(name).select("part").distinct().collect()) == [0, 1, 2]


def test_a_lost_file_raises_and_the_name_stays(spark, schema, monkeypatch):
    name = tables.qualified(schema, "t")
    tables.write_table(spark.range(5), name)
    save = tables.counted_save

    def lose(writer, df, path):
        written = save(writer, df, path)
        os.remove(sorted(glob.glob(f"{path.removeprefix('file:')}/part-*"))[0])
        return written

    monkeypatch.setattr(tables, "counted_save", lose)
    with pytest.raises(RuntimeError, match="100 rows were written"):
        tables.write_table(spark.range(0, 100, 1, 4), name)
    assert spark.table(name).count() == 5
    monkeypatch.undo()
    tables.write_table(spark.range(0), name)
    assert spark.table(name).count() == 0


def test_runs_at_the_same_time_keep_each_other_s_facts(spark, schema):
    name = tables.qualified(schema, "facts")

    failed = []

    def run(i, attempt):
        df = spark.createDataFrame([(f"run-{i}", attempt)], "run_id string, v int")
        try:
            tables.replace_facts(df, name, {"run_id": f"run-{i}", "layer": "raw"})
        except Exception as error:
            failed.append(error)

    for attempt in range(2):
        threads = [threading.Thread(target=run, args=(i, attempt)) for i in range(6)]
        for t in threads:
            t.start()
        for t in threads:
            t.join()
    got = sorted((r["run_id"], r["v"]) for r in spark.table(name).collect())
    assert not failed and got == [(f"run-{i}", 1) for i in range(6)]


def test_a_repeated_run_rewrites_its_own_files_alone(spark, schema):
    name = tables.qualified(schema, "facts")
    for run, v in (("a", 1), ("b", 2)):
        df = spark.createDataFrame([(run, v)], "run_id string, v int")
        tables.replace_facts(df, name, {"run_id": run})
    before = set(spark.table(name).inputFiles())
    wider = spark.createDataFrame([("b", 3, 0.5)], "run_id string, v int, x double")
    tables.replace_facts(wider, name, {"run_id": "b"})
    after = set(spark.table(name).inputFiles())
    assert len(before) == len(after) == 2 and len(before & after) == 1
    rows = sorted((r["run_id"], r["v"], r["x"]) for r in spark.table(name).collect())
    assert rows == [("a", 1, None), ("b", 3, 0.5)]
    tables.write_table(spark.range(1), tables.qualified(schema, "other"))
    with pytest.raises(ValueError, match="no column facts_part"):
        tables.replace_facts(wider, tables.qualified(schema, "other"), {"run_id": "b"})

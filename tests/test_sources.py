from datetime import datetime

import pytest
from pyspark.sql import functions as F

from millrace.errors import BadRegistry, EmptySource, NothingIngested, ScratchNotConfigured
from millrace.operators import models
from millrace.plans import training
from millrace.errors import ValidationFailed
from millrace.session import fresh_path, scratch_root, write_counted
from millrace.sources import files, jdbc, sinks
from millrace.sources.ingest import ingest


def test_scratch_is_the_clusters_folder(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")


def test_a_cluster_without_a_shared_folder_is_an_error():
    class Conf:
        def get(self, name, default):
            return default

    class Session:
        conf = Conf()
        sparkContext = type("C", (), {"master": "spark://host:7077", "applicationId": "a"})

    with pytest.raises(ScratchNotConfigured):
        scratch_root(Session())


def test_absent_and_empty_sources(spark):
    with pytest.raises(EmptySource):
        files.scan(spark, "/nowhere/at/all")
    with pytest.raises(EmptySource):
        files.scan_prefix(spark, "/nowhere/at/all/")
    with pytest.raises(EmptySource):
        files.scan_csv(spark, fresh_path(spark, "none"))
    with pytest.raises(EmptySource):
        files.require_rows(spark.range(0), "empty")


def test_csv_at_the_top_hides_nested_ones(spark):
    root = fresh_path(spark, "csv")
    spark.range(3).write.option("header", True).csv(f"{root}/deep/er")
    assert files.scan_csv(spark, root, "id long").count() == 3
    spark.range(10, 12).coalesce(1).write.option("header", True).mode("append").csv(root)
    assert sorted(r["id"] for r in files.scan_csv(spark, root).collect()) == [10, 11]


def test_stack_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "a int, b string")
    b = spark.createDataFrame([(2.5, 9)], "c double, a long")
    got = files.stack([a, b, b]).collect()
    assert [tuple(r) for r in got] == [(1, "x", None), (9, None, 2.5), (9, None, 2.5)]


def test_time_range_is_half_open_and_prunes(spark):
    days = [datetime(2024, 1, d) for d in range(1, 6)]
    df = spark.createDataFrame([(d, i) for i, d in enumerate(days)], "ts timestamp_ntz, i int")
    path = fresh_path(spark, "days")
    assert sinks.write_by_period(df, path, "ts", "day") == 5
    kept = files.between_times(files.scan(spark, path), "ts", "2024-01-02", "2024-01-04", ("day", "yyyy-MM-dd"))
    assert sorted(r["i"] for r in kept.collect()) == [1, 2]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_projection_reaches_the_scan(spark):
    path = fresh_path(spark, "wide")
    write_counted(spark.range(5).selectExpr("id as x", "id as y", "id as z"), path)
    kept = files.project(files.scan(spark, path), ["x"], "y").filter("x > 2")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<x:bigint,y:bigint>" in plan and "GreaterThan(x,2)" in plan


def test_table_names(spark):
    assert sinks.table_name("pay-sim.v1") == "lake.pay_sim_v1"
    df = spark.createDataFrame([("pay-sim.v1",)], "s string")
    assert df.select(sinks.table_name_column(F.col("s"))).first()[0] == "lake.pay_sim_v1"


def test_ingest(spark):
    root = fresh_path(spark, "in")
    spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string").write.option("header", True).csv(f"{root}/a/a-b.csv")
    spark.range(0).write.option("header", True).csv(f"{root}/empty/e.csv")
    with pytest.raises(BadRegistry):
        ingest(spark, [("just one",)], root, "1")
    with pytest.raises(BadRegistry):
        ingest(spark, ["ab"], root, "1")
    with pytest.raises(NothingIngested):
        ingest(spark, [(f"{root}/none", "n"), (f"{root}/empty", "e")], root, "1")
    spark.sql("CREATE DATABASE IF NOT EXISTS landed")
    for batch in ("1", "1", "2"):
        report = ingest(spark, [(f"{root}/a", "a-b"), (f"{root}/none", "n")], root, batch)
        assert [(r["short"], r["status"], r["rows"]) for r in report.collect()] == [("a-b", "ingested", 2), ("n", "skipped", 0)]
        assert {r["snapshot"] for r in report.collect()} == {None}
    assert files.scan_prefix(spark, f"{root}/raw/a-b/").count() == 4
    for batch, snapshot in (("1", 1), ("1", 1), ("2", 2)):
        report = ingest(spark, [(f"{root}/a", "a-b")], root, batch, namespace="landed")
        assert report.first()["snapshot"] == snapshot
    stored = spark.table("landed.a_b").filter("dataset = 'a-b'")
    assert stored.count() == 4 and {r[0] for r in stored.select("batch_id").distinct().collect()} == {"1", "2"}


def test_files_of_one_dataset_stay_apart(spark, tmp_path):
    folder = tmp_path / "odd.csv.d" / "in"
    folder.mkdir(parents=True)
    (folder / "prices.csv").write_text("id,price\n1,2.5\n")
    (folder / "shops.v1.csv").write_text("price,id,city\n9.5,7,x\n8.5,6,y\n")
    (folder / "deep").mkdir()
    (folder / "deep" / "hidden.csv").write_text("a\n1\n")
    spark.sql("CREATE DATABASE IF NOT EXISTS apart")
    root = fresh_path(spark, "apart")
    for uri in (str(folder), f"file://{folder}/"):
        report = ingest(spark, [(uri, "mixed")], root, "1", namespace="apart").collect()
        assert [(r["file"], r["table_name"], r["rows"]) for r in report] == [
            ("prices", "apart.prices", 1), ("shops.v1", "apart.shops_v1", 2),
        ]
    assert spark.table("apart.prices").select("id", "price").collect() == [(1, 2.5)]
    assert sorted(map(tuple, spark.table("apart.shops_v1").select("id", "price", "city").collect())) == [
        (6, 8.5, "y"), (7, 9.5, "x"),
    ]


def test_a_header_unlike_the_pinned_schema_fails(spark, tmp_path):
    (tmp_path / "good.csv").write_text("x,y\n1.0,2.0\n")
    (tmp_path / "swapped.csv").write_text("y,x\n1.0,2.0\n")
    report = ingest(spark, [(str(tmp_path), "training")], fresh_path(spark, "pinned"), "1").collect()
    assert [(r["file"], r["status"], r["rows"]) for r in report] == [("good", "ingested", 1), ("swapped", "failed", 0)]


def test_jdbc_options():
    assert jdbc.read_options("jdbc:x", "t") == {"url": "jdbc:x", "dbtable": "t"}
    split = jdbc.read_options("jdbc:x", "t", "id", 0, 100, 4, user="u")
    assert split == {
        "url": "jdbc:x", "dbtable": "t", "user": "u", "partitionColumn": "id", "lowerBound": "0",
        "upperBound": "100", "numPartitions": "4",
    }


def test_training_stops_at_a_failed_check(spark):
    rows = [(float(i), 2.0 * i + 1, i) for i in range(20)]
    good = spark.createDataFrame(rows, "a double, b double, i int")
    run = training.train(good, "a", "b")
    assert run.evaluation.first()["r2"] == pytest.approx(1.0)
    assert {r["check"] for r in run.raw_report.collect()} == {"row_count", "not_null", "unique_rows"}
    for bad in (
        spark.createDataFrame(rows + rows[:1], "a double, b double, i int"),
        spark.createDataFrame(rows + [(None, 1.0, 99)], "a double, b double, i int"),
        spark.createDataFrame(rows + [(float("nan"), 1.0, 99)], "a double, b double, i int"),
        spark.createDataFrame(rows + [(-1.0, 1.0, 99)], "a double, b double, i int"),
        good.limit(0),
    ):
        with pytest.raises(ValidationFailed):
            training.train(bad, "a", "b")


def test_the_run_registers_the_better_model(spark):
    path, registry = fresh_path(spark, "raw"), fresh_path(spark, "registry")
    rows = [(i, datetime(2024, 1, 1 + i % 28), float(i % 20), float((i % 20 - 10) ** 2)) for i in range(400)]
    write_counted(spark.createDataFrame(rows, "id long, ts timestamp_ntz, a double, b double"), path)
    trees = models.Candidate("trees", "gbt", (("maxIter", 3), ("maxDepth", 4), ("seed", 7)))
    versions = []
    for _ in range(2):
        run = training.train_and_register(
            spark, path, "ts", "id", "a", "b", "parabola", [models.Candidate("line", "linear"), trees], registry
        )
        found = {(r["candidate"], r["side"]): r["r2"] for r in run.compared.collect()}
        assert run.chosen == "trees" and found["trees", "valid"] > 0.9 > 0.1 > found["line", "valid"]
        meta = spark.read.json(run.metadata_path).first()
        assert meta["r2"] == pytest.approx(found["trees", "valid"]) and meta["mlflow_artifact_uri"] == run.model_path
        versions.append(meta["mlflow_registered_version"])
        again = models.load_model(run.model_path).transform(spark.createDataFrame([(10.0,), (0.0,)], "x double"))
        low, high = [r["trees"] for r in again.orderBy(F.desc("x")).collect()]
        assert low < 10 < high
    assert versions == ["1", "2"]


def test_snapshot_of_a_prefix(spark):
    root = fresh_path(spark, "objects")
    for i in range(2):
        df = spark.createDataFrame([(datetime(2024, 1, 1 + i), i)], "ts timestamp_ntz, v int")
        write_counted(df, f"{root}/part{i}")
    got = training.extract_snapshot(spark, f"{root}/", fresh_path(spark, "snap"), "ts")
    assert got.rows == 2 and got.facts.first()["rows"] == 2
    with pytest.raises(EmptySource):
        training.extract_snapshot(spark, f"{root}/", fresh_path(spark, "snap"), "ts", "2030-01-01", "2031-01-01")


def test_many_files_side_by_side(spark, tmp_path):
    registry = []
    for d in range(4):
        folder = tmp_path / f"set{d}"
        folder.mkdir()
        registry.append((str(folder), f"set{d}"))
        for n in range(15):
            # Three tables have a file in every dataset, the others one file each.
            name = f"shared{n}" if n < 3 else f"own{d}_{n}"
            bad = n == 7
            (folder / f"{name}.csv").write_text("id,v\n" + "".join(f"{i},{d}\n" for i in range(0 if bad else n + 1)))
    reports = []
    for run, at_once in enumerate((1, 6)):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS many{run}")
        report = ingest(spark, registry, fresh_path(spark, "many"), "1", namespace=f"many{run}", at_once=at_once)
        reports.append([(r["short"], r["file"], r["status"], r["rows"], r["snapshot"]) for r in report.collect()])
        assert spark.table(f"many{run}.shared1").count() == 8 and spark.table(f"many{run}.own2_9").count() == 10
    assert reports[0] == reports[1] and len(reports[0]) == 60
    assert [r[0] for r in reports[0]] == sorted(r[0] for r in reports[0])
    assert [r[4] for r in reports[0] if r[1] == "shared2"] == [1, 2, 3, 4]
    assert {r[2] for r in reports[0] if r[1].endswith("_7")} == {"skipped"}

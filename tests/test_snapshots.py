"""Numbered snapshots: reads as of a number, several writers, changes by predicate."""

import json
import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from millrace.errors import EmptySource, SchemaChanged, TableMoved
from millrace.operators import models
from millrace.session import fresh_path
from millrace.sources import objects, sinks, snapshots


def numbers(spark, low, high, files=1):
    return spark.range(low, high, 1, files).select("id", (F.col("id") % 3).alias("v"))


def ids(df):
    return sorted(r["id"] for r in df.collect())


def data_files(root):
    return {f for _, _, names in os.walk(f"{root}/data") for f in names if f.endswith(".parquet")}


def test_reads_as_of_a_number(spark):
    root = fresh_path(spark, "t")
    with pytest.raises(EmptySource):
        snapshots.read(spark, root)
    assert snapshots.latest(spark, root) == 0 and snapshots.history(spark, root).collect() == []
    assert [snapshots.append(numbers(spark, n, n + 2), root) for n in range(0, 10, 2)] == [1, 2, 3, 4, 5]
    for number in range(1, 6):
        assert ids(snapshots.read(spark, root, number)) == list(range(2 * number))
    for number in (0, 6):
        with pytest.raises(EmptySource):
            snapshots.read(spark, root, number)
    assert [(r["version"], r["base"], r["rows"]) for r in snapshots.history(spark, root, 2).orderBy("version").collect()] == [
        (1, 0, 2), (2, 1, 2),
    ]
    assert ids(snapshots.rows_of_snapshots(spark, root, [1, 2])) == [0, 0, 1, 1, 2, 3]


def test_a_write_without_a_commit_is_not_seen(spark):
    root = fresh_path(spark, "t")
    snapshots.append(numbers(spark, 0, 3), root)
    lost = snapshots.stage_append(numbers(spark, 3, 9), root)
    assert lost.rows == 6 and ids(snapshots.read(spark, root)) == [0, 1, 2]


def test_a_batch_is_appended_once(spark):
    root = fresh_path(spark, "t")
    assert [snapshots.append(numbers(spark, 0, 3), root, b) for b in ("x", "y", "x")] == [1, 2, 1]
    first, second = (snapshots.stage_append(numbers(spark, 0, 3), root, "z") for _ in range(2))
    assert [snapshots.commit(spark, c) for c in (first, second)] == [3, 3]
    assert snapshots.read(spark, root).count() == 9


def test_only_touched_files_are_written(spark):
    root = fresh_path(spark, "t")
    snapshots.append(numbers(spark, 0, 40, files=4), root)
    before = data_files(root)
    assert snapshots.update_rows(spark, root, F.col("id").isin(3, 5, 12), {"v": F.lit(-1).cast("long")}) == 2
    change = snapshots.history(spark, root).filter("version = 2").first()
    assert len(change["removed"]) == 2 and change["rows"] == 20 and before < data_files(root)
    got = {r["id"]: r["v"] for r in snapshots.read(spark, root).collect()}
    assert got == {n: -1 if n in (3, 5, 12) else n % 3 for n in range(40)}
    assert {r["id"]: r["v"] for r in snapshots.read(spark, root, 1).collect()} == {n: n % 3 for n in range(40)}
    # Twice changed, a whole file gone, and a change that hits nothing.
    snapshots.delete_rows(spark, root, F.col("id") < 20)
    assert ids(snapshots.read(spark, root)) == list(range(20, 40))
    snapshots.update_rows(spark, root, F.col("id") == 25, {"v": F.lit(7).cast("long")})
    snapshots.delete_rows(spark, root, F.col("id") > 99)
    assert ids(snapshots.read(spark, root)) == list(range(20, 40)) and snapshots.latest(spark, root) == 5
    assert snapshots.delete_rows(spark, root) == 6
    assert snapshots.read(spark, root).collect() == [] and snapshots.read(spark, root, 5).count() == 20
    snapshots.append(numbers(spark, 1, 2), root)
    assert ids(snapshots.read(spark, root)) == [1]


def test_unknown_predicates_change_nothing(spark):
    root = fresh_path(spark, "t")
    snapshots.append(spark.createDataFrame([(1, None), (2, "x")], "id long, v string"), root)
    snapshots.update_rows(spark, root, F.col("v") != "x", {"v": F.lit("z")})
    snapshots.delete_rows(spark, root, F.col("v") == "y")
    assert sorted(map(tuple, snapshots.read(spark, root).collect())) == [(1, None), (2, "x")]


def test_a_change_keeps_rows_appended_meanwhile(spark):
    root = fresh_path(spark, "t")
    snapshots.append(numbers(spark, 0, 10), root)
    change = snapshots.stage_delete(spark, root, F.col("id") < 5)
    snapshots.append(numbers(spark, 100, 103), root)
    assert snapshots.commit(spark, change) == 3
    assert ids(snapshots.read(spark, root)) == [5, 6, 7, 8, 9, 100, 101, 102]


def test_two_changes_of_the_same_rows(spark):
    root = fresh_path(spark, "t")
    snapshots.append(numbers(spark, 0, 10), root)
    snapshots.append(numbers(spark, 10, 20), root)
    first = snapshots.stage_update(spark, root, F.col("id") == 3, {"v": F.lit(8).cast("long")})
    second = snapshots.stage_delete(spark, root, F.col("id") == 4)
    elsewhere = snapshots.stage_delete(spark, root, F.col("id") == 14)
    assert snapshots.commit(spark, first) == 3
    with pytest.raises(TableMoved):
        snapshots.commit(spark, second)
    # Another file: both changes count.
    assert snapshots.commit(spark, elsewhere) == 4
    got = {r["id"]: r["v"] for r in snapshots.read(spark, root).collect()}
    assert got[3] == 8 and 4 in got and 14 not in got


def test_columns_may_be_added_but_not_changed(spark):
    root = fresh_path(spark, "t")
    snapshots.append(numbers(spark, 0, 2), root)
    more = snapshots.stage_append(numbers(spark, 2, 3).withColumn("w", F.lit("w")), root)
    snapshots.append(numbers(spark, 3, 4).withColumn("u", F.lit(1.5)), root)
    snapshots.commit(spark, more)
    assert snapshots.read(spark, root, 1).columns == ["id", "v"]
    rows = {r["id"]: (r["u"], r["w"]) for r in snapshots.read(spark, root).collect()}
    assert rows == {0: (None, None), 1: (None, None), 2: (None, "w"), 3: (1.5, None)}
    with pytest.raises(SchemaChanged):
        snapshots.append(numbers(spark, 0, 1).withColumn("v", F.lit("text")), root)
    assert snapshots.latest(spark, root) == 3


@pytest.mark.parametrize("rename", [False, True])
def test_one_of_many_creates_a_file(spark, monkeypatch, rename):
    path = f"{fresh_path(spark, 't')}/commits/1.json"
    if rename:
        # The way of file systems other than the local one, one writer after the other.
        monkeypatch.setattr(os, "link", lambda *_: pytest.fail("not for this store"))
        for text, made in (("first", True), ("second", False)):
            objects.put(spark, f"{path}.draft", text)
            draft, place = (objects.store(spark, p)[0] for p in (f"{path}.draft", path))
            assert objects.rename_once(spark, draft, place) is made
        assert objects.get(spark, path) == "first"
    else:
        with ThreadPoolExecutor(8) as pool:
            made = list(pool.map(lambda n: objects.create_once(spark, path, f"writer {n}"), range(8)))
        assert sum(made) == 1
    assert spark.read.text(path).count() == 1


RUNS = "name string, run_id string, artifact_uri string, r2 double"


def test_writers_register_at_once(spark):
    root = fresh_path(spark, "registry")
    runs = [spark.createDataFrame([("m", f"r{n}", "u", 0.5)], RUNS) for n in range(4)]
    with ThreadPoolExecutor(4) as pool:
        given = [r.first()["version"] for r in pool.map(lambda df: models.register(df, root), runs)]
    assert sorted(given) == [1, 2, 3, 4]
    kept = {r["run_id"]: r["version"] for r in models.read_registry(spark, root).collect()}
    assert kept == {f"r{n}": v for n, v in enumerate(given)}


def test_a_registration_that_comes_second_is_numbered_again(spark, monkeypatch):
    root = fresh_path(spark, "registry")
    mine, other = (spark.createDataFrame([("m", run, "u", 0.5)], RUNS) for run in ("mine", "other"))
    stage, waiting = snapshots.stage_append, [True]

    def interrupted(*args, **names):
        change = stage(*args, **names)
        if waiting:
            waiting.clear()
            assert models.register(other, root).first()["version"] == 1
        return change

    monkeypatch.setattr(snapshots, "stage_append", interrupted)
    assert models.register(mine, root).first()["version"] == 2
    assert {r["run_id"]: r["version"] for r in models.read_registry(spark, root).collect()} == {"other": 1, "mine": 2}


def test_the_catalog_holds_what_is_committed(spark):
    root = fresh_path(spark, "t")
    spark.sql("CREATE DATABASE IF NOT EXISTS shown")
    assert sinks.append_table(numbers(spark, 0, 3), "shown.t", "1", root) == 1
    snapshots.stage_append(numbers(spark, 50, 60), root, prefix="commit=")
    assert sinks.append_table(numbers(spark, 3, 5).withColumn("w", F.lit("w")), "shown.t", "2", root) == 2
    assert ids(spark.table("shown.t")) == [0, 1, 2, 3, 4]
    assert [r["w"] for r in spark.table("shown.t").orderBy("id").collect()] == [None] * 3 + ["w"] * 2
    assert sorted(ids(snapshots.read(spark, root, 1))) == [0, 1, 2]
    # A run that ended after its commit and before the catalog had it.
    change = snapshots.stage_append(numbers(spark, 5, 6), root, "/3", prefix="commit=")
    snapshots.commit(spark, change)
    assert ids(spark.table("shown.t")) == [0, 1, 2, 3, 4]
    assert sinks.append_table(numbers(spark, 5, 6), "shown.t", "3", root) == 3
    assert ids(spark.table("shown.t")) == [0, 1, 2, 3, 4, 5]


def test_a_commit_is_one_line_of_json(spark):
    root = fresh_path(spark, "t")
    snapshots.append(numbers(spark, 0, 1), root, "b")
    (name,) = os.listdir(f"{root}/commits")
    with open(f"{root}/commits/{name}") as file:
        record = json.load(file)
    assert name == "000000000001.json" and record["batch"] == "b" and record["removed"] == []
    assert os.listdir(f"{root}/drafts") == []

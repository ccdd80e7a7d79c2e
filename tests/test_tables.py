from datetime import datetime

import pytest
from pyspark.sql import functions as F

from millrace.operators import features, inference, joins, models, tables
from millrace.session import fresh_path

T0 = datetime(2024, 1, 1)
APPROVALS = "id string, status string, resolved_by string, resolved_at timestamp_ntz, reason string"
DECISIONS = "decision_id long, approval_id string, action string, approver string, reason string, decided_at timestamp_ntz"


@pytest.fixture
def approvals(spark):
    return spark.createDataFrame(
        [("a", "pending", None, None, "ask a"), ("b", "approved", "x", T0, "ask b"), ("c", "pending", None, None, "ask c"),
         ("d", "pending", None, None, "ask d")],
        APPROVALS,
    )


@pytest.fixture
def decisions(spark):
    return spark.createDataFrame(
        [
            (1, "a", "reject", "m1", "late", datetime(2024, 2, 2)),
            (2, "a", "approve", "m2", "ok", datetime(2024, 2, 1)),
            (3, "b", "reject", "m1", "no", datetime(2024, 2, 1)),
            (4, "zz", "approve", "m1", "no", datetime(2024, 2, 1)),
            (5, "c", "postpone", "m1", "", datetime(2024, 2, 1)),
            (6, "d", "approve", "m1", "undated", None),
            (7, "d", "reject", "m2", "dated", datetime(2024, 3, 1)),
        ],
        DECISIONS,
    )


def test_resolution(approvals, decisions):
    got = {r["id"]: tuple(r)[1:] for r in tables.resolve_approvals(approvals, decisions).collect()}
    # The decision's reason takes the place of the request's own.
    assert got["a"] == ("approved", "m2", datetime(2024, 2, 1), "ok", "ok")
    assert got["b"] == ("approved", "x", T0, "ask b", None)
    assert got["c"] == ("pending", None, None, "ask c", None)
    assert got["d"] == ("rejected", "m2", datetime(2024, 3, 1), "dated", "dated")


def test_resolution_is_idempotent(approvals, decisions):
    once = tables.resolve_approvals(approvals, decisions).drop("decision_reason")
    twice = tables.resolve_approvals(once, decisions).drop("decision_reason")
    assert sorted(once.collect()) == sorted(twice.collect())


def test_outcomes(approvals, decisions):
    got = {r["decision_id"]: r["outcome"] for r in tables.decision_outcomes(approvals, decisions).collect()}
    assert got == {
        1: "not_found", 2: "applied", 3: "not_found", 4: "not_found", 5: "invalid", 6: "not_found", 7: "applied",
    }


def test_table_life(spark):
    """Create, insert, read, update, read, delete all, count, drop."""
    path = fresh_path(spark, "life")
    schema = spark.createDataFrame([], "id long, v string").schema
    tables.create_if_absent(spark, "e2e_test", schema, path)
    tables.create_if_absent(spark, "e2e_test", schema, path)
    tables.insert(spark.createDataFrame([("insert_test", 1)], "v string, id long"), "e2e_test")
    assert [tuple(r) for r in spark.table("e2e_test").collect()] == [(1, "insert_test")]
    changed = tables.update(spark.table("e2e_test"), F.col("v") == "insert_test", {"v": F.lit("updated_test")})
    assert [r["v"] for r in changed.collect()] == ["updated_test"]
    assert tables.delete(changed).count() == 0
    tables.drop(spark, "e2e_test")
    assert not spark.catalog.tableExists("e2e_test")


def test_unknown_predicates_change_nothing(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "id long, v string")
    assert tables.delete(df, F.col("v") == "x").count() == 1
    got = tables.update(df, F.col("v") != "x", {"v": F.lit("z")}).collect()
    assert {r["id"]: r["v"] for r in got} == {1: None, 2: "x"}


def test_cascade_keeps_rows_without_a_reference(spark):
    child = spark.createDataFrame([(1, 10), (2, 11), (3, None)], "id long, parent long")
    gone = spark.createDataFrame([(10,), (10,)], "pid long")
    assert sorted(r["id"] for r in joins.cascade_delete(child, "parent", gone, "pid").collect()) == [2, 3]


def test_pending_are_oldest_first(spark):
    rows = [("b", "s", "u", "t", "{}", "r", "pending", T0), ("a", "s", "u", "t", "{}", "r", "pending", T0),
            ("z", "s", "u", "t", "{}", "r", "pending", datetime(2023, 1, 1)), ("q", "s", "u", "t", "{}", "r", "approved", T0),
            ("n", "s", "nobody", "t", "{}", "r", "pending", T0)]
    approvals = spark.createDataFrame(
        rows, "id string, session_id string, user_id string, tool_name string, tool_args string, reason string, status string, created_at timestamp_ntz"
    )
    users = spark.createDataFrame([("u", "e", "n")], "id string, email string, name string")
    got = joins.pending_approvals(approvals, users).collect()
    assert [r["id"] for r in got] == ["z", "a", "b"] and got[0]["requester_email"] == "e"


def test_registry(spark):
    path = fresh_path(spark, "registry")
    runs = spark.createDataFrame([("m", "r1", "u", 0.5), ("m", "r2", "u", 0.4), ("k", "r3", "u", 0.1)], "name string, run_id string, artifact_uri string, r2 double")
    assert models.read_registry(spark, path).collect() == []
    first = models.register(runs, path)
    assert sorted((r["name"], r["version"]) for r in first.collect()) == [("k", 1), ("m", 1), ("m", 2)]
    models.register(runs.filter("run_id = 'r1'"), path)
    registry = models.read_registry(spark, path)
    newest = {r["name"]: (r["version"], r["run_id"]) for r in tables.latest_versions(registry).collect()}
    assert newest == {"k": (1, "r3"), "m": (3, "r1")}


def test_failed_registration_leaves_no_version(spark):
    runs = spark.createDataFrame([("m", "r1", "u", 0.5)], "name string, run_id string, artifact_uri string, r2 double")
    got = models.register(runs, "nosuchscheme://x/y").first()
    assert got["version"] is None and got["r2"] == 0.5


def test_promotion(spark):
    m = spark.createDataFrame([("a", 0.5, 1.0), ("b", 0.7, 2.0), ("c", 0.7, 3.0)], "candidate string, r2 double, rmse double")
    base = spark.createDataFrame([(0.7,)], "r2 double")
    got = models.promotion(m, base).first()
    assert (got["candidate"], got["promote"]) == ("b", False)
    assert models.promotion(m, base.limit(0)).first()["promote"] is True
    assert models.best(m).first()["candidate"] == "a"


def test_search_respects_its_budget(spark):
    df = spark.createDataFrame([(float(i), 2.0 * i, 3.0 * i + 1) for i in range(60)], "x double, x2 double, y double")
    grid = [models.Candidate("one", "linear"), models.Candidate("two", "linear")]
    assert list(models.search(df, grid, ["x", "x2"], "y", budget_seconds=0)) == ["one"]
    fitted = models.search(df, grid, ["x", "x2"], "y")
    got = models.compare(fitted, df, "y").collect()
    assert [r["candidate"] for r in got] == ["one", "two"] and got[0]["r2"] == pytest.approx(1.0)
    path = fresh_path(spark, "model")
    models.save_model(fitted["one"], path)
    models.save_model(fitted["one"], path)
    assert models.load_model(path).transform(df).count() == 60


def test_scaling_without_spread(spark):
    df = spark.createDataFrame([(5.0,), (5.0,), (None,)], "v double")
    got = features.normalise(df, "v", features.fit_scaling(df, "v")).collect()
    assert [tuple(r)[1:] for r in got] == [(0.0, 0.0), (0.0, 0.0), (None, None)]


def test_split_is_a_partition_by_key(spark):
    df = spark.range(1000).selectExpr("id", "id % 100 as k")
    sides = df.withColumn("side", features.split_column("k"))
    assert sides.filter("side is null").isEmpty()
    assert sides.groupBy("k").agg(F.countDistinct("side").alias("n")).filter("n > 1").isEmpty()
    assert 600 < sides.filter("side = 'train'").count() < 950


def test_unseen_category_and_one_hot(spark):
    df = spark.createDataFrame([("b",), ("a",), ("q",), (None,)], "c string")
    mapping = features.fit_ordinal(df.filter("c != 'q'"), "c")
    got = {r["c"]: r["c_code"] for r in features.ordinal_encode(df, "c", mapping).collect()}
    assert got == {"a": 0, "b": 1, "q": -1, None: -1}
    hot = {r["c"]: (r["c_a"], r["c_b"]) for r in features.one_hot(df, "c", ["a", "b"]).collect()}
    assert hot == {"a": (1, 0), "b": (0, 1), "q": (0, 0), None: (0, 0)}


@pytest.fixture
def make_model():
    def factory():
        seen = []

        def model(requests):
            seen.append(len(requests))
            if any(r["messages"][-1]["content"] == "bad" for r in requests):
                raise ValueError("cannot answer")
            return [{"content": f"{max(seen)}", "usage": {"prompt_tokens": 1}} for _ in requests]

        return model

    return factory


def test_inference(spark, make_model):
    rows = [(str(i), [("user", "bad" if i == 50 else "hi")] if i % 10 else []) for i in range(1, 100)]
    rows.append(("null", None))
    df = spark.createDataFrame(rows, "request_id string, messages array<struct<role: string, content: string>>")
    got = {r["request_id"]: r for r in inference.infer(inference.with_request_defaults(df), make_model).collect()}
    assert len(got) == 100
    assert got["10"]["error"] == "empty_messages" and got["null"]["error"] == "empty_messages"
    assert got["1"]["success"] and got["1"]["usage"]["prompt_tokens"] == 1
    assert got["1"]["usage"]["completion_tokens"] is None
    assert all(int(r["content"]) <= 16 for r in got.values() if r["success"])


def test_one_failing_request_does_not_spoil_its_batch(spark, make_model):
    rows = [(str(i), [("user", "bad" if i == 5 else "hi")]) for i in range(20)]
    df = spark.createDataFrame(rows, "request_id string, messages array<struct<role: string, content: string>>").coalesce(1)
    got = {r["request_id"]: r for r in inference.infer(df, make_model).collect()}
    assert [k for k, r in got.items() if not r["success"]] == ["5"]
    assert got["5"]["error"] == "cannot answer"

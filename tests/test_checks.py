from datetime import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.errors import ValidationFailed
from millrace.operators import checks

NAN = float("nan")


def frame(spark, rows, schema="id long, v double, c string"):
    return spark.createDataFrame(rows, schema)


def only(report):
    rows = report.collect()
    assert len(rows) == 1
    return rows[0]


def test_missing_values_are_skipped_by_range_and_counted_by_null_check(spark):
    df = frame(spark, [(1, 0.0, "a"), (2, 1e9, "a"), (3, None, "a"), (4, NAN, None)])
    r = only(checks.row_report(df, [checks.between(df, "v", 0, 1e9)]))
    assert (r["success"], r["evaluated"], r["unexpected"]) == (True, 2, 0)
    r = only(checks.row_report(df, [checks.not_null(df, "v")]))
    assert (r["success"], r["evaluated"], r["unexpected"]) == (False, 4, 2)
    assert only(checks.row_report(df, [checks.not_null(df, "v", 0.5)]))["success"]


@pytest.mark.parametrize("value,bad", [(0.0, 0), (1e9, 0), (-0.001, 1), (1e9 + 1, 1)])
def test_range_bounds_are_inclusive(spark, value, bad):
    df = frame(spark, [(1, value, "a")])
    assert only(checks.row_report(df, [checks.between(df, "v", 0, 1e9)]))["unexpected"] == bad


def test_row_checks_share_one_scan(spark):
    df = frame(spark, [(1, 1.0, "a")])
    report = checks.row_report(df, [checks.row_count(1), checks.between(df, "v", 0, 2), checks.in_set(df, "c", ["a"])])
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1
    assert report.count() == 3


def test_empty_frame(spark):
    df = frame(spark, [])
    rows = {r["check"]: r for r in checks.report(
        checks.row_report(df, [checks.row_count(1), checks.between(df, "v", 0, 1), checks.mean_within(df, "v", 0, 1)]),
        checks.unique_rows(df), checks.unique_key(df, ["id"]),
    ).collect()}
    assert not rows["row_count"]["success"]
    assert rows["between"]["success"] and rows["unique_rows"]["success"] and rows["unique_key"]["success"]
    assert not rows["mean_within"]["success"]


def test_duplicate_rows_treat_missing_as_equal(spark):
    df = frame(spark, [(None, NAN, None), (None, NAN, None), (1, 0.0, "a"), (1, -0.0, "a"), (1, 0.0, "b")])
    found = {r["c"]: r["copies"] for r in checks.duplicate_rows(df).collect()}
    assert found == {None: 2, "a": 2}
    r = only(checks.unique_rows(df))
    assert (r["success"], r["evaluated"], r["unexpected"]) == (False, 5, 2)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2), st.sampled_from([0.0, 1.0, NAN, None]), st.sampled_from(["a", None])), max_size=30))
def test_excess_is_rows_minus_distinct(spark, rows):
    df = frame(spark, rows)
    assert only(checks.unique_rows(df))["unexpected"] == df.count() - df.distinct().count()


def test_duplicate_key_with_other_payload(spark):
    df = frame(spark, [(1, 1.0, "a"), (1, 2.0, "b"), (2, 3.0, "c")])
    assert only(checks.unique_rows(df))["success"]
    r = only(checks.unique_key(df, ["id"]))
    assert (r["success"], r["unexpected"], r["detail"]) == (False, 1, "1 repeated")


def test_foreign_key_counts_rows_and_passes_null(spark):
    child = frame(spark, [(1, 0.0, ""), (9, 0.0, ""), (9, 0.0, ""), (None, 0.0, "")])
    parent = spark.createDataFrame([(1,), (2,)], "pid long")
    r = only(checks.foreign_key(child, "id", parent, "pid"))
    assert (r["success"], r["evaluated"], r["unexpected"]) == (False, 3, 2)
    r = only(checks.foreign_key(child.filter("id = 1 or id is null"), "id", parent, "pid"))
    assert r["success"]


def test_required_set_and_its_complement(spark):
    present = spark.createDataFrame([("a",), ("b",), ("z",)], "name string")
    assert only(checks.required_set(["a", "b"], present, "name"))["success"]
    r = only(checks.required_set(["a", "q", "p"], present, "name"))
    assert (r["success"], r["unexpected"], r["detail"]) == (False, 2, "p,q")
    wanted = spark.createDataFrame([("a",), ("q",)], "name string")
    missing = checks.missing_names(wanted, present, "name")
    held = wanted.join(present, "name", "left_semi")
    assert missing.unionByName(held).count() == 2


def test_missing_day(spark):
    days = [datetime(2024, 1, d, 5) for d in (1, 2, 4)]
    df = spark.createDataFrame([(d,) for d in days], "ts timestamp_ntz")
    gaps = [str(r["day"]) for r in checks.missing_days(df, "ts", "2024-01-01", "2024-01-05").collect()]
    assert gaps == ["2024-01-03"]
    assert only(checks.complete_days(df, "ts", "2024-01-01", "2024-01-03"))["success"]
    assert not only(checks.complete_days(df, "ts", "2024-01-01", "2024-01-06"))["success"]


def test_unknown_category_and_time_bounds(spark):
    df = frame(spark, [(1, 1.0, "a"), (2, 1.0, "q"), (3, 1.0, None)])
    r = only(checks.row_report(df, [checks.in_set(df, "c", ["a", "b"])]))
    assert (r["evaluated"], r["unexpected"]) == (2, 1)
    assert [tuple(r) for r in checks.unexpected_categories(df, "c", ["a"]).collect()] == [("q", 1)]
    times = spark.createDataFrame(
        [(datetime(2024, 1, 1),), (datetime(2024, 1, 3),), (datetime(2023, 12, 31),), (None,)], "ts timestamp_ntz"
    )
    r = only(checks.row_report(times, [checks.sane_time(times, "ts", "2024-01-01", "2024-01-02")]))
    assert (r["evaluated"], r["unexpected"]) == (4, 3)


def test_label_balance(spark):
    df = spark.createDataFrame([(1,)] * 9 + [(0,)], "y int")
    assert only(checks.label_balance(df, "y", 0.1))["success"]
    assert not only(checks.label_balance(df, "y", 0.2))["success"]
    assert not only(checks.label_balance(df.filter("y = 1"), "y", 0.1))["success"]


def test_schema_check(spark):
    df = frame(spark, [(1, 1.0, "a")])
    assert only(checks.schema_check(df, df.schema))["success"]
    other = T.StructType([T.StructField("id", T.StringType()), T.StructField("w", T.DoubleType())])
    r = only(checks.schema_check(df, other))
    assert r["detail"] == "c:unexpected,id:type,v:unexpected,w:missing" and r["unexpected"] == 4


def test_sketched_distribution_is_near_the_exact_one(spark):
    df = spark.range(1000).select(F.col("id").cast("double").alias("v"))
    exact = checks.distribution(df, "v").first()
    near = checks.distribution(df, "v", exact=False).first()
    assert exact["p50"] == 499.5 and abs(near["p50"] - 499.5) <= 1


def test_constraints(spark):
    df = frame(spark, [(1, 1.0, "pending"), (1, 1.0, "odd")])
    report = checks.constraint_report(
        df, checks.Constraints(not_null=("id",), unique=(("id",),), domains={"c": ["pending"]})
    )
    assert {r["check"]: r["success"] for r in report.collect()} == {
        "not_null": True, "in_set": False, "unique_key": False,
    }


def test_gate(spark):
    df = frame(spark, [(1, 5.0, "a")])
    good = checks.row_report(df, [checks.between(df, "v", 0, 9)])
    assert checks.gate(df, good) is df
    with pytest.raises(ValidationFailed, match=r"between\(v\)"):
        checks.gate(df, checks.row_report(df, [checks.between(df, "v", 0, 1)]))


def test_checks_ride_along_on_a_write(spark):
    from millrace.session import fresh_path, write_counted

    df = frame(spark, [(1, 5.0, "a"), (2, None, "b"), (3, -1.0, "a")])
    listed = [checks.row_count(1), checks.between(df, "v", 0, 9), checks.not_null(df, "v")]
    watched, seen = checks.watch(df, listed)
    assert write_counted(watched, fresh_path(spark, "watched")) == 3
    assert sorted(seen().collect()) == sorted(checks.row_report(df, listed).collect())
    empty, seen = checks.watch(df.limit(0), listed)
    write_counted(empty, fresh_path(spark, "watched"))
    assert not seen().filter("check = 'row_count'").first()["success"]


def test_distribution_bounds(spark):
    df = spark.range(101).select(F.col("id").cast("double").alias("v"))
    fine = {"mean": (49, 51), "p50": (50, 50), "least": (0, 0), "stddev": (29, 30)}
    assert only(checks.distribution_check(df, "v", fine))["success"]
    r = only(checks.distribution_check(df, "v", {**fine, "p95": (0, 94), "most": (0, 99)}))
    assert (r["unexpected"], r["detail"]) == (2, "p95,most")
    assert not only(checks.distribution_check(df.filter("id < 0"), "v", fine))["success"]


def test_duplicates_with_nested_values(spark):
    rows = [(1, [0.0, NAN], ("a", 1.0)), (1, [-0.0, NAN], ("a", 1.0)), (2, [1.0], ("b", None)), (2, [1.0], ("c", None))]
    df = spark.createDataFrame(rows, "id int, v array<double>, s struct<n: string, d: double>")
    assert only(checks.unique_rows(df))["unexpected"] == 1
    assert checks.duplicate_rows(df).count() == 1
    assert only(checks.unique_rows(df.filter("id = 2")))["success"]

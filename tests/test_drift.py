"""Sketches of distributions and the distance between two of them."""

import math
import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import drift
from millrace.session import fresh_path

NAN = float("nan")


def column(spark, values):
    return spark.createDataFrame([(v, i) for i, v in enumerate(values)], "v double, i long").repartition(3)


def draws(seed, n, shift=0.0):
    r = random.Random(seed)
    return [r.choice([r.gauss(shift, 1), r.expovariate(0.01), -r.random(), 0.0, float(r.randrange(50))]) for _ in range(n)]


def plain_distance(a, b):
    places = sorted(set(a) | set(b))
    upto = lambda xs, v: sum(x <= v for x in xs) / len(xs)
    return max(abs(upto(a, v) - upto(b, v)) for v in places)


def test_buckets_are_narrow_and_in_order(spark):
    values = sorted(draws(1, 500) + [1e-300, -1e-300, 1e300, -1e300, 1.0, 2.0, 4.0, -4.0, float("inf"), -float("inf"), -0.0])
    rows = column(spark, values).select("v", drift.bucket(F.col("v"), 7).alias("b")).orderBy("v").collect()
    assert [r["b"] for r in rows] == sorted(r["b"] for r in rows)
    for r in rows:
        assert r["b"] == r["v"] if r["v"] == 0 or math.isinf(r["v"]) else r["b"] <= r["v"] <= r["b"] + abs(r["v"]) / 64


def test_parts_add_up_to_the_whole(spark):
    values = draws(2, 400) + [None, NAN, -0.0]
    df = column(spark, values)
    whole = drift.sketch(df, ["v", "i"])
    parts = [drift.sketch(df.filter(F.col("i") % 3 == n), ["v", "i"]) for n in range(3)]
    merged = drift.merge(*parts)
    assert sorted(map(tuple, whole.collect()), key=repr) == sorted(map(tuple, merged.collect()), key=repr)
    path = fresh_path(spark, "sketch")
    assert drift.save_sketch(merged, path) == whole.count()
    assert drift.load_sketch(spark, path).agg(F.sum("rows")).first()[0] == 2 * len(values)
    assert whole.filter("column = 'v' AND bucket IS NULL").first()["rows"] == 2


@pytest.mark.parametrize("shift", [0.0, 0.4, 5.0])
def test_distance_within_the_stated_error(spark, shift):
    a, b = draws(3, 500), draws(4, 300, shift)
    left, right = column(spark, a), column(spark, b)
    found = drift.drift(drift.sketch(left, ["v"]), drift.sketch(right, ["v"])).first()
    want = plain_distance(a, b)
    assert found["distance"] - 1e-12 <= want <= found["distance"] + found["error"] + 1e-12
    assert (found["reference_rows"], found["current_rows"]) == (500, 300)
    for way in ({}, {"one_task_rows": 0, "ranges": 7}):
        assert drift.exact_distance(left, right, "v", **way).first()["distance"] == pytest.approx(want)


def test_quantiles_are_close_below(spark):
    values = sorted(draws(5, 700))
    found = {r["probability"]: r["value"] for r in drift.sketch_quantiles(drift.sketch(column(spark, values), ["v"]), [0, 0.25, 0.5, 1]).collect()}
    for p, got in found.items():
        true = values[max(math.ceil(p * 700), 1) - 1]
        assert got <= true <= got + abs(true) / 64 + 1e-12
    assert len(found) == 4


def test_stability_and_missing_values(spark):
    a = column(spark, [float(i % 100) for i in range(1_000)] + [None] * 10)
    same = drift.drift(drift.sketch(a, ["v"]), drift.sketch(a, ["v"])).first()
    assert same["distance"] == 0 and same["stability"] == 0 and same["missing_change"] == 0
    half = column(spark, [float(i % 50) for i in range(1_000)] + [NAN] * 1_000)
    moved = drift.drift(drift.sketch(a, ["v"]), drift.sketch(half, ["v"])).first()
    assert moved["distance"] == pytest.approx(0.5) and moved["stability"] > 0.25
    assert moved["missing_change"] == pytest.approx(0.5 - 10 / 1_010)
    tenth = lambda n: (n + 0.5) / 1_005
    assert moved["stability"] == pytest.approx(
        5 * (tenth(200) - tenth(100)) * math.log(tenth(200) / tenth(100)) + 5 * (tenth(0) - tenth(100)) * math.log(tenth(0) / tenth(100)),
        rel=0.05,
    )


def test_columns_without_values(spark):
    none, some = column(spark, [None, NAN]), column(spark, [1.0, 2.0])
    empty = column(spark, [1.0]).limit(0)
    assert drift.drift(drift.sketch(empty, ["v"]), drift.sketch(empty, ["v"])).collect() == []
    for left, right in ((none, some), (some, none), (none, none), (empty, some)):
        row = drift.drift(drift.sketch(left, ["v"]), drift.sketch(right, ["v"])).first()
        assert row["distance"] is None

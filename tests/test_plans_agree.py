"""The ordinary plan and the one for very large entities give the same rows."""

import random

import pytest
from pyspark.sql import functions as F

from millrace.functions.text import money
from millrace.operators import features, ordered, timeline

SMALL = timeline.Limits(group_rows=1, slot_rows=4)


@pytest.fixture(scope="module")
def rows(spark):
    draw = random.Random(5)
    out = []
    for number in range(120):
        time = None if number % 5 == 0 else 1_000_000 * draw.randrange(40)
        value = None if number % 7 == 0 else float(draw.randrange(50))
        out.append((number, draw.choice(["a", "b"]), time, value))
    df = spark.createDataFrame(out, "tie long, key string, at long, v double")
    return df.withColumn("ts", F.timestamp_micros("at"))


def collected(df):
    return sorted(map(tuple, df.drop("ts").collect()), key=repr)


def test_rolling_spans_agree(rows):
    plain = timeline.rolling(rows, "key", "ts", "v", 5_000_000)
    sliced = timeline.rolling(rows, "key", "ts", "v", 5_000_000, limits=SMALL)
    assert collected(plain) == collected(sliced)


def test_trailing_rows_agree(rows):
    plain = timeline.trailing_rows(rows, "key", "ts", "tie", "v", 4)
    sliced = timeline.trailing_rows(rows, "key", "ts", "tie", "v", 4, limits=SMALL)
    assert plain.count() == 120
    assert collected(plain) == collected(sliced)


def test_auc_ignores_missing_scores_in_both_plans(spark):
    data = [(1, 0.9), (0, 0.1), (1, 0.4), (0, 0.5), (1, None), (0, None), (1, float("nan")), (0, 0.4)]
    df = spark.createDataFrame(data, "label int, score double")
    plain = ordered.auc(df, "label", "score").collect()
    ranged = ordered.auc(df, "label", "score", one_task_rows=1, ranges=3).collect()
    assert plain == ranged
    assert plain[0]["positives"] == 2 and plain[0]["negatives"] == 3
    assert plain[0]["auc"] == pytest.approx(4.5 / 6)


def test_scaling_takes_nan_as_missing(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (float("nan"),), (None,)], "v double")
    got = features.normalise(df, "v", features.fit_scaling(df, "v")).collect()
    assert sorted((r["v_z"], r["v_01"]) for r in got if r["v_z"] is not None) == [(-1.0, 0.0), (1.0, 1.0)]


def test_money_has_one_rounding_rule(spark):
    values = [0.125, 2.675, 1e13 + 0.125, 1e13 + 0.375, 5e13 + 0.625, -2e14 - 0.375, 8.5e15, 3e17, 1e13 + 0.998046875]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert [r[0] for r in df.select(money("v")).collect()] == [f"{v:.2f}" for v in values]


def test_a_burst_and_a_quiet_time_share_slots(spark):
    """720 hourly rows and a burst of 4000: no window is large, no entity has many slots."""
    hours = [(float(n), f"t{n % 10}{n}", "a", 3_600_000_000 * n) for n in range(720)]
    burst = [(float(n), f"t{n % 10}{n}", "a", 3_600_000_000 * 400 + n % 7) for n in range(1000, 5000)]
    df = spark.createDataFrame(hours + burst, "v double, tie string, key string, at long")
    df = df.withColumn("ts", F.timestamp_micros("at"))
    limits = timeline.Limits(group_rows=10, slot_rows=300, block_rows=300)
    axis = timeline.on_axis(df, "key", timeline.micros("ts"), tie=F.col("tie"))
    slots = [r["count"] for r in timeline._in_slots(axis, ["key", "pos", "tie"], limits).groupBy("slot").count().collect()]
    assert len(slots) <= 16 and max(slots) <= 900
    plain = timeline.trailing_rows(df, "key", "ts", "tie", "v", 5)
    sliced = timeline.trailing_rows(df, "key", "ts", "tie", "v", 5, limits=limits)
    assert collected(plain) == collected(sliced)
    found = timeline.asof_join(df, df.withColumnRenamed("v", "f"), "key", "ts", "ts", ["f"], tie="tie")
    cut = timeline.asof_join(df, df.withColumnRenamed("v", "f"), "key", "ts", "ts", ["f"], tie="tie", limits=limits)
    assert collected(found) == collected(cut)

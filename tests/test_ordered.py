import random

import numpy as np
import pytest

from millrace.operators import ordered

WAYS = [{}, {"one_task_rows": 0, "ranges": 5}]


@pytest.mark.parametrize("way", WAYS)
def test_running_totals(spark, way):
    rows = random.Random(3).sample(range(1000), 200)
    df = spark.createDataFrame([(v, v % 7) for v in rows], "v long, n long").repartition(6)
    got = {r["v"]: r["n_before"] for r in ordered.running_totals(df, "v", ["n"], **way).collect()}
    assert got == {v: sum(x % 7 for x in rows if x < v) for v in rows}


@pytest.mark.parametrize("way", WAYS)
def test_quantiles(spark, way):
    r = random.Random(4)
    values = [r.choice([1.5, r.random() * 10]) for _ in range(301)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    got = ordered.exact_quantiles(df, "v", (0.0, 0.1, 0.5, 0.99, 1.0), list("abcde"), **way).first()
    assert list(got) == pytest.approx(list(np.quantile(values, [0.0, 0.1, 0.5, 0.99, 1.0])))


@pytest.mark.parametrize("way", WAYS)
def test_auc(spark, way):
    r = random.Random(5)
    rows = [(r.randint(0, 1), r.choice([0.5, 0.25, r.random()])) for _ in range(150)]
    got = ordered.auc(spark.createDataFrame(rows, "y int, s double"), "y", "s", **way).first()
    pos, neg = [s for y, s in rows if y], [s for y, s in rows if not y]
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    assert got["auc"] == pytest.approx(wins / (len(pos) * len(neg)))


def test_auc_of_one_class_is_null(spark):
    df = spark.createDataFrame([(1, 0.2), (1, 0.4)], "y int, s double")
    assert ordered.auc(df, "y", "s").first()["auc"] is None


@pytest.mark.parametrize("way", WAYS)
def test_ordinal(spark, way):
    words = [f"w{i % 37:02d}" for i in range(200)] + ["Ä", "a", "Z", ""]
    df = spark.createDataFrame([(w,) for w in words] + [(None,)], "w string")
    got = {r["value"]: r["code"] for r in ordered.ordinal_codes(df, "w", **way).collect()}
    want = sorted(set(words), key=lambda w: w.encode())
    assert got == {w: i for i, w in enumerate(want)}


@pytest.mark.parametrize("ranges", [1, 7, 300])
def test_ranges_give_the_totals_of_one_task(spark, ranges):
    values = [float("nan"), float("-inf"), -1.5, 0.0, 2.0, 2.5, 1e300]
    df = spark.createDataFrame([(v, i + 1) for i, v in enumerate(values)], "v double, n long").repartition(4)
    plain = {repr(r["v"]): r["n_before"] for r in ordered.running_totals(df, "v", ["n"]).collect()}
    cut = ordered.running_totals(df, "v", ["n"], one_task_rows=0, ranges=ranges)
    assert {repr(r["v"]): r["n_before"] for r in cut.collect()} == plain
    # NaN comes last.
    assert plain["nan"] == sum(range(2, 8)) and plain["-inf"] == 0

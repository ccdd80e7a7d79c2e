"""Successive halving and boosting cut by validation."""

import pytest
from pyspark.sql import functions as F

from millrace.operators import models, search
from millrace.session import fresh_path


def test_rungs_keep_to_the_budget():
    for candidates in (1, 2, 3, 7, 16):
        for budget in (10, 1_000, 10**9):
            rungs = search.plan_rungs(candidates, 500, budget)
            assert rungs[0].candidates == candidates and rungs[-1].kept == 1
            assert sum(r.candidates * r.share * 500 for r in rungs) <= budget * (1 + 1e-9)
            shares = [r.share for r in rungs]
            assert shares == sorted(shares) and max(shares) <= 1
            for r, later in zip(rungs, rungs[1:]):
                assert later.candidates == r.kept == -(-r.candidates // 2)
    assert search.plan_rungs(4, 0, 100)[0].share == 1.0


@pytest.fixture(scope="module")
def sides(spark):
    rows = spark.range(4_000).select(
        "id", (F.col("id") % 17).cast("double").alias("a"), (F.pmod(F.xxhash64("id"), F.lit(13))).cast("double").alias("b"),
        F.lit(3.0).alias("flat"),
    ).withColumn("y", 2 * F.col("a") + F.col("b") / 10)
    return rows.filter("id % 4 > 0").cache(), rows.filter("id % 4 = 0").cache()


def test_larger_samples_hold_smaller_ones(sides):
    train, _ = sides
    taken = [{r["id"] for r in train.filter(search.sampled("id", s)).collect()} for s in (0.0, 0.1, 0.3, 1.0)]
    assert taken[0] == set() and taken[1] < taken[2] < taken[3] and len(taken[3]) == 3_000
    assert 240 < len(taken[1]) < 360


def test_halving_finds_the_line_within_the_budget(spark, sides):
    train, valid = sides
    columns = {"by_a": "a", "by_b": "b", "by_id": "id", "by_nothing": "flat"}
    found = search.halving(train, valid, columns, search.Lines(columns), "y", "id", 3_000)
    report = found.report.collect()
    assert found.chosen == "by_a" and found.spent == sum(r["rows"] for r in report) <= 3_600
    assert [(r["rung"], r["candidate"]) for r in report if r["rung"] > 1] == [
        (2, n) for n in sorted(r["candidate"] for r in report if r["rung"] == 1 and r["kept"])
    ] + [(3, "by_a")]
    # A constant column has no line, so no error, and is the first to go.
    flat = [r for r in report if r["candidate"] == "by_nothing"]
    assert len(flat) == 1 and flat[0]["rmse"] is None and not flat[0]["kept"]
    full = models.fit_lines(train.filter(search.sampled("id", 1 / 3)), "y", ["a"]).first()["a"]
    assert found.fitted["a"]["slope"] == pytest.approx(full["slope"])


def test_halving_over_estimators(sides):
    train, valid = sides
    candidates = [
        models.Candidate("line", "linear"), models.Candidate("flat", "linear", (("regParam", 1e9), ("elasticNetParam", 1.0))),
        models.Candidate("trees", "gbt", (("maxIter", 2), ("maxDepth", 2), ("seed", 1))),
    ]
    learner = search.Estimators(candidates, ["a", "b"])
    found = search.halving(train, valid, [c.name for c in candidates], learner, "y", "id", 4_000)
    assert found.chosen == "line" and list(found.fitted[1]) == ["line"]


def test_a_budget_without_rows_still_chooses(sides):
    train, valid = sides
    columns = {"one": "a", "two": "b"}
    found = search.halving(train, valid, columns, search.Lines(columns), "y", "id", 0)
    assert found.chosen == "one" and found.spent == 0
    empty = search.halving(train.limit(0), valid, columns, search.Lines(columns), "y", "id", 100)
    assert empty.chosen == "one"


def test_boosting_stops_where_validation_is_best(spark):
    # The training side has noise that the trees learn after the first rounds.
    noise = F.when(F.col("id") % 5 < 4, F.pmod(F.xxhash64("id", F.lit(3)), F.lit(100)) / 10 - 5).otherwise(0)
    df = spark.range(600).select(
        F.when(F.col("id") % 5 < 4, "train").otherwise("valid").alias("side"),
        F.pmod(F.xxhash64("id"), F.lit(1_000)).cast("double").alias("x"), noise.alias("e"),
    ).withColumn("y", F.when(F.col("x") < 500, 1.0).otherwise(4.0) + F.col("e")).drop("e").cache()
    boosted, measured = search.boost(df, ["x"], "y", "side", maxDepth=4, maxIter=12, stepSize=0.6, seed=1)
    errors = {(r["side"], r["round"]): r["rmse"] for r in measured.collect()}
    valid = [errors["valid", n] for n in range(1, 13)]
    train = [errors["train", n] for n in range(1, 13)]
    assert train == sorted(train, reverse=True) and boosted.rounds == valid.index(min(valid)) + 1 < 12
    # The sum of all rounds is what the library itself predicts.
    scored, names = boosted.staged(df)
    theirs = boosted.model.setPredictionCol("theirs").transform(scored)
    assert theirs.filter(F.abs(F.col("theirs") - F.col(names[-1])) > 1e-9).isEmpty()
    path = fresh_path(spark, "boosted")
    search.save_boosted(boosted, path)
    again = search.load_boosted(spark, path)
    both = again.transform(boosted.transform(df, "first"), "second")
    assert again.rounds == boosted.rounds and both.filter(F.abs(F.col("first") - F.col("second")) > 1e-12).isEmpty()
    assert both.columns == ["side", "x", "y", "first", "second"]


def test_boosting_without_a_validation_side(spark):
    df = spark.range(40).select(F.lit("train").alias("side"), F.col("id").cast("double").alias("x"), F.col("id").cast("double").alias("y"))
    boosted, measured = search.boost(df, ["x"], "y", "side", maxDepth=1, maxIter=3, seed=1)
    assert boosted.rounds == 3 and measured.count() == 3

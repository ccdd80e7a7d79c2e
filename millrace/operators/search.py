"""Search over many candidates with a budget of training rows.

Successive halving: all candidates are fitted on a small sample and the better
half goes on to a larger one, until one is left.  Every rung may read the same
share of the budget, so fewer candidates mean larger samples.  Samples are
shares of a hash of the key: they are the same in every run, a larger one holds
the smaller ones, and taking one moves no row.
"""

import json
import math
from dataclasses import dataclass

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import models
from millrace.sources import objects

PARTS = 16**7


@dataclass(frozen=True)
class Rung:
    """``share`` of the rows for each of ``candidates``, of which ``kept`` go on."""

    number: int
    candidates: int
    kept: int
    share: float


def plan_rungs(candidates: int, rows: int, budget_rows: int) -> list[Rung]:
    """Rungs whose fits together read at most about ``budget_rows`` rows.

    A sample never passes the whole; what a late rung cannot use is not spent.
    """
    left = [candidates]
    while left[-1] > 1:
        left.append(math.ceil(left[-1] / 2))
    shares = [min(1.0, budget_rows / (len(left) * n * max(rows, 1))) for n in left]
    return [Rung(i, n, kept, share) for i, (n, kept, share) in enumerate(zip(left, [*left[1:], 1], shares), 1)]


def sampled(key, share: float):
    """Rows of the sample of that share; a null key is in none but the whole."""
    if share >= 1:
        return F.lit(True)
    part = F.conv(F.substring(F.md5(F.concat(F.lit("sample:"), F.col(key).cast("string"))), 1, 7), 16, 10).cast("long")
    return F.coalesce(part < F.lit(math.floor(share * PARTS)), F.lit(False))


class Lines:
    """Candidates that are lines on one column: all of a rung are fitted by one pass.

    ``columns`` maps a candidate's name to its column.
    """

    def __init__(self, columns: dict):
        self.columns = columns

    def fit(self, train: DataFrame, names, label):
        """Row count of the sample and the lines of the named candidates."""
        columns = sorted({self.columns[n] for n in names})
        return models.fit_lines(train, label, columns, rows="rows").first()

    def rows(self, fitted) -> int:
        return fitted["rows"]

    def measure(self, valid: DataFrame, fitted, names, label) -> DataFrame:
        for name in names:
            line = fitted[self.columns[name]]
            value = F.lit(line["intercept"]) + F.lit(line["slope"]) * F.col(self.columns[name])
            valid = valid.withColumn(name, value.cast("double"))
        return models.evaluate_all(valid, label, list(names))


class Estimators:
    """Candidates that are MLlib estimators over common features."""

    def __init__(self, candidates, features):
        self.candidates = {c.name: c for c in candidates}
        self.features = list(features)

    def fit(self, train: DataFrame, names, label):
        train = train.select(*self.features, label).persist()
        rows = train.count()
        fitted = models.search(train, [self.candidates[n] for n in names], self.features, label) if rows else {}
        train.unpersist()
        return rows, fitted

    def rows(self, fitted) -> int:
        return fitted[0]

    def measure(self, valid: DataFrame, fitted, names, label) -> DataFrame:
        return models.compare(fitted[1], valid.select(*self.features, label), label)


@dataclass
class Halving:
    """A row for each fit, the candidate that is left, what was fitted of it last, and the rows read."""

    report: DataFrame
    chosen: str
    fitted: object
    spent: int


REPORT = "rung int, candidate string, rows long, rmse double, kept boolean"


def halving(train: DataFrame, valid: DataFrame, names, learner, label, key, budget_rows) -> Halving:
    """Search by successive halving; ``learner`` is ``Lines`` or ``Estimators``.

    The error is measured on all validation rows.  A candidate without an error,
    for want of rows, is worse than any other; of equal ones the first name is
    better.  Only errors of candidates reach the driver.
    """
    spark: SparkSession = train.sparkSession
    left, report, spent, fitted = sorted(names), [], 0, None
    for rung in plan_rungs(len(left), train.count(), budget_rows):
        fitted = learner.fit(train.filter(sampled(key, rung.share)), left, label)
        rows = learner.rows(fitted)
        found = learner.measure(valid, fitted, left, label).select("candidate", "rmse").collect() if rows else []
        errors = {r["candidate"]: r["rmse"] for r in found}
        usable = lambda n: errors.get(n) is not None and not math.isnan(errors[n])
        ranked = sorted(left, key=lambda n: (not usable(n), errors[n] if usable(n) else 0.0, n))
        kept = ranked[: rung.kept]
        report += [(rung.number, n, rows, errors.get(n), n in kept) for n in left]
        spent += rows * len(left)
        left = sorted(kept)
    return Halving(spark.createDataFrame(report, REPORT), left[0], fitted, spent)


# --- boosted trees, cut at the round that validates best -----------------------------------


@dataclass
class Boosted:
    """Boosted trees of which the first ``rounds`` count."""

    model: object
    features: list
    rounds: int

    def staged(self, df: DataFrame, upto=None) -> tuple[DataFrame, list]:
        """Adds the prediction after each round; the names of these columns."""
        upto = upto or len(self.model.trees)
        df = VectorAssembler(inputCols=self.features, outputCol="_features").transform(df)
        total, names = F.lit(0.0), []
        for number, (tree, weight) in enumerate(zip(self.model.trees[:upto], self.model.treeWeights), 1):
            one, name = f"_tree{number}", f"_round{number}"
            df = tree.setFeaturesCol("_features").setPredictionCol(one).transform(df)
            total = total + F.col(one) * weight
            names.append(name)
            df = df.withColumn(name, total)
        return df, names

    def transform(self, df: DataFrame, name="prediction") -> DataFrame:
        """Adds the prediction after the rounds that count."""
        scored, names = self.staged(df, self.rounds)
        return scored.select(*df.columns, F.col(names[-1]).alias(name))


def boost(df: DataFrame, features, label, side, **params) -> tuple[Boosted, DataFrame]:
    """Fit boosted trees on the training side and keep the rounds that validate best.

    All rounds are measured on both sides by one pass.  Of equally good numbers
    of rounds the smallest is taken.  Also returns a row for each round and side.
    """
    train = VectorAssembler(inputCols=list(features), outputCol="_features").transform(df.filter(F.col(side) == "train"))
    model = GBTRegressor(featuresCol="_features", labelCol=label, **params).fit(train)
    boosted = Boosted(model, list(features), len(model.trees))
    scored, names = boosted.staged(df)
    y = F.col(label)
    measured = scored.groupBy(F.col(side).alias("side")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.array(*[F.sqrt(F.avg(F.pow(y - F.col(n), F.lit(2.0)))) for n in names]).alias("errors"),
    ).collect()
    errors = {r["side"]: r["errors"] for r in measured}
    on_valid = errors.get("valid")
    if on_valid:
        boosted.rounds = on_valid.index(min(on_valid)) + 1
    rows = [
        (r["side"], number, r["rows"], error, number == boosted.rounds)
        for r in measured for number, error in enumerate(r["errors"], 1)
    ]
    return boosted, df.sparkSession.createDataFrame(rows, "side string, round int, rows long, rmse double, chosen boolean")


def save_boosted(boosted: Boosted, path):
    """Write boosted trees with the number of rounds that count."""
    models.save_model(boosted.model, f"{path}/model")
    about = {"features": boosted.features, "rounds": boosted.rounds}
    objects.put(SparkSession.getActiveSession(), f"{path}/about.json", json.dumps(about))


def load_boosted(spark: SparkSession, path) -> Boosted:
    """Read boosted trees back."""
    about = json.loads(objects.get(spark, f"{path}/about.json"))
    return Boosted(GBTRegressionModel.load(f"{path}/model"), about["features"], about["rounds"])

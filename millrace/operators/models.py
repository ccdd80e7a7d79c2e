"""Training, scoring, evaluation, selection and registration of models."""

import time
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.errors import SPARK_ERRORS, TableMoved
from millrace.functions import scores
from millrace.operators.tables import next_versions
from millrace.schemas import REGISTRY
from millrace.sources import snapshots


# --- closed-form fit ---------------------------------------------------------------


def fit_line(df: DataFrame, y, x) -> DataFrame:
    """One row: least-squares slope and intercept of y on x, and the rows used."""
    return df.agg(
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.regr_count(y, x).alias("rows"),
    )


def fit_lines(df: DataFrame, y, xs, rows=None) -> DataFrame:
    """One row with a (slope, intercept) struct per x, from one pass.

    With a name for it, the row also counts the rows used.
    """
    return df.agg(
        *([] if rows is None else [F.count(F.lit(1)).alias(rows)]),
        *[
            F.struct(
                F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept")
            ).alias(x)
            for x in xs
        ]
    )


def score_line(df: DataFrame, fit: DataFrame, x, name="prediction", line="") -> DataFrame:
    """Adds the prediction; the fitted row enters as scalar subqueries.

    ``line`` names the struct of ``fit_lines`` to use.
    """
    at = f"{line}." if line else ""
    slope, intercept = (fit.select(F.col(f"{at}{part}")).scalar() for part in ("slope", "intercept"))
    return df.withColumn(name, intercept + slope * F.col(x))


def evaluate(df: DataFrame, y, prediction="prediction") -> DataFrame:
    """One row: rows, R² and RMSE."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        scores.r2(F.col(y), F.col(prediction)).alias("r2"),
        scores.rmse(F.col(y), F.col(prediction)).alias("rmse"),
    )


def evaluate_all(df: DataFrame, y, predictions) -> DataFrame:
    """One row per prediction column with R² and RMSE, from one pass."""
    measured = df.agg(
        *[
            F.struct(
                F.lit(name).alias("candidate"),
                F.count(F.lit(1)).alias("rows"),
                scores.r2(F.col(y), F.col(name)).alias("r2"),
                scores.rmse(F.col(y), F.col(name)).alias("rmse"),
            ).alias(f"m{i}")
            for i, name in enumerate(predictions)
        ]
    )
    return measured.select(F.inline(F.array(*measured.columns)))


# --- distributed regressors and search -----------------------------------------------


ESTIMATORS = {
    "linear": LinearRegression,
    "gbt": GBTRegressor,
    "forest": RandomForestRegressor,
}


@dataclass(frozen=True)
class Candidate:
    """An estimator name with its parameters."""

    name: str
    kind: str
    params: tuple = ()

    def estimator(self, features, label):
        assembler = VectorAssembler(inputCols=list(features), outputCol="_features")
        regressor = ESTIMATORS[self.kind](
            featuresCol="_features", labelCol=label, predictionCol=self.name, **dict(self.params)
        )
        return Pipeline(stages=[assembler, regressor])


def search(train: DataFrame, candidates, features, label, budget_seconds=None) -> dict:
    """Fit candidates in order; none starts once the time budget is spent.

    The first one always runs.  Every fit is a distributed job over ``train``.
    """
    started, models = time.monotonic(), {}
    for candidate in candidates:
        spent = time.monotonic() - started
        if models and budget_seconds is not None and spent > budget_seconds:
            break
        models[candidate.name] = candidate.estimator(features, label).fit(train)
    return models


def compare(models: dict, df: DataFrame, label) -> DataFrame:
    """One row per model with R² and RMSE, from a single pass over the rows."""
    scored = df
    for model in models.values():
        scored = model.transform(scored).drop("_features")
    return evaluate_all(scored, label, list(models))


def compare_sides(models: dict, df: DataFrame, side, label) -> DataFrame:
    """As ``compare``, with one row per model and value of ``side``."""
    scored = df
    for model in models.values():
        scored = model.transform(scored).drop("_features")
    measured = scored.groupBy(F.col(side).alias("side")).agg(
        *[
            F.struct(
                F.lit(name).alias("candidate"),
                F.count(F.lit(1)).alias("rows"),
                scores.r2(F.col(label), F.col(name)).alias("r2"),
                scores.rmse(F.col(label), F.col(name)).alias("rmse"),
            ).alias(f"m{i}")
            for i, name in enumerate(models)
        ]
    )
    return measured.select("side", F.inline(F.array(*measured.columns[1:])))


def best(metrics: DataFrame, by="rmse", lower_is_better=True, name="candidate") -> DataFrame:
    """The best candidate's row; the first name wins a tie."""
    order = F.col(by) if lower_is_better else -F.col(by)
    row = F.struct(*metrics.columns)
    return metrics.agg(F.min_by(row, F.struct(order, F.col(name))).alias("b")).select("b.*")


def promotion(metrics: DataFrame, baseline: DataFrame, metric="r2", name="candidate") -> DataFrame:
    """The best candidate and whether it beats the baseline's metric.

    ``baseline`` is a one-row frame with the metric, for instance the newest
    registry row; with no baseline any candidate is promoted.
    """
    chosen = best(metrics, metric, lower_is_better=False, name=name)
    floor = baseline.select(metric).scalar()
    return chosen.withColumn("baseline", floor).withColumn(
        "promote", F.coalesce(F.col(metric) > F.col("baseline"), F.col(metric).isNotNull())
    )


# --- persistence and registry ----------------------------------------------------------


def save_model(model, path):
    """Write a fitted model, replacing an earlier one."""
    model.write().overwrite().save(path)


def load_model(path) -> PipelineModel:
    """Read a fitted model back."""
    return PipelineModel.load(path)


def run_metadata(run_id, artifact_uri, version, r2) -> list:
    """The four metadata columns of a run."""
    return [
        run_id.cast("string").alias("mlflow_run_id"),
        artifact_uri.cast("string").alias("mlflow_artifact_uri"),
        version.cast("string").alias("mlflow_registered_version"),
        r2.cast("double").alias("r2"),
    ]


def read_registry(spark, table_path, snapshot=None) -> DataFrame:
    """The registry table, empty before the first run."""
    known = snapshots.latest(spark, table_path) if snapshot is None else snapshot
    return snapshots.read(spark, table_path, known) if known else spark.createDataFrame([], REGISTRY)


def register(runs: DataFrame, table_path) -> DataFrame:
    """Add runs to a registry table; runs with their ``version``.

    Versions are numbered after the highest ones of a snapshot, and are theirs
    only if the next snapshot is: with several writers at once, the one that
    comes second numbers its runs again.  A failing write leaves the version
    null and does not fail the run.
    """
    spark = runs.sparkSession
    try:
        while True:
            base = snapshots.latest(spark, table_path)
            rows = next_versions(read_registry(spark, table_path, base), runs)
            change = snapshots.stage_append(rows, table_path, base=base)
            try:
                snapshots.commit(spark, change, exact=True)
            except TableMoved:
                continue
            return spark.read.schema(REGISTRY).parquet(f"{table_path}/{change.added[0]}")
    except SPARK_ERRORS:
        return runs.withColumn("version", F.lit(None).cast("long")).select(*REGISTRY.names)

"""The training run: extract, check, derive, check, fit, choose, score, register."""

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.fixed import FEATURE_RANGE
from millrace.operators import checks, drift, features, models
from millrace.schemas import pinned
from millrace.session import fresh_path, materialise, write_counted
from millrace.sources import files
from millrace.sources.metadata import describe_snapshot
from millrace.sources.sinks import write_features, write_metadata


@dataclass
class Snapshot:
    """A written extract."""

    path: str
    rows: int
    table: DataFrame
    facts: DataFrame
    sketch: DataFrame | None = None


def extract_snapshot(
    spark, uri, path, ts, start=None, end=None, columns=None, dataset=None, version="v1",
    partition=None, sketched=(),
) -> Snapshot:
    """Read a URI, keep a time range and some columns, write a snapshot.

    A URI ending in a slash is a prefix of many objects, any other is one.  A
    dataset with a pinned schema of that version is read with it.  Of a table
    laid out by the period of ``ts``, ``partition`` names the column and date
    format, so that only the folders of the range are opened.  The distribution
    of the columns ``sketched`` is stored beside the snapshot (``drift.py``).
    """
    read = files.scan_prefix if uri.endswith("/") else files.scan
    source = read(spark, uri, pinned(dataset, version))
    kept = files.between_times(source, ts, start, end, partition) if start and end else source
    if columns:
        kept = files.project(kept, dict.fromkeys([*columns, ts]))
    rows = write_counted(files.require_rows(kept, uri), path)
    table = files.scan(spark, path, kept.schema)
    stored = None
    if sketched:
        drift.save_sketch(drift.sketch(table, sketched), f"{path}-sketch")
        stored = drift.load_sketch(spark, f"{path}-sketch")
    return Snapshot(path, rows, table, describe_snapshot(table, dataset or uri, ts), stored)


@dataclass
class TrainingRun:
    """What a run leaves behind."""

    raw_report: DataFrame
    feature_report: DataFrame
    features: DataFrame
    fit: DataFrame
    scored: DataFrame
    evaluation: DataFrame


def check_raw(raw: DataFrame, x, y) -> DataFrame:
    """Report on raw rows: presence of values, and repeated rows."""
    rows = checks.row_report(
        raw, [checks.row_count(1), checks.not_null(raw, x), checks.not_null(raw, y)]
    )
    return checks.report(rows, checks.unique_rows(raw))


def derive(raw: DataFrame, x, y) -> DataFrame:
    """Training columns x, y and the derived x2."""
    renamed = raw.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    return features.double_feature(renamed)


def write_checked_features(table: DataFrame, path) -> tuple[DataFrame, DataFrame]:
    """Write a feature set and check it in the same pass; set and report."""
    low, high = FEATURE_RANGE
    watched, seen = checks.watch(table, [checks.row_count(1), checks.between(table, "x2", low, high)])
    write_features(watched, path)
    return files.scan(table.sparkSession, path, table.schema), seen()


def train(raw: DataFrame, x, y) -> TrainingRun:
    """Run all steps; a failed check raises and nothing is trained.

    Only the search for repeated rows reads every raw column.  All steps after
    the features are written read that narrow set.
    """
    raw_report = check_raw(raw, x, y)
    checks.gate(raw, raw_report)
    path = fresh_path(raw.sparkSession, "features")
    table, feature_report = write_checked_features(derive(raw, x, y), path)
    checks.gate(table, feature_report)
    fit, _ = materialise(models.fit_line(table, "y", "x"), "fit")
    scored = models.score_line(table, fit, "x")
    return TrainingRun(
        raw_report, feature_report, table, fit, scored, models.evaluate(scored, "y")
    )


@dataclass
class RegisteredRun:
    """What a run from a URI to the registry leaves behind."""

    snapshot: Snapshot
    raw_report: DataFrame
    feature_report: DataFrame
    compared: DataFrame
    chosen: str
    model_path: str
    registered: DataFrame
    metadata_path: str


def train_and_register(
    spark, uri, ts, key, x, y, name, candidates, registry_path, start=None, end=None, dataset=None,
    partition=None,
) -> RegisteredRun:
    """From files to a registered model: every step of the workflow in order.

    Extracts a snapshot, gates it, writes and gates the features, fits every
    candidate on the training side of a hash split of ``key`` (a column or a
    list; the first one decides the side), keeps the one with the smallest
    error on the validation side, saves it, appends it to the registry at
    ``registry_path`` and writes its metadata as one JSON object, with the
    version that the registry gave it.
    """
    keys = [key] if isinstance(key, str) else list(key)
    snapshot = extract_snapshot(
        spark, uri, fresh_path(spark, "snapshot"), ts, start, end, [*keys, x, y], dataset,
        partition=partition,
    )
    raw_report = check_raw(snapshot.table, x, y)
    checks.gate(snapshot.table, raw_report)
    sided = snapshot.table.select(
        F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"),
        features.split_column(keys[0]).alias("side"),
    )
    table, feature_report = write_checked_features(
        features.double_feature(sided), fresh_path(spark, "features")
    )
    checks.gate(table, feature_report)
    fitted = models.search(table.filter("side = 'train'"), candidates, ["x"], "y")
    compared, _ = materialise(models.compare_sides(fitted, table, "side", "y"), "compared")
    on_valid = compared.filter("side = 'valid'")
    chosen = models.best(on_valid).first()
    model_path = fresh_path(spark, "model")
    models.save_model(fitted[chosen["candidate"]], model_path)
    run_id = model_path.rsplit("/", 1)[1]
    run = on_valid.filter(F.col("candidate") == chosen["candidate"]).select(
        F.lit(name).alias("name"), F.lit(run_id).alias("run_id"),
        F.lit(model_path).alias("artifact_uri"), "r2",
    )
    registered = models.register(run, registry_path)
    metadata_path = fresh_path(spark, "metadata")
    write_metadata(
        registered.select(
            *models.run_metadata(F.col("run_id"), F.col("artifact_uri"), F.col("version"), F.col("r2"))
        ),
        metadata_path,
    )
    return RegisteredRun(
        snapshot, raw_report, feature_report, compared, chosen["candidate"], model_path, registered,
        metadata_path,
    )

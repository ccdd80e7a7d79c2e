"""File scans: one object, a prefix of many, CSV trees, time ranges."""

import re
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.errors import EmptySource


ABSENT = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def _absent(error):
    """Whether an error only says that there is nothing to read."""
    return error.getCondition() in ABSENT


def scan(spark: SparkSession, uri: str, schema=None) -> DataFrame:
    """Read one Parquet file or directory, local or remote."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    try:
        return reader.parquet(uri)
    except AnalysisException as error:
        if not _absent(error):
            raise
        raise EmptySource(f"nothing to read at {uri}") from error


def scan_prefix(spark: SparkSession, prefix: str, schema=None) -> DataFrame:
    """Stack every Parquet object under a prefix, columns united by name.

    Without a schema all footers are read to unite theirs.
    """
    reader = spark.read.option("recursiveFileLookup", True)
    reader = reader.option("mergeSchema", True) if schema is None else reader.schema(schema)
    try:
        return reader.parquet(prefix)
    except AnalysisException as error:
        if not _absent(error):
            raise
        raise EmptySource(f"no objects under {prefix}") from error


def stack(frames) -> DataFrame:
    """Union by name; absent columns become null, duplicates stay."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def require_rows(df: DataFrame, source: str) -> DataFrame:
    """Raise unless the frame has a row; reads at most one."""
    if df.isEmpty():
        raise EmptySource(f"{source} holds no rows")
    return df


def scan_csv(spark: SparkSession, directory: str, schema=None) -> DataFrame:
    """CSV files of a directory; its subdirectories only if the top has none.

    Jobs pass a schema: inference costs a full extra read and narrows types.
    A file whose header differs from the schema fails the read.
    """
    options = {"header": True, "enforceSchema": False, "pathGlobFilter": "*.csv"}
    if _has_files(spark, directory, recursive=False):
        pass
    elif _has_files(spark, directory, recursive=True):
        options["recursiveFileLookup"] = True
    else:
        raise EmptySource(f"no CSV files under {directory}")
    reader = spark.read.options(**options)
    if schema is not None:
        return reader.schema(schema).csv(directory)
    return reader.option("inferSchema", True).csv(directory)


def _has_files(spark, directory, recursive):
    """Whether CSV files exist; lists names only, no content is read."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv")
    try:
        listed = reader.option("recursiveFileLookup", recursive).load(directory)
        return not listed.select("path").isEmpty()
    except AnalysisException as error:
        if not _absent(error):
            raise
        return False


_STORE = r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?"


def csv_sources(spark: SparkSession, directory: str) -> list:
    """(stem, path) of each CSV source below a directory, in order of name.

    A source is a file ``stem.csv``, or a folder of that name with the part
    files of a distributed writer.  Nested ones count only if the top has none.
    """
    top = re.sub(_STORE, "", directory.rstrip("/"))
    reader = spark.read.format("binaryFile").options(pathGlobFilter="*.csv", recursiveFileLookup=True)
    try:
        listed = reader.load(directory).select(F.regexp_replace("path", _STORE, "").alias("path"))
    except AnalysisException as error:
        if not _absent(error):
            raise
        return []
    below = F.substr("path", F.locate(top, F.col("path")) + F.lit(len(top)))
    # One row per source, not per part file.
    found = listed.select(F.regexp_extract(below, r"^(.*?/[^/]*\.csv)(?:/.*)?$", 1).alias("s")).distinct()
    sources = sorted(row["s"] for row in found.collect())
    at_top = [s for s in sources if s.count("/") == 1]
    return [(s.rsplit("/", 1)[1].removesuffix(".csv"), directory.rstrip("/") + s) for s in at_top or sources]


def preview(df: DataFrame, rows=2):
    """First rows and the column types, for a log line."""
    return df.limit(rows), df.dtypes


def between_times(df: DataFrame, ts, start, end, partition=None) -> DataFrame:
    """Rows with ``start <= ts < end``.

    ``partition`` names a (column, date format) pair the files are laid out by;
    the extra predicate on it lets the scan skip whole directories.
    """
    kind = df.schema[ts].dataType.typeName()
    lower, upper = F.lit(start).cast(kind), F.lit(end).cast(kind)
    kept = df.filter((F.col(ts) >= lower) & (F.col(ts) < upper))
    if partition:
        column, pattern = partition
        kept = kept.filter(
            F.col(column).between(F.date_format(lower, pattern), F.date_format(upper, pattern))
        )
    return kept


def project(df: DataFrame, features, label=None) -> DataFrame:
    """Only the requested features and the label."""
    return df.select(*features, *([] if label is None else [label]))

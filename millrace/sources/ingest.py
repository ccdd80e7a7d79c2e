"""Batch ingest of a small registry of datasets."""

import logging
from collections import defaultdict
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from millrace.errors import SPARK_ERRORS, BadRegistry, EmptySource, NothingIngested
from millrace.schemas import pinned
from millrace.sources.files import csv_sources, preview, require_rows, scan, scan_csv
from millrace.sources.sinks import append_table, land, table_name

log = logging.getLogger(__name__)

REPORT = "short string, file string, path string, table_name string, status string, rows long, snapshot long, error string"


def check_registry(registry):
    """Entries are tuples of a dataset reference and a short name."""
    if not all(isinstance(entry, tuple) and len(entry) >= 2 for entry in registry):
        raise BadRegistry("registry entries must be (reference, short name) tuples")


def ingest(spark: SparkSession, registry, prefix, batch_id, namespace=None, at_once=8) -> DataFrame:
    """Land and append each file of each dataset; a failing one is reported and skipped.

    ``registry`` pairs a directory of CSV files with a short name.  Every file
    (see ``csv_sources``) is landed on its own and, with a ``namespace``,
    appended to the table named by its stem, from the landed Parquet, so the
    CSV is parsed once; the report has the id of the snapshot it became.  A file whose header differs from the pinned schema of
    its dataset, or else of its stem, fails.  Returns one row per file, and one
    per dataset without files.

    Up to ``at_once`` tables are filled side by side, each by jobs of a pool of
    its own, so that a small file does not wait for a large one where the
    session's scheduler is fair.  Files of one table go one after the other in
    the order of the registry, and so does the report, whatever ends first.
    """
    check_registry(registry)
    found_in = lambda entry: csv_sources(spark, entry[0])
    with ThreadPoolExecutor(at_once) as threads:
        listed = list(threads.map(inheritable_thread_target(spark)(found_in), registry))
        tables = defaultdict(list)
        for place, ((_, short, *_), sources) in enumerate(zip(registry, listed)):
            for number, (stem, source) in enumerate(sources):
                tables[stem].append(((place, number), short, stem, source))

        def fill(files):
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"ingest-{files[0][2]}")
            try:
                return [
                    (order, (short, stem, *_ingest_file(spark, source, stem, prefix, short, batch_id, namespace)))
                    for order, short, stem, source in files
                ]
            finally:
                spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)

        done = [row for rows in threads.map(inheritable_thread_target(spark)(fill), tables.values()) for row in rows]
    for place, ((reference, short, *_), sources) in enumerate(zip(registry, listed)):
        if not sources:
            skipped = (short, None, None, None, "skipped", 0, None, f"no CSV files under {reference}")
            done.append(((place, 0), skipped))
    report = [row for _, row in sorted(done, key=lambda pair: pair[0])]
    if not any(row[4] == "ingested" for row in report):
        raise NothingIngested("no dataset was ingested")
    return spark.createDataFrame(report, REPORT)


def _ingest_file(spark, source, stem, prefix, short, batch_id, namespace):
    """Path, table, status, rows, snapshot of the table and error of one file."""
    try:
        rows_in = require_rows(scan_csv(spark, source, pinned(short) or pinned(stem)), source)
        head, kinds = preview(rows_in)
        log.info("%s/%s: columns %s, first rows %s", short, stem, kinds, head.collect())
        path, rows = land(rows_in, prefix, f"{short}/{stem}", batch_id)
        table = table_name(stem, namespace) if namespace else None
        snapshot = None
        if table:
            snapshot = append_table(scan(spark, path), table, batch_id, f"{prefix}/tables/{stem}", short)
        return path, table, "ingested", rows, snapshot, None
    except EmptySource as error:
        return None, None, "skipped", 0, None, str(error)
    except SPARK_ERRORS as error:
        return None, None, "failed", 0, None, str(error).split("\n")[0]

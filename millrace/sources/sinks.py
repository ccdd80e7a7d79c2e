"""Writes: landed files, appended tables, feature sets, metadata objects."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import write_counted
from millrace.sources import snapshots


def table_name(stem, namespace="lake"):
    """Table identifier of a file stem."""
    return f"{namespace}.{stem.replace('-', '_').replace('.', '_')}"


def table_name_column(stem, namespace="lake"):
    """``table_name`` over a column of stems."""
    return F.concat(F.lit(f"{namespace}."), F.translate(stem, "-.", "__"))


def land(df: DataFrame, prefix, short, batch_id) -> tuple[str, int]:
    """Write one batch under ``{prefix}/raw/{short}``; returns path and rows.

    A batch has its own folder, so a rerun replaces it instead of doubling it.
    """
    path = f"{prefix}/raw/{short}/batch={batch_id}"
    return path, write_counted(df, path, mode="overwrite")


def append_table(df: DataFrame, identifier, batch_id, path, dataset="") -> int:
    """Append to the table at ``path``, creating it when absent; the id of its snapshot.

    A batch of a dataset that the table already holds is not appended again, so
    that an ingest run can be repeated; the snapshot that it came with is
    returned.  Any snapshot can be read with ``snapshots.read``, and the table
    ``identifier`` of the session catalog holds the newest one.
    """
    spark = df.sparkSession
    batch = f"{dataset}/{batch_id}"
    found = snapshots.batch_version(spark, path, batch)
    if found is None:
        stamped = df.withColumns(
            {"ingested_at": F.current_timestamp(), "dataset": F.lit(dataset), "batch_id": F.lit(batch_id)}
        )
        found = snapshots.commit(spark, snapshots.stage_append(stamped, path, batch, prefix="commit="))
    # Also after a run that failed between its commit and this line.
    snapshots.show(spark, identifier, path)
    return found


def write_by_period(df: DataFrame, path, ts, column="period", pattern="yyyy-MM-dd"):
    """Write a table laid out by the period of ``ts``.

    The rebalance step gathers the rows of a period into few files and, unlike
    a repartition on the period, splits a period too large for one task.
    """
    dated = df.withColumn(column, F.date_format(ts, pattern))
    return write_counted(dated.hint("rebalance", column), path, partition_by=[column])


def write_features(df: DataFrame, path):
    """Write a feature set, replacing an earlier one; returns rows written."""
    return write_counted(df, path, mode="overwrite")


def write_metadata(df: DataFrame, path):
    """Write a one-row frame as a single JSON object; more rows are an error."""
    if len(df.limit(2).collect()) > 1:
        raise ValueError("metadata must be one row")
    df.coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(path)

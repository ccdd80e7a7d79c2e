"""Running a stream over what has arrived, into files that survive a retry."""

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import fresh_path
from millrace.sources import objects
from millrace.sources.files import scan

log = logging.getLogger(__name__)


def read_files(spark: SparkSession, directory, schema, files_per_batch=None) -> DataFrame:
    """A stream of Parquet files as they appear under a directory."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(directory)


def batch_path(directory, batch_id):
    """Folder of one micro-batch: a repeated batch replaces its own files."""
    return f"{directory}/batch_id={batch_id}"


def drain(stream: DataFrame, each_batch, mode="append", checkpoint=None) -> int:
    """Feed everything available to ``each_batch(frame, batch_id)`` and stop.

    Returns how many rows were too late for a watermark, as far back as Spark
    keeps the progress of a run, and logs them.
    """
    place = checkpoint or fresh_path(stream.sparkSession, "checkpoint")
    query = (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", place)
        .trigger(availableNow=True)
        .foreachBatch(each_batch)
        .start()
    )
    query.awaitTermination()
    late = sum(s.numRowsDroppedByWatermark for p in query.recentProgress for s in p.stateOperators)
    if late:
        log.warning("%d rows were too late", late)
    return late


def write_updates(stream: DataFrame, directory, checkpoint=None) -> int:
    """Write the changed rows of every micro-batch of an aggregate; rows that were too late."""

    def each(frame, batch_id):
        frame.write.mode("overwrite").parquet(batch_path(directory, batch_id))

    return drain(stream, each, "update", checkpoint)


def read_batches(spark: SparkSession, directory, schema) -> DataFrame:
    """All micro-batch files with their ``batch_id``; empty if none were written."""
    stamped = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
    if not objects.exists(spark, directory):
        return spark.createDataFrame([], stamped)
    return scan(spark, directory, stamped)


def newest_updates(updates: DataFrame, *keys) -> DataFrame:
    """The last written row of each key."""
    rest = [c for c in updates.columns if c not in (*keys, "batch_id")]
    newest = updates.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch_id").alias("r"))
    return newest.select(*keys, *[F.col(f"r.{c}").alias(c) for c in rest])

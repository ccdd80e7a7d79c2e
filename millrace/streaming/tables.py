"""Service tables fed by streams: ingest, validation, approvals, expiring keys."""

import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators import checks
from millrace.operators.tables import first_decisions
from millrace.operators.timeline import Limits, entity, latest_before, micros, on_axis
from millrace.streaming.runs import batch_path, drain, read_batches
from millrace.streaming.state import BucketState

log = logging.getLogger(__name__)


def ingest_files(stream: DataFrame, directory, checkpoint):
    """Append new files to a table, each exactly once."""
    query = (
        stream.writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", checkpoint).option("path", directory)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()


def validate_stream(stream: DataFrame, checks_for, is_bad, directory, checkpoint=None):
    """Check every micro-batch: accepted rows, quarantined rows and a report.

    ``checks_for(frame)`` gives row checks; ``is_bad`` marks rows to set aside.
    The rows are written once, laid out by verdict, and checked by that write.
    """

    def each(frame, batch_id):
        verdict = F.when(F.coalesce(is_bad, F.lit(True)), "quarantine").otherwise("accepted")
        watched, seen = checks.watch(frame, checks_for(frame))
        rows = watched.withColumn("verdict", verdict)
        rows.write.mode("overwrite").partitionBy("verdict").parquet(
            batch_path(f"{directory}/rows", batch_id)
        )
        seen().coalesce(1).write.mode("overwrite").parquet(batch_path(f"{directory}/report", batch_id))

    drain(stream, each, checkpoint=checkpoint)


def first_decisions_in_order(stream: DataFrame, late="1 hour") -> DataFrame:
    """First decision per approval of a stream that arrives in time order."""
    timed = stream.withColumn("decided_at", F.col("decided_at").cast("timestamp"))
    return timed.withWatermark("decided_at", late).dropDuplicatesWithinWatermark(["approval_id"])


def resolve_stream(stream: DataFrame, approvals: DataFrame, directory, checkpoint=None, buckets=256):
    """Log the decision that settles each pending approval.

    A micro-batch adds its first decisions on approvals that are still open.
    The approvals table itself is not rewritten: it is the base table joined
    with this log.  What is open is worked out once, when a run begins, from
    the table and the log; from then on it is state in buckets (see
    ``state.py``) beside the log, and a micro-batch reads and writes the buckets
    of its own approvals, whatever was settled before.
    """
    spark = stream.sparkSession
    pending = approvals.filter((F.col("status") == "pending") & F.col("id").isNotNull())
    pending = pending.select(F.col("id").alias("approval_id")).distinct()
    state = BucketState(spark, f"{directory}-open", pending.schema, "approval_id", buckets)
    begun = []

    def each(frame, batch_id):
        first = first_decisions(frame).persist()
        place = batch_path(directory, batch_id)
        if not begun:
            settled = read_batches(spark, directory, first.schema).filter(F.col("batch_id") < batch_id)
            state.start(pending.join(settled, "approval_id", "left_anti"), batch_id, {})
            begun.append(batch_id)
        index, wanted = state.index(batch_id), state.buckets_of(first)
        open_ids = state.rows(index, wanted)
        first.join(open_ids, "approval_id", "left_semi").write.mode("overwrite").parquet(place)
        new = spark.read.schema(first.schema).parquet(place)
        state.save(open_ids.join(new, "approval_id", "left_anti"), batch_id, index, wanted, {})
        first.unpersist()

    drain(stream, each, checkpoint=checkpoint)


def ttl_micros(seconds):
    """Seconds of a time to live as whole microseconds."""
    seconds = F.col(seconds) if isinstance(seconds, str) else seconds
    return F.round(seconds * 1e6).cast("long")


EXPIRING = "key string, at timestamp, put boolean, value string, ttl double, read_id string"
ANSWERS = ["read_id", "key", "at", "value"]


def expiring_values(stream: DataFrame, directory, checkpoint=None, late="1 hour", buckets=256) -> int:
    """Answer reads of an expiring key/value store fed by one event stream.

    Events have the columns of ``EXPIRING``: a put sets a value for ``ttl``
    seconds, for ever if that is null; a read asks for it.  A read sees the
    newest put at or before it, of those that have arrived, unless that put has
    expired.

    The puts that a read may still ask for are state in buckets (see
    ``state.py``): all of the last ``late`` before the newest event, and of
    older ones the newest of each key unless it has expired.  So a read may be
    that late and a put may come at any time.  A micro-batch looks its reads up
    in the puts of its own buckets as a table does, which cuts a key with very
    many events into slots.  Reads later than that, and events without a time,
    get no answer; returns how many, and logs them.
    """
    spark = stream.sparkSession
    state = BucketState(spark, f"{directory}-puts", spark.createDataFrame([], EXPIRING).schema, "key", buckets)
    span = spark.range(1).select(F.unix_micros(F.timestamp_micros(F.lit(0)) + F.expr(f"interval {late}"))).first()[0]
    aside = []

    def each(frame, batch_id):
        events = frame.select(*state.schema.names).persist()
        index = state.index(batch_id) if batch_id else None
        index = index or state.start(spark.createDataFrame([], state.schema), batch_id, {"newest": None})
        newest = index.facts["newest"]
        answerable = micros("at").isNotNull()
        if newest is not None:
            answerable &= F.col("put") | (micros("at") >= newest - span)
        facts = events.agg(
            F.max(micros("at")).alias("newest"), F.count(F.when(~F.coalesce(answerable, F.lit(False)), 1)).alias("aside")
        ).first()
        usable = events.filter(answerable)
        wanted = state.buckets_of(usable.filter("key is not null"))
        puts = state.rows(index, wanted).unionByName(usable.filter("put and key is not null"))
        asked = puts.unionByName(usable.filter("not put"))
        answer_reads(asked).select(*ANSWERS).write.mode("overwrite").parquet(batch_path(directory, batch_id))
        newest = max((n for n in (newest, facts["newest"]) if n is not None), default=None)
        state.save(_still_asked(puts, newest, span), batch_id, index, wanted, {"newest": newest})
        aside.append(facts["aside"])
        events.unpersist()

    drain(stream, each, checkpoint=checkpoint)
    if sum(aside):
        log.warning("%d events were too late or had no time", sum(aside))
    return sum(aside)


def _still_asked(puts: DataFrame, newest, span) -> DataFrame:
    """Puts that a read at most ``span`` older than the newest event can see.

    Of older puts only the newest of a key counts, which is aggregated before
    it is moved; one that has expired by then counts no more.
    """
    if newest is None:
        return puts
    horizon = F.lit(newest - span)
    recent = puts.filter(micros("at") > horizon)
    latest = F.max_by(F.struct(*puts.columns), F.struct("at", "value")).alias("p")
    older = puts.filter(micros("at") <= horizon).groupBy("key").agg(latest).select("p.*")
    alive = F.coalesce(micros("at") + ttl_micros("ttl") > horizon, F.lit(True))
    return recent.unionByName(older.filter(alive))


def answer_reads(events: DataFrame) -> DataFrame:
    """Reads of an event table with the value alive at that time, or null."""
    puts = events.filter("put AND key IS NOT NULL").select(
        entity("key").alias("key"), micros("at").alias("pos"),
        F.struct("at", "value", "ttl").alias("payload"), F.col("value").alias("tie"),
    )
    reads = on_axis(events.filter(~F.col("put")).select("read_id", "key", "at"), "key", micros("at"))
    found = latest_before(reads, puts, Limits())
    put = F.col("found")
    ends = micros(put["at"]) + ttl_micros(put["ttl"])
    alive = put.isNotNull() & F.coalesce(F.col("pos") < ends, F.lit(True))
    return found.select("row.*", F.when(alive, put["value"]).alias("value"))

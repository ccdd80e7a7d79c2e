"""Queries that run a stream over the given tables to its end."""

from pyspark.sql import functions as F

from millrace.operators import checks
from millrace.plans import stand_ins
from millrace.plans.catalog.registry import query, rounded, table, time_text
from millrace.plans.catalog.service import BUCKET_SQL
from millrace.session import fresh_path
from millrace.streaming import runs, tables, windows

WINDOW_SQL = "strftime(time_bucket(INTERVAL 15 SECOND, ts), '%Y-%m-%d %H:%M:%S')"


def _staged(df, spark, name):
    """Files for a stream to find, and the schema to read them with."""
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return path, df.schema


def _arriving(df, ts, name):
    """A folder and schema, and its files put there in three steps of time.

    Stepping through them and draining after each gives three micro-batches
    that share a checkpoint.
    """
    path = fresh_path(df.sparkSession, name)
    at = F.unix_micros(F.col(ts).cast("timestamp"))
    first, second = df.select(at.alias("at")).approxQuantile("at", [0.33, 0.67], 0.05) or (0, 0)
    step = F.when(at <= first, 0).when(at <= second, 1).otherwise(2)

    def arrivals():
        for number in range(3):
            df.filter(step == number).write.mode("append").parquet(path)
            yield number

    return path, df.schema, arrivals()


def _requests(spark, directory):
    return stand_ins.request_metrics(table(spark, directory, "events"))


@query(
    "stream_counters_15s",
    f"""
    WITH {stand_ins.REQUESTS_SQL}
    SELECT {WINDOW_SQL} AS window_start, status, user_id, count(*) AS requests FROM requests GROUP BY ALL
    """,
)
def stream_counters_15s(spark, directory):
    """Requests per export interval, status and user."""
    path, schema, arrivals = _arriving(_requests(spark, directory), "ts", "requests")
    out, checkpoint = fresh_path(spark, "counters"), fresh_path(spark, "checkpoint")
    for _ in arrivals:
        counted = windows.windowed_counts(runs.read_files(spark, path, schema), "ts", "status", "user_id")
        runs.write_updates(counted, out, checkpoint)
    newest = runs.newest_updates(
        runs.read_batches(spark, out, counted.schema), "window_start", "status", "user_id"
    )
    return newest.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss"))


@query(
    "stream_histogram_15s",
    f"""
    WITH {stand_ins.REQUESTS_SQL}
    SELECT {WINDOW_SQL} AS window_start, status, {BUCKET_SQL} AS le, count(*) AS points,
           round(sum(seconds), 4) AS total
    FROM requests GROUP BY ALL
    """,
)
def stream_histogram_15s(spark, directory):
    """Durations per export interval, status and bucket."""
    stream = runs.read_files(spark, *_staged(_requests(spark, directory), spark, "requests"))
    points = windows.windowed_histogram(stream, "ts", "seconds", "status")
    out = fresh_path(spark, "histogram")
    runs.write_updates(points, out)
    newest = runs.newest_updates(
        runs.read_batches(spark, out, points.schema), "window_start", "status", "le"
    )
    return newest.withColumns(
        {
            "window_start": F.date_format("window_start", "yyyy-MM-dd HH:mm:ss"),
            "total": rounded("total", 4),
        }
    )


@query(
    "stream_resolve",
    f"""
    WITH {stand_ins.APPROVALS_SQL}, {stand_ins.DECISIONS_SQL}
    SELECT d.approval_id, d.decision_id, CASE d.action WHEN 'approve' THEN 'approved' ELSE 'rejected' END AS new_status,
           d.approver, strftime(d.decided_at, '%Y-%m-%d %H:%M:%S.%f') AS decided_at
    FROM first_decision d JOIN approvals a ON a.id = d.approval_id WHERE a.status = 'pending'
    """,
)
def stream_resolve(spark, directory):
    """Decisions that settle an approval, found micro-batch by micro-batch."""
    decisions = stand_ins.decisions(table(spark, directory, "events"))
    stream = runs.read_files(spark, *_staged(decisions, spark, "decisions"))
    approvals = stand_ins.approvals(table(spark, directory, "orders"))
    log = fresh_path(spark, "resolutions")
    tables.resolve_stream(stream, approvals, log)
    return spark.read.parquet(log).select(
        "approval_id", "decision_id", "new_status", "approver", time_text("decided_at").alias("decided_at")
    )


@query(
    "stream_validate",
    """
    SELECT CASE WHEN value BETWEEN 1 AND 300 THEN 'accepted' ELSE 'quarantine' END AS verdict, event_id,
           (SELECT count(*) FILTER (value < 1 OR value > 300) FROM events) AS reported
    FROM events
    """,
)
def stream_validate(spark, directory):
    """Rows set aside by a streaming check, and what its reports add up to."""
    stream = runs.read_files(spark, *_staged(table(spark, directory, "events"), spark, "events"))
    out = fresh_path(spark, "validated")
    tables.validate_stream(
        stream, lambda frame: [checks.between(frame, "value", 1, 300)],
        ~F.col("value").between(1, 300), out,
    )
    reported = spark.read.parquet(f"{out}/report").agg(F.sum("unexpected").alias("n")).scalar()
    return spark.read.parquet(f"{out}/rows").select(
        "verdict", "event_id", reported.alias("reported")
    )


@query(
    "stream_ingest",
    """
    SELECT event_id, user_id, event_type, value, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS at FROM events
    """,
)
def stream_ingest(spark, directory):
    """Files appended to a table by two runs that share a checkpoint."""
    path, schema = _staged(table(spark, directory, "events"), spark, "arrivals")
    out, checkpoint = fresh_path(spark, "ingested"), fresh_path(spark, "checkpoint")
    for _ in range(2):
        tables.ingest_files(runs.read_files(spark, path, schema), out, checkpoint)
    return spark.read.schema(schema).parquet(out).select(
        "event_id", "user_id", "event_type", "value", time_text("ts").alias("at")
    )


STORE_SQL = """
    kv AS (
      SELECT *, CASE WHEN event_id % 3 = 0 THEN 'hot' ELSE user_id::VARCHAR END AS key,
             event_type IN ('click', 'signup') AS put FROM events
    ),
    puts AS (
      SELECT key, ts, max('v' || event_id) AS v, arg_max(value, 'v' || event_id) AS hours FROM kv WHERE put GROUP BY key, ts
    )
"""


@query(
    "stream_ttl",
    f"""
    WITH {STORE_SQL}
    SELECT 'r' || r.event_id AS read_id,
           CASE WHEN r.ts < p.ts + to_microseconds(round(p.hours * 3600 * 1e6)::BIGINT) THEN p.v ELSE '' END AS value
    FROM (SELECT * FROM kv WHERE NOT put) r ASOF LEFT JOIN puts p ON r.key = p.key AND r.ts >= p.ts
    """,
)
def stream_ttl(spark, directory):
    """Reads of an expiring key/value store; values live for hours.

    One key has a third of all events, and every fourth read comes two hours late.
    """
    put = F.col("event_type").isin("click", "signup")
    at = F.col("ts").cast("timestamp")
    hours = F.when(~put & (F.col("event_id") % 4 == 0), F.lit(2)).otherwise(0)
    events = table(spark, directory, "events").select(
        F.when(F.col("event_id") % 3 == 0, "hot").otherwise(F.col("user_id").cast("string")).alias("key"),
        at.alias("at"),
        put.alias("put"),
        F.when(put, F.concat(F.lit("v"), "event_id")).alias("value"),
        F.when(put, F.col("value") * 3600).alias("ttl"),
        F.when(~put, F.concat(F.lit("r"), "event_id")).alias("read_id"),
        (at + F.make_dt_interval(hours=hours)).alias("arrives"),
    )
    path, schema, arrivals = _arriving(events, "arrives", "kv")
    answers, checkpoint = fresh_path(spark, "answers"), fresh_path(spark, "checkpoint")
    for _ in arrivals:
        tables.expiring_values(runs.read_files(spark, path, schema), answers, checkpoint, late="3 hours")
    return spark.read.parquet(answers).select("read_id", F.coalesce("value", F.lit("")).alias("value"))

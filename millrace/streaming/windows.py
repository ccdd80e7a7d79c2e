"""Counters and histograms per export interval, on streams."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.fixed import EXPORT_INTERVAL, HISTOGRAM_BOUNDS
from millrace.operators.metrics import bucket_bound


def _windowed(events, ts, late, interval):
    """Event time with its watermark; streams need an instant, not a local time."""
    timed = events.withColumn(ts, F.col(ts).cast("timestamp"))
    if timed.isStreaming:
        timed = timed.withWatermark(ts, late)
    return timed, F.window(ts, interval)


def windowed_counts(
    events: DataFrame, ts, *attributes, interval=EXPORT_INTERVAL, late="10 minutes"
) -> DataFrame:
    """Requests per interval and attributes; works on streams and tables."""
    timed, window = _windowed(events, ts, late, interval)
    return (
        timed.groupBy(window.alias("w"), *attributes)
        .agg(F.count(F.lit(1)).alias("requests"))
        .select(F.col("w.start").alias("window_start"), *attributes, "requests")
    )


def windowed_histogram(
    events: DataFrame, ts, value, *attributes, interval=EXPORT_INTERVAL, late="10 minutes",
    bounds=HISTOGRAM_BOUNDS,
) -> DataFrame:
    """Points and their total per interval, attributes and bucket."""
    timed, window = _windowed(events, ts, late, interval)
    return (
        timed.groupBy(window.alias("w"), *attributes, bucket_bound(value, bounds).alias("le"))
        .agg(F.count(F.lit(1)).alias("points"), F.sum(value).alias("total"))
        .select(F.col("w.start").alias("window_start"), *attributes, "le", "points", "total")
    )

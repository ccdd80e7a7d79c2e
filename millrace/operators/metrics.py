"""Request counters, duration histograms and token totals."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.fixed import HISTOGRAM_BOUNDS


def count_by(events: DataFrame, *attributes) -> DataFrame:
    """Number of events per combination of attributes."""
    return events.groupBy(*attributes).agg(F.count(F.lit(1)).alias("requests"))


def bucket_bound(value, bounds=HISTOGRAM_BOUNDS) -> Column:
    """Upper bound of the bucket a value falls in; infinity above the last."""
    value = F.col(value) if isinstance(value, str) else value
    chain = F.when(value <= bounds[0], F.lit(float(bounds[0])))
    for bound in bounds[1:]:
        chain = chain.when(value <= bound, F.lit(float(bound)))
    return chain.when(value.isNotNull(), F.lit(float("inf")))


def duration_seconds(start, end) -> Column:
    """Seconds between two times, with their fraction."""
    start, end = F.col(start).cast("timestamp"), F.col(end).cast("timestamp")
    return (F.unix_micros(end) - F.unix_micros(start)) / F.lit(1e6)


def histogram(events: DataFrame, value, *attributes, bounds=HISTOGRAM_BOUNDS) -> DataFrame:
    """Count and sum per attributes and bucket."""
    return events.groupBy(*attributes, bucket_bound(value, bounds).alias("le")).agg(
        F.count(F.lit(1)).alias("points"), F.sum(value).alias("total")
    )


def token_totals(replies: DataFrame, *attributes) -> DataFrame:
    """Token sums and success counts; an absent usage counts as 0."""
    tokens = lambda name: F.sum(F.coalesce(F.col(f"usage.{name}"), F.lit(0)))
    return replies.groupBy(*attributes).agg(
        F.count_if("success").alias("succeeded"),
        F.count_if(~F.col("success")).alias("failed"),
        tokens("prompt_tokens").alias("prompt_tokens"),
        tokens("completion_tokens").alias("completion_tokens"),
    )

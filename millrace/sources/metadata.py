"""Facts about a snapshot."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def describe_snapshot(df: DataFrame, name, ts) -> DataFrame:
    """One row: dataset, rows, columns, first and last time."""
    return df.agg(
        F.lit(name).alias("dataset"),
        F.count(F.lit(1)).alias("rows"),
        F.lit(len(df.columns)).cast("long").alias("columns"),
        F.min(ts).alias("first_time"),
        F.max(ts).alias("last_time"),
    )

"""Joins of service and feature tables."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pending_approvals(approvals: DataFrame, users: DataFrame) -> DataFrame:
    """Pending approvals with who asked for them, oldest first."""
    asked = approvals.filter(F.col("status") == "pending").select(
        "id", "session_id", "user_id", "tool_name", "tool_args", "reason", "created_at"
    )
    requesters = users.select(
        F.col("id").alias("user_id"),
        F.col("email").alias("requester_email"),
        F.col("name").alias("requester_name"),
    )
    return asked.join(requesters, "user_id").drop("user_id").orderBy("created_at", "id")


def cascade_delete(child: DataFrame, key, deleted: DataFrame, deleted_key) -> DataFrame:
    """Child rows that remain after their parents are deleted.

    Rows with a null reference refer to no parent and remain.
    """
    gone = deleted.select(F.col(deleted_key).alias(key)).distinct()
    return child.join(gone, key, "left_anti").select(*child.columns)


def feature_join(entities: DataFrame, key, *tables: DataFrame) -> DataFrame:
    """Entities enriched from tables with one row per key, unmatched kept."""
    for table in tables:
        entities = entities.join(table, key, "left")
    return entities


def aggregate_features(df: DataFrame, key, value, prefix, distinct=None) -> DataFrame:
    """Count, sum, average and bounds per entity, optionally a distinct count.

    The distinct count is taken from groups of (entity, value), so an entity
    with many rows is reduced before its groups meet.
    """
    if distinct is None:
        return df.groupBy(key).agg(
            F.count(F.lit(1)).alias(f"{prefix}_rows"),
            F.sum(value).alias(f"{prefix}_sum"),
            F.avg(value).alias(f"{prefix}_avg"),
            F.min(value).alias(f"{prefix}_min"),
            F.max(value).alias(f"{prefix}_max"),
        )
    inner = df.groupBy(F.col(key).alias("_key"), F.col(distinct).alias("_distinct")).agg(
        F.count(F.lit(1)).alias("_rows"), F.count(value).alias("_count"), F.sum(value).alias("_sum"),
        F.min(value).alias("_min"), F.max(value).alias("_max"),
    )
    return inner.groupBy(F.col("_key").alias(key)).agg(
        F.sum("_rows").alias(f"{prefix}_rows"),
        F.sum("_sum").alias(f"{prefix}_sum"),
        F.try_divide(F.sum("_sum"), F.sum("_count").cast("double")).alias(f"{prefix}_avg"),
        F.min("_min").alias(f"{prefix}_min"),
        F.max("_max").alias(f"{prefix}_max"),
        F.count("_distinct").alias(f"{prefix}_distinct"),
    )

"""Inserts, updates, deletes and approval resolution.

Parquet tables take no UPDATE or DELETE.  Each change is a projection or a
filter; ``sources/snapshots.py`` writes it for the files that it touches.
"""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions.text import decision_status

FAR_FUTURE = "9999-12-31 00:00:00"


def create_if_absent(spark: SparkSession, identifier, schema, path=None):
    """Create an empty table unless it exists."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    place = f" LOCATION '{path}'" if path else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {identifier} ({columns}) USING parquet{place}")


def drop(spark: SparkSession, identifier):
    """Drop a table if it exists."""
    spark.sql(f"DROP TABLE IF EXISTS {identifier}")


def insert(df: DataFrame, identifier):
    """Append rows to a table, columns matched by name."""
    spark = df.sparkSession
    df.select(*spark.table(identifier).columns).write.mode("append").insertInto(identifier)


def with_defaults(df: DataFrame, defaults) -> DataFrame:
    """Fill nulls, and columns that are absent, from default expressions."""
    filled = {
        c: F.coalesce(F.col(c), value) if c in df.columns else value for c, value in defaults.items()
    }
    return df.withColumns(filled)


def update(df: DataFrame, predicate, changes) -> DataFrame:
    """Rows after an update; rows where the predicate is unknown stay."""
    hit = F.coalesce(predicate, F.lit(False))
    return df.withColumns({c: F.when(hit, v).otherwise(F.col(c)) for c, v in changes.items()})


def delete(df: DataFrame, predicate=None) -> DataFrame:
    """Rows that remain after a delete; without a predicate none do."""
    if predicate is None:
        return df.limit(0)
    return df.filter(~F.coalesce(predicate, F.lit(False)))


def first_decisions(decisions: DataFrame) -> DataFrame:
    """The earliest valid decision of each approval, undated ones last.

    Columns in: decision_id, approval_id, action, approver, reason, decided_at.
    """
    kind = decisions.schema["decided_at"].dataType.typeName()
    order = F.struct(F.coalesce("decided_at", F.lit(FAR_FUTURE).cast(kind)), F.col("decision_id"))
    taken = F.struct(
        "decision_id", decision_status("action").alias("new_status"), "approver",
        F.coalesce("reason", F.lit("")).alias("decision_reason"), "decided_at",
    )
    return (
        decisions.filter(decision_status("action").isNotNull() & F.col("approval_id").isNotNull())
        .groupBy("approval_id").agg(F.min_by(taken, order).alias("d"))
        .select("approval_id", "d.*")
    )


def resolve_approvals(approvals: DataFrame, decisions: DataFrame) -> DataFrame:
    """Approvals after their decisions; only a pending row is changed.

    The reason of the decision takes the place of the request's own.
    """
    first = first_decisions(decisions).withColumnRenamed("approval_id", "id")
    joined = approvals.join(first, "id", "left")
    hit = (F.col("status") == "pending") & F.col("new_status").isNotNull()
    resolved = update(
        joined.withColumn("decision_reason", F.when(hit, F.col("decision_reason"))), hit,
        {
            "resolved_by": F.col("approver"),
            "resolved_at": F.col("decided_at"),
            "status": F.col("new_status"),
            "reason": F.col("decision_reason"),
        },
    )
    return resolved.select(*approvals.columns, "decision_reason")


def decision_outcomes(approvals: DataFrame, decisions: DataFrame) -> DataFrame:
    """What became of each decision: applied, invalid or not_found.

    A decision on an unknown or already resolved approval is not found.  The
    large side is reduced to one row per approval before it is joined.
    """
    pending = approvals.filter(F.col("status") == "pending").select(F.col("id").alias("approval_id"))
    first = (
        first_decisions(decisions).join(pending, "approval_id", "left_semi")
        .select("approval_id", F.col("decision_id").alias("applied_id"))
    )
    joined = decisions.join(first, "approval_id", "left")
    outcome = (
        F.when(decision_status("action").isNull() | F.col("approval_id").isNull(), "invalid")
        .when(F.col("decision_id") == F.col("applied_id"), "applied")
        .otherwise("not_found")
    )
    return joined.select(*decisions.columns, outcome.alias("outcome"))


def latest(df: DataFrame, ts, tie, rows) -> DataFrame:
    """The newest rows, newest first."""
    return df.orderBy(F.desc(ts), F.desc(tie)).limit(rows)


def of_session(df: DataFrame, session, column="session_id") -> DataFrame:
    """Rows of one session."""
    return df.filter(F.col(column) == session)


def latest_versions(registry: DataFrame) -> DataFrame:
    """The highest version of each model."""
    rest = [c for c in registry.columns if c not in ("name", "version")]
    return registry.groupBy("name").agg(
        F.max("version").alias("version"), F.max_by(F.struct(*rest), "version").alias("r")
    ).select("name", "version", *[F.col(f"r.{c}").alias(c) for c in rest])


def next_versions(registry: DataFrame, runs: DataFrame) -> DataFrame:
    """Registry rows of new runs, numbered after the highest version.

    Runs of one model registered together are numbered in run order.
    """
    highest = registry.groupBy("name").agg(F.max("version").alias("highest"))
    order = F.row_number().over(Window.partitionBy("name").orderBy("run_id"))
    numbered = runs.withColumn("_n", order).join(highest, "name", "left")
    version = F.coalesce(F.col("highest"), F.lit(0)) + F.col("_n")
    return numbered.withColumn("version", version.cast("long")).select(*registry.columns)

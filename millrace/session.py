"""Session settings and the shared scratch folder."""

import tempfile
import uuid

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from millrace.errors import ScratchNotConfigured


# Java never compiles a method above 8000 bytes of bytecode.  With this limit
# Spark splits an expression that large into smaller methods instead.
METHOD_LIMIT = ("spark.sql.codegen.hugeMethodLimit", "8000")


def build_session(app="millrace", master=None, **conf) -> SparkSession:
    """A session with the settings every job relies on."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        **dict([METHOD_LIMIT]),
        **conf,
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shuffle_settings(shuffle_bytes, cores, partition_bytes=200 << 20) -> dict:
    """Settings that keep a shuffle partition small enough to sort in memory.

    ``shuffle_bytes`` is the largest amount one step is expected to exchange.
    Adaptive execution merges partitions that turn out small and splits skewed
    ones, so the number errs on the high side.
    """
    wanted = -(-int(shuffle_bytes) // partition_bytes)
    return {
        "spark.sql.shuffle.partitions": str(min(max(wanted, 2 * cores), 100_000)),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(256 << 20),
    }


def pin_settings(spark: SparkSession) -> SparkSession:
    """Runtime settings that a session built elsewhere needs."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set(*METHOD_LIMIT)
    return spark


_local_root = {}


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of the cluster.

    A cluster names it in ``spark.checkpoint.dir``.  Only a local-mode session
    that names none gets a temporary folder, because there the driver and the
    executors are one process on one machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ScratchNotConfigured("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_root:
        _local_root[app] = tempfile.mkdtemp(prefix="millrace-")
    return _local_root[app]


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, unused path under the shared folder."""
    return f"{scratch_root(spark)}/millrace/{name}-{uuid.uuid4().hex}"


def observed(seen: Observation):
    """Metrics of an observation whose action has run.

    None when the optimizer proved the frame empty and dropped the observation.
    """
    try:
        return seen.get
    except Py4JError:
        return None


def unused_name(df: DataFrame, name: str) -> str:
    """A column name the frame does not have yet."""
    while name in df.columns:
        name = f"_{name}"
    return name


def write_counted(df: DataFrame, path: str, mode="errorifexists", partition_by=()) -> int:
    """Write Parquet and return the row count seen by that same pass.

    The count is taken in the writing stage, whose tasks count once each.
    """
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    found = observed(seen)
    return found["rows"] if found else 0


def materialise(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """Write a frame that several later steps read, cutting its lineage.

    Returns the frame read back and its row count.  The files survive the loss
    of an executor, which a cached frame does not.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    rows = write_counted(df, path)
    return spark.read.schema(df.schema).parquet(path), rows

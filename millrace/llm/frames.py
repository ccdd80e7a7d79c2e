"""Small helpers for frames that several operators share."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import materialise

#: A list of at most this many rows of a few numbers is sent to every executor.
SENT_ROWS = 500_000


def load(spark, sf_dir, name) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def listed(df: DataFrame, name: str) -> DataFrame:
    """Write a narrow list and mark it for sending if its counted size allows.

    A longer list is left to an ordinary join.
    """
    written, rows = materialise(df, name)
    return F.broadcast(written) if rows <= SENT_ROWS else written


def held_out(key, folds: int):
    """Whether a row belongs to the fold that nothing is learned from.

    True when the CRC-32 of the key as text is divisible by ``folds``; a null
    key is never learned from.
    """
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % folds == 0, F.lit(True))

"""Service tables kept in a relational database."""

from pyspark.sql import DataFrame, SparkSession


def read_options(url, table, split_column=None, lower=None, upper=None, parts=8, **extra):
    """Reader options; a split column makes the read parallel."""
    options = {"url": url, "dbtable": table, **extra}
    if split_column:
        options.update(
            partitionColumn=split_column, lowerBound=str(lower), upperBound=str(upper),
            numPartitions=str(parts),
        )
    return options


def read_table(spark: SparkSession, url, table, **options) -> DataFrame:
    """A lazy frame over a database table; filters are pushed to it."""
    return spark.read.format("jdbc").options(**read_options(url, table, **options)).load()


def append_rows(df: DataFrame, url, table, batch_rows=10_000, **extra):
    """Append a frame to a database table."""
    options = {"url": url, "dbtable": table, "batchsize": str(batch_rows), **extra}
    df.write.format("jdbc").options(**options).mode("append").save()

"""Feature engineering on columns."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import clean_missing
from millrace.operators.ordered import ordinal_codes
from millrace.session import unused_name


def double_feature(df: DataFrame, column="x", name="x2") -> DataFrame:
    """Adds twice a column; everything else stays."""
    return df.withColumn(name, F.col(column) * 2.0)


def double_batch(batch, column="x", name="x2"):
    """The same on one pandas batch, for ``map_batches``."""
    return batch.assign(**{name: batch[column] * 2.0})


def map_batches(df: DataFrame, fn, schema, **options) -> DataFrame:
    """Apply a function to pandas batches of the rows."""

    def each(batches):
        for batch in batches:
            yield fn(batch, **options)

    return df.mapInPandas(each, schema)


def split_column(key, train_percent=80):
    """"train" or "valid" from a hash of the key: stable, no shuffle."""
    bucket = F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 7), 16, 10).cast("long") % 100
    return F.when(bucket < train_percent, "train").otherwise("valid")


def fit_scaling(df: DataFrame, column) -> DataFrame:
    """One row with mean, population deviation and bounds of a column; NaN is missing."""
    value = clean_missing(column, df.schema[column].dataType.typeName())
    return df.agg(
        F.avg(value).alias("mean"),
        F.stddev_pop(value).alias("std"),
        F.min(value).alias("low"),
        F.max(value).alias("high"),
    )


def normalise(df: DataFrame, column, fit: DataFrame) -> DataFrame:
    """Adds z-score and min-max columns from a fitted row; no spread gives 0.

    The fit enters as scalar subqueries, so applying it is a projection.
    """
    value = clean_missing(column, df.schema[column].dataType.typeName())
    mean, std, low, high = (fit.select(n).scalar() for n in ("mean", "std", "low", "high"))
    present = value.isNotNull()
    return df.withColumns(
        {
            f"{column}_z": F.when(
                present, F.coalesce(F.try_divide(value - mean, F.nullif(std, F.lit(0.0))), F.lit(0.0))
            ),
            f"{column}_01": F.when(
                present,
                F.coalesce(F.try_divide(value - low, F.nullif(high - low, F.lit(0.0))), F.lit(0.0)),
            ),
        }
    )


def fit_ordinal(df: DataFrame, column, **options) -> DataFrame:
    """Mapping from each value to its position in sorted order."""
    return ordinal_codes(df, column, **options)


def ordinal_encode(df: DataFrame, column, mapping: DataFrame, name=None) -> DataFrame:
    """Adds the code of a value; unseen values get -1."""
    value, number = unused_name(df, "_value"), unused_name(df, "_code")
    codes = mapping.select(F.col("value").alias(value), F.col("code").alias(number))
    coded = df.join(codes, F.col(column) == F.col(value), "left")
    code = F.coalesce(F.col(number), F.lit(-1)).cast("long")
    return coded.select(*df.columns, code.alias(name or f"{column}_code"))


def one_hot(df: DataFrame, column, values, prefix=None) -> DataFrame:
    """Adds a 0/1 column for each listed value."""
    prefix = prefix or column
    hot = {
        f"{prefix}_{v}": F.coalesce(F.col(column) == v, F.lit(False)).cast("int") for v in values
    }
    return df.withColumns(hot)

"""How far the distribution of a feature has moved between two snapshots.

A sketch counts values in buckets whose width is a fixed share of their size,
as many to each power of two.  Sketches of parts add up to the sketch of the
whole, whatever the parts, so they are stored with a snapshot and never need its
rows again.  A column has at most about four thousand times ``2**bits`` buckets,
however many rows.
"""

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions.text import clean_missing
from millrace.operators.ordered import running_totals
from millrace.session import write_counted

SKETCH = "column string, bucket double, rows long"
BINS = 10


def bucket(value, bits):
    """Lower end of a value's bucket; 0 has its own, infinities are their own."""
    step = F.pow(F.lit(2.0), F.floor(F.log2(F.abs(value))) - bits)
    plain = F.floor(value / step).cast("double") * step
    return F.when((value == 0) | (F.abs(value) == float("inf")), value).otherwise(plain)


def sketch(df: DataFrame, columns, bits=7) -> DataFrame:
    """(column, bucket, rows) of numeric columns, by one pass; missing values have a null bucket."""
    each = [
        F.struct(
            F.lit(c).alias("column"),
            # Plus zero: minus zero has a bucket of its own otherwise.
            (bucket(clean_missing(c, df.schema[c].dataType.typeName()).cast("double"), bits) + 0.0).alias("bucket"),
        )
        for c in columns
    ]
    return df.select(F.inline(F.array(*each))).groupBy("column", "bucket").agg(F.count(F.lit(1)).alias("rows"))


def merge(*sketches: DataFrame) -> DataFrame:
    """The sketch of all rows of several sketches made with the same ``bits``."""
    everything = reduce(DataFrame.unionByName, sketches)
    return everything.groupBy("column", "bucket").agg(F.sum("rows").alias("rows"))


def save_sketch(made: DataFrame, path) -> int:
    """Store a sketch; its number of buckets."""
    return write_counted(made, path)


def load_sketch(spark: SparkSession, path) -> DataFrame:
    """A stored sketch."""
    return spark.read.schema(SKETCH).parquet(path)


def _ranked(made: DataFrame) -> DataFrame:
    """Buckets with values, the rows before each and the rows in all."""
    whole = Window.partitionBy("column")
    before = whole.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    return made.filter("bucket IS NOT NULL").withColumns(
        {"before": F.coalesce(F.sum("rows").over(before), F.lit(0)), "total": F.sum("rows").over(whole)}
    )


def sketch_quantiles(made: DataFrame, probabilities) -> DataFrame:
    """(column, probability, value): lower ends of the buckets that hold the quantiles.

    A value is at most its ``2**-bits``-th part below the quantile of the rows.
    """
    asked = F.explode(F.array(*[F.lit(float(p)) for p in probabilities]))
    placed = _ranked(made).withColumn("probability", asked)
    upto = F.col("before") + F.col("rows") >= F.greatest(F.col("probability") * F.col("total"), F.lit(1))
    return placed.filter(upto).groupBy("column", "probability").agg(F.min("bucket").alias("value"))


def drift(reference: DataFrame, current: DataFrame) -> DataFrame:
    """A row per column that two sketches have: how far ``current`` is from ``reference``.

    ``distance`` is the largest difference of the two shares of rows up to a
    bucket's end.  The distance of the rows themselves is at least that, and
    more by ``error`` at most: the largest share that one bucket has.
    ``stability`` is the population stability index over tenths of the
    reference; ``missing_change`` is how much the share of missing values grew.
    """
    sides = reference.select("column", "bucket", F.col("rows").alias("a"), F.lit(0).cast("long").alias("b")).unionByName(
        current.select("column", "bucket", F.lit(0).cast("long").alias("a"), F.col("rows").alias("b"))
    )
    both = sides.groupBy("column", "bucket").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    whole = Window.partitionBy("column")
    known = F.col("bucket").isNotNull()
    upto = whole.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = {f"all_{s}": F.sum(s).over(whole) for s in "ab"} | {
        f"known_{s}": F.sum(F.when(known, F.col(s))).over(whole) for s in "ab"
    }
    placed = both.withColumns(totals).withColumns(
        {f"upto_{s}": F.sum(F.when(known, F.col(s)).otherwise(0)).over(upto) for s in "ab"}
    )
    share = lambda column, s: F.try_divide(F.col(f"{column}_{s}").cast("double"), F.col(f"known_{s}"))
    own = lambda s: F.try_divide(F.col(s).cast("double"), F.col(f"known_{s}"))
    middle = F.try_divide(F.col("upto_a") - F.col("a") / 2, F.col("known_a"))
    binned = placed.withColumn("bin", F.least(F.floor(middle * BINS), F.lit(BINS - 1)))
    missing = lambda s: F.try_divide(F.max(F.col(f"all_{s}") - F.col(f"known_{s}")).cast("double"), F.max(f"all_{s}"))
    facts = binned.groupBy("column").agg(
        F.max("known_a").alias("reference_rows"),
        F.max("known_b").alias("current_rows"),
        F.max(F.when(known, F.abs(share("upto", "a") - share("upto", "b")))).alias("distance"),
        F.max(F.when(known, F.greatest(own("a"), own("b")))).alias("error"),
        (missing("b") - missing("a")).alias("missing_change"),
    )
    # Half a row more in every bin keeps empty ones finite.
    bins = binned.filter(known).groupBy("column", "bin").agg(
        F.sum("a").alias("a"), F.sum("b").alias("b"), F.max("known_a").alias("all_a"), F.max("known_b").alias("all_b")
    )
    part = lambda s: (F.col(s) + 0.5) / (F.col(f"all_{s}") + BINS / 2)
    index = F.sum((part("b") - part("a")) * F.ln(part("b") / part("a"))).alias("stability")
    return facts.join(bins.groupBy("column").agg(index), "column", "left")


def exact_distance(reference: DataFrame, current: DataFrame, column, **options) -> DataFrame:
    """One row with the two-sample distance of a column, from the rows themselves.

    The running totals go over ranges of values, so no task sees them all.
    """
    marked = lambda df, a: df.select(
        clean_missing(column, df.schema[column].dataType.typeName()).cast("double").alias("v"),
        F.lit(a).cast("long").alias("a"), F.lit(1 - a).cast("long").alias("b"),
    ).filter("v IS NOT NULL")
    sides = marked(reference, 1).unionByName(marked(current, 0))
    counts = sides.groupBy("v").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    ranked = running_totals(counts, "v", ["a", "b"], **options)
    totals = ranked.agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    all_a, all_b = (totals.select(s).scalar() for s in "ab")
    upto = lambda s, total: F.try_divide((F.col(f"{s}_before") + F.col(s)).cast("double"), total)
    return ranked.agg(F.max(F.abs(upto("a", all_a) - upto("b", all_b))).alias("distance"))

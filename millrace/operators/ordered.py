"""Running totals over a whole ordered table, and what is built on them.

A window without a partition puts a table into one task.  Here the ordered
values are dealt out in ranges by Spark's own sampling range partitioner; each
range is summed on its own and shifted by the totals of the ranges before it.
Only the per-range totals, one for a million values, meet in one task.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.text import clean_missing
from millrace.session import materialise

ONE_TASK_ROWS = 1_000_000
FEWEST_RANGES = 256
# Range totals that are sent to every task: a few numbers each.
TOTALS_SENT = 1_000_000
# Of Spark's increasing ids, the bits that number the rows of a partition.
PLACE_BITS = 33


def in_ranges(table: DataFrame, by, ranges, name, part_rows=None) -> DataFrame:
    """Rows dealt out in ``ranges`` parts of about equal size, in the order of ``by``.

    Adds the number of the part as ``name``.  With ``part_rows``, each is cut
    again into parts of so many consecutive rows, whose numbers grow along
    ``by`` and have gaps.  The frame is written, so that a row keeps its part
    whatever later happens to a task.
    """
    dealt = table.repartitionByRange(ranges, *by)
    if part_rows is None:
        part = F.spark_partition_id()
    else:
        dealt = dealt.sortWithinPartitions(*by)
        # The range above, and below it the place of the row in its range.
        place = F.monotonically_increasing_id()
        part = F.shiftleft(F.shiftright(place, PLACE_BITS), PLACE_BITS) + F.floor(
            place.bitwiseAND(F.lit((1 << PLACE_BITS) - 1)) / part_rows
        )
    return materialise(dealt.withColumn(name, part), "ranged")[0]


def running_totals(
    df: DataFrame, by, totals, one_task_rows=ONE_TASK_ROWS, ranges=None
) -> DataFrame:
    """Adds ``{name}_before``: the total over all rows with a smaller ``by``.

    ``by`` must be unique and not null: group first.  The frame is written
    once, because its size decides the plan and the plan reads it again.
    """
    table, rows = materialise(df, "ordered")
    before = {f"{t}_before": t for t in totals}
    if rows <= one_task_rows:
        return _shifted(table, Window.orderBy(by), before)
    wanted = ranges or max(rows // ONE_TASK_ROWS, FEWEST_RANGES)
    ranged = in_ranges(table, [by], wanted, "_range")
    sums = ranged.groupBy("_range").agg(*[F.sum(t).alias(f"_sum_{t}") for t in totals])
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        "_range",
        *[F.coalesce(F.sum(f"_sum_{t}").over(earlier), F.lit(0)).alias(f"_off_{t}") for t in totals],
    )
    local = _shifted(ranged, Window.partitionBy("_range").orderBy(by), before)
    joined = local.join(F.broadcast(offsets) if wanted <= TOTALS_SENT else offsets, "_range")
    return joined.select(
        *table.columns, *[(F.col(b) + F.col(f"_off_{t}")).alias(b) for b, t in before.items()]
    )


def _shifted(df, window, before):
    frame = window.rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumns({b: F.coalesce(F.sum(t).over(frame), F.lit(0)) for b, t in before.items()})


def exact_quantiles(
    df: DataFrame, column, quantiles, names, one_task_rows=ONE_TASK_ROWS, ranges=None
) -> DataFrame:
    """One row with linearly interpolated quantiles of the non-null values."""
    values = df.select(F.col(column).alias("v")).filter("v IS NOT NULL")
    counts = values.groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    ranked = running_totals(counts, "v", ["n"], one_task_rows, ranges)
    total = ranked.agg(F.sum("n")).scalar()
    placed = ranked.withColumn("_total", total)
    picks = []
    for i, q in enumerate(quantiles):
        place = (F.col("_total") - 1) * F.lit(float(q))
        for side, index in (("lo", F.floor(place)), ("hi", F.ceil(place))):
            here = (F.col("n_before") <= index) & (index < F.col("n_before") + F.col("n"))
            picks.append(F.max(F.when(here, F.col("v"))).alias(f"{side}{i}"))
        picks.append(F.max(place - F.floor(place)).alias(f"part{i}"))
    found = placed.agg(*picks)
    return found.select(
        *[
            (F.col(f"lo{i}") + (F.col(f"hi{i}") - F.col(f"lo{i}")) * F.col(f"part{i}")).alias(name)
            for i, name in enumerate(names)
        ]
    )


def auc(df: DataFrame, label, score, one_task_rows=ONE_TASK_ROWS, ranges=None) -> DataFrame:
    """One row: chance that a positive outscores a negative, ties half.

    Rows whose score is null or NaN take no part.
    """
    kind = df.schema[score].dataType.typeName()
    pairs = df.select(clean_missing(score, kind).alias("s"), (F.col(label) == 1).alias("hit"))
    pairs = pairs.filter("s IS NOT NULL")
    by_score = pairs.groupBy("s").agg(
        F.count_if("hit").alias("p"), F.count_if(~F.coalesce("hit", F.lit(False))).alias("n")
    )
    ranked = running_totals(by_score, "s", ["n"], one_task_rows, ranges)
    # Half points are counted in whole numbers, so the sum has no rounding.
    wins = F.sum(F.col("p").cast("decimal(38,0)") * (2 * F.col("n_before") + F.col("n")))
    pairs = F.sum("p").cast("double") * F.sum("n").cast("double")
    return ranked.agg(
        F.sum("p").alias("positives"),
        F.sum("n").alias("negatives"),
        F.try_divide(wins.cast("double") / 2.0, pairs).alias("auc"),
    )


def ordinal_codes(df: DataFrame, column, one_task_rows=ONE_TASK_ROWS, ranges=None) -> DataFrame:
    """Distinct values, as ``value``, with their position in sorted order, ``code``."""
    values = df.select(F.col(column).alias("v")).filter("v IS NOT NULL").distinct()
    ranked = running_totals(
        values.withColumn("one", F.lit(1).cast("long")), "v", ["one"], one_task_rows, ranges
    )
    return ranked.select(F.col("v").alias("value"), F.col("one_before").alias("code"))

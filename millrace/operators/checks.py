"""Data checks, their report, and the gate.

Row-level checks are compiled into one aggregate, so any number of them costs
one scan, or none when they ride along on a write (``watch``).  Checks that need
a shuffle (duplicates, keys, missing days) each give one report row, and
``report`` unites them all.
"""

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.errors import ValidationFailed
from millrace.functions.text import clean_missing
from millrace.operators.ordered import exact_quantiles
from millrace.session import materialise, observed

# Eight bytes each.
HASHES_SENT = 2_000_000

REPORT = (
    "check string, column string, success boolean, evaluated long, unexpected long, detail string"
)
REPORT_COLUMNS = ["check", "column", "success", "evaluated", "unexpected", "detail"]


@dataclass
class RowCheck:
    """One expectation answered by aggregates over the rows."""

    check: str
    column: str
    evaluated: Column
    unexpected: Column
    success: Column | None = None
    detail: Column = field(default_factory=lambda: F.lit(""))


def _value(df, column):
    return clean_missing(column, df.schema[column].dataType.typeName())


def between(df, column, low, high) -> RowCheck:
    """Values within both bounds, inclusive; missing values are skipped."""
    value = _value(df, column)
    return RowCheck(
        "between", column, F.count(value), F.count_if(~value.between(low, high)),
        detail=F.lit(f"[{low}, {high}]"),
    )


def not_null(df, column, allowed_share=0.0) -> RowCheck:
    """Null and NaN values make up at most the allowed share."""
    value = _value(df, column)
    missing, rows = F.count_if(value.isNull()), F.count(F.lit(1))
    return RowCheck(
        "not_null", column, rows, missing, missing <= rows * F.lit(float(allowed_share)),
        F.lit(f"share <= {allowed_share}"),
    )


def in_set(df, column, allowed) -> RowCheck:
    """Values belong to a fixed set; missing values are skipped."""
    value = _value(df, column)
    return RowCheck(
        "in_set", column, F.count(value), F.count_if(~value.isin(list(allowed))),
        detail=F.lit("|".join(str(a) for a in allowed)),
    )


def sane_time(df, column, earliest, as_of) -> RowCheck:
    """Times are present, not before ``earliest`` and not after ``as_of``."""
    kind = df.schema[column].dataType.typeName()
    value = F.col(column)
    bad = value.isNull() | (value < F.lit(earliest).cast(kind)) | (value > F.lit(as_of).cast(kind))
    return RowCheck(
        "sane_time", column, F.count(F.lit(1)), F.count_if(bad), detail=F.lit(f"{earliest}..{as_of}")
    )


def row_count(low=1, high=None) -> RowCheck:
    """The number of rows lies within bounds."""
    rows = F.count(F.lit(1))
    fits = rows >= low if high is None else rows.between(low, high)
    return RowCheck(
        "row_count", "*", rows, F.when(fits, F.lit(0)).otherwise(F.lit(1)), detail=rows.cast("string")
    )


def mean_within(df, column, low, high) -> RowCheck:
    """The mean lies within bounds."""
    value = _value(df, column)
    fits = F.coalesce(F.avg(value).between(low, high), F.lit(False))
    return RowCheck(
        "mean_within", column, F.count(value), F.when(fits, F.lit(0)).otherwise(F.lit(1)),
        detail=F.lit(f"[{low}, {high}]"),
    )


def _aggregates(checks):
    """One struct of report columns per row check."""
    structs = []
    for i, c in enumerate(checks):
        success = c.success if c.success is not None else c.unexpected == 0
        structs.append(
            F.struct(
                F.lit(c.check).alias("check"),
                F.lit(c.column).alias("column"),
                success.alias("success"),
                c.evaluated.cast("long").alias("evaluated"),
                c.unexpected.cast("long").alias("unexpected"),
                c.detail.alias("detail"),
            ).alias(f"c{i}")
        )
    return structs


def row_report(df: DataFrame, checks) -> DataFrame:
    """Report rows of all row checks, from a single aggregate."""
    one = df.agg(*_aggregates(checks))
    return one.select(F.inline(F.array(*one.columns))).select(*REPORT_COLUMNS)


def watch(df: DataFrame, checks):
    """The frame with its row checks attached, and a function for their report.

    The checks are answered by the write of the frame, so they cost no scan of
    their own; ask for the report after it.  Nothing that shuffles may come
    between: a task of a writing stage counts once, while one before a shuffle
    counts again if its executor is lost and its output made anew.
    """
    seen = Observation()
    watched = df.observe(seen, *_aggregates(checks))

    def watched_report() -> DataFrame:
        found = observed(seen)
        if found is None:
            return row_report(df, checks)
        rows = [tuple(found[f"c{i}"]) for i in range(len(checks))]
        return df.sparkSession.createDataFrame(rows, REPORT)

    return watched, watched_report


def _report_row(df, check, column, evaluated, unexpected, detail):
    """One report row from an already aggregated frame."""
    return df.select(
        F.lit(check).alias("check"),
        F.lit(column).alias("column"),
        (unexpected == 0).alias("success"),
        evaluated.cast("long").alias("evaluated"),
        unexpected.cast("long").alias("unexpected"),
        detail.alias("detail"),
    )


# --- duplicates -----------------------------------------------------------


def _repeated_hashes(df):
    """Hashes held by several rows, how many there are, and the rows read."""
    seen = Observation()
    hashed = df.select(F.xxhash64(*[_hashable(f) for f in df.schema.fields]).alias("_h"))
    counts = hashed.groupBy("_h").agg(F.count(F.lit(1)).alias("_n"))
    counts = counts.observe(seen, F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"))
    repeated, n = materialise(counts.filter("_n > 1").select("_h"), "repeated")
    found = observed(seen)
    return repeated, n, found["rows"] if found else 0


def _rows_with(df, repeated, n):
    """Rows whose hash is listed; a short list is sent to every task."""
    hashed = df.withColumn("_h", F.xxhash64(*[_hashable(f) for f in df.schema.fields]))
    listed = F.broadcast(repeated) if n <= HASHES_SENT else repeated
    return hashed.join(listed, "_h", "left_semi").select(*df.columns)


def _copies(df, keys=None):
    return df.groupBy(*(keys or df.columns)).agg(F.count(F.lit(1)).alias("_copies"))


def _repeated(counted):
    return counted.filter("_copies > 1").withColumnRenamed("_copies", "copies")


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Repeated full rows with their ``copies``; missing equals missing.

    A wide row is first reduced to a hash: that shuffle carries 8 bytes per
    row.  The repeated hashes are written and counted, and only rows that have
    one are compared in full, so rows without a double are not shuffled whole.
    """
    if len(df.columns) > 2 and _hashes_alike(df.schema):
        repeated, n, _ = _repeated_hashes(df)
        df = _rows_with(df, repeated, n)
    return _repeated(_copies(df))


def _hashes_alike(schema):
    """Whether equal rows hash alike: a -0.0 inside an array or struct does not."""
    nested = [f.dataType for f in schema if isinstance(f.dataType, (T.ArrayType, T.StructType))]
    return not any("double" in t.simpleString() or "float" in t.simpleString() for t in nested)


def _hashable(f):
    """A column for hashing, with -0.0 turned into 0.0."""
    if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
        return F.col(f"`{f.name}`") + F.lit(0.0).cast(f.dataType)
    return F.col(f"`{f.name}`")


def unique_rows(df: DataFrame) -> DataFrame:
    """Report row: excess rows, which is rows minus distinct rows."""
    if not _hashes_alike(df.schema):
        totals = _copies(df).agg(
            F.coalesce(F.sum("_copies"), F.lit(0)).alias("rows"),
            F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("excess"),
            F.count_if(F.col("_copies") > 1).alias("groups"),
        )
        totals, _ = materialise(totals, "repeated")
        return _report_row(
            totals, "unique_rows", "*", F.col("rows"), F.col("excess"),
            F.concat(F.col("groups").cast("string"), F.lit(" repeated")),
        )
    repeated, n, rows = _repeated_hashes(df)
    if n == 0:
        clean = [("unique_rows", "*", True, rows, 0, "0 repeated")]
        return df.sparkSession.createDataFrame(clean, REPORT)
    totals = _copies(_rows_with(df, repeated, n)).agg(
        F.sum(F.col("_copies") - 1).alias("excess"), F.count_if(F.col("_copies") > 1).alias("groups")
    )
    return _report_row(
        totals, "unique_rows", "*", F.lit(rows), F.col("excess"),
        F.concat(F.col("groups").cast("string"), F.lit(" repeated")),
    )


def duplicate_keys(df: DataFrame, keys) -> DataFrame:
    """Keys held by several rows, with the number of ``copies``."""
    return _repeated(_copies(df, keys))


def unique_key(df: DataFrame, keys) -> DataFrame:
    """Report row: rows beyond the first of each key."""
    totals = _copies(df, keys).agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("excess"),
        F.count_if(F.col("_copies") > 1).alias("groups"),
    )
    return _report_row(
        totals, "unique_key", ",".join(keys), F.col("rows"), F.col("excess"),
        F.concat(F.col("groups").cast("string"), F.lit(" repeated")),
    )


# --- references and sets ----------------------------------------------------


def orphans(child: DataFrame, key, parent: DataFrame, parent_key) -> DataFrame:
    """Child key values without a parent and the ``rows`` that hold them.

    Rows are counted per key before the join, so a key held by many rows costs
    the join one row.  Null keys refer to nothing and pass.
    """
    held = child.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    parents = parent.select(F.col(parent_key).alias(key))
    return held.join(parents, key, "left_anti").withColumnRenamed("_rows", "rows")


def foreign_key(child: DataFrame, key, parent: DataFrame, parent_key) -> DataFrame:
    """Report row: child rows without a parent."""
    lost = orphans(child, key, parent, parent_key).agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("bad"), F.count(F.lit(1)).alias("keys")
    )
    counted = lost.withColumn("rows", child.agg(F.count(key).alias("n")).scalar())
    return _report_row(
        counted, "foreign_key", key, F.col("rows"), F.col("bad"),
        F.concat(F.col("keys").cast("string"), F.lit(" keys")),
    )


def missing_names(required: DataFrame, present: DataFrame, name) -> DataFrame:
    """Required names that are not present."""
    return required.select(name).join(present.select(name).distinct(), name, "left_anti")


def required_set(required, present: DataFrame, name) -> DataFrame:
    """Report row: required names that are absent."""
    spark = present.sparkSession
    wanted = spark.createDataFrame([(n,) for n in required], f"{name} string")
    lost = missing_names(wanted, present.filter(F.col(name).isin(list(required))), name)
    totals = lost.agg(
        F.count(F.lit(1)).alias("bad"), F.concat_ws(",", F.sort_array(F.collect_list(name))).alias("d")
    )
    return _report_row(
        totals, "required_set", name, F.lit(len(required)), F.col("bad"), F.col("d")
    )


def missing_days(df: DataFrame, ts, start, end) -> DataFrame:
    """Days of [start, end) without a row."""
    days = df.sparkSession.range(1).select(
        F.explode(
            F.sequence(
                F.lit(start).cast("date"),
                F.date_sub(F.lit(end).cast("date"), 1),
                F.expr("interval 1 day"),
            )
        ).alias("day")
    )
    seen = df.select(F.to_date(ts).alias("day")).distinct()
    return days.join(seen, "day", "left_anti")


def complete_days(df: DataFrame, ts, start, end) -> DataFrame:
    """Report row: expected days without a row."""
    gaps = missing_days(df, ts, start, end).agg(F.count(F.lit(1)).alias("bad"))
    expected = F.datediff(F.lit(end).cast("date"), F.lit(start).cast("date"))
    return _report_row(
        gaps, "complete_days", ts, expected, F.col("bad"), F.lit(f"[{start}, {end})")
    )


def unexpected_categories(df: DataFrame, column, allowed) -> DataFrame:
    """Values outside the allowed set with their row counts."""
    return (
        df.filter(F.col(column).isNotNull() & ~F.col(column).isin(list(allowed)))
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def label_shares(df: DataFrame, label) -> DataFrame:
    """Rows and share of each label; a missing label is a label."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("rows"))
    total = df.agg(F.count(F.lit(1)).alias("total")).scalar()
    return counts.withColumn("share", F.try_divide(F.col("rows").cast("double"), total))


def label_balance(df: DataFrame, label, minimum_share, minimum_labels=2) -> DataFrame:
    """Report row: labels whose share is below the minimum."""
    totals = label_shares(df, label).agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.count(F.lit(1)).alias("labels"),
        F.count_if(F.col("share") < minimum_share).alias("rare"),
        F.min("share").alias("least"),
    )
    absent = F.greatest(F.lit(minimum_labels) - F.col("labels"), F.lit(0))
    return _report_row(
        totals, "label_balance", label, F.col("rows"), F.col("rare") + absent,
        F.concat(F.lit("least share "), F.round("least", 6).cast("string")),
    )


# --- schema and distribution --------------------------------------------------


def schema_differences(df: DataFrame, expected: T.StructType) -> DataFrame:
    """One row per column: status is ok, missing, unexpected or type."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema}
    wanted = {f.name: f.dataType.simpleString() for f in expected}
    rows = []
    for name in [*wanted, *(n for n in actual if n not in wanted)]:
        want, have = wanted.get(name), actual.get(name)
        status = (
            "missing" if have is None
            else "unexpected" if want is None
            else "ok" if want == have
            else "type"
        )
        rows.append((name, want, have, status))
    return df.sparkSession.createDataFrame(
        rows, "column string, expected string, actual string, status string"
    )


def schema_check(df: DataFrame, expected: T.StructType) -> DataFrame:
    """Report row: columns that differ from the expected schema."""
    totals = schema_differences(df, expected).agg(
        F.count(F.lit(1)).alias("columns"),
        F.count_if(F.col("status") != "ok").alias("bad"),
        F.concat_ws(
            ",",
            F.sort_array(F.collect_list(F.when(F.col("status") != "ok", F.concat_ws(":", "column", "status")))),
        ).alias("d"),
    )
    return _report_row(totals, "schema", "*", F.col("columns"), F.col("bad"), F.col("d"))


def distribution(df: DataFrame, column, quantiles=(0.05, 0.5, 0.95), exact=True) -> DataFrame:
    """One row: count, mean, sample deviation, bounds and quantiles.

    Exact quantiles interpolate between neighbours and are found with a
    distributed ranking; ``exact=False`` uses the sketch Spark offers.
    """
    value = _value(df, column)
    names = [f"p{round(q * 100):02d}" for q in quantiles]
    moments = [
        F.count(value).alias("rows"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("stddev"),
        F.min(value).alias("least"),
        F.max(value).alias("most"),
    ]
    if not exact:
        sketch = F.percentile_approx(value, list(quantiles), 10_000)
        sketched = df.agg(*moments, sketch.alias("_q"))
        return sketched.select(
            "*", *[F.col("_q")[i].alias(n) for i, n in enumerate(names)]
        ).drop("_q")
    ranked = exact_quantiles(df.select(value.alias(column)), column, quantiles, names)
    return df.agg(*moments).select("*", *[ranked.select(n).scalar().alias(n) for n in names])


def distribution_check(df: DataFrame, column, bounds, exact=True) -> DataFrame:
    """Report row: statistics of ``distribution`` outside their bounds.

    ``bounds`` maps a statistic's name to (low, high); one that is null, as on
    an empty frame, is outside.
    """
    stats = distribution(df, column, exact=exact)
    outside = [
        F.when(F.coalesce(F.col(name).between(low, high), F.lit(False)), None).otherwise(name)
        for name, (low, high) in bounds.items()
    ]
    listed = stats.select("rows", F.array_compact(F.array(*outside)).alias("bad"))
    return _report_row(
        listed, "distribution", column, F.col("rows"), F.size("bad"), F.array_join("bad", ",")
    )


# --- suites ---------------------------------------------------------------


@dataclass
class Constraints:
    """Declared table constraints."""

    not_null: tuple = ()
    unique: tuple = ()
    domains: dict = field(default_factory=dict)
    references: dict = field(default_factory=dict)


def constraint_report(df: DataFrame, constraints: Constraints) -> DataFrame:
    """Report rows of declared constraints.

    ``unique`` holds tuples of columns; ``references`` maps a column to
    (parent frame, parent key).
    """
    rows = [not_null(df, c) for c in constraints.not_null]
    rows += [in_set(df, c, allowed) for c, allowed in constraints.domains.items()]
    parts = [row_report(df, rows)] if rows else []
    parts += [unique_key(df, list(keys)) for keys in constraints.unique]
    parts += [foreign_key(df, c, *parent) for c, parent in constraints.references.items()]
    return report(*parts)


def report(*parts: DataFrame) -> DataFrame:
    """All report rows in one frame."""
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def gate(df: DataFrame, checked: DataFrame) -> DataFrame:
    """Pass the data on unchanged, or raise with the failed checks.

    A report has one row per check, so collecting the failed ones is bounded
    by the number of checks written, not by the data.
    """
    failed = checked.filter(~F.col("success")).collect()
    if failed:
        raise ValidationFailed(failed)
    return df


"""Queries on feature engineering."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators import features, joins, timeline
from millrace.plans.catalog.registry import query, rounded, rounded_average, table, time_text

HOUR = 3_600_000_000
DAY = 24 * HOUR

# Limits so low that every entity takes the plan meant for very large ones.
SLICED = timeline.Limits(group_rows=16, frame_rows=0, slot_rows=16, block_rows=8)

DERIVED_SQL = """
    SELECT l_orderkey, l_linenumber, l_quantity AS x, l_quantity * 2.0 AS x2 FROM lineitem
"""


def _x(spark, directory):
    return table(spark, directory, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").alias("x")
    )


@query("derived_feature", DERIVED_SQL)
def derived_feature(spark, directory):
    """Twice a column, as an expression."""
    return features.double_feature(_x(spark, directory))


@query("derived_feature_batch", DERIVED_SQL)
def derived_feature_batch(spark, directory):
    """Twice a column, by a function on pandas batches."""
    rows = _x(spark, directory)
    schema = T.StructType([*rows.schema.fields, T.StructField("x2", T.DoubleType())])
    return features.map_batches(rows, features.double_batch, schema)


@query(
    "aggregate_features",
    """
    SELECT l_suppkey, count(*) AS li_rows, round(sum(l_extendedprice), 2) AS li_sum,
           round(avg(l_extendedprice) + 1e-9, 4) AS li_avg, min(l_extendedprice) AS li_min,
           max(l_extendedprice) AS li_max, count(DISTINCT l_partkey) AS li_distinct
    FROM lineitem GROUP BY l_suppkey
    """,
)
def aggregate_features(spark, directory):
    """Aggregates per entity, one of them distinct."""
    lines = table(spark, directory, "lineitem")
    out = joins.aggregate_features(lines, "l_suppkey", "l_extendedprice", "li", distinct="l_partkey")
    return out.withColumns({"li_sum": rounded("li_sum", 2), "li_avg": rounded_average("li_avg", 4)})


@query(
    "feature_join",
    """
    WITH li AS (
      SELECT l_orderkey, count(*) AS n, sum(l_extendedprice) AS s, max(l_quantity) AS q
      FROM lineitem GROUP BY l_orderkey
    ),
    cu AS (SELECT o_custkey AS k, count(*) AS n, sum(o_totalprice) AS s FROM orders GROUP BY o_custkey)
    SELECT o_orderkey, o_custkey, coalesce(li.n, 0) AS li_rows, round(coalesce(li.s, 0), 2) AS li_sum,
           cu.n AS cust_rows, round(cu.s, 2) AS cust_sum, c_mktsegment
    FROM orders LEFT JOIN li ON l_orderkey = o_orderkey
    LEFT JOIN cu ON k = o_custkey LEFT JOIN customer ON c_custkey = o_custkey
    """,
)
def feature_join(spark, directory):
    """Orders enriched from their lines, their customer and its history."""
    orders = table(spark, directory, "orders")
    lines = joins.aggregate_features(
        table(spark, directory, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey"),
        "o_orderkey", "l_extendedprice", "li",
    )
    history = joins.aggregate_features(orders, "o_custkey", "o_totalprice", "cust")
    customers = table(spark, directory, "customer").select(
        F.col("c_custkey").alias("o_custkey"), "c_mktsegment"
    )
    joined = joins.feature_join(orders, "o_orderkey", lines)
    joined = joins.feature_join(joined, "o_custkey", history, customers)
    return joined.select(
        "o_orderkey", "o_custkey",
        F.coalesce("li_rows", F.lit(0).cast("long")).alias("li_rows"),
        rounded(F.coalesce("li_sum", F.lit(0.0)), 2).alias("li_sum"),
        "cust_rows", rounded("cust_sum", 2).alias("cust_sum"), "c_mktsegment",
    )


ASOF_SQL = """
    WITH clicks AS (SELECT user_id, ts AS click_ts, value AS click_value FROM events WHERE event_type = 'click'),
    buys AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase')
    SELECT b.event_id, b.user_id, coalesce(strftime(click_ts, '%Y-%m-%d %H:%M:%S.%f'), '') AS click_ts,
           coalesce(click_value, -1) AS click_value
    FROM buys b ASOF LEFT JOIN clicks c ON b.user_id = c.user_id AND b.ts >= c.click_ts
"""

TTL_SQL = ASOF_SQL.replace(
    "coalesce(strftime(click_ts, '%Y-%m-%d %H:%M:%S.%f'), '')",
    "CASE WHEN b.ts < click_ts + INTERVAL 1 DAY THEN strftime(click_ts, '%Y-%m-%d %H:%M:%S.%f') ELSE '' END",
).replace(
    "coalesce(click_value, -1)",
    "CASE WHEN b.ts < click_ts + INTERVAL 1 DAY THEN click_value ELSE -1 END",
)


def _asof(spark, directory, **options):
    events = table(spark, directory, "events")
    clicks = events.filter("event_type = 'click'").select(
        "user_id", F.col("ts").alias("click_ts"), F.col("value").alias("click_value"),
    )
    buys = events.filter("event_type = 'purchase'").select("event_id", "user_id", "ts")
    found = timeline.asof_join(buys, clicks, "user_id", "ts", "click_ts", ["click_value"], **options)
    return found.select(
        "event_id", "user_id",
        F.coalesce(time_text("click_ts"), F.lit("")).alias("click_ts"),
        F.coalesce("click_value", F.lit(-1.0)).alias("click_value"),
    )


@query("asof_feature_join", ASOF_SQL)
def asof_feature_join(spark, directory):
    """Latest click of the user at or before each purchase."""
    return _asof(spark, directory)


@query("asof_feature_join_sliced", ASOF_SQL)
def asof_feature_join_sliced(spark, directory):
    """The same by the plan for very large entities."""
    return _asof(spark, directory, limits=SLICED)


@query("ttl_lookup", TTL_SQL)
def ttl_lookup(spark, directory):
    """The same where a click expires after a day."""
    return _asof(spark, directory, ttl_micros=DAY)


FEATURES_SQL = """
    WITH buys AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase')
    SELECT b.event_id, b.user_id, coalesce(c.value, -1) AS click_value,
           CASE WHEN b.ts < v.ts + INTERVAL 1 DAY THEN v.value ELSE -1 END AS view_value,
           CASE WHEN b.ts < s.ts + INTERVAL 3 DAY THEN strftime(s.ts, '%Y-%m-%d %H:%M:%S.%f') ELSE '' END AS signup_ts
    FROM buys b
    ASOF LEFT JOIN (FROM events WHERE event_type = 'click') c ON b.user_id = c.user_id AND b.ts >= c.ts
    ASOF LEFT JOIN (FROM events WHERE event_type = 'view') v ON b.user_id = v.user_id AND b.ts >= v.ts
    ASOF LEFT JOIN (FROM events WHERE event_type = 'signup') s ON b.user_id = s.user_id AND b.ts >= s.ts
"""


def _features_as_of(spark, directory, **options):
    events = table(spark, directory, "events")
    kinds = {"click": None, "view": DAY, "signup": 3 * DAY}
    tables = [
        timeline.FeatureTable(
            kind, events.filter(F.col("event_type") == kind).select("user_id", "ts", "value"), "ts", ("value",), ttl
        )
        for kind, ttl in kinds.items()
    ]
    buys = events.filter("event_type = 'purchase'").select("event_id", "user_id", "ts")
    found = timeline.asof_join_all(buys, tables, "user_id", "ts", **options)
    return found.select(
        "event_id", "user_id",
        F.coalesce("click_value", F.lit(-1.0)).alias("click_value"),
        F.coalesce("view_value", F.lit(-1.0)).alias("view_value"),
        F.coalesce(time_text("signup_ts"), F.lit("")).alias("signup_ts"),
    )


@query("features_as_of", FEATURES_SQL)
def features_as_of(spark, directory):
    """Three feature tables as of each purchase, two of them expiring, by one pass over time."""
    return _features_as_of(spark, directory)


@query("features_as_of_sliced", FEATURES_SQL)
def features_as_of_sliced(spark, directory):
    """The same by the plan for very large entities."""
    return _features_as_of(spark, directory, limits=SLICED)


@query(
    "rolling_spread",
    """
    SELECT event_id, user_id, count(DISTINCT event_type) OVER w AS rolling_distinct,
           round(quantile_cont(value, 0.5) OVER w + 1e-9, 6) AS rolling_p50, round(quantile_cont(value, 0.9) OVER w + 1e-9, 6) AS rolling_p90
    FROM events
    WINDOW w AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND CURRENT ROW)
    """,
)
def rolling_spread(spark, directory):
    """Kinds of event, median and ninetieth percentile of a user's last seven days."""
    found = timeline.rolling_spread(
        table(spark, directory, "events"), "user_id", "ts", "value", "event_type", 7 * DAY, (0.5, 0.9)
    )
    return found.select(
        "event_id", "user_id", "rolling_distinct", rounded_average("rolling_p50", 6).alias("rolling_p50"),
        rounded_average("rolling_p90", 6).alias("rolling_p90"),
    )


ROLLING_SQL = """
    SELECT event_id, user_id, count(value) OVER w AS rolling_count, round(sum(value) OVER w, 4) AS rolling_sum,
           round(sum(value) OVER w / count(value) OVER w + 1e-9, 6) AS rolling_avg,
           min(value) OVER w AS rolling_min, max(value) OVER w AS rolling_max
    FROM events
    WINDOW w AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND CURRENT ROW)
"""

TRAILING_SQL = """
    SELECT event_id, user_id, count(value) OVER w AS trailing_count, round(sum(value) OVER w, 4) AS trailing_sum,
           round(sum(value) OVER w / count(value) OVER w + 1e-9, 6) AS trailing_avg,
           min(value) OVER w AS trailing_min, max(value) OVER w AS trailing_max
    FROM events
    WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)
"""


def _window_columns(df, prefix):
    return df.select(
        "event_id", "user_id", f"{prefix}_count",
        rounded(f"{prefix}_sum", 4).alias(f"{prefix}_sum"),
        rounded_average(f"{prefix}_avg", 6).alias(f"{prefix}_avg"),
        f"{prefix}_min", f"{prefix}_max",
    )


def _rolling(spark, directory, **options):
    events = table(spark, directory, "events")
    return _window_columns(
        timeline.rolling(events, "user_id", "ts", "value", 7 * DAY, **options), "rolling"
    )


def _trailing(spark, directory, **options):
    events = table(spark, directory, "events")
    return _window_columns(
        timeline.trailing_rows(events, "user_id", "ts", "event_id", "value", 5, **options), "trailing"
    )


@query("rolling_days", ROLLING_SQL)
def rolling_days(spark, directory):
    """Aggregates over the trailing seven days per user."""
    return _rolling(spark, directory)


@query("rolling_days_sliced", ROLLING_SQL)
def rolling_days_sliced(spark, directory):
    """The same by the plan for very large entities."""
    return _rolling(spark, directory, limits=SLICED)


@query("rolling_rows", TRAILING_SQL)
def rolling_rows(spark, directory):
    """Aggregates over the last five events per user."""
    return _trailing(spark, directory)


@query("rolling_rows_sliced", TRAILING_SQL)
def rolling_rows_sliced(spark, directory):
    """The same by the plan for very large entities."""
    return _trailing(spark, directory, limits=SLICED)


LABEL_SQL = """
    SELECT event_id, CASE WHEN count(*) FILTER (event_type = 'purchase') OVER w > 0 THEN 1 ELSE 0 END AS label
    FROM events
    WINDOW w AS (PARTITION BY user_id ORDER BY ts
                 RANGE BETWEEN INTERVAL 1 MICROSECOND FOLLOWING AND INTERVAL 2 DAY FOLLOWING)
"""


def _labels(spark, directory, **options):
    events = table(spark, directory, "events")
    buys = events.filter("event_type = 'purchase'")
    found = timeline.has_event_after(events, buys, "user_id", "ts", "ts", 2 * DAY, **options)
    return found.select("event_id", "label")


@query("label_forward", LABEL_SQL)
def label_forward(spark, directory):
    """Whether the user purchases within the next two days."""
    return _labels(spark, directory)


@query("label_forward_sliced", LABEL_SQL)
def label_forward_sliced(spark, directory):
    """The same by the plan for very large entities."""
    return _labels(spark, directory, limits=SLICED)


SPLIT = "CASE WHEN ('0x' || substr(md5({k}::VARCHAR), 1, 7))::BIGINT % 100 < 80 THEN 'train' ELSE 'valid' END"


@query("hash_split", f"SELECT event_id, user_id, {SPLIT.format(k='user_id')} AS side FROM events")
def hash_split(spark, directory):
    """Training or validation side, all rows of a user on one side."""
    return table(spark, directory, "events").select(
        "event_id", "user_id", features.split_column("user_id").alias("side")
    )


@query(
    "normalise",
    f"""
    WITH fit AS (
      SELECT avg(c_acctbal) AS m, stddev_pop(c_acctbal) AS s, min(c_acctbal) AS lo, max(c_acctbal) AS hi
      FROM customer WHERE {SPLIT.format(k='c_custkey')} = 'train'
    )
    SELECT c_custkey, round((c_acctbal - m) / s, 6) AS z, round((c_acctbal - lo) / (hi - lo), 6) AS scaled
    FROM customer, fit
    """,
)
def normalise(spark, directory):
    """Scaled balances, the scaling fitted on the training side."""
    customers = table(spark, directory, "customer")
    train = customers.filter(features.split_column("c_custkey") == "train")
    scaled = features.normalise(customers, "c_acctbal", features.fit_scaling(train, "c_acctbal"))
    return scaled.select(
        "c_custkey", rounded("c_acctbal_z", 6).alias("z"), rounded("c_acctbal_01", 6).alias("scaled")
    )


ORDINAL_SQL = f"""
    WITH days AS (SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders),
    codes AS (
      SELECT day, row_number() OVER (ORDER BY day) - 1 AS code
      FROM (SELECT DISTINCT day FROM days WHERE {SPLIT.format(k='o_orderkey')} = 'train')
    )
    SELECT o_orderkey, coalesce(code, -1) AS code FROM days LEFT JOIN codes USING (day)
"""


def _ordinal(spark, directory, **options):
    days = table(spark, directory, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day")
    )
    train = days.filter(features.split_column("o_orderkey") == "train")
    mapping = features.fit_ordinal(train, "day", **options)
    return features.ordinal_encode(days, "day", mapping, "code").select("o_orderkey", "code")


@query("ordinal_encode", ORDINAL_SQL)
def ordinal_encode(spark, directory):
    """Position of a category among those of the training side."""
    return _ordinal(spark, directory)


@query("ordinal_encode_in_ranges", ORDINAL_SQL)
def ordinal_encode_in_ranges(spark, directory):
    """The same by the plan for more categories than one task holds."""
    return _ordinal(spark, directory, one_task_rows=0, ranges=16)


@query(
    "one_hot",
    """
    SELECT o_orderkey, (o_orderstatus = 'F')::INT AS status_F, (o_orderstatus = 'O')::INT AS status_O,
           (o_orderstatus = 'P')::INT AS status_P
    FROM orders
    """,
)
def one_hot(spark, directory):
    """A 0/1 column for each status."""
    orders = table(spark, directory, "orders").select("o_orderkey", "o_orderstatus")
    return features.one_hot(orders, "o_orderstatus", ["F", "O", "P"], "status").drop("o_orderstatus")

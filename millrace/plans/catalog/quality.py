"""Queries on checks and reports."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators import checks
from millrace.operators.ordered import exact_quantiles
from millrace.plans.catalog.registry import query, rounded, table
from millrace.schemas import ORDERS


@query(
    "range_check",
    """
    SELECT 'between' AS "check", 'value' AS "column", count(*) FILTER (value < 0 OR value > 300) = 0 AS success,
           count(value) AS evaluated, count(*) FILTER (value < 0 OR value > 300) AS unexpected,
           '[0, 300]' AS detail
    FROM events
    """,
)
def range_check(spark, directory):
    """Values outside a closed range."""
    events = table(spark, directory, "events")
    return checks.row_report(events, [checks.between(events, "value", 0, 300)])


@query(
    "suite_report",
    """
    SELECT 'row_count' AS "check", '*' AS "column", count(*) >= 1 AS success, count(*) AS evaluated,
           CASE WHEN count(*) >= 1 THEN 0 ELSE 1 END::BIGINT AS unexpected, count(*)::VARCHAR AS detail
    FROM events
    UNION ALL
    SELECT 'not_null', 'user_id', count(*) FILTER (user_id IS NULL) = 0, count(*),
           count(*) FILTER (user_id IS NULL), 'share <= 0.0' FROM events
    UNION ALL
    SELECT 'between', 'value', count(*) FILTER (value < 1 OR value > 400) = 0, count(value),
           count(*) FILTER (value < 1 OR value > 400), '[1, 400]' FROM events
    UNION ALL
    SELECT 'in_set', 'event_type', count(*) FILTER (event_type NOT IN ('click', 'view', 'purchase')) = 0,
           count(event_type), count(*) FILTER (event_type NOT IN ('click', 'view', 'purchase')),
           'click|view|purchase' FROM events
    UNION ALL
    SELECT 'sane_time', 'ts', false, count(*),
           count(*) FILTER (ts IS NULL OR ts < TIMESTAMP '2024-01-02' OR ts > TIMESTAMP '2024-01-25'),
           '2024-01-02..2024-01-25' FROM events
    UNION ALL
    SELECT 'mean_within', 'value', avg(value) BETWEEN 0 AND 1000, count(value),
           CASE WHEN avg(value) BETWEEN 0 AND 1000 THEN 0 ELSE 1 END::BIGINT, '[0, 1000]' FROM events
    UNION ALL
    SELECT 'unique_rows', '*', count(*) = count(DISTINCT event_id), count(*),
           count(*) - count(DISTINCT event_id), '0 repeated' FROM events
    """,
)
def suite_report(spark, directory):
    """Several row checks in one scan, and the duplicate check."""
    events = table(spark, directory, "events")
    rows = checks.row_report(
        events,
        [
            checks.row_count(1),
            checks.not_null(events, "user_id"),
            checks.between(events, "value", 1, 400),
            checks.in_set(events, "event_type", ["click", "view", "purchase"]),
            checks.sane_time(events, "ts", "2024-01-02", "2024-01-25"),
            checks.mean_within(events, "value", 0, 1000),
        ],
    )
    return checks.report(rows, checks.unique_rows(events))


@query(
    "dup_rows",
    """
    SELECT l_orderkey, l_linenumber, l_returnflag, count(*) AS copies
    FROM lineitem GROUP BY ALL HAVING count(*) > 1
    """,
)
def dup_rows(spark, directory):
    """Repeated rows of a three-column projection."""
    lines = table(spark, directory, "lineitem")
    return checks.duplicate_rows(lines.select("l_orderkey", "l_linenumber", "l_returnflag"))


@query(
    "dup_keys",
    """
    SELECT l_orderkey, l_linenumber, count(*) AS copies
    FROM lineitem GROUP BY ALL HAVING count(*) > 1
    """,
)
def dup_keys(spark, directory):
    """Keys held by several rows."""
    return checks.duplicate_keys(table(spark, directory, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "unique_key_report",
    """
    WITH k AS (SELECT count(*) AS c FROM lineitem GROUP BY l_orderkey, l_linenumber)
    SELECT 'unique_key' AS "check", 'l_orderkey,l_linenumber' AS "column", max(c) = 1 AS success,
           sum(c)::BIGINT AS evaluated, sum(c - 1)::BIGINT AS unexpected,
           count(*) FILTER (c > 1) || ' repeated' AS detail
    FROM k
    """,
)
def unique_key_report(spark, directory):
    """Rows beyond the first of each key."""
    return checks.unique_key(table(spark, directory, "lineitem"), ["l_orderkey", "l_linenumber"])


EXPECTED_ORDERS = T.StructType(
    [f for f in ORDERS if f.name not in ("o_orderdate", "o_orderpriority")]
    + [T.StructField("o_orderdate", T.TimestampType()), T.StructField("o_clerk", T.StringType())]
)


@query(
    "schema_check",
    """
    SELECT 'o_orderkey' AS "column", 'bigint' AS expected, 'bigint' AS actual, 'ok' AS status, count(o_orderkey) AS present FROM orders
    UNION ALL SELECT 'o_custkey', 'bigint', 'bigint', 'ok', count(o_custkey) FROM orders
    UNION ALL SELECT 'o_orderstatus', 'string', 'string', 'ok', count(o_orderstatus) FROM orders
    UNION ALL SELECT 'o_totalprice', 'double', 'double', 'ok', count(o_totalprice) FROM orders
    UNION ALL SELECT 'o_orderdate', 'timestamp', 'timestamp_ntz', 'type', count(o_orderdate) FROM orders
    UNION ALL SELECT 'o_clerk', 'string', '', 'missing', 0
    UNION ALL SELECT 'o_orderpriority', '', 'string', 'unexpected', count(o_orderpriority) FROM orders
    """,
)
def schema_check(spark, directory):
    """Column differences from an expected schema, with values present."""
    orders = table(spark, directory, "orders")
    present = checks.row_report(orders, [checks.not_null(orders, c) for c in orders.columns]).select(
        "column", (F.col("evaluated") - F.col("unexpected")).alias("present")
    )
    differences = checks.schema_differences(orders, EXPECTED_ORDERS)
    return differences.join(present, "column", "left").select(
        "column",
        F.coalesce("expected", F.lit("")).alias("expected"),
        F.coalesce("actual", F.lit("")).alias("actual"),
        "status",
        F.coalesce("present", F.lit(0).cast("long")).alias("present"),
    )


@query(
    "partition_completeness",
    """
    SELECT strftime(d, '%Y-%m-%d') AS missing_day
    FROM generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-08-01', INTERVAL 1 DAY) AS s(d)
    WHERE d::DATE NOT IN (SELECT o_orderdate::DATE FROM orders)
    """,
)
def partition_completeness(spark, directory):
    """Expected order days without an order."""
    gaps = checks.missing_days(
        table(spark, directory, "orders"), "o_orderdate", "1995-01-01", "2001-08-02"
    )
    return gaps.select(F.date_format("day", "yyyy-MM-dd").alias("missing_day"))


@query(
    "required_set",
    """
    WITH required(name) AS (VALUES ('1-URGENT'), ('2-HIGH'), ('0-NOW'), ('9-NEVER')),
    lost AS (SELECT name FROM required WHERE name NOT IN (SELECT o_orderpriority FROM orders))
    SELECT 'required_set' AS "check", 'name' AS "column", count(*) = 0 AS success,
           4::BIGINT AS evaluated, count(*) AS unexpected,
           coalesce(string_agg(name, ',' ORDER BY name), '') AS detail
    FROM lost
    """,
)
def required_set(spark, directory):
    """Required priorities that no order has."""
    present = table(spark, directory, "orders").select(F.col("o_orderpriority").alias("name"))
    return checks.required_set(["1-URGENT", "2-HIGH", "0-NOW", "9-NEVER"], present, "name")


@query(
    "names_in_list",
    """
    SELECT n_name, count(c_custkey) AS customers
    FROM customer JOIN nation ON c_nationkey = n_nationkey
    WHERE n_name IN ('NATION_1', 'NATION_3', 'NATION_20', 'ATLANTIS')
    GROUP BY n_name ORDER BY n_name
    """,
)
def names_in_list(spark, directory):
    """Rows whose name is in a list, in name order."""
    nations = table(spark, directory, "nation")
    wanted = nations.filter(F.col("n_name").isin("NATION_1", "NATION_3", "NATION_20", "ATLANTIS"))
    held = table(spark, directory, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(
        F.count("c_custkey").alias("customers")
    )
    return wanted.join(held, "n_nationkey").select("n_name", "customers").orderBy("n_name")


@query(
    "constraint_report",
    """
    SELECT 'not_null' AS "check", 'o_orderkey' AS "column", true AS success, count(*) AS evaluated,
           count(*) - count(o_orderkey) AS unexpected, 'share <= 0.0' AS detail FROM orders
    UNION ALL
    SELECT 'in_set', 'o_orderstatus', false, count(o_orderstatus),
           count(*) FILTER (o_orderstatus NOT IN ('P', 'F')), 'P|F' FROM orders
    UNION ALL
    SELECT 'unique_key', 'o_orderkey', count(*) = count(DISTINCT o_orderkey), count(*),
           count(*) - count(DISTINCT o_orderkey), '0 repeated' FROM orders
    UNION ALL
    SELECT 'unique_key', 'o_custkey', false, sum(c)::BIGINT, sum(c - 1)::BIGINT,
           count(*) FILTER (c > 1) || ' repeated'
    FROM (SELECT count(*) AS c FROM orders GROUP BY o_custkey)
    UNION ALL
    SELECT 'foreign_key', 'o_custkey', count(*) FILTER (rich) = 0, count(*), count(*) FILTER (rich),
           count(DISTINCT o_custkey) FILTER (rich) || ' keys'
    FROM (SELECT o_custkey, c_acctbal >= 5000 AS rich FROM orders JOIN customer ON o_custkey = c_custkey)
    """,
)
def constraint_report(spark, directory):
    """Declared constraints; the parents are only the customers below a balance."""
    orders = table(spark, directory, "orders")
    parents = table(spark, directory, "customer").filter("c_acctbal < 5000")
    declared = checks.Constraints(
        not_null=("o_orderkey",),
        unique=(("o_orderkey",), ("o_custkey",)),
        domains={"o_orderstatus": ["P", "F"]},
        references={"o_custkey": (parents, "c_custkey")},
    )
    return checks.constraint_report(orders, declared)


@query(
    "orphan_keys",
    """
    SELECT o_custkey, count(*) AS n_rows FROM orders
    WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 5000)
    GROUP BY o_custkey
    """,
)
def orphan_keys(spark, directory):
    """Orders by customers that are not among the parents."""
    parents = table(spark, directory, "customer").filter("c_acctbal < 5000")
    lost = checks.orphans(table(spark, directory, "orders"), "o_custkey", parents, "c_custkey")
    return lost.withColumnRenamed("rows", "n_rows")


@query(
    "unexpected_categories",
    """
    SELECT event_type, count(*) AS n_rows FROM events
    WHERE event_type NOT IN ('click', 'view') GROUP BY event_type
    """,
)
def unexpected_categories(spark, directory):
    """Categories outside the domain."""
    events = table(spark, directory, "events")
    return checks.unexpected_categories(events, "event_type", ["click", "view"]).withColumnRenamed(
        "rows", "n_rows"
    )


@query(
    "label_balance",
    """
    SELECT quality, count(*) AS n_rows, round(count(*) / (SELECT count(*) FROM labels), 6) AS share
    FROM labels GROUP BY quality
    """,
)
def label_balance(spark, directory):
    """Share of each label."""
    shares = checks.label_shares(table(spark, directory, "labels"), "quality")
    return shares.select("quality", F.col("rows").alias("n_rows"), rounded("share", 6).alias("share"))


DISTRIBUTION_SQL = """
    SELECT count({c}) AS n_rows, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS stddev,
           min({c}) AS least, max({c}) AS most, round(quantile_cont({c}, 0.05), 6) AS p05,
           round(quantile_cont({c}, 0.5), 6) AS p50, round(quantile_cont({c}, 0.95), 6) AS p95
    FROM {t}
"""


def _shown(stats):
    return stats.select(
        F.col("rows").alias("n_rows"), rounded("mean", 6).alias("mean"),
        rounded("stddev", 6).alias("stddev"), "least", "most",
        *[rounded(p, 6).alias(p) for p in ("p05", "p50", "p95")],
    )


@query("distribution_stats", DISTRIBUTION_SQL.format(c="value", t="events"))
def distribution_stats(spark, directory):
    """Moments and exact quantiles."""
    return _shown(checks.distribution(table(spark, directory, "events"), "value"))


@query(
    "quantiles_in_ranges",
    """
    SELECT round(quantile_cont(l_extendedprice, 0.01), 6) AS p01,
           round(quantile_cont(l_extendedprice, 0.333), 6) AS p33,
           round(quantile_cont(l_extendedprice, 0.999), 6) AS p99
    FROM lineitem
    """,
)
def quantiles_in_ranges(spark, directory):
    """Exact quantiles by the plan for more values than one task holds."""
    found = exact_quantiles(
        table(spark, directory, "lineitem"), "l_extendedprice", (0.01, 0.333, 0.999),
        ("p01", "p33", "p99"), one_task_rows=0, ranges=16,
    )
    return found.select(*[rounded(c, 6).alias(c) for c in found.columns])

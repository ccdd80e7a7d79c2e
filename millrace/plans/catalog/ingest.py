"""Queries on scans, sinks and snapshots."""

from pyspark.sql import functions as F

from millrace.operators import models
from millrace.plans import training
from millrace.plans.catalog.registry import query, rounded, table, time_text
from millrace.schemas import CUSTOMER, ORDERS, RUN_METADATA
from millrace.session import fresh_path, write_counted
from millrace.sources import files, metadata, sinks, snapshots
from millrace.sources.ingest import ingest


@query(
    "csv_scan_roundtrip",
    """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
           strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%f') AS ordered_at, o_orderpriority
    FROM orders
    """,
)
def csv_scan_roundtrip(spark, directory):
    """CSV files in a subfolder, found because the top folder has none."""
    root = fresh_path(spark, "csv")
    table(spark, directory, "orders").write.option("header", True).csv(f"{root}/nested")
    back = files.scan_csv(spark, root, ORDERS)
    return back.select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
        time_text("o_orderdate").alias("ordered_at"), "o_orderpriority",
    )


@query(
    "csv_preview",
    """
    SELECT kind_of.column_name, kind_of.kind, least(2, (SELECT count(*) FROM customer)) AS previewed,
           (SELECT count(*) FROM customer) AS n_rows
    FROM (VALUES ('c_custkey', 'bigint'), ('c_name', 'string'), ('c_nationkey', 'int'), ('c_acctbal', 'double'),
                 ('c_mktsegment', 'string')) AS kind_of(column_name, kind)
    """,
)
def csv_preview(spark, directory):
    """What a log line says of a CSV file: its columns and types, and how many rows it shows."""
    root = fresh_path(spark, "csv")
    table(spark, directory, "customer").write.option("header", True).csv(root)
    rows = files.scan_csv(spark, root, CUSTOMER)
    head, kinds = files.preview(rows)
    counted = rows.agg(F.count(F.lit(1)).alias("n_rows"))
    shown = head.agg(F.count(F.lit(1)).alias("previewed"))
    listed = spark.createDataFrame(kinds, "column_name string, kind string")
    return listed.select(
        "column_name", "kind", shown.scalar().alias("previewed"), counted.scalar().alias("n_rows")
    )


@query(
    "ingest_report",
    """
    SELECT 'shop' AS short, 'orders' AS file, 'orders' AS table_name, 'ingested' AS status,
           (SELECT count(*) FROM orders) AS n_rows, 1::BIGINT AS snapshot, (SELECT count(*) FROM orders) AS table_rows,
           (SELECT round(sum(o_totalprice), 2) FROM orders) AS total
    UNION ALL
    SELECT 'shop', 'customer-list', 'customer_list', 'ingested', (SELECT count(*) FROM customer), 1,
           (SELECT count(*) FROM customer), (SELECT round(sum(c_acctbal), 2) FROM customer)
    UNION ALL
    SELECT 'orders', 'swapped', '', 'failed', 0, 0, 0, 0
    UNION ALL
    SELECT 'absent', '', '', 'skipped', 0, 0, 0, 0
    """,
)
def ingest_report(spark, directory):
    """A dataset of two files with different headers, one whose header is not the pinned one, and an absent one."""
    root = fresh_path(spark, "ingest")
    lake = root.rsplit("/", 1)[1].replace("-", "_")
    spark.sql(f"CREATE DATABASE {lake} LOCATION '{root}/lake'")
    orders, customers = table(spark, directory, "orders"), table(spark, directory, "customer")
    swapped = orders.select(*reversed(orders.columns))
    for path, rows in (
        ("shop/orders", orders), ("shop/customer-list", customers), ("orders/swapped", swapped),
    ):
        rows.write.option("header", True).csv(f"{root}/in/{path}.csv")
    registry = [(f"{root}/in/{name}", name) for name in ("shop", "orders", "absent")]
    report = ingest(spark, registry, root, batch_id="1", namespace=lake)
    stored = files.stack(
        spark.table(sinks.table_name(file, lake)).agg(
            F.lit(file).alias("file"), F.count(F.lit(1)).alias("table_rows"), rounded(F.sum(money), 2).alias("total")
        )
        for file, money in (("orders", "o_totalprice"), ("customer-list", "c_acctbal"))
    )
    return report.join(stored, "file", "left").select(
        "short",
        F.coalesce("file", F.lit("")).alias("file"),
        F.coalesce(F.replace("table_name", F.lit(f"{lake}."), F.lit("")), F.lit("")).alias("table_name"),
        "status",
        F.col("rows").alias("n_rows"),
        F.coalesce("snapshot", F.lit(0).cast("long")).alias("snapshot"),
        F.coalesce("table_rows", F.lit(0).cast("long")).alias("table_rows"),
        F.coalesce("total", F.lit(0.0)).alias("total"),
    )


@query(
    "snapshots_as_of",
    """
    WITH years AS (SELECT *, CASE WHEN year(o_orderdate) < 1998 THEN 1 WHEN year(o_orderdate) < 2000 THEN 2 ELSE 3 END AS batch FROM orders)
    SELECT snapshot::BIGINT AS snapshot, o_orderstatus, count(*) AS n_rows, round(sum(o_totalprice), 2) AS total,
           count(*) FILTER (batch = 3) AS with_late
    FROM years JOIN (VALUES (1), (2), (3)) AS v(snapshot) ON batch <= snapshot GROUP BY ALL
    """,
)
def snapshots_as_of(spark, directory):
    """A table after each of three appends, the last with one more column; a repeated batch adds nothing."""
    root = fresh_path(spark, "orders")
    lake = root.rsplit("/", 1)[1].replace("-", "_")
    spark.sql(f"CREATE DATABASE {lake} LOCATION '{root}/lake'")
    orders, year = table(spark, directory, "orders"), F.year("o_orderdate")
    parts = {
        "old": orders.filter(year < 1998), "middle": orders.filter(year.between(1998, 1999)),
        "late": orders.filter(year >= 2000).withColumn("late", F.lit(True)),
    }
    ids = [sinks.append_table(df, f"{lake}.orders", batch, root) for batch, df in parts.items()]
    again = sinks.append_table(parts["old"], f"{lake}.orders", "old", root)
    assert again == ids[0]
    # The newest snapshot as the catalog has it, the others as of their number.
    newest = spark.table(f"{lake}.orders").drop("commit").withColumn("snapshot", F.lit(ids[-1]).cast("long"))
    rows = files.stack([snapshots.rows_of_snapshots(spark, root, ids[:-1]), newest])
    return rows.groupBy("snapshot", "o_orderstatus").agg(
        F.count(F.lit(1)).alias("n_rows"), rounded(F.sum("o_totalprice"), 2).alias("total"),
        F.count(F.when(F.col("late"), 1)).alias("with_late"),
    )


@query(
    "rewrite_history",
    """
    WITH o AS (SELECT *, CASE WHEN year(o_orderdate) < 1998 THEN 1 WHEN year(o_orderdate) < 2000 THEN 2 ELSE 3 END AS batch FROM orders),
    c AS (SELECT count(*) FILTER (batch = 1) AS a, count(*) FILTER (batch = 2) AS b, count(*) FILTER (batch = 3) AS c,
                 count(*) FILTER (batch = 2 AND o_orderpriority <> '5-LOW') AS kept,
                 sum(o_totalprice) AS total, sum(o_totalprice) FILTER (batch = 2) AS middle,
                 sum(o_totalprice) FILTER (batch = 2 AND o_orderpriority = '5-LOW') AS low FROM o)
    SELECT version::BIGINT AS version, kind, rows_written, table_rows, round(money, 2) AS money FROM c, LATERAL (VALUES
      (3, 'append', c, a + b + c, total), (4, 'update', b, a + b + c, total + middle),
      (5, 'delete', kept, a + kept + c, total + middle - 2 * low), (6, 'delete', 0, 0, 0.0)
    ) AS v(version, kind, rows_written, table_rows, money)
    """,
)
def rewrite_history(spark, directory):
    """An update and a delete by predicate write only the files of one batch; then all rows go."""
    root = fresh_path(spark, "orders")
    orders, year = table(spark, directory, "orders"), F.year("o_orderdate")
    for part in (year < 1998, year.between(1998, 1999), year >= 2000):
        snapshots.append(orders.filter(part), root)
    middle = (F.col("o_orderdate") >= "1998-01-01") & (F.col("o_orderdate") < "2000-01-01")
    snapshots.update_rows(spark, root, middle, {"o_totalprice": F.col("o_totalprice") * 2})
    snapshots.delete_rows(spark, root, middle & (F.col("o_orderpriority") == "5-LOW"))
    last = snapshots.delete_rows(spark, root)
    stated = snapshots.rows_of_snapshots(spark, root, range(3, last + 1)).groupBy("snapshot").agg(
        F.count(F.lit(1)).alias("table_rows"), rounded(F.sum("o_totalprice"), 2).alias("money")
    )
    past = snapshots.history(spark, root).filter("version > 2")
    return past.join(stated, F.col("version") == F.col("snapshot"), "left").select(
        "version", "kind", F.col("rows").alias("rows_written"),
        F.coalesce("table_rows", F.lit(0).cast("long")).alias("table_rows"),
        F.coalesce("money", F.lit(0.0)).alias("money"),
    )


@query(
    "snapshot_union_by_name",
    """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
           CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderpriority END AS priority
    FROM orders
    """,
)
def snapshot_union_by_name(spark, directory):
    """Objects under a prefix, one of which lacks a column."""
    root = fresh_path(spark, "raw")
    orders = table(spark, directory, "orders")
    pending = F.col("o_orderstatus") == "P"
    write_counted(orders.filter(pending).drop("o_orderpriority"), f"{root}/a")
    write_counted(orders.filter(~pending), f"{root}/b")
    united = files.require_rows(files.scan_prefix(spark, root), root)
    return united.select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
        F.coalesce("o_orderpriority", F.lit("")).alias("priority"),
    )


@query(
    "extract_time_range",
    """
    SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice,
           strftime(l_shipdate, '%Y-%m-%d') AS ship_day
    FROM lineitem
    WHERE l_shipdate >= TIMESTAMP '1997-01-01' AND l_shipdate < TIMESTAMP '1998-01-01'
    """,
)
def extract_time_range(spark, directory):
    """A half-open year; the range and the columns reach the scan of the given files."""
    year = files.between_times(
        table(spark, directory, "lineitem"), "l_shipdate", "1997-01-01", "1998-01-01"
    )
    return files.project(
        year,
        ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"],
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("ship_day"),
    )


@query(
    "extract_snapshot",
    """
    SELECT 'orders' AS dataset, count(*) AS n_rows, 3::BIGINT AS n_columns, count(*) AS written,
           strftime(min(o_orderdate), '%Y-%m-%d %H:%M:%S.%f') AS first_time,
           strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S.%f') AS last_time
    FROM orders WHERE o_orderdate >= TIMESTAMP '1996-02-29' AND o_orderdate < TIMESTAMP '1999-07-01'
    """,
)
def extract_snapshot(spark, directory):
    """A written snapshot of a time range and a few columns, and its facts."""
    snapshot = training.extract_snapshot(
        spark, f"{directory}/orders.parquet", fresh_path(spark, "snapshot"), "o_orderdate",
        "1996-02-29", "1999-07-01", ["o_orderkey", "o_totalprice"], dataset="orders",
    )
    return snapshot.facts.select(
        "dataset",
        F.col("rows").alias("n_rows"),
        F.col("columns").alias("n_columns"),
        F.lit(snapshot.rows).cast("long").alias("written"),
        time_text("first_time").alias("first_time"),
        time_text("last_time").alias("last_time"),
    )


@query(
    "extract_by_period",
    """
    SELECT 'lineitem' AS dataset, count(*) AS n_rows, 3::BIGINT AS n_columns,
           strftime(min(l_shipdate), '%Y-%m-%d') AS first_day, strftime(max(l_shipdate), '%Y-%m-%d') AS last_day
    FROM lineitem WHERE l_shipdate >= TIMESTAMP '1997-01-01' AND l_shipdate < TIMESTAMP '1998-01-01'
    """,
)
def extract_by_period(spark, directory):
    """Landing by month, and a snapshot of a year that opens only its folders."""
    path = fresh_path(spark, "lineitem-by-month")
    sinks.write_by_period(table(spark, directory, "lineitem"), path, "l_shipdate", "month", "yyyy-MM")
    snapshot = training.extract_snapshot(
        spark, path, fresh_path(spark, "snapshot"), "l_shipdate", "1997-01-01", "1998-01-01",
        ["l_quantity", "l_extendedprice"], partition=("month", "yyyy-MM"),
    )
    return snapshot.facts.select(
        F.lit("lineitem").alias("dataset"),
        F.col("rows").alias("n_rows"),
        F.col("columns").alias("n_columns"),
        F.date_format("first_time", "yyyy-MM-dd").alias("first_day"),
        F.date_format("last_time", "yyyy-MM-dd").alias("last_day"),
    )


@query(
    "snapshot_metadata",
    """
    SELECT 'lineitem' AS dataset, count(*) AS n_rows, 11::BIGINT AS n_columns,
           strftime(min(l_shipdate), '%Y-%m-%d %H:%M:%S.%f') AS first_time,
           strftime(max(l_shipdate), '%Y-%m-%d %H:%M:%S.%f') AS last_time
    FROM lineitem
    """,
)
def snapshot_metadata(spark, directory):
    """Facts about a snapshot."""
    facts = metadata.describe_snapshot(table(spark, directory, "lineitem"), "lineitem", "l_shipdate")
    return facts.select(
        "dataset",
        F.col("rows").alias("n_rows"),
        F.col("columns").alias("n_columns"),
        time_text("first_time").alias("first_time"),
        time_text("last_time").alias("last_time"),
    )


@query(
    "metadata_json",
    """
    WITH fit AS (
      SELECT regr_slope(l_extendedprice, l_quantity) AS a,
             regr_intercept(l_extendedprice, l_quantity) AS b, avg(l_extendedprice) AS m
      FROM lineitem
    )
    SELECT 'run-' || count(*) AS mlflow_run_id, 'models/run-' || count(*) AS mlflow_artifact_uri,
           '1' AS mlflow_registered_version,
           round(1 - sum(pow(l_extendedprice - (a * l_quantity + b), 2))
                     / sum(pow(l_extendedprice - m, 2)), 6) AS r2
    FROM lineitem, fit
    """,
)
def metadata_json(spark, directory):
    """Run metadata written as one JSON object and read back."""
    lines = table(spark, directory, "lineitem")
    fit = models.fit_line(lines, "l_extendedprice", "l_quantity")
    result = models.evaluate(
        models.score_line(lines, fit, "l_quantity"), "l_extendedprice"
    )
    run = F.concat(F.lit("run-"), F.col("rows"))
    one = result.select(
        *models.run_metadata(run, F.concat(F.lit("models/"), run), F.lit("1"), F.col("r2"))
    )
    path = fresh_path(spark, "metadata")
    sinks.write_metadata(one, path)
    return spark.read.schema(RUN_METADATA).json(path).withColumn("r2", rounded("r2", 6))

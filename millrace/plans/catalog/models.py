"""Queries on training, evaluation and the registry."""

from pyspark.sql import functions as F

from millrace.functions import scores
from millrace.operators import drift, features, models, ordered, search
from millrace.operators.tables import latest_versions
from millrace.plans import training
from millrace.plans.catalog.features import SPLIT
from millrace.plans.catalog.registry import query, rounded, table
from millrace.schemas import RUN_METADATA
from millrace.session import fresh_path, materialise
from millrace.sources.files import stack


@query(
    "train_score_r2",
    """
    WITH fit AS (
      SELECT regr_slope(l_extendedprice, l_quantity) AS a, regr_intercept(l_extendedprice, l_quantity) AS b,
             avg(l_extendedprice) AS m
      FROM lineitem
    ),
    scored AS (SELECT l_extendedprice AS y, a * l_quantity + b AS p, m FROM lineitem, fit)
    SELECT count(*) AS n_rows, round(1 - sum(pow(y - p, 2)) / sum(pow(y - m, 2)), 6) AS r2,
           round(sqrt(avg(pow(y - p, 2))), 4) AS rmse
    FROM scored
    """,
)
def train_score_r2(spark, directory):
    """The whole training run on quantity against price."""
    run = training.train(table(spark, directory, "lineitem"), "l_quantity", "l_extendedprice")
    return run.evaluation.select(
        F.col("rows").alias("n_rows"), rounded("r2", 6).alias("r2"), rounded("rmse", 4).alias("rmse")
    )


@query(
    "score_lines",
    f"""
    WITH fit AS (
      SELECT regr_slope(l_extendedprice, l_quantity) AS a, regr_intercept(l_extendedprice, l_quantity) AS b
      FROM lineitem WHERE {SPLIT.format(k='l_orderkey')} = 'train'
    )
    SELECT l_orderkey, l_linenumber, l_extendedprice, round(a * l_quantity + b, 4) AS prediction
    FROM lineitem, fit WHERE {SPLIT.format(k='l_orderkey')} = 'valid'
    """,
)
def score_lines(spark, directory):
    """Predictions on the validation side from a fit on the training side."""
    lines = table(spark, directory, "lineitem")
    side = features.split_column("l_orderkey")
    fit = models.fit_line(lines.filter(side == "train"), "l_extendedprice", "l_quantity")
    scored = models.score_line(lines.filter(side == "valid"), fit, "l_quantity")
    return scored.select(
        "l_orderkey", "l_linenumber", "l_extendedprice", rounded("prediction", 4).alias("prediction")
    )


@query("mllib_gbt_search")
def mllib_gbt_search(spark, directory):
    """Distributed search over regressors, saved, reloaded and compared."""
    lines = table(spark, directory, "lineitem").select(
        "l_orderkey", F.col("l_quantity").alias("x"), F.col("l_extendedprice").alias("y")
    )
    sides = features.double_feature(lines).withColumn("side", features.split_column("l_orderkey"))
    train = sides.filter("side = 'train'").persist()
    candidates = [
        models.Candidate("linear", "linear"),
        models.Candidate("gbt_small", "gbt", (("maxIter", 3), ("maxDepth", 2), ("seed", 7))),
        models.Candidate("gbt_deep", "gbt", (("maxIter", 3), ("maxDepth", 4), ("seed", 7))),
    ]
    fitted = models.search(train, candidates, ["x", "x2"], "y")
    train.unpersist()
    root = fresh_path(spark, "models")
    for name, model in fitted.items():
        models.save_model(model, f"{root}/{name}")
    loaded = {name: models.load_model(f"{root}/{name}") for name in fitted}
    compared = models.compare(loaded, sides.filter("side = 'valid'"), "y")
    chosen = models.best(compared).select("candidate").scalar()
    return compared.withColumn("chosen", F.col("candidate") == chosen)


LINE = models.Candidate("linear", "linear", (("solver", "normal"),))
# So strong a penalty that only the intercept is left.
MEAN = models.Candidate("mean", "linear", (("regParam", 1e12), ("elasticNetParam", 1.0)))


@query(
    "training_to_registry",
    f"""
    WITH years AS (SELECT * FROM (VALUES (1, 1996), (2, 1997)) AS v(version, year)),
    sides AS (
      SELECT version, l_quantity AS x, l_extendedprice AS y, {SPLIT.format(k='l_orderkey')} AS side
      FROM lineitem JOIN years ON year(l_shipdate) = year
    ),
    fit AS (
      SELECT version, regr_slope(y, x) AS a, regr_intercept(y, x) AS b, avg(y) AS c
      FROM sides WHERE side = 'train' GROUP BY version
    ),
    scored AS (
      SELECT version, side, candidate, y, CASE candidate WHEN 'linear' THEN a * x + b ELSE c END AS p,
             avg(y) OVER (PARTITION BY version, side, candidate) AS m
      FROM sides JOIN fit USING (version) CROSS JOIN (VALUES ('linear'), ('mean')) AS v(candidate)
    ),
    measured AS (
      SELECT version, side, candidate, count(*) AS n, 1 - sum(pow(y - p, 2)) / sum(pow(y - m, 2)) AS r2
      FROM scored GROUP BY version, side, candidate
    ),
    best AS (
      SELECT version, max_by(candidate, r2) AS chosen FROM measured WHERE side = 'valid' GROUP BY version
    )
    SELECT 'prices' AS name, version::VARCHAR AS registered_version, chosen,
           max(n) FILTER (side = 'train') AS train_rows, max(n) FILTER (side = 'valid') AS valid_rows,
           round(max(r2) FILTER (side = 'train'), 6) + 0.0::DOUBLE AS train_r2,
           round(max(r2) FILTER (side = 'valid'), 6) + 0.0::DOUBLE AS valid_r2,
           round(max(r2) FILTER (side = 'valid'), 6) + 0.0::DOUBLE AS metadata_r2, true AS reloads
    FROM measured JOIN best USING (version) WHERE candidate = chosen GROUP BY version, chosen
    """,
)
def training_to_registry(spark, directory):
    """Two runs from files to the registry and its metadata, one per year."""
    registry = fresh_path(spark, "registry")
    found = []
    for year in (1996, 1997):
        run = training.train_and_register(
            spark, f"{directory}/lineitem.parquet", "l_shipdate", ["l_orderkey", "l_linenumber"],
            "l_quantity", "l_extendedprice", "prices", [MEAN, LINE], registry,
            f"{year}-01-01", f"{year + 1}-01-01",
        )
        sides = run.compared.filter(F.col("candidate") == run.chosen)
        side = lambda name, c: F.max(F.when(F.col("side") == name, F.col(c)))
        facts = sides.agg(
            F.lit("prices").alias("name"), F.lit(run.chosen).alias("chosen"),
            side("train", "rows").alias("train_rows"), side("valid", "rows").alias("valid_rows"),
            # Plus zero: minus zero has another hash.
            (rounded(side("train", "r2"), 6) + 0.0).alias("train_r2"),
            (rounded(side("valid", "r2"), 6) + 0.0).alias("valid_r2"),
        )
        written = spark.read.schema(RUN_METADATA).json(run.metadata_path)
        again = models.load_model(run.model_path)
        probe = spark.createDataFrame([(10.0,)], "x double")
        found.append(
            facts.crossJoin(
                written.select(
                    F.col("mlflow_registered_version").alias("registered_version"),
                    (rounded("r2", 6) + 0.0).alias("metadata_r2"),
                )
            ).crossJoin(again.transform(probe).select(F.col(run.chosen).isNotNull().alias("reloads")))
        )
    return stack(found)


LINES = {
    "quantity": "l_quantity", "discount": "l_discount", "tax": "l_tax", "line": "l_linenumber",
    "part": "l_partkey", "supplier": "l_suppkey", "order": "l_orderkey",
}


@query(
    "search_by_halving",
    f"""
    WITH sides AS (
      SELECT *, {SPLIT.format(k='l_orderkey')} AS side,
             ('0x' || substr(md5('sample:' || l_orderkey::VARCHAR), 1, 7))::BIGINT AS part FROM lineitem
    ),
    shares AS (SELECT * FROM (VALUES (1, 7, 4, 2 / 28.0), (2, 4, 2, 2 / 16.0), (3, 2, 1, 2 / 8.0), (4, 1, 1, 2 / 4.0)) AS v(rung, n, kept, share)),
    points AS (
      SELECT side, part, l_extendedprice AS y, unnest([{', '.join(f"{{'name': '{n}', 'x': {c}::DOUBLE}}" for n, c in LINES.items())}]) AS p
      FROM sides
    ),
    fits AS (
      SELECT rung, n, kept, p.name AS name, count(*) AS seen, regr_slope(y, p.x) AS a, regr_intercept(y, p.x) AS b
      FROM points JOIN shares ON part < floor(share * 268435456) WHERE side = 'train' GROUP BY ALL
    ),
    errors AS (
      SELECT rung, n, kept, fits.name, seen, sqrt(avg(pow(y - (b + a * p.x), 2))) AS rmse
      FROM fits JOIN points ON fits.name = p.name AND side = 'valid' GROUP BY ALL
    ),
    r1 AS (SELECT *, row_number() OVER (ORDER BY rmse, name) <= kept AS stays FROM errors WHERE rung = 1),
    r2 AS (SELECT *, row_number() OVER (ORDER BY rmse, name) <= kept AS stays FROM errors
           WHERE rung = 2 AND name IN (SELECT name FROM r1 WHERE stays)),
    r3 AS (SELECT *, row_number() OVER (ORDER BY rmse, name) <= kept AS stays FROM errors
           WHERE rung = 3 AND name IN (SELECT name FROM r2 WHERE stays)),
    r4 AS (SELECT *, true AS stays FROM errors WHERE rung = 4 AND name IN (SELECT name FROM r3 WHERE stays))
    SELECT rung, name AS candidate, seen AS n_rows, round(rmse, 3) AS rmse, stays AS kept,
           (SELECT sum(seen) FROM (SELECT seen FROM r1 UNION ALL SELECT seen FROM r2 UNION ALL SELECT seen FROM r3 UNION ALL SELECT seen FROM r4))::BIGINT AS spent
    FROM (SELECT * FROM r1 UNION ALL SELECT * FROM r2 UNION ALL SELECT * FROM r3 UNION ALL SELECT * FROM r4)
    """,
)
def search_by_halving(spark, directory):
    """Seven lines on the price, halved on growing samples; the fits may read twice the training rows."""
    lines = table(spark, directory, "lineitem").withColumn("side", features.split_column("l_orderkey"))
    train, valid = (lines.filter(F.col("side") == side) for side in ("train", "valid"))
    found = search.halving(
        train, valid, LINES, search.Lines(LINES), "l_extendedprice", "l_orderkey", 2 * train.count()
    )
    return found.report.select(
        "rung", "candidate", F.col("rows").alias("n_rows"), rounded("rmse", 3).alias("rmse"), "kept",
        F.lit(found.spent).cast("long").alias("spent"),
    )


def boosting_sql(rounds, step):
    """Boosted stumps over the few values of one column, round by round."""
    parts = ["f0 AS (SELECT x, 0.0::DOUBLE AS f FROM train)"]
    for r in range(1, rounds + 1):
        target = "s" if r == 1 else "2 * (s - n * f)"
        weight = 1.0 if r == 1 else step
        parts.append(
            f"""
    g{r} AS (SELECT x, n, {target} AS t FROM train JOIN f{r - 1} USING (x)),
    h{r} AS (
      SELECT x, sum(n) OVER (ORDER BY x) AS nl, sum(t) OVER (ORDER BY x) AS tl, sum(n) OVER () AS na, sum(t) OVER () AS ta FROM g{r}
    ),
    c{r} AS (
      SELECT x AS cut, tl / nl AS l, (ta - tl) / (na - nl) AS r FROM h{r} WHERE nl < na
      ORDER BY tl * tl / nl + (ta - tl) * (ta - tl) / (na - nl) DESC LIMIT 1
    ),
    f{r} AS (SELECT x, f + {weight} * CASE WHEN x <= cut THEN l ELSE r END AS f FROM f{r - 1}, c{r}),
    e{r} AS (SELECT side, {r} AS round, sum(n)::BIGINT AS n_rows, sqrt(sum(ss - 2 * f * s + n * f * f) / sum(n)) AS rmse FROM points JOIN f{r} USING (x) GROUP BY side)"""
        )
    everything = " UNION ALL ".join(f"SELECT * FROM e{r}" for r in range(1, rounds + 1))
    return f"""
    WITH points AS (
      SELECT {SPLIT.format(k='l_orderkey')} AS side, l_discount AS x, count(*) AS n, sum(l_extendedprice) AS s,
             sum(l_extendedprice * l_extendedprice) AS ss FROM lineitem GROUP BY ALL
    ),
    train AS (SELECT x, n, s FROM points WHERE side = 'train'),
    {','.join(parts)},
    measured AS ({everything})
    SELECT side, round, n_rows, round(rmse, 3) AS rmse,
           round = (SELECT arg_min(round, (rmse, round)) FROM measured WHERE side = 'valid') AS chosen
    FROM measured
    """


@query("boosting_rounds", boosting_sql(6, 0.5))
def boosting_rounds(spark, directory):
    """Boosted stumps on the discount, cut at the round with the least error on the validation side."""
    lines = table(spark, directory, "lineitem").select(
        features.split_column("l_orderkey").alias("side"), "l_discount", F.col("l_extendedprice").alias("y")
    )
    boosted, measured = search.boost(
        lines, ["l_discount"], "y", "side", maxDepth=1, maxIter=6, stepSize=0.5, maxBins=64, seed=7
    )
    path = fresh_path(spark, "boosted")
    search.save_boosted(boosted, path)
    again = search.load_boosted(spark, path)
    # The error of the model that was read back must be that of its round.
    valid = again.transform(lines.filter("side = 'valid'"))
    error = valid.agg(F.sqrt(F.avg(F.pow(F.col("y") - F.col("prediction"), F.lit(2.0))))).first()[0]
    chosen = F.col("chosen") & ((F.col("side") == "train") | (F.abs(F.col("rmse") - error) < 1e-6))
    return measured.select(
        "side", "round", F.col("rows").alias("n_rows"), rounded("rmse", 3).alias("rmse"), chosen.alias("chosen")
    )


@query(
    "snapshot_drift",
    """
    WITH sides AS (
      SELECT year(l_shipdate) >= 1998 AS now, unnest([{'c': 'l_quantity', 'v': l_quantity}, {'c': 'l_extendedprice', 'v': l_extendedprice},
             {'c': 'l_discount', 'v': l_discount}]) AS p FROM lineitem
    ),
    points AS (
      SELECT now, p.c AS c, p.v AS v, CASE WHEN p.v = 0 THEN p.v ELSE
        floor(p.v / pow(2.0, floor(log2(abs(p.v))) - 7)) * pow(2.0, floor(log2(abs(p.v))) - 7) END AS k FROM sides
    ),
    exact AS (SELECT c, v, count(*) FILTER (NOT now) AS a, count(*) FILTER (now) AS b FROM points GROUP BY c, v),
    exact_upto AS (
      SELECT c, sum(a) OVER (PARTITION BY c ORDER BY v) / sum(a) OVER (PARTITION BY c) AS fa,
             sum(b) OVER (PARTITION BY c ORDER BY v) / sum(b) OVER (PARTITION BY c) AS fb FROM exact
    ),
    exact_distance AS (SELECT c, max(abs(fa - fb)) AS d FROM exact_upto GROUP BY c),
    kept AS (SELECT c, k, count(*) FILTER (NOT now) AS a, count(*) FILTER (now) AS b FROM points GROUP BY c, k),
    upto AS (
      SELECT *, sum(a) OVER (PARTITION BY c ORDER BY k) AS ua, sum(b) OVER (PARTITION BY c ORDER BY k) AS ub,
             sum(a) OVER (PARTITION BY c) AS na, sum(b) OVER (PARTITION BY c) AS nb FROM kept
    ),
    bins AS (
      SELECT c, least(floor((ua - a / 2) / na * 10), 9) AS bin, (sum(a) + 0.5) / (max(na) + 5) AS pa, (sum(b) + 0.5) / (max(nb) + 5) AS pb
      FROM upto GROUP BY ALL
    ),
    stability AS (SELECT c, sum((pb - pa) * ln(pb / pa)) AS s FROM bins GROUP BY c)
    SELECT c AS column_name, max(na)::BIGINT AS reference_rows, max(nb)::BIGINT AS current_rows, round(max(abs(ua / na - ub / nb)), 9) AS distance,
           round(max(d), 9) AS exact_distance, true AS within_error, round(max(s), 6) AS stability
    FROM upto JOIN exact_distance USING (c) JOIN stability USING (c) GROUP BY c
    """,
)
def snapshot_drift(spark, directory):
    """Features of a snapshot from 1998 on against one of the years before, from their stored sketches."""
    columns = ["l_quantity", "l_extendedprice", "l_discount"]
    old, new = (
        training.extract_snapshot(
            spark, f"{directory}/lineitem.parquet", fresh_path(spark, "snapshot"), "l_shipdate", *years, columns,
            sketched=columns,
        )
        for years in (("1900-01-01", "1998-01-01"), ("1998-01-01", "2100-01-01"))
    )
    exact = stack(
        drift.exact_distance(old.table, new.table, c).select(F.lit(c).alias("column"), F.col("distance").alias("exact"))
        for c in columns
    )
    off = F.col("exact") - F.col("distance")
    return drift.drift(old.sketch, new.sketch).join(exact, "column").select(
        F.col("column").alias("column_name"), "reference_rows", "current_rows",
        rounded("distance", 9).alias("distance"), rounded("exact", 9).alias("exact_distance"),
        off.between(-1e-12, F.col("error") + 1e-12).alias("within_error"), rounded("stability", 6).alias("stability"),
    )


@query(
    "mllib_linear_model",
    f"""
    WITH sides AS (
      SELECT l_quantity AS x, l_extendedprice AS y, {SPLIT.format(k='l_orderkey')} AS side FROM lineitem
    ),
    fit AS (SELECT regr_slope(y, x) AS a, regr_intercept(y, x) AS b FROM sides WHERE side = 'train'),
    scored AS (
      SELECT side, y, a * x + b AS p, avg(y) OVER (PARTITION BY side) AS m FROM sides, fit
    )
    SELECT side, count(*) AS n_rows, round(1 - sum(pow(y - p, 2)) / sum(pow(y - m, 2)), 6) AS r2,
           round(sqrt(avg(pow(y - p, 2))), 3) AS rmse
    FROM scored GROUP BY side
    """,
)
def mllib_linear_model(spark, directory):
    """A distributed linear model, saved and reloaded, measured on both sides."""
    sides = table(spark, directory, "lineitem").select(
        F.col("l_quantity").alias("x"), F.col("l_extendedprice").alias("y"),
        features.split_column("l_orderkey").alias("side"),
    )
    only = models.Candidate("linear", "linear", (("solver", "normal"),))
    fitted = models.search(sides.filter("side = 'train'"), [only], ["x"], "y")
    path = fresh_path(spark, "model")
    models.save_model(fitted["linear"], path)
    scored = models.load_model(path).transform(sides)
    measured = scored.groupBy("side").agg(
        F.count(F.lit(1)).alias("n_rows"),
        rounded(scores.r2(F.col("y"), F.col("linear")), 6).alias("r2"),
        rounded(scores.rmse(F.col("y"), F.col("linear")), 3).alias("rmse"),
    )
    return measured


def _pairs(spark, directory):
    documents = table(spark, directory, "documents").select("doc_id", "n_chars")
    return table(spark, directory, "labels").select("doc_id", "quality").join(documents, "doc_id")


@query(
    "classification_metrics",
    """
    WITH pairs AS (SELECT quality AS q, n_chars >= 500 AS f FROM labels JOIN documents USING (doc_id)),
    c AS (
      SELECT count(*) FILTER (q = 1 AND f) AS tp, count(*) FILTER (q <> 1 AND f) AS fp,
             count(*) FILTER (q = 1 AND NOT f) AS fn, count(*) FILTER (q <> 1 AND NOT f) AS tn
      FROM pairs
    )
    SELECT tp, fp, fn, tn, round((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy,
           round(tp / (tp + fp), 6) AS precision_score, round(tp / (tp + fn), 6) AS recall_score
    FROM c
    """,
)
def classification_metrics(spark, directory):
    """Confusion counts and what follows, with document length as the score."""
    label, flagged = F.col("quality"), F.col("n_chars") >= 500
    counts = scores.confusion(label, flagged)
    return _pairs(spark, directory).agg(
        *[c.alias(n) for n, c in counts.items()],
        rounded(scores.accuracy(label, flagged), 6).alias("accuracy"),
        rounded(scores.precision(label, flagged), 6).alias("precision_score"),
        rounded(scores.recall(label, flagged), 6).alias("recall_score"),
    )


AUC_SQL = """
    by_score AS (
      SELECT s, sum(l)::BIGINT AS p, sum(1 - l)::BIGINT AS n FROM pairs GROUP BY s
    ),
    ranked AS (SELECT p, n, coalesce(sum(n) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb FROM by_score)
    SELECT sum(p)::BIGINT AS positives, sum(n)::BIGINT AS negatives,
           round(sum(p * (nb + n / 2)) / (sum(p) * sum(n)), 9) AS auc
    FROM ranked
"""


@query(
    "auc",
    "WITH pairs AS (SELECT n_chars AS s, quality AS l FROM labels JOIN documents USING (doc_id))," + AUC_SQL,
)
def auc(spark, directory):
    """Area under the curve of document length against quality."""
    found = ordered.auc(_pairs(spark, directory), "quality", "n_chars")
    return found.withColumn("auc", rounded("auc", 9))


@query(
    "auc_in_ranges",
    "WITH pairs AS (SELECT l_extendedprice AS s, (l_returnflag = 'R')::INT AS l FROM lineitem)," + AUC_SQL,
)
def auc_in_ranges(spark, directory):
    """The same measure by the plan for more scores than one task holds."""
    pairs = table(spark, directory, "lineitem").select(
        "l_extendedprice", (F.col("l_returnflag") == "R").cast("int").alias("returned")
    )
    found = ordered.auc(pairs, "returned", "l_extendedprice", one_task_rows=0, ranges=16)
    return found.withColumn("auc", rounded("auc", 9))


def _runs(lines, suffix):
    """A run per return flag: R² of price on quantity."""
    return lines.groupBy(F.concat(F.lit("price_"), "l_returnflag").alias("name")).agg(
        F.concat(F.lit(f"run-{suffix}-"), F.count(F.lit(1))).alias("run_id"),
        F.lit("models").alias("artifact_uri"),
        rounded(F.regr_r2("l_extendedprice", "l_quantity"), 6).alias("r2"),
    )


@query(
    "model_registry",
    """
    WITH runs AS (
      SELECT 'price_' || l_returnflag AS name, CASE l_linestatus WHEN 'F' THEN 1 ELSE 2 END::BIGINT AS version,
             'run-' || l_linestatus || '-' || count(*) AS run_id, 'models' AS artifact_uri,
             round(regr_r2(l_extendedprice, l_quantity), 6) AS r2
      FROM lineitem GROUP BY l_returnflag, l_linestatus
    )
    SELECT *, version = max(version) OVER (PARTITION BY name) AS latest FROM runs
    """,
)
def model_registry(spark, directory):
    """Two rounds of registrations, and the latest version of each model."""
    lines = table(spark, directory, "lineitem")
    path = fresh_path(spark, "registry")
    models.register(_runs(lines.filter("l_linestatus = 'F'"), "F"), path)
    models.register(_runs(lines.filter("l_linestatus = 'O'"), "O"), path)
    registry = models.read_registry(spark, path)
    newest = latest_versions(registry).select("name", F.col("version").alias("newest"))
    return registry.join(newest, "name").select(
        *registry.columns, (F.col("version") == F.col("newest")).alias("latest")
    )


@query(
    "promotion",
    f"""
    WITH sides AS (SELECT l_quantity, l_discount, l_tax, l_extendedprice AS y, {SPLIT.format(k='l_orderkey')} AS side FROM lineitem),
    fit AS (
      SELECT regr_slope(y, l_quantity) AS aq, regr_intercept(y, l_quantity) AS bq,
             regr_slope(y, l_discount) AS ad, regr_intercept(y, l_discount) AS bd,
             regr_slope(y, l_tax) AS a_tax, regr_intercept(y, l_tax) AS b_tax
      FROM sides WHERE side = 'train'
    ),
    valid AS (SELECT *, (SELECT avg(y) FROM sides WHERE side = 'valid') AS m FROM sides, fit WHERE side = 'valid'),
    metrics AS (
      SELECT 'by_discount' AS candidate, 1 - sum(pow(y - (ad * l_discount + bd), 2)) / sum(pow(y - m, 2)) AS r2 FROM valid
      UNION ALL SELECT 'by_quantity', 1 - sum(pow(y - (aq * l_quantity + bq), 2)) / sum(pow(y - m, 2)) FROM valid
    ),
    base AS (SELECT 1 - sum(pow(y - (a_tax * l_tax + b_tax), 2)) / sum(pow(y - m, 2)) AS r2 FROM valid)
    SELECT candidate, round(metrics.r2, 6) AS r2, round(base.r2, 6) AS baseline, metrics.r2 > base.r2 AS promote
    FROM metrics, base ORDER BY metrics.r2 DESC LIMIT 1
    """,
)
def promotion(spark, directory):
    """The better of two candidates against a baseline, on the validation side."""
    lines = table(spark, directory, "lineitem").withColumn("side", features.split_column("l_orderkey"))
    columns = {"by_discount": "l_discount", "by_quantity": "l_quantity", "by_tax": "l_tax"}
    fit = models.fit_lines(lines.filter("side = 'train'"), "l_extendedprice", columns.values())
    valid = lines.filter("side = 'valid'")
    for name, x in columns.items():
        valid = models.score_line(valid, fit, x, name, line=x)
    # Three rows, needed twice.
    measured, _ = materialise(models.evaluate_all(valid, "l_extendedprice", columns), "measured")
    decided = models.promotion(
        measured.filter("candidate <> 'by_tax'"), measured.filter("candidate = 'by_tax'")
    )
    return decided.select(
        "candidate", rounded("r2", 6).alias("r2"), rounded("baseline", 6).alias("baseline"), "promote"
    )

"""Operations where one key, score or row holds a third of everything."""

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from millrace.operators import checks, features, joins, ordered, tables
from millrace.plans import catalog
from millrace.session import shuffle_settings

N = 900


@pytest.fixture(scope="module")
def hot(spark):
    """Rows (id, k, v, c): a third have the same k, v and c."""
    r = random.Random(8)
    rows = [(i, 7, 1.5, "hot") if i % 3 == 0 else (i, r.randrange(50), float(r.randrange(90)), f"c{r.randrange(40)}") for i in range(N)]
    return rows, spark.createDataFrame(rows, "id long, k long, v double, c string").repartition(7).cache()


def test_duplicates(hot):
    rows, df = hot
    same = Counter(r[1:] for r in rows)
    got = {tuple(r)[:3]: r["copies"] for r in checks.duplicate_rows(df.drop("id")).collect()}
    assert got == {k: n for k, n in same.items() if n > 1}
    assert checks.unique_rows(df.drop("id")).first()["unexpected"] == N - len(same)


def test_keys_and_references(hot):
    rows, df = hot
    count = Counter(r[1] for r in rows)
    got = checks.unique_key(df, ["k"]).first()
    assert got["unexpected"] == N - len(count)
    parent = df.sparkSession.createDataFrame([(k,) for k in range(50) if k != 7], "pk long")
    lost = checks.orphans(df, "k", parent, "pk").collect()
    assert [tuple(r) for r in lost] == [(7, count[7])]


def test_aggregates(hot):
    rows, df = hot
    got = {r["k"]: r for r in joins.aggregate_features(df, "k", "v", "f", distinct="c").collect()}
    for k in got:
        mine = [r for r in rows if r[1] == k]
        assert got[k]["f_rows"] == len(mine) and got[k]["f_distinct"] == len({r[3] for r in mine})
        assert got[k]["f_sum"] == sum(r[2] for r in mine)
        assert got[k]["f_avg"] == pytest.approx(sum(r[2] for r in mine) / len(mine))


@pytest.mark.parametrize("way", [{}, {"one_task_rows": 0, "ranges": 6}])
def test_hot_score_and_category(hot, way):
    rows, df = hot
    got = ordered.auc(df.withColumn("y", (F.col("id") % 2).cast("int")), "y", "v", **way).first()["auc"]
    pos, neg = [r[2] for r in rows if r[0] % 2], [r[2] for r in rows if r[0] % 2 == 0]
    assert got == pytest.approx(sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / len(pos) / len(neg))
    mapping = features.fit_ordinal(df, "c", **way)
    codes = {c: i for i, c in enumerate(sorted({r[3] for r in rows}))}
    coded = features.ordinal_encode(df, "c", mapping).collect()
    assert len(coded) == N and all(r["c_code"] == codes[r["c"]] for r in coded)


def test_many_decisions_on_one_approval(spark):
    start = datetime(2024, 1, 1)
    rows = [(i, "a" if i % 3 else f"b{i}", "approve", "m", None, start - timedelta(seconds=i)) for i in range(N)]
    decisions = spark.createDataFrame(
        rows, "decision_id long, approval_id string, action string, approver string, reason string, decided_at timestamp_ntz"
    )
    approvals = spark.createDataFrame([("a", "pending"), ("b0", "pending"), ("b3", "approved")], "id string, status string")
    first = {r["approval_id"]: r["decision_id"] for r in tables.first_decisions(decisions).collect()}
    assert first["a"] == 899 - (899 % 3 == 0)
    got = Counter(r["outcome"] for r in tables.decision_outcomes(approvals, decisions).collect())
    assert got == {"applied": 2, "not_found": N - 2}


def test_session_lookup_is_pushed_to_the_scan(spark):
    found = catalog.queries()["session_audit"](spark, "/root/testdata/sf0.001")
    assert "EqualTo(user_id,3)" in found._jdf.queryExecution().executedPlan().toString()


def test_shuffle_settings():
    small, large = shuffle_settings(10, 8), shuffle_settings(20 << 40, 4000)
    assert small["spark.sql.shuffle.partitions"] == "16"
    assert int(large["spark.sql.shuffle.partitions"]) == min(100_000, -(-(20 << 40) // (200 << 20)))


def test_column_names_do_not_clash(spark):
    names = ["n", "p", "s", "c", "v", "one", "code", "rows", "copies", "_code"]
    df = spark.createDataFrame([tuple(range(10)), tuple(range(10)), tuple(range(1, 11))], ", ".join(f"{n} long" for n in names))
    for name in names:
        assert checks.distribution(df, name).first()["rows"] == 3
        assert ordered.auc(df.withColumn("y", F.lit(1)), "y", name).first()["positives"] == 3
        coded = features.ordinal_encode(df, name, features.fit_ordinal(df, name), "out")
        assert sorted(r["out"] for r in coded.collect()) == [0, 0, 1]
        got = joins.aggregate_features(df, name, "v", "f", distinct="s").collect()
        assert sorted(r["f_rows"] for r in got) == [1, 2]
        assert checks.unique_key(df, [name]).first()["unexpected"] == 1
    assert checks.unique_rows(df).first()["unexpected"] == 1

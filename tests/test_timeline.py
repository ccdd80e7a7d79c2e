"""Both plans of each time operation against brute force on skewed rows."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from millrace.operators import ordered, timeline
from millrace.operators.timeline import Limits

BASE = datetime(2024, 1, 1)
PLANS = {
    "plain": Limits(),
    "sliced": Limits(group_rows=7, frame_rows=3, slot_rows=7, block_rows=5),
    "mixed": Limits(group_rows=60, frame_rows=25, slot_rows=9, block_rows=11),
}


def skewed(seed, n=240):
    """Rows of which a third belong to one entity, some without an entity.

    Times are coarse, so many rows share one; a burst sits at a single time.
    """
    r = random.Random(seed)
    rows = []
    for i in range(n):
        user = 1 if i % 3 == 0 else r.choice([2, 3, 4, 5, None])
        at = 50 if i % 5 == 0 and user == 1 else r.randrange(0, 400)
        rows.append((i, user, BASE + timedelta(minutes=at), r.choice([None, *map(float, range(20))]), r.choice("ab")))
    return rows


def events(spark, rows):
    return spark.createDataFrame(rows, "id long, u long, ts timestamp_ntz, v double, kind string")


@pytest.fixture(params=PLANS)
def limits(request):
    return PLANS[request.param]


def test_asof(spark, limits):
    rows = skewed(1)
    df = events(spark, rows)
    facts = df.filter("kind = 'b'").select("u", F.col("ts").alias("fts"), F.col("id").alias("fid"))
    found = timeline.asof_join(
        df, facts, "u", "ts", "fts", ["fid"], tie="fid", limits=limits
    ).collect()
    assert len(found) == len(rows)
    for r in found:
        known = [(f[2], f[0]) for f in rows if f[4] == "b" and f[1] is not None and f[1] == r["u"] and f[2] <= r["ts"]]
        assert (r["fts"], r["fid"]) == (max(known) if known else (None, None))


def test_asof_expires_at_its_ttl(spark, limits):
    puts = spark.createDataFrame([(1, BASE, "x")], "u long, pts timestamp_ntz, val string")
    reads = spark.createDataFrame(
        [(1, BASE + timedelta(seconds=s)) for s in (0, 2, 3, 4)] + [(1, BASE - timedelta(seconds=1))],
        "u long, ts timestamp_ntz",
    )
    found = timeline.asof_join(reads, puts, "u", "ts", "pts", ["val"], ttl_micros=3_000_000, limits=limits)
    got = {int((r["ts"] - BASE).total_seconds()): r["val"] for r in found.collect()}
    assert got == {-1: None, 0: "x", 2: "x", 3: None, 4: None}


def test_rolling(spark, limits):
    rows = skewed(2)
    span = timedelta(minutes=60)
    found = timeline.rolling(events(spark, rows), "u", "ts", "v", 3_600_000_000, limits=limits).collect()
    assert len(found) == len(rows)
    for r in found:
        inside = [x[3] for x in rows if x[1] == r["u"] and r["ts"] - span <= x[2] <= r["ts"] and x[3] is not None]
        assert r["rolling_count"] == len(inside)
        if inside:
            assert r["rolling_sum"] == sum(inside)
            assert (r["rolling_min"], r["rolling_max"]) == (min(inside), max(inside))
            assert r["rolling_avg"] == pytest.approx(sum(inside) / len(inside))
        else:
            assert r["rolling_sum"] is None and r["rolling_avg"] is None


def test_rolling_over_many_slots(spark):
    """Dense rows with a burst: slots are narrow, so those between are many."""
    rows = [(i, 1, BASE + timedelta(seconds=i * 7), float(i % 11)) for i in range(240)]
    rows += [(400 + i, 1, BASE + timedelta(seconds=900, microseconds=i * 50), 1.0) for i in range(120)]
    rows += [(600 + i, 2, BASE + timedelta(seconds=i * 100), 2.0) for i in range(10)]
    df = spark.createDataFrame(rows, "id long, u long, ts timestamp_ntz, v double")
    tight = Limits(group_rows=30, frame_rows=20, slot_rows=12, block_rows=5)
    found = timeline.rolling(df, "u", "ts", "v", 1_200_000_000, limits=tight).collect()
    span = timedelta(seconds=1200)
    assert len(found) == len(rows)
    for r in found:
        inside = [x[3] for x in rows if x[1] == r["u"] and r["ts"] - span <= x[2] <= r["ts"]]
        assert (r["rolling_count"], r["rolling_sum"]) == (len(inside), sum(inside))
        assert (r["rolling_min"], r["rolling_max"]) == (min(inside), max(inside))


def test_trailing(spark, limits):
    rows = skewed(3)
    found = timeline.trailing_rows(events(spark, rows), "u", "ts", "id", "v", 4, limits=limits).collect()
    assert len(found) == len(rows)
    for r in found:
        mine = sorted(((x[2], x[0], x[3]) for x in rows if x[1] == r["u"]))
        at = [m[1] for m in mine].index(r["id"])
        inside = [m[2] for m in mine[max(0, at - 3) : at + 1] if m[2] is not None]
        assert r["trailing_count"] == len(inside)
        assert r["trailing_sum"] == (sum(inside) if inside else None)
        assert r["trailing_min"] == (min(inside) if inside else None)
        assert r["trailing_max"] == (max(inside) if inside else None)


@pytest.mark.parametrize("plan", ["plain", "sliced"])
def test_entities_of_two_columns(spark, plan):
    limits = PLANS[plan]
    rows = skewed(9, 120)
    df = events(spark, rows)
    found = timeline.rolling(df, ["u", "kind"], "ts", "v", 3_600_000_000, limits=limits).collect()
    span = timedelta(minutes=60)
    for r in found:
        inside = [
            x[3] for x in rows
            if (x[1], x[4]) == (r["u"], r["kind"]) and r["ts"] - span <= x[2] <= r["ts"] and x[3] is not None
        ]
        assert (r["rolling_count"], r["rolling_sum"]) == (len(inside), sum(inside) if inside else None)
    facts = df.select("u", "kind", F.col("ts").alias("fts"), F.col("id").alias("fid"))
    joined = timeline.asof_join(df, facts, ["u", "kind"], "ts", "fts", ["fid"], tie="fid", limits=limits).collect()
    assert len(joined) == len(rows)
    for r in joined:
        known = [(f[2], f[0]) for f in rows if None not in (f[1], r["u"]) and (f[1], f[4]) == (r["u"], r["kind"]) and f[2] <= r["ts"]]
        assert (r["fts"], r["fid"]) == (max(known) if known else (None, None))


def test_forward_label(spark, limits):
    rows = skewed(4)
    df = events(spark, rows)
    horizon = timedelta(minutes=30)
    found = timeline.has_event_after(
        df, df.filter("kind = 'b'"), "u", "ts", "ts", 1_800_000_000, limits=limits
    ).collect()
    assert len(found) == len(rows)
    for r in found:
        hit = any(
            x[4] == "b" and x[1] is not None and x[1] == r["u"] and r["ts"] < x[2] <= r["ts"] + horizon for x in rows
        )
        assert r["label"] == int(hit)


def test_large_entities_are_found(spark):
    df = spark.createDataFrame([(1, i) for i in range(50)] + [(2, i) for i in range(5)], "key long, pos long")
    big, count = timeline.large_entities(df, Limits(group_rows=10))
    assert [r["key"] for r in big.collect()] == [1] and count == 1


def test_trailing_with_every_row_at_one_moment(spark):
    df = spark.createDataFrame([(i, 1, BASE, float(i)) for i in range(90)], "id long, u long, ts timestamp_ntz, v double")
    found = timeline.trailing_rows(df, "u", "ts", "id", "v", 3, limits=PLANS["sliced"]).collect()
    assert {r["id"]: r["trailing_sum"] for r in found} == {
        i: float(sum(range(max(0, i - 2), i + 1))) for i in range(90)
    }


def test_slots_narrow_until_they_fit(spark):
    rows = [(1, 1_000_000 + i) for i in range(100)] + [(1, 10**12)]
    df = spark.createDataFrame(rows, "key long, pos long")
    width = timeline.slot_width(df, 10)
    fullest = df.groupBy("key", F.floor(F.col("pos") / width)).count().agg(F.max("count")).first()[0]
    assert fullest <= 10


NAMES = "key pos v row tie kind slot part block at n s lo hi found payload origin id end off"


@pytest.mark.parametrize("plan", ["plain", "sliced"])
def test_column_names_do_not_clash(spark, plan):
    """Users may call their columns whatever the operators call theirs."""
    limits = PLANS[plan]
    rows = skewed(6, 60)
    extra = [n for n in NAMES.split() if n not in ("key", "pos", "v", "tie")]
    df = spark.createDataFrame(
        [(u, ts, v, i, *range(len(extra))) for i, u, ts, v, _ in rows],
        ", ".join(["key long", "pos timestamp_ntz", "v double", "tie long", *[f"{n} int" for n in extra]]),
    )
    given = sorted(map(repr, df.collect()))
    facts = df.select("key", F.col("pos").alias("fpos"), F.col("tie").alias("ftie"))
    outs = [
        timeline.rolling(df, "key", "pos", "v", 3_600_000_000, limits=limits),
        timeline.trailing_rows(df, "key", "pos", "tie", "v", 3, limits=limits),
        timeline.asof_join(df, facts, "key", "pos", "fpos", ["ftie"], tie="ftie", limits=limits),
        timeline.has_event_after(df, df, "key", "pos", "pos", 60_000_000, limits=limits),
    ]
    for out in outs:
        assert out.columns[: len(df.columns)] == df.columns
        assert sorted(map(repr, out.select(df.columns).collect())) == given


def feature_tables(df):
    part = lambda kind: df.filter(F.col("kind") == kind).select("u", F.col("ts").alias("at"), F.col("id").alias("fid"), "v")
    return [
        timeline.FeatureTable("a", part("a"), "at", ("fid", "v"), tie="fid"),
        timeline.FeatureTable("b", part("b"), "at", ("fid",), ttl_micros=90 * 60_000_000, tie="fid"),
        timeline.FeatureTable("none", part("nothing"), "at", ("v",)),
    ]


def test_several_tables_at_once(spark, limits):
    rows = skewed(21)
    df = events(spark, rows)
    found = timeline.asof_join_all(df, feature_tables(df), "u", "ts", limits=limits).collect()
    assert len(found) == len(rows)
    for r in found:
        seen = {}
        for kind in "ab":
            known = [(f[2], f[0], f[3]) for f in rows if f[4] == kind and f[1] is not None and f[1] == r["u"] and f[2] <= r["ts"]]
            seen[kind] = max(known, key=lambda k: k[:2]) if known else (None, None, None)
        assert (r["a_at"], r["a_fid"], r["a_v"]) == seen["a"]
        held = seen["b"][0] is not None and r["ts"] < seen["b"][0] + timedelta(minutes=90)
        assert (r["b_at"], r["b_fid"]) == (seen["b"][:2] if held else (None, None))
        assert r["none_at"] is None and r["none_v"] is None


def test_several_tables_move_the_entities_once(spark):
    df = events(spark, skewed(22))
    plan = timeline.asof_join_all(df, feature_tables(df)[:2], "u", "ts")._jdf.queryExecution().optimizedPlan().toString()
    # One ordered pass, and no join.
    assert plan.count("Window [") == 1 and "Join" not in plan


def test_spread_of_ordinary_entities_is_exact(spark):
    rows = skewed(23)
    span = 60 * 60_000_000
    found = timeline.rolling_spread(events(spark, rows), "u", "ts", "v", "kind", span, (0.0, 0.5, 0.9)).collect()
    assert len(found) == len(rows)
    for r in found:
        mine = [f for f in rows if f[1] == r["u"] and r["ts"] - timedelta(hours=1) <= f[2] <= r["ts"]]
        assert r["rolling_distinct"] == len({f[4] for f in mine})
        values = sorted(f[3] for f in mine if f[3] is not None)
        for p, got in ((0.0, r["rolling_p00"]), (0.5, r["rolling_p50"]), (0.9, r["rolling_p90"])):
            if not values:
                assert got is None
                continue
            place = p * (len(values) - 1)
            low = int(place)
            high = min(low + 1, len(values) - 1)
            assert got == pytest.approx(values[low] + (values[high] - values[low]) * (place - low))


def test_spread_of_a_hot_entity_is_close(spark):
    r = random.Random(24)
    # One entity with nearly all rows, and one of ordinary size.
    rows = [(i, 1 if i % 10 else 2, BASE + timedelta(seconds=r.randrange(4_000)), float(r.randrange(5_000)), f"k{r.randrange(1_500)}") for i in range(4_000)]
    span = 1_500 * 1_000_000
    limits = Limits(group_rows=1_000, frame_rows=500, slot_rows=300, block_rows=200)
    found = timeline.rolling_spread(events(spark, rows), "u", "ts", "v", "kind", span, (0.1, 0.5, 0.9), limits=limits).collect()
    assert len(found) == len(rows)
    by_id = {f[0]: f for f in rows}
    for n, got in enumerate(sorted(found, key=lambda f: f["id"])):
        if n % 23:
            continue
        me = by_id[got["id"]]
        mine = [f for f in rows if f[1] == me[1] and me[2] - timedelta(seconds=1_500) <= f[2] <= me[2]]
        distinct, values = len({f[4] for f in mine}), sorted(f[3] for f in mine)
        if me[1] == 2:
            assert got["rolling_distinct"] == distinct
            continue
        # Five times the stated error, which is that of one in about a million.
        assert abs(got["rolling_distinct"] - distinct) <= max(2, 5 * 0.016 * distinct)
        for p, name in ((0.1, "rolling_p10"), (0.5, "rolling_p50"), (0.9, "rolling_p90")):
            rank = sum(v <= got[name] for v in values) / len(values)
            below = sum(v < got[name] for v in values) / len(values)
            assert below - 5 * 0.0133 <= p <= rank + 5 * 0.0133


def dense(spark, n=1_500):
    """Rows of four entities, each with a time of its own."""
    r = random.Random(31)
    rows = [(i, i % 4, BASE + timedelta(seconds=i), float(r.randrange(50)), r.choice("ab")) for i in range(n)]
    return events(spark, rows)


@pytest.fixture
def tasks_of_slots(monkeypatch):
    """How many tasks cut each table into slots."""
    seen, write = [], ordered.materialise

    def counted(df, name):
        if name == "ranged":
            seen.append(df.rdd.getNumPartitions())
        return write(df, name)

    monkeypatch.setattr(ordered, "materialise", counted)
    return seen


SMALL_SLOTS = Limits(group_rows=7, frame_rows=3, slot_rows=4, block_rows=5)


def test_small_slots_do_not_make_many_tasks(spark, tasks_of_slots):
    table = timeline._in_slots(dense(spark).select("u", "id"), ["u", "id"], SMALL_SLOTS)
    slots = {}
    for row in table.collect():
        slots.setdefault(row["slot"], []).append((row["u"], row["id"]))
    assert tasks_of_slots == [timeline.FEWEST_RANGES]
    assert max(map(len, slots.values())) == SMALL_SLOTS.slot_rows and len(slots) >= 375
    # Slots are consecutive, and no row is lost.
    in_order = [row for slot in sorted(slots) for row in sorted(slots[slot])]
    assert in_order == sorted((i % 4, i) for i in range(1_500))


def test_asof_of_small_slots_takes_few_tasks(spark, tasks_of_slots):
    df = dense(spark)
    facts = df.filter("kind = 'b'").select("u", F.col("ts").alias("fts"), F.col("id").alias("fid"))
    ways = [Limits(), SMALL_SLOTS]
    plain, sliced = (
        sorted(map(tuple, timeline.asof_join(df, facts, "u", "ts", "fts", ["fid"], limits=limits).collect()))
        for limits in ways
    )
    assert plain == sliced and len(plain) == 1_500
    assert tasks_of_slots == [timeline.FEWEST_RANGES]


def test_several_tables_of_small_slots_take_few_tasks(spark, tasks_of_slots):
    df = dense(spark)
    plain, sliced = (
        sorted(map(repr, timeline.asof_join_all(df, feature_tables(df), "u", "ts", limits=limits).collect()))
        for limits in (Limits(), SMALL_SLOTS)
    )
    assert plain == sliced and len(plain) == 1_500
    assert tasks_of_slots == [timeline.FEWEST_RANGES]


def test_trailing_rows_of_small_slots_take_few_tasks(spark, tasks_of_slots):
    df = dense(spark)
    plain, sliced = (
        sorted(map(tuple, timeline.trailing_rows(df, "u", "ts", "id", "v", 4, limits=limits).collect()))
        for limits in (Limits(), SMALL_SLOTS)
    )
    assert plain == sliced and len(plain) == 1_500
    assert tasks_of_slots == [timeline.FEWEST_RANGES]


def test_forward_label_of_small_slots_takes_few_tasks(spark, tasks_of_slots):
    df = dense(spark)
    plain, sliced = (
        sorted(map(tuple, timeline.has_event_after(df, df.filter("kind = 'b'"), "u", "ts", "ts", 3_000_000, limits=limits).collect()))
        for limits in (Limits(), SMALL_SLOTS)
    )
    assert plain == sliced and len(plain) == 1_500
    assert tasks_of_slots == [timeline.FEWEST_RANGES]

"""Streams of several micro-batches against the same work on a table."""

import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from millrace.operators import checks, timeline
from millrace.operators.tables import first_decisions
from millrace.session import fresh_path
from millrace.streaming import runs, tables, windows
from millrace.streaming.state import BucketState

BASE = datetime(2024, 1, 1)


def staged(spark, batches, schema):
    """One file per batch, found in this order."""
    import os
    import time

    path = fresh_path(spark, "stream")
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
        for name in os.listdir(path):
            full = f"{path}/{name}"
            if name.endswith(".parquet") and os.path.getmtime(full) > time.time() - 5_000:
                os.utime(full, (time.time() - 10_000 + i * 10,) * 2)
    return path, spark.createDataFrame([], schema).schema


REQUESTS = "ts timestamp_ntz, status string, seconds double"


def requests(seed=1, n=120):
    r = random.Random(seed)
    rows = [(BASE + timedelta(seconds=i * 2 + r.random()), r.choice(["ok", "error"]), r.random() * 30) for i in range(n)]
    return [rows[i::1][:40] for i in (0, 40, 80)]


def test_counters_and_histogram_equal_the_batch(spark):
    path, schema = staged(spark, requests(), REQUESTS)
    for build, keys in (
        (lambda df: windows.windowed_counts(df, "ts", "status"), ["window_start", "status"]),
        (lambda df: windows.windowed_histogram(df, "ts", "seconds", "status"), ["window_start", "status", "le"]),
    ):
        stream = build(runs.read_files(spark, path, schema, files_per_batch=1))
        out = fresh_path(spark, "out")
        runs.write_updates(stream, out)
        updates = runs.read_batches(spark, out, stream.schema)
        assert updates.select("batch_id").distinct().count() > 1
        streamed = runs.newest_updates(updates, *keys)
        batch = build(spark.read.schema(schema).parquet(path)).select(*streamed.columns)
        assert streamed.exceptAll(batch).isEmpty() and batch.exceptAll(streamed).isEmpty()


def test_complete_mode_equals_the_batch(spark):
    path, schema = staged(spark, requests(2), REQUESTS)
    stream = windows.windowed_counts(runs.read_files(spark, path, schema), "ts", "status")
    query = (
        stream.writeStream.outputMode("complete").format("memory").queryName("complete_counts")
        .option("checkpointLocation", fresh_path(spark, "cp")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    batch = windows.windowed_counts(spark.read.schema(schema).parquet(path), "ts", "status")
    assert sorted(spark.table("complete_counts").collect()) == sorted(batch.collect())


DECISIONS = "decision_id long, approval_id string, action string, approver string, reason string, decided_at timestamp_ntz"


def decision_batches():
    at = lambda s: BASE + timedelta(seconds=s)
    return [
        [(1, "a", "later", "m", "", at(1)), (2, "a", "approve", "m", "", at(2)), (3, "x", "approve", "m", "", at(3))],
        [(4, "a", "reject", "m", "", at(4)), (5, "b", "reject", "m", "", at(5)), (6, "done", "reject", "m", "", at(6))],
        [(7, "b", "approve", "m", "", at(7)), (8, "c", "approve", "m", "", at(8))],
    ]


def test_resolution_log(spark):
    path, schema = staged(spark, decision_batches(), DECISIONS)
    approvals = spark.createDataFrame([("a", "pending"), ("b", "pending"), ("c", "pending"), ("done", "approved")], "id string, status string")
    log, checkpoint = fresh_path(spark, "log"), fresh_path(spark, "cp")
    for _ in range(2):
        tables.resolve_stream(runs.read_files(spark, path, schema, 1), approvals, log, checkpoint)
    got = {r["approval_id"]: (r["decision_id"], r["new_status"]) for r in spark.read.parquet(log).collect()}
    assert got == {"a": (2, "approved"), "b": (5, "rejected"), "c": (8, "approved")}
    whole = first_decisions(spark.read.schema(schema).parquet(path))
    assert {r["approval_id"]: r["decision_id"] for r in whole.collect() if r["approval_id"] in got} == {
        k: v[0] for k, v in got.items()
    }


def test_first_decision_of_an_ordered_stream(spark):
    path, schema = staged(spark, decision_batches(), DECISIONS)
    stream = runs.read_files(spark, path, schema, 1).filter("action != 'later'")
    out = fresh_path(spark, "first")
    runs.drain(
        tables.first_decisions_in_order(stream),
        lambda frame, b: frame.write.mode("overwrite").parquet(runs.batch_path(out, b)),
    )
    got = {r["approval_id"]: r["decision_id"] for r in spark.read.parquet(out).collect()}
    assert got == {"a": 2, "x": 3, "b": 5, "done": 6, "c": 8}


def test_validation_splits_every_row(spark):
    path, schema = staged(spark, requests(3), REQUESTS)
    out = fresh_path(spark, "checked")
    tables.validate_stream(
        runs.read_files(spark, path, schema, 1), lambda f: [checks.between(f, "seconds", 0, 20)],
        ~F.col("seconds").between(0, 20), out,
    )
    rows = spark.read.parquet(f"{out}/rows")
    bad = rows.filter("verdict = 'quarantine'")
    assert rows.count() == 120 and bad.count() == spark.read.parquet(path).filter("seconds > 20").count()
    report = spark.read.parquet(f"{out}/report")
    assert report.count() == 3 and report.agg(F.sum("unexpected")).first()[0] == bad.count()


def test_files_are_ingested_once(spark):
    path, schema = staged(spark, requests(4), REQUESTS)
    out, checkpoint = fresh_path(spark, "in"), fresh_path(spark, "cp")
    for _ in range(2):
        tables.ingest_files(runs.read_files(spark, path, schema, 1), out, checkpoint)
    assert spark.read.schema(schema).parquet(out).count() == 120
    spark.createDataFrame([(BASE, "ok", 1.0)], REQUESTS).write.mode("append").parquet(path)
    tables.ingest_files(runs.read_files(spark, path, schema, 1), out, checkpoint)
    assert spark.read.schema(schema).parquet(out).count() == 121


def kv(r, n):
    """Random puts and reads in time order, as (key, at, put, value, ttl, read_id)."""
    out = []
    for i in range(n):
        key, at = r.choice(["a", "a", "b", None]), BASE + timedelta(seconds=i)
        if r.random() < 0.3:
            out.append((key, at, True, f"v{i}", r.choice([3.0, 3.0, 40.0, None]), None))
        else:
            out.append((key, at, False, None, None, f"r{i}"))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_expiring_values(spark, seed):
    rows = kv(random.Random(seed), 90)
    # Set with a time to live of 3 s: there at once, gone after 4 s.
    rows += [("k", BASE + timedelta(seconds=100), True, "ci", 3.0, None)]
    rows += [("k", BASE + timedelta(seconds=100 + s), False, None, None, f"k{s}") for s in (0, 2, 3, 4)]
    path, schema = staged(spark, [rows[:30], rows[30:60], rows[60:]], tables.EXPIRING)
    answers = fresh_path(spark, "answers")
    assert tables.expiring_values(runs.read_files(spark, path, schema, 1), answers) == 0
    got = {r["read_id"]: r["value"] for r in spark.read.parquet(answers).collect()}
    store, want = {}, {}
    for key, at, put, value, ttl, read in rows:
        if put:
            store[key] = (value, at + timedelta(seconds=ttl) if ttl is not None else datetime.max)
        else:
            held = store.get(key) if key is not None else None
            want[read] = held[0] if held and at < held[1] else None
    assert got == want
    assert (got["k0"], got["k2"], got["k3"], got["k4"]) == ("ci", "ci", None, None)



def plain_store(arrived):
    """Answers of a store, events by arrival: a read sees the newest put so far at or before it."""
    puts, want = {}, {}
    for batch in arrived:
        for key, at, put, value, ttl, _ in batch:
            if put and key is not None:
                puts.setdefault(key, []).append((at, value, ttl))
        for key, at, put, _, _, read in batch:
            if put:
                continue
            seen = max((p for p in puts.get(key, []) if p[0] <= at), key=lambda p: p[:2], default=None)
            alive = seen and (seen[2] is None or at < seen[0] + timedelta(seconds=seen[2]))
            want[read] = seen[1] if alive else None
    return want


@pytest.mark.parametrize("seed", [3, 4])
def test_late_reads_and_a_hot_key(spark, monkeypatch, seed):
    r = random.Random(seed)
    events = [(r.choice(["hot", "a", "b", "c", None]), at, put, value, ttl, read) for _, at, put, value, ttl, read in kv(r, 240)]
    # Reads come up to two minutes late, puts up to one.
    late = lambda e: e[1] + timedelta(seconds=r.random() * (60 if e[2] else 120) if r.random() < 0.5 else 0)
    order = sorted(events, key=late)
    batches = [order[i : i + 40] for i in range(0, 240, 40)]
    # The plan for keys with very many events, on all of them.
    monkeypatch.setattr(tables, "Limits", lambda: timeline.Limits(group_rows=5, slot_rows=7))
    path, schema = staged(spark, batches, tables.EXPIRING)
    answers = fresh_path(spark, "answers")
    assert tables.expiring_values(runs.read_files(spark, path, schema, 1), answers, late="3 minutes", buckets=3) == 0
    got = {row["read_id"]: row["value"] for row in spark.read.parquet(answers).collect()}
    assert got == plain_store(batches)


def test_reads_beyond_the_lateness_are_counted(spark):
    at = lambda s: BASE + timedelta(seconds=s)
    batches = [
        [("k", at(0), True, "old", None, None), ("k", at(1000), True, "new", 5.0, None), ("n", None, True, "x", None, None)],
        [("k", at(900), False, None, None, "late"), ("k", at(1), False, None, None, "too late"), (None, at(950), False, None, None, "keyless")],
        [("k", at(2), True, "older", None, None), ("q", at(1), True, "first", None, None), ("q", at(1001), False, None, None, "q")],
        [("k", at(1004), False, None, None, "alive"), ("k", at(1005), False, None, None, "gone")],
    ]
    path, schema = staged(spark, batches, tables.EXPIRING)
    answers, checkpoint = fresh_path(spark, "answers"), fresh_path(spark, "cp")
    assert tables.expiring_values(runs.read_files(spark, path, schema, 1), answers, checkpoint, late="150 seconds") == 2
    got = {row["read_id"]: row["value"] for row in spark.read.parquet(answers).collect()}
    assert got == {"late": "old", "keyless": None, "q": "first", "alive": "new", "gone": None}
    # A second run over the same checkpoint finds nothing new and changes nothing.
    assert tables.expiring_values(runs.read_files(spark, path, schema, 1), answers, checkpoint, late="150 seconds") == 0
    assert spark.read.parquet(answers).count() == 5


def test_puts_that_no_read_can_see_are_given_up(spark):
    at = lambda s: BASE + timedelta(seconds=s)
    batches = [[("k", at(10 * n + i), True, f"v{n}.{i}", None, None) for i in range(10)] for n in range(6)]
    path, schema = staged(spark, batches, tables.EXPIRING)
    answers = fresh_path(spark, "answers")
    tables.expiring_values(runs.read_files(spark, path, schema, 1), answers, late="15 seconds", buckets=2)
    kept = state_of(spark, f"{answers}-puts", "key", 2).index(6)
    assert kept.facts["newest"] == int(at(59).replace(tzinfo=timezone.utc).timestamp() * 1e6)
    rows = state_of(spark, f"{answers}-puts", "key", 2).rows(kept, [0, 1]).collect()
    assert sorted(r["value"] for r in rows) == sorted([f"v5.{i}" for i in range(10)] + [f"v4.{i}" for i in range(4, 10)])


def state_of(spark, root, key, count):
    return BucketState(spark, root, spark.createDataFrame([], tables.EXPIRING).schema, key, count)


def test_many_micro_batches_read_no_more_with_time(spark, monkeypatch):
    r = random.Random(6)
    ids = [f"a{n}" for n in range(400)]
    approvals = spark.createDataFrame([(i, "approved" if n % 9 == 0 else "pending") for n, i in enumerate(ids)], "id string, status string")
    number, batches = 0, []
    for batch in range(20):
        rows = []
        for _ in range(10):
            number += 1
            rows.append((number, r.choice(ids), r.choice(["approve", "reject", "later"]), "m", "", BASE + timedelta(seconds=number)))
        batches.append(rows)
    path, schema = staged(spark, batches, DECISIONS)
    read, rows = [], BucketState.rows

    def counted(self, index, wanted):
        found = rows(self, index, wanted)
        read.append((found.count(), len(wanted)))
        return found

    monkeypatch.setattr(BucketState, "rows", counted)
    log = fresh_path(spark, "log")
    tables.resolve_stream(runs.read_files(spark, path, schema, 1), approvals, log, buckets=50)
    got = {row["approval_id"]: row["decision_id"] for row in spark.read.parquet(log).collect()}
    want = {}
    for decision, approval, action, *_ in (row for batch in batches for row in batch):
        if action != "later" and ids.index(approval) % 9:
            want.setdefault(approval, decision)
    assert got == want and spark.read.parquet(log).count() == len(want)
    # Eight open approvals a bucket at first: never more than the buckets of ten decisions hold.
    assert len(read) == 20 and all(n <= 14 * wanted for n, wanted in read)
    assert sum(n for n, _ in read[10:]) <= sum(n for n, _ in read[:10])


def test_a_repeated_micro_batch_replaces_what_it_wrote(spark):
    state = state_of(spark, fresh_path(spark, "state"), "key", 4)
    row = lambda key, value: (key, BASE, True, value, None, None)
    frame = lambda *rows: spark.createDataFrame(rows, tables.EXPIRING)
    values = lambda index: sorted(r["value"] for r in state.rows(index, range(4)).collect())
    state.start(frame(row("a", "0"), row("b", "0")), 0, {"n": 0})
    for _ in range(2):
        index = state.index(0)
        changed = frame(row("a", "1"), row("c", "1"))
        wanted = state.buckets_of(changed)
        state.save(state.rows(index, wanted).filter("key <> 'a'").unionByName(changed), 0, index, wanted, {"n": 1})
        assert values(state.index(0)) == ["0", "0"] and values(state.index(1)) == ["0", "1", "1"]
    everything = state.buckets_of(frame(*[row(k, "") for k in "abc"]))
    state.save(frame(), 1, state.index(1), everything, {"n": 2})
    assert values(state.index(2)) == [] and state.index(2).facts == {"n": 2} and state.index(3) is None

import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from millrace.functions import fixed, nested, rules, scores, text
from millrace.functions.json_rules import check_arguments
from millrace.operators import metrics


def one(spark, expression, **values):
    """Value of an expression over a one-row frame of strings."""
    schema = ", ".join(f"{n} string" for n in values) or "x string"
    df = spark.createDataFrame([tuple(values.values()) or ("",)], schema)
    return df.select(expression.alias("r")).first()["r"]


@pytest.mark.parametrize("raw", ["  a b ", "\t\na\r\n", " a　", "\x1fa\x1c", "", " \n ", "a\nb", "a\n"])
def test_strip_is_pythons(spark, raw):
    assert one(spark, text.strip("s"), s=raw) == raw.strip()


@pytest.mark.parametrize(
    "uri,masked",
    [
        ("postgres://u:secret@h:5432/d", "postgres://u:*****@h:5432/d"),
        ("a:b@c:d@e", "a:*****@c:d@e"),
        ("no secret here", "no secret here"),
        ("x:1\nu:p@h q:r@s", "x:1\nu:*****@h q:r@s"),
    ],
)
def test_mask(spark, uri, masked):
    assert one(spark, text.mask_credentials("s"), s=uri) == masked


def test_iso_time_is_pythons(spark):
    for at in (datetime(2024, 1, 2, 3, 4, 5), datetime(2024, 1, 2, 3, 4, 5, 60)):
        df = spark.createDataFrame([(at,)], "t timestamp_ntz")
        assert df.select(text.iso_time("t")).first()[0] == at.replace(tzinfo=timezone.utc).isoformat()


def test_small_text_rules(spark):
    assert one(spark, text.decision_status("s"), s="approve") == "approved"
    assert one(spark, text.decision_status("s"), s="reject") == "rejected"
    assert one(spark, text.decision_status("s"), s="later") is None
    assert one(spark, text.null_if("s", "anonymous"), s="anonymous") is None
    assert one(spark, text.preview("s", 3), s="abcdef") == "abc"
    a = one(spark, text.business_id("s", "t"), s="a", t=None)
    assert a == one(spark, text.business_id("s", "t"), s="a", t=None)
    assert a != one(spark, text.business_id("t", "s"), s="a", t=None)


TOOL_CASES = [
    ("get_order_status", '{"order_id": "A"}', []),
    ("get_order_status", "{}", ["required:order_id"]),
    ("get_order_status", '{"order_id": null}', ["type:order_id"]),
    ("get_order_status", '{"order_id": 1}', ["type:order_id"]),
    ("get_order_status", '{"order_id": "A", "x": null}', ["additionalProperties"]),
    ("get_order_status", '{"order_id": "A"', ["malformed"]),
    ("get_order_status", None, ["malformed"]),
    ("get_order_status", '"text"', ["type"]),
    ("get_order_status", "null", ["type"]),
    ("lookup", "{}", ["unknown_tool"]),
    (None, "{}", ["unknown_tool"]),
    ("process_refund", '{"order_id": "A", "amount": 0.01, "reason": "12345"}', []),
    ("process_refund", '{"order_id": "A", "amount": 5, "reason": "12345"}', []),
    ("process_refund", '{"order_id": "A", "amount": 1e3, "reason": "12345"}', []),
    ("process_refund", '{"order_id": "A", "amount": 0.009, "reason": "12345"}', ["minimum:amount"]),
    ("process_refund", '{"order_id": "A", "amount": "5", "reason": "12345"}', ["type:amount"]),
    ("process_refund", '{"order_id": "A", "amount": true, "reason": "12345"}', ["type:amount"]),
    ("process_refund", '{"order_id": "A", "amount": null, "reason": "12345"}', ["type:amount"]),
    ("process_refund", '{"order_id": "A", "amount": 5, "reason": "1234"}', ["minLength:reason"]),
    ("process_refund", json.dumps({"order_id": "A", "amount": 5, "reason": "é" * 500}), []),
    ("process_refund", json.dumps({"order_id": "A", "amount": 5, "reason": "é" * 501}), ["maxLength:reason"]),
    ("escalate_to_human", '{"issue_description": "0123456789", "priority": "low"}', []),
    ("escalate_to_human", '{"issue_description": "0123456789", "priority": "urgent"}', ["enum:priority"]),
    ("escalate_to_human", '{"priority": null}', ["required:issue_description", "type:priority", "enum:priority"]),
    ("update_customer_note", '{"note": "hello"}', []),
]


def test_tool_arguments(spark):
    df = spark.createDataFrame([(i, t, a) for i, (t, a, _) in enumerate(TOOL_CASES)], "i int, tool string, args string")
    for r in check_arguments(df, "tool", "args").collect():
        want = TOOL_CASES[r["i"]][2]
        assert r["broken"] == want, TOOL_CASES[r["i"]]
        assert r["valid"] == (not want)


def test_approval_rules(spark):
    df = spark.createDataFrame(
        [(100.0, None, None), (100.01, True, None), (None, True, ""), (5.0, True, "pending"), (5.0, None, "")],
        "amount double, required boolean, status string",
    )
    found = df.select(
        rules.needs_approval(F.col("amount")), rules.approval_pending(F.col("required"), F.col("status"))
    ).collect()
    assert [tuple(r) for r in found] == [(False, False), (True, True), (False, True), (False, False), (False, False)]
    assert one(spark, rules.approval_text(F.lit(150.0))) == (
        "Refund of $150.00 requires manager approval (threshold: $100.00)"
    )


def test_route(spark):
    def at(error, completed, tool, required, status):
        s = lambda v: F.lit(v).cast("string")
        return one(spark, rules.route(s(error), F.lit(completed), s(tool), F.lit(required), s(status)))

    assert at("e", False, "t", True, None) == "generate_response"
    assert at(None, True, "t", True, None) == "generate_response"
    assert at(None, False, None, True, None) == "generate_response"
    assert at(None, False, "t", True, None) == "approval_gate"
    assert at(None, False, "t", True, "approved") == "generate_response"
    assert at(None, False, "t", False, None) == "generate_response"


def test_replies(spark):
    schema = (
        "tool string, error string, direct string, r struct<order_id string, status string, "
        "items array<struct<name: string, price: double>>, shipping_status string, amount double, "
        "refund_id string, ticket_id string, priority string>"
    )
    blank = (None,) * 8
    rows = [
        ("get_order_status", None, None, ("O1", None, [("pen", 1.25), ("ink", 20.0)], None, None, None, None, None)),
        ("get_order_status", None, None, ("O2", "sent", None, "van", None, None, None, None)),
        ("process_refund", None, None, ("", None, None, None, 12.5, "R1", None, None)),
        ("escalate_to_human", None, None, ("", None, None, None, None, None, "T1", None)),
        ("update_customer_note", None, None, blank),
        ("other", None, None, blank),
        ("other", "boom", "kept", blank),
        (None, None, "kept", None),
        (None, None, None, None),
    ]
    df = spark.createDataFrame(rows, schema)
    got = [r[0] for r in df.select(rules.reply(F.col("error"), F.col("tool"), F.col("r"), F.col("direct"))).collect()]
    assert got == [
        "📦 Order O1 status: unknown\nItems:\n  • pen: $1.25\n  • ink: $20.00\nShipping: N/A",
        "📦 Order O2 status: sent\nItems:\n\nShipping: van",
        "✅ Refund of $12.50 processed successfully (ID: R1)",
        "🎫 Support ticket created (ID: T1) with medium priority. An agent will contact you shortly.",
        fixed.REPLY_NOTE,
        fixed.REPLY_OTHER_TOOL,
        "❌ Error: boom",
        "kept",
        fixed.REPLY_GENERIC,
    ]


def test_messages(spark):
    df = spark.createDataFrame([([("user", "hi")],), ([],)], "m array<struct<role: string, content: string>>")
    grown = df.select(nested.append_message(F.col("m"), "assistant", F.lit("yo")).alias("m"))
    assert [r["m"][-1]["content"] for r in grown.collect()] == ["yo", "yo"]
    assert df.select(nested.last_message(F.col("m"))).collect()[1][0] is None
    first = df.select(nested.with_system_message(F.col("m")).alias("m")).first()["m"]
    assert [x["role"] for x in first] == ["system", "user"]
    empty = spark.createDataFrame([(None,)], "a array<string>")
    assert empty.select(nested.array_or_empty("a")).first()[0] == []


def test_long_conversations_are_cut_and_come_back_whole(spark):
    turns = [(1, t, "user", f"m{t}") for t in range(25)] + [(2, 0, "user", "x")]
    df = spark.createDataFrame(turns, "c long, t long, role string, content string").repartition(5)
    rows = nested.assemble_conversations(df, "c", "t", "role", "content", chunk=10)
    assert sorted((r["c"], r["part"], len(r["messages"])) for r in rows.collect()) == [
        (1, 0, 10), (1, 1, 10), (1, 2, 5), (2, 0, 1),
    ]
    back = nested.explode_conversations(rows, "c")
    assert sorted(tuple(r) for r in back.collect()) == sorted(turns)


@pytest.mark.parametrize("chunk", [2, 1_000])
def test_turn_numbers_survive_gaps(spark, chunk):
    turns = [(1, t, "user", f"m{t}") for t in (0, 2, 3, 9)] + [(2, 5, "user", "x"), (2, 7, "user", "y")]
    df = spark.createDataFrame(turns, "c long, t long, role string, content string").repartition(3)
    rows = nested.assemble_conversations(df, "c", "t", "role", "content", chunk)
    assert sorted(tuple(r) for r in nested.explode_conversations(rows, "c").collect()) == sorted(turns)
    more = rows.withColumn("messages", nested.append_message(F.col("messages"), "assistant", F.lit("z")))
    added = nested.explode_conversations(more, "c").filter("content = 'z'")
    assert {(r["c"], r["turn"]) for r in added.collect()} >= {(1, 10), (2, 8)}


def test_parse_json_keeps_malformed_as_null(spark):
    assert one(spark, nested.parse_json("s").isNull(), s="{bad") is True
    assert one(spark, nested.first_call(F.from_json("s", "array<struct<a: int>>")), s="[]") is None


@pytest.mark.parametrize("seconds,le", [(0.0, 0.0), (0.1, 5.0), (5.0, 5.0), (5.01, 10.0), (10000.0, 10000.0), (10001.0, float("inf"))])
def test_buckets_include_their_upper_bound(spark, seconds, le):
    assert one(spark, metrics.bucket_bound(F.lit(seconds))) == le


def test_durations_and_tokens(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 0, 1, 500000))], "a timestamp_ntz, b timestamp_ntz")
    assert df.select(metrics.duration_seconds("a", "b")).first()[0] == 1.5
    replies = spark.createDataFrame(
        [(True, (3, 4)), (True, (None, 1)), (False, None)],
        "success boolean, usage struct<prompt_tokens: long, completion_tokens: long>",
    )
    assert tuple(metrics.token_totals(replies).first()) == (2, 1, 3, 5)


def test_r2(spark):
    def r2(pairs):
        df = spark.createDataFrame(pairs, "y double, p double")
        return df.agg(scores.r2(F.col("y"), F.col("p"))).first()[0]

    assert r2([(1.0, 1.0), (2.0, 2.0)]) == 1.0
    assert r2([(1.0, 2.0), (2.0, 1.0)]) == pytest.approx(-3.0)
    assert r2([(5.0, 5.0), (5.0, 5.0)]) == 1.0
    assert r2([(5.0, 5.0), (5.0, 6.0)]) == 0.0


def test_money_is_pythons(spark):
    import random

    r = random.Random(11)
    values = [0.0, -0.0, 0.125, 0.375, 1.005, 1.015, 2.675, 0.005, 0.015, 99.995, 999999.995, -2.5, -0.001, 1e14, 1e16, 0.01]
    values += [r.randrange(10**7) / 1000 for _ in range(3000)]
    values += [r.randrange(10**6) / 8 for _ in range(500)]
    values += [r.random() * 10 ** r.randrange(-5, 12) for _ in range(2000)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    wrong = [(r["v"], r["t"]) for r in df.select("v", text.money("v").alias("t")).collect() if r["t"] != f"{r['v']:.2f}"]
    assert wrong == []


def test_sessions_and_blank_messages(spark):
    df = spark.createDataFrame([("s1", " hi "), ("", "\n"), (None, None)], "s string, m string")
    ids = [r[0] for r in df.select(text.session_id("s", "m")).collect()]
    assert ids[0] == "s1" and len(set(ids)) == 3 and all(ids)
    kept, rejected = text.without_blanks(df, "m")
    assert [tuple(r) for r in kept.collect()] == [("s1", "hi")] and rejected.count() == 2

import json

import pytest

from millrace.plans.tool_calls import plan, run_tool_calls

SCHEMA = "session_id string, user_id string, tool string, args string, approval_status string, result string, created_at string, direct string, plan_error string"
REFUND = '{"order_id": "O1", "amount": 150.5, "reason": "broken"}'
SMALL = '{"order_id": "O1", "amount": 100.0, "reason": "broken"}'
CASES = {
    "gated": ("u", "process_refund", REFUND, None, None, None, None),
    "approved": ("u", "process_refund", REFUND, "approved", '{"refund_id": "R9"}', None, None),
    "rejected": ("u", "process_refund", REFUND, "rejected", None, None, None),
    "small": ("anonymous", "process_refund", SMALL, None, '{"refund_id": null}', None, None),
    "unanswered": ("u", "process_refund", SMALL, None, None, None, None),
    "status": ("u", "get_order_status", '{"order_id": "O2"}', None, "{}", None, None),
    "nulls": ("u", "get_order_status", '{"order_id": "O2"}', None, '{"status": null, "shipping": {"status": "van"}}', None, None),
    "note": ("u", "update_customer_note", '{"note": "hello there"}', None, None, None, None),
    "ticket": ("u", "escalate_to_human", '{"issue_description": "a long problem"}', None, '{"ticket_id": "T"}', None, None),
    "invalid": ("u", "get_order_status", '{"order_id": 5}', None, "{}", None, None),
    "direct": ("u", None, None, None, None, "just text", None),
    "failed": ("u", None, None, None, None, None, "Planning failed: unknown"),
    "nothing": ("u", None, None, None, None, None, None),
}


@pytest.fixture(scope="module")
def outcome(spark):
    rows = [(k, u, t, a, s, r, "2024-01-01", d, e) for k, (u, t, a, s, r, d, e) in CASES.items()]
    return run_tool_calls(spark.createDataFrame(rows, SCHEMA))


def test_replies(outcome):
    got = {r["session_id"]: r["response"] for r in outcome.replies.collect()}
    assert got == {
        "gated": "Refund of $150.50 requires manager approval (threshold: $100.00)",
        "approved": "✅ Refund of $150.50 processed successfully (ID: R9)",
        "rejected": "I've processed your request. How else can I help?",
        "small": "✅ Refund of $100.00 processed successfully (ID: None)",
        "unanswered": "❌ Error: Tool execution error: no result",
        "status": "📦 Order O2 status: unknown\nItems:\n\nShipping: N/A",
        "nulls": "📦 Order O2 status: None\nItems:\n\nShipping: van",
        "note": "✅ Note added to your account.",
        "ticket": "🎫 Support ticket created (ID: T) with medium priority. An agent will contact you shortly.",
        "invalid": "❌ Error: Invalid tool arguments for get_order_status: type:order_id",
        "direct": "just text",
        "failed": "❌ Error: Planning failed: unknown",
        "nothing": "I've processed your request. How else can I help?",
    }


def test_approvals_are_only_for_gated_calls(outcome):
    rows = outcome.approvals.collect()
    assert [(r["session_id"], r["status"], r["tool_args"]) for r in rows] == [("gated", "pending", REFUND)]


def test_audit_is_only_for_executed_calls(outcome):
    rows = {r["session_id"]: r for r in outcome.audit.collect()}
    assert set(rows) == {"approved", "small", "status", "nulls", "note", "ticket"}
    assert rows["small"]["user_id"] is None and rows["note"]["user_id"] == "u"
    assert rows["approved"]["action"] == "tool_executed_process_refund"
    assert json.loads(rows["approved"]["details"]) == {
        "tool": "process_refund", "args": json.loads(REFUND),
        "result": {"success": True, "refund_id": "R9", "amount": 150.5, "status": "processed"},
    }
    results = {k: json.loads(r["details"])["result"] for k, r in rows.items() if k != "approved"}
    assert results == {
        "small": {"success": True, "refund_id": None, "amount": 100.0, "status": "processed"},
        "status": {"success": True, "order_id": "O2", "status": "unknown", "items": [], "shipping": {}},
        "nulls": {"success": True, "order_id": "O2", "status": None, "items": [], "shipping": {"status": "van"}},
        "note": {"success": True, "note_added": True},
        "ticket": {"success": True, "ticket_id": "T", "priority": "medium"},
    }
    assert '"amount": 100.0' in rows["small"]["details"]


def test_planning(spark):
    call = '[{"function": {"name": "t1", "arguments": "{}"}}, {"function": {"name": "t2", "arguments": "{}"}}]'
    rows = [
        ("a", True, None, "ignored", call), ("b", True, None, " hi\n", "[]"), ("c", True, None, " ", None),
        ("d", False, "boom", "x", call), ("e", False, None, None, None), ("f", True, None, None, None),
    ]
    df = spark.createDataFrame(rows, "id string, success boolean, error string, content string, tool_calls string")
    got = {r["id"]: (r["tool"], r["args"], r["direct"], r["plan_error"]) for r in plan(df).collect()}
    assert got == {
        "a": ("t1", "{}", None, None), "b": (None, None, "hi", None), "c": (None,) * 4,
        "d": (None, None, None, "Planning failed: boom"), "e": (None, None, None, "Planning failed: unknown"),
        "f": (None,) * 4,
    }

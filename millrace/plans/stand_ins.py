"""The given tables seen as the service's tables, with the same views in SQL.

Orders stand in for approvals and tool calls, customers for users, events for
decisions, audit rows and request metrics, conversation turns for messages.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOOLS = {
    "1-URGENT": "process_refund",
    "2-HIGH": "get_order_status",
    "3-MEDIUM": "escalate_to_human",
    "4-NOT SPECIFIED": "update_customer_note",
    "5-LOW": "lookup_weather",
}

# Argument text by tool and order status: one good call each, and the ways a
# call goes wrong.  {k} is the order key, {p} its price.
ARGUMENTS = {
    ("1-URGENT", "P"): '{"order_id": "ORD-{k}", "amount": {p}, "reason": "arrived broken"}',
    ("1-URGENT", "F"): '{"order_id": "ORD-{k}", "amount": "{p}", "reason": "arrived broken"}',
    ("1-URGENT", "O"): '{"order_id": "ORD-{k}", "amount": {p}, "reason": "no"}',
    ("2-HIGH", "P"): '{"order_id": "ORD-{k}"}',
    ("2-HIGH", "F"): '{"order_id": "ORD-{k}", "verbose": true}',
    ("2-HIGH", "O"): '{"order_id": {k}}',
    ("3-MEDIUM", "P"): '{"issue_description": "Order {k} is late", "priority": "high"}',
    ("3-MEDIUM", "F"): '{"issue_description": "Order {k} is late", "priority": "urgent"}',
    ("3-MEDIUM", "O"): '{"priority": null}',
    ("4-NOT SPECIFIED", "P"): '{"note": "Asked about order {k}"}',
    ("4-NOT SPECIFIED", "F"): '{"note": "Asked about order {k}',
    ("4-NOT SPECIFIED", "O"): "[{k}]",
    ("5-LOW", "P"): "{}",
    ("5-LOW", "F"): "{}",
    ("5-LOW", "O"): "{}",
}

RESULTS = {
    "process_refund": '{"refund_id": "RF-{k}"}',
    "get_order_status": (
        '{"status": "shipped", "items": [{"name": "order total", "price": {p}}], '
        '"shipping": {"status": "in transit"}}'
    ),
    "escalate_to_human": '{"ticket_id": "T-{k}"}',
    "update_customer_note": "{}",
    "lookup_weather": "{}",
}


def _sql_case(pairs, text_type):
    """CASE over (condition, template) in SQL that every engine reads."""
    whens = "".join(
        f" WHEN {test} THEN replace(replace('{text}', '{{k}}', CAST(o_orderkey AS {text_type})), "
        f"'{{p}}', CAST(o_totalprice AS {text_type}))"
        for test, text in pairs
    )
    return f"CASE{whens} END"


def _cases(text_type):
    """Tool, arguments and result of an order."""
    by_priority = [(f"o_orderpriority = '{p}'", t) for p, t in TOOLS.items()]
    by_status = [
        (f"o_orderpriority = '{p}' AND o_orderstatus = '{s}'", t) for (p, s), t in ARGUMENTS.items()
    ]
    results = [(test, RESULTS[tool]) for test, tool in by_priority]
    return [_sql_case(pairs, text_type) for pairs in (by_priority, by_status, results)]


# Some refunds come back after a decision on them.
_SETTLED = (
    "CASE WHEN o_orderpriority = '1-URGENT' AND o_orderkey % 4 = 1 THEN 'approved' "
    "WHEN o_orderpriority = '1-URGENT' AND o_orderkey % 4 = 2 THEN 'rejected' END"
)


def tool_calls(orders: DataFrame, *kept) -> DataFrame:
    """One tool call per order; ``kept`` names order columns to carry along."""
    tool, arguments, result = (F.expr(case) for case in _cases("STRING"))
    return orders.select(
        F.col("o_orderkey").cast("string").alias("session_id"),
        F.when(F.col("o_custkey") == 0, "anonymous")
        .otherwise(F.col("o_custkey").cast("string")).alias("user_id"),
        tool.alias("tool"),
        arguments.alias("args"),
        F.expr(_SETTLED).alias("approval_status"),
        result.alias("result"),
        F.col("o_orderdate").alias("created_at"),
        *kept,
    )


_TOOL, _ARGUMENTS, _RESULT = _cases("VARCHAR")

TOOL_CALLS_SQL = f"""
calls AS (
  SELECT o_orderkey::VARCHAR AS session_id,
         CASE WHEN o_custkey = 0 THEN 'anonymous' ELSE o_custkey::VARCHAR END AS user_id,
         {_TOOL} AS tool, {_ARGUMENTS} AS args, {_RESULT} AS result, {_SETTLED} AS approval_status,
         o_orderdate AS created_at
  FROM orders
)
"""


def approvals(orders: DataFrame) -> DataFrame:
    """One approval per order; status P is pending."""
    status = (
        F.when(F.col("o_orderstatus") == "P", "pending")
        .when(F.col("o_orderstatus") == "F", "approved")
        .otherwise("rejected")
    )
    return orders.select(
        F.col("o_orderkey").alias("id"),
        F.concat(F.lit("s-"), F.col("o_orderkey")).alias("session_id"),
        F.col("o_custkey").alias("user_id"),
        F.lit("process_refund").alias("tool_name"),
        F.concat(F.lit('{"amount": '), F.col("o_totalprice"), F.lit("}")).alias("tool_args"),
        F.concat(F.lit("refund of a "), F.col("o_orderpriority"), F.lit(" order")).alias("reason"),
        status.alias("status"),
        F.lit(None).cast("string").alias("resolved_by"),
        F.lit(None).cast("timestamp_ntz").alias("resolved_at"),
        F.col("o_orderdate").alias("created_at"),
    )


APPROVALS_SQL = """
approvals AS (
  SELECT o_orderkey AS id, 's-' || o_orderkey AS session_id, o_custkey AS user_id,
         'process_refund' AS tool_name, '{"amount": ' || o_totalprice || '}' AS tool_args,
         'refund of a ' || o_orderpriority || ' order' AS reason,
         CASE o_orderstatus WHEN 'P' THEN 'pending' WHEN 'F' THEN 'approved' ELSE 'rejected' END AS status,
         o_orderdate AS created_at
  FROM orders
)
"""


def users(customers: DataFrame) -> DataFrame:
    """One user per customer."""
    return customers.select(
        F.col("c_custkey").alias("id"),
        F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@example.com")).alias("email"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("provider"),
    )


USERS_SQL = """
users AS (
  SELECT c_custkey AS id, lower(replace(c_name, '#', '.')) || '@example.com' AS email,
         c_name AS name, c_mktsegment AS provider
  FROM customer
)
"""

ACTIONS = {"purchase": "approve", "click": "approve", "signup": "reject", "view": "postpone", "error": "approve"}


def decisions(events: DataFrame) -> DataFrame:
    """One decision per event; two share an approval, errors name unknown ones."""
    action = None
    for kind, name in ACTIONS.items():
        match = F.col("event_type") == kind
        action = F.when(match, name) if action is None else action.when(match, name)
    approval = F.when(F.col("event_type") == "error", -F.col("event_id") - 1).otherwise(
        F.floor(F.col("event_id") / 2)
    )
    return events.select(
        F.col("event_id").alias("decision_id"),
        approval.cast("long").alias("approval_id"),
        action.alias("action"),
        F.concat(F.lit("u-"), F.col("user_id")).alias("approver"),
        F.concat(F.lit("because of "), F.col("event_type")).alias("reason"),
        F.col("ts").alias("decided_at"),
    )


DECISIONS_SQL = """
decisions AS (
  SELECT event_id AS decision_id,
         CASE WHEN event_type = 'error' THEN -event_id - 1 ELSE event_id // 2 END AS approval_id,
         CASE event_type WHEN 'purchase' THEN 'approve' WHEN 'click' THEN 'approve'
              WHEN 'signup' THEN 'reject' WHEN 'view' THEN 'postpone' ELSE 'approve' END AS action,
         'u-' || user_id AS approver, 'because of ' || event_type AS reason, ts AS decided_at
  FROM events
),
first_decision AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY approval_id ORDER BY decided_at, decision_id) AS rn
    FROM decisions WHERE action IN ('approve', 'reject')
  ) WHERE rn = 1
)
"""


def request_metrics(events: DataFrame) -> DataFrame:
    """Request events: status from the outcome, value as duration."""
    status = F.when(F.col("event_type") == "error", "error").otherwise("success")
    return events.select(
        "event_id", "ts", "user_id", status.alias("status"),
        F.when(F.col("event_type") == "error", "agent_error").alias("error_type"),
        F.col("value").alias("seconds"),
    )


REQUESTS_SQL = """
requests AS (
  SELECT event_id, ts, user_id,
         CASE WHEN event_type = 'error' THEN 'error' ELSE 'success' END AS status,
         CASE WHEN event_type = 'error' THEN 'agent_error' END AS error_type, value AS seconds
  FROM events
)
"""


def audit_logs(events: DataFrame) -> DataFrame:
    """Audit rows: a session per user."""
    return events.select(
        F.col("event_id").alias("id"),
        F.col("ts").alias("timestamp"),
        "user_id",
        F.col("user_id").alias("session_id"),
        F.concat(F.lit("tool_executed_"), F.col("event_type")).alias("action"),
        F.col("props").alias("details"),
    )

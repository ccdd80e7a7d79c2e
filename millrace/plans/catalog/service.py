"""Queries on approvals, tool calls, conversations, audit rows and inference."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import nested, rules, text
from millrace.functions.json_rules import check_arguments
from millrace.operators import inference, joins, metrics, tables
from millrace.plans import stand_ins, tool_calls
from millrace.plans.catalog.registry import query, rounded, table, time_text
from millrace.schemas import USERS
from millrace.session import fresh_path, materialise
from millrace.sources import snapshots

ISO_SQL = "strftime({c}, '%Y-%m-%dT%H:%M:%S') || '+00:00'"


def _approvals(spark, directory):
    return stand_ins.approvals(table(spark, directory, "orders"))


def _users(spark, directory):
    return stand_ins.users(table(spark, directory, "customer"))


@query(
    "pending_approvals",
    f"""
    WITH {stand_ins.APPROVALS_SQL}, {stand_ins.USERS_SQL}
    SELECT a.id, a.session_id, a.tool_name, a.tool_args, a.reason,
           {ISO_SQL.format(c="a.created_at")} AS created_at,
           u.email AS requester_email, u.name AS requester_name
    FROM approvals a JOIN users u ON a.user_id = u.id
    WHERE a.status = 'pending' ORDER BY a.created_at, a.id
    """,
)
def pending_approvals(spark, directory):
    """Pending approvals with their requester, oldest first."""
    waiting = joins.pending_approvals(_approvals(spark, directory), _users(spark, directory))
    return waiting.withColumn("created_at", text.iso_time("created_at"))


@query(
    "resolve_approvals",
    f"""
    WITH {stand_ins.APPROVALS_SQL}, {stand_ins.DECISIONS_SQL}
    SELECT a.id,
           CASE WHEN a.status = 'pending' AND d.action IS NOT NULL THEN d.reason ELSE a.reason END AS reason,
           CASE WHEN a.status = 'pending' AND d.action IS NOT NULL
                THEN CASE d.action WHEN 'approve' THEN 'approved' ELSE 'rejected' END ELSE a.status END AS status,
           CASE WHEN a.status = 'pending' AND d.action IS NOT NULL THEN d.approver ELSE '' END AS resolved_by,
           CASE WHEN a.status = 'pending' AND d.action IS NOT NULL
                THEN strftime(d.decided_at, '%Y-%m-%d %H:%M:%S.%f') ELSE '' END AS resolved_at,
           CASE WHEN a.status = 'pending' AND d.action IS NOT NULL THEN d.reason ELSE '' END AS decision_reason
    FROM approvals a LEFT JOIN first_decision d ON a.id = d.approval_id
    """,
)
def resolve_approvals(spark, directory):
    """Approvals after their first valid decision."""
    decided = tables.resolve_approvals(
        _approvals(spark, directory), stand_ins.decisions(table(spark, directory, "events"))
    )
    blank = F.lit("")
    return decided.select(
        "id", "reason", "status",
        F.coalesce("resolved_by", blank).alias("resolved_by"),
        F.coalesce(time_text("resolved_at"), blank).alias("resolved_at"),
        F.coalesce("decision_reason", blank).alias("decision_reason"),
    )


@query(
    "decision_outcomes",
    f"""
    WITH {stand_ins.APPROVALS_SQL}, {stand_ins.DECISIONS_SQL}
    SELECT d.decision_id, d.approval_id,
           CASE WHEN d.action NOT IN ('approve', 'reject') THEN 'invalid'
                WHEN f.decision_id = d.decision_id AND a.status = 'pending' THEN 'applied'
                ELSE 'not_found' END AS outcome
    FROM decisions d
    LEFT JOIN first_decision f ON d.approval_id = f.approval_id
    LEFT JOIN approvals a ON d.approval_id = a.id
    """,
)
def decision_outcomes(spark, directory):
    """What became of each decision."""
    outcomes = tables.decision_outcomes(
        _approvals(spark, directory), stand_ins.decisions(table(spark, directory, "events"))
    )
    return outcomes.select("decision_id", "approval_id", "outcome")


@query(
    "cascade_delete",
    """
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders
    WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)
    """,
)
def cascade_delete(spark, directory):
    """Orders left after the customers in debt are deleted."""
    gone = table(spark, directory, "customer").filter("c_acctbal < 0")
    left = joins.cascade_delete(table(spark, directory, "orders"), "o_custkey", gone, "c_custkey")
    return left.select("o_orderkey", "o_custkey", "o_totalprice")


@query(
    "update_delete",
    """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'updated' ELSE o_orderstatus END AS o_orderstatus,
           o_totalprice
    FROM orders WHERE o_orderpriority <> '5-LOW'
    """,
)
def update_delete(spark, directory):
    """An update by predicate, then a delete by predicate, each committed as a snapshot."""
    root = fresh_path(spark, "orders")
    snapshots.append(table(spark, directory, "orders"), root)
    snapshots.update_rows(spark, root, F.col("o_orderstatus") == "P", {"o_orderstatus": F.lit("updated")})
    snapshots.delete_rows(spark, root, F.col("o_orderpriority") == "5-LOW")
    return snapshots.read(spark, root).select("o_orderkey", "o_orderstatus", "o_totalprice")


NEW_USERS = T.StructType(
    [f for f in USERS if f.name != "updated_at"] + [T.StructField("known_id", T.StringType())]
)


@query(
    "insert_defaults",
    f"""
    WITH {stand_ins.USERS_SQL}
    SELECT email, provider, name, 0 AS orgs,
           CASE WHEN email = 'customer.000000000@example.com' THEN '' ELSE id::VARCHAR END AS known_id
    FROM users
    """,
)
def insert_defaults(spark, directory):
    """Users inserted into a new table; ids and times come from defaults."""
    path = fresh_path(spark, "users")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    tables.create_if_absent(spark, name, NEW_USERS, path)
    tables.create_if_absent(spark, name, NEW_USERS, path)
    people = _users(spark, directory).withColumn(
        "known_id", F.when(F.col("id") == 0, "anonymous").otherwise(F.col("id").cast("string"))
    ).drop("id")
    filled = tables.with_defaults(
        people.withColumn("known_id", text.null_if("known_id", "anonymous")),
        {
            "id": text.business_id("email"),
            "allowed_orgs": F.array().cast("array<string>"),
            "created_at": F.current_timestamp(),
        },
    )
    tables.insert(filled, name)
    stored = spark.read.schema(spark.table(name).schema).parquet(path)
    complete = stored.filter("id IS NOT NULL AND created_at IS NOT NULL")
    return complete.select(
        "email", "provider", "name", F.size("allowed_orgs").alias("orgs"),
        F.coalesce("known_id", F.lit("")).alias("known_id"),
    )


@query(
    "approval_rule_route",
    """
    SELECT o_orderkey, o_orderstatus = 'O' OR o_totalprice > 250000 AS required,
           (o_orderstatus = 'O' OR o_totalprice > 250000) AND o_orderstatus <> 'F' AS pending,
           CASE WHEN o_orderpriority = '5-LOW' THEN 'generate_response'
                WHEN (o_orderstatus = 'O' OR o_totalprice > 250000) AND o_orderstatus <> 'F' THEN 'approval_gate'
                ELSE 'generate_response' END AS route,
           CASE WHEN o_totalprice > 250000
                THEN printf('Refund of $%.2f requires manager approval (threshold: $250000.00)', o_totalprice)
                ELSE 'processed' END AS message
    FROM orders
    """,
)
def approval_rule_route(spark, directory):
    """Threshold, pending flag and next step of each call."""
    orders = table(spark, directory, "orders")
    amount, limit = F.col("o_totalprice"), 250_000.0
    required = (F.col("o_orderstatus") == "O") | rules.needs_approval(amount, limit)
    status = F.when(F.col("o_orderstatus") == "F", "approved")
    error = F.when(F.col("o_orderpriority") == "5-LOW", "no such tool")
    route = rules.route(error, F.lit(False), F.lit("process_refund"), required, status)
    return orders.select(
        "o_orderkey",
        required.alias("required"),
        rules.approval_pending(required, status).alias("pending"),
        route.alias("route"),
        F.when(rules.needs_approval(amount, limit), rules.approval_text(amount, limit))
        .otherwise("processed").alias("message"),
    )


def _rule_sql(name, test):
    return f"CASE WHEN coalesce({test}, false) THEN '{name}' END"


def _is(k, *kinds):
    listed = ", ".join(f"'{kind}'" for kind in kinds)
    return f"json_type(j, '$.{k}') IN ({listed})"


_TEXT, _NUMBER = ("VARCHAR",), ("BIGINT", "UBIGINT", "DOUBLE")


def _string_rules(k, low=None, high=None):
    out = [_rule_sql(f"type:{k}", f"json_type(j, '$.{k}') IS NOT NULL AND NOT {_is(k, *_TEXT)}")]
    if low:
        out.append(_rule_sql(f"minLength:{k}", f"{_is(k, *_TEXT)} AND length(j->>'$.{k}') < {low}"))
    if high:
        out.append(_rule_sql(f"maxLength:{k}", f"{_is(k, *_TEXT)} AND length(j->>'$.{k}') > {high}"))
    return out


def _tool_sql(required, body, keys):
    listed = ", ".join(f"'{k}'" for k in keys)
    parts = [_rule_sql(f"required:{k}", f"json_type(j, '$.{k}') IS NULL") for k in required]
    parts += body
    parts.append(
        _rule_sql("additionalProperties", f"len(list_filter(json_keys(j), lambda k: k NOT IN ({listed}))) > 0")
    )
    return f"concat_ws(',', {', '.join(parts)})"


RULES_SQL = f"""
rules AS (
  SELECT *, CASE
    WHEN NOT json_valid(args) THEN 'malformed'
    WHEN json_type(j) <> 'OBJECT' THEN 'type'
    WHEN tool = 'get_order_status' THEN {_tool_sql(["order_id"], _string_rules("order_id"), ["order_id"])}
    WHEN tool = 'process_refund' THEN {_tool_sql(
        ["order_id", "amount", "reason"],
        [*_string_rules("order_id"),
         _rule_sql("type:amount", f"json_type(j, '$.amount') IS NOT NULL AND NOT {_is('amount', *_NUMBER)}"),
         _rule_sql("minimum:amount", f"{_is('amount', *_NUMBER)} AND (j->>'$.amount')::DOUBLE < 0.01"),
         *_string_rules("reason", 5, 500)],
        ["order_id", "amount", "reason"])}
    WHEN tool = 'escalate_to_human' THEN {_tool_sql(
        ["issue_description"],
        [*_string_rules("issue_description", 10, 2000), *_string_rules("priority"),
         _rule_sql("enum:priority", "json_type(j, '$.priority') IS NOT NULL AND NOT (" + _is("priority", *_TEXT)
                   + " AND (j->>'$.priority') IN ('low', 'medium', 'high', 'critical'))")],
        ["issue_description", "priority"])}
    WHEN tool = 'update_customer_note' THEN {_tool_sql(["note"], _string_rules("note", 5, 1000), ["note"])}
    ELSE 'unknown_tool' END AS broken
  FROM (SELECT *, CASE WHEN json_valid(args) THEN args::JSON END AS j FROM calls)
)
"""


def _calls(spark, directory):
    """The calls as a table: their texts are made up once, not at each use of a column."""
    return materialise(stand_ins.tool_calls(table(spark, directory, "orders")), "calls")[0]


@query(
    "tool_args_rules",
    f"""
    WITH {stand_ins.TOOL_CALLS_SQL}, {RULES_SQL}
    SELECT session_id, tool, broken, broken = '' AS valid,
           CASE WHEN json_type(j) = 'OBJECT' THEN array_to_string(list_sort(json_keys(j)), ',') ELSE '' END AS arg_keys,
           CASE WHEN json_type(j) = 'OBJECT' THEN coalesce(j->>'$.priority', 'medium') ELSE 'medium' END AS priority
    FROM rules
    """,
)
def tool_args_rules(spark, directory):
    """Which argument rules each call breaks."""
    checked = check_arguments(_calls(spark, directory), "tool", "args")
    keys = F.array_join(F.sort_array("arg_keys"), ",")
    return checked.select(
        "session_id", "tool", F.array_join("broken", ",").alias("broken"), "valid",
        F.coalesce(keys, F.lit("")).alias("arg_keys"),
        rules.with_default(F.get_json_object("args", "$.priority"), "medium").alias("priority"),
    )


LIMIT = 250_000.0

DECIDED_SQL = f"""
{RULES_SQL},
decided AS (
  SELECT *, over AND approval_status IS NULL AS gated, coalesce(over AND approval_status = 'rejected', false) AS refused
  FROM (
    SELECT *, broken = '' AND tool = 'process_refund' AND coalesce((j->>'$.amount')::DOUBLE > {LIMIT}, false) AS over
    FROM rules
  )
)
"""


@query(
    "tool_calls",
    f"""
    WITH {stand_ins.TOOL_CALLS_SQL}, {DECIDED_SQL}
    SELECT session_id, tool AS tool_used, CASE WHEN gated THEN 'approval_gate' ELSE 'generate_response' END AS route,
      CASE WHEN broken <> '' THEN '❌ Error: Invalid tool arguments for ' || tool || ': ' || broken
           WHEN gated THEN printf('Refund of $%.2f requires manager approval (threshold: $250000.00)', (j->>'$.amount')::DOUBLE)
           WHEN refused THEN 'I''ve processed your request. How else can I help?'
           WHEN tool = 'get_order_status' THEN '📦 Order ' || (j->>'$.order_id') || ' status: ' || (result->>'$.status')
                || chr(10) || 'Items:' || chr(10) || '  • ' || (result->>'$.items[0].name') || ': $'
                || printf('%.2f', (result->>'$.items[0].price')::DOUBLE) || chr(10) || 'Shipping: '
                || (result->>'$.shipping.status')
           WHEN tool = 'process_refund' THEN printf('✅ Refund of $%.2f processed successfully (ID: %s)',
                (j->>'$.amount')::DOUBLE, result->>'$.refund_id')
           WHEN tool = 'escalate_to_human' THEN printf('🎫 Support ticket created (ID: %s) with %s priority. An agent will contact you shortly.',
                result->>'$.ticket_id', coalesce(j->>'$.priority', 'medium'))
           ELSE '✅ Note added to your account.' END AS response
    FROM decided
    """,
)
def run_tool_calls(spark, directory):
    """Route and reply of every call."""
    return tool_calls.reply_rows(tool_calls.decide(_calls(spark, directory), LIMIT))


PLANNED_SQL = """
planned AS (
  SELECT *, o_orderstatus <> 'O' AS success FROM calls JOIN orders ON session_id = o_orderkey::VARCHAR
)
"""


@query(
    "plan_actions",
    f"""
    WITH {stand_ins.TOOL_CALLS_SQL}, {PLANNED_SQL}
    SELECT session_id,
           CASE WHEN success AND tool <> 'lookup_weather' THEN tool ELSE '' END AS tool,
           CASE WHEN success AND tool <> 'lookup_weather' THEN args ELSE '' END AS args,
           CASE WHEN success AND tool = 'lookup_weather' AND o_orderstatus = 'P' THEN 'Sunny in ' || o_custkey ELSE '' END AS direct,
           CASE WHEN success THEN '' ELSE 'Planning failed: unknown' END AS plan_error
    FROM planned
    """,
)
def plan_actions(spark, directory):
    """First tool call, direct reply or failure out of each model reply."""
    orders = table(spark, directory, "orders")
    calls = stand_ins.tool_calls(orders, "o_orderstatus", "o_custkey")
    wanted = F.col("tool") != "lookup_weather"
    call = F.struct(F.struct(F.col("tool").alias("name"), F.col("args").alias("arguments")).alias("function"))
    replies = calls.select(
        "session_id",
        (F.col("o_orderstatus") != "O").alias("success"),
        F.lit(None).cast("string").alias("error"),
        F.when(F.col("o_orderstatus") == "P", F.concat(F.lit(" \n Sunny in "), "o_custkey", F.lit("\t"))).alias("content"),
        F.when(wanted, F.to_json(F.array(call, call))).otherwise("[]").alias("tool_calls"),
    )
    planned = tool_calls.plan(replies)
    return planned.select(
        "session_id", *[F.coalesce(c, F.lit("")).alias(c) for c in ("tool", "args", "direct", "plan_error")]
    )


@query(
    "approval_requests",
    f"""
    WITH {stand_ins.TOOL_CALLS_SQL}, {DECIDED_SQL}
    SELECT session_id, user_id, tool AS tool_name, args AS tool_args,
           printf('Refund of $%.2f requires manager approval (threshold: $250000.00)', (j->>'$.amount')::DOUBLE) AS reason,
           'pending' AS status, strftime(created_at, '%Y-%m-%d %H:%M:%S.%f') AS created_at
    FROM decided WHERE gated
    """,
)
def approval_requests(spark, directory):
    """Pending approvals that the calls give rise to."""
    rows = tool_calls.run_tool_calls(_calls(spark, directory), LIMIT).approvals
    return rows.drop("id").withColumn("created_at", time_text("created_at"))


@query(
    "audit_append",
    f"""
    WITH {stand_ins.TOOL_CALLS_SQL}, {DECIDED_SQL}
    SELECT session_id, CASE WHEN user_id = 'anonymous' THEN '' ELSE user_id END AS user_id,
           'tool_executed_' || tool AS action,
           '{{"tool":"' || tool || '","args":' || args || ',"result":{{"success":true,' || CASE tool
             WHEN 'get_order_status' THEN '"order_id":' || (j->'$.order_id') || ',"status":' || (result->'$.status')
                  || ',"items":' || (result->'$.items') || ',"shipping":' || (result->'$.shipping')
             WHEN 'process_refund' THEN '"refund_id":' || (result->'$.refund_id') || ',"amount":' || (j->'$.amount')
                  || ',"status":"processed"'
             WHEN 'escalate_to_human' THEN '"ticket_id":' || (result->'$.ticket_id') || ',"priority":'
                  || coalesce(j->'$.priority', '"medium"')
             ELSE '"note_added":true' END || '}}}}' AS details
    FROM decided WHERE broken = '' AND NOT gated AND NOT refused
    """,
)
def audit_append(spark, directory):
    """Audit rows of executed calls, appended to a table and read back."""
    rows = tool_calls.run_tool_calls(_calls(spark, directory), LIMIT).audit
    path = fresh_path(spark, "audit")
    rows.write.mode("append").parquet(path)
    stored = spark.read.schema(rows.schema).parquet(path)
    return stored.select("session_id", F.coalesce("user_id", F.lit("")).alias("user_id"), "action", "details")


@query(
    "render_responses",
    """
    WITH li AS (
      SELECT l_orderkey, sum(l_extendedprice) FILTER (l_returnflag = 'A') AS a,
             sum(l_extendedprice) FILTER (l_returnflag = 'N') AS n, sum(l_extendedprice) FILTER (l_returnflag = 'R') AS r
      FROM lineitem GROUP BY l_orderkey
    )
    SELECT o_orderkey, '📦 Order ' || o_orderkey || ' status: ' || CASE WHEN o_orderstatus = 'O' THEN 'unknown' ELSE o_orderstatus END
           || chr(10) || 'Items:' || chr(10)
           || concat_ws(chr(10), CASE WHEN a IS NOT NULL THEN printf('  • A: $%.2f', round(a, 2)) END,
                                 CASE WHEN n IS NOT NULL THEN printf('  • N: $%.2f', round(n, 2)) END,
                                 CASE WHEN r IS NOT NULL THEN printf('  • R: $%.2f', round(r, 2)) END)
           || chr(10) || 'Shipping: ' || CASE WHEN o_orderpriority = '5-LOW' THEN 'N/A' ELSE o_orderpriority END AS response
    FROM orders LEFT JOIN li ON l_orderkey = o_orderkey
    """,
)
def render_responses(spark, directory):
    """Order replies; the items are the value per return flag."""
    flags = ["A", "N", "R"]
    price = {f: F.sum(F.when(F.col("l_returnflag") == f, F.col("l_extendedprice"))) for f in flags}
    lines = table(spark, directory, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        *[rounded(p, 2).alias(f) for f, p in price.items()]
    )
    items = F.array_compact(
        F.array(*[F.when(F.col(f).isNotNull(), F.struct(F.lit(f).alias("name"), F.col(f).alias("price"))) for f in flags])
    )
    joined = table(spark, directory, "orders").join(lines, "o_orderkey", "left")
    result = F.struct(
        F.col("o_orderkey").cast("string").alias("order_id"),
        text.null_if("o_orderstatus", "O").alias("status"),
        items.alias("items"),
        text.null_if("o_orderpriority", "5-LOW").alias("shipping_status"),
        F.lit(None).cast("double").alias("amount"),
        *[F.lit(None).cast("string").alias(n) for n in ("refund_id", "ticket_id", "priority")],
    )
    reply = rules.reply(F.lit(None).cast("string"), F.lit("get_order_status"), F.col("result"))
    return joined.withColumn("result", result).select("o_orderkey", reply.alias("response"))


STRIP_SQL = r"regexp_replace(text, '^[\s\p{Z}\x1c-\x1f\x85]+|[\s\p{Z}\x1c-\x1f\x85]+$', '', 'g')"


@query(
    "conversation_assembly",
    f"""
    WITH clean AS (SELECT conv_id, turn, role, {STRIP_SQL} AS text FROM conversations),
    kept AS (SELECT * FROM clean WHERE length(text) > 0)
    SELECT conv_id, turn // 4 AS part, count(*) + 1 AS n_messages, 'system' AS first_role,
           max_by(role, turn) AS last_role, md5(string_agg(role || ': ' || text, chr(10) ORDER BY turn)) AS transcript,
           max_by(substr(text, 1, 50), turn) AS last_preview
    FROM kept GROUP BY conv_id, turn // 4
    """,
)
def conversation_assembly(spark, directory):
    """Messages in order, four turn numbers to a row, system prompt in front."""
    kept, _ = text.without_blanks(table(spark, directory, "conversations"), "text")
    rows = nested.assemble_conversations(kept, "conv_id", "turn", "role", "text", chunk=4)
    prompted = nested.with_system_message(F.col("messages"))
    last = nested.last_message(F.col("messages"))
    transcript = F.array_join(
        F.transform("messages", lambda m: F.concat(m["role"], F.lit(": "), m["content"])), "\n"
    )
    return rows.select(
        "conv_id", "part",
        F.size(prompted).cast("long").alias("n_messages"),
        prompted[0]["role"].alias("first_role"),
        last["role"].alias("last_role"),
        F.md5(transcript).alias("transcript"),
        text.preview(last["content"], 50).alias("last_preview"),
    )


@query(
    "conversation_turns",
    f"""
    WITH kept AS (
      SELECT conv_id, (2 * turn + 5)::BIGINT AS turn, role, {STRIP_SQL} AS text FROM conversations
      WHERE role <> 'system' AND length({STRIP_SQL}) > 0
    )
    SELECT * FROM kept
    UNION ALL
    SELECT conv_id, max(turn) + 1, 'assistant', 'closed' FROM kept GROUP BY conv_id
    """,
)
def conversation_turns(spark, directory):
    """Assembled conversations with a message appended, taken apart again.

    Turn numbers have gaps and system turns are blank, so positions are not turns.
    """
    turns = table(spark, directory, "conversations").withColumns(
        {
            "turn": (2 * F.col("turn") + 5).cast("long"),
            "text": F.when(F.col("role") == "system", " \n").otherwise(F.col("text")),
        }
    )
    kept, _ = text.without_blanks(turns, "text")
    rows = nested.assemble_conversations(kept, "conv_id", "turn", "role", "text", chunk=6)
    last = rows.groupBy("conv_id").agg(F.max("part").alias("last"))
    closed = rows.join(last, "conv_id").withColumn(
        "messages",
        F.when(
            F.col("part") == F.col("last"),
            nested.append_message(F.col("messages"), "assistant", F.lit("closed")),
        ).otherwise(F.col("messages")),
    )
    return nested.explode_conversations(closed, "conv_id").select(
        "conv_id", F.col("turn").cast("long").alias("turn"), "role", F.col("content").alias("text")
    )


@query(
    "latest_audit",
    """
    SELECT event_id AS id, user_id, 'tool_executed_' || event_type AS action FROM events
    ORDER BY ts DESC, event_id DESC LIMIT 100
    """,
)
def latest_audit(spark, directory):
    """The hundred newest audit rows."""
    logs = stand_ins.audit_logs(table(spark, directory, "events"))
    return tables.latest(logs, "timestamp", "id", 100).select("id", "user_id", "action")


@query(
    "session_audit",
    """
    SELECT event_id AS id, 'tool_executed_' || event_type AS action, props AS details FROM events
    WHERE user_id = 3
    """,
)
def session_audit(spark, directory):
    """All audit rows of one session."""
    logs = stand_ins.audit_logs(table(spark, directory, "events"))
    return tables.of_session(logs, 3).select("id", "action", "details")


@query(
    "mask_credentials",
    r"""
    SELECT c_custkey, regexp_replace('postgresql://u' || c_custkey || ':pw-' || c_name || '@db-' || c_nationkey
             || ':5432/app?copy=a:b@c', '^(.*?):[^:@]+@', '\1:*****@') AS masked
    FROM customer
    """,
)
def mask_credentials(spark, directory):
    """Connection strings without their secret."""
    uri = F.concat(
        F.lit("postgresql://u"), "c_custkey", F.lit(":pw-"), "c_name", F.lit("@db-"), "c_nationkey",
        F.lit(":5432/app?copy=a:b@c"),
    )
    return table(spark, directory, "customer").select("c_custkey", text.mask_credentials(uri).alias("masked"))


@query(
    "json_values",
    """
    SELECT event_id, array_to_string(json_keys(props), ',') AS prop_keys, (props->>'$.k')::BIGINT AS k,
           '{"id":' || event_id || ',"kind":"' || event_type || '"}' AS rendered
    FROM events
    """,
)
def json_values(spark, directory):
    """A JSON column parsed, its keys, and a JSON column rendered."""
    parsed = table(spark, directory, "events").withColumn("p", nested.parse_json(F.col("props"), "k long"))
    return parsed.select(
        "event_id",
        F.array_join(nested.argument_keys("props"), ",").alias("prop_keys"),
        F.col("p.k").alias("k"),
        nested.render_json(F.col("event_id").alias("id"), F.col("event_type").alias("kind")).alias("rendered"),
    )


@query(
    "request_counters",
    f"""
    WITH {stand_ins.REQUESTS_SQL}
    SELECT status, user_id, coalesce(error_type, '') AS error_type, count(*) AS requests
    FROM requests GROUP BY ALL
    """,
)
def request_counters(spark, directory):
    """Requests by outcome, user and kind of error."""
    requests = stand_ins.request_metrics(table(spark, directory, "events"))
    return metrics.count_by(
        requests.withColumn("error_type", F.coalesce("error_type", F.lit(""))),
        "status", "user_id", "error_type",
    )


BUCKET_SQL = "CASE " + " ".join(
    f"WHEN seconds <= {b} THEN {b}" for b in metrics.HISTOGRAM_BOUNDS
) + " ELSE 'Infinity'::DOUBLE END::DOUBLE"


@query(
    "duration_histogram",
    f"""
    WITH {stand_ins.REQUESTS_SQL}
    SELECT status, {BUCKET_SQL} AS le, count(*) AS points, round(sum(seconds), 4) AS total
    FROM requests GROUP BY ALL
    """,
)
def duration_histogram(spark, directory):
    """Durations by outcome and bucket."""
    requests = stand_ins.request_metrics(table(spark, directory, "events"))
    return metrics.histogram(requests, "seconds", "status").withColumn("total", rounded("total", 4))


def echo_model():
    """A stand-in model: answers the last user message with its first line."""

    def complete(requests):
        answers = []
        for request in requests:
            last = request["messages"][-1]
            if last["role"] != "user":
                raise ValueError("last message is not from the user")
            line = last["content"].split("\n")[0]
            usage = {"prompt_tokens": len(last["content"]), "completion_tokens": len(line)}
            answers.append({"content": line, "usage": usage})
        return answers

    return complete


def _replies(spark, directory):
    """A request per turn; system turns carry no messages."""
    turns = table(spark, directory, "conversations")
    content = nested.message(F.col("role"), F.col("text"))
    requests = turns.select(
        F.concat_ws("-", "conv_id", "turn").alias("request_id"),
        F.when(F.col("role") == "system", F.array().cast("array<struct<role:string,content:string>>"))
        .otherwise(F.array(content)).alias("messages"),
    )
    return inference.infer(inference.with_request_defaults(requests), echo_model)


@query(
    "batch_inference",
    """
    SELECT conv_id || '-' || turn AS request_id, role = 'user' AS success,
           CASE role WHEN 'user' THEN '' WHEN 'system' THEN 'empty_messages'
                ELSE 'last message is not from the user' END AS error,
           CASE WHEN role = 'user' THEN split_part(text, chr(10), 1) ELSE '' END AS content
    FROM conversations
    """,
)
def batch_inference(spark, directory):
    """One reply per request, errors included."""
    blank = F.lit("")
    return _replies(spark, directory).select(
        "request_id", "success", F.coalesce("error", blank).alias("error"),
        F.coalesce("content", blank).alias("content"),
    )


@query(
    "token_usage",
    """
    SELECT CASE role WHEN 'user' THEN '' WHEN 'system' THEN 'empty_messages'
                ELSE 'last message is not from the user' END AS error,
           count(*) FILTER (role = 'user') AS succeeded, count(*) FILTER (role <> 'user') AS failed,
           sum(CASE WHEN role = 'user' THEN length(text) ELSE 0 END)::BIGINT AS prompt_tokens,
           sum(CASE WHEN role = 'user' THEN length(split_part(text, chr(10), 1)) ELSE 0 END)::BIGINT AS completion_tokens
    FROM conversations GROUP BY 1
    """,
)
def token_usage(spark, directory):
    """Token totals by kind of error."""
    replies = _replies(spark, directory).withColumn("error", F.coalesce("error", F.lit("")))
    return metrics.token_totals(replies, "error")

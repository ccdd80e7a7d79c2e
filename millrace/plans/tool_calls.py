"""Tool calls of the assistant as tables: plan, validate, decide, record, reply."""

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import fixed, rules
from millrace.functions.json_rules import check_arguments
from millrace.functions.nested import first_call, json_text
from millrace.functions.text import business_id, null_if, strip
from millrace.session import materialise


@dataclass
class ToolCallOutcome:
    """The three tables a set of calls gives rise to."""

    decided: DataFrame
    approvals: DataFrame
    audit: DataFrame
    replies: DataFrame


CALLS = "array<struct<function: struct<name: string, arguments: string>>>"


def plan(replies: DataFrame) -> DataFrame:
    """What the model's reply asks for: a tool call, a direct reply, or nothing.

    Columns in: success, error, content, tool_calls (JSON).  Adds ``tool`` and
    ``args`` of the first call, ``direct`` and ``plan_error``.
    """
    parsed = replies.withColumn("_call", first_call(F.from_json("tool_calls", CALLS))["function"])
    called = F.col("success") & F.col("_call").isNotNull()
    text = strip(F.coalesce("content", F.lit("")))
    failure = F.format_string(
        fixed.PLANNING_FAILED, rules.with_default(F.col("error"), fixed.DEFAULT_STATUS)
    )
    return parsed.withColumns(
        {
            "tool": F.when(called, F.col("_call.name")),
            "args": F.when(called, F.col("_call.arguments")),
            "direct": F.when(F.col("success") & ~called & (text != ""), text),
            "plan_error": F.when(~F.col("success"), failure),
        }
    ).drop("_call")


def _absent_as_null(df, *names):
    return df.withColumns({n: F.lit(None).cast("string") for n in names if n not in df.columns})


def decide(calls: DataFrame, threshold=fixed.APPROVAL_THRESHOLD) -> DataFrame:
    """Adds ``error``, ``approval_required``, ``approval_reason``, ``route``.

    Columns in: session_id, user_id, tool, args (JSON), approval_status, result
    (JSON of the external call), created_at, and from planning, if it ran,
    ``direct`` and ``plan_error``.  A call whose approval was given counts as
    executed.  A call that needs an answer from another service and has no
    result failed.
    """
    checked = check_arguments(_absent_as_null(calls, "direct", "plan_error"), "tool", "args")
    asked = F.col("tool").isNotNull()
    fine = asked & F.col("valid")
    amount = F.get_json_object("args", "$.amount").try_cast("double")
    error = F.coalesce(
        F.col("plan_error"),
        F.when(
            asked & ~F.col("valid"),
            F.format_string(fixed.INVALID_ARGUMENTS, "tool", F.array_join("broken", ",")),
        ),
    )
    decided = checked.withColumns(
        {"error": error, "amount": F.when(fine & (F.col("tool") == "process_refund"), amount)}
    ).withColumn("approval_required", rules.needs_approval(F.col("amount"), threshold))
    approved = F.coalesce(F.col("approval_status") == "approved", F.lit(False))
    allowed = F.coalesce(fine, F.lit(False)) & (~F.col("approval_required") | approved)
    unanswered = F.col("tool").isin(fixed.EXTERNAL_TOOLS) & F.col("result").isNull()
    decided = decided.withColumns(
        {
            "executed": allowed & ~F.coalesce(unanswered, F.lit(False)),
            "error": F.when(
                allowed & unanswered, F.format_string(fixed.EXECUTION_FAILED, F.lit("no result"))
            ).otherwise(F.col("error")),
        }
    )
    return decided.withColumns(
        {
            "approval_reason": F.when(
                F.col("approval_required"), rules.approval_text(F.col("amount"), threshold)
            ),
            "route": rules.route(
                F.col("error"), F.lit(False), F.col("tool"), F.col("approval_required"),
                F.col("approval_status"),
            ),
        }
    )


def approval_rows(decided: DataFrame) -> DataFrame:
    """A pending approval for each gated call."""
    return decided.filter(F.col("route") == "approval_gate").select(
        business_id("session_id", "tool", "args").alias("id"),
        "session_id",
        "user_id",
        F.col("tool").alias("tool_name"),
        F.col("args").alias("tool_args"),
        F.col("approval_reason").alias("reason"),
        F.lit("pending").alias("status"),
        "created_at",
    )


def _json_value(parsed, path, default) -> Column:
    """JSON text of the value at a path of a parsed column; a default where it is absent."""
    return F.coalesce(F.to_json(F.try_variant_get(parsed, path, "variant")), F.lit(json.dumps(default)))


def _object(**members) -> Column:
    """JSON text of an object whose members are JSON texts."""
    parts = [F.concat(F.lit(f'"{name}":'), value) for name, value in members.items()]
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))


def tool_result(tool, arguments, answer) -> Column:
    """What a tool returns for the answer of the service behind it, as JSON text."""
    asked, told = F.try_parse_json(arguments), F.try_parse_json(answer)
    success = F.lit("true")
    return (
        F.when(
            tool == "get_order_status",
            _object(
                success=success,
                order_id=_json_value(asked, "$.order_id", None),
                status=_json_value(told, "$.status", fixed.DEFAULT_STATUS),
                items=F.coalesce(F.get_json_object(answer, "$.items"), F.lit("[]")),
                shipping=F.coalesce(F.get_json_object(answer, "$.shipping"), F.lit("{}")),
            ),
        )
        .when(
            tool == "process_refund",
            _object(
                success=success,
                refund_id=_json_value(told, "$.refund_id", None),
                amount=F.get_json_object(arguments, "$.amount"),
                status=F.lit(json.dumps(fixed.REFUND_DONE)),
            ),
        )
        .when(
            tool == "escalate_to_human",
            _object(
                success=success,
                ticket_id=_json_value(told, "$.ticket_id", None),
                priority=_json_value(asked, "$.priority", fixed.DEFAULT_PRIORITY),
            ),
        )
        .when(tool == "update_customer_note", _object(success=success, note_added=success))
    )


def audit_rows(decided: DataFrame) -> DataFrame:
    """An audit row for each successful execution; anonymous users are null.

    The details keep the arguments as they were given, down to the digits.
    """
    done = decided.filter("executed")
    result = tool_result(F.col("tool"), F.col("args"), F.col("result"))
    return done.select(
        F.col("created_at").alias("timestamp"),
        null_if("user_id", fixed.ANONYMOUS).alias("user_id"),
        "session_id",
        F.concat(F.lit("tool_executed_"), F.col("tool")).alias("action"),
        _object(
            tool=F.concat(F.lit('"'), F.col("tool"), F.lit('"')), args=F.col("args"), result=result
        ).alias("details"),
    )


RESULT = (
    "items array<struct<name: string, price: double>>, refund_id string, ticket_id string"
)


def reply_rows(decided: DataFrame) -> DataFrame:
    """The reply of each call."""
    parsed = decided.withColumns(
        {"_r": F.from_json("result", RESULT), "_v": F.try_parse_json("result")}
    )
    result = F.when(
        F.col("executed"),
        F.struct(
            F.coalesce(F.get_json_object("args", "$.order_id"), F.lit("")).alias("order_id"),
            json_text(F.col("_v"), "$.status").alias("status"),
            F.col("_r.items").alias("items"),
            json_text(F.col("_v"), "$.shipping.status").alias("shipping_status"),
            F.col("amount").alias("amount"),
            F.col("_r.refund_id").alias("refund_id"),
            F.col("_r.ticket_id").alias("ticket_id"),
            F.get_json_object("args", "$.priority").alias("priority"),
        ),
    )
    given = F.when(F.col("route") == "approval_gate", F.col("approval_reason")).otherwise(F.col("direct"))
    text = rules.reply(F.col("error"), F.col("tool"), F.col("_result"), direct=given)
    return (
        parsed.withColumn("_result", result)
        .select("session_id", F.col("tool").alias("tool_used"), "route", text.alias("response"))
    )


def run_tool_calls(calls: DataFrame, threshold=fixed.APPROVAL_THRESHOLD) -> ToolCallOutcome:
    """All outputs of one pass over the calls.

    The decisions are written before the outputs are drawn from them: a filter
    on a decision would otherwise repeat all the parsing that led to it.
    """
    decided, _ = materialise(decide(calls, threshold), "decided")
    return ToolCallOutcome(
        decided, approval_rows(decided), audit_rows(decided), reply_rows(decided)
    )

"""Rules of the assistant: approval, routing, defaults and replies."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions import fixed
from millrace.functions.text import money
from millrace.schemas import ITEM


def approval_pending(required, status) -> Column:
    """An approval is required and none has a status yet."""
    return F.coalesce(required, F.lit(False)) & (F.coalesce(status, F.lit("")) == "")


def needs_approval(amount, threshold=fixed.APPROVAL_THRESHOLD) -> Column:
    """Strictly above the threshold."""
    return F.coalesce(amount > threshold, F.lit(False))


def approval_text(amount, threshold=fixed.APPROVAL_THRESHOLD) -> Column:
    """The text that explains why an approval is needed."""
    return F.format_string(
        fixed.REFUND_NEEDS_APPROVAL, money(amount), F.lit(f"{threshold:.2f}")
    )


def route(error, completed, tool, required, status) -> Column:
    """Next step of a call."""
    skip = error.isNotNull() | F.coalesce(completed, F.lit(False)) | tool.isNull()
    return (
        F.when(skip, "generate_response")
        .when(approval_pending(required, status), "approval_gate")
        .otherwise("generate_response")
    )


def with_default(c, value) -> Column:
    """A default for an absent value."""
    return F.coalesce(c, F.lit(value))


def item_lines(items) -> Column:
    """One text line per ordered item."""
    listed = F.coalesce(items, F.array().cast(f"array<{ITEM.simpleString()}>"))
    lines = F.transform(
        listed, lambda i: F.format_string(fixed.REPLY_ORDER_ITEM, i["name"], money(i["price"]))
    )
    return F.concat_ws("\n", lines)


def reply(error, tool, result, direct=None) -> Column:
    """Reply text: the error, else the tool's template, else a default.

    ``result`` is a struct column with the fields a tool result may hold;
    ``direct`` is a reply the planner already gave, which is kept.
    """
    known = (
        F.when(
            tool == "get_order_status",
            F.format_string(
                fixed.REPLY_ORDER,
                result["order_id"],
                with_default(result["status"], fixed.DEFAULT_STATUS),
                item_lines(result["items"]),
                with_default(result["shipping_status"], fixed.DEFAULT_SHIPPING_STATUS),
            ),
        )
        .when(
            tool == "process_refund",
            F.format_string(
                fixed.REPLY_REFUND, money(result["amount"]), with_default(result["refund_id"], "None")
            ),
        )
        .when(
            tool == "escalate_to_human",
            F.format_string(
                fixed.REPLY_TICKET,
                with_default(result["ticket_id"], "None"),
                with_default(result["priority"], fixed.DEFAULT_PRIORITY),
            ),
        )
        .when(tool == "update_customer_note", F.lit(fixed.REPLY_NOTE))
        .otherwise(F.lit(fixed.REPLY_OTHER_TOOL))
    )
    chosen = F.when(error.isNotNull(), F.format_string(fixed.REPLY_ERROR, error))
    if direct is not None:
        chosen = chosen.when(direct.isNotNull(), direct)
    return chosen.when(result.isNotNull(), known).otherwise(F.lit(fixed.REPLY_GENERIC))

"""JSON, array and message expressions."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.fixed import SYSTEM_PROMPT
from millrace.schemas import MESSAGE


def parse_json(c, schema=None) -> Column:
    """Parse a JSON column; malformed text gives null."""
    return F.try_parse_json(c) if schema is None else F.from_json(c, schema)


def render_json(*columns) -> Column:
    """One JSON object from columns."""
    return F.to_json(F.struct(*columns))


def argument_keys(c) -> Column:
    """Top-level keys of a JSON object column."""
    return F.json_object_keys(c)


def json_text(parsed, path) -> Column:
    """Text at a path of a parsed column: null if absent, "None" if JSON null."""
    value = F.try_variant_get(parsed, path, "variant")
    return F.when(F.is_variant_null(value), "None").otherwise(F.try_variant_get(parsed, path, "string"))


def first_call(calls) -> Column:
    """First tool call of an array column, null when there is none."""
    return F.try_element_at(calls, F.lit(1))


def message(role, content) -> Column:
    """One ``{role, content}`` record."""
    role = F.lit(role) if isinstance(role, str) else role
    return F.struct(role.alias("role"), content.alias("content")).cast(MESSAGE)


def append_message(messages, role, content) -> Column:
    """Messages with one more at the end."""
    return F.array_append(messages, message(role, content))


def last_message(messages) -> Column:
    """The newest message, null when there is none."""
    return F.try_element_at(messages, F.lit(-1))


def with_system_message(messages, prompt=SYSTEM_PROMPT) -> Column:
    """Messages with the system prompt in front."""
    return F.concat(F.array(message("system", F.lit(prompt))), messages)


def array_or_empty(c, kind="array<string>") -> Column:
    """An empty array in place of null."""
    return F.coalesce(c, F.array().cast(kind))


def assemble_conversations(
    turns: DataFrame, session, turn, role, content, chunk=1_000
) -> DataFrame:
    """Ordered message arrays per session.

    A session becomes one row per ``chunk`` turn numbers, so that a session of
    any length spreads over bounded rows; ordinary sessions are one row with
    ``part`` 0.  ``turns`` holds the turn number of each message.
    """
    entry = F.struct(F.col(turn).alias("turn"), message(F.col(role), F.col(content)).alias("m"))
    return (
        turns.groupBy(F.col(session), F.floor(F.col(turn) / chunk).alias("part"))
        .agg(F.array_sort(F.collect_list(entry)).alias("entries"))
        .select(
            session, "part", F.col("entries.m").alias("messages"), F.col("entries.turn").alias("turns")
        )
    )


def explode_conversations(conversations: DataFrame, session) -> DataFrame:
    """The inverse: one row per message with its own turn number.

    Messages appended since count on from the last turn of their row.
    """
    offset, known = F.col("offset"), F.size("turns")
    after = F.try_element_at("turns", F.lit(-1)) + offset - known + 1
    return conversations.select(
        session, "turns", F.posexplode("messages").alias("offset", "message")
    ).select(
        session,
        F.when(offset < known, F.get("turns", offset)).otherwise(after).alias("turn"),
        F.col("message.role").alias("role"),
        F.col("message.content").alias("content"),
    )

"""Pinned schemas, keyed by dataset and feature-schema version."""

from pyspark.sql import types as T

_S, _L, _D, _TS, _NTZ = (
    T.StringType(), T.LongType(), T.DoubleType(), T.TimestampType(), T.TimestampNTZType(),
)


def _struct(*fields, required=()):
    return T.StructType([T.StructField(n, t, n not in required) for n, t in fields])


MESSAGE = _struct(("role", _S), ("content", _S))
ITEM = _struct(("name", _S), ("price", _D))
USAGE = _struct(("prompt_tokens", _L), ("completion_tokens", _L))

TRAINING = _struct(("x", _D), ("y", _D))

USERS = _struct(
    ("id", _S), ("email", _S), ("provider", _S), ("name", _S),
    ("allowed_orgs", T.ArrayType(_S)), ("created_at", _TS), ("updated_at", _TS),
)

APPROVALS = _struct(
    ("id", _S), ("session_id", _S), ("user_id", _S), ("tool_name", _S), ("tool_args", _S),
    ("reason", _S), ("status", _S), ("resolved_by", _S), ("resolved_at", _TS), ("created_at", _TS),
)

AUDIT_LOGS = _struct(
    ("id", _S), ("timestamp", _TS), ("user_id", _S), ("session_id", _S),
    ("action", _S), ("details", _S), ("ip_address", _S),
)

AGENT_STATE = _struct(
    ("session_id", _S), ("user_id", _S), ("messages", T.ArrayType(MESSAGE)), ("current_tool", _S),
    ("tool_args", _S), ("tool_result", _S), ("approval_required", T.BooleanType()),
    ("approval_status", _S), ("approval_reason", _S), ("error", _S), ("completed", T.BooleanType()),
)

REPLY = _struct(
    ("request_id", _S), ("success", T.BooleanType()), ("error", _S), ("content", _S),
    ("tool_calls", _S), ("usage", USAGE),
)

RUN_METADATA = _struct(
    ("mlflow_run_id", _S), ("mlflow_artifact_uri", _S), ("mlflow_registered_version", _S), ("r2", _D),
)

REGISTRY = _struct(
    ("name", _S), ("version", _L), ("run_id", _S), ("artifact_uri", _S), ("r2", _D),
)

ORDERS = _struct(
    ("o_orderkey", _L), ("o_custkey", _L), ("o_orderstatus", _S), ("o_totalprice", _D),
    ("o_orderdate", _NTZ), ("o_orderpriority", _S),
)

CUSTOMER = _struct(
    ("c_custkey", _L), ("c_name", _S), ("c_nationkey", T.IntegerType()), ("c_acctbal", _D),
    ("c_mktsegment", _S),
)

LINEITEM = _struct(
    ("l_orderkey", _L), ("l_partkey", _L), ("l_suppkey", _L), ("l_linenumber", T.IntegerType()),
    ("l_quantity", _D), ("l_extendedprice", _D), ("l_discount", _D), ("l_tax", _D),
    ("l_returnflag", _S), ("l_linestatus", _S), ("l_shipdate", _NTZ),
)

EVENTS = _struct(
    ("event_id", _L), ("ts", _NTZ), ("user_id", _L), ("event_type", _S), ("value", _D), ("props", _S),
)

_VERSIONED = {
    ("training", "v1"): TRAINING,
    ("users", "v1"): USERS,
    ("approvals", "v1"): APPROVALS,
    ("audit_logs", "v1"): AUDIT_LOGS,
    ("agent_state", "v1"): AGENT_STATE,
    ("registry", "v1"): REGISTRY,
    ("orders", "v1"): ORDERS,
    ("customer", "v1"): CUSTOMER,
    ("lineitem", "v1"): LINEITEM,
    ("events", "v1"): EVENTS,
}


def pinned(dataset, version="v1"):
    """The schema of a dataset, or None when it has no pinned one."""
    return _VERSIONED.get((dataset, version))

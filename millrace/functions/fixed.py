"""Texts, limits and rules whose exact content decides results."""

# Refund rule.
APPROVAL_THRESHOLD = 100.0
REFUND_NEEDS_APPROVAL = "Refund of $%s requires manager approval (threshold: $%s)"

# Defaults for absent fields.
DEFAULT_STATUS = "unknown"
DEFAULT_PRIORITY = "medium"
REFUND_DONE = "processed"
DEFAULT_SHIPPING_STATUS = "N/A"
DEFAULT_MAX_TOKENS = 512
DEFAULT_TEMPERATURE = 0.1
DEFAULT_SEED = 42
ANONYMOUS = "anonymous"

# Message texts.
SYSTEM_PROMPT = (
    "You are a helpful customer service assistant. Use tools to fulfill user requests. "
    "Only call tools when necessary."
)
REPLY_ERROR = "❌ Error: %s"
REPLY_ORDER = "📦 Order %s status: %s\nItems:\n%s\nShipping: %s"
REPLY_ORDER_ITEM = "  • %s: $%s"
REPLY_REFUND = "✅ Refund of $%s processed successfully (ID: %s)"
REPLY_TICKET = (
    "🎫 Support ticket created (ID: %s) with %s priority. An agent will contact you shortly."
)
REPLY_NOTE = "✅ Note added to your account."
REPLY_OTHER_TOOL = "✅ Request completed successfully."
REPLY_GENERIC = "I've processed your request. How else can I help?"
PLANNING_FAILED = "Planning failed: %s"
INVALID_ARGUMENTS = "Invalid tool arguments for %s: %s"
EXECUTION_FAILED = "Tool execution error: %s"
EMPTY_MESSAGES = "empty_messages"

# Tools that need an answer from another service.
EXTERNAL_TOOLS = ["get_order_status", "process_refund", "escalate_to_human"]

# Argument rules of the four tools.
TOOL_RULES = {
    "get_order_status": {
        "properties": {"order_id": {"type": "string"}},
        "required": ["order_id"],
    },
    "process_refund": {
        "properties": {
            "order_id": {"type": "string"},
            "amount": {"type": "number", "minimum": 0.01},
            "reason": {"type": "string", "minLength": 5, "maxLength": 500},
        },
        "required": ["order_id", "amount", "reason"],
    },
    "escalate_to_human": {
        "properties": {
            "issue_description": {"type": "string", "minLength": 10, "maxLength": 2000},
            "priority": {"type": "string", "enum": ["low", "medium", "high", "critical"]},
        },
        "required": ["issue_description"],
    },
    "update_customer_note": {
        "properties": {"note": {"type": "string", "minLength": 5, "maxLength": 1000}},
        "required": ["note"],
    },
}

# Upper-inclusive histogram bounds and the export interval.
HISTOGRAM_BOUNDS = [
    0, 5, 10, 25, 50, 75, 100, 250, 500, 750, 1000, 2500, 5000, 7500, 10000,
]
EXPORT_INTERVAL = "15 seconds"

# Inference batch size.
BATCH_REQUESTS = 16

# Approval status domain and the range of the derived feature.
STATUS_DOMAIN = ["pending", "approved", "rejected"]
FEATURE_RANGE = (0.0, 1e9)

"""Fixed values the rules depend on."""

from __future__ import annotations

# --- fixed values: lookup tables ------------------------------------------------
# team -> (department, manager)
TEAMS = {
    "PaymentsOps": ("Finance", "Rina Patel"),
    "CustomerCare": ("Customer Success", "Jordan Lee"),
    "ClaimsReview": ("Operations", "Maya Chen"),
    "RiskOps": ("Operations", "Daniel Kim"),
    "FulfillmentOps": ("Operations", "Elena Garcia"),
}
# workflow type -> (domain, SLA hours)
WORKFLOW_TYPES = {
    "InvoiceApproval": ("Finance", 24),
    "RefundReview": ("Customer", 12),
    "ClaimsValidation": ("Risk", 36),
    "VendorOnboarding": ("Procurement", 72),
    "KycRefresh": ("Compliance", 48),
}
PRIORITY_RANKS = {"low": 1, "medium": 2, "high": 3, "critical": 4}
STATUSES = ("completed", "in_progress", "queued", "failed", "cancelled")
TERMINAL_STATUSES = ("completed", "failed", "cancelled")
CLOSED_EXCEPTION_STATUSES = ("completed", "cancelled")  # a failed workflow's exception stays open
UNKNOWN = "Unknown"
DEFAULT_SLA_HOURS = 24
HIGH_PROCESSING_HOURS = 24

# --- fixed values: source contract ----------------------------------------------
SOURCE_COLUMNS = (
    "source_file_name",
    "source_row_number",
    "workflow_id",
    "workflow_type",
    "team_name",
    "assignee_id",
    "priority",
    "status",
    "queue_name",
    "created_at",
    "started_at",
    "completed_at",
    "due_at",
    "backlog_flag",
    "exception_flag",
    "exception_type",
    "source_system",
    "records_touched",
    "error_count",
    "payload",
)
TIMESTAMP_COLUMNS = ("created_at", "started_at", "completed_at", "due_at")
TRUE_TOKENS = ("1", "true", "t", "yes", "y")

# Cells a CSV reader treats as missing.
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Characters stripped from both ends of text: everything Unicode calls white space.
WHITESPACE = (
    "\t\n\u000b\u000c\r\u001c\u001d\u001e\u001f \u0085\u00a0"
    "\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008"
    "\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# ISO-8601 date, or date-time with optional seconds, fraction and offset (none means UTC).
ISO_TIMESTAMP = (
    r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?(Z|[+-]\d{2}(:?\d{2})?)?)?$"
)
# Instants outside the range of signed 64-bit nanoseconds count as unparseable.
EARLIEST_INSTANT = "1677-09-21T00:12:43.145225Z"
LATEST_INSTANT = "2262-04-11T23:47:16.854775Z"
DECIMAL_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"

# --- fixed values: labels ---------------------------------------------------------
VALID = "valid"
QUARANTINED = "quarantined"
SOURCE_ROW_TAKEN = "source_row_taken"  # another workflow holds the same file and row number
OVERDUE = "overdue_workflow"
MISSING_ASSIGNEE = "missing_assignee"
INVALID_LIFECYCLE = "invalid_lifecycle_pattern"
HIGH_PROCESSING = "high_processing_time"

MAX_PAGE_SIZE = 500
DEFAULT_PAGE_SIZE = 50

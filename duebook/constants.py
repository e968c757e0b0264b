"""Names, limits and texts that results are compared on.

Everything in this file is data.  Operators build their expressions from it.
"""

# --- fixed values: raw file header -> staging column -------------------------------
RAW_HEADER = {
    "Invoice": "invoice_no",
    "StockCode": "stock_code",
    "Description": "description",
    "Quantity": "quantity",
    "InvoiceDate": "invoice_date",
    "Price": "unit_price",
    "Customer ID": "customer_id",
    "Country": "country",
}

# --- fixed values: customer and invoice defaults -----------------------------------
CUSTOMER_NAME_PREFIX = "Retail Customer "
CUSTOMER_TYPE = "RETAIL"
CUSTOMER_INDUSTRY = "RETAIL"
CUSTOMER_CREDIT_LIMIT = "10000"
CUSTOMER_RISK = "LOW"
CANCELLED_PREFIX = "C"
DEFAULT_TERM = (1, "NET 30", 30, "Payment is due within 30 days")
REPORTING_LAG_DAYS = 45

# --- fixed values: aging buckets as (name, lowest day, highest day), in report order
AGING_BUCKETS = [
    ("CURRENT", None, 0),
    ("1-30 DAYS", 1, 30),
    ("31-60 DAYS", 31, 60),
    ("61-90 DAYS", 61, 90),
    ("90+ DAYS", 91, None),
]
OLDEST_BUCKET = "90+ DAYS"

# --- fixed values: collection priorities, in queue order ---------------------------
PRIORITIES = ["CRITICAL", "HIGH", "MEDIUM", "LOW", "MONITOR"]
CRITICAL_AMOUNT = "10000"

# (lowest day, smallest outstanding amount or None, priority, recommended action)
COLLECTION_TIERS = [
    (91, CRITICAL_AMOUNT, "CRITICAL", "ESCALATE TO COLLECTIONS MANAGER"),
    (91, None, "HIGH", "CALL CUSTOMER AND REQUEST PAYMENT COMMITMENT"),
    (61, None, "HIGH", "MAKE COLLECTION CALL"),
    (31, None, "MEDIUM", "SEND SECOND PAYMENT REMINDER"),
    (1, None, "LOW", "SEND FIRST PAYMENT REMINDER"),
]
COLLECTION_DEFAULT = ("MONITOR", "MONITOR UNTIL DUE DATE")

# --- fixed values: risk score points as (lower bound, points) ----------------------
EXPOSURE_POINTS = [(100000, 35), (50000, 30), (25000, 20)]
EXPOSURE_POSITIVE_POINTS = 10
LATENESS_POINTS = [(91, 35), (61, 30), (31, 20), (1, 10)]
OVERDUE_COUNT_POINTS = [(10, 20), (5, 15), (1, 5)]
PARTIAL_COUNT_POINTS = [(3, 10), (1, 5)]
RISK_SCORE_CAP = 100

# (lowest score, level, recommended action)
RISK_LEVELS = [
    (80, "CRITICAL", "ESCALATE ACCOUNT AND REVIEW COLLECTION STRATEGY"),
    (60, "HIGH", "PRIORITIZE CUSTOMER FOR COLLECTION CALL"),
    (40, "MEDIUM", "SEND PAYMENT REMINDER AND MONITOR"),
    (1, "LOW", "MONITOR OUTSTANDING BALANCE"),
]
RISK_DEFAULT = ("NO RISK", "NO COLLECTION ACTION REQUIRED")

# --- fixed values: payment fixture -------------------------------------------------
PAYMENT_METHODS = ["ACH", "CREDIT CARD", "WIRE TRANSFER", "CHECK"]
PAYMENT_REFERENCE_PREFIX = "PAY-"

# --- fixed values: allowed words per column ----------------------------------------
CUSTOMER_STATUSES = ["ACTIVE", "INACTIVE", "BLOCKED"]
RISK_CATEGORIES = ["LOW", "MEDIUM", "HIGH"]
INVOICE_STATUSES = ["OPEN", "PARTIALLY_PAID", "PAID", "OVERDUE", "CANCELLED"]
DISPUTE_FLAGS = ["Y", "N"]
CONVERSATION_STATUSES = ["ACTIVE", "COMPLETED", "ERROR"]
ACTIVITY_TYPES = [
    "USER_MESSAGE", "TOOL_CALL", "AGENT_RESPONSE", "ERROR", "MEMORY_CLEAR", "SESSION_END",
    "APPROVAL_REQUEST", "APPROVAL_DECISION", "ACTION_EXECUTION",
]
EXECUTION_STATUSES = ["SUCCESS", "FAILED"]
APPROVAL_STATUSES = ["PENDING", "APPROVED", "REJECTED", "CANCELLED", "EXECUTED"]
NOTIFICATION_STATUSES = ["PENDING", "PROCESSING", "SENT", "FAILED", "RETRY", "DEAD"]
RECOVERABLE_STATUSES = ["DEAD", "FAILED", "RETRY"]
ORCHESTRATION_STATUSES = [
    "STARTED", "WAITING_APPROVAL", "APPROVED", "QUEUED", "PROCESSING", "COMPLETED", "FAILED",
]
NOTIFICATION_TRANSITIONS = [
    ("PENDING", "PROCESSING"), ("RETRY", "PROCESSING"),
    ("PROCESSING", "SENT"), ("PROCESSING", "FAILED"), ("PROCESSING", "RETRY"), ("PROCESSING", "DEAD"),
    ("DEAD", "PENDING"), ("FAILED", "PENDING"), ("RETRY", "PENDING"),
]
ORCHESTRATION_TRANSITIONS = [
    ("STARTED", "WAITING_APPROVAL"), ("STARTED", "FAILED"),
    ("WAITING_APPROVAL", "APPROVED"), ("WAITING_APPROVAL", "FAILED"),
    ("APPROVED", "QUEUED"), ("APPROVED", "FAILED"),
    ("QUEUED", "PROCESSING"), ("QUEUED", "FAILED"),
    ("PROCESSING", "COMPLETED"), ("PROCESSING", "FAILED"),
]

# --- fixed values: workflow --------------------------------------------------------
REMINDER_ACTION = "SEND_PAYMENT_REMINDER"
REMINDER_TYPE = "PAYMENT_REMINDER"
REMINDER_CHANNEL = "EMAIL"
REVIEWER = "AR_MANAGER"
MAX_RETRY_COUNT = 3
RETRY_DELAY = "1 minute"
STALE_AFTER = "30 minutes"

# Message texts; %s marks the places that are filled from columns.
TEXT_REQUEST = "Send a payment reminder for invoice %s."
TEXT_SUBJECT = "Payment Reminder - Invoice %s"
TEXT_BODY = (
    "Hello %s,\n\nThis is a payment reminder for invoice %s. "
    "Please review the outstanding balance and arrange payment.\n\nThank you."
)
TEXT_BODY_PLAIN = (
    "This is a payment reminder for invoice %s. "
    "Please review the outstanding balance and arrange payment."
)
TEXT_EXECUTED_MESSAGE_ONLY = "Payment reminder simulation completed for invoice %s."
TEXT_EXECUTED_PLAIN = (
    "Payment reminder for invoice %s was queued successfully. Notification ID: %s. Status: PENDING."
)
TEXT_EXECUTED = (
    "Payment reminder for invoice %s was queued. Recipient: %s. Notification ID: %s. Status: PENDING."
)
TEXT_EXECUTED_RUN = "Notification %s created by orchestrator."
TEXT_RUN_REVIEW = "Approved from Day 21 orchestrator."
TEXT_RECOVERY_REASON = "Manual recovery from notification console."
TEXT_REQUEUED = "Notification %s was requeued successfully. %s -> PENDING. Recovery ID: %s."
TEXT_DEAD = "Maximum retry count reached."
TEXT_RETRY = "Notification delivery failed."
TEXT_NO_RECIPIENT = "Recipient address is missing."
ERR_INVOICE = "Invoice %s was not found."
ERR_AMBIGUOUS = "Invoice number %s belongs to %s invoices."
ERR_INACTIVE = "Customer %s is INACTIVE."
ERR_NO_EMAIL = "Customer %s does not have an email address."
ERR_BLANK_EMAIL = "Customer %s does not have a usable email address."
ERR_APPROVAL_MISSING = "Approval request %s was not found."
ERR_APPROVAL_STATUS = "Approval request %s is %s, not APPROVED."
ERR_ACTION = "Unsupported action type: %s"
ERR_PAYLOAD = "The action payload names no invoice."
ERR_DUPLICATE = "Approval request %s already has notification %s."
ERR_DECISION = "Decision must be APPROVED or REJECTED."
ERR_NOTIFICATION_MISSING = "Notification %s was not found."
ERR_REQUEUE = "Notification %s is %s. Only DEAD, FAILED, or RETRY notifications can be requeued."
ERR_RUN_MISSING = "Orchestration %s was not found."
ERR_RUN_STATUS = "Orchestration %s is %s, not WAITING_APPROVAL."
ERR_RUN_APPROVAL = "Approval request could not be approved."
ERR_CUSTOMER_LOOKUP = "Customer does not exist: %s"
ERR_INVOICE_LOOKUP = "Invoice does not exist: %s"

# --- fixed values: phrases that mark a follow-up question --------------------------
FOLLOW_UP_PHRASES = [
    "which one",
    "which invoice",
    "the oldest",
    "the newest",
    "the highest",
    "the largest",
    "the lowest",
    "what action",
    "what should we do",
    "what should i do",
    "tell me more",
    "explain that",
    "why is it",
    "why is that",
    "those invoices",
    "that customer",
    "that invoice",
    "this customer",
    "this invoice",
    "summarize them",
    "summarize it",
]

# --- fixed values: sentences of the collections narrative --------------------------
NARRATIVE_SUBJECT = "The accounts receivable agent"
NARRATIVE = {
    "opening": "%s is currently managing $%s in outstanding receivables.",
    "overdue": "There are %s overdue invoices totaling $%s, representing %s%% of the current outstanding balance.",
    "none": "There are currently no overdue invoices requiring collection action.",
    "days_90": "The highest-risk invoice is %s days past due. Immediate collection follow-up should be prioritized.",
    "days_60": "The oldest outstanding invoice is %s days past due, indicating elevated collection risk.",
    "days_30": "The oldest outstanding invoice is %s days past due. Collection follow-up should continue.",
    "recent": "Overdue exposure is currently concentrated in relatively recent delinquencies.",
    "waiting": "%s collection action(s) are waiting for manager approval.",
    "not_waiting": "There are no collection actions currently waiting for manager approval.",
    "runs": "The Action Orchestrator has completed %s workflow(s), with %s failed workflow(s).",
    "sent": "The notification service has successfully sent %s reminder(s), with %s failed notification(s).",
    "exceptions": "Operational exceptions were detected. The AR team should review failed orchestrations or notification errors.",
    "no_exceptions": "No unresolved orchestration or notification failures are currently reported.",
}

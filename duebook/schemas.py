"""Explicit schemas of all tables (never inferred).

Amounts are declared for 12 digits, but kept in 18: the sum of a very large invoice or
customer must not stop a load.  Amounts beyond 12 digits are reported as rule violations.
"""

from pyspark.sql.types import StructType

STAGING = """
  transaction_id bigint, invoice_no string, stock_code string, description string,
  quantity decimal(18,4), invoice_date timestamp, unit_price decimal(10,2),
  customer_id bigint, country string, load_date timestamp, source_file string"""

CUSTOMERS = """
  customer_id bigint, customer_name string, customer_type string, industry string,
  email string, phone string, credit_limit decimal(18,2), current_balance decimal(18,2),
  risk_category string, status string, created_date timestamp"""

PAYMENT_TERMS = "payment_term_id bigint, term_name string, due_days int, description string"

INVOICES = """
  invoice_id bigint, invoice_number string, customer_id bigint, payment_term_id bigint,
  invoice_date timestamp, due_date timestamp, invoice_amount decimal(18,2),
  amount_paid decimal(18,2), outstanding_amount decimal(18,2), invoice_status string,
  dispute_flag string, created_date timestamp"""

INVOICE_LINES = """
  invoice_line_id bigint, invoice_id bigint, product_code string, description string,
  quantity decimal(18,4), unit_price decimal(12,2), line_amount decimal(18,2)"""

PAYMENTS = """
  payment_id bigint, invoice_id bigint, payment_date timestamp, payment_amount decimal(18,2),
  payment_method string, reference_number string, created_date timestamp"""

CONVERSATIONS = """
  conversation_id string, started_at timestamp, ended_at timestamp,
  conversation_status string, created_by string"""

ACTIVITY_LOG = """
  activity_id bigint, conversation_id string, activity_time timestamp, activity_type string,
  user_question string, tool_name string, tool_arguments string, records_returned int,
  agent_response string, execution_status string, error_message string"""

APPROVALS = """
  approval_id bigint, conversation_id string, requested_at timestamp, requested_by string,
  action_type string, action_description string, action_payload string, approval_status string,
  reviewed_at timestamp, reviewed_by string, review_comments string, executed_at timestamp,
  execution_status string, execution_message string"""

OUTBOX = """
  notification_id bigint, approval_id bigint, conversation_id string, notification_type string,
  recipient_address string, subject_text string, message_body string, notification_status string,
  retry_count int, max_retry_count int, next_retry_at timestamp, created_at timestamp,
  processed_at timestamp, updated_at timestamp, error_message string, failure_reason string,
  dead_at timestamp"""

RECOVERY_LOG = """
  recovery_id bigint, notification_id bigint, previous_status string, new_status string,
  recovered_by string, recovery_reason string, recovered_at timestamp"""

ORCHESTRATION_RUNS = """
  orchestration_id bigint, invoice_number string, approval_id bigint, notification_id bigint,
  orchestration_status string, current_step string, started_at timestamp, completed_at timestamp,
  error_message string"""

TABLES = {
    "stg_retail_transactions": STAGING,
    "customers": CUSTOMERS,
    "payment_terms": PAYMENT_TERMS,
    "invoices": INVOICES,
    "invoice_lines": INVOICE_LINES,
    "payments": PAYMENTS,
    "agent_conversations": CONVERSATIONS,
    "agent_activity_log": ACTIVITY_LOG,
    "agent_approval_requests": APPROVALS,
    "agent_notification_outbox": OUTBOX,
    "agent_notification_recovery_log": RECOVERY_LOG,
    "agent_orchestration_runs": ORCHESTRATION_RUNS,
}


def struct(table):
    return StructType.fromDDL(TABLES[table])


def conform(df, table):
    """Project `df` to the columns and types of `table`; columns it lacks become NULL."""
    from pyspark.sql import functions as F

    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in struct(table)
        ]
    )

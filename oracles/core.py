"""Shared CTEs: the driver's tables as staging, receivables and workflow tables."""

import re

# name -> body; bodies refer to earlier names only.
CTES = {}

CTES["stg"] = """
SELECT row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
                  l_extendedprice, l_shipdate, l_returnflag, l_linestatus) AS transaction_id,
       CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'C' ELSE '' END
         || CAST(o_orderkey AS VARCHAR) AS invoice_no,
       CAST(l_partkey AS VARCHAR) AS stock_code,
       p_name AS description,
       CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN -1 ELSE 1 END
         * CAST(l_quantity AS INTEGER) AS quantity,
       CAST(date '2001-08-01'
            - CAST(date_diff('day', CAST(o_orderdate AS DATE), date '2001-08-01') % 150 AS INTEGER)
            AS TIMESTAMP) AS invoice_date,
       CAST((CAST(round(l_extendedprice * 100) AS BIGINT) // (CAST(l_quantity AS BIGINT) * 20))
            * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(10,2)) AS unit_price,
       CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_custkey END AS customer_id,
       n_name AS country
FROM lineitem
JOIN orders ON l_orderkey = o_orderkey
JOIN part ON p_partkey = l_partkey
JOIN customer ON c_custkey = o_custkey
JOIN nation ON n_nationkey = c_nationkey"""

CTES["raw"] = """
SELECT CAST(transaction_id AS VARCHAR) AS transaction_id, invoice_no AS "Invoice", stock_code AS "StockCode",
  CASE WHEN transaction_id % 101 = 0 THEN repeat(description, 60) ELSE description END AS "Description",
  CASE WHEN transaction_id % 97 = 0 THEN 'n/a' ELSE CAST(quantity AS VARCHAR) END AS "Quantity",
  CASE WHEN transaction_id % 89 = 0 THEN 'not a date' ELSE strftime(invoice_date, '%Y-%m-%d %H:%M:%S') END AS "InvoiceDate",
  CASE WHEN transaction_id % 83 = 0 THEN 'free' ELSE CAST(unit_price AS VARCHAR) END AS "Price",
  CAST(customer_id AS VARCHAR) || '.0' AS "Customer ID", country AS "Country",
  CASE WHEN transaction_id % 2 = 0 THEN 'even rows' ELSE 'odd rows' END AS source_part
FROM stg"""

CTES["typed"] = """
SELECT transaction_id, "Invoice" AS invoice_no, "StockCode" AS stock_code,
  "Description" AS description, TRY_CAST("Quantity" AS DECIMAL(18,4)) AS quantity,
  TRY_CAST("InvoiceDate" AS TIMESTAMP) AS invoice_date, TRY_CAST("Price" AS DECIMAL(18,4)) AS unit_price,
  CAST(trunc(TRY_CAST("Customer ID" AS DECIMAL(38,4))) AS BIGINT) AS customer_id,
  "Country" AS country, source_part
FROM raw"""

CTES["good"] = """
SELECT * FROM stg
WHERE customer_id IS NOT NULL AND invoice_no IS NOT NULL AND invoice_no NOT LIKE 'C%'
  AND quantity > 0 AND unit_price >= 0 AND invoice_date IS NOT NULL"""

CTES["inv0"] = """
SELECT row_number() OVER (ORDER BY invoice_no, customer_id) AS invoice_id, *
FROM (SELECT invoice_no, customer_id, min(invoice_date) AS invoice_date,
             CAST(sum(quantity * unit_price) AS DECIMAL(18,2)) AS invoice_amount
      FROM good GROUP BY invoice_no, customer_id)
WHERE invoice_amount >= 0"""

CTES["pay"] = """
SELECT row_number() OVER (ORDER BY invoice_id) AS payment_id, invoice_id,
       invoice_date + to_days(CAST(invoice_id % 45 + 1 AS INTEGER)) AS payment_date,
       CASE WHEN invoice_id % 5 = 0 THEN invoice_amount
            ELSE CAST(round(invoice_amount * CAST(0.5 AS DECIMAL(2,1)), 2) AS DECIMAL(18,2)) END AS payment_amount,
       CASE invoice_id % 4 WHEN 0 THEN 'ACH' WHEN 1 THEN 'CREDIT CARD'
            WHEN 2 THEN 'WIRE TRANSFER' ELSE 'CHECK' END AS payment_method,
       'PAY-' || lpad(CAST(invoice_id AS VARCHAR), 10, '0') AS reference_number
FROM inv0 WHERE invoice_id % 5 IN (0, 1) AND invoice_amount > 0"""

CTES["paid"] = """
SELECT invoice_id, CAST(sum(payment_amount) AS DECIMAL(18,2)) AS paid FROM pay GROUP BY invoice_id"""

CTES["inv"] = """
SELECT i.invoice_id, i.invoice_no AS invoice_number, i.customer_id, i.invoice_date,
       i.invoice_date + INTERVAL 30 DAY AS due_date, i.invoice_amount,
       coalesce(p.paid, 0) AS amount_paid,
       CASE WHEN p.paid IS NULL THEN i.invoice_amount
            WHEN i.invoice_amount > p.paid THEN i.invoice_amount - p.paid ELSE 0 END AS outstanding_amount,
       CASE WHEN p.paid >= i.invoice_amount THEN 'PAID' WHEN p.paid > 0 THEN 'PARTIALLY_PAID'
            ELSE 'OPEN' END AS invoice_status
FROM inv0 i LEFT JOIN paid p ON p.invoice_id = i.invoice_id"""

CTES["cust"] = """
SELECT c.customer_id, 'Retail Customer ' || CAST(c.customer_id AS VARCHAR) AS customer_name,
       CASE WHEN c.customer_id % 4 = 0 THEN NULL WHEN c.customer_id % 4 = 1 THEN '   '
            ELSE 'c' || CAST(c.customer_id AS VARCHAR) || '@example.com' END AS email,
       CASE WHEN c.customer_id % 10 = 3 THEN 'INACTIVE' WHEN c.customer_id % 10 = 7 THEN 'BLOCKED'
            ELSE 'ACTIVE' END AS status,
       coalesce(b.bal, 0) AS current_balance
FROM (SELECT DISTINCT customer_id FROM stg WHERE customer_id IS NOT NULL) c
LEFT JOIN (SELECT customer_id, sum(outstanding_amount) AS bal FROM inv GROUP BY customer_id) b
  ON b.customer_id = c.customer_id"""

CTES["lines"] = """
SELECT g.transaction_id AS invoice_line_id, i.invoice_id, g.stock_code AS product_code, g.description,
       g.quantity, g.unit_price, CAST(round(g.quantity * g.unit_price, 2) AS DECIMAL(18,2)) AS line_amount
FROM good g JOIN inv0 i ON i.invoice_no = g.invoice_no AND i.customer_id = g.customer_id"""

CTES["aged"] = """
SELECT i.*, c.customer_name, a.as_of,
       date_diff('day', CAST(i.due_date AS DATE), a.as_of) AS raw_days,
       greatest(date_diff('day', CAST(i.due_date AS DATE), a.as_of), 0) AS days
FROM inv i JOIN cust c ON c.customer_id = i.customer_id
CROSS JOIN (SELECT CAST(max(invoice_date) AS DATE) + 45 AS as_of FROM inv) a
WHERE i.outstanding_amount > 0"""

CTES["aging"] = """
SELECT *,
  CASE WHEN raw_days <= 0 THEN 'CURRENT' WHEN raw_days <= 30 THEN '1-30 DAYS'
       WHEN raw_days <= 60 THEN '31-60 DAYS' WHEN raw_days <= 90 THEN '61-90 DAYS'
       ELSE '90+ DAYS' END AS aging_bucket,
  CASE WHEN days > 90 AND outstanding_amount >= 10000 THEN 'CRITICAL' WHEN days > 60 THEN 'HIGH'
       WHEN days > 30 THEN 'MEDIUM' WHEN days > 0 THEN 'LOW' ELSE 'MONITOR' END AS collection_priority,
  CASE WHEN days > 90 AND outstanding_amount >= 10000 THEN 'ESCALATE TO COLLECTIONS MANAGER'
       WHEN days > 90 THEN 'CALL CUSTOMER AND REQUEST PAYMENT COMMITMENT'
       WHEN days > 60 THEN 'MAKE COLLECTION CALL'
       WHEN days > 30 THEN 'SEND SECOND PAYMENT REMINDER'
       WHEN days > 0 THEN 'SEND FIRST PAYMENT REMINDER'
       ELSE 'MONITOR UNTIL DUE DATE' END AS recommended_action
FROM aged"""

CTES["summary"] = """
SELECT c.customer_id, c.customer_name, count(i.invoice_id) AS total_invoice_count,
  count(CASE WHEN i.outstanding_amount > 0 THEN 1 END) AS open_invoice_count,
  coalesce(sum(i.invoice_amount), 0) AS total_invoiced,
  coalesce(sum(i.amount_paid), 0) AS total_paid,
  coalesce(sum(i.outstanding_amount), 0) AS total_outstanding,
  coalesce(max(a.days), 0) AS maximum_days_past_due,
  coalesce(sum(CASE WHEN a.days > 0 THEN a.outstanding_amount END), 0) AS overdue_amount,
  coalesce(sum(CASE WHEN a.aging_bucket = '90+ DAYS' THEN a.outstanding_amount END), 0) AS amount_over_90_days,
  count(CASE WHEN i.invoice_status = 'PARTIALLY_PAID' THEN 1 END) AS partially_paid_invoice_count,
  count(CASE WHEN a.days > 0 THEN 1 END) AS overdue_count
FROM cust c LEFT JOIN inv i ON i.customer_id = c.customer_id
LEFT JOIN aging a ON a.invoice_id = i.invoice_id
GROUP BY c.customer_id, c.customer_name"""

CTES["scored"] = """
SELECT *, CAST(least(100,
    CASE WHEN total_outstanding >= 100000 THEN 35 WHEN total_outstanding >= 50000 THEN 30
         WHEN total_outstanding >= 25000 THEN 20 WHEN total_outstanding > 0 THEN 10 ELSE 0 END
  + CASE WHEN maximum_days_past_due > 90 THEN 35 WHEN maximum_days_past_due >= 61 THEN 30
         WHEN maximum_days_past_due >= 31 THEN 20 WHEN maximum_days_past_due >= 1 THEN 10 ELSE 0 END
  + CASE WHEN overdue_count >= 10 THEN 20 WHEN overdue_count >= 5 THEN 15
         WHEN overdue_count > 0 THEN 5 ELSE 0 END
  + CASE WHEN partially_paid_invoice_count >= 3 THEN 10
         WHEN partially_paid_invoice_count > 0 THEN 5 ELSE 0 END) AS INTEGER) AS risk_score
FROM summary"""

CTES["risk"] = """
SELECT *,
  CASE WHEN risk_score >= 80 THEN 'CRITICAL' WHEN risk_score >= 60 THEN 'HIGH'
       WHEN risk_score >= 40 THEN 'MEDIUM' WHEN risk_score > 0 THEN 'LOW' ELSE 'NO RISK' END AS risk_level,
  CASE WHEN risk_score >= 80 THEN 'ESCALATE ACCOUNT AND REVIEW COLLECTION STRATEGY'
       WHEN risk_score >= 60 THEN 'PRIORITIZE CUSTOMER FOR COLLECTION CALL'
       WHEN risk_score >= 40 THEN 'SEND PAYMENT REMINDER AND MONITOR'
       WHEN risk_score > 0 THEN 'MONITOR OUTSTANDING BALANCE'
       ELSE 'NO COLLECTION ACTION REQUIRED' END AS recommended_action
FROM scored"""

CTES["ev"] = """
SELECT event_id, ts, user_id, event_type, CAST(json_extract(props, '$.k') AS INTEGER) AS k,
       'conv-' || CAST(user_id AS VARCHAR) AS conversation_id,
       CAST((event_id * 3 + 1) % (SELECT count(*) FROM orders) AS VARCHAR) AS invoice_number
FROM events"""

CTES["ev2"] = """
SELECT *, CASE WHEN second THEN 4 ELSE event_id % 5 END AS state,
  CASE WHEN second THEN -event_id - 1 ELSE event_id END AS aid,
  CASE WHEN second THEN -event_id - 1 ELSE event_id + 1 END AS nid
FROM ev, (VALUES (false), (true)) s(second)"""

CTES["appr"] = """
SELECT aid AS approval_id, conversation_id, ts AS requested_at,
  'user-' || CAST(user_id AS VARCHAR) AS requested_by,
  CASE WHEN event_id % 11 = 0 THEN 'OTHER_ACTION' ELSE 'SEND_PAYMENT_REMINDER' END AS action_type,
  'Send a payment reminder for invoice ' || invoice_number || '.' AS action_description,
  '{"invoice_number":"' || invoice_number || '","channel":"EMAIL"}' AS action_payload,
  CASE state WHEN 0 THEN 'PENDING' WHEN 1 THEN 'APPROVED' WHEN 2 THEN 'REJECTED'
       WHEN 3 THEN 'CANCELLED' ELSE 'EXECUTED' END AS approval_status,
  CASE WHEN state <> 0 THEN ts + INTERVAL 1 HOUR END AS reviewed_at,
  CASE WHEN state <> 0 THEN 'AR_MANAGER' END AS reviewed_by,
  CAST(NULL AS VARCHAR) AS review_comments,
  CASE WHEN state = 4 THEN ts + INTERVAL 2 HOUR END AS executed_at,
  CASE WHEN state = 4 THEN 'SUCCESS' END AS execution_status,
  CASE WHEN state = 4 THEN 'Notification ' || CAST(nid AS VARCHAR)
       || ' created by orchestrator.' END AS execution_message,
  invoice_number AS wanted_invoice
FROM ev2"""

CTES["box"] = """
SELECT *, CASE WHEN notification_status = 'RETRY' THEN created_at + INTERVAL 1 MINUTE END AS next_retry_at,
  CASE WHEN notification_status IN ('SENT', 'DEAD', 'FAILED') THEN updated_at END AS processed_at,
  CASE WHEN notification_status IN ('RETRY', 'DEAD', 'FAILED') THEN 'Recipient address is missing.' END AS error_message,
  CASE WHEN notification_status = 'DEAD' THEN 'Maximum retry count reached.'
       WHEN notification_status = 'RETRY' THEN 'Notification delivery failed.' END AS failure_reason,
  CASE WHEN notification_status = 'DEAD' THEN updated_at END AS dead_at
FROM (
  SELECT nid AS notification_id, aid AS approval_id, conversation_id,
    'PAYMENT_REMINDER' AS notification_type,
    CASE WHEN k % 7 <> 0 THEN 'u' || CAST(user_id AS VARCHAR) || '@example.com' END AS recipient_address,
    'Payment Reminder - Invoice ' || invoice_number AS subject_text,
    'This is a payment reminder for invoice ' || invoice_number
      || '. Please review the outstanding balance and arrange payment.' AS message_body,
    st AS notification_status,
    CASE WHEN st = 'DEAD' THEN 3 ELSE k % 3 END AS retry_count,
    3 AS max_retry_count, ts AS created_at, ts + to_minutes(k) AS updated_at, k
  FROM (SELECT *, CASE event_type WHEN 'click' THEN 'PENDING' WHEN 'signup' THEN 'PROCESSING'
                       WHEN 'purchase' THEN 'SENT' WHEN 'view' THEN 'RETRY'
                       ELSE CASE WHEN k % 2 = 0 THEN 'DEAD' ELSE 'FAILED' END END AS st FROM ev2)
  WHERE second OR event_id % 5 = 4 OR event_id % 25 = 1)"""

CTES["rec"] = """
SELECT notification_id AS recovery_id, notification_id, notification_status AS previous_status,
  'PENDING' AS new_status, 'AR_MANAGER' AS recovered_by,
  'Manual recovery from notification console.' AS recovery_reason,
  updated_at + INTERVAL 5 MINUTE AS recovered_at
FROM box WHERE notification_status IN ('DEAD', 'FAILED', 'RETRY')"""

CTES["runs"] = """
SELECT event_id AS orchestration_id, invoice_number, event_id AS approval_id,
  CASE WHEN event_id % 7 IN (3, 4, 5) THEN event_id + 1 END AS notification_id,
  st AS orchestration_status, st AS current_step, ts AS started_at,
  CASE WHEN st IN ('COMPLETED', 'FAILED') THEN ts + INTERVAL 10 MINUTE END AS completed_at,
  CASE WHEN st = 'FAILED' THEN 'Invoice ' || invoice_number || ' was not found.' END AS error_message
FROM (SELECT *, CASE event_id % 7 WHEN 0 THEN 'STARTED' WHEN 1 THEN 'WAITING_APPROVAL'
        WHEN 2 THEN 'APPROVED' WHEN 3 THEN 'QUEUED' WHEN 4 THEN 'PROCESSING'
        WHEN 5 THEN 'COMPLETED' ELSE 'FAILED' END AS st FROM ev)"""

CTES["act"] = """
SELECT event_id AS activity_id, conversation_id, ts AS activity_time, activity_type,
  CASE WHEN activity_type = 'USER_MESSAGE' THEN 'question ' || CAST(k AS VARCHAR) END AS user_question,
  CASE WHEN activity_type = 'TOOL_CALL' AND k % 3 = 0 THEN 'get_invoice_details'
       WHEN activity_type = 'TOOL_CALL' THEN 'get_overdue_invoices' END AS tool_name,
  CASE WHEN activity_type = 'TOOL_CALL' AND k % 3 <> 0 THEN CAST(k AS BIGINT) END AS customer_id,
  CASE WHEN activity_type = 'TOOL_CALL' AND k % 3 = 0 THEN invoice_number END AS invoice_number,
  CASE WHEN activity_type = 'TOOL_CALL' THEN k END AS records_returned,
  CASE WHEN activity_type = 'AGENT_RESPONSE' THEN 'answer ' || CAST(k AS VARCHAR) END AS agent_response,
  CASE WHEN activity_type = 'ERROR' THEN repeat('error text ', 400 + k) END AS error_message
FROM (SELECT *, CASE event_type WHEN 'view' THEN 'USER_MESSAGE' WHEN 'click' THEN 'TOOL_CALL'
        WHEN 'purchase' THEN 'AGENT_RESPONSE' WHEN 'error' THEN 'ERROR'
        ELSE CASE WHEN k % 2 = 0 THEN 'SESSION_END' ELSE 'MEMORY_CLEAR' END END AS activity_type FROM ev)"""

CTES["msg"] = """
SELECT conv_id, turn, role,
  CASE turn % 6 WHEN 1 THEN 'which one ' || text WHEN 2 THEN 'request reminder ' || CAST(conv_id AS VARCHAR)
    WHEN 3 THEN 'clear' WHEN 4 THEN 'approve ' || CAST(turn AS VARCHAR) ELSE text END AS text
FROM conversations"""


CTES["log"] = """
SELECT activity_id, conversation_id, activity_time, activity_type, user_question, tool_name,
  CASE WHEN customer_id IS NOT NULL THEN '{"customer_id":' || CAST(customer_id AS VARCHAR) || '}'
       WHEN invoice_number IS NOT NULL THEN '{"invoice_number":"' || invoice_number || '"}' END AS tool_arguments,
  records_returned, agent_response,
  CASE WHEN activity_type = 'ERROR' THEN 'FAILED' ELSE 'SUCCESS' END AS execution_status,
  error_message, customer_id, invoice_number
FROM act"""

CTES["conv"] = """
SELECT conversation_id, min(activity_time) AS started_at,
  coalesce(max(CASE WHEN activity_type = 'SESSION_END' THEN activity_time END), max(activity_time)) AS ended_at,
  CASE WHEN bool_or(activity_type = 'SESSION_END') THEN 'COMPLETED' ELSE 'ERROR' END AS conversation_status,
  'SYSTEM' AS created_by
FROM log GROUP BY conversation_id"""

CTES["said"] = """
SELECT *, regexp_replace(lower(text), '^\\s+|\\s+$', '', 'g') AS line,
  regexp_replace(text, '^\\s+|\\s+$', '', 'g') AS clean FROM msg WHERE role = 'user'"""

CTES["typed_msg"] = """
SELECT *, CASE
    WHEN line = '' OR line IN ('context', 'approvals', 'outbox') THEN NULL
    WHEN line = 'exit' OR line = 'quit' THEN 'SESSION_END'
    WHEN line = 'clear' THEN 'MEMORY_CLEAR'
    WHEN starts_with(line, 'request reminder ') THEN 'APPROVAL_REQUEST'
    WHEN regexp_matches(line, '^(approve|reject) \\s*[+-]?[0-9]+$') THEN 'APPROVAL_DECISION'
    WHEN regexp_matches(line, '^execute \\s*[+-]?[0-9]+$') THEN 'ACTION_EXECUTION'
    WHEN regexp_matches(line, '^(approve|reject|execute) ') THEN NULL
    ELSE 'USER_MESSAGE' END AS activity_type,
  CASE WHEN starts_with(line, 'request reminder ') THEN trim(substr(clean, 18))
       WHEN regexp_matches(line, '^(approve|reject|execute) \\s*[+-]?[0-9]+$')
       THEN CAST(CAST(regexp_extract(line, '[+-]?[0-9]+$') AS BIGINT) AS VARCHAR) END AS argument
FROM said"""


def _mentions(sql):
    return set(re.findall(r"(?:FROM|JOIN)\s+([a-z_0-9]+)", sql))


def with_tables(sql: str) -> str:
    """`sql` preceded by the shared CTEs it needs; it may start with CTEs of its own."""
    needed, todo = set(), _mentions(sql) & CTES.keys()
    while todo:
        name = todo.pop()
        needed.add(name)
        todo |= (_mentions(CTES[name]) & CTES.keys()) - needed
    if not needed:
        return sql
    shared = ",\n".join(f"{n} AS ({CTES[n]})" for n in CTES if n in needed)
    body = sql.strip()
    if body[:5].upper() == "WITH ":
        return f"WITH {shared},\n{body[5:]}"
    return f"WITH {shared}\n{body}"


def money(expr: str, name: str) -> str:
    """A two-decimal amount as a double, the form both engines are compared in."""
    return f"CAST(CAST({expr} AS DECIMAL(18,2)) AS DOUBLE) AS {name}"


def cols(text: str) -> str:
    return ", ".join(text.split())

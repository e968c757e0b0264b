"""Oracles for the workflow transitions and checks."""

from oracles.core import cols

SQL = {}
NOW = "timestamp '2024-01-15 12:00:00'"
LATER, UNKNOWN = 10**10, 10**12

APPR = cols("""approval_id conversation_id requested_at requested_by action_type action_description
  action_payload approval_status reviewed_at reviewed_by review_comments executed_at execution_status
  execution_message""")
BOX = cols("""notification_id approval_id conversation_id notification_type recipient_address subject_text
  message_body notification_status retry_count max_retry_count next_retry_at created_at processed_at updated_at
  error_message failure_reason dead_at""")
RUNS = cols("""orchestration_id invoice_number approval_id notification_id orchestration_status current_step
  started_at completed_at error_message""")


def recipients(requests, status_first, invoices="inv"):
    """CTE `res`: requests with contact and reason."""
    inactive = "WHEN upper(status) = 'INACTIVE' THEN 'CUSTOMER_INACTIVE'"
    address = """WHEN email IS NULL OR email = '' THEN 'NO_EMAIL' WHEN trim(email) = '' THEN 'BLANK_EMAIL'"""
    order = inactive + " " + address if status_first else address + " " + inactive
    return f"""
res0 AS (SELECT q.*, c.customer_id AS cid, c.customer_name, c.email, c.status, c.same
  FROM {requests} q LEFT JOIN (SELECT i.invoice_number AS inum, i.same, c.* FROM
    (SELECT invoice_number, arg_min(customer_id, invoice_id) AS customer_id, count(*) AS same FROM {invoices}
     GROUP BY invoice_number) i
    JOIN cust c ON c.customer_id = i.customer_id) c ON c.inum = q.invoice_number),
res AS (SELECT *, CASE why WHEN 'INVOICE_NOT_FOUND' THEN 'Invoice ' || invoice_number || ' was not found.'
    WHEN 'AMBIGUOUS_INVOICE' THEN 'Invoice number ' || invoice_number || ' belongs to ' || same || ' invoices.'
    WHEN 'CUSTOMER_INACTIVE' THEN 'Customer ' || cid || ' is INACTIVE.'
    WHEN 'NO_EMAIL' THEN 'Customer ' || cid || ' does not have an email address.'
    WHEN 'BLANK_EMAIL' THEN 'Customer ' || cid || ' does not have a usable email address.' END AS txt
  FROM (SELECT *, CASE WHEN cid IS NULL THEN 'INVOICE_NOT_FOUND' WHEN same > 1 THEN 'AMBIGUOUS_INVOICE' {order} END AS why FROM res0))"""


RUN_REQUESTS = "wanted AS (SELECT event_id AS request_id, invoice_number FROM ev)"

for key, first in (("resolve_recipients", True), ("resolve_recipients_address_first", False)):
    SQL[key] = f"""
WITH {RUN_REQUESTS}, {recipients('wanted', first)}
SELECT request_id, invoice_number, cid AS customer_id, customer_name,
  CASE WHEN why IS NULL THEN trim(email) END AS recipient_address, why AS reason, txt AS message FROM res"""

SQL["resolve_recipients_ambiguous"] = f"""
WITH {RUN_REQUESTS}, twice AS (SELECT invoice_id, invoice_number, customer_id FROM inv
  UNION ALL SELECT -invoice_id, invoice_number, customer_id FROM inv WHERE customer_id % 7 = 0),
{recipients('wanted', True, 'twice')}
SELECT request_id, invoice_number, cid AS customer_id, customer_name,
  CASE WHEN why IS NULL THEN trim(email) END AS recipient_address, why AS reason, txt AS message FROM res"""

# ---- approvals -----------------------------------------------------------------------------
REMIND = """
rq AS (SELECT event_id, conversation_id, 'user-' || user_id AS requested_by, invoice_number,
    (SELECT max(approval_id) FROM appr) + row_number() OVER (ORDER BY event_id) AS approval_id
  FROM ev WHERE event_id % 28 <> 0)"""
SQL["request_reminders"] = f"""
WITH {REMIND}
SELECT {APPR} FROM appr
UNION ALL SELECT approval_id, conversation_id, {NOW}, requested_by, 'SEND_PAYMENT_REMINDER',
  'Send a payment reminder for invoice ' || invoice_number || '.',
  '{{"invoice_number":"' || invoice_number || '","channel":"EMAIL"}}', 'PENDING',
  NULL, NULL, NULL, NULL, NULL, NULL FROM rq"""


def event(kind, tool, arguments, source, conversation="conversation_id", response="NULL"):
    return f"""SELECT {conversation} AS conversation_id, {NOW} AS activity_time, '{kind}' AS activity_type,
  CAST(NULL AS VARCHAR) AS user_question, {tool} AS tool_name, {arguments} AS tool_arguments,
  CAST(NULL AS INTEGER) AS records_returned, CAST({response} AS VARCHAR) AS agent_response,
  'SUCCESS' AS execution_status, CAST(NULL AS VARCHAR) AS error_message FROM {source}"""


SQL["request_reminders_events"] = f"WITH {REMIND} " + event(
    "APPROVAL_REQUEST", "'SEND_PAYMENT_REMINDER'",
    "'{\"invoice_number\":\"' || invoice_number || '\",\"approval_id\":' || approval_id || '}'", "rq",
)

DECIDE = f"""
dec AS (
  SELECT event_id AS decision_id, event_id AS approval_id, CASE WHEN k % 10 = 4 THEN 'MAYBE'
    WHEN k % 2 = 1 THEN ' approved ' ELSE 'REJECTED' END AS decision, 'comment ' || k AS comments
  FROM ev
  UNION ALL SELECT event_id + {LATER}, event_id, 'REJECTED', 'comment ' || k FROM ev WHERE event_id % 6 = 0
  UNION ALL SELECT event_id + {2 * LATER}, event_id + {UNKNOWN}, 'APPROVED', 'comment ' || k FROM ev
    WHERE event_id % 30 = 3),
dec2 AS (SELECT *, upper(trim(decision)) AS word, upper(trim(decision)) IN ('APPROVED', 'REJECTED') AS ok FROM dec),
win AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY approval_id ORDER BY decision_id) AS r
    FROM dec2 WHERE ok) WHERE r = 1)"""
SQL["decide_approvals"] = f"""
WITH {DECIDE}
SELECT a.approval_id, conversation_id, requested_at, requested_by, action_type, action_description, action_payload,
  CASE WHEN hit THEN w.word ELSE approval_status END AS approval_status,
  CASE WHEN hit THEN {NOW} ELSE reviewed_at END AS reviewed_at,
  CASE WHEN hit THEN 'AR_MANAGER' ELSE reviewed_by END AS reviewed_by,
  CASE WHEN hit THEN w.comments ELSE review_comments END AS review_comments,
  executed_at, execution_status, execution_message
FROM (SELECT a.*, approval_status = 'PENDING' AND approval_id IN (SELECT approval_id FROM win) AS hit FROM appr a) a
LEFT JOIN win w ON w.approval_id = a.approval_id"""
SQL["decide_approvals_rejects"] = f"""
WITH {DECIDE}
SELECT * FROM (SELECT d.decision_id, d.approval_id, d.decision,
  CASE WHEN NOT d.ok THEN 'INVALID_DECISION' WHEN a.approval_id IS NULL THEN 'NOT_FOUND'
       WHEN a.approval_status <> 'PENDING' THEN 'NOT_PENDING'
       WHEN d.decision_id <> w.decision_id THEN 'ALREADY_DECIDED' END AS reason,
  CASE WHEN NOT d.ok THEN 'Decision must be APPROVED or REJECTED.'
       WHEN a.approval_id IS NULL THEN 'Approval request ' || d.approval_id || ' was not found.'
       WHEN a.approval_status <> 'PENDING' THEN a.approval_status END AS message
FROM dec2 d LEFT JOIN appr a ON a.approval_id = d.approval_id LEFT JOIN win w ON w.approval_id = d.approval_id)
WHERE reason IS NOT NULL"""
DECIDED = """decided AS (SELECT a.approval_id, a.conversation_id, w.word FROM appr a
  JOIN win w ON w.approval_id = a.approval_id WHERE a.approval_status = 'PENDING')"""
SQL["append_activity_events"] = f"""
WITH {DECIDE}, {DECIDED}, evs AS ({event(
    "APPROVAL_DECISION", "CASE WHEN word = 'APPROVED' THEN 'APPROVE_REQUEST' ELSE 'REJECT_REQUEST' END",
    "'{\"approval_id\":' || approval_id || ',\"decision\":\"' || word || '\"}'", "decided")})
SELECT * EXCLUDE (customer_id, invoice_number) FROM log
UNION ALL BY NAME SELECT (SELECT max(activity_id) FROM log)
  + row_number() OVER (ORDER BY activity_time, conversation_id, activity_type, tool_arguments) AS activity_id, * FROM evs"""


def executions(form):
    plain = "WHEN 1 = 0 THEN NULL" if form != "recipient" else "WHEN r.why IS NOT NULL THEN r.why"
    twice = "" if form == "message" else "WHEN b.notification_id IS NOT NULL THEN 'DUPLICATE_NOTIFICATION'"
    return f"""
ex AS (SELECT event_id AS request_id, event_id AS approval_id FROM ev
  UNION ALL SELECT event_id + {LATER}, event_id FROM ev WHERE event_id % 10 = 1
  UNION ALL SELECT event_id + {2 * LATER}, event_id + {UNKNOWN} FROM ev WHERE event_id % 50 = 0),
one AS (SELECT e.approval_id AS aid, e.first, a.*, a.wanted_invoice AS invoice_number
  FROM (SELECT approval_id, min(request_id) AS first FROM ex GROUP BY approval_id) e
  LEFT JOIN appr a ON a.approval_id = e.approval_id),
{recipients('one', True)},
judged AS (SELECT r.*, b.notification_id AS existing,
    CASE WHEN r.approval_id IS NULL THEN 'NOT_FOUND' WHEN approval_status <> 'APPROVED' THEN 'NOT_APPROVED'
      WHEN action_type <> 'SEND_PAYMENT_REMINDER' THEN 'UNSUPPORTED_ACTION' {plain} {twice} END AS reason
  FROM res r LEFT JOIN box b ON b.approval_id = r.aid),
good_ex AS (SELECT *, (SELECT max(notification_id) FROM box) + row_number() OVER (ORDER BY aid) AS nid
  FROM judged WHERE reason IS NULL)"""


def new_box(body, address, status="'PENDING'", processed="NULL"):
    return f"""SELECT nid, aid, conversation_id, 'PAYMENT_REMINDER', {address},
  'Payment Reminder - Invoice ' || invoice_number, {body}, {status}, 0, 3, NULL, {NOW}, {processed}, {NOW},
  NULL, NULL, NULL"""


BODY = """'Hello ' || customer_name || ',' || chr(10) || chr(10) || 'This is a payment reminder for invoice '
  || invoice_number || '. Please review the outstanding balance and arrange payment.' || chr(10) || chr(10) || 'Thank you.'"""
PLAIN = """'This is a payment reminder for invoice ' || invoice_number
  || '. Please review the outstanding balance and arrange payment.'"""


def executed(message):
    return f"""SELECT a.approval_id, a.conversation_id, a.requested_at, a.requested_by, a.action_type,
  a.action_description, a.action_payload,
  CASE WHEN g.aid IS NOT NULL THEN 'EXECUTED' ELSE a.approval_status END AS approval_status, a.reviewed_at,
  a.reviewed_by, a.review_comments, CASE WHEN g.aid IS NOT NULL THEN {NOW} ELSE a.executed_at END AS executed_at,
  CASE WHEN g.aid IS NOT NULL THEN 'SUCCESS' ELSE a.execution_status END AS execution_status,
  CASE WHEN g.aid IS NOT NULL THEN {message} ELSE a.execution_message END AS execution_message
FROM appr a LEFT JOIN good_ex g ON g.aid = a.approval_id"""


SQL["execute_approved"] = f"WITH {executions('recipient')} " + executed(
    "'Payment reminder for invoice ' || g.invoice_number || ' was queued. Recipient: ' || trim(g.email) "
    "|| '. Notification ID: ' || g.nid || '. Status: PENDING.'"
)
SQL["execute_approved_outbox"] = f"""
WITH {executions('recipient')}
SELECT {BOX} FROM box UNION ALL {new_box(BODY, 'trim(email)')} FROM good_ex"""
SQL["execute_approved_plain"] = f"""
WITH {executions('plain')}
SELECT {BOX} FROM box UNION ALL {new_box(PLAIN, 'NULL')} FROM good_ex"""
SQL["execute_approved_message"] = f"WITH {executions('message')} " + executed(
    "'Payment reminder simulation completed for invoice ' || g.invoice_number || '.'"
)
SQL["execute_approved_rejects"] = f"""
WITH {executions('recipient')}
SELECT * FROM (SELECT e.request_id, e.approval_id,
  CASE WHEN j.reason IS NULL AND e.request_id <> j.first THEN 'NOT_APPROVED' ELSE j.reason END AS reason,
  CASE WHEN j.reason IS NULL AND e.request_id <> j.first
       THEN 'Approval request ' || e.approval_id || ' is EXECUTED, not APPROVED.'
    WHEN j.reason = 'NOT_FOUND' THEN 'Approval request ' || e.approval_id || ' was not found.'
    WHEN j.reason = 'NOT_APPROVED' THEN 'Approval request ' || e.approval_id || ' is ' || j.approval_status || ', not APPROVED.'
    WHEN j.reason = 'UNSUPPORTED_ACTION' THEN 'Unsupported action type: ' || j.action_type
    WHEN j.reason = 'DUPLICATE_NOTIFICATION'
      THEN 'Approval request ' || e.approval_id || ' already has notification ' || j.existing || '.'
    ELSE j.txt END AS message
FROM ex e JOIN judged j ON j.aid = e.approval_id) WHERE reason IS NOT NULL"""

# ---- notifications ---------------------------------------------------------------------------
READY = f"""(notification_status = 'PENDING' OR (notification_status = 'RETRY' AND next_retry_at <= {NOW}))
  AND retry_count < max_retry_count"""


def claimed(condition):
    return f"""SELECT * EXCLUDE (k, hit) REPLACE (
  CASE WHEN hit THEN 'PROCESSING' ELSE notification_status END AS notification_status,
  CASE WHEN hit THEN {NOW} ELSE updated_at END AS updated_at,
  CASE WHEN hit THEN NULL ELSE error_message END AS error_message)
FROM (SELECT *, coalesce({condition}, false) AS hit FROM box)"""


SQL["claim_notifications"] = claimed(READY)
SQL["claim_notifications_simple"] = claimed("notification_status = 'PENDING'")
SQL["claim_notifications_oldest"] = claimed(
    f"notification_id IN (SELECT notification_id FROM box WHERE {READY} ORDER BY created_at, notification_id LIMIT 25)"
)

TRIES = f"""
att AS (SELECT notification_id AS attempt_id, notification_id, CASE WHEN k % 9 = 0 THEN repeat('timeout ', 600)
    WHEN k % 2 = 1 THEN 'Recipient address is missing.' END AS error FROM box
  UNION ALL SELECT notification_id + {LATER}, notification_id, NULL FROM box WHERE k % 5 = 0
  UNION ALL SELECT notification_id + {2 * LATER}, notification_id + {UNKNOWN}, NULL FROM box WHERE k = 1),
won AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY notification_id ORDER BY attempt_id) AS r FROM att)
  WHERE r = 1)"""


def settled(source, tries="won"):
    return f"""SELECT * EXCLUDE (sent, bad, dead, attempt_id, error) REPLACE (
  CASE WHEN sent THEN 'SENT' WHEN dead THEN 'DEAD' WHEN bad THEN 'RETRY' ELSE notification_status END AS notification_status,
  CASE WHEN bad THEN retry_count + 1 ELSE retry_count END AS retry_count,
  CASE WHEN sent OR dead THEN {NOW} ELSE processed_at END AS processed_at,
  CASE WHEN sent OR bad THEN {NOW} ELSE updated_at END AS updated_at,
  CASE WHEN sent OR dead THEN NULL WHEN bad THEN {NOW} + INTERVAL 1 MINUTE ELSE next_retry_at END AS next_retry_at,
  CASE WHEN sent THEN NULL WHEN dead THEN 'Maximum retry count reached.' WHEN bad THEN 'Notification delivery failed.'
       ELSE failure_reason END AS failure_reason,
  CASE WHEN sent THEN NULL WHEN bad THEN error ELSE error_message END AS error_message,
  CASE WHEN dead THEN {NOW} ELSE dead_at END AS dead_at)
FROM (SELECT *, bad AND retry_count + 1 >= max_retry_count AS dead FROM (
  SELECT b.*, w.attempt_id, w.error,
    b.notification_status = 'PROCESSING' AND w.attempt_id IS NOT NULL AND w.error IS NULL AS sent,
    b.notification_status = 'PROCESSING' AND w.error IS NOT NULL AS bad
  FROM {source} b LEFT JOIN {tries} w ON w.notification_id = b.notification_id))"""


SQL["apply_delivery_results"] = f"WITH {TRIES}, b0 AS (SELECT {BOX} FROM box) " + settled("b0")
SQL["apply_delivery_results_final"] = f"""
WITH {TRIES}
SELECT * EXCLUDE (tried, error) REPLACE (
  CASE WHEN tried AND error IS NULL THEN 'SENT' WHEN tried THEN 'FAILED' ELSE notification_status END AS notification_status,
  CASE WHEN tried AND error IS NOT NULL THEN retry_count + 1 ELSE retry_count END AS retry_count,
  CASE WHEN tried THEN {NOW} ELSE processed_at END AS processed_at,
  CASE WHEN tried THEN {NOW} ELSE updated_at END AS updated_at,
  CASE WHEN tried THEN error ELSE error_message END AS error_message)
FROM (SELECT {BOX}, error, notification_status = 'PROCESSING' AND attempt_id IS NOT NULL AS tried
  FROM box LEFT JOIN (SELECT notification_id AS wid, attempt_id, error FROM won) ON wid = notification_id
  )"""
SQL["apply_delivery_results_rejects"] = f"""
WITH {TRIES}
SELECT * FROM (SELECT a.attempt_id, a.notification_id,
  CASE WHEN b.notification_id IS NULL THEN 'NOT_FOUND' WHEN b.notification_status <> 'PROCESSING' THEN 'NOT_PROCESSING'
       WHEN a.attempt_id <> w.attempt_id THEN 'ALREADY_SETTLED' END AS reason,
  CASE WHEN b.notification_id IS NULL THEN 'Notification ' || a.notification_id || ' was not found.'
       WHEN b.notification_status <> 'PROCESSING' THEN b.notification_status END AS message
FROM att a LEFT JOIN box b ON b.notification_id = a.notification_id
LEFT JOIN won w ON w.notification_id = a.notification_id) WHERE reason IS NOT NULL"""
SQL["delivery_round"] = f"WITH {TRIES}, cl AS ({claimed(READY)}) " + settled("cl")

RQ = f"""
rqs AS (SELECT notification_id AS request_id, notification_id, CASE WHEN k % 2 = 0 THEN 'reason ' || k END AS recovery_reason
    FROM box
  UNION ALL SELECT notification_id + {LATER}, notification_id, CASE WHEN k % 2 = 0 THEN 'reason ' || k END
    FROM box WHERE k % 6 = 0
  UNION ALL SELECT notification_id + {2 * LATER}, notification_id + {UNKNOWN}, NULL FROM box WHERE k = 3),
hits AS (SELECT b.notification_id, b.notification_status AS was, min(q.request_id) AS req
  FROM box b JOIN rqs q ON q.notification_id = b.notification_id
  WHERE b.notification_status IN ('DEAD', 'FAILED', 'RETRY') GROUP BY b.notification_id, b.notification_status)"""
SQL["requeue"] = f"""
WITH {RQ}
SELECT {BOX} FROM box WHERE notification_id NOT IN (SELECT notification_id FROM hits)
UNION ALL SELECT notification_id, approval_id, conversation_id, notification_type, recipient_address, subject_text,
  message_body, 'PENDING', 0, max_retry_count, NULL, created_at, NULL, {NOW}, NULL, NULL, NULL
FROM box WHERE notification_id IN (SELECT notification_id FROM hits)"""
SQL["requeue_log"] = f"""
WITH {RQ}
SELECT * FROM rec UNION ALL SELECT (SELECT max(recovery_id) FROM rec) + row_number() OVER (ORDER BY h.notification_id),
  h.notification_id, h.was, 'PENDING', 'OPERATOR',
  coalesce(q.recovery_reason, 'Manual recovery from notification console.'), {NOW}
FROM hits h JOIN rqs q ON q.request_id = h.req"""
SQL["requeue_rejects"] = f"""
WITH {RQ}
SELECT q.request_id, q.notification_id,
  CASE WHEN b.notification_id IS NULL THEN 'NOT_FOUND' ELSE 'NOT_RECOVERABLE' END AS reason,
  CASE WHEN b.notification_id IS NULL THEN 'Notification ' || q.notification_id || ' was not found.'
    ELSE 'Notification ' || q.notification_id || ' is '
      || CASE WHEN h.req IS NULL THEN b.notification_status ELSE 'PENDING' END
      || '. Only DEAD, FAILED, or RETRY notifications can be requeued.' END AS message
FROM rqs q LEFT JOIN box b ON b.notification_id = q.notification_id
LEFT JOIN hits h ON h.notification_id = q.notification_id
WHERE h.req IS NULL OR h.req <> q.request_id"""

# ---- orchestration ---------------------------------------------------------------------------
START = f"""
{RUN_REQUESTS}, {recipients('wanted', False)},
started AS (SELECT *, (SELECT max(orchestration_id) FROM runs) + row_number() OVER (ORDER BY request_id) AS rid FROM res),
fine AS (SELECT *, (SELECT max(approval_id) FROM appr) + row_number() OVER (ORDER BY rid) AS aid,
    sha256('orchestration-' || rid) AS h FROM started WHERE why IS NULL),
fine2 AS (SELECT *, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' || substr(h, 17, 4)
    || '-' || substr(h, 21, 12) AS cv FROM fine)"""
SQL["start_orchestrations"] = f"""
WITH {START}
SELECT {RUNS} FROM runs
UNION ALL SELECT rid, invoice_number, aid, NULL, 'WAITING_APPROVAL', 'WAITING_APPROVAL', {NOW}, NULL, NULL FROM fine2
UNION ALL SELECT rid, invoice_number, NULL, NULL, 'FAILED', 'FAILED', {NOW}, {NOW}, txt FROM started WHERE why IS NOT NULL"""
SQL["start_orchestrations_approvals"] = f"""
WITH {START}
SELECT {APPR} FROM appr UNION ALL SELECT aid, cv, {NOW}, 'SYSTEM', 'SEND_PAYMENT_REMINDER',
  'Send a payment reminder for invoice ' || invoice_number || '.',
  '{{"invoice_number":"' || invoice_number || '","channel":"EMAIL"}}', 'PENDING', NULL, NULL, NULL, NULL, NULL, NULL
FROM fine2"""
SQL["start_orchestrations_conversations"] = f"""
WITH {START}
SELECT * FROM conv UNION ALL SELECT cv, {NOW}, NULL, 'ACTIVE', 'SYSTEM' FROM fine2"""

COMPLETE = f"""
ids AS (SELECT DISTINCT oid FROM (SELECT event_id AS oid FROM ev
  UNION ALL SELECT event_id + {UNKNOWN} FROM ev WHERE event_id % 40 = 0)),
joined AS (SELECT i.oid, r.* FROM ids i LEFT JOIN runs r ON r.orchestration_id = i.oid),
{recipients('joined', False)},
verdict AS (SELECT r.* EXCLUDE (approval_id), r.approval_id AS aid, a.conversation_id, b.notification_id AS existing,
    CASE WHEN r.orchestration_id IS NULL THEN 'NOT_FOUND' WHEN orchestration_status <> 'WAITING_APPROVAL' THEN 'NOT_WAITING'
      WHEN why IS NOT NULL THEN why WHEN a.approval_status IS DISTINCT FROM 'PENDING' THEN 'APPROVAL_NOT_PENDING'
      WHEN b.notification_id IS NOT NULL THEN 'DUPLICATE_NOTIFICATION' END AS reason
  FROM res r LEFT JOIN appr a ON a.approval_id = r.approval_id LEFT JOIN box b ON b.approval_id = r.approval_id),
done AS (SELECT *, (SELECT max(notification_id) FROM box) + row_number() OVER (ORDER BY oid) AS nid
  FROM verdict WHERE reason IS NULL),
broke AS (SELECT *, CASE reason WHEN 'APPROVAL_NOT_PENDING' THEN 'Approval request could not be approved.'
    ELSE 'Approval request ' || aid || ' already has notification ' || existing || '.' END AS failure
  FROM verdict WHERE reason IN ('APPROVAL_NOT_PENDING', 'DUPLICATE_NOTIFICATION'))"""
SQL["complete_orchestrations"] = f"""
WITH {COMPLETE}
SELECT r.orchestration_id, r.invoice_number, r.approval_id, coalesce(d.nid, r.notification_id) AS notification_id,
  CASE WHEN d.oid IS NOT NULL THEN 'COMPLETED' WHEN f.oid IS NOT NULL THEN 'FAILED' ELSE r.orchestration_status END AS orchestration_status,
  CASE WHEN d.oid IS NOT NULL THEN 'COMPLETED' WHEN f.oid IS NOT NULL THEN 'FAILED' ELSE r.current_step END AS current_step,
  r.started_at, CASE WHEN d.oid IS NOT NULL OR f.oid IS NOT NULL THEN {NOW} ELSE r.completed_at END AS completed_at,
  CASE WHEN d.oid IS NOT NULL THEN NULL WHEN f.oid IS NOT NULL THEN f.failure ELSE r.error_message END AS error_message
FROM runs r LEFT JOIN done d ON d.oid = r.orchestration_id LEFT JOIN broke f ON f.oid = r.orchestration_id"""
SQL["complete_orchestrations_approvals"] = f"""
WITH {COMPLETE}
SELECT {APPR} FROM appr WHERE approval_id NOT IN (SELECT aid FROM done)
UNION ALL SELECT a.approval_id, a.conversation_id, requested_at, requested_by, action_type, action_description, action_payload,
  'EXECUTED', {NOW}, 'AR_MANAGER', 'Approved from Day 21 orchestrator.', {NOW}, 'SUCCESS',
  'Notification ' || d.nid || ' created by orchestrator.'
FROM appr a JOIN done d ON d.aid = a.approval_id"""
SQL["complete_orchestrations_outbox"] = f"""
WITH {COMPLETE}
SELECT {BOX} FROM box UNION ALL {new_box(BODY, 'trim(email)', "'SENT'", NOW)} FROM done"""
SQL["complete_orchestrations_steps"] = f"""
WITH {COMPLETE},
steps(step, orchestration_status, current_step) AS (VALUES (1, 'APPROVED', 'CREATE_OUTBOX'),
  (2, 'QUEUED', 'PROCESS_NOTIFICATION'), (3, 'PROCESSING', 'SEND_NOTIFICATION'), (4, 'COMPLETED', 'COMPLETED'))
SELECT d.oid AS orchestration_id, d.aid AS approval_id, d.nid AS notification_id, s.step, s.orchestration_status,
  s.current_step, {NOW} AS changed_at FROM done d CROSS JOIN steps s"""
SQL["complete_orchestrations_rejects"] = f"""
WITH {COMPLETE}
SELECT oid AS orchestration_id, reason, CASE reason WHEN 'NOT_FOUND' THEN 'Orchestration ' || oid || ' was not found.'
  WHEN 'NOT_WAITING' THEN 'Orchestration ' || oid || ' is ' || orchestration_status || ', not WAITING_APPROVAL.'
  WHEN 'APPROVAL_NOT_PENDING' THEN 'Approval request could not be approved.'
  WHEN 'DUPLICATE_NOTIFICATION' THEN 'Approval request ' || aid || ' already has notification ' || existing || '.'
  ELSE txt END AS message
FROM verdict WHERE reason IS NOT NULL"""

# ---- history ---------------------------------------------------------------------------------
CHANGES = """
ch AS (SELECT user_id AS entity_id, event_id AS change_id, ts AS changed_at, CASE event_type WHEN 'click' THEN 'PENDING'
    WHEN 'signup' THEN 'PROCESSING' WHEN 'purchase' THEN 'SENT' WHEN 'view' THEN 'RETRY'
    ELSE CASE WHEN k % 2 = 0 THEN 'DEAD' ELSE 'FAILED' END END AS status FROM ev),
hist AS (SELECT *, lag(status) OVER w AS previous_status, lead(changed_at) OVER w AS nxt FROM ch
  WINDOW w AS (PARTITION BY entity_id ORDER BY changed_at, change_id)),
marked AS (SELECT *, CASE WHEN previous_status IS NULL THEN NULL ELSE (previous_status, status) IN (
    ('PENDING', 'PROCESSING'), ('RETRY', 'PROCESSING'), ('PROCESSING', 'SENT'), ('PROCESSING', 'FAILED'),
    ('PROCESSING', 'RETRY'), ('PROCESSING', 'DEAD'), ('DEAD', 'PENDING'), ('FAILED', 'PENDING'),
    ('RETRY', 'PENDING')) END AS is_allowed FROM hist)"""
SQL["transition_history"] = f"""
WITH {CHANGES}
SELECT entity_id, change_id, changed_at, previous_status, status,
  CAST(epoch_us(nxt) - epoch_us(changed_at) AS DOUBLE) / 1000000 AS seconds_in_status, is_allowed FROM marked"""
SQL["illegal_transitions"] = f"""
WITH {CHANGES}
SELECT previous_status, status, count(*) AS jumps FROM marked WHERE NOT is_allowed GROUP BY previous_status, status"""


SQL["run_transition_history"] = """
WITH ch AS (SELECT user_id AS entity_id, event_id AS change_id, ts AS changed_at,
    ['STARTED', 'WAITING_APPROVAL', 'APPROVED', 'QUEUED', 'PROCESSING', 'COMPLETED', 'FAILED'][event_id % 7 + 1] AS status FROM ev),
hist AS (SELECT *, lag(status) OVER w AS previous_status, lead(changed_at) OVER w AS nxt FROM ch
  WINDOW w AS (PARTITION BY entity_id ORDER BY changed_at, change_id))
SELECT entity_id, change_id, changed_at, previous_status, status,
  CAST(epoch_us(nxt) - epoch_us(changed_at) AS DOUBLE) / 1000000 AS seconds_in_status,
  CASE WHEN previous_status IS NOT NULL THEN (previous_status, status) IN (
    ('STARTED', 'WAITING_APPROVAL'), ('STARTED', 'FAILED'), ('WAITING_APPROVAL', 'APPROVED'), ('WAITING_APPROVAL', 'FAILED'),
    ('APPROVED', 'QUEUED'), ('APPROVED', 'FAILED'), ('QUEUED', 'PROCESSING'), ('QUEUED', 'FAILED'),
    ('PROCESSING', 'COMPLETED'), ('PROCESSING', 'FAILED')) END AS is_allowed
FROM hist"""


# ---- checks ----------------------------------------------------------------------------------
def check(name, bad, text, source):
    return (
        f"SELECT '{name}' AS check_name, CASE WHEN n = 0 THEN 'PASS' ELSE '{bad}' END AS status, "
        f"n || ' {text}' AS message FROM (SELECT count(*) AS n FROM {source})"
    )


def integrity(invoices, customers):
    return [
        check("Negative Outstanding Balances", "FAIL", "invoice(s) found.", f"{invoices} WHERE outstanding_amount < 0"),
        check("Negative Amount Paid", "FAIL", "invoice(s) found.", f"{invoices} WHERE amount_paid < 0"),
        check("Outstanding > Invoice Amount", "FAIL", "invoice(s) found.",
              f"{invoices} WHERE outstanding_amount > invoice_amount"),
        check("Missing Due Dates", "WARNING", "invoice(s) found.", f"{invoices} WHERE due_date IS NULL"),
        check("Orphan Invoices", "FAIL", "invoice(s) without a valid customer.",
              f"{invoices} WHERE customer_id NOT IN (SELECT customer_id FROM {customers})"),
        check("Customers Without Email", "WARNING", "customer(s) found.",
              f"{customers} WHERE email IS NULL OR trim(email) = ''"),
    ]


WORK = [
    check("Stale STARTED Orchestrations", "WARNING", "stale orchestration(s) found.",
          f"runs WHERE orchestration_status = 'STARTED' AND started_at < {NOW} - INTERVAL 30 MINUTE"),
    check("Failed Orchestrations", "WARNING", "failed orchestration(s) found.",
          "runs WHERE orchestration_status = 'FAILED'"),
    check("Pending Approvals", "WARNING", "pending approval(s) found.", "appr WHERE approval_status = 'PENDING'"),
    check("Failed Notifications", "FAIL", "failed notification(s) found.", "box WHERE notification_status = 'FAILED'"),
    check("Stuck Notifications", "WARNING", "stuck notification(s) found.",
          f"box WHERE notification_status = 'PROCESSING' AND updated_at < {NOW} - INTERVAL 30 MINUTE"),
]
UNION = "\nUNION ALL "
SQL["integrity_checks"] = """
WITH i1 AS (SELECT invoice_id, customer_id, invoice_amount, amount_paid,
    CASE WHEN invoice_id % 90 = 0 THEN -invoice_amount WHEN invoice_id % 91 = 0 THEN invoice_amount + 1
         ELSE outstanding_amount END AS outstanding_amount,
    CASE WHEN invoice_id % 70 <> 0 THEN due_date END AS due_date FROM inv),
c1 AS (SELECT * REPLACE (CASE WHEN customer_id % 50 = 1 THEN -customer_id ELSE customer_id END AS customer_id) FROM cust)
""" + UNION.join(integrity("i1", "c1"))
SQL["workflow_checks"] = UNION.join(WORK)

OBJECTS = """CUSTOMERS INVOICES AGENT_CONVERSATIONS AGENT_APPROVAL_REQUESTS AGENT_NOTIFICATION_OUTBOX
  AGENT_ORCHESTRATION_RUNS VW_AR_AGING_DETAIL""".split()
PRESENT = [
    f"SELECT '{o}' AS check_name, 'PASS' AS status, 'Required {'view' if o[:3] == 'VW_' else 'table'} exists.' AS message"
    for o in OBJECTS
]
SOURCES = "cust inv conv appr box runs aging".split()
SQL["schema_checks"] = UNION.join(
    f"{present}, (SELECT count(*) FROM {source}) AS row_count" for present, source in zip(PRESENT, SOURCES)
    if source != "runs"
) + UNION + "SELECT 'AGENT_ORCHESTRATION_RUNS', 'FAIL', 'Required table is missing.', NULL"
ALL = UNION.join(
    PRESENT + integrity("inv", "cust") + WORK
)
SQL["all_checks"] = ALL
SQL["readiness_report"] = f"""
SELECT total_checks, passed, warnings, failed,
  CASE WHEN failed > 0 THEN 'FAIL' WHEN warnings > 0 THEN 'WARNING' ELSE 'PASS' END AS overall_status,
  round(passed / total_checks * 100, 1) AS readiness_score
FROM (SELECT count(*) AS total_checks, count(CASE WHEN status = 'PASS' THEN 1 END) AS passed,
  count(CASE WHEN status = 'WARNING' THEN 1 END) AS warnings, count(CASE WHEN status = 'FAIL' THEN 1 END) AS failed
FROM ({ALL}))"""

# ---- the same steps on stored tables ---------------------------------------------------------
for name in (
    "request_reminders decide_approvals decide_approvals_rejects execute_approved execute_approved_outbox "
    "apply_delivery_results requeue requeue_log start_orchestrations complete_orchestrations "
    "complete_orchestrations_approvals complete_orchestrations_outbox"
).split():
    SQL[f"stored_{name}"] = SQL[name]

"""Oracles for table rules, indicators and operations reports."""

from oracles.core import cols, money

SQL = {}

# ---- table rules: defects are planted in the same way as in the query --------------------
DAMAGED = """
WITH c1 AS (SELECT * REPLACE (CASE WHEN customer_id % 50 = 1 THEN -customer_id ELSE customer_id END AS customer_id),
    'LOW' AS risk_category, 10000 AS credit_limit FROM cust),
i0 AS (SELECT invoice_id, invoice_number, customer_id, 1 AS payment_term_id, invoice_date, amount_paid, outstanding_amount,
    CASE WHEN invoice_id % 110 = 0 THEN 10000000000 ELSE invoice_amount END AS invoice_amount,
    CASE WHEN invoice_id % 100 = 0 THEN 'LATE' ELSE invoice_status END AS invoice_status,
    CASE WHEN invoice_id % 150 = 0 THEN 'X' ELSE 'N' END AS dispute_flag,
    CASE WHEN invoice_id % 70 <> 0 THEN due_date END AS due_date FROM inv),
i1 AS (SELECT * FROM i0 UNION ALL SELECT * FROM i0 WHERE invoice_id % 500 = 0),
l1 AS (SELECT invoice_line_id, invoice_id, product_code, unit_price, line_amount,
    CASE WHEN invoice_line_id % 90 <> 0 THEN quantity ELSE 0 END AS quantity,
    CASE WHEN invoice_line_id % 80 = 0 THEN repeat(description, 50) ELSE description END AS description FROM lines),
p1 AS (SELECT payment_id, payment_date, payment_method, reference_number,
    CASE WHEN payment_id % 40 <> 0 THEN payment_amount ELSE 0 END AS payment_amount,
    CASE WHEN payment_id % 60 <> 0 THEN invoice_id ELSE -1 END AS invoice_id FROM pay),
t1 AS (SELECT 1 AS payment_term_id, 'NET 30' AS term_name, 30 AS due_days),
v1 AS (SELECT * REPLACE (CASE conversation_id WHEN 'conv-7' THEN 'conv-seven' ELSE conversation_id END AS conversation_id)
       FROM conv),
g1 AS (SELECT * REPLACE (error_message || '!' AS error_message) FROM log),
a1 AS (SELECT * REPLACE (CASE WHEN approval_id % 33 = 0 THEN 'LOST' ELSE approval_status END AS approval_status,
         CASE WHEN approval_id % 50 = 4 THEN approval_id + 1000000000000 ELSE approval_id END AS approval_id)
       FROM appr),
o1 AS (SELECT * FROM box), r1 AS (SELECT * FROM rec), n1 AS (SELECT * FROM runs)
"""

_TABLE = {
    "c1": "customers", "t1": "payment_terms", "i1": "invoices", "l1": "invoice_lines", "p1": "payments",
    "v1": "agent_conversations", "g1": "agent_activity_log", "a1": "agent_approval_requests",
    "o1": "agent_notification_outbox", "r1": "agent_notification_recovery_log",
    "n1": "agent_orchestration_runs",
}


def _count(t, rule, condition):
    return (
        f"SELECT '{_TABLE[t]}' AS table_name, '{rule}' AS rule, count(*) AS violations FROM {t} WHERE {condition}"
    )


def _violations():
    out = []
    required = {
        "c1": "customer_id customer_name",
        "t1": "payment_term_id term_name due_days",
        "i1": "invoice_id invoice_number customer_id payment_term_id invoice_date due_date invoice_amount",
        "l1": "invoice_line_id invoice_id quantity unit_price line_amount",
        "p1": "payment_id invoice_id payment_date payment_amount",
        "v1": "conversation_id started_at conversation_status created_by",
        "g1": "activity_id conversation_id activity_time activity_type execution_status",
        "a1": "approval_id conversation_id requested_at requested_by action_type action_description approval_status",
        "o1": "notification_id approval_id conversation_id notification_type notification_status retry_count "
        "max_retry_count created_at",
        "r1": "recovery_id notification_id previous_status new_status recovered_by recovered_at",
        "n1": "orchestration_id invoice_number orchestration_status started_at",
    }
    for t, names in required.items():
        out += [_count(t, f"{c} NOT NULL", f"{c} IS NULL") for c in names.split()]
    words = [
        ("c1", "status", "ACTIVE INACTIVE BLOCKED"), ("c1", "risk_category", "LOW MEDIUM HIGH"),
        ("i1", "invoice_status", "OPEN PARTIALLY_PAID PAID OVERDUE CANCELLED"), ("i1", "dispute_flag", "Y N"),
        ("v1", "conversation_status", "ACTIVE COMPLETED ERROR"),
        ("g1", "activity_type", "USER_MESSAGE TOOL_CALL AGENT_RESPONSE ERROR MEMORY_CLEAR SESSION_END "
         "APPROVAL_REQUEST APPROVAL_DECISION ACTION_EXECUTION"),
        ("g1", "execution_status", "SUCCESS FAILED"), ("a1", "execution_status", "SUCCESS FAILED"),
        ("a1", "approval_status", "PENDING APPROVED REJECTED CANCELLED EXECUTED"),
        ("o1", "notification_status", "PENDING PROCESSING SENT FAILED RETRY DEAD"),
        ("r1", "previous_status", "DEAD FAILED RETRY"), ("r1", "new_status", "PENDING"),
        ("n1", "orchestration_status", "STARTED WAITING_APPROVAL APPROVED QUEUED PROCESSING COMPLETED FAILED"),
    ]
    for t, c, allowed in words:
        listed = ", ".join(f"'{w}'" for w in allowed.split())
        out.append(_count(t, f"{c} allowed values", f"{c} NOT IN ({listed})"))
    for t, c, bad in [("t1", "due_days", "<= 0"), ("l1", "quantity", "<= 0"), ("l1", "unit_price", "< 0"),
                      ("l1", "line_amount", "< 0"), ("p1", "payment_amount", "<= 0")]:
        out.append(_count(t, f"{c} minimum", f"{c} {bad}"))
    for t, names in [("c1", "credit_limit current_balance"), ("i1", "invoice_amount amount_paid outstanding_amount"),
                     ("l1", "unit_price line_amount"), ("p1", "payment_amount")]:
        out += [_count(t, f"{c} precision", f"abs({c}) > 9999999999.99") for c in names.split()]
    for t, c, n in [
        ("c1", "customer_name", 150), ("c1", "email", 150), ("i1", "invoice_number", 50),
        ("l1", "product_code", 50), ("l1", "description", 200), ("p1", "payment_method", 30),
        ("p1", "reference_number", 100), ("v1", "conversation_id", 36), ("g1", "user_question", 4000),
        ("g1", "error_message", 4000), ("a1", "action_description", 1000), ("a1", "review_comments", 1000),
        ("o1", "recipient_address", 320), ("o1", "subject_text", 500), ("r1", "recovery_reason", 1000),
        ("n1", "invoice_number", 100), ("n1", "error_message", 4000),
    ]:
        out.append(_count(t, f"{c} length", f"length({c}) > {n}"))
    for t, names in [
        ("c1", "customer_id"), ("t1", "payment_term_id term_name"), ("i1", "invoice_id invoice_number"),
        ("l1", "invoice_line_id"), ("p1", "payment_id"), ("v1", "conversation_id"), ("g1", "activity_id"),
        ("a1", "approval_id"), ("o1", "notification_id approval_id"), ("r1", "recovery_id"),
        ("n1", "orchestration_id"),
    ]:
        out += [
            f"SELECT '{_TABLE[t]}', '{c} UNIQUE', count({c}) - count(DISTINCT {c}) FROM {t}" for c in names.split()
        ]
    for t, c, parent in [
        ("i1", "customer_id", "c1"), ("i1", "payment_term_id", "t1"), ("l1", "invoice_id", "i1"),
        ("p1", "invoice_id", "i1"), ("g1", "conversation_id", "v1"), ("a1", "conversation_id", "v1"),
        ("o1", "approval_id", "a1"), ("o1", "conversation_id", "v1"), ("r1", "notification_id", "o1"),
        ("n1", "approval_id", "a1"), ("n1", "notification_id", "o1"),
    ]:
        out.append(_count(t, f"{c} REFERENCES", f"{c} NOT IN (SELECT {c} FROM {parent} WHERE {c} IS NOT NULL)"))
    return DAMAGED + " UNION ALL ".join(out)


SQL["constraint_violations"] = _violations()


# ---- indicators --------------------------------------------------------------------------
def _n(column, status, name):
    return f"count(CASE WHEN {column} = '{status}' THEN 1 END) AS {name}"


PORTFOLIO = f"""count(*) AS total_invoices, {money('coalesce(sum(invoice_amount), 0)', 'total_invoice_amount')},
  {money('coalesce(sum(amount_paid), 0)', 'total_amount_paid')},
  {money('coalesce(sum(outstanding_amount), 0)', 'total_outstanding')},
  {_n('invoice_status', 'PAID', 'paid_invoices')}, {_n('invoice_status', 'OPEN', 'open_invoices')},
  {_n('invoice_status', 'PARTIALLY_PAID', 'partially_paid_invoices')}"""
OVERDUE = f"""count(*) AS overdue_invoices, {money('coalesce(sum(outstanding_amount), 0)', 'overdue_outstanding')},
  CAST(coalesce(max(days), 0) AS INTEGER) AS maximum_days_past_due,
  round(coalesce(avg(days), 0), 4) AS average_days_past_due"""
RUNS = "count(*) AS total_orchestrations, " + ", ".join(
    _n("orchestration_status", n.upper(), n) for n in "completed failed waiting_approval processing queued".split()
)
APPROVALS = "count(*) AS total_approvals, " + ", ".join(
    _n("approval_status", n.upper(), n) for n in "pending approved executed".split()
)
NOTES = "count(*) AS total_notifications, " + ", ".join(
    _n("notification_status", n.upper(), n) for n in "pending processing sent failed".split()
)

SQL["portfolio_kpis"] = f"SELECT {PORTFOLIO} FROM inv"
SQL["overdue_kpis"] = f"SELECT {OVERDUE} FROM aging WHERE days > 0"
SQL["orchestration_kpis"] = f"SELECT {RUNS} FROM runs"
SQL["approval_kpis"] = f"SELECT {APPROVALS} FROM appr"
SQL["notification_kpis"] = f"SELECT {NOTES} FROM box"

SQL["top_overdue_invoices"] = f"""
SELECT invoice_id, invoice_number, customer_name, due_date, {money('outstanding_amount', 'outstanding_amount')},
  CAST(days AS INTEGER) AS days_past_due, aging_bucket, collection_priority, recommended_action
FROM (SELECT * FROM aging WHERE days > 0 ORDER BY days DESC, outstanding_amount DESC, invoice_id LIMIT 10)"""

RUN = cols("""orchestration_id invoice_number orchestration_status current_step approval_id notification_id
  started_at completed_at error_message""")
SQL["recent_orchestrations"] = f"SELECT {RUN} FROM runs ORDER BY orchestration_id DESC LIMIT 10"

SQL["executive_dashboard"] = f"""
WITH p AS (SELECT {PORTFOLIO} FROM inv), o AS (SELECT {OVERDUE} FROM aging WHERE days > 0),
r AS (SELECT {RUNS} FROM runs), a AS (SELECT {APPROVALS} FROM appr), n AS (SELECT {NOTES} FROM box)
""" + " UNION ALL ".join(
    f"SELECT '{section}' AS section, '{metric}' AS metric, CAST({metric} AS DOUBLE) AS value FROM {t}"
    for section, t, metrics in [
        ("AR PORTFOLIO", "p", "total_invoices total_invoice_amount total_amount_paid total_outstanding "
         "paid_invoices open_invoices partially_paid_invoices"),
        ("OVERDUE", "o", "overdue_invoices overdue_outstanding maximum_days_past_due average_days_past_due"),
        ("ORCHESTRATION", "r", "total_orchestrations completed failed waiting_approval processing queued"),
        ("APPROVALS", "a", "total_approvals pending approved executed"),
        ("NOTIFICATIONS", "n", "total_notifications pending processing sent failed"),
    ]
    for metric in metrics.split()
)

TEXT = """'The accounts receivable agent is currently managing $' || format('{:,.2f}', owed)
  || ' in outstanding receivables. There are ' || late_n || ' overdue invoices totaling $' || format('{:,.2f}', late)
  || ', representing ' || format('{:.1f}', CASE WHEN owed > 0 THEN late / owed * 100 ELSE 0 END)
  || '% of the current outstanding balance. '
  || CASE WHEN late_n = 0 THEN 'There are currently no overdue invoices requiring collection action.'
     WHEN days >= 90 THEN 'The highest-risk invoice is ' || days
       || ' days past due. Immediate collection follow-up should be prioritized.'
     WHEN days >= 60 THEN 'The oldest outstanding invoice is ' || days
       || ' days past due, indicating elevated collection risk.'
     WHEN days >= 30 THEN 'The oldest outstanding invoice is ' || days
       || ' days past due. Collection follow-up should continue.'
     ELSE 'Overdue exposure is currently concentrated in relatively recent delinquencies.' END || ' '
  || CASE WHEN waiting > 0 OR pending > 0 THEN greatest(waiting, pending)
       || ' collection action(s) are waiting for manager approval.'
     ELSE 'There are no collection actions currently waiting for manager approval.' END
  || ' The Action Orchestrator has completed ' || done || ' workflow(s), with ' || failed || ' failed workflow(s).'
  || ' The notification service has successfully sent ' || sent || ' reminder(s), with ' || unsent
  || ' failed notification(s). '
  || CASE WHEN failed > 0 OR unsent > 0 THEN 'Operational exceptions were detected. The AR team should review failed '
       || 'orchestrations or notification errors.'
     ELSE 'No unresolved orchestration or notification failures are currently reported.' END AS summary"""

SQL["collections_narrative"] = f"""
SELECT {TEXT} FROM (SELECT
  (SELECT CAST(sum(outstanding_amount) AS DOUBLE) FROM inv) AS owed,
  (SELECT count(*) FROM aging WHERE days > 0) AS late_n,
  (SELECT CAST(sum(outstanding_amount) AS DOUBLE) FROM aging WHERE days > 0) AS late,
  (SELECT max(days) FROM aging) AS days,
  (SELECT count(*) FROM runs WHERE orchestration_status = 'COMPLETED') AS done,
  (SELECT count(*) FROM runs WHERE orchestration_status = 'FAILED') AS failed,
  (SELECT count(*) FROM runs WHERE orchestration_status = 'WAITING_APPROVAL') AS waiting,
  (SELECT count(*) FROM appr WHERE approval_status = 'PENDING') AS pending,
  (SELECT count(*) FROM box WHERE notification_status = 'SENT') AS sent,
  (SELECT count(*) FROM box WHERE notification_status = 'FAILED') AS unsent)"""

SQL["collections_narrative_by_status"] = f"""
WITH own AS (SELECT i.invoice_number, i.outstanding_amount, c.status FROM inv i
             JOIN cust c ON c.customer_id = i.customer_id)
SELECT status, {TEXT} FROM (SELECT s.status,
  (SELECT CAST(sum(outstanding_amount) AS DOUBLE) FROM own o WHERE o.status = s.status) AS owed,
  (SELECT count(*) FROM aging a JOIN cust c ON c.customer_id = a.customer_id WHERE days > 0 AND c.status = s.status) AS late_n,
  (SELECT CAST(sum(outstanding_amount) AS DOUBLE) FROM aging a JOIN cust c ON c.customer_id = a.customer_id
     WHERE days > 0 AND c.status = s.status) AS late,
  (SELECT max(days) FROM aging a JOIN cust c ON c.customer_id = a.customer_id WHERE c.status = s.status) AS days,
  (SELECT count(*) FROM runs r JOIN own o ON o.invoice_number = r.invoice_number
     WHERE r.orchestration_status = 'COMPLETED' AND o.status = s.status) AS done,
  (SELECT count(*) FROM runs r JOIN own o ON o.invoice_number = r.invoice_number
     WHERE r.orchestration_status = 'FAILED' AND o.status = s.status) AS failed,
  (SELECT count(*) FROM runs r JOIN own o ON o.invoice_number = r.invoice_number
     WHERE r.orchestration_status = 'WAITING_APPROVAL' AND o.status = s.status) AS waiting,
  (SELECT count(*) FROM appr p JOIN own o ON o.invoice_number = p.wanted_invoice
     WHERE p.approval_status = 'PENDING' AND o.status = s.status) AS pending,
  (SELECT count(*) FROM box b JOIN own o ON 'Payment Reminder - Invoice ' || o.invoice_number = b.subject_text
     WHERE b.notification_status = 'SENT' AND o.status = s.status) AS sent,
  (SELECT count(*) FROM box b JOIN own o ON 'Payment Reminder - Invoice ' || o.invoice_number = b.subject_text
     WHERE b.notification_status = 'FAILED' AND o.status = s.status) AS unsent
FROM (SELECT DISTINCT status FROM own) s)"""


# ---- the indicators per value of each dimension, one SELECT each --------------------------------
OWNERS = """
WITH nat AS (SELECT customer_id, max(country) AS country FROM stg GROUP BY customer_id),
own AS (SELECT c.customer_id, c.status, 'RETAIL' AS customer_type, n.country FROM cust c
        LEFT JOIN nat n ON n.customer_id = c.customer_id),
inv_own AS (SELECT i.*, o.status, o.customer_type, o.country FROM inv i LEFT JOIN own o ON o.customer_id = i.customer_id),
late_own AS (SELECT a.*, o.status, o.customer_type, o.country FROM aging a LEFT JOIN own o ON o.customer_id = a.customer_id
             WHERE a.days > 0),
num AS (SELECT invoice_number, status, customer_type, country FROM inv_own),
runs_own AS (SELECT r.*, n.status, n.customer_type, n.country FROM runs r LEFT JOIN num n ON n.invoice_number = r.invoice_number),
appr_own AS (SELECT a.*, n.status, n.customer_type, n.country FROM appr a LEFT JOIN num n ON n.invoice_number = a.wanted_invoice),
box_own AS (SELECT b.*, n.status, n.customer_type, n.country FROM box b
            LEFT JOIN num n ON 'Payment Reminder - Invoice ' || n.invoice_number = b.subject_text)
"""


def _each(measures, table):
    parts = [f"SELECT 'ALL' AS dimension, CAST(NULL AS VARCHAR) AS value, {measures} FROM {table}"]
    parts += [f"SELECT '{d}', {d}, {measures} FROM {table} GROUP BY {d}" for d in ("status", "customer_type", "country")]
    return " UNION ALL ".join(parts)


for name, measures, table in [
    ("portfolio", PORTFOLIO, "inv_own"), ("overdue", OVERDUE, "late_own"), ("orchestration", RUNS, "runs_own"),
    ("approval", APPROVALS, "appr_own"), ("notification", NOTES, "box_own"),
]:
    SQL[f"{name}_kpis_by_each"] = OWNERS + _each(measures, table)
_FIGURES = " UNION ALL BY NAME ".join(
    "(" + _each(measures, table) + ")"
    for measures, table in [
        ("CAST(sum(outstanding_amount) AS DOUBLE) AS owed", "inv_own"),
        ("count(*) AS late_n, CAST(sum(outstanding_amount) AS DOUBLE) AS late, max(days) AS days", "late_own"),
        ("count_if(orchestration_status = 'COMPLETED') AS done, count_if(orchestration_status = 'FAILED') AS failed, "
         "count_if(orchestration_status = 'WAITING_APPROVAL') AS waiting", "runs_own"),
        ("count_if(approval_status = 'PENDING') AS pending", "appr_own"),
        ("count_if(notification_status = 'SENT') AS sent, count_if(notification_status = 'FAILED') AS unsent", "box_own"),
    ]
)
_FOLDED = ", ".join(
    f"coalesce(max({c}), 0) AS {c}" for c in "owed late_n late days done failed waiting pending sent unsent".split()
)
SQL["collections_narrative_by_each"] = OWNERS + f"""
SELECT dimension, value, {TEXT} FROM (SELECT dimension, value, {_FOLDED} FROM ({_FIGURES}) GROUP BY dimension, value)"""


# ---- operations reports --------------------------------------------------------------------
SQL["notification_status_summary"] = """
SELECT notification_status, count(*) AS notification_count FROM box GROUP BY notification_status"""
SQL["approval_status_summary"] = """
SELECT approval_status, count(*) AS approval_count FROM appr GROUP BY approval_status"""
SQL["orchestration_status_summary"] = """
SELECT orchestration_status, count(*) AS run_count FROM runs GROUP BY orchestration_status"""
SQL["notification_metrics"] = "SELECT count(*) AS total_notifications, " + ", ".join(
    _n("notification_status", n.upper(), f"{n}_count") for n in "pending processing sent retry dead failed".split()
) + " FROM box"

NOTE = cols("""notification_id approval_id notification_type recipient_address subject_text notification_status
  retry_count created_at processed_at""")
SQL["recent_notifications"] = f"SELECT {NOTE} FROM box ORDER BY created_at DESC, notification_id LIMIT 20"
SQL["notification_failures"] = "SELECT " + cols("""notification_id approval_id recipient_address
  notification_status retry_count max_retry_count failure_reason error_message next_retry_at dead_at
  updated_at""") + " FROM box WHERE notification_status IN ('RETRY', 'DEAD', 'FAILED')"
RECOVERY = cols("""recovery_id notification_id previous_status new_status recovered_by recovery_reason
  recovered_at""")
SQL["recovery_history"] = f"SELECT {RECOVERY} FROM rec ORDER BY recovered_at DESC, recovery_id LIMIT 20"
SQL["recovery_history_all"] = f"SELECT {RECOVERY} FROM rec"
SQL["recent_approvals"] = "SELECT " + cols("""approval_id conversation_id action_type action_description
  approval_status requested_at reviewed_at reviewed_by executed_at execution_status""") + """
  FROM appr ORDER BY requested_at DESC, approval_id LIMIT 20"""
LIFE = """SELECT a.approval_id, a.action_type, a.approval_status, n.notification_id, n.notification_type,
  n.recipient_address, n.notification_status, n.retry_count, n.max_retry_count, n.failure_reason, n.created_at,
  n.processed_at FROM appr a LEFT JOIN box n ON n.approval_id = a.approval_id"""
SQL["approval_notification_lifecycle"] = LIFE
SQL["approval_notification_recent"] = LIFE + " ORDER BY a.approval_id DESC LIMIT 20"
SQL["retry_status"] = "SELECT " + cols("""notification_id notification_status retry_count max_retry_count
  next_retry_at failure_reason error_message dead_at""") + " FROM box"
SQL["dead_notifications"] = "SELECT " + cols("""notification_id approval_id notification_type recipient_address
  notification_status retry_count max_retry_count failure_reason error_message dead_at""") + """
  FROM box WHERE notification_status = 'DEAD'"""
SQL["pending_approvals"] = "SELECT " + cols("""approval_id conversation_id requested_at action_type
  action_description action_payload approval_status""") + " FROM appr WHERE approval_status = 'PENDING'"
SQL["outbox_listing"] = "SELECT " + cols("""notification_id approval_id conversation_id notification_type
  recipient_address subject_text notification_status retry_count created_at processed_at error_message
  updated_at""") + " FROM box"
STATUS = """SELECT r.orchestration_id, r.invoice_number, r.approval_id, r.notification_id, r.orchestration_status,
  r.current_step, r.started_at, r.completed_at, r.error_message, a.conversation_id
FROM runs r LEFT JOIN appr a ON a.approval_id = r.approval_id"""
SQL["orchestration_status"] = STATUS
SQL["orchestration_status_by_id"] = STATUS + " WHERE r.orchestration_status = 'FAILED'"
SQL["record_lookup"] = """
SELECT * EXCLUDE (wanted_invoice) FROM appr
WHERE approval_id IN (SELECT approval_id FROM box WHERE notification_status = 'DEAD')"""
SQL["customer_contacts"] = "SELECT customer_id, customer_name, email, status FROM cust"
COVER = """SELECT i.invoice_number, i.customer_id, c.customer_name, c.email AS recipient_address
FROM inv i JOIN cust c ON c.customer_id = i.customer_id"""
SQL["recipient_coverage"] = COVER + " ORDER BY i.invoice_number, i.customer_id LIMIT 20"
SQL["recipient_coverage_all"] = COVER
SQL["reachable_recipients"] = COVER + """ WHERE c.email IS NOT NULL AND c.email <> ''
ORDER BY i.invoice_number, i.customer_id LIMIT 20"""


def management_report(others) -> str:
    """The sections of the report, each from its own query."""

    def body(sql, name):
        own = sql.strip()
        inner = own[own.index("SELECT"):] if not own.upper().startswith("WITH") else own
        return f"({inner}) {name}"

    def pairs(section, item, source, metrics):
        return [
            f"SELECT '{section}' AS section, CAST({item} AS VARCHAR) AS item, '{m}' AS metric, CAST({m} AS DOUBLE) AS value, "
            f"CAST(NULL AS VARCHAR) AS text FROM {source}" for m in metrics
        ]

    amounts = ["invoice_count", "outstanding_amount"]
    out = [f"SELECT 'DASHBOARD' AS section, section AS item, metric, value, CAST(NULL AS VARCHAR) AS text FROM "
           f"{body(SQL['executive_dashboard'], 'd')}"]
    out += pairs("AGING", "aging_bucket", body(others["aging_summary"], "g"), amounts)
    out += pairs("PRIORITY", "collection_priority", body(others["priority_summary"], "g"), amounts)
    out += pairs("OVERDUE", "invoice_number", body(SQL["top_overdue_invoices"], "g"), ["days_past_due", "outstanding_amount"])
    out.append("SELECT 'ACTIONS', CAST(orchestration_id AS VARCHAR), 'orchestration_status', NULL, orchestration_status FROM "
               + body(SQL["recent_orchestrations"], "g"))
    out.append("SELECT 'SUMMARY', NULL, 'summary', NULL, summary FROM " + body(SQL["collections_narrative"], "g"))
    return " UNION ALL ".join(out)

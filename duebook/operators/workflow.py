"""The approval, notification, retry and recovery workflow as table transitions.

A transition takes the current tables, a table of requests and `now`, and gives the next
tables, the audit rows and the requests it turned down.  Nothing is updated in place: write
the next tables to new paths and switch over when all of them are there.  Several requests
for one id are resolved by the lowest request id.
"""

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duebook import constants as K
from duebook.functions.expr import empty_to_null, fill, first_match
from duebook.functions.text import stripped
from duebook.operators.blocks import Ordered, dense_key
from duebook.schemas import conform
from duebook.storage import materialize

APPROVALS = "agent_approval_requests"
OUTBOX = "agent_notification_outbox"
RECOVERY = "agent_notification_recovery_log"
RUNS = "agent_orchestration_runs"
CONVERSATIONS = "agent_conversations"
ACTIVITY = "agent_activity_log"


class Transition(NamedTuple):
    tables: dict[str, DataFrame]  # next state, by table name
    events: DataFrame | None  # audit rows
    rejects: DataFrame  # requests without effect: reason and message
    added: dict[str, DataFrame] = {}  # the new rows of tables that only grow


def highest(df: DataFrame, key: str) -> Column:
    """Largest id of a table, 0 when it is empty, as a scalar subquery."""
    return df.agg(F.coalesce(F.max(key), F.lit(0)).cast("bigint")).scalar()


def _last_id(ids: dict[str, int] | None, df: DataFrame, key: str) -> Column:
    """Highest id so far: from `ids` where it is known, else from the table."""
    return F.lit(ids[key]).cast("bigint") if ids and key in ids else highest(df, key)


def first_request(requests: DataFrame, key: str, order: str) -> DataFrame:
    """The earliest request per id; partial aggregation keeps busy ids cheap."""
    rest = [c for c in requests.columns if c != key]
    # The other columns settle requests that share an id.
    place = F.struct(order, *rest)
    return requests.groupBy(key).agg(F.min_by(F.struct(*rest), place).alias("_r")).select(
        key, *[F.col(f"_r.{c}").alias(c) for c in rest]
    )


def _reason(pairs) -> tuple[Column, Column]:
    """(reason, message) of the first condition that holds; both NULL when none does."""
    return (
        first_match([(cond, F.lit(code)) for cond, code, _ in pairs]),
        first_match([(cond, text) for cond, _, text in pairs]),
    )


def _with_reason(df: DataFrame, pairs) -> DataFrame:
    reason, message = _reason(pairs)
    return df.withColumns({"reason": reason, "message": message})


def _judged(df: DataFrame, checks) -> DataFrame:
    """`df` with reason and message of the first (condition, reason, message) check that holds."""
    return df.withColumns(
        {
            "reason": first_match([(c, code if isinstance(code, Column) else F.lit(code)) for c, code, _ in checks]),
            "message": first_match([(c, text) for c, _, text in checks]),
        }
    )


def _holds(checks) -> Column:
    """Whether any of the checks holds."""
    out = F.lit(False)
    for condition, _, _ in checks:
        out = out | F.coalesce(condition, F.lit(False))
    return out


def reminder_payload(invoice: Column) -> Column:
    return F.to_json(
        F.struct(invoice.alias("invoice_number"), F.lit(K.REMINDER_CHANNEL).alias("channel"))
    )


def payload_invoice(payload: Column) -> Column:
    return F.from_json(payload, "invoice_number string, channel string")["invoice_number"]


def _audit(df: DataFrame, kind: str, now: Column, tool: str, arguments: Column, **more) -> DataFrame:
    given = {
        "activity_time": now,
        "activity_type": F.lit(kind),
        "tool_name": F.lit(tool),
        "tool_arguments": F.to_json(arguments),
        "execution_status": F.lit("SUCCESS"),
        **more,
    }
    return conform(df.withColumns(given), ACTIVITY)


def numbered_events(events: DataFrame, last: Column) -> DataFrame:
    """Audit rows with the ids after `last`."""
    order = ["activity_time", "conversation_id", "activity_type", "tool_arguments"]
    return conform(dense_key(events, "activity_id", order, last), ACTIVITY)


def append_events(log: DataFrame, events: DataFrame) -> DataFrame:
    """The activity log with new events; their ids continue the log's."""
    return log.unionByName(numbered_events(events, highest(log, "activity_id")))


# ---- recipients -------------------------------------------------------------------------
def resolve_recipients(
    requests: DataFrame, invoices: DataFrame, customers: DataFrame, status_first=True
) -> DataFrame:
    """`requests` with customer and trimmed address, or reason and message why there is none.

    The inactive check comes before the address checks, or after them with
    status_first=False.
    """
    contact = customers.select(
        "customer_id", "customer_name", empty_to_null(F.col("email")).alias("_email"),
        F.upper("status").alias("_status"), F.lit(True).alias("_known"),
    )
    # Only requested invoices are grouped, to one row per number: requests must not multiply
    # where invoices share one.  Invoices without ids would get them in the order of their customers.
    asked = requests.select("invoice_number").distinct()
    place = "invoice_id" if "invoice_id" in invoices.columns else "customer_id"
    owner = invoices.join(asked, "invoice_number", "left_semi").groupBy("invoice_number").agg(
        F.min_by("customer_id", place).alias("customer_id"), F.count("*").alias("_same")
    )
    # Customers are met by the requested invoices, of which there are at most as many as requests
    # and which are narrower; requests are moved once, for their invoices.
    found = requests.join(owner.join(contact, "customer_id", "left"), "invoice_number", "left")
    cid = F.col("customer_id")
    missing = [
        (F.col("_known").isNull(), "INVOICE_NOT_FOUND", fill(K.ERR_INVOICE, F.col("invoice_number")))
    ]
    missing.append(
        (F.col("_same") > 1, "AMBIGUOUS_INVOICE", fill(K.ERR_AMBIGUOUS, F.col("invoice_number"), F.col("_same")))
    )
    inactive = [(F.col("_status") == "INACTIVE", "CUSTOMER_INACTIVE", fill(K.ERR_INACTIVE, cid))]
    address = [
        (F.col("_email").isNull(), "NO_EMAIL", fill(K.ERR_NO_EMAIL, cid)),
        (stripped(F.col("_email")) == "", "BLANK_EMAIL", fill(K.ERR_BLANK_EMAIL, cid)),
    ]
    checks = missing + (inactive + address if status_first else address + inactive)
    judged = _with_reason(found, checks)
    usable = F.when(F.col("reason").isNull(), stripped(F.col("_email")))
    return judged.withColumn("recipient_address", usable).select(
        *requests.columns, "customer_id", "customer_name", "recipient_address", "reason", "message"
    )


# ---- approvals --------------------------------------------------------------------------
def request_reminders(
    requests: DataFrame, approvals: DataFrame, now: Column, ids: dict[str, int] | None = None
) -> Transition:
    """A pending approval per request (request_id, conversation_id, requested_by, invoice_number)."""
    keyed = dense_key(
        requests.where(F.col("invoice_number").isNotNull()),
        "approval_id", ["request_id"], _last_id(ids, approvals, "approval_id"),
    )
    invoice = F.col("invoice_number")
    new = conform(
        keyed.withColumns(
            {
                "requested_at": now,
                "action_type": F.lit(K.REMINDER_ACTION),
                "action_description": fill(K.TEXT_REQUEST, invoice),
                "action_payload": reminder_payload(invoice),
                "approval_status": F.lit("PENDING"),
            }
        ),
        APPROVALS,
    )
    events = _audit(
        keyed, "APPROVAL_REQUEST", now, K.REMINDER_ACTION, F.struct("invoice_number", "approval_id")
    )
    rejects = requests.where(invoice.isNull()).withColumn("reason", F.lit("NO_INVOICE_NUMBER"))
    return Transition({APPROVALS: approvals.unionByName(new)}, events, rejects, {APPROVALS: new})


def decide_approvals(approvals: DataFrame, decisions: DataFrame, now: Column) -> Transition:
    """Approve or reject pending requests.

    `decisions` has decision_id, approval_id, decision, reviewed_by and comments.  The first
    valid decision on a pending approval counts.
    """
    word = F.upper(stripped(F.col("decision")))
    valid = word.isin("APPROVED", "REJECTED")
    chosen = first_request(
        decisions.where(valid).select(
            "approval_id", "decision_id", word.alias("_word"), "reviewed_by", "comments"
        ),
        "approval_id", "decision_id",
    ).select(
        "approval_id", F.col("decision_id").alias("_chosen"), "_word",
        F.col("reviewed_by").alias("_by"), F.col("comments").alias("_comments"),
    )
    judged = approvals.join(chosen, "approval_id", "left")
    applies = (F.col("approval_status") == "PENDING") & F.col("_word").isNotNull()

    def changed(c, value):
        return F.when(applies, value).otherwise(F.col(c))

    after = judged.withColumn("_applies", applies).withColumns(
        {
            "reviewed_at": changed("reviewed_at", now),
            "reviewed_by": changed("reviewed_by", F.col("_by")),
            "review_comments": changed("review_comments", F.col("_comments")),
            "approval_status": changed("approval_status", F.col("_word")),
        }
    )
    decided = after.where("_applies")
    events = _audit(
        decided, "APPROVAL_DECISION", now,
        "APPROVE_REQUEST",
        F.struct("approval_id", F.col("approval_status").alias("decision")),
        tool_name=F.when(F.col("approval_status") == "APPROVED", "APPROVE_REQUEST").otherwise(
            "REJECT_REQUEST"
        ),
    )
    state = judged.select(
        "approval_id", F.col("approval_status").alias("_status"), "_chosen", F.lit(True).alias("_known")
    )
    checks = [
        (~F.coalesce(valid, F.lit(False)), "INVALID_DECISION", F.lit(K.ERR_DECISION)),
        (
            F.col("_known").isNull(), "NOT_FOUND",
            fill(K.ERR_APPROVAL_MISSING, F.col("approval_id")),
        ),
        (F.col("_status") != "PENDING", "NOT_PENDING", F.col("_status")),
        (F.col("decision_id") != F.col("_chosen"), "ALREADY_DECIDED", F.lit(None).cast("string")),
    ]
    rejects = (
        _with_reason(decisions.join(state, "approval_id", "left"), checks)
        .where(F.col("reason").isNotNull())
        .select("decision_id", "approval_id", "decision", "reason", "message")
    )
    return Transition({APPROVALS: conform(after, APPROVALS)}, events, rejects)


def _new_notifications(ok: DataFrame, now: Column, body: Column) -> DataFrame:
    return conform(
        ok.withColumns(
            {
                "notification_type": F.lit(K.REMINDER_TYPE),
                "subject_text": fill(K.TEXT_SUBJECT, F.col("invoice_number")),
                "message_body": body,
                "notification_status": F.lit("PENDING"),
                "retry_count": F.lit(0),
                "max_retry_count": F.lit(K.MAX_RETRY_COUNT),
                "created_at": now,
                "updated_at": now,
            }
        ),
        OUTBOX,
    )


def _queued(outbox: DataFrame, wanted: DataFrame) -> DataFrame:
    """First notification (`_queued`) of each wanted approval that has one."""
    return (
        outbox.select("approval_id", "notification_id").join(wanted.select("approval_id").distinct(), "approval_id", "left_semi")
        .groupBy("approval_id").agg(F.min("notification_id").alias("_queued"))
    )


def execute_approved(
    approvals: DataFrame, outbox: DataFrame, requests: DataFrame, now: Column,
    invoices: DataFrame | None = None, customers: DataFrame | None = None, form="recipient",
    ids: dict[str, int] | None = None,
) -> Transition:
    """Queue the reminders of approved requests (request_id, approval_id).

    `form` is "recipient" (address resolved from the invoice), "plain" (queued without an
    address) or "message" (approval closed with a message, nothing queued).
    """
    aid, status = F.col("approval_id"), F.col("approval_status")
    wanted = requests.groupBy("approval_id").agg(F.min("request_id").alias("_first"))
    known = approvals.select(
        "approval_id", "conversation_id", "action_type", "approval_status",
        payload_invoice(F.col("action_payload")).alias("invoice_number"),
    )
    found = wanted.join(known, "approval_id", "left")
    checks = [
        (status.isNull(), "NOT_FOUND", fill(K.ERR_APPROVAL_MISSING, aid)),
        (status != "APPROVED", "NOT_APPROVED", fill(K.ERR_APPROVAL_STATUS, aid, status)),
        (
            F.col("action_type") != K.REMINDER_ACTION, "UNSUPPORTED_ACTION",
            fill(K.ERR_ACTION, F.col("action_type")),
        ),
        (F.col("invoice_number").isNull(), "BAD_PAYLOAD", F.lit(K.ERR_PAYLOAD)),
    ]
    closed = None
    if form != "message":
        # Only approvals that pass so far are met with notifications and recipients.
        early = list(checks)
        first = materialize(found.withColumn("_closed", _holds(early)), "execution-requests")
        closed = _judged(first.where("_closed").drop("_closed"), early)
        found = first.where("NOT _closed").drop("_closed")
        found = found.join(_queued(outbox, found), "approval_id", "left")
    if form == "recipient":
        found = resolve_recipients(found, invoices, customers).withColumnsRenamed(
            {"reason": "_why", "message": "_text"}
        )
        checks.append((F.col("_why").isNotNull(), F.col("_why"), F.col("_text")))
    if form != "message":
        checks.append(
            (F.col("_queued").isNotNull(), "DUPLICATE_NOTIFICATION",
             fill(K.ERR_DUPLICATE, aid, F.col("_queued")))
        )
    outcome = materialize(_judged(found, checks), "executions")

    ok = outcome.where(F.col("reason").isNull())
    if closed is not None:
        outcome = outcome.unionByName(closed, allowMissingColumns=True)
    invoice = F.col("invoice_number")
    tables, added = {}, {}
    if form == "message":
        done = ok.withColumn("_done", fill(K.TEXT_EXECUTED_MESSAGE_ONLY, invoice))
    else:
        ok = dense_key(ok, "notification_id", ["approval_id"], _last_id(ids, outbox, "notification_id"))
        nid = F.col("notification_id")
        if form == "plain":
            body = fill(K.TEXT_BODY_PLAIN, invoice)
            done = ok.withColumn("_done", fill(K.TEXT_EXECUTED_PLAIN, invoice, nid))
        else:
            # A customer without a name is greeted with an empty one.
            name = F.coalesce(F.col("customer_name"), F.lit(""))
            body = fill(K.TEXT_BODY, name, invoice)
            done = ok.withColumn(
                "_done", fill(K.TEXT_EXECUTED, invoice, F.col("recipient_address"), nid)
            )
        added[OUTBOX] = _new_notifications(ok, now, body)
        tables[OUTBOX] = outbox.unionByName(added[OUTBOX])
    after = approvals.join(done.select("approval_id", "_done"), "approval_id", "left")
    hit = F.col("_done").isNotNull()
    tables[APPROVALS] = conform(
        after.withColumns(
            {
                "approval_status": F.when(hit, "EXECUTED").otherwise(status),
                "executed_at": F.when(hit, now).otherwise(F.col("executed_at")),
                "execution_status": F.when(hit, "SUCCESS").otherwise(F.col("execution_status")),
                "execution_message": F.when(hit, F.col("_done")).otherwise(F.col("execution_message")),
            }
        ),
        APPROVALS,
    )
    events = _audit(
        done, "ACTION_EXECUTION", now, "EXECUTE_APPROVED_ACTION", F.struct("approval_id"),
        agent_response=F.col("_done"),
    )
    # A repeated request meets the approval already executed, or fails as the first one did.
    repeated = F.col("reason").isNull() & (F.col("request_id") != F.col("_first"))
    rejects = (
        requests.select("request_id", "approval_id")
        .join(outcome.select("approval_id", "_first", "reason", "message"), "approval_id")
        .withColumn(
            "message",
            F.when(repeated, fill(K.ERR_APPROVAL_STATUS, aid, F.lit("EXECUTED"))).otherwise(
                F.col("message")
            ),
        )
        .withColumn("reason", F.when(repeated, "NOT_APPROVED").otherwise(F.col("reason")))
        .where(F.col("reason").isNotNull())
        .select("request_id", "approval_id", "reason", "message")
    )
    return Transition(tables, events, rejects, added)


# ---- notifications ------------------------------------------------------------------------
def is_claimable(now: Column, retries=True) -> Column:
    status = F.col("notification_status")
    if not retries:
        return status == "PENDING"
    due = (status == "RETRY") & (F.col("next_retry_at") <= now)
    return ((status == "PENDING") | due) & (F.col("retry_count") < F.col("max_retry_count"))


def claimable(outbox: DataFrame, now: Column, n: int | None = None, retries=True) -> DataFrame:
    """Notifications ready for delivery, oldest first."""
    ready = outbox.where(is_claimable(now, retries)).orderBy("created_at", "notification_id")
    return ready if n is None else ready.limit(n)


def claim_notifications(outbox: DataFrame, now: Column, n: int | None = None, retries=True) -> DataFrame:
    """The outbox with ready notifications (or the `n` oldest of them) moved to PROCESSING."""
    if n is None:
        marked, hit = outbox, is_claimable(now, retries)
    else:
        ids = claimable(outbox, now, n, retries).select("notification_id", F.lit(True).alias("_hit"))
        marked, hit = outbox.join(ids, "notification_id", "left"), F.col("_hit").isNotNull()
    changed = marked.withColumn("_claimed", F.coalesce(hit, F.lit(False))).withColumns(
        {
            "notification_status": F.when(F.col("_claimed"), "PROCESSING").otherwise(
                F.col("notification_status")
            ),
            "updated_at": F.when(F.col("_claimed"), now).otherwise(F.col("updated_at")),
            "error_message": F.when(~F.col("_claimed"), F.col("error_message")),
        }
    )
    return conform(changed, OUTBOX)


def apply_delivery_results(
    outbox: DataFrame, results: DataFrame, now: Column, retries=True
) -> Transition:
    """Outcome of delivery attempts (attempt_id, notification_id, error; no error = delivered).

    A failure leads to RETRY after a delay, or to DEAD when the retries are used up.  With
    retries=False every failure is final (FAILED).
    """
    first = first_request(
        results.select("notification_id", "attempt_id", "error"), "notification_id", "attempt_id"
    ).select(
        "notification_id", F.col("attempt_id").alias("_attempt"), F.col("error").alias("_error")
    )
    judged = outbox.join(first, "notification_id", "left")
    processing = F.col("notification_status") == "PROCESSING"
    state = judged.select(
        "notification_id", F.col("notification_status").alias("_status"), "_attempt",
    )
    tried = processing & F.col("_attempt").isNotNull()
    sent = tried & F.col("_error").isNull()
    failed = tried & F.col("_error").isNotNull()
    count = F.col("retry_count") + 1
    if retries:
        dead = failed & (count >= F.col("max_retry_count"))
        again = failed & (count < F.col("max_retry_count"))
        after_failure = F.when(dead, "DEAD").otherwise("RETRY")
        why = F.when(dead, K.TEXT_DEAD).otherwise(K.TEXT_RETRY)
        when_again = F.when(again, now + F.expr(f"INTERVAL {K.RETRY_DELAY}"))
        ended = sent | dead
    else:
        dead = F.lit(False)
        after_failure, ended = F.lit("FAILED"), tried
        why, when_again = F.col("failure_reason"), F.col("next_retry_at")

    def after(c, on_sent, on_failed):
        return F.when(sent, on_sent).when(failed, on_failed).otherwise(F.col(c))

    null = F.lit(None)
    text = F.col("_error")
    moved = judged.select(
        *[c for c in outbox.columns if c not in (
            "notification_status", "retry_count", "processed_at", "updated_at", "next_retry_at",
            "failure_reason", "error_message", "dead_at")],
        after("notification_status", F.lit("SENT"), after_failure).alias("notification_status"),
        F.when(failed, count).otherwise(F.col("retry_count")).alias("retry_count"),
        F.when(ended, now).otherwise(F.col("processed_at")).alias("processed_at"),
        F.when(tried, now).otherwise(F.col("updated_at")).alias("updated_at"),
        after("next_retry_at", null if retries else F.col("next_retry_at"), when_again).alias(
            "next_retry_at"
        ),
        after("failure_reason", null if retries else F.col("failure_reason"), why).alias(
            "failure_reason"
        ),
        after("error_message", null, text).alias("error_message"),
        F.when(dead, now).otherwise(F.col("dead_at")).alias("dead_at"),
    )
    nid = F.col("notification_id")
    checks = [
        (F.col("_status").isNull(), "NOT_FOUND", fill(K.ERR_NOTIFICATION_MISSING, nid)),
        (F.col("_status") != "PROCESSING", "NOT_PROCESSING", F.col("_status")),
        (F.col("attempt_id") != F.col("_attempt"), "ALREADY_SETTLED", F.lit(None).cast("string")),
    ]
    rejects = (
        _with_reason(results.join(state, "notification_id", "left"), checks)
        .where(F.col("reason").isNotNull())
        .select("attempt_id", "notification_id", "reason", "message")
    )
    return Transition({OUTBOX: conform(moved, OUTBOX)}, None, rejects)


def requeue(
    outbox: DataFrame, log: DataFrame, requests: DataFrame, now: Column, ids: dict[str, int] | None = None
) -> Transition:
    """Send DEAD, FAILED and RETRY notifications back to PENDING, with a recovery log row.

    `requests` has request_id, notification_id, recovered_by and recovery_reason.
    """
    first = first_request(
        requests.select("notification_id", "request_id", "recovered_by", "recovery_reason"),
        "notification_id", "request_id",
    ).withColumnsRenamed(
        {"request_id": "_request", "recovered_by": "_by", "recovery_reason": "_reason"}
    )
    joined = outbox.join(first, "notification_id", "left")
    status = F.upper("notification_status")
    hit = F.col("_request").isNotNull() & status.isin(K.RECOVERABLE_STATUSES)
    cleared = [
        "next_retry_at", "failure_reason", "error_message", "dead_at", "processed_at",
    ]
    marked = joined.withColumn("_hit", hit).withColumn("_before", status)
    moved = marked.withColumns(
        {
            **{c: F.when(~F.col("_hit"), F.col(c)) for c in cleared},
            "notification_status": F.when(F.col("_hit"), "PENDING").otherwise(
                F.col("notification_status")
            ),
            "retry_count": F.when(F.col("_hit"), 0).otherwise(F.col("retry_count")),
            "updated_at": F.when(F.col("_hit"), now).otherwise(F.col("updated_at")),
        }
    )
    recovered = dense_key(
        marked.where("_hit").select(
            "notification_id", F.col("_before").alias("previous_status"),
            F.coalesce("_by", F.lit(K.REVIEWER)).alias("recovered_by"),
            F.coalesce("_reason", F.lit(K.TEXT_RECOVERY_REASON)).alias("recovery_reason"),
        ),
        "recovery_id", ["notification_id"], _last_id(ids, log, "recovery_id"),
    )
    rows = conform(
        recovered.withColumns({"new_status": F.lit("PENDING"), "recovered_at": now}), RECOVERY
    )
    nid = F.col("notification_id")
    state = marked.select("notification_id", "_before", F.col("_request"))
    checks = [
        (F.col("_before").isNull(), "NOT_FOUND", fill(K.ERR_NOTIFICATION_MISSING, nid)),
        (
            ~F.col("_before").isin(K.RECOVERABLE_STATUSES), "NOT_RECOVERABLE",
            fill(K.ERR_REQUEUE, nid, F.col("_before")),
        ),
        (
            F.col("request_id") != F.col("_request"), "NOT_RECOVERABLE",
            fill(K.ERR_REQUEUE, nid, F.lit("PENDING")),
        ),
    ]
    rejects = (
        _with_reason(requests.join(state, "notification_id", "left"), checks)
        .where(F.col("reason").isNotNull())
        .select("request_id", "notification_id", "reason", "message")
    )
    return Transition(
        {OUTBOX: conform(moved, OUTBOX), RECOVERY: log.unionByName(rows)}, rows, rejects, {RECOVERY: rows}
    )


# ---- orchestration ------------------------------------------------------------------------
def conversation_for(run: Column) -> Column:
    """A conversation id that depends on the run alone."""
    digest = F.sha2(F.concat(F.lit("orchestration-"), run.cast("string")), 256)
    places = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat_ws("-", *[F.substring(digest, at, size) for at, size in places])


def start_orchestrations(
    requests: DataFrame, runs: DataFrame, approvals: DataFrame, conversations: DataFrame,
    invoices: DataFrame, customers: DataFrame, now: Column, created_by="SYSTEM",
    ids: dict[str, int] | None = None,
) -> Transition:
    """One run per request (request_id, invoice_number).

    Runs whose recipient is usable wait for a new approval in a new conversation; the others
    fail at once with the reason.
    """
    keyed = dense_key(
        requests.select("request_id", "invoice_number"), "orchestration_id", ["request_id"],
        _last_id(ids, runs, "orchestration_id"),
    )
    found = resolve_recipients(keyed, invoices, customers, status_first=False)
    judged = materialize(found.select(*keyed.columns, "reason", "message"), "run-starts")
    ok = dense_key(
        judged.where(F.col("reason").isNull()).select("orchestration_id", "invoice_number"),
        "approval_id", ["orchestration_id"], _last_id(ids, approvals, "approval_id"),
    ).withColumn("conversation_id", conversation_for(F.col("orchestration_id")))
    waiting = ok.withColumns(
        {
            "orchestration_status": F.lit("WAITING_APPROVAL"),
            "current_step": F.lit("WAITING_APPROVAL"),
            "started_at": now,
        }
    )
    failed = judged.where(F.col("reason").isNotNull()).withColumns(
        {
            "orchestration_status": F.lit("FAILED"),
            "current_step": F.lit("FAILED"),
            "started_at": now,
            "completed_at": now,
            "error_message": F.col("message"),
        }
    )
    invoice = F.col("invoice_number")
    asked = ok.withColumns(
        {
            "requested_at": now,
            "requested_by": F.lit(created_by),
            "action_type": F.lit(K.REMINDER_ACTION),
            "action_description": fill(K.TEXT_REQUEST, invoice),
            "action_payload": reminder_payload(invoice),
            "approval_status": F.lit("PENDING"),
        }
    )
    opened = ok.withColumns(
        {"started_at": now, "conversation_status": F.lit("ACTIVE"), "created_by": F.lit(created_by)}
    )
    new_runs = conform(waiting, RUNS).unionByName(conform(failed, RUNS))
    added = {RUNS: new_runs, APPROVALS: conform(asked, APPROVALS), CONVERSATIONS: conform(opened, CONVERSATIONS)}
    rejects = judged.where(F.col("reason").isNotNull()).select(
        "request_id", "orchestration_id", "invoice_number", "reason", "message"
    )
    return Transition(
        {
            RUNS: runs.unionByName(new_runs),
            APPROVALS: approvals.unionByName(added[APPROVALS]),
            CONVERSATIONS: conversations.unionByName(added[CONVERSATIONS]),
        },
        new_runs,
        rejects,
        added,
    )


def complete_orchestrations(
    runs: DataFrame, approvals: DataFrame, outbox: DataFrame, requests: DataFrame,
    invoices: DataFrame, customers: DataFrame, now: Column, ids: dict[str, int] | None = None,
) -> Transition:
    """Approve waiting runs (orchestration_id) and carry them through to a sent notification.

    Unknown runs, runs that do not wait and runs without a usable recipient stay as they are.
    Runs whose approval is no longer pending, or already has a notification, become FAILED and
    their approval is left alone.
    """
    rid, status = F.col("orchestration_id"), F.col("orchestration_status")
    wanted = requests.select("orchestration_id").distinct()
    known = runs.select(
        "orchestration_id", "invoice_number", "approval_id", "orchestration_status"
    )
    first = materialize(wanted.join(known, "orchestration_id", "left"), "run-requests")
    idle = [
        (status.isNull(), "NOT_FOUND", fill(K.ERR_RUN_MISSING, rid)),
        (status != "WAITING_APPROVAL", "NOT_WAITING", fill(K.ERR_RUN_STATUS, rid, status)),
    ]
    # Only runs that wait are met with approvals, notifications and recipients.
    # The others are turned down once for each copy of their approval.
    closed = _judged(first.where(_holds(idle)).join(approvals.select("approval_id"), "approval_id", "left"), idle)
    waiting = first.where(~_holds(idle))
    approval = approvals.select("approval_id", "conversation_id", "approval_status")
    queued = _queued(outbox, waiting)
    # Of several runs that wait for the same approval only the first can be completed.
    owner = waiting.groupBy("approval_id").agg(F.min("orchestration_id").alias("_owner"))
    full = resolve_recipients(
        waiting.join(approval, "approval_id", "left")
        .join(queued, "approval_id", "left")
        .join(owner, "approval_id", "left"),
        invoices, customers, status_first=False,
    ).withColumnsRenamed({"reason": "_why", "message": "_text"})
    unreachable = [(F.col("_why").isNotNull(), F.col("_why"), F.col("_text"))]
    pending = F.coalesce(F.col("approval_status") == "PENDING", F.lit(False))
    fatal = [
        (~pending | (F.col("_owner") != rid), "APPROVAL_NOT_PENDING", F.lit(K.ERR_RUN_APPROVAL)),
        (
            F.col("_queued").isNotNull(), "DUPLICATE_NOTIFICATION",
            fill(K.ERR_DUPLICATE, F.col("approval_id"), F.col("_queued")),
        ),
    ]
    judged = materialize(
        _judged(full.withColumn("_stays", _holds(unreachable)), unreachable + fatal), "run-completions"
    )
    ok = dense_key(
        judged.where(F.col("reason").isNull()), "notification_id", ["orchestration_id"],
        _last_id(ids, outbox, "notification_id"),
    )
    name = F.coalesce(F.col("customer_name"), F.lit(""))
    sent = _new_notifications(ok, now, fill(K.TEXT_BODY, name, F.col("invoice_number"))).withColumns(
        {"notification_status": F.lit("SENT"), "processed_at": now}
    )
    closing = ok.select("approval_id", F.col("notification_id").alias("_new"))
    hit = F.col("_new").isNotNull()
    executed = {
        "approval_status": F.lit("EXECUTED"),
        "reviewed_at": now,
        "reviewed_by": F.lit(K.REVIEWER),
        "review_comments": F.lit(K.TEXT_RUN_REVIEW),
        "executed_at": now,
        "execution_status": F.lit("SUCCESS"),
        "execution_message": fill(K.TEXT_EXECUTED_RUN, F.col("_new")),
    }
    next_approvals = approvals.join(closing, "approval_id", "left").withColumns(
        {c: F.when(hit, v).otherwise(F.col(c)) for c, v in executed.items()}
    )
    error = F.col("message")
    ends = ok.select(
        "orchestration_id", F.lit("COMPLETED").alias("_to"), F.col("notification_id").alias("_new"),
        F.lit(None).cast("string").alias("_error"),
    ).unionByName(
        judged.where(F.col("reason").isNotNull() & ~F.col("_stays")).select(
            "orchestration_id", F.lit("FAILED").alias("_to"), F.lit(None).cast("bigint").alias("_new"),
            error.alias("_error"),
        )
    )
    ended = F.col("_to").isNotNull()
    next_runs = runs.join(ends, "orchestration_id", "left").withColumns(
        {
            "notification_id": F.coalesce("_new", "notification_id"),
            "orchestration_status": F.coalesce("_to", "orchestration_status"),
            "current_step": F.coalesce("_to", "current_step"),
            "completed_at": F.when(ended, now).otherwise(F.col("completed_at")),
            "error_message": F.when(ended, F.col("_error")).otherwise(F.col("error_message")),
        }
    )
    steps = [
        ("APPROVED", "CREATE_OUTBOX"), ("QUEUED", "PROCESS_NOTIFICATION"),
        ("PROCESSING", "SEND_NOTIFICATION"), ("COMPLETED", "COMPLETED"),
    ]
    trail = F.array(
        *[
            F.struct(
                F.lit(i).alias("step"), F.lit(s).alias("orchestration_status"),
                F.lit(c).alias("current_step"),
            )
            for i, (s, c) in enumerate(steps, 1)
        ]
    )
    events = ok.select(
        "orchestration_id", "approval_id", "notification_id", F.inline(trail)
    ).withColumn("changed_at", now)
    turned_down = ["orchestration_id", "reason", "message"]
    rejects = judged.where(F.col("reason").isNotNull()).select(*turned_down).unionByName(closed.select(*turned_down))
    return Transition(
        {
            RUNS: conform(next_runs, RUNS),
            APPROVALS: conform(next_approvals, APPROVALS),
            OUTBOX: outbox.unionByName(sent),
        },
        events,
        rejects,
        {OUTBOX: sent},
    )


# ---- history ------------------------------------------------------------------------------
def transition_history(changes: DataFrame, allowed) -> DataFrame:
    """Status changes per entity with the previous status, time spent and whether it is allowed.

    `changes` has entity_id, change_id, changed_at and status.
    """
    ordered = Ordered(
        changes.select("entity_id", "changed_at", "change_id", "status"),
        ["entity_id"], ["changed_at", "change_id"], name="history",
    )
    both = (
        ordered.neighbour({"previous_status": "status"}, -1)
        .neighbour({"_until": "changed_at"}, 1)
        .result()
    )
    pair = F.concat_ws(">", "previous_status", "status")
    pairs = [f"{a}>{b}" for a, b in allowed]
    spent = (F.unix_micros("_until") - F.unix_micros("changed_at")).cast("double") / 1000000
    return both.select(
        "entity_id", "change_id", "changed_at", "previous_status", "status",
        spent.alias("seconds_in_status"),
        F.when(F.col("previous_status").isNotNull(), pair.isin(pairs)).alias("is_allowed"),
    )


def illegal_transitions(history: DataFrame) -> DataFrame:
    """Number of forbidden jumps per pair of statuses."""
    return (
        history.where(~F.col("is_allowed"))
        .groupBy("previous_status", "status")
        .agg(F.count("*").alias("jumps"))
    )

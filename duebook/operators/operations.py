"""Operations reports over approvals, notifications, recoveries and runs."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duebook import constants as K
from duebook.functions.expr import top_with
from duebook.operators.requested import requested


def status_summary(df: DataFrame, column: str, count_name: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias(count_name)).orderBy(column)


def notification_status_summary(outbox: DataFrame) -> DataFrame:
    return status_summary(outbox, "notification_status", "notification_count")


def approval_status_summary(approvals: DataFrame) -> DataFrame:
    return status_summary(approvals, "approval_status", "approval_count")


def orchestration_status_summary(runs: DataFrame) -> DataFrame:
    return status_summary(runs, "orchestration_status", "run_count")


def notification_metrics(outbox: DataFrame) -> DataFrame:
    names = ("pending", "processing", "sent", "retry", "dead", "failed")
    return outbox.agg(
        F.count("*").alias("total_notifications"),
        *[F.count_if(F.col("notification_status") == n.upper()).alias(f"{n}_count") for n in names],
    )


def _newest(df: DataFrame, order, n: int | None) -> DataFrame:
    ordered = df.orderBy(*order)
    return ordered if n is None else ordered.limit(n)


def recent_notifications(outbox: DataFrame, n: int | None = 20) -> DataFrame:
    return _newest(outbox, [F.desc("created_at"), "notification_id"], n).select(
        "notification_id", "approval_id", "notification_type", "recipient_address", "subject_text",
        "notification_status", "retry_count", "created_at", "processed_at",
    )


def notification_failures(outbox: DataFrame) -> DataFrame:
    """Notifications in trouble, latest change first (unknown times first)."""
    failed = outbox.where(F.col("notification_status").isin(K.RECOVERABLE_STATUSES))
    return failed.orderBy(F.col("updated_at").desc_nulls_first(), "notification_id").select(
        "notification_id", "approval_id", "recipient_address", "notification_status",
        "retry_count", "max_retry_count", "failure_reason", "error_message", "next_retry_at",
        "dead_at", "updated_at",
    )


def recovery_history(log: DataFrame, n: int | None = 20) -> DataFrame:
    """Newest recoveries, or with n=None all of them by id."""
    order = ["recovery_id"] if n is None else [F.desc("recovered_at"), "recovery_id"]
    return _newest(log, order, n).select(
        "recovery_id", "notification_id", "previous_status", "new_status", "recovered_by",
        "recovery_reason", "recovered_at",
    )


def recent_approvals(approvals: DataFrame, n: int | None = 20) -> DataFrame:
    return _newest(approvals, [F.desc("requested_at"), "approval_id"], n).select(
        "approval_id", "conversation_id", "action_type", "action_description", "approval_status",
        "requested_at", "reviewed_at", "reviewed_by", "executed_at", "execution_status",
    )


def approval_notification_lifecycle(approvals: DataFrame, outbox: DataFrame, n=None) -> DataFrame:
    """Approvals with their notification, newest approval first."""
    wanted = approvals.select("approval_id", "action_type", "approval_status")
    sent = outbox.select(
        "approval_id", "notification_id", "notification_type", "recipient_address",
        "notification_status", "retry_count", "max_retry_count", "failure_reason", "created_at",
        "processed_at",
    )
    if n is not None:
        # An approval has at most one notification, so the cut may come before the join,
        # and the n ids filter the notifications in place.
        wanted = wanted.orderBy(F.desc("approval_id")).limit(n)
        sent = sent.join(F.broadcast(wanted.select("approval_id")), "approval_id", "left_semi")
    joined = wanted.join(sent, "approval_id", "left").orderBy(F.desc("approval_id"))
    return joined if n is None else joined.limit(n)


def retry_status(outbox: DataFrame) -> DataFrame:
    return outbox.select(
        "notification_id", "notification_status", "retry_count", "max_retry_count",
        "next_retry_at", "failure_reason", "error_message", "dead_at",
    ).orderBy("notification_id")


def dead_notifications(outbox: DataFrame) -> DataFrame:
    """DEAD notifications, longest dead first (unknown times last)."""
    dead = outbox.where(F.col("notification_status") == "DEAD")
    return dead.orderBy(F.col("dead_at").asc_nulls_last(), "notification_id").select(
        "notification_id", "approval_id", "notification_type", "recipient_address",
        "notification_status", "retry_count", "max_retry_count", "failure_reason",
        "error_message", "dead_at",
    )


def pending_approvals(approvals: DataFrame) -> DataFrame:
    waiting = approvals.where(F.col("approval_status") == "PENDING")
    return waiting.orderBy("requested_at", "approval_id").select(
        "approval_id", "conversation_id", "requested_at", "action_type", "action_description",
        "action_payload", "approval_status",
    )


def outbox_listing(outbox: DataFrame) -> DataFrame:
    return outbox.select(
        "notification_id", "approval_id", "conversation_id", "notification_type",
        "recipient_address", "subject_text", "notification_status", "retry_count", "created_at",
        "processed_at", "error_message", "updated_at",
    ).orderBy("notification_id")


def orchestration_status(runs: DataFrame, approvals: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """Runs with the conversation of their approval."""
    if ids is not None:
        runs = requested(runs, ids, "orchestration_id")
    return runs.join(approvals.select("approval_id", "conversation_id"), "approval_id", "left").select(
        "orchestration_id", "invoice_number", "approval_id", "notification_id",
        "orchestration_status", "current_step", "started_at", "completed_at", "error_message",
        "conversation_id",
    )


def record_lookup(table: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """Full rows of the requested ids."""
    return requested(table, ids, key)


def customer_contacts(customers: DataFrame) -> DataFrame:
    return customers.select("customer_id", "customer_name", "email", "status").orderBy("customer_id")


def recipient_coverage(
    invoices: DataFrame, customers: DataFrame, reachable_only=False, n: int | None = 20
) -> DataFrame:
    """Invoices with the address of their customer; optionally only those that have one."""
    contacts = customers.select("customer_id", "customer_name", "email")
    if reachable_only:
        contacts = contacts.where((F.col("email") != "") & F.col("email").isNotNull())
    numbers, order = invoices.select("invoice_number", "customer_id"), ["invoice_number", "customer_id"]
    if n is None:
        found = numbers.join(contacts, "customer_id").orderBy(*order)
    else:
        found = top_with(numbers, order, n, contacts, "customer_id")
    return found.select(
        "invoice_number", "customer_id", "customer_name",
        F.col("email").alias("recipient_address"),
    )

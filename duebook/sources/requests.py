"""Workflow requests derived from the event table, with repeats, unknown ids and bad values."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duebook import constants as K
from duebook.functions.expr import first_match
from duebook.sources.fixtures import _events, outbox

LATER = 10**10  # added to a request id to make a later repeat
UNKNOWN = 10**12  # added to an id to make it unknown


def _eid():
    return F.col("event_id")


def _key():
    return F.col("k")


def _union(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def reminder_requests(spark, folder) -> DataFrame:
    return _events(spark, folder).select(
        _eid().alias("request_id"),
        "conversation_id",
        F.concat(F.lit("user-"), F.col("user_id").cast("string")).alias("requested_by"),
        F.when(_eid() % 28 != 0, F.col("invoice_number")).alias("invoice_number"),
    )


def decisions(spark, folder) -> DataFrame:
    ev = _events(spark, folder)
    word = first_match(
        [(_key() % 10 == 4, F.lit("MAYBE")), (_key() % 2 == 1, F.lit(" approved "))], F.lit("REJECTED")
    )
    comment = F.concat(F.lit("comment "), _key().cast("string"))

    def shaped(df, decision_id, approval_id, decision):
        return df.select(
            decision_id.alias("decision_id"), approval_id.alias("approval_id"),
            decision.alias("decision"), F.lit(K.REVIEWER).alias("reviewed_by"),
            comment.alias("comments"),
        )

    return _union(
        shaped(ev, _eid(), _eid(), word),
        shaped(ev.where(_eid() % 6 == 0), _eid() + LATER, _eid(), F.lit("REJECTED")),
        shaped(ev.where(_eid() % 30 == 3), _eid() + 2 * LATER, _eid() + UNKNOWN, F.lit("APPROVED")),
    )


def executions(spark, folder) -> DataFrame:
    ev = _events(spark, folder)
    return _union(
        ev.select(_eid().alias("request_id"), _eid().alias("approval_id")),
        ev.where(_eid() % 10 == 1).select((_eid() + LATER).alias("request_id"), _eid().alias("approval_id")),
        ev.where(_eid() % 50 == 0).select(
            (_eid() + 2 * LATER).alias("request_id"), (_eid() + UNKNOWN).alias("approval_id")
        ),
    )


def attempts(spark, folder) -> DataFrame:
    rows = outbox(spark, folder).withColumn("k", F.col("_k"))
    nid = F.col("notification_id")
    error = F.when(_key() % 9 == 0, F.repeat(F.lit("timeout "), 600)).when(
        _key() % 2 == 1, K.TEXT_NO_RECIPIENT
    )
    return _union(
        rows.select(nid.alias("attempt_id"), "notification_id", error.alias("error")),
        rows.where(_key() % 5 == 0).select(
            (nid + LATER).alias("attempt_id"), "notification_id",
            F.lit(None).cast("string").alias("error"),
        ),
        rows.where(_key() == 1).select(
            (nid + 2 * LATER).alias("attempt_id"), (nid + UNKNOWN).alias("notification_id"),
            F.lit(None).cast("string").alias("error"),
        ),
    )


def recoveries(spark, folder) -> DataFrame:
    rows = outbox(spark, folder).withColumn("k", F.col("_k"))
    nid = F.col("notification_id")
    reason = F.when(_key() % 2 == 0, F.concat(F.lit("reason "), _key().cast("string")))

    def shaped(df, request_id, notification_id):
        return df.select(
            request_id.alias("request_id"), notification_id.alias("notification_id"),
            F.lit("OPERATOR").alias("recovered_by"), reason.alias("recovery_reason"),
        )

    return _union(
        shaped(rows, nid, nid),
        shaped(rows.where(_key() % 6 == 0), nid + LATER, nid),
        shaped(rows.where(_key() == 3), nid + 2 * LATER, nid + UNKNOWN),
    )


def run_requests(spark, folder) -> DataFrame:
    return _events(spark, folder).select(
        _eid().alias("request_id"), "invoice_number"
    )


def run_approvals(spark, folder) -> DataFrame:
    ev = _events(spark, folder)
    return _union(
        ev.select(_eid().alias("orchestration_id")),
        ev.where(_eid() % 10 == 1).select(_eid().alias("orchestration_id")),
        ev.where(_eid() % 40 == 0).select((_eid() + UNKNOWN).alias("orchestration_id")),
    )


def status_changes(spark, folder) -> DataFrame:
    return status_changes_of(_events(spark, folder))


def status_changes_of(events: DataFrame) -> DataFrame:
    """Event types read as notification statuses of the event's user."""
    status = first_match(
        [
            (F.col("event_type") == "click", F.lit("PENDING")),
            (F.col("event_type") == "signup", F.lit("PROCESSING")),
            (F.col("event_type") == "purchase", F.lit("SENT")),
            (F.col("event_type") == "view", F.lit("RETRY")),
            (_key() % 2 == 0, F.lit("DEAD")),
        ],
        F.lit("FAILED"),
    )
    return events.select(
        F.col("user_id").alias("entity_id"), _eid().alias("change_id"),
        F.col("ts").alias("changed_at"), status.alias("status"),
    )


def run_changes(spark, folder) -> DataFrame:
    """Events read as status changes of the runs of the event's user, by the place of the event."""
    words = F.array(*[F.lit(w) for w in K.ORCHESTRATION_STATUSES])
    return _events(spark, folder).select(
        F.col("user_id").alias("entity_id"), _eid().alias("change_id"), F.col("ts").alias("changed_at"),
        F.get(words, (_eid() % len(K.ORCHESTRATION_STATUSES)).cast("int")).alias("status"),
    )

"""Streaming forms of the time-driven operators.  All take and give streaming DataFrames."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from duebook import constants as K
from duebook.operators.payments import paid_per_invoice
from duebook.streaming.processors import (
    RETRY_OUTPUT, STUCK_OUTPUT, RetryMachine, StuckDetector, compact_attempts,
)

ATTEMPTS = "notification_id bigint, attempt_id bigint, attempt_at timestamp, delivered boolean"


def stream_payments_to_balances(payments: DataFrame) -> DataFrame:
    """Running total paid per invoice (update mode)."""
    return paid_per_invoice(payments)


def stream_notification_metrics(
    outbox: DataFrame, window="1 day", slide=None, lateness="1 hour"
) -> DataFrame:
    """Notifications per status in tumbling windows, or sliding ones when `slide` is given."""
    times = F.window("created_at", window, slide) if slide else F.window("created_at", window)
    return (
        outbox.withWatermark("created_at", lateness)
        .groupBy(times.alias("w"), "notification_status")
        .agg(F.count("*").alias("notification_count"))
        .select(
            F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
            "notification_status", "notification_count",
        )
    )


def stream_retry_machine(
    attempts: DataFrame, lateness="1 hour", start: DataFrame | None = None, groups: int = 4096
) -> DataFrame:
    """Status per notification after its attempts so far (update mode).

    `start` has notification_id, failures (at least one) and last_failure_at of notifications
    that were tried before the stream began (`stored.open_and_closed` of an outbox).

    A notification ends as SENT at its first success or DEAD at its third failure; until then
    it is RETRY, and RETRY_DUE once the back-off is over.  The outcome does not depend on the
    order in which attempts arrive.  Attempts are reduced before the shuffle.  Ended
    notifications leave the state once the watermark has passed them, with a last row that says
    `is_final`; attempts that come after that make new rows, which `stored.retry_status` turns
    away.  The state is kept for `groups` of notifications (of a fixed number, by the hash of the
    id); a batch reads and writes the groups it touches.
    """
    reduced = attempts.mapInPandas(compact_attempts, ATTEMPTS)
    group = F.pmod(F.xxhash64("notification_id"), F.lit(groups)).cast("int").alias("retry_group")
    if start is not None:
        opened = F.struct("notification_id", "failures", F.unix_micros("last_failure_at").alias("at"))
        start = start.groupBy(group).agg(F.collect_list(opened).alias("open")).groupBy("retry_group")
    return (
        reduced.withWatermark("attempt_at", lateness)
        .select("*", F.unix_micros("attempt_at").alias("attempt_micros"), group)
        .groupBy("retry_group")
        .transformWithState(
            RetryMachine(), outputStructType=StructType.fromDDL(RETRY_OUTPUT), outputMode="update",
            timeMode="EventTime", initialState=start,
        )
        .select(
            "notification_id", "notification_status", "retry_count",
            F.timestamp_micros("changed_micros").alias("changed_at"),
            F.timestamp_micros("next_retry_micros").alias("next_retry_at"), "is_final",
        )
    )


def stream_stuck_detector(changes: DataFrame, lateness="1 hour") -> DataFrame:
    """Entities that stayed in PROCESSING for longer than the staleness limit (append mode).

    `changes` has entity_id, change_id, changed_at and status.  Only the last change in a slice
    of that length can be stuck, so changes are first reduced to one row per entity and slice.
    """
    order = F.struct("changed_at", "change_id")
    slices = (
        changes.withWatermark("changed_at", lateness)
        .groupBy(F.window("changed_at", K.STALE_AFTER).alias("slice"), "entity_id")
        .agg(
            F.min("changed_at").alias("first_at"),
            F.max("changed_at").alias("last_at"),
            F.max_by("status", order).alias("last_status"),
        )
        .select(
            "entity_id", F.window_time("slice").alias("slice_time"),
            F.col("slice.end").alias("slice_end"), "first_at", "last_at", "last_status",
        )
    )
    return slices.groupBy("entity_id").transformWithStateInPandas(
        StuckDetector(), outputStructType=STUCK_OUTPUT, outputMode="append", timeMode="EventTime"
    )


MERGE_SESSIONS = {"spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true"}


def stream_sessions(events: DataFrame, key: str, time: str, gap=K.STALE_AFTER, lateness="1 hour") -> DataFrame:
    """Closed sessions per key (append mode); run with MERGE_SESSIONS to merge before the shuffle."""
    return (
        events.withWatermark(time, lateness)
        .groupBy(key, F.session_window(time, gap).alias("s"))
        .agg(F.count("*").alias("event_count"))
        .select(
            key, F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"),
            "event_count",
        )
    )


def stream_dedup_requests(requests: DataFrame) -> DataFrame:
    """The first request seen per approval (approval_id, requested_at), for good.

    The guard it stands for never forgets an id, so its state holds every id and no request
    is late.
    """
    return requests.select("approval_id", "requested_at").dropDuplicates(["approval_id"])

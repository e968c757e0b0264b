"""Each streaming operator run to the end of the driver's event stream."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duebook.plans.stored import create, tables_at
from duebook.schemas import struct
from duebook.sources import fixtures, requests
from duebook.storage import new_path
from duebook.streaming import operators as S
from duebook.streaming import stored
from duebook.streaming.run import (
    append_available, appended, latest, stream_files, update_available,
)

EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def event_stream(spark, folder) -> DataFrame:
    raw = stream_files(spark, folder, EVENTS, pattern="events.parquet")
    return raw.withColumn("ts", F.col("ts").cast("timestamp"))


def attempts_of(events: DataFrame) -> DataFrame:
    """Delivery attempts by rule: two or three per notification, one success in four."""
    k = F.get_json_object("props", "$.k").cast("int")
    return events.select(
        F.expr("(event_id * 2) div 5").alias("notification_id"),
        F.col("event_id").alias("attempt_id"),
        F.col("ts").alias("attempt_at"),
        (k % 4 == 0).alias("delivered"),
    )


def dedup_requests_of(events: DataFrame) -> DataFrame:
    return events.select(F.expr("event_id div 13").alias("approval_id"), F.col("ts").alias("requested_at"))


def payments_to_balances(c) -> DataFrame:
    """Stored invoices after the whole payment stream, settled batch by batch."""
    source = new_path(c.spark, "payment-stream")
    c.payments.write.parquet(source)
    tables = create(tables_at(c.spark, new_path(c.spark, "settled"), 16), {"invoices": c.new_invoices})
    stream = stream_files(c.spark, source, struct("payments"), files_per_batch=4)
    stored.settle_payments(tables, stream, new_path(c.spark, "settled-state"))
    return tables.read("invoices").drop("payment_term_id", "dispute_flag", "created_date")


def notification_metrics(c, slide=None) -> DataFrame:
    outbox = fixtures.outbox_of(event_stream(c.spark, c.folder), _orders(c))
    stream = S.stream_notification_metrics(outbox, slide=slide)
    path = update_available(stream, "notification-metrics")
    keys = ["window_start", "window_end", "notification_status"]
    return latest(c.spark, path, stream.schema, keys)


def retry_machine(c) -> DataFrame:
    stream = S.stream_retry_machine(attempts_of(event_stream(c.spark, c.folder)))
    tables = tables_at(c.spark, new_path(c.spark, "retry-status"), 16)
    stored.retry_status(tables, stream, new_path(c.spark, "retry-state"))
    return tables.read(stored.STATUS).drop("is_final")


def stuck_detector(c) -> DataFrame:
    changes = requests.status_changes_of(fixtures.events_of(event_stream(c.spark, c.folder), _orders(c)))
    stream = S.stream_stuck_detector(changes)
    return appended(c.spark, append_available(stream, "stuck"), stream.schema)


def session_stream(c) -> DataFrame:
    stream = S.stream_sessions(event_stream(c.spark, c.folder), "user_id", "ts")
    return appended(
        c.spark, append_available(stream, "sessions", **S.MERGE_SESSIONS), stream.schema
    )


def dedup_requests(c) -> DataFrame:
    tables = tables_at(c.spark, new_path(c.spark, "requests"), 16)
    stored.dedup_requests(tables, dedup_requests_of(event_stream(c.spark, c.folder)), new_path(c.spark, "dedup-state"))
    return tables.read(stored.SEEN).select("approval_id")


def _orders(c):
    return fixtures.order_count(c.spark, c.folder)

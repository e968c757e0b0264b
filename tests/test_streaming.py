"""Streams over several batches and restarts give the batch result."""

import pytest
from pyspark.sql import functions as F

from duebook.operators import replay
from duebook.operators.payments import paid_per_invoice
from duebook.plans.stored import tables_at
from duebook.sources import fixtures, requests
from duebook.streaming import jobs, stored
from duebook.streaming import operators as S
from duebook.streaming.run import append_available, appended, latest, stream_files, update_available

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"


@pytest.fixture(scope="module")
def events(spark):
    return fixtures.read_table(spark, FOLDER, "events").cache()


def in_turns(spark, events, folder, build, run):
    """Feed three consecutive slices of the events, restarting the stream for each."""
    cuts = [F.lit(f"2024-01-{d:02d}").cast("timestamp") for d in (1, 11, 21)] + [None]
    path = None
    for i in range(3):
        part = events.where(F.col("ts") >= cuts[i])
        if cuts[i + 1] is not None:
            part = part.where(F.col("ts") < cuts[i + 1])
        part.coalesce(1).write.parquet(f"{folder}/in", mode="append")
        stream = build(stream_files(spark, f"{folder}/in", SCHEMA))
        path = run(stream, "turns", path)
    return stream.schema, path


def rows(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def test_retry_machine(spark, events, tmp_path):
    tables = tables_at(spark, str(tmp_path / "status"), 8)

    def run(stream, name, path):
        path = path or str(tmp_path / "state")
        stored.retry_status(tables, stream, path)
        return path

    in_turns(spark, events, str(tmp_path), lambda s: S.stream_retry_machine(jobs.attempts_of(s)), run)
    got = tables.read(stored.STATUS).drop("is_final")
    want = replay.retry_outcomes(jobs.attempts_of(events))
    mark = events.agg(F.max("ts") - F.expr("INTERVAL 1 HOUR")).first()[0]
    due = (F.col("notification_status") == "RETRY") & (F.col("next_retry_at") <= F.lit(mark))
    want = want.withColumn("notification_status", F.when(due, "RETRY_DUE").otherwise(F.col("notification_status")))
    assert rows(got) == rows(want)
    assert {r[0] for r in got.select("notification_status").distinct().collect()} >= {"SENT", "RETRY_DUE"}


def test_stuck_detector(spark, events, tmp_path):
    orders = F.lit(1500)

    def changes(df):
        return requests.status_changes_of(fixtures.events_of(df, orders))

    schema, path = in_turns(
        spark, events, str(tmp_path), lambda s: S.stream_stuck_detector(changes(s)), append_available
    )
    got = appended(spark, path, schema)
    mark = events.agg((F.max("ts") - F.expr("INTERVAL 1 HOUR"))).scalar()
    want = replay.stuck_intervals(changes(events), mark)
    # A change is only reported once the slice after its own is complete.
    slot = F.window("stuck_since", "30 minutes")["end"] + F.expr("INTERVAL 30 MINUTES")
    assert rows(got) == rows(want.withColumn("_end", slot).where(F.col("_end") <= mark).drop("_end"))
    assert got.count() > 50


def test_sessions(spark, events, tmp_path):
    schema, path = in_turns(
        spark, events, str(tmp_path), lambda s: S.stream_sessions(s, "user_id", "ts"),
        lambda s, n, p: append_available(s, n, p, **S.MERGE_SESSIONS),
    )
    mark = events.agg(F.max("ts") - F.expr("INTERVAL 1 HOUR")).scalar()
    want = replay.sessions(events, "user_id", "ts", "event_id").where(F.col("session_end") <= mark)
    assert rows(appended(spark, path, schema)) == rows(want)


def test_metrics_and_dedup(spark, events, tmp_path):
    outbox = fixtures.outbox_of(events, F.lit(1500))
    schema, path = in_turns(
        spark, events, str(tmp_path / "a"),
        lambda s: S.stream_notification_metrics(fixtures.outbox_of(s, F.lit(1500))), update_available,
    )
    got = latest(spark, path, schema, ["window_start", "window_end", "notification_status"])
    assert got.agg(F.sum("notification_count")).first()[0] == outbox.count()
    schema, path = in_turns(
        spark, events, str(tmp_path / "b"), lambda s: S.stream_dedup_requests(jobs.dedup_requests_of(s)),
        append_available,
    )
    got = appended(spark, path, schema)
    ids = jobs.dedup_requests_of(events).select("approval_id").distinct().count()
    assert got.count() == got.select("approval_id").distinct().count() == ids


def test_payment_totals(spark, tmp_path):
    pays = spark.range(1, 200).select(
        F.col("id").alias("payment_id"), (F.col("id") % 13).alias("invoice_id"),
        F.lit("1.25").cast("decimal(12,2)").alias("payment_amount"),
    )
    pays.repartition(6).write.parquet(str(tmp_path / "in"))
    stream = S.stream_payments_to_balances(
        stream_files(spark, str(tmp_path / "in"), pays.schema, files_per_batch=2)
    )
    path = update_available(stream, "totals")
    assert rows(latest(spark, path, stream.schema, ["invoice_id"])) == rows(paid_per_invoice(pays))

"""Streams that keep stored tables: replays, restarts, bounded state, late rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from duebook.operators import replay
from duebook.operators.payments import apply_payments
from duebook.plans.stored import create, tables_at
from duebook.schemas import struct
from duebook.streaming import operators as S
from duebook.streaming import stored
from duebook.streaming.run import stream_files
from tests.frames import frame, invoice

T0 = dt.datetime(2026, 7, 1)


def rows(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def feed(spark, folder, batch, schema):
    spark.createDataFrame(batch, schema).coalesce(1).write.parquet(str(folder), mode="append")


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


# ---- settlement -----------------------------------------------------------------------------------
def payments_of(spark, pairs):
    return frame(spark, "payments", [
        {"payment_id": i, "invoice_id": n, "payment_amount": a} for i, (n, a) in enumerate(pairs, 1)])


def test_batches_settle_what_they_touch_and_no_batch_counts_twice(spark, tmp_path):
    invoices = frame(spark, "invoices", [invoice(i) for i in range(1, 41)])
    batches = [[(1, "10.00"), (2, "60.00")], [(1, "90.00"), (999, "5.00")], [(2, "40.00"), (3, "1.00"), (3, "2.50")]]
    tables = create(tables_at(spark, str(tmp_path / "t"), 16), {"invoices": invoices})
    tables.keys.update({stored.TOTALS: "invoice_id"})
    before = set(tables.read("invoices").inputFiles())
    for number, batch in enumerate(batches):
        for _ in range(2 if number == 1 else 1):  # the second batch comes twice
            run = tables.run()
            stored.settle_batch(run, payments_of(spark, batch), number)
            run.publish()
    want = apply_payments(invoices, payments_of(spark, sum(batches, [])))
    assert rows(tables.read("invoices")) == rows(want)
    after = set(tables.read("invoices").inputFiles())
    assert len(before & after) >= len(before) - 4  # invoices 1, 2, 3 and an unknown one
    assert {r.invoice_id: r.batch for r in tables.read(stored.TOTALS).collect()} == {1: 1, 999: 1, 2: 2, 3: 2}


def test_a_stopped_stream_goes_on(spark, tmp_path):
    invoices = frame(spark, "invoices", [invoice(i) for i in range(1, 11)])
    tables = create(tables_at(spark, str(tmp_path / "t"), 4), {"invoices": invoices})
    everything = []
    for turn in range(3):
        batch = payments_of(spark, [(turn + 1, "30.00"), (1, "10.00")])
        everything.append(batch)
        batch.coalesce(1).write.parquet(str(tmp_path / "in"), mode="append")
        stored.settle_payments(tables, stream_files(spark, str(tmp_path / "in"), struct("payments")), str(tmp_path / "state"))
    whole = everything[0].unionByName(everything[1]).unionByName(everything[2])
    assert rows(tables.read("invoices")) == rows(apply_payments(invoices, whole))


# ---- duplicate guard --------------------------------------------------------------------------------
def test_repeats_far_beyond_the_window(spark, tmp_path):
    tables, schema = tables_at(spark, str(tmp_path / "t"), 8), "approval_id long, requested_at timestamp"
    held = []
    for day in range(4):
        # Ids of this day, one of the day before and one of the first day, each of them twice.
        ids = [*range(10 * day, 10 * day + 10), max(0, 10 * day - 5), 0, None]
        feed(spark, tmp_path / "in", [(i, at(1440 * day + n)) for n, i in enumerate(ids * 2)], schema)
        stream = stream_files(spark, str(tmp_path / "in"), schema)
        held.append(stored.state_rows(stored.dedup_requests(tables, stream, str(tmp_path / "state"))))
    seen = tables.read(stored.SEEN)
    assert sorted(r.approval_id for r in seen.collect()) == list(range(40))
    assert {r.requested_at for r in seen.where("approval_id = 0").collect()} == {at(0)}
    assert max(held) <= 12 + 1  # a day's ids, not all of them


# ---- retries ------------------------------------------------------------------------------------------
ATTEMPTS = "notification_id long, attempt_id long, attempt_at timestamp, delivered boolean"


def history():
    """Attempts of 30 notifications; some end early and are tried again long afterwards."""
    out, n = [], 0
    for i in range(30):
        for k in range(1 + i % 5):
            n += 1
            out.append((i, n, at(120 * k + i), (i + k) % 4 == 3))
    return sorted(out, key=lambda r: r[2])


def outcome(spark, attempts):
    got = replay.retry_outcomes(spark.createDataFrame(attempts, ATTEMPTS))
    return {r.notification_id: (r.notification_status, r.retry_count, r.changed_at) for r in got.collect()}


def run_retries(spark, tmp_path, parts, tables, start=None):
    queries = []
    for part in parts:
        feed(spark, tmp_path / "in", part, ATTEMPTS)
        stream = S.stream_retry_machine(stream_files(spark, str(tmp_path / "in"), ATTEMPTS), start=start)
        queries.append(stored.retry_status(tables, stream, str(tmp_path / "state")))
    return queries


def status_of(tables):
    return {
        r.notification_id: (r.notification_status.removesuffix("_DUE"), r.retry_count, r.changed_at)
        for r in tables.read(stored.STATUS).collect()
    }


def test_a_stream_started_half_way_equals_the_whole_history(spark, tmp_path):
    attempts = history()
    half = len(attempts) // 2
    early = outcome(spark, attempts[:half])
    outbox = spark.createDataFrame(
        [(i, s, n, t, T0) for i, (s, n, t) in early.items()],
        "notification_id long, notification_status string, retry_count int, updated_at timestamp, created_at timestamp",
    )
    start, closed = stored.open_and_closed(outbox)
    tables = create(tables_at(spark, str(tmp_path / "t"), 8), {})
    tables.keys[stored.STATUS] = "notification_id"
    run = tables.run()
    run.create(stored.STATUS, closed)
    run.publish()
    run_retries(spark, tmp_path, [attempts[half:]], tables, start)
    want = outcome(spark, attempts)
    got = status_of(tables)
    later = {a[0] for a in attempts[half:]} | {i for i, (s, _, _) in early.items() if s in stored.FINAL}
    assert {i: got[i] for i in later} == {i: want[i] for i in later}


def test_ended_notifications_leave_the_state(spark, tmp_path):
    attempts = history()
    third = len(attempts) // 3
    tables = tables_at(spark, str(tmp_path / "t"), 8)
    # A last attempt far in the future of a notification that was sent moves the watermark on.
    far = [(3, 10**6, at(10**5), False), (3, 10**6 + 1, at(2 * 10**5), True)]
    # All other notifications end first.
    ends = [(i, 10**5 + i, at(9000 + i), True) for i in range(30)]
    parts = [attempts[:third], attempts[third:], ends, far[:1], far[1:], [(3, 10**6 + 2, at(3 * 10**5), True)]]
    queries = run_retries(spark, tmp_path, parts, tables)
    want = outcome(spark, attempts + ends)
    assert status_of(tables) == want  # attempts after the end are turned away
    assert all(r.is_final for r in tables.read(stored.STATUS).collect())
    assert stored.state_rows(queries[2]) >= 20 and stored.state_rows(queries[-1]) <= 2


# ---- late rows ------------------------------------------------------------------------------------------
EVENTS = "event_id long, created_at timestamp, notification_status string"


def test_on_time_and_late_rows_are_all_rows(spark, tmp_path):
    tables, n = tables_at(spark, str(tmp_path / "t"), 4), 0
    batches = [
        [(i, at(i), "SENT") for i in range(100)],
        [(100 + i, at(2000 + i), "SENT") for i in range(50)] + [(200, at(1990), "DEAD")],
        [(300, at(5), "SENT"), (301, at(2040), "SENT"), (302, None, "SENT"), (303, at(1000), "DEAD"), (304, at(4000), "SENT")],
    ]
    for batch in batches:
        n += len(batch)
        feed(spark, tmp_path / "in", batch, EVENTS)
        stored.split_late(
            tables, stream_files(spark, str(tmp_path / "in"), EVENTS), "created_at", "1 hour", str(tmp_path / "ok"), str(tmp_path / "s1")
        )
    late = {r.event_id for r in tables.read(stored.LATE).collect()}
    assert late == {300, 302, 303}
    on_time = spark.read.schema(EVENTS).parquet(str(tmp_path / "ok"))
    assert on_time.count() + len(late) == n and tables.pointer()["notes"]["rows_late"] == 3
    # The operator behind it drops nothing, and counts every row in time.
    from duebook.streaming.run import ROCKSDB, STATE_STORE, settings

    metrics = S.stream_notification_metrics(stream_files(spark, str(tmp_path / "ok"), EVENTS))
    with settings(spark, {STATE_STORE: ROCKSDB}):
        query = (
            metrics.writeStream.outputMode("update").format("memory").queryName("late_metrics")
            .option("checkpointLocation", str(tmp_path / "s2")).trigger(availableNow=True).start()
        )
        query.awaitTermination()
    assert stored.dropped_behind_watermark(query) == 0
    top = spark.table("late_metrics").groupBy("window_start", "notification_status").agg(F.max("notification_count").alias("n"))
    assert top.agg(F.sum("n")).first()[0] == on_time.count()


def test_dropped_rows_are_counted(spark, tmp_path):
    for batch in ([(1, at(5000), "SENT")], [(2, at(5001), "SENT"), (3, at(1), "SENT"), (4, at(2), "DEAD")]):
        feed(spark, tmp_path / "in", batch, EVENTS)
        from duebook.streaming.run import ROCKSDB, STATE_STORE, settings

        metrics = S.stream_notification_metrics(stream_files(spark, str(tmp_path / "in"), EVENTS))
        with settings(spark, {STATE_STORE: ROCKSDB}):
            query = (
                metrics.writeStream.outputMode("update").foreachBatch(lambda b, n: b.count())
                .option("checkpointLocation", str(tmp_path / "s")).trigger(availableNow=True).start()
            )
            query.awaitTermination()
    assert stored.dropped_behind_watermark(query) == 2


def test_the_state_of_many_notifications_is_kept_by_group(spark, tmp_path):
    """Exchanges with the state store grow with the groups of a batch, not with its notifications."""
    attempts = [(i, 3 * i + k, at(2 * k + i % 7), (i + k) % 4 == 3) for i in range(900) for k in range(1 + i % 3)]
    feed(spark, tmp_path / "in", attempts, ATTEMPTS)
    tables = tables_at(spark, str(tmp_path / "t"), 8)
    stream = S.stream_retry_machine(stream_files(spark, str(tmp_path / "in"), ATTEMPTS), groups=16)
    query = stored.retry_status(tables, stream, str(tmp_path / "state"))
    assert status_of(tables) == outcome(spark, attempts)
    assert max(op.numRowsTotal for p in query.recentProgress for op in p.stateOperators) <= 16 * 3

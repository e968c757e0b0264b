"""Guards, limits and conservation of the workflow transitions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from duebook import constants as K
from duebook.operators import checks, workflow as W
from tests.frames import by, customer, frame, invoice

NOW_TEXT = "2026-08-01 12:00:00"
NOW = dt.datetime(2026, 8, 1, 12)


@pytest.fixture
def now(spark):
    return F.lit(NOW_TEXT).cast("timestamp")


def approval(i, status="PENDING", number="N0001", action=K.REMINDER_ACTION):
    return {
        "approval_id": i, "conversation_id": f"conv-{i}", "requested_at": NOW, "requested_by": "u",
        "action_type": action, "action_description": "d", "approval_status": status,
        "action_payload": f'{{"invoice_number": "{number}", "channel": "EMAIL"}}',
    }


def note(i, status="PENDING", retries=0, **more):
    return {
        "notification_id": i, "approval_id": i, "conversation_id": "c", "notification_type": "T",
        "recipient_address": "a@example.com", "notification_status": status, "retry_count": retries,
        "max_retry_count": 3, "created_at": NOW - dt.timedelta(minutes=i), "updated_at": NOW, **more,
    }


def contacts(spark):
    invoices = frame(spark, "invoices", [invoice(i, customer=i) for i in range(1, 8)])
    customers = frame(
        spark, "customers",
        [
            customer(1), customer(2, email=None), customer(3, email="   "), customer(4, email=""),
            customer(5, status="inactive", email=None), customer(6, status="BLOCKED", email=" b@x.org "),
        ],
    )
    return invoices, customers


def test_recipient_reasons_and_their_order(spark):
    asked = spark.createDataFrame([(f"N{i:04d}",) for i in (1, 2, 3, 4, 5, 6, 7, 99)], "invoice_number string")
    invoices, customers = contacts(spark)
    got = by(W.resolve_recipients(asked, invoices, customers), "invoice_number", "recipient_address", "reason")
    assert got == {
        "N0001": ("c1@example.com", None), "N0002": (None, "NO_EMAIL"), "N0003": (None, "BLANK_EMAIL"),
        "N0004": (None, "NO_EMAIL"), "N0005": (None, "CUSTOMER_INACTIVE"), "N0006": ("b@x.org", None),
        # The customer of invoice 7 does not exist, invoice 99 neither.
        "N0007": (None, "INVOICE_NOT_FOUND"), "N0099": (None, "INVOICE_NOT_FOUND"),
    }
    other = W.resolve_recipients(asked, invoices, customers, status_first=False)
    assert by(other, "invoice_number", "reason")["N0005"] == "NO_EMAIL"


def test_decisions_apply_once_and_only_to_pending(spark, now):
    approvals = frame(spark, W.APPROVALS, [approval(1), approval(2), approval(3, "EXECUTED")])
    decisions = spark.createDataFrame(
        [(10, 1, " approved "), (11, 1, "REJECTED"), (12, 2, "maybe"), (13, 3, "APPROVED"), (14, 9, "APPROVED")],
        "decision_id bigint, approval_id bigint, decision string",
    ).withColumns({"reviewed_by": F.lit("boss"), "comments": F.lit("ok")})
    out = W.decide_approvals(approvals, decisions, now)
    assert by(out.tables[W.APPROVALS], "approval_id", "approval_status", "reviewed_by", "reviewed_at") == {
        1: ("APPROVED", "boss", NOW), 2: ("PENDING", None, None), 3: ("EXECUTED", None, None)
    }
    assert by(out.rejects, "decision_id", "reason") == {
        11: "ALREADY_DECIDED", 12: "INVALID_DECISION", 13: "NOT_PENDING", 14: "NOT_FOUND"
    }
    assert out.events.count() == 1


def test_execution_queues_one_notification_per_approval(spark, now):
    invoices, customers = contacts(spark)
    approvals = frame(
        spark, W.APPROVALS,
        [approval(1, "APPROVED"), approval(2, "PENDING"), approval(3, "APPROVED", action="OTHER"),
         approval(4, "APPROVED"), approval(5, "APPROVED", "N0002")],
    )
    outbox = frame(spark, W.OUTBOX, [note(4)])
    asked = spark.createDataFrame(
        [(i, a) for i, a in enumerate([1, 1, 2, 3, 4, 5, 77])], "request_id bigint, approval_id bigint"
    )
    out = W.execute_approved(approvals, outbox, asked, now, invoices, customers)
    assert by(out.rejects, "request_id", "reason") == {
        1: "NOT_APPROVED", 2: "NOT_APPROVED", 3: "UNSUPPORTED_ACTION", 4: "DUPLICATE_NOTIFICATION",
        5: "NO_EMAIL", 6: "NOT_FOUND",
    }
    new = out.tables[W.OUTBOX].where("notification_id > 4").collect()
    assert [(r["notification_id"], r["approval_id"], r["recipient_address"]) for r in new] == [
        (5, 1, "c1@example.com")
    ]
    assert new[0]["message_body"].startswith("Hello Customer 1,\n\nThis is a payment reminder for invoice N0001.")
    states = by(out.tables[W.APPROVALS], "approval_id", "approval_status", "execution_message")
    assert states[1] == (
        "EXECUTED",
        "Payment reminder for invoice N0001 was queued. Recipient: c1@example.com. Notification ID: 5. "
        "Status: PENDING.",
    )
    assert states[4] == ("APPROVED", None)


def test_claiming(spark, now):
    minute = dt.timedelta(minutes=1)
    outbox = frame(
        spark, W.OUTBOX,
        [note(1), note(2, "RETRY", 1, next_retry_at=NOW), note(3, "RETRY", 1, next_retry_at=NOW + minute),
         note(4, "PENDING", 3), note(5, "SENT"), note(6, error_message="old")],
    )
    claimed = W.claim_notifications(outbox, now)
    assert [k for k, s in by(claimed, "notification_id", "notification_status").items() if s == "PROCESSING"] == [
        1, 2, 6
    ]
    assert by(claimed, "notification_id", "error_message")[6] is None
    # Number 6 is the oldest.
    oldest = by(W.claim_notifications(outbox, now, n=1), "notification_id", "notification_status")
    assert [k for k, s in oldest.items() if s == "PROCESSING"] == [6]
    simple = by(W.claim_notifications(outbox, now, retries=False), "notification_id", "notification_status")
    assert sorted(k for k, s in simple.items() if s == "PROCESSING") == [1, 4, 6]


def test_delivery_then_requeue_then_claim(spark, now):
    outbox = frame(
        spark, W.OUTBOX,
        [note(1, "PROCESSING"), note(2, "PROCESSING", 1), note(3, "PROCESSING", 2), note(4, "SENT")],
    )
    results = spark.createDataFrame(
        [(1, 1, None), (2, 2, "x" * 5000), (3, 3, "no"), (4, 4, None), (5, 3, None), (6, 9, None)],
        "attempt_id bigint, notification_id bigint, error string",
    )
    out = W.apply_delivery_results(outbox, results, now)
    after = out.tables[W.OUTBOX]
    got = by(after, "notification_id", "notification_status", "retry_count", "next_retry_at", "dead_at")
    assert got == {
        1: ("SENT", 0, None, None), 2: ("RETRY", 2, NOW + dt.timedelta(minutes=1), None),
        3: ("DEAD", 3, None, NOW), 4: ("SENT", 0, None, None),
    }
    assert len(by(after, "notification_id", "error_message")[2]) == 5000
    assert by(out.rejects, "attempt_id", "reason") == {4: "NOT_PROCESSING", 5: "ALREADY_SETTLED", 6: "NOT_FOUND"}

    log = frame(spark, W.RECOVERY, [])
    asked = spark.createDataFrame(
        [(1, 2), (2, 3), (3, 3), (4, 1), (5, 9)], "request_id bigint, notification_id bigint"
    ).withColumns({"recovered_by": F.lit(None).cast("string"), "recovery_reason": F.lit("again")})
    back = W.requeue(after, log, asked, now)
    assert back.tables[W.OUTBOX].count() == 4
    assert by(back.tables[W.RECOVERY], "recovery_id", "notification_id", "previous_status", "recovered_by") == {
        1: (2, "RETRY", "AR_MANAGER"), 2: (3, "DEAD", "AR_MANAGER")
    }
    assert sorted(r["request_id"] for r in back.rejects.collect()) == [3, 4, 5]
    again = W.claim_notifications(back.tables[W.OUTBOX], now)
    assert by(again, "notification_id", "notification_status", "retry_count") == {
        1: ("SENT", 0), 2: ("PROCESSING", 0), 3: ("PROCESSING", 0), 4: ("SENT", 0)
    }


def test_run_from_start_to_sent(spark, now):
    invoices, customers = contacts(spark)
    empty = {t: frame(spark, t, []) for t in (W.RUNS, W.APPROVALS, W.CONVERSATIONS, W.OUTBOX)}
    asked = spark.createDataFrame([(1, "N0001"), (2, "N0005"), (3, "N0006")], "request_id bigint, invoice_number string")
    begun = W.start_orchestrations(
        asked, empty[W.RUNS], empty[W.APPROVALS], empty[W.CONVERSATIONS], invoices, customers, now
    )
    runs, approvals = begun.tables[W.RUNS], begun.tables[W.APPROVALS]
    assert by(runs, "orchestration_id", "orchestration_status", "approval_id") == {
        1: ("WAITING_APPROVAL", 1), 2: ("FAILED", None), 3: ("WAITING_APPROVAL", 2)
    }
    conversations = by(begun.tables[W.CONVERSATIONS], "conversation_id", "conversation_status")
    assert len(conversations) == 2 and all(len(c) == 36 for c in conversations)
    # The approval of run 3 was rejected in between.
    approvals = approvals.withColumn(
        "approval_status", F.when(F.col("approval_id") == 2, "REJECTED").otherwise(F.col("approval_status"))
    )
    ids = spark.createDataFrame([(1,), (1,), (2,), (3,), (8,)], "orchestration_id bigint")
    done = W.complete_orchestrations(runs, approvals, empty[W.OUTBOX], ids, invoices, customers, now)
    assert by(done.tables[W.RUNS], "orchestration_id", "orchestration_status", "notification_id", "error_message") == {
        1: ("COMPLETED", 1, None),
        2: ("FAILED", None, "Customer 5 does not have an email address."),
        3: ("FAILED", None, "Approval request could not be approved."),
    }
    assert by(done.tables[W.APPROVALS], "approval_id", "approval_status", "execution_message") == {
        1: ("EXECUTED", "Notification 1 created by orchestrator."), 2: ("REJECTED", None)
    }
    sent = done.tables[W.OUTBOX].first()
    assert (sent["notification_status"], sent["processed_at"], sent["recipient_address"]) == (
        "SENT", NOW, "c1@example.com"
    )
    assert [r["current_step"] for r in done.events.orderBy("step").collect()] == [
        "CREATE_OUTBOX", "PROCESS_NOTIFICATION", "SEND_NOTIFICATION", "COMPLETED"
    ]
    assert by(done.rejects, "orchestration_id", "reason") == {
        2: "NOT_WAITING", 3: "APPROVAL_NOT_PENDING", 8: "NOT_FOUND"
    }


def test_two_runs_on_one_approval(spark, now):
    invoices, customers = contacts(spark)
    approvals = frame(spark, W.APPROVALS, [approval(1)])
    runs = frame(
        spark, W.RUNS,
        [{"orchestration_id": i, "invoice_number": "N0001", "approval_id": 1, "started_at": NOW,
          "orchestration_status": "WAITING_APPROVAL", "current_step": "WAITING_APPROVAL"} for i in (1, 2)],
    )
    done = W.complete_orchestrations(
        runs, approvals, frame(spark, W.OUTBOX, []), runs.select("orchestration_id"), invoices, customers, now
    )
    assert done.tables[W.OUTBOX].count() == 1
    assert by(done.tables[W.RUNS], "orchestration_id", "orchestration_status") == {1: "COMPLETED", 2: "FAILED"}


def test_readiness(spark, now):
    rows = spark.createDataFrame([("a", "PASS"), ("b", "WARNING"), ("c", "PASS")], "check_name string, status string")
    out = checks.readiness_report(rows).first()
    assert (out["overall_status"], out["readiness_score"]) == ("WARNING", 66.7)
    old = NOW - dt.timedelta(minutes=31)
    runs = frame(spark, W.RUNS, [{"orchestration_id": i, "orchestration_status": "STARTED", "started_at": t}
                                 for i, t in enumerate([old, NOW - dt.timedelta(minutes=30)])])
    outbox = frame(spark, W.OUTBOX, [note(1, "PROCESSING", updated_at=old)])
    found = by(checks.workflow_checks(runs, frame(spark, W.APPROVALS, []), outbox, now), "check_name", "message")
    assert found["Stale STARTED Orchestrations"] == "1 stale orchestration(s) found."
    assert found["Stuck Notifications"] == "1 stuck notification(s) found."


def shared_number(spark):
    """Two invoices under one number, and one with a number of its own."""
    invoices = frame(spark, "invoices", [
        invoice(1, customer=1), {**invoice(2, customer=6), "invoice_number": "N0001"}, invoice(3, customer=1)])
    return invoices, frame(spark, "customers", [customer(1), customer(6)])


def test_a_number_of_two_invoices_is_turned_down(spark, now):
    invoices, customers = shared_number(spark)
    asked = spark.createDataFrame([("N0001",), ("N0003",)], "invoice_number string")
    found = W.resolve_recipients(asked, invoices, customers)
    assert by(found, "invoice_number", "reason") == {"N0001": "AMBIGUOUS_INVOICE", "N0003": None}
    assert found.count() == 2

    approvals = frame(spark, W.APPROVALS, [approval(1, "APPROVED", "N0001"), approval(2, "APPROVED", "N0003")])
    outbox = frame(spark, W.OUTBOX, [])
    wanted = spark.createDataFrame([(1, 1), (2, 2)], "request_id bigint, approval_id bigint")
    out = W.execute_approved(approvals, outbox, wanted, now, invoices, customers)
    assert by(out.rejects, "request_id", "reason") == {1: "AMBIGUOUS_INVOICE"}
    assert out.tables[W.APPROVALS].count() == 2 and out.tables[W.OUTBOX].count() == 1


def test_runs_keep_their_number_of_rows_when_invoices_share_a_number(spark, now):
    invoices, customers = shared_number(spark)
    none = {t: frame(spark, t, []) for t in (W.RUNS, W.APPROVALS, W.CONVERSATIONS, W.OUTBOX)}
    wanted = spark.createDataFrame([(1, "N0001"), (2, "N0003")], "request_id bigint, invoice_number string")
    started = W.start_orchestrations(
        wanted, none[W.RUNS], none[W.APPROVALS], none[W.CONVERSATIONS], invoices, customers, now)
    assert started.tables[W.RUNS].count() == 2 and started.tables[W.APPROVALS].count() == 1
    runs = started.tables[W.RUNS]
    ended = W.complete_orchestrations(
        runs, started.tables[W.APPROVALS], none[W.OUTBOX], runs.select("orchestration_id"), invoices, customers, now)
    assert ended.tables[W.RUNS].count() == 2 and ended.tables[W.OUTBOX].count() == 1


def test_requests_that_share_an_id_are_settled_by_their_values(spark):
    rows = [(1, 7, "b"), (1, 7, "a"), (1, 8, "z")]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "k int, request_id int, v string")
        assert W.first_request(df, "k", "request_id").first()["v"] == "a"


def test_a_run_is_turned_down_for_each_copy_of_its_approval(spark, now):
    runs = frame(spark, W.RUNS, [
        {"orchestration_id": 1, "invoice_number": "N0001", "approval_id": 5, "orchestration_status": "QUEUED"},
        {"orchestration_id": 2, "invoice_number": "N0002", "approval_id": 6, "orchestration_status": "WAITING_APPROVAL"},
        {"orchestration_id": 3, "invoice_number": "N0001", "orchestration_status": "FAILED"},
    ])
    approvals = frame(spark, W.APPROVALS, [approval(5), approval(5), approval(6), approval(6)])
    asked = spark.createDataFrame([(1,), (2,), (3,), (9,)], "orchestration_id bigint")
    out = W.complete_orchestrations(runs, approvals, frame(spark, W.OUTBOX, []), asked, *contacts(spark), now)
    got = sorted((r.orchestration_id, r.reason) for r in out.rejects.collect())
    assert got == [(1, "NOT_WAITING")] * 2 + [(2, "NO_EMAIL")] * 2 + [(3, "NOT_WAITING"), (9, "NOT_FOUND")]

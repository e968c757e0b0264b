"""Boundaries and invariants of normalisation, payments, aging and risk."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from duebook.operators import aging, lookups, merge, normalize, payments, risk, staging
from duebook.plans.refresh import refresh
from duebook.sources import raw
from tests.frames import by, customer, day, frame, invoice

AS_OF = dt.date(2026, 10, 31)


def due_before(days):
    return str(AS_OF - dt.timedelta(days=days))


def test_bucket_and_priority_boundaries(spark):
    cases = [0, 1, 30, 31, 60, 61, 90, 91, -5]
    rows = [invoice(i, due=due_before(d), amount="9999.99") for i, d in enumerate(cases)]
    rows += [invoice(50, due=due_before(91), amount="10000"), invoice(51, due=due_before(90), amount="10000")]
    rows += [invoice(52, due=None), invoice(53, due=due_before(95), owed="0")]
    out = aging.ar_aging_detail(
        frame(spark, "invoices", rows), frame(spark, "customers", [customer(1)]), AS_OF
    )
    got = by(out, "invoice_id", "days_past_due", "aging_bucket", "collection_priority", "recommended_action")
    assert got == {
        0: (0, "CURRENT", "MONITOR", "MONITOR UNTIL DUE DATE"),
        1: (1, "1-30 DAYS", "LOW", "SEND FIRST PAYMENT REMINDER"),
        2: (30, "1-30 DAYS", "LOW", "SEND FIRST PAYMENT REMINDER"),
        3: (31, "31-60 DAYS", "MEDIUM", "SEND SECOND PAYMENT REMINDER"),
        4: (60, "31-60 DAYS", "MEDIUM", "SEND SECOND PAYMENT REMINDER"),
        5: (61, "61-90 DAYS", "HIGH", "MAKE COLLECTION CALL"),
        6: (90, "61-90 DAYS", "HIGH", "MAKE COLLECTION CALL"),
        7: (91, "90+ DAYS", "HIGH", "CALL CUSTOMER AND REQUEST PAYMENT COMMITMENT"),
        8: (0, "CURRENT", "MONITOR", "MONITOR UNTIL DUE DATE"),
        50: (91, "90+ DAYS", "CRITICAL", "ESCALATE TO COLLECTIONS MANAGER"),
        51: (90, "61-90 DAYS", "HIGH", "MAKE COLLECTION CALL"),
        # Unknown due date: no days, oldest bucket, nothing to chase yet.
        52: (None, "90+ DAYS", "MONITOR", "MONITOR UNTIL DUE DATE"),
    }


def test_summaries_at_a_date(spark):
    rows = [invoice(i, due=due_before(d)) for i, d in enumerate([0, 10, 40, 70, 100])]
    invoices = frame(spark, "invoices", rows)
    assert by(aging.aging_summary(invoices, AS_OF), "aging_bucket", "invoice_count") == {
        "CURRENT": 1, "1-30 DAYS": 1, "31-60 DAYS": 1, "61-90 DAYS": 1, "90+ DAYS": 1
    }
    assert by(aging.priority_summary(invoices, AS_OF), "collection_priority", "invoice_count") == {
        "HIGH": 2, "MEDIUM": 1, "LOW": 1
    }


def test_reporting_date_adds_days_to_the_newest_day(spark):
    rows = [invoice(1, invoice_date=day("2026-07-01T18:30:00")), invoice(2)]
    for r in rows[:1]:
        r["invoice_date"] = day("2026-07-03T18:30:00")
    assert aging.reporting_date(frame(spark, "invoices", rows)).first()[0] == dt.date(2026, 8, 17)


@pytest.mark.parametrize(
    "owed, days, overdue, partial, score",
    [
        ("0", 0, 0, 0, 0), ("24999.99", 0, 0, 0, 10), ("25000", 0, 0, 0, 20), ("50000", 0, 0, 0, 30),
        ("100000", 0, 0, 0, 35), ("0", 1, 1, 0, 15), ("0", 31, 4, 0, 25), ("0", 61, 5, 0, 45),
        ("0", 90, 9, 0, 45), ("0", 91, 10, 0, 55), ("0", 0, 0, 1, 5), ("0", 0, 0, 2, 5),
        ("0", 0, 0, 3, 10), ("100000", 91, 10, 3, 100),
    ],
)
def test_score_tiers(spark, owed, days, overdue, partial, score):
    facts = spark.createDataFrame(
        [(Decimal(owed), days, overdue, partial)],
        "total_outstanding decimal(18,2), maximum_days_past_due int, overdue_invoice_count bigint, "
        "partially_paid_invoice_count bigint",
    )
    assert risk.risk_score(facts).first()["risk_score"] == score


def test_levels(spark):
    rows = spark.createDataFrame([(s,) for s in (0, 1, 39, 40, 59, 60, 79, 80, 100)], "risk_score int")
    assert by(risk.customer_risk_summary(rows), "risk_score", "risk_level") == {
        0: "NO RISK", 1: "LOW", 39: "LOW", 40: "MEDIUM", 59: "MEDIUM", 60: "HIGH", 79: "HIGH",
        80: "CRITICAL", 100: "CRITICAL",
    }


def test_customer_without_invoices_is_kept(spark):
    invoices = frame(spark, "invoices", [invoice(1, customer=1, due=due_before(95), amount="20000")])
    out = risk.customer_collection_summary(
        frame(spark, "customers", [customer(1), customer(2)]), invoices, AS_OF
    )
    got = by(out, "customer_id", "total_invoice_count", "amount_over_90_days", "risk_score")
    assert got == {1: (1, Decimal("20000.00"), 50), 2: (0, Decimal("0.00"), 0)}


def sample(spark):
    """The hand-made case: one invoice, two lines, one payment."""
    return {
        "customers": frame(spark, "customers", [customer(1, customer_name="Apex Manufacturing")]),
        "terms": normalize.default_payment_terms(spark),
        "invoices": frame(
            spark, "invoices", [invoice(1, amount="1500", invoice_number="TEST-INV-1001")]
        ),
        "lines": frame(
            spark, "invoice_lines",
            [
                {"invoice_line_id": 1, "invoice_id": 1, "product_code": "LAPTOP-001", "quantity": 1,
                 "unit_price": 1000, "line_amount": 1000},
                {"invoice_line_id": 2, "invoice_id": 1, "product_code": "MONITOR-001", "quantity": 2,
                 "unit_price": 250, "line_amount": 500},
            ],
        ),
        "payments": frame(
            spark, "payments",
            [{"payment_id": 1, "invoice_id": 1, "payment_date": day("2026-07-20"), "payment_amount": 500,
              "payment_method": "ACH"}],
        ),
    }


def test_sample_case(spark):
    s = sample(spark)
    rows = normalize.invoice_relationships(**s, invoice_number="TEST-INV-1001").collect()
    assert len(rows) == 2 and {r["payment_amount"] for r in rows} == {Decimal("500.00")}
    header = normalize.reconcile_header_lines(s["invoices"], s["lines"]).first()
    assert (header["header_total"], header["line_total"], header["difference"]) == (1500, 1500, 0)
    after = payments.apply_payments(s["invoices"], s["payments"]).first()
    assert (after["amount_paid"], after["outstanding_amount"], after["invoice_status"]) == (
        500, 1000, "PARTIALLY_PAID",
    )


def test_payments_over_exact_and_reset(spark):
    invoices = frame(
        spark, "invoices",
        [invoice(1), invoice(2), invoice(3, paid="40", owed="60", status="PARTIALLY_PAID"), invoice(4)],
    )
    pays = frame(
        spark, "payments",
        [{"payment_id": i, "invoice_id": n, "payment_date": day("2026-07-02"), "payment_amount": a}
         for i, (n, a) in enumerate([(1, 60), (1, 60), (2, 100), (4, 30), (4, 20)])],
    )
    got = by(
        payments.apply_payments(invoices, pays), "invoice_id", "amount_paid", "outstanding_amount",
        "invoice_status",
    )
    assert got == {
        1: (120, 0, "PAID"), 2: (100, 0, "PAID"), 3: (0, 100, "OPEN"), 4: (50, 50, "PARTIALLY_PAID")
    }


def test_merge(spark):
    target = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "k int, name string, n int")
    source = spark.createDataFrame([(2, None), (3, "c")], "k int, name string")
    assert by(merge.upsert(target, source, ["k"]), "k", "name", "n") == {
        1: ("a", 10), 2: (None, 20), 3: ("c", None)
    }
    assert by(merge.update_from(target, source, ["k"]), "k", "name", "n") == {1: ("a", 10), 2: (None, 20)}


def test_queue_filter_ignores_case_and_lookup_reports_unknown(spark):
    invoices = frame(spark, "invoices", [invoice(1, due=due_before(95)), invoice(2, due=due_before(5))])
    customers = frame(spark, "customers", [customer(1)])
    detail = aging.ar_aging_detail(invoices, customers, AS_OF)
    assert [r["invoice_id"] for r in aging.collection_queue(detail, "hIgH").collect()] == [1]
    ids = spark.createDataFrame([(1,), (9,), (9,)], "customer_id bigint")
    assert [r["error"] for r in lookups.unknown_customers(ids, customers).collect()] == [
        "Customer does not exist: 9"
    ]
    assert lookups.overdue_invoices(invoices, customers, ids, 1, AS_OF).first()["invoice_id"] == 1


def test_missing_headers_are_listed(spark):
    with pytest.raises(ValueError, match="Missing source columns: quantity, country"):
        raw.conform_columns(
            spark.createDataFrame(
                [("",) * 6], ["Invoice", "StockCode", "Description", "InvoiceDate", "Price", "Customer ID"]
            )
        )


def test_coercion(spark):
    rows = [
        ("1", "A", "x" * 600, "12.5", "12/1/2009 7:45", "1.005", "13085.7", "y" * 120),
        ("2", "B", None, "abc", "2009-12-01", "", "none", None),
    ]
    names = ["invoice_no", "stock_code", "description", "quantity", "invoice_date", "unit_price",
             "customer_id", "country"]
    a, b = raw.coerce_types(spark.createDataFrame(rows, names)).collect()
    assert (a["quantity"], a["invoice_date"], a["customer_id"]) == (
        Decimal("12.5"), dt.datetime(2009, 12, 1, 7, 45), 13085
    )
    assert len(a["description"]) == 600 and len(a["country"]) == 120
    assert (b["quantity"], b["unit_price"], b["customer_id"]) == (None, None, None)
    assert b["invoice_date"] == dt.datetime(2009, 12, 1)


def test_ids_are_not_read_as_doubles(spark):
    row = ("1", "A", "x", "1", "2009-12-01", "1", "9007199254740993", "y")
    names = ["invoice_no", "stock_code", "description", "quantity", "invoice_date", "unit_price",
             "customer_id", "country"]
    assert raw.coerce_types(spark.createDataFrame([row], names)).first()["customer_id"] == 9007199254740993


def test_listed_files_are_read_by_their_own_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Invoice,Country,StockCode\n1,FR,\"say \"\"hi\"\"\"\n")
    (tmp_path / "b.csv").write_text("Country,Invoice,StockCode\nPE,2,x\n")
    rows = raw.read_raw_transactions(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")])
    got = {r["Invoice"]: (r["Country"], r["StockCode"], r["source_part"]) for r in rows.collect()}
    assert got == {"1": ("FR", 'say "hi"', "a.csv"), "2": ("PE", "x", "b.csv")}
    with pytest.raises(Exception, match="header"):
        raw.read_raw_transactions(spark, [str(tmp_path)]).collect()


def test_a_merge_source_with_a_repeated_key_is_an_error(spark):
    target = spark.createDataFrame([(1, "a")], "k int, name string")
    source = spark.createDataFrame([(1, "b"), (1, "c")], "k int, name string")
    for change in (merge.upsert, merge.update_from):
        with pytest.raises(Exception, match="several rows"):
            change(target, source, ["k"]).collect()


def test_overdue_invoices_are_whole_unless_a_limit_is_asked_for(spark):
    invoices = frame(spark, "invoices", [invoice(i, due=due_before(5 + i % 7)) for i in range(1, 251)])
    customers = frame(spark, "customers", [customer(1)])
    ids = spark.createDataFrame([(1,)], "customer_id bigint")
    assert lookups.overdue_invoices(invoices, customers, ids, as_of=AS_OF).count() == 250
    three = lookups.overdue_invoices(invoices, customers, ids, 3, AS_OF)
    assert by(three, "overdue_rank", "invoice_id") == {1: 6, 2: 13, 3: 20}


def test_rejects_name_every_broken_rule(spark):
    df = spark.createDataFrame([("1", "x" * 60), ("2" * 30, "x" * 60), ("3", "ok")],
                               ["invoice_no", "stock_code"])
    good, bad = staging.split_rejects(df, staging.length_rules({"invoice_no": 20, "stock_code": 50}))
    assert [r["invoice_no"] for r in good.collect()] == ["3"]
    assert sorted(r["failed_rules"] for r in bad.collect()) == [
        "invoice_no too long; stock_code too long", "stock_code too long"
    ]


HEADER = "Invoice,StockCode,Description,Quantity,InvoiceDate,Price,Customer ID,Country\n"
LINES = [
    "100,A,Lamp,2,2026-07-01 10:00:00,10.00,7.0,Norway",
    "100,A,Lamp,2,2026-07-01 10:00:00,10.00,7.0,Norway",  # an exact copy counts twice
    "100,B,Desk,1,2026-07-01 09:00:00,100.50,7.0,Norway",
    "C101,A,Lamp,-2,2026-07-02 10:00:00,10.00,7.0,Norway",
    "102,A,Lamp,3,2026-07-03 10:00:00,0.00,8.0,Peru",
    "103,A,Lamp,3,2026-07-03 10:00:00,5.00,,Peru",
    "104,A,Lamp,0,2026-07-03 10:00:00,5.00,9.0,Peru",
    "10" + "5" * 30 + ",A,Lamp,1,2026-07-03 10:00:00,5.00,9.0,Peru",
    "106,A," + "x" * 700 + ",1,2026-07-03 10:00:00,5.00,9.0,Peru",
]


def test_refresh_from_files(spark, tmp_path):
    for name, rows in (("a", LINES[:4]), ("b", LINES[4:])):
        (tmp_path / f"{name}.csv").write_text(HEADER + "\n".join(rows) + "\n")
    loaded = F.lit("2026-08-01").cast("timestamp")
    parts = {n: str(tmp_path / f"{n}.csv") for n in ("a", "b")}
    unpaid = refresh(spark, parts, str(tmp_path / "run0"), "retail", loaded)
    assert unpaid["payments"].count() == 0
    assert {r["invoice_status"] for r in unpaid["invoices"].collect()} == {"OPEN"}
    assert by(unpaid["rejects"], "failed_rules", "source_part") == {
        "invoice_no too long": "b", "description too long": "b"}
    payments = frame(spark, "payments", [{"payment_id": 1, "invoice_id": 1, "payment_amount": "70.25"}])
    tables = refresh(spark, parts, str(tmp_path / "run1"), "retail", loaded, payments=payments)
    staged = tables["stg_retail_transactions"]
    assert sorted(r[0] for r in staged.select("transaction_id").collect()) == list(range(1, 8))
    got = by(
        tables["invoices"], "invoice_number", "invoice_id", "invoice_amount", "invoice_date", "due_date",
        "invoice_status",
    )
    assert got == {
        "100": (1, Decimal("140.50"), dt.datetime(2026, 7, 1, 9), dt.datetime(2026, 7, 31, 9), "PARTIALLY_PAID"),
        "102": (2, Decimal("0.00"), dt.datetime(2026, 7, 3, 10), dt.datetime(2026, 8, 2, 10), "OPEN"),
    }
    assert tables["invoice_lines"].count() == 4
    # Customers come from every staged row, also from cancelled and empty ones.
    assert by(tables["customers"], "customer_id", "current_balance") == {
        7: Decimal("70.25"), 8: Decimal("0.00"), 9: Decimal("0.00")
    }
    again = refresh(spark, parts, str(tmp_path / "run2"), "retail", loaded, payments=payments)
    for t in tables:
        assert sorted(map(str, again[t].collect())) == sorted(map(str, tables[t].collect()))

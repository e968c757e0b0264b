"""The management report and the approximate profile on the stored tables."""

from duebook.operators import staging
from duebook.plans.core import core
from duebook.plans.reports import management_report

FOLDER = "/root/testdata/sf0.001"


def test_management_report(spark):
    c = core(spark, FOLDER)
    report = management_report(
        c.invoices, c.customers, c.orchestrations, c.approvals, c.outbox, "2001-08-20", n=5
    )
    rows = {name: df.collect() for name, df in report.items()}
    assert list(rows) == ["dashboard", "aging", "priority", "overdue", "actions", "summary"]
    figures = {(r["section"], r["metric"]): r["value"] for r in rows["dashboard"]}
    assert figures["AR PORTFOLIO", "total_invoices"] == c.invoices.count()
    assert sum(r["invoice_count"] for r in rows["aging"]) == c.invoices.where("outstanding_amount > 0").count()
    assert [r["bucket_order"] for r in rows["aging"]] == sorted(r["bucket_order"] for r in rows["aging"])
    assert len(rows["overdue"]) == len(rows["actions"]) == 5
    assert rows["summary"][0]["summary"].startswith("The accounts receivable agent is currently managing $")


def test_approximate_profile_is_close(spark):
    c = core(spark, FOLDER)
    exact = staging.profile_transactions(c.staging).first()
    rough = staging.profile_transactions(c.staging, approximate=True).first()
    assert rough["total_rows"] == exact["total_rows"]
    assert abs(rough["unique_invoices"] - exact["unique_invoices"]) <= 0.2 * exact["unique_invoices"]

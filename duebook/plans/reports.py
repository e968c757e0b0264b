"""The management report as a set of frames."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duebook.operators import aging, kpis


def management_report(
    invoices: DataFrame, customers: DataFrame, runs: DataFrame, approvals: DataFrame,
    outbox: DataFrame, today, n=10,
) -> dict[str, DataFrame]:
    """Dashboard, aging, priorities, overdue invoices, actions and summary text.

    Aging and priorities are taken at `today`, the other parts at the reporting date.
    """
    detail = aging.ar_aging_detail(invoices, customers)
    indicators = (
        kpis.portfolio_kpis(invoices),
        kpis.overdue_kpis(detail),
        kpis.orchestration_kpis(runs),
        kpis.approval_kpis(approvals),
        kpis.notification_kpis(outbox),
    )
    return {
        "dashboard": kpis.executive_dashboard(*indicators),
        "aging": aging.aging_summary(invoices, today),
        "priority": aging.priority_summary(invoices, today),
        "overdue": aging.top_overdue_invoices(invoices, customers, n),
        "actions": kpis.recent_orchestrations(runs, n),
        "summary": kpis.collections_narrative(*indicators),
    }


def report_lines(report: dict[str, DataFrame]) -> DataFrame:
    """The whole report as (section, item, metric, value, text), one figure or text a line."""

    def figures(part, item, metrics):
        df = report[part].select(item.cast("string").alias("item"), *[F.col(m).cast("double").alias(m) for m in metrics])
        return df.unpivot("item", list(metrics), "metric", "value").select(
            F.lit(part.upper()).alias("section"), "item", "metric", "value", F.lit(None).cast("string").alias("text")
        )

    def texts(part, item, metric, text):
        return report[part].select(
            F.lit(part.upper()).alias("section"), item.cast("string").alias("item"), F.lit(metric).alias("metric"),
            F.lit(None).cast("double").alias("value"), text.alias("text"),
        )

    dashboard = report["dashboard"].select(
        F.lit("DASHBOARD").alias("section"), F.col("section").alias("item"), "metric",
        F.col("value").cast("double").alias("value"), F.lit(None).cast("string").alias("text"),
    )
    amounts = ["invoice_count", "outstanding_amount"]
    parts = [
        dashboard,
        figures("aging", F.col("aging_bucket"), amounts),
        figures("priority", F.col("collection_priority"), amounts),
        figures("overdue", F.col("invoice_number"), ["days_past_due", "outstanding_amount"]),
        texts("actions", F.col("orchestration_id"), "orchestration_status", F.col("orchestration_status")),
        texts("summary", F.lit(None), "summary", F.col("summary")),
    ]
    return reduce(DataFrame.unionByName, parts)

"""Management indicators, the collections narrative and the dashboard."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duebook import constants as K
from duebook.functions.expr import fill, first_match, money_text, total0

FIGURE = "decimal(32,4)"


def _statuses(column: str, names: dict[str, str]) -> list[Column]:
    return [F.count_if(F.col(column) == status).alias(name) for name, status in names.items()]


def _portfolio() -> list[Column]:
    return [
        F.count("*").alias("total_invoices"),
        total0(F.col("invoice_amount")).alias("total_invoice_amount"),
        total0(F.col("amount_paid")).alias("total_amount_paid"),
        total0(F.col("outstanding_amount")).alias("total_outstanding"),
        *_statuses(
            "invoice_status",
            {
                "paid_invoices": "PAID",
                "open_invoices": "OPEN",
                "partially_paid_invoices": "PARTIALLY_PAID",
            },
        ),
    ]


def _overdue() -> list[Column]:
    zero = F.lit(0)
    return [
        F.count("*").alias("overdue_invoices"),
        total0(F.col("outstanding_amount")).alias("overdue_outstanding"),
        F.coalesce(F.max("days_past_due"), zero).alias("maximum_days_past_due"),
        F.round(F.coalesce(F.avg("days_past_due"), zero), 4).alias("average_days_past_due"),
    ]


def _orchestration() -> list[Column]:
    names = ("completed", "failed", "waiting_approval", "processing", "queued")
    return [
        F.count("*").alias("total_orchestrations"),
        *_statuses("orchestration_status", {n: n.upper() for n in names}),
    ]


def _approval() -> list[Column]:
    names = ("pending", "approved", "executed")
    return [F.count("*").alias("total_approvals"), *_statuses("approval_status", {n: n.upper() for n in names})]


def _notification() -> list[Column]:
    names = ("pending", "processing", "sent", "failed")
    return [
        F.count("*").alias("total_notifications"),
        *_statuses("notification_status", {n: n.upper() for n in names}),
    ]


def _late(aging: DataFrame) -> DataFrame:
    return aging.where((F.col("days_past_due") > 0) & (F.col("outstanding_amount") > 0))


def portfolio_kpis(invoices: DataFrame, by=()) -> DataFrame:
    return invoices.groupBy(*by).agg(*_portfolio())


def overdue_kpis(aging: DataFrame, by=()) -> DataFrame:
    return _late(aging).groupBy(*by).agg(*_overdue())


def orchestration_kpis(runs: DataFrame, by=()) -> DataFrame:
    return runs.groupBy(*by).agg(*_orchestration())


def approval_kpis(approvals: DataFrame, by=()) -> DataFrame:
    return approvals.groupBy(*by).agg(*_approval())


def notification_kpis(outbox: DataFrame, by=()) -> DataFrame:
    return outbox.groupBy(*by).agg(*_notification())


def _by_each(df: DataFrame, dimensions, measures) -> DataFrame:
    """Measures over all rows and per value of each dimension alone, from one pass.

    `dimension` is ALL or a column's name, `value` its value (NULL is a value of its own); with
    no rows there is the ALL row only.
    """
    if not dimensions:
        return df.agg(*measures).select(F.lit("ALL").alias("dimension"), F.lit(None).cast("string").alias("value"), "*")
    sets = [[], *[[d] for d in dimensions]]
    inside = [(F.grouping(d) == 0).alias(f"_in_{d}") for d in dimensions]
    rows = df.groupingSets(sets, *dimensions).agg(*inside, *measures)
    dimension = first_match([(F.col(f"_in_{d}"), F.lit(d)) for d in dimensions], F.lit("ALL"))
    value = first_match([(F.col(f"_in_{d}"), F.col(d).cast("string")) for d in dimensions])
    return rows.select(
        dimension.alias("dimension"), value.alias("value"),
        *[c for c in rows.columns if c not in dimensions and not c.startswith("_in_")],
    )


def indicators_by_each(invoices, aging, runs, approvals, outbox, dimensions) -> tuple[DataFrame, ...]:
    """The five indicator frames over all rows and per value of each dimension.

    Every frame has the dimensions as columns and is read once, however many there are.
    """
    return (
        _by_each(invoices, dimensions, _portfolio()), _by_each(_late(aging), dimensions, _overdue()),
        _by_each(runs, dimensions, _orchestration()), _by_each(approvals, dimensions, _approval()),
        _by_each(outbox, dimensions, _notification()),
    )


def recent_orchestrations(runs: DataFrame, n=10) -> DataFrame:
    return (
        runs.orderBy(F.desc("orchestration_id"))
        .limit(n)
        .select(
            "orchestration_id", "invoice_number", "orchestration_status", "current_step",
            "approval_id", "notification_id", "started_at", "completed_at", "error_message",
        )
    )


def collections_narrative(
    portfolio, overdue, orchestrations, approvals, notifications, by=(), subject=K.NARRATIVE_SUBJECT
) -> DataFrame:
    """One text per group (or one in all) from the five indicator frames.

    Each frame has the `by` columns and one row per group.  The frames are stacked and folded
    into one row per group, so no frame has to be joined to another.
    """
    wanted = {
        "total_outstanding": (portfolio, "total_outstanding"),
        "overdue_invoices": (overdue, "overdue_invoices"),
        "overdue_outstanding": (overdue, "overdue_outstanding"),
        "days": (overdue, "maximum_days_past_due"),
        "completed": (orchestrations, "completed"),
        "failed": (orchestrations, "failed"),
        "waiting": (orchestrations, "waiting_approval"),
        "pending": (approvals, "pending"),
        "sent": (notifications, "sent"),
        "undelivered": (notifications, "failed"),
    }
    frames = (portfolio, overdue, orchestrations, approvals, notifications)
    slim = [
        f.select(*by, *[F.col(c).alias(name) for name, (owner, c) in wanted.items() if owner is f])
        for f in frames
    ]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), slim)
    figures = stacked.groupBy(*by).agg(
        *[F.coalesce(F.max(n), F.lit(0)).alias(n) for n in wanted]
    )
    f, say = F.col, K.NARRATIVE
    owed, late = f("total_outstanding"), f("overdue_outstanding")
    share = F.when(owed > 0, late.cast("double") / owed.cast("double") * 100).otherwise(F.lit(0.0))
    queued = F.greatest(f("waiting"), f("pending"))
    trouble = (f("failed") > 0) | (f("undelivered") > 0)
    sentences = [
        fill(say["opening"], F.lit(subject), money_text(owed)),
        fill(say["overdue"], f("overdue_invoices"), money_text(late), F.format_string("%.1f", share)),
        first_match(
            [
                (f("overdue_invoices") == 0, F.lit(say["none"])),
                (f("days") >= 90, fill(say["days_90"], f("days"))),
                (f("days") >= 60, fill(say["days_60"], f("days"))),
                (f("days") >= 30, fill(say["days_30"], f("days"))),
            ],
            F.lit(say["recent"]),
        ),
        F.when(queued > 0, fill(say["waiting"], queued)).otherwise(say["not_waiting"]),
        fill(say["runs"], f("completed"), f("failed")),
        fill(say["sent"], f("sent"), f("undelivered")),
        F.when(trouble, say["exceptions"]).otherwise(say["no_exceptions"]),
    ]
    return figures.select(*by, F.concat_ws(" ", *sentences).alias("summary"))


def executive_dashboard(portfolio, overdue, orchestrations, approvals, notifications) -> DataFrame:
    """All indicators as (section, metric, value)."""
    sections = {
        "AR PORTFOLIO": portfolio,
        "OVERDUE": overdue,
        "ORCHESTRATION": orchestrations,
        "APPROVALS": approvals,
        "NOTIFICATIONS": notifications,
    }

    def rows(name, df):
        figures = df.select(*[F.col(c).cast(FIGURE).alias(c) for c in df.columns])
        return figures.unpivot([], df.columns, "metric", "value").select(
            F.lit(name).alias("section"), "metric", "value"
        )

    return reduce(DataFrame.unionByName, [rows(n, df) for n, df in sections.items()])

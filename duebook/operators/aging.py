"""Invoice aging, collection priority and the collection queue."""

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duebook import constants as K
from duebook.functions.expr import (
    MONEY, TOTAL, at_least, first_match, position_in, top_with, total, total0,
)

QUEUE_COLUMNS = (
    "invoice_id", "invoice_number", "customer_id", "customer_name", "outstanding_amount",
    "days_past_due", "aging_bucket", "collection_priority", "recommended_action",
)


def reporting_date(invoices: DataFrame, lag=K.REPORTING_LAG_DAYS) -> DataFrame:
    """One row: day of the newest invoice plus `lag` days."""
    return invoices.agg(F.date_add(F.to_date(F.max("invoice_date")), lag).alias("as_of_date"))


def as_of_column(invoices: DataFrame, as_of=None) -> Column:
    """The caller's date, or the reporting date as a scalar subquery."""
    if as_of is None:
        return reporting_date(invoices).scalar()
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, datetime.datetime):
        as_of = as_of.date()
    return F.lit(as_of).cast("date")


def days_late(as_of: Column, due: Column) -> Column:
    """Whole days past due; negative before the due day."""
    return F.datediff(as_of, F.to_date(due))


def bucket_of(days: Column) -> Column:
    """Aging bucket of raw days past due; the last bucket also takes unknown days."""
    named = [
        (days <= high if low is None else days.between(low, high), F.lit(name))
        for name, low, high in K.AGING_BUCKETS
        if high is not None
    ]
    return first_match(named, F.lit(K.OLDEST_BUCKET))


def _tiers(days: Column, amount: Column, text_at: int, default: str) -> Column:
    pairs = []
    for tier in K.COLLECTION_TIERS:
        reached = days >= tier[0]
        if tier[1] is not None:
            reached = reached & (amount >= F.lit(tier[1]).cast(MONEY))
        pairs.append((reached, F.lit(tier[text_at])))
    return first_match(pairs, F.lit(default))


def priority_of(days: Column, amount: Column) -> Column:
    return _tiers(days, amount, 2, K.COLLECTION_DEFAULT[0])


def action_of(days: Column, amount: Column) -> Column:
    return _tiers(days, amount, 3, K.COLLECTION_DEFAULT[1])


def bucket_order(bucket: Column) -> Column:
    return position_in(bucket, [b[0] for b in K.AGING_BUCKETS], missing=len(K.AGING_BUCKETS) + 1)


def priority_order(priority: Column) -> Column:
    return position_in(priority, K.PRIORITIES)


def age_invoices(invoices: DataFrame, as_of=None) -> DataFrame:
    """Invoices with money outstanding, with days past due and aging bucket."""
    date = as_of_column(invoices, as_of)
    return (
        invoices.where(F.col("outstanding_amount") > 0)
        .withColumn("as_of_date", date)
        .withColumn("_raw_days", days_late(F.col("as_of_date"), F.col("due_date")))
        .withColumn("days_past_due", at_least(F.col("_raw_days"), 0))
        .withColumn("aging_bucket", bucket_of(F.col("_raw_days")))
        .drop("_raw_days")
    )


def ar_aging_detail(invoices: DataFrame, customers: DataFrame, as_of=None) -> DataFrame:
    """Open invoices with customer, bucket, priority and recommended action."""
    days, amount = F.col("days_past_due"), F.col("outstanding_amount")
    return (
        age_invoices(invoices, as_of)
        .join(customers.select("customer_id", "customer_name"), "customer_id")
        .select(
            "invoice_id", "invoice_number", "customer_id", "customer_name", "invoice_date",
            "due_date", "as_of_date", "invoice_amount", "amount_paid", "outstanding_amount",
            "invoice_status", "days_past_due", "aging_bucket",
            priority_of(days, amount).alias("collection_priority"),
            action_of(days, amount).alias("recommended_action"),
        )
    )


def aging_bucket_summary(aging: DataFrame) -> DataFrame:
    return (
        aging.groupBy("aging_bucket")
        .agg(
            F.count("*").alias("invoice_count"),
            total(F.col("invoice_amount")).alias("total_invoice_amount"),
            total(F.col("amount_paid")).alias("total_paid"),
            total(F.col("outstanding_amount")).alias("outstanding_amount"),
        )
        .withColumn("bucket_order", bucket_order(F.col("aging_bucket")))
        .orderBy("bucket_order")
    )


def top_overdue_customers(invoices: DataFrame, customers: DataFrame, n=10, as_of=None) -> DataFrame:
    """Customers with the largest open balance.

    Invoices are added up per customer before names are joined, so a customer with very many
    invoices costs no more than others after the map side.
    """
    old = F.when(F.col("aging_bucket") == K.OLDEST_BUCKET, F.col("outstanding_amount")).otherwise(0)
    sums = (
        age_invoices(invoices, as_of)
        .groupBy("customer_id")
        .agg(
            F.count("invoice_id").alias("open_invoice_count"),
            F.max("days_past_due").alias("maximum_days_past_due"),
            total(F.col("outstanding_amount")).alias("total_outstanding_amount"),
            F.sum(old).cast(TOTAL).alias("amount_over_90_days"),
        )
    )
    names = customers.select("customer_id", "customer_name")
    order = [F.desc("total_outstanding_amount"), F.asc("customer_id")]
    return top_with(sums, order, n, names, "customer_id")


def _judged(aged: DataFrame) -> DataFrame:
    days, amount = F.col("days_past_due"), F.col("outstanding_amount")
    return aged.withColumns(
        {"collection_priority": priority_of(days, amount), "recommended_action": action_of(days, amount)}
    )


def top_of_queue(invoices: DataFrame, customers: DataFrame, n: int, as_of=None) -> DataFrame:
    """The first `n` rows of the collection queue; names are joined to those only."""
    order = [
        priority_order(F.col("collection_priority")), F.desc("outstanding_amount"), F.asc("invoice_id")
    ]
    names = customers.select("customer_id", "customer_name")
    return top_with(_judged(age_invoices(invoices, as_of)), order, n, names, "customer_id").select(*QUEUE_COLUMNS)


def top_overdue_invoices(invoices: DataFrame, customers: DataFrame, n=10, as_of=None) -> DataFrame:
    """The invoices longest past due; names are joined to the `n` rows only."""
    late = _judged(age_invoices(invoices, as_of).where(F.col("days_past_due") > 0))
    order = [F.desc("days_past_due"), F.desc("outstanding_amount"), F.asc("invoice_id")]
    names = customers.select("customer_id", "customer_name")
    return top_with(late, order, n, names, "customer_id").select(
        "invoice_id", "invoice_number", "customer_name", "due_date", "outstanding_amount",
        "days_past_due", "aging_bucket", "collection_priority", "recommended_action",
    )


def collection_queue(aging: DataFrame, priority: str | None = None, n: int | None = None) -> DataFrame:
    """Open invoices by priority, then outstanding amount; optionally one priority or the top n."""
    if priority is not None:
        aging = aging.where(F.col("collection_priority") == F.upper(F.lit(priority)))
    queue = aging.select(*QUEUE_COLUMNS).orderBy(
        priority_order(F.col("collection_priority")), F.desc("outstanding_amount"), "invoice_id"
    )
    return queue if n is None else queue.limit(n)


def aging_validation(aging: DataFrame, invoices: DataFrame) -> DataFrame:
    """Row count, bad rows and totals of the aging frame against the invoice table."""
    open_rows = F.when(F.col("outstanding_amount") > 0, F.col("outstanding_amount"))
    from_table = invoices.agg(total(open_rows)).scalar()
    return aging.agg(
        F.count("*").alias("aging_invoice_count"),
        F.count_if(F.col("outstanding_amount") <= 0).alias("invalid_aging_rows"),
        F.count_if(F.col("recommended_action").isNull()).alias("missing_recommended_actions"),
        total(F.col("outstanding_amount")).alias("aging_view_outstanding"),
    ).withColumn("invoice_table_outstanding", from_table)


def aging_summary(invoices: DataFrame, as_of) -> DataFrame:
    """Buckets straight from the invoices at the caller's date."""
    return (
        age_invoices(invoices, as_of)
        .groupBy("aging_bucket")
        .agg(
            F.count("*").alias("invoice_count"),
            total0(F.col("outstanding_amount")).alias("outstanding_amount"),
        )
        .withColumn("bucket_order", bucket_order(F.col("aging_bucket")))
        .orderBy("bucket_order")
    )


def priority_summary(invoices: DataFrame, as_of) -> DataFrame:
    """Overdue invoices by HIGH, MEDIUM and LOW at the caller's date, without the critical tier."""
    late = days_late(as_of_column(invoices, as_of), F.col("due_date"))
    tiers = [(low, name) for low, amount, name, _ in K.COLLECTION_TIERS if amount is None]
    named = first_match([(late >= low, F.lit(name)) for low, name in tiers])
    return (
        invoices.where(F.col("outstanding_amount") > 0)
        .withColumn("collection_priority", named)
        .where(F.col("collection_priority").isNotNull())
        .groupBy("collection_priority")
        .agg(
            F.count("*").alias("invoice_count"),
            total0(F.col("outstanding_amount")).alias("outstanding_amount"),
        )
        .withColumn("priority_order", priority_order(F.col("collection_priority")) - 1)
        .orderBy("priority_order")
    )

"""Customer collection summary, risk score and risk level."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duebook import constants as K
from duebook.functions.expr import at_least, first_match, steps, total
from duebook.operators.aging import as_of_column, days_late


def invoice_facts(invoices: DataFrame, as_of=None) -> DataFrame:
    """Per customer totals over its invoices, aged in the same pass."""
    owed = F.col("outstanding_amount")
    is_open = owed > 0
    days = F.when(is_open, at_least(F.col("_raw_days"), 0))
    # Unknown due dates count as the oldest bucket.
    oldest = is_open & ((F.col("_raw_days") > 90) | F.col("_raw_days").isNull())
    overdue = days > 0
    aged = invoices.withColumn(
        "_raw_days", days_late(as_of_column(invoices, as_of), F.col("due_date"))
    )
    return aged.groupBy("customer_id").agg(
        F.count("invoice_id").alias("total_invoice_count"),
        F.count_if(is_open).alias("open_invoice_count"),
        total(F.col("invoice_amount")).alias("total_invoiced"),
        total(F.col("amount_paid")).alias("total_paid"),
        total(owed).alias("total_outstanding"),
        F.max(days).alias("maximum_days_past_due"),
        total(F.when(overdue, owed)).alias("overdue_amount"),
        total(F.when(oldest, owed)).alias("amount_over_90_days"),
        F.count_if(F.col("invoice_status") == "PARTIALLY_PAID").alias("partially_paid_invoice_count"),
        F.count_if(overdue).alias("overdue_invoice_count"),
    )


def risk_score(facts: DataFrame) -> DataFrame:
    """`facts` plus `risk_score` from exposure, lateness, overdue count and partial payments."""
    exposure = F.col("total_outstanding")
    points = (
        F.when(exposure > 0, steps(exposure, K.EXPOSURE_POINTS, K.EXPOSURE_POSITIVE_POINTS))
        .otherwise(0),
        steps(F.col("maximum_days_past_due"), K.LATENESS_POINTS, 0),
        steps(F.col("overdue_invoice_count"), K.OVERDUE_COUNT_POINTS, 0),
        steps(F.col("partially_paid_invoice_count"), K.PARTIAL_COUNT_POINTS, 0),
    )
    return facts.withColumn(
        "risk_score", F.least(F.lit(K.RISK_SCORE_CAP), sum(points[1:], points[0])).cast("int")
    )


def customer_collection_summary(customers: DataFrame, invoices: DataFrame, as_of=None) -> DataFrame:
    """One scored row per customer, with zeros where a customer has no invoices.

    Invoices are aggregated before the join, so a customer with very many of them is
    reduced on the map side and never makes a large join partition.  Only invoices of known
    customers are reported, while the reporting date looks at all of them.
    """
    facts = invoice_facts(invoices, as_of)
    joined = customers.select("customer_id", "customer_name").join(facts, "customer_id", "left")
    filled = joined.select(
        "customer_id",
        "customer_name",
        *[
            F.coalesce(F.col(f.name), F.lit(0)).cast(f.dataType).alias(f.name)
            for f in facts.schema
            if f.name != "customer_id"
        ],
    )
    return risk_score(filled).drop("overdue_invoice_count")


def customer_risk_summary(summary: DataFrame) -> DataFrame:
    """`summary` with risk level and recommended action."""
    score = F.col("risk_score")

    def by_score(at, default):
        return first_match([(score >= r[0], F.lit(r[at])) for r in K.RISK_LEVELS], F.lit(default))

    return summary.withColumns(
        {
            "risk_level": by_score(1, K.RISK_DEFAULT[0]),
            "recommended_action": by_score(2, K.RISK_DEFAULT[1]),
        }
    )

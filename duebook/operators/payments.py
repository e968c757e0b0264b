"""Payments and their effect on invoices."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duebook.functions.expr import MONEY, money, top_with, total
from duebook.operators.constraints import orphan_count
from duebook.schemas import conform


def paid_per_invoice(payments: DataFrame) -> DataFrame:
    return payments.groupBy("invoice_id").agg(money(F.sum("payment_amount")).alias("total_paid"))


def apply_payments(invoices: DataFrame, payments: DataFrame) -> DataFrame:
    """Paid and outstanding amount and status, recomputed from all payments."""
    return settle(invoices, paid_per_invoice(payments))


def settle(invoices: DataFrame, totals: DataFrame) -> DataFrame:
    """Invoices after `total_paid` per invoice; those without payments are open."""
    amount = F.col("invoice_amount")
    paid = F.coalesce(F.col("total_paid"), F.lit(0).cast(MONEY))
    changed = {
        "amount_paid": paid,
        "outstanding_amount": F.when(
            F.col("total_paid").isNull(), amount
        ).otherwise(F.greatest(money(amount - paid), F.lit(0))),
        "invoice_status": F.when(F.col("total_paid") >= amount, "PAID")
        .when(F.col("total_paid") > 0, "PARTIALLY_PAID")
        .otherwise("OPEN"),
    }
    joined = invoices.join(totals, "invoice_id", "left")
    return conform(joined.withColumns(changed), "invoices")


def payments_by_method(payments: DataFrame) -> DataFrame:
    return payments.groupBy("payment_method").agg(
        F.count("*").alias("payment_count"), total(F.col("payment_amount")).alias("total_paid")
    )


def invoices_by_status(invoices: DataFrame) -> DataFrame:
    sums = ["invoice_amount", "amount_paid", "outstanding_amount"]
    return invoices.groupBy("invoice_status").agg(
        F.count("*").alias("invoice_count"), *[total(F.col(c)).alias(c) for c in sums]
    )


def invalid_invoice_balances(invoices: DataFrame) -> DataFrame:
    """Number of invoices whose amount is not paid + outstanding."""
    zero = F.lit(0).cast(MONEY)
    parts = F.coalesce("amount_paid", zero) + F.coalesce("outstanding_amount", zero)
    wrong = F.round("invoice_amount", 2) != F.round(parts, 2)
    return invoices.agg(F.count_if(wrong).alias("invalid_invoice_balances"))


def orphan_payments(payments: DataFrame, invoices: DataFrame) -> DataFrame:
    """Number of payments without an invoice."""
    return orphan_count(payments, "invoice_id", invoices, "orphan_payments")


def top_payments(payments: DataFrame, invoices: DataFrame, customers: DataFrame, n=20) -> DataFrame:
    """Largest payments with invoice and customer."""
    headers = invoices.join(customers.select("customer_id"), "customer_id", "left_semi").select(
        "invoice_id", "invoice_number", "customer_id", "invoice_status", "outstanding_amount"
    )
    order = [F.desc("payment_amount"), F.asc("payment_id")]
    return (
        top_with(payments, order, n, headers, "invoice_id")
        .join(customers.select("customer_id", "customer_name"), "customer_id")
        .orderBy(*order)
        .limit(n)
        .select(
            "payment_id", "invoice_number", "customer_name", "payment_date", "payment_amount",
            "payment_method", "reference_number", "invoice_status", "outstanding_amount",
        )
    )

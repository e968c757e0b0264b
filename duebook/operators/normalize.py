"""Staged transactions -> customers, invoices and invoice lines."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duebook import constants as K
from duebook.functions.expr import TOTAL, money, top_with, total, total0
from duebook.operators.blocks import dense_key
from duebook.operators.merge import update_from
from duebook.schemas import conform

INVOICE_ORDER = ("invoice_number", "customer_id")
INVOICED = ["invoice_no", "customer_id", "invoice_date", "quantity", "unit_price"]  # what customers and invoices are built from


def is_eligible() -> Column:
    """A complete, uncancelled sale."""
    return (
        F.col("customer_id").isNotNull()
        & F.col("invoice_no").isNotNull()
        & F.col("invoice_date").isNotNull()
        & ~F.col("invoice_no").startswith(K.CANCELLED_PREFIX)
        & (F.col("quantity") > 0)
        & (F.col("unit_price") >= 0)
    )


def eligible_transactions(staging: DataFrame) -> DataFrame:
    return staging.where(is_eligible())


def default_payment_terms(spark) -> DataFrame:
    from duebook.schemas import struct

    return spark.createDataFrame([K.DEFAULT_TERM], struct("payment_terms"))


def build_customers(staging: DataFrame, created: Column) -> DataFrame:
    """One customer per id found in any staged row, eligible or not."""
    ids = staging.where(F.col("customer_id").isNotNull()).select("customer_id").distinct()
    rows = ids.select(
        "customer_id",
        F.concat(F.lit(K.CUSTOMER_NAME_PREFIX), F.col("customer_id").cast("string")).alias(
            "customer_name"
        ),
        F.lit(K.CUSTOMER_TYPE).alias("customer_type"),
        F.lit(K.CUSTOMER_INDUSTRY).alias("industry"),
        F.lit(K.CUSTOMER_CREDIT_LIMIT).alias("credit_limit"),
        F.lit("0").alias("current_balance"),
        F.lit(K.CUSTOMER_RISK).alias("risk_category"),
        F.lit(K.CUSTOMER_STATUSES[0]).alias("status"),
        created.alias("created_date"),
    )
    return conform(rows, "customers")


def invoice_headers(staging: DataFrame) -> DataFrame:
    """Date and amount per (invoice number, customer), without keys."""
    return (
        eligible_transactions(staging)
        .groupBy(F.col("invoice_no").alias("invoice_number"), "customer_id")
        .agg(
            F.min("invoice_date").alias("invoice_date"),
            money(F.sum(F.col("quantity") * F.col("unit_price"))).alias("invoice_amount"),
        )
        .where(F.col("invoice_amount") >= 0)
    )


def billed(staging: DataFrame, together=()) -> DataFrame:
    """Number and customer of the rows of `invoice_headers`; no amount of eligible rows is below 0.

    Rows of one number must agree in the columns `together`: where rows lie by them, none is moved.
    """
    keys = [F.col("invoice_no").alias("invoice_number"), "customer_id"]
    return eligible_transactions(staging).select(*together, *keys).distinct().select("invoice_number", "customer_id")


def build_invoices(staging: DataFrame, terms: DataFrame, created: Column) -> DataFrame:
    """Open invoices with dense ids in (invoice number, customer) order."""
    term_id = F.lit(K.DEFAULT_TERM[0]).cast("bigint")
    due_days = terms.where(F.col("payment_term_id") == term_id).agg(F.max("due_days")).scalar()
    keyed = dense_key(invoice_headers(staging), "invoice_id", INVOICE_ORDER)
    rows = keyed.select(
        "invoice_id",
        "invoice_number",
        "customer_id",
        term_id.alias("payment_term_id"),
        "invoice_date",
        F.timestamp_add("DAY", due_days, F.col("invoice_date")).alias("due_date"),
        "invoice_amount",
        F.lit(0).alias("amount_paid"),
        F.col("invoice_amount").alias("outstanding_amount"),
        F.lit(K.INVOICE_STATUSES[0]).alias("invoice_status"),
        F.lit("N").alias("dispute_flag"),
        created.alias("created_date"),
    )
    return conform(rows, "invoices")


def build_invoice_lines(staging: DataFrame, invoices: DataFrame) -> DataFrame:
    """Eligible rows joined to their invoice for its id."""
    headers = invoices.select("invoice_id", F.col("invoice_number").alias("invoice_no"), "customer_id")
    return conform(
        eligible_transactions(staging)
        .join(headers, ["invoice_no", "customer_id"])
        .select(
            F.col("transaction_id").alias("invoice_line_id"),
            "invoice_id",
            F.col("stock_code").alias("product_code"),
            "description",
            "quantity",
            "unit_price",
            money(F.col("quantity") * F.col("unit_price")).alias("line_amount"),
        ),
        "invoice_lines",
    )


def balances(invoices: DataFrame) -> DataFrame:
    return invoices.groupBy("customer_id").agg(
        money(F.sum("outstanding_amount")).alias("current_balance")
    )


def customer_balances(customers: DataFrame, invoices: DataFrame) -> DataFrame:
    """Customers with the outstanding total of their invoices; others keep their balance."""
    return update_from(customers, balances(invoices), ["customer_id"])


def load_counts(tables: dict, amounts: dict | None = None) -> DataFrame:
    """Row count, and total of one money column, per table.

    `amounts` maps a table name to the column to add up.
    """
    amounts = amounts or {}
    parts = [
        df.agg(
            F.lit(name).alias("table_name"),
            F.count("*").alias("row_count"),
            (total(F.col(amounts[name])) if name in amounts else F.lit(None).cast(TOTAL)).alias(
                "total_amount"
            ),
        )
        for name, df in tables.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def reconcile_header_lines(invoices: DataFrame, lines: DataFrame) -> DataFrame:
    """Header total against line total."""
    line_total = lines.agg(total0(F.col("line_amount"))).scalar()
    return invoices.agg(total0(F.col("invoice_amount")).alias("header_total")).select(
        "header_total",
        line_total.alias("line_total"),
        money(F.col("header_total") - line_total, TOTAL).alias("difference"),
    )


def reconcile_invoices(invoices: DataFrame, lines: DataFrame) -> DataFrame:
    """Invoices whose lines do not add up to the header, from either side."""
    per_invoice = lines.groupBy("invoice_id").agg(total(F.col("line_amount")).alias("line_total"))
    headers = invoices.select("invoice_id", F.col("invoice_amount").cast(TOTAL).alias("header_total"))
    return headers.join(per_invoice, "invoice_id", "full_outer").select(
        "invoice_id",
        F.coalesce("header_total", F.lit(0).cast(TOTAL)).alias("header_total"),
        F.coalesce("line_total", F.lit(0).cast(TOTAL)).alias("line_total"),
    ).withColumn(
        "difference", money(F.col("header_total") - F.col("line_total"), TOTAL)
    ).where("difference <> 0")


def top_customers_by_outstanding(customers: DataFrame, invoices: DataFrame, n=10) -> DataFrame:
    """Largest outstanding balances; invoices are added up before the join."""
    per_customer = invoices.groupBy("customer_id").agg(
        F.count("invoice_id").alias("invoice_count"),
        total(F.col("invoice_amount")).alias("total_invoice_amount"),
        total(F.col("outstanding_amount")).alias("outstanding_amount"),
    )
    names = customers.select("customer_id", "customer_name")
    order = [F.desc("outstanding_amount"), F.asc("customer_id")]
    return top_with(per_customer, order, n, names, "customer_id").select(
        "customer_id", "customer_name", "invoice_count", "total_invoice_amount", "outstanding_amount"
    )


def invoice_relationships(
    customers, invoices, terms, lines, payments, invoice_number: str | None = None
) -> DataFrame:
    """Invoice lines with customer, term and payments: one row per line and payment."""
    if invoice_number is not None:
        invoices = invoices.where(F.col("invoice_number") == invoice_number)
    return (
        invoices.join(customers.select("customer_id", "customer_name"), "customer_id")
        .join(terms.select("payment_term_id", "term_name"), "payment_term_id")
        .join(
            lines.select(
                "invoice_id", "product_code", "description", "quantity", "unit_price", "line_amount"
            ),
            "invoice_id",
        )
        .join(payments.select("invoice_id", "payment_date", "payment_amount"), "invoice_id", "left")
        .select(
            "customer_name", "invoice_number", "term_name", "invoice_date", "due_date",
            "product_code", "description", "quantity", "unit_price", "line_amount",
            "payment_date", "payment_amount",
        )
    )

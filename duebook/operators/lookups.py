"""Parameterised lookups: many requested ids at once, unknown ids reported."""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from duebook import constants as K
from duebook.functions.expr import at_least, fill
from duebook.operators import aging as A
from duebook.operators import risk as R
from duebook.operators.requested import requested

OVERDUE_COLUMNS = (
    "invoice_id", "invoice_number", "invoice_date", "due_date", "outstanding_amount",
    "days_past_due", "aging_bucket", "collection_priority", "recommended_action",
)


def unknown_ids(ids: DataFrame, table: DataFrame, key: str, message: str) -> DataFrame:
    """Requested ids that `table` does not have, with an error text."""
    return (
        ids.select(key)
        .distinct()
        .join(table.select(key), key, "left_anti")
        .withColumn("error", fill(message, F.col(key)))
    )


def unknown_customers(ids: DataFrame, customers: DataFrame) -> DataFrame:
    return unknown_ids(ids, customers, "customer_id", K.ERR_CUSTOMER_LOOKUP)


def unknown_invoices(numbers: DataFrame, invoices: DataFrame) -> DataFrame:
    return unknown_ids(numbers, invoices, "invoice_number", K.ERR_INVOICE_LOOKUP)


def customer_summary(
    customers: DataFrame, invoices: DataFrame, ids: DataFrame, as_of=None
) -> DataFrame:
    """Risk rows of the requested customers.

    Invoices are filtered before they are added up; the reporting date still comes from all
    of them.
    """
    date = A.as_of_column(invoices, as_of)
    wanted = ids.select("customer_id")
    invoices = requested(invoices, wanted, "customer_id")
    asked = requested(customers, wanted, "customer_id")
    return R.customer_risk_summary(R.customer_collection_summary(asked, invoices, date))


def worst_first() -> list[Column]:
    return [F.desc("days_past_due"), F.desc("outstanding_amount"), F.asc("invoice_id")]


def overdue_invoices(
    invoices: DataFrame, customers: DataFrame, ids: DataFrame | None = None,
    limit: int | None = None, as_of=None,
) -> DataFrame:
    """Overdue invoices of the requested customers, all of them or the latest `limit` of each.

    With a limit, rows come with `overdue_rank`, 1 for the latest; its filter is applied
    before the shuffle as well, so a customer with very many invoices sends few rows per task.
    Without one, `worst_first` gives the order in which a customer's rows are to be shown.
    """
    date = A.as_of_column(invoices, as_of)
    if ids is not None:
        invoices = requested(invoices, ids, "customer_id")
    late = A.age_invoices(invoices, date).where(F.col("days_past_due") > 0)
    days, amount = F.col("days_past_due"), F.col("outstanding_amount")
    out = late.withColumns(
        {
            "collection_priority": A.priority_of(days, amount),
            "recommended_action": A.action_of(days, amount),
        }
    ).select("customer_id", *OVERDUE_COLUMNS)
    out = out.join(customers.select("customer_id"), "customer_id", "left_semi")
    if limit is None:
        return out
    place = F.row_number().over(Window.partitionBy("customer_id").orderBy(*worst_first()))
    return out.withColumn("overdue_rank", place).where(F.col("overdue_rank") <= limit)


def invoice_details(
    invoices: DataFrame, customers: DataFrame, numbers: DataFrame | None = None, as_of=None
) -> DataFrame:
    """Invoices with customer and aging; aging is NULL for invoices without a balance."""
    found = invoices if numbers is None else requested(invoices, numbers, "invoice_number")
    amount = F.col("outstanding_amount")
    is_open = amount > 0
    days = F.col("_days")
    raw = A.days_late(A.as_of_column(invoices, as_of), F.col("due_date"))
    return (
        found.withColumn("_raw", raw)
        .withColumn("_days", at_least(F.col("_raw"), 0))
        .join(customers.select("customer_id", "customer_name"), "customer_id")
        .select(
            "invoice_id", "invoice_number", "invoice_date", "due_date", "invoice_amount",
            "amount_paid", "outstanding_amount", "invoice_status", "customer_id", "customer_name",
            F.when(is_open, days).alias("days_past_due"),
            F.when(is_open, A.bucket_of(F.col("_raw"))).alias("aging_bucket"),
            F.when(is_open, A.priority_of(days, amount)).alias("collection_priority"),
            F.when(is_open, A.action_of(days, amount)).alias("recommended_action"),
        )
    )


def _table_type(df: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)


def register_lookups(
    spark: SparkSession, invoices: DataFrame, customers: DataFrame, aging: DataFrame, risk: DataFrame, strict=True
) -> None:
    """Views and SQL table functions, callable as ``SELECT * FROM get_customer_summary(42)``.

    An id that does not exist is an error.  With strict=False it has no rows, which suits
    lateral joins over many ids.
    """
    aging.createOrReplaceTempView("vw_ar_aging_detail")
    risk.createOrReplaceTempView("vw_customer_risk_summary")
    customers.select("customer_id").createOrReplaceTempView("vw_known_customers")
    details = invoice_details(invoices, customers)
    details.createOrReplaceTempView("vw_invoice_details")
    overdue, queue = ", ".join(OVERDUE_COLUMNS), ", ".join(A.QUEUE_COLUMNS)

    def known(view, key, message):
        """One row, the wanted id, if the view has it; else an error."""
        said = message.replace("%s", "' || CAST(wanted AS STRING) || '")
        return (
            f"(SELECT CASE WHEN found > 0 THEN wanted ELSE raise_error('{said}') END AS known_id "
            f"FROM (SELECT count(*) AS found FROM {view} WHERE {key} = wanted))"
        )

    def body(columns, view, key, message, more="", owner=None):
        if not strict:
            return f"SELECT {columns} FROM {view} WHERE {key} = wanted{more}"
        return f"SELECT {columns} FROM {known(owner or view, key, message)} JOIN {view} ON {key} = known_id{more}"

    functions = {
        "get_customer_summary(wanted BIGINT)": (
            risk, body(", ".join(risk.columns), "vw_customer_risk_summary", "customer_id", K.ERR_CUSTOMER_LOOKUP),
        ),
        "get_overdue_invoices(wanted BIGINT)": (
            aging.select(*OVERDUE_COLUMNS),
            body(overdue, "vw_ar_aging_detail", "customer_id", K.ERR_CUSTOMER_LOOKUP, " AND days_past_due > 0 "
                 "ORDER BY days_past_due DESC, outstanding_amount DESC, invoice_id", "vw_known_customers"),
        ),
        "get_collection_queue(wanted STRING DEFAULT NULL)": (
            aging.select(*A.QUEUE_COLUMNS),
            f"SELECT {queue} FROM vw_ar_aging_detail "
            "WHERE wanted IS NULL OR collection_priority = upper(wanted)",
        ),
        "get_invoice_details(wanted STRING)": (
            details, body(", ".join(details.columns), "vw_invoice_details", "invoice_number", K.ERR_INVOICE_LOOKUP),
        ),
    }
    for signature, (shape, text) in functions.items():
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} "
            f"RETURNS TABLE({_table_type(shape)}) RETURN {text}"
        )

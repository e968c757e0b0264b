"""Schema, integrity and workflow checks, and the readiness report."""

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from duebook import constants as K
from duebook.functions.expr import blank_to_null, fill
from duebook.operators.constraints import orphan_count
from duebook.schemas import TABLES, struct

# --- fixed values: objects that must be there ----------------------------------------
REQUIRED_TABLES = [
    "customers", "invoices", "agent_conversations", "agent_approval_requests",
    "agent_notification_outbox", "agent_orchestration_runs",
]
REQUIRED_VIEWS = ["vw_ar_aging_detail"]

CHECK_SCHEMA = "check_name string, status string, message string"


def _judged(counts: DataFrame, checks) -> DataFrame:
    """One row per check from one row of counts; `checks` lists (column, name, bad status, text)."""
    rows = [
        F.struct(
            F.lit(name).alias("check_name"),
            F.when(F.col(c) == 0, "PASS").otherwise(bad).alias("status"),
            fill(text, F.col(c)).alias("message"),
        )
        for c, name, bad, text in checks
    ]
    return counts.select(F.inline(F.array(*rows)))


def _shape_fault(name: str, df: DataFrame) -> str | None:
    """First column that is missing or has another type than the schema declares."""
    if name not in TABLES:
        return None
    have = {f.name: f.dataType for f in df.schema}
    for field in struct(name):
        if field.name not in have:
            return f"Column {field.name} is missing."
        if have[field.name] != field.dataType:
            return f"Column {field.name} is {have[field.name].simpleString()}."
    return None


def schema_checks(
    spark: SparkSession, tables: dict[str, DataFrame], shapes=False, counts=False
) -> DataFrame:
    """Whether the required tables and views are supplied.

    `shapes` also checks their columns, `counts` adds their number of rows.
    """
    rows = []
    for kind, names in (("table", REQUIRED_TABLES), ("view", REQUIRED_VIEWS)):
        for name in names:
            fault = None
            if name not in tables:
                fault = f"Required {kind} is missing."
            elif shapes:
                fault = _shape_fault(name, tables[name])
            message = fault or f"Required {kind} exists."
            rows.append((name, "FAIL" if fault else "PASS", message))
    if not counts:
        named = [(name.upper(), status, message) for name, status, message in rows]
        return spark.createDataFrame(named, CHECK_SCHEMA)

    def counted(name, status, message):
        size = F.count("*") if name in tables else F.lit(None).cast("bigint")
        result = [F.lit(name.upper()).alias("check_name"), F.lit(status).alias("status"),
                  F.lit(message).alias("message"), size.alias("row_count")]
        return tables[name].agg(*result) if name in tables else spark.range(1).select(*result)

    return reduce(DataFrame.unionByName, [counted(*row) for row in rows])


def integrity_checks(invoices: DataFrame, customers: DataFrame) -> DataFrame:
    """Money, due date, owner and address checks; one pass over each table, one anti join."""
    found = "%s invoice(s) found."
    money = _judged(
        invoices.agg(
            F.count_if(F.col("outstanding_amount") < 0).alias("owed"),
            F.count_if(F.col("amount_paid") < 0).alias("paid"),
            F.count_if(F.col("outstanding_amount") > F.col("invoice_amount")).alias("more"),
            F.count_if(F.col("due_date").isNull()).alias("undated"),
        ),
        [
            ("owed", "Negative Outstanding Balances", "FAIL", found),
            ("paid", "Negative Amount Paid", "FAIL", found),
            ("more", "Outstanding > Invoice Amount", "FAIL", found),
            ("undated", "Missing Due Dates", "WARNING", found),
        ],
    )
    orphans = _judged(
        orphan_count(invoices, "customer_id", customers, "n"),
        [("n", "Orphan Invoices", "FAIL", "%s invoice(s) without a valid customer.")],
    )
    silent = _judged(
        customers.agg(F.count_if(blank_to_null(F.col("email")).isNull()).alias("n")),
        [("n", "Customers Without Email", "WARNING", "%s customer(s) found.")],
    )
    return money.unionByName(orphans).unionByName(silent)


def workflow_checks(runs: DataFrame, approvals: DataFrame, outbox: DataFrame, now: Column) -> DataFrame:
    """Stale, failed and waiting work at `now`; one pass over each table."""
    limit = now - F.expr(f"INTERVAL {K.STALE_AFTER}")
    run, note = F.col("orchestration_status"), F.col("notification_status")
    parts = [
        _judged(
            runs.agg(
                F.count_if((run == "STARTED") & (F.col("started_at") < limit)).alias("stale"),
                F.count_if(run == "FAILED").alias("failed"),
            ),
            [
                ("stale", "Stale STARTED Orchestrations", "WARNING", "%s stale orchestration(s) found."),
                ("failed", "Failed Orchestrations", "WARNING", "%s failed orchestration(s) found."),
            ],
        ),
        _judged(
            approvals.agg(F.count_if(F.col("approval_status") == "PENDING").alias("pending")),
            [("pending", "Pending Approvals", "WARNING", "%s pending approval(s) found.")],
        ),
        _judged(
            outbox.agg(
                F.count_if(note == "FAILED").alias("failed"),
                F.count_if((note == "PROCESSING") & (F.col("updated_at") < limit)).alias("stuck"),
            ),
            [
                ("failed", "Failed Notifications", "FAIL", "%s failed notification(s) found."),
                ("stuck", "Stuck Notifications", "WARNING", "%s stuck notification(s) found."),
            ],
        ),
    ]
    return reduce(DataFrame.unionByName, parts)


def all_checks(spark: SparkSession, tables: dict[str, DataFrame], now: Column) -> DataFrame:
    """Schema, integrity and workflow checks."""
    parts = [
        schema_checks(spark, tables),
        integrity_checks(tables["invoices"], tables["customers"]),
        workflow_checks(
            tables["agent_orchestration_runs"], tables["agent_approval_requests"],
            tables["agent_notification_outbox"], now,
        ),
    ]
    return reduce(DataFrame.unionByName, parts)


def readiness_report(checks: DataFrame) -> DataFrame:
    """Counts per outcome, the worst outcome, and the share of passed checks."""
    counts = checks.agg(
        F.count("*").alias("total_checks"),
        *[
            F.count_if(F.col("status") == s).alias(n)
            for n, s in (("passed", "PASS"), ("warnings", "WARNING"), ("failed", "FAIL"))
        ],
    )
    overall = F.when(F.col("failed") > 0, "FAIL").when(F.col("warnings") > 0, "WARNING").otherwise("PASS")
    share = F.when(F.col("total_checks") > 0, F.col("passed") / F.col("total_checks") * 100).otherwise(0.0)
    return counts.withColumns(
        {"overall_status": overall, "readiness_score": F.round(share, 1)}
    )

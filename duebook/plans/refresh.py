"""The batch run: raw files to stored receivables tables."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from duebook.operators import merge, normalize, staging
from duebook.operators import payments as P
from duebook.plans import stored
from duebook.schemas import conform, struct
from duebook.sources import raw
from duebook.storage import materialize

def refresh(
    spark: SparkSession, parts, folder: str, source_file: str, loaded: Column, fmt="csv",
    payments: DataFrame | None = None, terms: DataFrame | None = None, rules=staging.staging_rules,
    buckets: int = 64,
) -> dict[str, DataFrame]:
    """Read raw `parts`, write every receivables table below `folder` and publish them together.

    Readers of `folder` (`stored.tables_at`) see the tables of the run before until all of this
    one are there; a run that stops half-way changes nothing for them.  `payments` is the
    payments table, by invoice id; without one every invoice is open.  Lines that do not have
    the fields of their header, and rows that break a rule, go to `rejects` and take no further
    part.  Raw files are parsed once; row counts and totals are taken while tables are written.
    """
    tables = stored.tables_at(spark, folder, buckets)
    run = tables.run()
    read = raw.read_raw_transactions(spark, parts, fmt, faults=fmt == "csv")
    typed = materialize(raw.coerce_types(raw.conform_columns(read)).withColumn("source_file", F.lit(source_file)), "parsed")
    good, bad = staging.split_rejects(typed, {**raw.fault_rules(typed), **rules()})
    out = {"rejects": run.create("rejects", bad)}

    def store(table, df):
        out[table] = run.create(table, conform(df, table), stored.amounts(table))
        return out[table]

    staged = store("stg_retail_transactions", staging.stage_transactions(good, source_file, loaded))
    default = normalize.default_payment_terms(spark)
    terms = store(
        "payment_terms",
        default if terms is None else merge.upsert(terms, default, ["payment_term_id"]),
    )
    opened = materialize(normalize.build_invoices(staged, terms, loaded), "opened-invoices")
    none = spark.createDataFrame([], struct("payments"))
    paid = store("payments", none if payments is None else payments)
    invoices = store("invoices", P.apply_payments(opened, paid))
    store("invoice_lines", normalize.build_invoice_lines(staged, invoices))
    customers = normalize.build_customers(staged, loaded)
    store("customers", normalize.customer_balances(customers, invoices))
    stored.note_counts(run)
    run.publish()
    return out

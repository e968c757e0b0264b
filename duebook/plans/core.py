"""The stored layers: staging, then the receivables tables that reports read.

Tables that take a shuffle are derived from the driver's tables once per application and folder,
written to the shared folder, and read back from there by every later query.  What one pass over
rows gives (workflow tables, requests, invoices before payments) is not written again.
"""

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from duebook.operators import aging, conversations, normalize, payments, risk
from duebook.operators.requested import store_for_lookups
from duebook.sources import fixtures, requests
from duebook.sources.raw import read_raw_transactions
from duebook.storage import input_bytes, materialize, new_path, size_tasks

INPUTS = ("customer", "part", "orders", "lineitem", "events", "conversations")
_CORES = {}


class Core:
    """Receivables and workflow tables for one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._requests = {}

    @cached_property
    def input_bytes(self) -> int:
        return input_bytes(self.spark, [f"{self.folder}/{name}.parquet" for name in INPUTS])

    # ---- stored layers -----------------------------------------------------------
    @cached_property
    def staging(self) -> DataFrame:
        return materialize(fixtures.staging(self.spark, self.folder), "staging")

    @cached_property
    def sold(self) -> DataFrame:
        """The part of the staged rows that customers and invoices need; their ids, which take a sort, are not."""
        if "staging" in vars(self):
            return self.staging
        rows = fixtures.staging(self.spark, self.folder, numbered=False)
        return materialize(rows.select(*normalize.INVOICED), "sold")

    @property
    def sold_once(self) -> DataFrame:
        """The rows of `sold` for a query that reads them once: where they are not stored, they need not be."""
        if {"staging", "sold"} & set(vars(self)):
            return self.sold
        return fixtures.staging(self.spark, self.folder, numbered=False).select(*normalize.INVOICED)

    @cached_property
    def terms(self) -> DataFrame:
        return normalize.default_payment_terms(self.spark)

    @cached_property
    def new_invoices(self) -> DataFrame:
        """Invoices as first loaded, before payments."""
        return normalize.build_invoices(self.sold, self.terms, fixtures.load_date())

    @cached_property
    def payments(self) -> DataFrame:
        return materialize(
            fixtures.derive_payments(self.new_invoices, fixtures.load_date()), "payments"
        )

    @cached_property
    def invoices(self) -> DataFrame:
        settled = payments.apply_payments(self.new_invoices, self.payments)
        return store_for_lookups(
            settled, new_path(self.spark, "invoices"), "customer_id", ["customer_id", "invoice_number"]
        )

    @cached_property
    def lines(self) -> DataFrame:
        staging = self.staging  # before the invoices, which then are built from it as well
        return materialize(normalize.build_invoice_lines(staging, self.new_invoices), "invoice-lines")

    @cached_property
    def customers(self) -> DataFrame:
        plain = normalize.build_customers(self.sold, fixtures.load_date())
        full = normalize.customer_balances(fixtures.with_contacts(plain), self.invoices)
        return store_for_lookups(full, new_path(self.spark, "customers"), "customer_id", ["customer_id"])

    @cached_property
    def billed(self) -> DataFrame:
        """Numbers and customers of the invoices; ids, dates and amounts take more to build and to move."""
        for name in ("invoices", "new_invoices"):
            if name in vars(self):
                return vars(self)[name].select("invoice_id", "invoice_number", "customer_id")
        rows = fixtures.sales(self.spark, self.folder, numbered=False, judged=True)
        return materialize(normalize.billed(rows, ["_order"]), "billed")

    @cached_property
    def contacts(self) -> DataFrame:
        """Customers that have invoices, before any balance."""
        plain = normalize.build_customers(self.billed, fixtures.load_date())
        return materialize(fixtures.with_contacts(plain), "contacts")

    @cached_property
    def raw_parts(self) -> dict[str, str]:
        """The staged rows as two folders of raw CSV files."""
        rows = fixtures.raw_transactions(self.staging)
        parts = {
            "even rows": rows.where("transaction_id % 2 = 0"),
            "odd rows": rows.where("transaction_id % 2 = 1"),
        }
        paths = {name: new_path(self.spark, "raw") for name in parts}
        for name, part in parts.items():
            part.write.options(header=True, compression="gzip").csv(paths[name])
        return paths

    @property
    def raw(self) -> DataFrame:
        return read_raw_transactions(self.spark, self.raw_parts)

    # ---- views -------------------------------------------------------------------
    @property
    def aging(self) -> DataFrame:
        return aging.ar_aging_detail(self.invoices, self.customers)

    @property
    def parties(self) -> tuple[DataFrame, DataFrame]:
        """Invoices and customers as far as recipients are concerned: what is paid or owed need not be known."""
        if "customers" in vars(self):
            return self.invoices, self.customers
        return self.billed, self.contacts

    @property
    def risk(self) -> DataFrame:
        return risk.customer_risk_summary(
            risk.customer_collection_summary(self.customers, self.invoices)
        )

    # ---- workflow tables -----------------------------------------------------------
    @cached_property
    def approvals(self) -> DataFrame:
        return fixtures.approvals(self.spark, self.folder)

    @cached_property
    def outbox(self) -> DataFrame:
        return fixtures.outbox_table(self.spark, self.folder)

    @cached_property
    def activity(self) -> DataFrame:
        events = fixtures.activity_events(self.spark, self.folder)
        return conversations.activity_log(events)

    @cached_property
    def sessions(self) -> DataFrame:
        return materialize(conversations.conversation_sessions(self.activity), "conversations")

    @cached_property
    def recovery_log(self) -> DataFrame:
        return fixtures.recovery_log(self.spark, self.folder)

    @cached_property
    def orchestrations(self) -> DataFrame:
        return fixtures.orchestrations(self.spark, self.folder)

    def request(self, name: str) -> DataFrame:
        """A table of workflow requests (a function of `sources.requests`)."""
        if name not in self._requests:
            self._requests[name] = getattr(requests, name)(self.spark, self.folder)
        return self._requests[name]

    @property
    def messages(self) -> DataFrame:
        return fixtures.messages(self.spark, self.folder)


def core(spark: SparkSession, folder: str) -> Core:
    """The tables of `folder`, shared by all queries of this application."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _CORES:
        _CORES[key] = Core(spark, folder)
    size_tasks(spark, _CORES[key].input_bytes)
    return _CORES[key]

"""Transitions and merges on stored tables: read, judge and rewrite only what requests touch.

Every function takes the stored tables and requests, rewrites the buckets that the requested
keys fall into, adds new rows beside the others, publishes all tables of the step at once and
returns the transition (audit rows and rejects are read from the state before).
"""

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from duebook.functions.expr import TOTAL
from duebook.operators import merge, workflow
from duebook.operators.workflow import (
    ACTIVITY, APPROVALS, CONVERSATIONS, OUTBOX, RECOVERY, RUNS, Transition,
)
from duebook.storage import materialize
from duebook.tables import Run, Tables

KEYS = {
    "stg_retail_transactions": "transaction_id",
    "customers": "customer_id",
    "payment_terms": "payment_term_id",
    "invoices": "invoice_id",
    "invoice_lines": "invoice_line_id",
    "payments": "payment_id",
    CONVERSATIONS: "conversation_id",
    ACTIVITY: "activity_id",
    APPROVALS: "approval_id",
    OUTBOX: "notification_id",
    RECOVERY: "recovery_id",
    RUNS: "orchestration_id",
}


def tables_at(spark: SparkSession, root: str, buckets: int = 64) -> Tables:
    return Tables(spark, root, KEYS, buckets)


def create(tables: Tables, frames: dict[str, DataFrame]) -> Tables:
    """Store whole tables, visible together, with their row counts and money totals."""
    run = tables.run()
    for name, df in frames.items():
        run.create(name, df, amounts(name))
    note_counts(run)
    run.publish()
    return tables


AMOUNTS = {"invoices": "invoice_amount", "invoice_lines": "line_amount", "payments": "payment_amount"}


def amounts(name: str) -> list[str]:
    return [AMOUNTS[name]] if name in AMOUNTS else []


def note_counts(run: Run) -> None:
    """Publish what was counted while the run's tables were written."""
    counted = {}
    for name, seen in run.metrics.items():
        total = seen.get(f"sum_{AMOUNTS[name]}") if name in AMOUNTS else None
        counted[name] = {"rows": seen["rows"], "total": None if total is None else str(total)}
    run.note("load_counts", counted)


def load_counts(tables: Tables, names=None) -> DataFrame:
    """Row count and money total of every table of the last full load, as counted while written.

    The rows of `normalize.load_counts`, without reading any table.
    """
    counted = tables.pointer()["notes"]["load_counts"]
    rows = [
        (n, c["rows"], None if c["total"] is None else Decimal(c["total"]))
        for n, c in counted.items() if names is None or n in names
    ]
    return tables.spark.createDataFrame(rows, f"table_name string, row_count long, total_amount {TOTAL}")


def _settled(t: Transition, name: str) -> Transition:
    """The transition with its audit rows and rejects written, so that they outlive the run."""
    events = None if t.events is None else materialize(t.events, f"{name}-events")
    return t._replace(events=events, rejects=materialize(t.rejects, f"{name}-rejects"))


# ---- merges ---------------------------------------------------------------------------------
def upsert(tables: Tables, name: str, source: DataFrame) -> None:
    """`merge.upsert` of `source` into a stored table, by its key."""
    run, key = tables.run(), tables.keys[name]
    keys = materialize(source.select(key).distinct(), "merge-keys")
    run.replace(name, merge.upsert(run.read(name, keys), source, [key]), keys)
    run.publish()


def update_from(tables: Tables, name: str, source: DataFrame) -> None:
    """`merge.update_from` of `source` into a stored table, by its key."""
    run, key = tables.run(), tables.keys[name]
    keys = materialize(source.select(key).distinct(), "merge-keys")
    run.replace(name, merge.update_from(run.read(name, keys), source, [key]), keys)
    run.publish()


# ---- workflow -------------------------------------------------------------------------------
def request_reminders(tables: Tables, requests: DataFrame, now: Column) -> Transition:
    run = tables.run()
    t = workflow.request_reminders(requests, run.read(APPROVALS), now, {"approval_id": run.highest(APPROVALS)})
    run.append(APPROVALS, t.added[APPROVALS])
    run.publish()
    return _settled(t, "reminders")


def decide_approvals(tables: Tables, decisions: DataFrame, now: Column) -> Transition:
    run, keys = tables.run(), decisions.select("approval_id")
    t = workflow.decide_approvals(run.read(APPROVALS, keys), decisions, now)
    run.replace(APPROVALS, t.tables[APPROVALS], keys)
    run.publish()
    return _settled(t, "decisions")


def execute_approved(
    tables: Tables, requests: DataFrame, now: Column, invoices: DataFrame, customers: DataFrame, form="recipient"
) -> Transition:
    run, keys = tables.run(), requests.select("approval_id")
    t = workflow.execute_approved(
        run.read(APPROVALS, keys), run.read(OUTBOX), requests, now, invoices, customers, form,
        {"notification_id": run.highest(OUTBOX)},
    )
    run.replace(APPROVALS, t.tables[APPROVALS], keys)
    if OUTBOX in t.added:
        run.append(OUTBOX, t.added[OUTBOX])
    run.publish()
    return _settled(t, "executions")


def apply_delivery_results(tables: Tables, results: DataFrame, now: Column, retries=True) -> Transition:
    run, keys = tables.run(), results.select("notification_id")
    t = workflow.apply_delivery_results(run.read(OUTBOX, keys), results, now, retries)
    run.replace(OUTBOX, t.tables[OUTBOX], keys)
    run.publish()
    return _settled(t, "deliveries")


def requeue(tables: Tables, requests: DataFrame, now: Column) -> Transition:
    run, keys = tables.run(), requests.select("notification_id")
    t = workflow.requeue(
        run.read(OUTBOX, keys), run.read(RECOVERY), requests, now, {"recovery_id": run.highest(RECOVERY)}
    )
    run.replace(OUTBOX, t.tables[OUTBOX], keys)
    run.append(RECOVERY, t.added[RECOVERY])
    run.publish()
    return _settled(t, "recoveries")


def start_orchestrations(
    tables: Tables, requests: DataFrame, invoices: DataFrame, customers: DataFrame, now: Column
) -> Transition:
    """New runs, approvals and conversations: three tables, one commit."""
    run = tables.run()
    t = workflow.start_orchestrations(
        requests, run.read(RUNS), run.read(APPROVALS), run.read(CONVERSATIONS), invoices, customers, now,
        ids={"orchestration_id": run.highest(RUNS), "approval_id": run.highest(APPROVALS)},
    )
    for name, rows in t.added.items():
        run.append(name, rows)
    run.publish()
    return _settled(t, "run-starts")


def complete_orchestrations(
    tables: Tables, requests: DataFrame, invoices: DataFrame, customers: DataFrame, now: Column
) -> Transition:
    """Runs, approvals and outbox change together or not at all."""
    run, keys = tables.run(), requests.select("orchestration_id")
    runs = run.read(RUNS, keys)
    asked = materialize(runs.join(keys.distinct(), "orchestration_id", "left_semi").select("approval_id"), "run-approvals")
    t = workflow.complete_orchestrations(
        runs, run.read(APPROVALS, asked), run.read(OUTBOX), requests, invoices, customers, now,
        {"notification_id": run.highest(OUTBOX)},
    )
    run.replace(RUNS, t.tables[RUNS], keys)
    run.replace(APPROVALS, t.tables[APPROVALS], asked)
    run.append(OUTBOX, t.added[OUTBOX])
    run.publish()
    return _settled(t, "run-completions")


def append_events(tables: Tables, events: DataFrame) -> None:
    """Audit rows at the end of the stored activity log."""
    run = tables.run()
    run.append(ACTIVITY, workflow.numbered_events(events, F.lit(run.highest(ACTIVITY)).cast("bigint")))
    run.publish()

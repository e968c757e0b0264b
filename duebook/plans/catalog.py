"""Every registered query: name -> function of (session, data folder)."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duebook import constants as K
from duebook.operators import (
    aging, blocks, checks, constraints, conversations, kpis, lookups, merge, normalize, operations,
    payments, replay, risk, staging, workflow,
)
from duebook.plans import reports, stored
from duebook.plans.colocated import Colocated
from duebook.plans.core import Core, core
from duebook.sources import fixtures, raw, requests
from duebook.storage import materialize, new_path
from duebook.streaming import jobs
from duebook.tables import Tables

QUERIES: dict[str, Callable[[Core], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def register(**entries):
    QUERIES.update(entries)


# ---- sources, staging, quality ----------------------------------------------------------
def _typed(c):
    return raw.coerce_types(raw.conform_columns(c.raw))


def _checked(c):
    rules = {
        **staging.length_rules({k: v for k, v in staging.TEXT_LIMITS.items() if k != "source_file"}),
        **staging.required_rules("quantity", "invoice_date", "unit_price"),
    }
    return staging.split_rejects(_typed(c), rules)


register(
    read_raw_transactions=lambda c: c.raw,
    conform_columns=lambda c: raw.conform_columns(c.raw),
    coerce_types=_typed,
    split_rejects=lambda c: _checked(c)[1].drop("description"),
    stage_transactions=lambda c: staging.stage_transactions(
        _checked(c)[0], "transactions.csv", fixtures.load_date()
    ),
    profile_transactions=lambda c: staging.profile_transactions(c.staging),
    profile_by_sketches=lambda c: _estimated_profile(c),
    source_inventory=lambda c: staging.source_inventory(c.raw),
    source_sample=lambda c: staging.source_sample(
        c.raw.withColumn("transaction_id", F.col("transaction_id").cast("bigint")),
        ["transaction_id"],
    ).select("source_part", "sample_row", "transaction_id", "Invoice", "StockCode"),
)


def _estimated_profile(c):
    """Exact figures, and for distinct counts whether sketches of each month's rows, united, keep their bound."""
    months = c.staging.withColumn("source_part", F.date_format("invoice_date", "yyyy-MM"))
    kept = materialize(staging.profile_sketches(months), "profile-sketches")
    guess, exact = staging.profile_from_sketches(kept), staging.profile_transactions(c.staging)
    bound = staging.sketch_bound()
    figures = []
    for name in exact.columns:
        true, said = exact.select(name).scalar(), F.col(name)
        if name in staging.PROFILED:
            figures.append((F.abs(said - true) <= F.ceil(true * bound)).alias(f"{name}_within"))
        else:
            figures.append(said)
    return guess.select(*figures)


@query
def malformed_lines(c):
    """Lines of a raw file by what is wrong with them."""
    path = new_path(c.spark, "raw-lines")
    fixtures.raw_lines(c.staging).write.options(header=True, sep="\u0001", quote="", compression="gzip").csv(path)
    rows = raw.conform_columns(raw.read_raw_transactions(c.spark, {"lines": path}, faults=True))
    typed = materialize(raw.coerce_types(rows), "parsed-lines")
    good, bad = staging.split_rejects(typed, raw.fault_rules(typed))
    return (
        bad.groupBy("failed_rules", raw.FAULT).agg(F.count("*").alias("line_count"))
        .unionByName(good.groupBy(F.lit("none").alias("failed_rules"), raw.FAULT).agg(F.count("*").alias("line_count")))
    )


def _new_limits(c):
    """Every customer again with a new limit, next to customers not seen before."""
    known = c.customers.select(
        "customer_id", "customer_name", "status",
        F.when(F.col("customer_id") % 3 == 0, 25000).otherwise(12000).cast("decimal(18,2)").alias("credit_limit"),
    )
    fresh = c.invoices.select(
        (F.col("invoice_id") + 1000000).alias("customer_id"),
        F.concat(F.lit("New customer "), F.col("invoice_id").cast("string")).alias("customer_name"),
        F.lit("ACTIVE").alias("status"),
        F.lit("500").cast("decimal(18,2)").alias("credit_limit"),
    )
    return known.unionByName(fresh)


def _largest_invoices(c):
    return c.invoices.groupBy("customer_id").agg(F.max("invoice_amount").alias("credit_limit"))


UPSERTED = ["customer_id", "customer_name", "email", "status", "credit_limit", "current_balance"]
UPDATED = ["customer_id", "customer_name", "credit_limit"]


@query
def upsert(c):
    return merge.upsert(c.customers, _new_limits(c), ["customer_id"]).select(*UPSERTED)


@query
def update_from(c):
    return merge.update_from(c.customers, _largest_invoices(c), ["customer_id"]).select(*UPDATED)


def _moved_keys(customers):
    """Some customers under another id, so that their invoices have no customer."""
    cid = F.col("customer_id")
    return customers.withColumn("customer_id", F.when(cid % 50 == 1, -cid).otherwise(cid))


def _damaged(c):
    """All tables with defects planted by rule."""
    iid, lines = F.col("invoice_id"), c.lines
    invoices = c.invoices.withColumns(
        {
            "invoice_status": F.when(iid % 100 == 0, "LATE").otherwise(F.col("invoice_status")),
            "invoice_amount": F.when(iid % 110 == 0, 10**10).otherwise(F.col("invoice_amount")),
            "dispute_flag": F.when(iid % 150 == 0, "X").otherwise(F.col("dispute_flag")),
            "due_date": F.when(iid % 70 != 0, F.col("due_date")),
        }
    )
    return {
        "customers": _moved_keys(c.customers),
        "payment_terms": c.terms,
        "invoices": invoices.unionByName(invoices.where("invoice_id % 500 = 0")),
        "invoice_lines": lines.withColumns(
            {
                "quantity": F.when(F.col("invoice_line_id") % 90 != 0, F.col("quantity")).otherwise(0),
                "description": F.when(
                    F.col("invoice_line_id") % 80 == 0, F.repeat("description", 50)
                ).otherwise(F.col("description")),
            }
        ),
        "payments": c.payments.withColumns(
            {
                "payment_amount": F.when(F.col("payment_id") % 40 != 0, F.col("payment_amount")).otherwise(0),
                "invoice_id": F.when(F.col("payment_id") % 60 != 0, F.col("invoice_id")).otherwise(-1),
            }
        ),
        "agent_conversations": c.sessions.withColumn(
            "conversation_id",
            F.when(F.col("conversation_id") == "conv-7", "conv-seven").otherwise(F.col("conversation_id")),
        ),
        "agent_activity_log": c.activity.withColumn(
            "error_message", F.concat(F.col("error_message"), F.lit("!"))
        ),
        "agent_approval_requests": c.approvals.withColumns(
            {
                "approval_status": F.when(F.col("approval_id") % 33 == 0, "LOST").otherwise(F.col("approval_status")),
                "approval_id": F.when(F.col("approval_id") % 50 == 4, F.col("approval_id") + requests.UNKNOWN)
                .otherwise(F.col("approval_id")),
            }
        ),
        "agent_notification_outbox": c.outbox,
        "agent_notification_recovery_log": c.recovery_log,
        "agent_orchestration_runs": c.orchestrations,
    }


@query
def constraint_violations(c):
    return constraints.constraint_violations(_damaged(c))


# ---- normalisation --------------------------------------------------------------------
@query
def eligible_transactions(c):
    return normalize.eligible_transactions(c.staging).drop("load_date", "source_file")


@query
def build_customers(c):
    return normalize.build_customers(c.sold_once, fixtures.load_date())


@query
def build_invoices(c):
    return normalize.build_invoices(c.sold_once, c.terms, fixtures.load_date())


@query
def dense_surrogate_key(c):
    rows = c.staging.select("transaction_id", "invoice_no")
    return blocks.dense_key(rows, "row_key", ["invoice_no", "transaction_id"])


@query
def build_invoice_lines(c):
    return normalize.build_invoice_lines(c.staging, c.new_invoices)


@query
def customer_balances(c):
    plain = fixtures.with_contacts(normalize.build_customers(c.sold, fixtures.load_date()))
    return normalize.customer_balances(plain, c.invoices).select(
        "customer_id", "customer_name", "email", "status", "current_balance"
    )


@query
def load_counts(c):
    return normalize.load_counts(
        {
            "customers": c.customers,
            "payment_terms": c.terms,
            "invoices": c.invoices,
            "invoice_lines": c.lines,
        },
        {"invoices": "invoice_amount", "invoice_lines": "line_amount"},
    )


@query
def load_counts_published(c):
    frames = {"customers": c.customers, "payment_terms": c.terms, "invoices": c.invoices, "invoice_lines": c.lines}
    tables = stored.create(stored.tables_at(c.spark, new_path(c.spark, "load"), 16), frames)
    return stored.load_counts(tables)


@query
def reconcile_header_lines(c):
    return normalize.reconcile_header_lines(c.invoices, c.lines)


@query
def reconcile_invoices(c):
    # Lines of some invoices have another amount, those of others belong to unknown invoices.
    iid, amount = F.col("invoice_id"), F.col("line_amount")
    changed = c.lines.withColumns(
        {
            "line_amount": F.when(iid % 50 == 0, amount + 1).otherwise(amount).cast("decimal(18,2)"),
            "invoice_id": F.when(iid % 50 == 1, -iid).otherwise(iid),
        }
    )
    return normalize.reconcile_invoices(c.invoices, changed)


@query
def top_customers_by_outstanding(c):
    return normalize.top_customers_by_outstanding(c.customers, c.invoices)


@query
def invoice_relationships(c):
    return normalize.invoice_relationships(c.customers, c.invoices, c.terms, c.lines, c.payments)


# ---- payments ---------------------------------------------------------------------------
@query
def derive_payments(c):
    return fixtures.derive_payments(c.new_invoices, fixtures.load_date())


@query
def apply_payments(c):
    return payments.apply_payments(c.new_invoices, c.payments).drop(
        "payment_term_id", "dispute_flag", "created_date"
    )


@query
def orphan_payments(c):
    iid = F.col("invoice_id")
    lost = c.payments.withColumn("invoice_id", F.when(F.col("payment_id") % 4 == 0, -iid).otherwise(iid))
    return payments.orphan_payments(lost, c.invoices)


register(
    payments_by_method=lambda c: payments.payments_by_method(c.payments),
    invoices_by_status=lambda c: payments.invoices_by_status(c.invoices),
    invalid_invoice_balances=lambda c: payments.invalid_invoice_balances(c.invoices),
    top_payments=lambda c: payments.top_payments(c.payments, c.invoices, c.customers),
)

# ---- aging and risk ---------------------------------------------------------------------
register(
    reporting_date=lambda c: aging.reporting_date(c.invoices),
    ar_aging_detail=lambda c: c.aging,
    ar_aging_detail_early=lambda c: aging.ar_aging_detail(c.invoices, c.customers, "2001-07-15"),
    aging_bucket_summary=lambda c: aging.aging_bucket_summary(c.aging),
    top_overdue_customers=lambda c: aging.top_overdue_customers(c.invoices, c.customers),
    collection_queue=lambda c: aging.collection_queue(c.aging),
    collection_queue_high=lambda c: aging.collection_queue(c.aging, priority="high"),
    collection_queue_top=lambda c: aging.top_of_queue(c.invoices, c.customers, 20),
    aging_validation=lambda c: aging.aging_validation(c.aging, c.invoices),
    aging_summary=lambda c: aging.aging_summary(c.invoices, "2001-08-20"),
    priority_summary=lambda c: aging.priority_summary(c.invoices, "2001-08-20"),
    customer_collection_summary=lambda c: risk.customer_collection_summary(c.customers, c.invoices),
    customer_risk_summary=lambda c: c.risk,
    risk_score=lambda c: risk.customer_collection_summary(c.customers, c.invoices).select(
        "customer_id", "risk_score"
    ),
)

# ---- lookups ----------------------------------------------------------------------------
def _wanted_customers(c):
    """All customers of the order table, and as many ids that no customer has."""
    return fixtures.read_table(c.spark, c.folder, "orders").select(
        F.explode(F.array("o_custkey", -F.col("o_custkey") - 1)).alias("customer_id")
    )


def _wanted_invoices(c):
    number = F.col("o_orderkey").cast("string")
    return fixtures.read_table(c.spark, c.folder, "orders").select(
        F.explode(F.array(number, F.concat(F.lit("X"), number))).alias("invoice_number")
    )


def _sql(text):
    """A query over the registered table functions, with all wanted ids in the view `wanted`."""

    def run(c):
        lookups.register_lookups(c.spark, c.invoices, c.customers, c.aging, c.risk, strict=False)
        orders = fixtures.read_table(c.spark, c.folder, "orders")
        orders.select(F.col("o_custkey").alias("customer_id")).distinct().createOrReplaceTempView(
            "wanted_customers"
        )
        _wanted_invoices(c).createOrReplaceTempView("wanted_invoices")
        return c.spark.sql(text)

    return run


register(
    sql_collection_queue=_sql("SELECT * FROM get_collection_queue('high')"),
    sql_customer_summary=_sql(
        "SELECT f.* FROM wanted_customers w, LATERAL get_customer_summary(w.customer_id) f"
    ),
    sql_overdue_invoices=_sql(
        "SELECT w.customer_id, f.* FROM wanted_customers w, LATERAL get_overdue_invoices(w.customer_id) f"
    ),
    sql_invoice_details=_sql(
        "SELECT f.* FROM wanted_invoices w, LATERAL get_invoice_details(w.invoice_number) f"
    ),
)


register(
    customer_summary=lambda c: lookups.customer_summary(
        c.customers, c.invoices, _wanted_customers(c)
    ),
    unknown_customers=lambda c: lookups.unknown_customers(_wanted_customers(c), c.customers),
    overdue_invoices=lambda c: lookups.overdue_invoices(
        c.invoices, c.customers, _wanted_customers(c)
    ),
    overdue_invoices_100=lambda c: lookups.overdue_invoices(
        c.invoices, c.customers, _wanted_customers(c), limit=100
    ),
    overdue_invoices_top3=lambda c: lookups.overdue_invoices(c.invoices, c.customers, limit=3),
    invoice_details=lambda c: lookups.invoice_details(c.invoices, c.customers, _wanted_invoices(c)),
    unknown_invoices=lambda c: lookups.unknown_invoices(_wanted_invoices(c), c.invoices),
)


# ---- indicators -------------------------------------------------------------------------
def _indicators(c, by=(), frames=None):
    f = frames or {}
    return (
        kpis.portfolio_kpis(f.get("invoices", c.invoices), by),
        kpis.overdue_kpis(f.get("aging", c.aging), by),
        kpis.orchestration_kpis(f.get("runs", c.orchestrations), by),
        kpis.approval_kpis(f.get("approvals", c.approvals), by),
        kpis.notification_kpis(f.get("outbox", c.outbox), by),
    )


@query
def collections_narrative_by_status(c):
    """The narrative per customer status; workflow rows belong to the customer of their invoice."""
    status = c.customers.select("customer_id", "status")
    invoices = c.invoices.join(status, "customer_id")
    owner = invoices.select("invoice_number", "status")
    runs = c.orchestrations.join(owner, "invoice_number")
    subject = F.regexp_extract("subject_text", "Invoice (.*)$", 1).alias("invoice_number")
    frames = {
        "invoices": invoices,
        "aging": c.aging.join(status, "customer_id"),
        "runs": runs,
        "approvals": c.approvals.withColumn(
            "invoice_number", F.get_json_object("action_payload", "$.invoice_number")
        ).join(owner, "invoice_number"),
        "outbox": c.outbox.select("notification_status", subject).join(owner, "invoice_number"),
    }
    by = ("status",)
    return kpis.collections_narrative(*_indicators(c, by, frames), by=by)


DIMENSIONS = ("status", "customer_type", "country")


def _by_each(c):
    """The five indicator frames over everything and per status, segment and country of the customer."""
    country = c.staging.groupBy("customer_id").agg(F.max("country").alias("country"))
    owner = c.customers.select("customer_id", "status", "customer_type").join(country, "customer_id", "left")
    invoices = c.invoices.join(owner, "customer_id", "left")
    of_number = invoices.select("invoice_number", *DIMENSIONS)
    payload = F.get_json_object("action_payload", "$.invoice_number")
    subject = F.regexp_extract("subject_text", "Invoice (.*)$", 1).alias("invoice_number")
    return kpis.indicators_by_each(
        invoices, c.aging.join(owner, "customer_id", "left"), c.orchestrations.join(of_number, "invoice_number", "left"),
        c.approvals.withColumn("invoice_number", payload).join(of_number, "invoice_number", "left"),
        c.outbox.select("notification_status", subject).join(of_number, "invoice_number", "left"), DIMENSIONS,
    )


register(
    portfolio_kpis_by_each=lambda c: _by_each(c)[0],
    overdue_kpis_by_each=lambda c: _by_each(c)[1],
    orchestration_kpis_by_each=lambda c: _by_each(c)[2],
    approval_kpis_by_each=lambda c: _by_each(c)[3],
    notification_kpis_by_each=lambda c: _by_each(c)[4],
    collections_narrative_by_each=lambda c: kpis.collections_narrative(*_by_each(c), by=("dimension", "value")),
    management_report=lambda c: reports.report_lines(
        reports.management_report(c.invoices, c.customers, c.orchestrations, c.approvals, c.outbox, "2001-08-20")
    ),
    portfolio_kpis=lambda c: kpis.portfolio_kpis(c.invoices),
    overdue_kpis=lambda c: kpis.overdue_kpis(c.aging),
    orchestration_kpis=lambda c: kpis.orchestration_kpis(c.orchestrations),
    approval_kpis=lambda c: kpis.approval_kpis(c.approvals),
    notification_kpis=lambda c: kpis.notification_kpis(c.outbox),
    top_overdue_invoices=lambda c: aging.top_overdue_invoices(c.invoices, c.customers),
    recent_orchestrations=lambda c: kpis.recent_orchestrations(c.orchestrations),
    collections_narrative=lambda c: kpis.collections_narrative(*_indicators(c)),
    executive_dashboard=lambda c: kpis.executive_dashboard(*_indicators(c)),
)


# ---- operations reports -----------------------------------------------------------------
def _failed_runs(c):
    return c.orchestrations.where("orchestration_status = 'FAILED'").select("orchestration_id")


register(
    notification_status_summary=lambda c: operations.notification_status_summary(c.outbox),
    notification_metrics=lambda c: operations.notification_metrics(c.outbox),
    recent_notifications=lambda c: operations.recent_notifications(c.outbox),
    notification_failures=lambda c: operations.notification_failures(c.outbox),
    recovery_history=lambda c: operations.recovery_history(c.recovery_log),
    recovery_history_all=lambda c: operations.recovery_history(c.recovery_log, None),
    approval_status_summary=lambda c: operations.approval_status_summary(c.approvals),
    recent_approvals=lambda c: operations.recent_approvals(c.approvals),
    approval_notification_lifecycle=lambda c: operations.approval_notification_lifecycle(
        c.approvals, c.outbox
    ),
    approval_notification_recent=lambda c: operations.approval_notification_lifecycle(
        c.approvals, c.outbox, 20
    ),
    retry_status=lambda c: operations.retry_status(c.outbox),
    dead_notifications=lambda c: operations.dead_notifications(c.outbox),
    pending_approvals=lambda c: operations.pending_approvals(c.approvals),
    outbox_listing=lambda c: operations.outbox_listing(c.outbox),
    orchestration_status=lambda c: operations.orchestration_status(c.orchestrations, c.approvals),
    orchestration_status_by_id=lambda c: operations.orchestration_status(
        c.orchestrations, c.approvals, _failed_runs(c)
    ),
    orchestration_status_summary=lambda c: operations.orchestration_status_summary(c.orchestrations),
    record_lookup=lambda c: operations.record_lookup(
        c.approvals, "approval_id", c.outbox.where("notification_status = 'DEAD'")
    ),
    customer_contacts=lambda c: operations.customer_contacts(c.customers),
    recipient_coverage=lambda c: operations.recipient_coverage(c.invoices, c.customers),
    reachable_recipients=lambda c: operations.recipient_coverage(
        c.invoices, c.customers, reachable_only=True
    ),
    recipient_coverage_all=lambda c: operations.recipient_coverage(c.invoices, c.customers, n=None),
)


# ---- conversations ----------------------------------------------------------------------
def _odd_events(c):
    """Audit events of which some have a type that the log does not know, or none."""
    eid = F.col("activity_id")
    kind = F.when(eid % 17 == 0, "NOTE").when(eid % 17 != 1, F.col("activity_type"))
    return fixtures.activity_events(c.spark, c.folder).withColumn("activity_type", kind)


@query
def recent_context(c):
    lines = F.transform("context", lambda m: F.concat(m["role"], F.lit(": "), m["text"]))
    return conversations.recent_context(c.messages).select(
        "conv_id", "message_count", F.array_join(lines, "\n").alias("context")
    )


register(
    activity_log=lambda c: conversations.activity_log(
        fixtures.activity_events(c.spark, c.folder)
    ),
    activity_log_rejects=lambda c: conversations.activity_rejects(_odd_events(c)).select(
        "activity_id", "conversation_id", "activity_type", "reason"
    ),
    conversation_sessions=lambda c: conversations.conversation_sessions(c.activity),
    classify_message=lambda c: conversations.classify_messages(c.messages).drop("is_follow_up"),
    is_follow_up=lambda c: conversations.classify_messages(c.messages).select(
        "conv_id", "turn", "is_follow_up"
    ),
    session_memory=lambda c: conversations.session_memory(c.activity),
    conversation_activity_summary=lambda c: conversations.conversation_activity_summary(c.activity),
)

# ---- workflow -----------------------------------------------------------------------------
def _workflow(c):
    """Every transition on the fixture tables, as functions so that only the wanted one runs."""
    now = fixtures.now()

    def execute(form):
        # Only an address makes invoices and customers necessary.
        parties = c.parties if form == "recipient" else (None, None)
        return workflow.execute_approved(c.approvals, c.outbox, c.request("executions"), now, *parties, form)

    return {
        "request_reminders": lambda: workflow.request_reminders(
            c.request("reminder_requests"), c.approvals, now
        ),
        "decide_approvals": lambda: workflow.decide_approvals(
            c.approvals, c.request("decisions"), now
        ),
        "execute_approved": lambda: execute("recipient"),
        "execute_approved_plain": lambda: execute("plain"),
        "execute_approved_message": lambda: execute("message"),
        "apply_delivery_results": lambda: workflow.apply_delivery_results(
            c.outbox, c.request("attempts"), now
        ),
        "apply_delivery_results_final": lambda: workflow.apply_delivery_results(
            c.outbox, c.request("attempts"), now, retries=False
        ),
        "requeue": lambda: workflow.requeue(
            c.outbox, c.recovery_log, c.request("recoveries"), now
        ),
        "start_orchestrations": lambda: workflow.start_orchestrations(
            c.request("run_requests"), c.orchestrations, c.approvals, c.sessions, *c.parties, now,
        ),
        "complete_orchestrations": lambda: workflow.complete_orchestrations(
            c.orchestrations, c.approvals, c.outbox, c.request("run_approvals"), *c.parties, now,
        ),
    }


def _table(step, table):
    return lambda c: _workflow(c)[step]().tables[table]


def _rejects(step):
    return lambda c: _workflow(c)[step]().rejects


def _step_events(step):
    return lambda c: _workflow(c)[step]().events.drop("activity_id")


@query
def delivery_round(c):
    """Claim what is ready, then settle it with the attempts made."""
    claimed = workflow.claim_notifications(c.outbox, fixtures.now())
    attempts = c.request("attempts")
    return workflow.apply_delivery_results(claimed, attempts, fixtures.now()).tables[workflow.OUTBOX]


@query
def append_activity_events(c):
    decided = _workflow(c)["decide_approvals"]().events
    return workflow.append_events(c.activity, decided)


def _shared_numbers(c):
    """Invoices of which every seventh customer's come twice, under the same number."""
    again = c.invoices.where("customer_id % 7 = 0").withColumn("invoice_id", -F.col("invoice_id"))
    return c.invoices.unionByName(again)


def _history(c):
    changes = c.request("status_changes")
    return workflow.transition_history(changes, K.NOTIFICATION_TRANSITIONS)


register(
    resolve_recipients=lambda c: workflow.resolve_recipients(c.request("run_requests"), *c.parties),
    resolve_recipients_address_first=lambda c: workflow.resolve_recipients(
        c.request("run_requests"), *c.parties, status_first=False
    ),
    resolve_recipients_ambiguous=lambda c: workflow.resolve_recipients(
        c.request("run_requests"), _shared_numbers(c), c.customers
    ),
    request_reminders=_table("request_reminders", workflow.APPROVALS),
    request_reminders_events=_step_events("request_reminders"),
    decide_approvals=_table("decide_approvals", workflow.APPROVALS),
    decide_approvals_rejects=_rejects("decide_approvals"),
    execute_approved=_table("execute_approved", workflow.APPROVALS),
    execute_approved_outbox=_table("execute_approved", workflow.OUTBOX),
    execute_approved_rejects=_rejects("execute_approved"),
    execute_approved_plain=_table("execute_approved_plain", workflow.OUTBOX),
    execute_approved_message=_table("execute_approved_message", workflow.APPROVALS),
    claim_notifications=lambda c: workflow.claim_notifications(c.outbox, fixtures.now()),
    claim_notifications_oldest=lambda c: workflow.claim_notifications(c.outbox, fixtures.now(), 25),
    claim_notifications_simple=lambda c: workflow.claim_notifications(
        c.outbox, fixtures.now(), retries=False
    ),
    apply_delivery_results=_table("apply_delivery_results", workflow.OUTBOX),
    apply_delivery_results_rejects=_rejects("apply_delivery_results"),
    apply_delivery_results_final=_table("apply_delivery_results_final", workflow.OUTBOX),
    requeue=_table("requeue", workflow.OUTBOX),
    requeue_log=_table("requeue", workflow.RECOVERY),
    requeue_rejects=_rejects("requeue"),
    start_orchestrations=_table("start_orchestrations", workflow.RUNS),
    start_orchestrations_approvals=_table("start_orchestrations", workflow.APPROVALS),
    start_orchestrations_conversations=_table("start_orchestrations", workflow.CONVERSATIONS),
    complete_orchestrations=_table("complete_orchestrations", workflow.RUNS),
    complete_orchestrations_approvals=_table("complete_orchestrations", workflow.APPROVALS),
    complete_orchestrations_outbox=_table("complete_orchestrations", workflow.OUTBOX),
    complete_orchestrations_steps=_step_events("complete_orchestrations"),
    complete_orchestrations_rejects=_rejects("complete_orchestrations"),
    transition_history=_history,
    illegal_transitions=lambda c: workflow.illegal_transitions(_history(c)),
    run_transition_history=lambda c: workflow.transition_history(
        c.request("run_changes"), K.ORCHESTRATION_TRANSITIONS
    ),
)


# ---- the same steps on stored tables, of which only touched buckets are rewritten ----------
def _stored(c, *names) -> Tables:
    frames = {
        "customers": "customers", workflow.APPROVALS: "approvals", workflow.OUTBOX: "outbox",
        workflow.RECOVERY: "recovery_log", workflow.RUNS: "orchestrations",
        workflow.CONVERSATIONS: "sessions", workflow.ACTIVITY: "activity",
    }
    # Tables that are not named are not derived either.
    wanted = {n: getattr(c, frames[n]) for n in names}
    return stored.create(stored.tables_at(c.spark, new_path(c.spark, "stored"), 16), wanted)


def _stored_step(names, step, table):
    """A step on freshly stored tables, and one of them afterwards (or its rejects)."""

    def run(c):
        tables = _stored(c, *names)
        done = step(c, tables, fixtures.now())
        return done.rejects if table is None else tables.read(table)

    return run


def _decide(c, tables, now):
    return stored.decide_approvals(tables, c.request("decisions"), now)


def _execute(c, tables, now):
    return stored.execute_approved(tables, c.request("executions"), now, *c.parties)


def _settle(c, tables, now):
    return stored.apply_delivery_results(tables, c.request("attempts"), now)


def _requeue(c, tables, now):
    return stored.requeue(tables, c.request("recoveries"), now)


def _start(c, tables, now):
    return stored.start_orchestrations(tables, c.request("run_requests"), *c.parties, now)


def _complete(c, tables, now):
    return stored.complete_orchestrations(tables, c.request("run_approvals"), *c.parties, now)


def _ask(c, tables, now):
    return stored.request_reminders(tables, c.request("reminder_requests"), now)


_BOX, _REQUEUED = [workflow.OUTBOX], [workflow.OUTBOX, workflow.RECOVERY]
_EXECUTED = [workflow.APPROVALS, workflow.OUTBOX]
_STARTED = [workflow.RUNS, workflow.APPROVALS, workflow.CONVERSATIONS]
_COMPLETED = [workflow.RUNS, workflow.APPROVALS, workflow.OUTBOX]
register(
    stored_request_reminders=_stored_step([workflow.APPROVALS], _ask, workflow.APPROVALS),
    stored_decide_approvals=_stored_step([workflow.APPROVALS], _decide, workflow.APPROVALS),
    stored_decide_approvals_rejects=_stored_step([workflow.APPROVALS], _decide, None),
    stored_execute_approved=_stored_step(_EXECUTED, _execute, workflow.APPROVALS),
    stored_execute_approved_outbox=_stored_step(_EXECUTED, _execute, workflow.OUTBOX),
    stored_apply_delivery_results=_stored_step(_BOX, _settle, workflow.OUTBOX),
    stored_requeue=_stored_step(_REQUEUED, _requeue, workflow.OUTBOX),
    stored_requeue_log=_stored_step(_REQUEUED, _requeue, workflow.RECOVERY),
    stored_start_orchestrations=_stored_step(_STARTED, _start, workflow.RUNS),
    stored_complete_orchestrations=_stored_step(_COMPLETED, _complete, workflow.RUNS),
    stored_complete_orchestrations_approvals=_stored_step(_COMPLETED, _complete, workflow.APPROVALS),
    stored_complete_orchestrations_outbox=_stored_step(_COMPLETED, _complete, workflow.OUTBOX),
)


@query
def stored_upsert(c):
    tables = _stored(c, "customers")
    stored.upsert(tables, "customers", _new_limits(c))
    return tables.read("customers").select(*UPSERTED)


@query
def stored_update_from(c):
    tables = _stored(c, "customers")
    stored.update_from(tables, "customers", _largest_invoices(c))
    return tables.read("customers").select(*UPDATED)


# ---- tables bucketed alike: joins on their key without a shuffle ----------------------------
@query
def colocated_customer_summary(c):
    date = aging.reporting_date(c.invoices).scalar()
    both = Colocated(c.spark, {"customers": c.customers, "invoices": c.invoices}, "customer_id", 8)
    return both.apply(lambda customers, invoices: risk.customer_collection_summary(customers, invoices, date))


@query
def colocated_apply_payments(c):
    both = Colocated(c.spark, {"invoices": c.new_invoices, "payments": c.payments}, "invoice_id", 8)
    return both.apply(payments.apply_payments).drop("payment_term_id", "dispute_flag", "created_date")


# ---- checks ---------------------------------------------------------------------------------
def _checked_tables(c):
    return {
        "customers": c.customers,
        "invoices": c.invoices,
        "agent_conversations": c.sessions,
        "agent_approval_requests": c.approvals,
        "agent_notification_outbox": c.outbox,
        "agent_orchestration_runs": c.orchestrations,
        "vw_ar_aging_detail": c.aging,
    }


@query
def integrity_checks(c):
    iid = F.col("invoice_id")
    damaged = c.invoices.withColumns(
        {
            "outstanding_amount": F.when(iid % 90 == 0, -F.col("invoice_amount"))
            .when(iid % 91 == 0, F.col("invoice_amount") + 1)
            .otherwise(F.col("outstanding_amount")),
            "due_date": F.when(iid % 70 != 0, F.col("due_date")),
        }
    )
    return checks.integrity_checks(damaged, _moved_keys(c.customers))


@query
def schema_checks(c):
    tables = _checked_tables(c)
    del tables["agent_orchestration_runs"]
    return checks.schema_checks(c.spark, tables, shapes=True, counts=True)


register(
    workflow_checks=lambda c: checks.workflow_checks(
        c.orchestrations, c.approvals, c.outbox, fixtures.now()
    ),
    all_checks=lambda c: checks.all_checks(c.spark, _checked_tables(c), fixtures.now()),
    readiness_report=lambda c: checks.readiness_report(
        checks.all_checks(c.spark, _checked_tables(c), fixtures.now())
    ),
)

# ---- streams, and the same results from whole histories -------------------------------------
def _event_rows(c):
    return fixtures.read_table(c.spark, c.folder, "events")


def _final_watermark(c):
    """Newest event less the allowed lateness."""
    return _event_rows(c).agg(F.max("ts") - F.expr("INTERVAL 1 HOUR")).scalar()


register(
    stream_payments_to_balances=jobs.payments_to_balances,
    stream_notification_metrics=jobs.notification_metrics,
    stream_notification_metrics_sliding=lambda c: jobs.notification_metrics(c, slide="6 hours"),
    stream_retry_machine=jobs.retry_machine,
    stream_stuck_detector=jobs.stuck_detector,
    stream_sessions=jobs.session_stream,
    stream_dedup_requests=jobs.dedup_requests,
    retry_outcomes=lambda c: replay.retry_outcomes(jobs.attempts_of(_event_rows(c))),
    stuck_intervals=lambda c: replay.stuck_intervals(
        c.request("status_changes"), _final_watermark(c)
    ),
    sessions=lambda c: replay.sessions(_event_rows(c), "user_id", "ts", "event_id"),
)


def comparable(df: DataFrame) -> DataFrame:
    """Amounts as doubles and instants without a zone, the form other engines are compared in."""

    def plain(field):
        kind, c = field.dataType.typeName(), F.col(field.name)
        if kind == "decimal":
            return c.cast("double").alias(field.name)
        if kind in ("timestamp", "date"):
            return c.cast("timestamp_ntz").alias(field.name)
        return c

    return df.select(*[plain(f) for f in df.schema])


def runnable() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(fn):
        return lambda spark, folder: comparable(fn(core(spark, folder)))

    return {name: bind(fn) for name, fn in QUERIES.items()}

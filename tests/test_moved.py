"""Queries derive, shuffle and write no more than they need."""

import pytest
from pyspark.sql import functions as F

from duebook.operators import normalize, workflow
from duebook.operators.blocks import dense_key, dense_key_with_copies
from duebook.plans import catalog
from duebook.plans.core import Core
from duebook.sources import fixtures
from duebook.storage import materialize
from duebook.tables import Tables

FOLDER = "/root/testdata/sf0.001"
RECEIVABLES = {"staging", "new_invoices", "payments", "invoices", "customers"}


def test_closing_with_a_message_needs_no_receivables(spark):
    c = Core(spark, FOLDER)
    assert catalog.QUERIES["execute_approved_message"](c).count() > 0
    assert not RECEIVABLES & set(vars(c))


def test_only_named_tables_are_stored(spark):
    c = Core(spark, FOLDER)
    tables = catalog._stored(c, workflow.RUNS)
    assert set(tables.pointer()["tables"]) == {workflow.RUNS}
    assert not (RECEIVABLES | {"approvals", "outbox", "sessions", "activity"}) & set(vars(c))


def test_invoices_and_customers_need_no_ids_of_staged_rows(spark):
    c, whole = Core(spark, FOLDER), Core(spark, FOLDER)
    assert whole.staging.count() == c.sold.count()
    assert c.invoices.exceptAll(whole.invoices).isEmpty() and whole.invoices.exceptAll(c.invoices).isEmpty()
    assert c.customers.exceptAll(whole.customers).isEmpty() and whole.customers.exceptAll(c.customers).isEmpty()
    assert "staging" not in vars(c)


def test_columns_of_the_order_alone_are_not_written(spark):
    rows = spark.range(1000).selectExpr("id % 7 as a", "id as b", "id * 2 as c")
    keyed = dense_key(rows, "n", ["a", "b"], blocks=3, keep=["c"])
    assert keyed.columns == ["n", "c"]
    assert {f.name for f in spark.read.parquet(*keyed.inputFiles()).schema} == {"c", "_block", "_pos"}
    want = rows.selectExpr("row_number() over (order by a, b) as n", "c")
    assert keyed.exceptAll(want).isEmpty() and keyed.count() == 1000


def test_copies_are_moved_twice(spark):
    rows = spark.range(100).selectExpr("id % 10 as a", "'x' as b")
    keyed = dense_key_with_copies(rows, "n", blocks=3)
    text = keyed._jdf.queryExecution().executedPlan().toString()
    # Reading the sorted rows takes no shuffle but that of the sizes of blocks.
    assert text.count("Exchange hashpartitioning(_block") == text.count("Exchange hashpartitioning") == 1
    assert "Window [sum(_copies" not in text and "rangepartitioning" not in text


def test_rows_of_one_pass_are_not_stored(spark):
    c = Core(spark, FOLDER)
    for table in (c.approvals, c.outbox, c.activity, c.recovery_log, c.orchestrations, c.request("executions")):
        assert all("events.parquet" in f or "orders.parquet" in f for f in table.inputFiles())


def test_invoices_alone_are_built_without_a_copy_of_the_staged_rows(spark):
    c, whole = Core(spark, FOLDER), Core(spark, FOLDER)
    built = catalog.QUERIES["build_invoices"](c)
    assert not {"staging", "sold"} & set(vars(c))
    want = normalize.build_invoices(whole.staging, whole.terms, fixtures.load_date())
    assert built.exceptAll(want).isEmpty() and want.exceptAll(built).isEmpty()


def test_lines_meet_parts_before_and_customers_after_their_orders_are_sorted_out(spark, tmp_path):
    for table in ("part", "customer", "nation", "orders"):
        spark.read.parquet(f"{FOLDER}/{table}.parquet").write.parquet(str(tmp_path / f"{table}.parquet"))
    lines = spark.read.parquet(f"{FOLDER}/lineitem.parquet")
    # A price that is no number matters only where the line has an order.
    lost = lines.limit(1).withColumns({"l_orderkey": F.lit(-1).cast("bigint"), "l_extendedprice": F.lit("NaN").cast("double")})
    lines.unionByName(lost).write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        rows = fixtures.staging(spark, str(tmp_path), numbered=False).select(*normalize.INVOICED)
        text = rows._jdf.queryExecution().optimizedPlan().toString()
        # The join of lines and orders is the last one: both sides are complete by then.
        first = next(line for line in text.splitlines() if "Join" in line)
        assert "l_orderkey" in first and "o_orderkey" in first
        want = fixtures.staging(spark, FOLDER).select(*normalize.INVOICED)
        assert rows.exceptAll(want).isEmpty() and want.exceptAll(rows).isEmpty()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize(
    "name", ["execute_approved_rejects", "execute_approved_outbox", "start_orchestrations_approvals",
             "stored_complete_orchestrations_outbox"],
)
def test_recipients_need_no_payments_or_balances(spark, name):
    c = Core(spark, FOLDER)
    assert catalog.QUERIES[name](c).count() > 0
    assert not {"staging", "payments", "invoices", "customers"} & set(vars(c))


def test_recipients_need_no_ids_dates_or_amounts(spark):
    c, whole = Core(spark, FOLDER), Core(spark, FOLDER)
    started = catalog.QUERIES["start_orchestrations_approvals"](c)
    assert not RECEIVABLES & set(vars(c)) and "sold" not in vars(c)
    runs = [c.request("run_requests"), c.orchestrations, c.approvals, c.sessions]
    want = workflow.start_orchestrations(*runs, whole.invoices, whole.customers, fixtures.now()).tables[workflow.APPROVALS]
    assert started.exceptAll(want).isEmpty() and want.exceptAll(started).isEmpty()


def odd_lines(spark, path):
    """Tables of `FOLDER` in which lines and orders come twice and lines have odd values."""
    for table in ("part", "customer", "nation"):
        spark.read.parquet(f"{FOLDER}/{table}.parquet").write.parquet(f"{path}/{table}.parquet")
    orders = spark.read.parquet(f"{FOLDER}/orders.parquet")
    orders.unionByName(orders.where("o_orderkey % 3 = 0").withColumn("o_custkey", F.col("o_custkey") + 1)).unionByName(orders).write.parquet(
        f"{path}/orders.parquet")
    lines, key = spark.read.parquet(f"{FOLDER}/lineitem.parquet"), F.col("l_orderkey")
    odd = lines.withColumns({
        "l_extendedprice": F.when(key % 7 == 1, -F.col("l_extendedprice")).when(key % 7 != 2, F.col("l_extendedprice")),
        "l_quantity": F.when(key % 11 == 1, -F.col("l_quantity")).when(key % 11 != 2, F.col("l_quantity")),
    })
    # Values that are no numbers matter only where the line has an order.
    lost = lines.limit(1).withColumn("l_orderkey", F.lit(-1).cast("bigint"))
    nan = F.lit("NaN").cast("double")
    for part in (lost.withColumn("l_extendedprice", nan), lost.withColumn("l_quantity", nan), lost.withColumn("l_quantity", F.lit(0.0)), odd):
        odd = odd.unionByName(part)
    odd.write.parquet(f"{path}/lineitem.parquet")
    return path


def test_billed_rows_are_those_of_invoices(spark, tmp_path):
    c, whole = Core(spark, odd_lines(spark, str(tmp_path))), Core(spark, str(tmp_path))
    want = whole.new_invoices.select("invoice_number", "customer_id")
    assert c.billed.count() > 0 and "sold" not in vars(c)
    assert c.billed.exceptAll(want).isEmpty() and want.exceptAll(c.billed).isEmpty()
    assert want.count() < Core(spark, FOLDER).billed.count() * 2  # some are left out
    # Of customers that share a number the smallest has the lowest id.
    asked = want.select("invoice_number").unionByName(spark.createDataFrame([("none",), (None,)], "invoice_number string"))
    owners = fixtures.with_contacts(normalize.build_customers(whole.sold, fixtures.load_date()))
    plain, ids = (workflow.resolve_recipients(asked, *p) for p in (c.parties, (whole.new_invoices, owners)))
    assert plain.where("reason = 'AMBIGUOUS_INVOICE'").count() > 0
    assert plain.exceptAll(ids).isEmpty() and ids.exceptAll(plain).isEmpty()


def test_values_that_cannot_be_read_are_errors_where_the_line_has_an_order(spark, tmp_path):
    for table in ("part", "customer", "nation", "orders"):
        spark.read.parquet(f"{FOLDER}/{table}.parquet").write.parquet(str(tmp_path / f"{table}.parquet"))
    lines = spark.read.parquet(f"{FOLDER}/lineitem.parquet")
    lines.withColumn("l_extendedprice", F.lit("NaN").cast("double")).write.parquet(str(tmp_path / "lineitem.parquet"))
    with pytest.raises(Exception, match="CAST"):
        Core(spark, str(tmp_path)).billed.count()


def test_lines_are_moved_with_their_order_alone(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        rows = normalize.billed(fixtures.sales(spark, FOLDER, numbered=False, judged=True), ["_order"])
        text = rows._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Rows that met by their order are not moved again.
    moved = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
    assert moved and not any("invoice_number" in line for line in moved)
    # Lines that cannot be eligible stay where they are.
    first = next(line for line in text.splitlines() if "Filter" in line)
    assert "l_quantity" in first and "l_extendedprice" in first


def test_names_and_addresses_of_started_runs_are_not_written(spark, monkeypatch):
    written, real = {}, workflow.materialize

    def seen(df, name):
        written[name] = df.columns
        return real(df, name)

    monkeypatch.setattr(workflow, "materialize", seen)
    assert catalog.QUERIES["start_orchestrations_approvals"](Core(spark, FOLDER)).count() > 0
    assert set(written["run-starts"]) == {"request_id", "orchestration_id", "invoice_number", "reason", "message"}


def test_requests_are_moved_once_for_their_recipients(spark):
    c = Core(spark, FOLDER)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        asked = c.request("run_requests")
        text = workflow.resolve_recipients(asked, *c.parties)._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Customers are met by invoices: the first join is that of requests with both.
    joins = [line for line in text.splitlines() if "Join LeftOuter" in line]
    assert "invoice_number" in joins[0] and "customer_id" in joins[1]


@pytest.mark.parametrize(
    "name, column, status",
    [("execute_approved_rejects", "approval_status", "APPROVED"),
     ("stored_complete_orchestrations_outbox", "orchestration_status", "WAITING_APPROVAL")],
)
def test_only_requests_that_pass_so_far_meet_recipients(spark, monkeypatch, name, column, status):
    met, real = [], workflow.resolve_recipients

    def seen(requests, *others, **more):
        met.append(requests.select(column).distinct().collect())
        return real(requests, *others, **more)

    monkeypatch.setattr(workflow, "resolve_recipients", seen)
    assert catalog.QUERIES[name](Core(spark, FOLDER)).count() > 0
    assert [[r[0] for r in rows] for rows in met] == [[status]]


def test_stored_files_are_zstd(spark, tmp_path):
    tables = Tables(spark, str(tmp_path), {"t": "id"}, 2)
    run = tables.run()
    run.create("t", spark.range(10))
    run.publish()
    files = [*tables.read("t").inputFiles(), *materialize(spark.range(10), "numbers").inputFiles()]
    assert all(f.endswith(".zstd.parquet") for f in files)

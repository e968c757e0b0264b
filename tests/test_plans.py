"""The physical plans are the ones meant."""

import contextlib
import io

import pytest

from pyspark.sql import functions as F

from duebook.operators import aging, checks, constraints, kpis, normalize, operations, payments, risk, staging, workflow
from duebook.operators.blocks import dense_key
from duebook.operators.requested import requested, store_for_lookups
from duebook.plans.colocated import Colocated
from duebook.plans.core import core

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def c(spark):
    return core(spark, FOLDER)


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_keys_never_gather_the_rows(c):
    text = plan(dense_key(c.staging.select("invoice_no", "transaction_id"), "n", ["invoice_no", "transaction_id"]))
    # The only gathered rows are the block sizes, below the broadcast.
    assert text.count("Exchange SinglePartition") <= 1
    assert "rangepartitioning" not in text  # the sort was written, not repeated


@pytest.mark.parametrize(
    "build",
    [
        lambda c: aging.top_of_queue(c.invoices, c.customers, 20),
        lambda c: aging.top_overdue_customers(c.invoices, c.customers),
        lambda c: aging.top_overdue_invoices(c.invoices, c.customers),
        lambda c: normalize.top_customers_by_outstanding(c.customers, c.invoices),
        lambda c: payments.top_payments(c.payments, c.invoices, c.customers),
        lambda c: operations.recipient_coverage(c.invoices, c.customers),
        lambda c: operations.recent_notifications(c.outbox),
    ],
)
def test_top_rows_are_not_fully_sorted(c, build):
    text = plan(build(c))
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_names_are_joined_after_the_cut(c):
    for df in (aging.top_of_queue(c.invoices, c.customers, 20), aging.top_overdue_customers(c.invoices, c.customers),
               aging.top_overdue_invoices(c.invoices, c.customers), operations.recipient_coverage(c.invoices, c.customers),
               normalize.top_customers_by_outstanding(c.customers, c.invoices),
               payments.top_payments(c.payments, c.invoices, c.customers)):
        tree = plan(df).split("\n(1) ")[0]
        cut = tree.rindex("TakeOrderedAndProject")
        assert "Inner" in plan(df) and "Join" in tree[:cut], tree


def test_constraints_read_every_table_once(c):
    from duebook.plans import catalog

    tables = catalog._damaged(c)
    tree = plan(constraints.constraint_violations(tables)).split("\n(1) ")[0]
    assert tree.count("Scan parquet") <= len(tables) + 1  # one table is made of two readings


def test_reports_read_few_columns_with_filters(c):
    text = plan(aging.aging_summary(c.invoices, "2001-08-20"))
    assert "GreaterThan(outstanding_amount,0.00)" in text
    assert "ReadSchema: struct<due_date:timestamp,outstanding_amount:decimal(18,2)>" in text


def test_row_checks_share_one_scan(c):
    text = plan(checks.integrity_checks(c.invoices, c.customers))
    # Row checks, the orphan count, and two reads of the customers.
    assert text.count("Scan parquet") <= 2 * 4


def test_summary_aggregates_before_it_joins(c):
    text = plan(risk.customer_collection_summary(c.customers, c.invoices, "2001-09-01"))
    assert text.count("Scan parquet") <= 2 * 2
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_no_query_pairs_rows_without_a_key(spark, c):
    from duebook.plans.catalog import QUERIES

    for name in ("collections_narrative", "executive_dashboard", "reconcile_header_lines", "aging_validation",
                 "ar_aging_detail", "decide_approvals"):
        text = plan(QUERIES[name](c))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_no_python_in_batch_operators(c):
    for df in (c.aging, c.risk, c.outbox, c.activity):
        assert "Python" not in plan(df) and "Pandas" not in plan(df)


def test_files_are_in_the_shared_folder(spark, c):
    base = spark.conf.get("spark.checkpoint.dir").removeprefix("file://")
    files = c.invoices.inputFiles()
    assert files and all(base in f for f in files)


def test_discarded_tables_are_gone(spark):
    from pathlib import Path

    from duebook.storage import discard, materialize

    table = materialize(spark.range(5), "short-lived")
    folder = Path(table.inputFiles()[0].removeprefix("file://")).parent
    assert folder.exists()
    discard(table)
    assert not folder.exists()


# ---- storage that lookups can skip, tables bucketed alike, figures counted while writing -----------
def scan_rows(df):
    """Rows that the Parquet scans of a collected frame read."""
    executed = df._jdf.queryExecution().executedPlan()
    leaves = executed.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


@pytest.fixture
def without_aqe(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.enabled")


def test_lookups_skip_row_groups(spark, tmp_path, without_aqe):
    rows = spark.range(200_000).select(
        F.xxhash64("id").alias("customer_id"), F.concat(F.lit("N"), F.hash("id").cast("string")).alias("invoice_number"), "id"
    )
    table = store_for_lookups(rows.repartition(2), str(tmp_path / "t"), "customer_id", ["customer_id", "invoice_number"], 100_000)
    assert table.count() == 200_000
    some = rows.where("id = 77").first()
    for key in ("customer_id", "invoice_number"):
        ids = spark.createDataFrame([(some[key],), (some[key],), (None,)], f"{key} {rows.schema[key].dataType.simpleString()}")
        found = requested(table, ids, key)
        assert [r.id for r in found.collect()] == [77]
        assert f"[IsNotNull({key}), EqualTo({key}" in plan(found) or f"In({key}" in plan(found)
        # Both columns are far from sorted as a whole: Bloom filters and the order in a file skip the rest.
        assert scan_rows(found) < 100_000
    assert requested(table, ids.where("false"), "invoice_number").count() == 0
    many = rows.select("invoice_number")
    assert requested(table, many, "invoice_number").count() == 200_000 and "LeftSemi" in plan(requested(table, many, "invoice_number"))


def test_bucketed_tables_are_joined_without_a_shuffle(spark, c):
    # One customer has a third of all invoices.
    busy = c.customers.first().customer_id
    more = c.invoices.withColumn("customer_id", F.when(F.col("invoice_id") % 3 == 0, busy).otherwise(F.col("customer_id")))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        both = Colocated(spark, {"customers": c.customers, "invoices": more}, "customer_id", 4, share=0.1)
        assert [r[0] for r in both.hot_keys.collect()] == [busy]

        def summary(customers, invoices):
            return risk.customer_collection_summary(customers, invoices, "2001-09-15")

        cold = plan(summary(**both.cold))
        assert "SortMergeJoin" in cold and "Exchange" not in cold
        # The busy customer is summed up before its rows are shuffled.
        hot = plan(summary(**both.hot))
        assert hot.count("HashAggregate") >= 2 and "Exchange" in hot
        whole = sorted(map(str, summary(c.customers, more).collect()))
        assert sorted(map(str, both.apply(summary).collect())) == whole
        paid = Colocated(spark, {"invoices": c.new_invoices, "payments": c.payments}, "invoice_id", 4)
        assert "Exchange" not in plan(payments.apply_payments(**paid.cold))
        both.drop(), paid.drop()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_indicators_of_all_dimensions_take_one_scan(c):
    owner = c.customers.select("customer_id", "status", "customer_type")
    frame = c.invoices.join(owner, "customer_id", "left")
    dimensions = {"status": F.lit("a"), "customer_type": F.lit("b")}
    others = [f.withColumns(dimensions) for f in (c.aging, c.orchestrations, c.approvals, c.outbox)]
    once = kpis.indicators_by_each(frame, *others, list(dimensions))[0]
    assert plan(once).count("Scan parquet") == plan(frame).count("Scan parquet")
    total = once.where("dimension = 'ALL'").drop("dimension", "value")
    assert [tuple(r) for r in total.collect()] == [tuple(r) for r in kpis.portfolio_kpis(c.invoices).collect()]


def test_grouped_indicators_without_dimensions_or_rows(c):
    frames = [f.limit(0) for f in (c.invoices, c.aging, c.orchestrations, c.approvals, c.outbox)]
    for frame in kpis.indicators_by_each(*frames, []):
        assert [r.dimension for r in frame.collect()] == ["ALL"]


def test_sketches_of_parts_unite(c):
    parts = c.staging.withColumn("source_part", F.pmod(F.col("transaction_id"), F.lit(3)).cast("string"))
    stored = staging.profile_sketches(parts)
    later = staging.profile_sketches(parts.where("source_part = '2'"))
    united = staging.profile_from_sketches(stored.where("source_part <> '2'").unionByName(later)).first()
    exact = staging.profile_transactions(c.staging).first()
    for name in exact.asDict():
        bound = staging.sketch_bound() * exact[name] if name in staging.PROFILED else 0
        assert abs(united[name] - exact[name]) <= bound + 1e-9
    assert staging.profile_from_sketches(stored.limit(0)).first().unique_invoices == 0


def test_only_requested_rows_are_grouped(c):
    asked = c.orchestrations.select("invoice_number").limit(5)
    text = plan(workflow.resolve_recipients(asked, c.invoices, c.customers))
    tree = text.split("\n(1) ")[0]
    # The semi join lies below the grouping of invoices.
    assert "LeftSemi" in text and tree.index("HashAggregate") < tree.index("Join", tree.index("HashAggregate"))


def test_each_key_is_sent_once(c):
    tables = {"customers": c.customers, "invoices": c.invoices, "invoice_lines": c.lines, "payments": c.payments}
    spaces = constraints._spaces(tables)
    assert spaces[("invoices", "invoice_id")] == [("invoices", "invoice_id"), ("invoice_lines", "invoice_id"), ("payments", "invoice_id")]
    assert plan(constraints.constraint_violations(tables)).split("\n(1) ")[0].count("Scan parquet") == 4


def test_unknown_ids_are_errors_in_sql(spark, c):
    from duebook.operators import lookups

    lookups.register_lookups(spark, c.invoices, c.customers, c.aging, c.risk)
    known, number = c.aging.first().customer_id, c.invoices.first().invoice_number
    assert spark.sql(f"SELECT * FROM get_customer_summary({known})").count() == 1
    assert spark.sql(f"SELECT * FROM get_overdue_invoices({known})").count() == c.aging.where(f"customer_id = {known} AND days_past_due > 0").count()
    assert spark.sql(f"SELECT * FROM get_invoice_details('{number}')").count() == 1
    for call, text in [("get_customer_summary(-5)", "Customer does not exist: -5"), ("get_overdue_invoices(-5)", "Customer does not exist: -5"),
                       ("get_invoice_details('nope')", "Invoice does not exist: nope")]:
        with pytest.raises(Exception, match=text):
            spark.sql(f"SELECT * FROM {call}").collect()
    owes_nothing = c.customers.join(c.aging, "customer_id", "left_anti").first()
    if owes_nothing:
        assert spark.sql(f"SELECT * FROM get_overdue_invoices({owes_nothing.customer_id})").count() == 0
    lookups.register_lookups(spark, c.invoices, c.customers, c.aging, c.risk, strict=False)
    assert spark.sql("SELECT * FROM get_customer_summary(-5)").count() == 0

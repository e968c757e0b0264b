"""Stored tables: touched buckets only, one commit for several tables, exactly the rows of a full rewrite."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from duebook.operators import merge, workflow
from duebook.plans import stored
from duebook.plans.core import core
from duebook.plans.refresh import refresh
from duebook.sources import fixtures, requests
from duebook.tables import Conflict, Tables

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def c(spark):
    return core(spark, FOLDER)


def files(tables, name):
    """Files of a table as readers see it."""
    return set(tables.read(name).inputFiles())


def bucket(file):
    return file.partition("_bucket=")[2].partition("/")[0]


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def rows(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def numbers(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "approval_id long")


def test_read_of_one_key_opens_one_bucket(spark, c, tmp_path):
    tables = stored.create(stored.tables_at(spark, str(tmp_path), 16), {workflow.APPROVALS: c.approvals})
    some = c.approvals.where("approval_status = 'PENDING'").first().approval_id
    touched = tables.read(workflow.APPROVALS, numbers(spark, some))
    assert len({bucket(f) for f in touched.inputFiles()}) == 1
    assert "PartitionFilters: [isnotnull(_bucket" in plan(touched).replace("#", " #")
    assert touched.where(F.col("approval_id") == some).count() == 1
    assert len(files(tables, workflow.APPROVALS)) == 16 and rows(tables.read(workflow.APPROVALS)) == rows(c.approvals)


def test_one_decision_writes_one_bucket(spark, c, tmp_path):
    tables = stored.create(stored.tables_at(spark, str(tmp_path), 16), {workflow.APPROVALS: c.approvals})
    some = c.approvals.where("approval_status = 'PENDING'").first().approval_id
    decision = spark.createDataFrame(
        [(1, some, "APPROVED", "me", "yes"), (2, -10**15, "APPROVED", "me", ""), (3, None, "APPROVED", "me", "")],
        "decision_id long, approval_id long, decision string, reviewed_by string, comments string",
    )
    before = files(tables, workflow.APPROVALS)
    done = stored.decide_approvals(tables, decision, fixtures.now())
    after = files(tables, workflow.APPROVALS)
    # The bucket of the unknown id is written again as it was.
    assert {bucket(f) for f in before ^ after} <= {bucket(f) for f in tables.read(workflow.APPROVALS, numbers(spark, some, -10**15)).inputFiles()}
    assert len(before & after) >= 14
    full = workflow.decide_approvals(c.approvals, decision, fixtures.now())
    assert rows(tables.read(workflow.APPROVALS)) == rows(full.tables[workflow.APPROVALS])
    assert rows(done.rejects) == rows(full.rejects) and rows(done.events) == rows(full.events)
    assert {r.reason for r in done.rejects.collect()} == {"NOT_FOUND"}


def test_merges_touch_their_keys_only(spark, c, tmp_path):
    tables = stored.create(stored.tables_at(spark, str(tmp_path), 16), {"customers": c.customers})
    some = c.customers.first().customer_id
    source = spark.createDataFrame([(some, "new name"), (10**9, "new customer")], "customer_id long, customer_name string")
    before = files(tables, "customers")
    stored.upsert(tables, "customers", source)
    assert len(before - files(tables, "customers")) <= 2
    assert rows(tables.read("customers")) == rows(merge.upsert(c.customers, source, ["customer_id"]))
    assert tables.highest("customers") == 10**9
    twice = source.unionByName(source)
    with pytest.raises(Exception, match="several rows"):
        stored.update_from(tables, "customers", twice)
    assert rows(tables.read("customers")) == rows(merge.upsert(c.customers, source, ["customer_id"]))


def test_a_run_that_stops_half_way_changes_nothing(spark, c, tmp_path, monkeypatch):
    names = {workflow.RUNS: c.orchestrations, workflow.APPROVALS: c.approvals, workflow.OUTBOX: c.outbox}
    tables = stored.create(stored.tables_at(spark, str(tmp_path), 8), names)
    before = {n: (files(tables, n), rows(tables.read(n))) for n in names}
    asked = requests.run_approvals(spark, FOLDER)
    real = workflow.RUNS, "append"

    def stop(self, name, *args, **more):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr("duebook.tables.Run.append", stop)  # the outbox is the last of the three tables
        with pytest.raises(RuntimeError, match="lost"):
            stored.complete_orchestrations(tables, asked, c.invoices, c.customers, fixtures.now())
    assert real and {n: (files(tables, n), rows(tables.read(n))) for n in names} == before
    stored.complete_orchestrations(tables, asked, c.invoices, c.customers, fixtures.now())
    full = workflow.complete_orchestrations(
        c.orchestrations, c.approvals, c.outbox, asked, c.invoices, c.customers, fixtures.now()
    ).tables
    assert {n: rows(tables.read(n)) for n in names} == {n: rows(full[n]) for n in names}
    tables.vacuum()
    assert {n: rows(tables.read(n)) for n in names} == {n: rows(full[n]) for n in names}


def test_two_runs_at_once(spark, tmp_path):
    tables = Tables(spark, str(tmp_path), {"t": "k"}, 4)
    first, second = tables.run(), tables.run()
    first.create("t", spark.range(5).withColumnRenamed("id", "k"))
    second.create("t", spark.range(9).withColumnRenamed("id", "k"))
    first.publish()
    with pytest.raises(Conflict):
        second.publish()
    assert tables.read("t").count() == 5


def test_rows_outside_the_replaced_buckets_are_an_error(spark, tmp_path):
    tables = Tables(spark, str(tmp_path), {"t": "k"}, 64)
    run = tables.run()
    run.create("t", spark.range(500).withColumnRenamed("id", "k"))
    run.publish()
    run = tables.run()
    one = spark.createDataFrame([(3,)], "k long")
    with pytest.raises(ValueError, match="outside"):
        run.replace("t", spark.range(500).withColumnRenamed("id", "k"), one)
    assert tables.read("t").count() == 500


def test_empty_tables_and_keys(spark, tmp_path):
    tables = Tables(spark, str(tmp_path), {"t": "k"}, 4)
    run = tables.run()
    run.create("t", spark.createDataFrame([], "k long, v string"))
    run.publish()
    assert tables.read("t").count() == 0 and tables.read("t").columns == ["k", "v"] and tables.highest("t") == 0
    run = tables.run()
    run.append("t", spark.createDataFrame([(None, "a"), (2, None)], "k long, v string"))
    run.publish()
    none = spark.createDataFrame([(None,)], "k long")
    assert tables.read("t").count() == 2 and tables.read("t", none).count() == 0 and tables.highest("t") == 2
    assert [r.v for r in tables.read("t", spark.createDataFrame([(2,)], "k int")).where("k = 2").collect()] == [None]


HEADER = "Invoice,StockCode,Description,Quantity,InvoiceDate,Price,Customer ID,Country\n"
GOOD = '100,A,"Lamp, ""red""",2,2026-07-01 10:00:00,20.00,7.0,Norway'
BAD = [
    "101,A,Lamp,1,2026-07-01 10:00:00,20.00,7.0,Norway,extra", "102,A,Lamp", '103,A,"Lamp,1,2026-07-01 10:00:00,20.00,7.0,Norway',
    '104,A,"Lamp"x,1,2026-07-01 10:00:00,20.00,7.0,Norway',
]


def load(spark, folder, lines, name="in.csv", **more):
    path = folder / name
    path.write_text(HEADER + "\n".join(lines) + "\n")
    return refresh(spark, {"a": str(path)}, str(folder / "out"), "retail", F.lit("2026-08-01").cast("timestamp"), buckets=4, **more)


def test_malformed_lines_are_rejected(spark, tmp_path):
    out = load(spark, tmp_path, [GOOD, *BAD, "", GOOD.replace("100", "105")])
    got = {r.corrupt_record: (r.line_fault, r.failed_rules) for r in out["rejects"].collect()}
    number, quotes = "line with too few or too many fields", "line with bad quotes"
    assert got == {
        BAD[0]: ("9 of 8 fields", number), BAD[1]: ("3 of 8 fields", number), BAD[2]: ("bad quotes", quotes),
        BAD[3]: ("bad quotes", quotes),
    }
    assert out["stg_retail_transactions"].count() + len(got) == 6
    assert {r.description for r in out["stg_retail_transactions"].collect()} == {'Lamp, "red"'}


def test_a_load_is_published_as_a_whole(spark, tmp_path, monkeypatch):
    load(spark, tmp_path, [GOOD])
    tables = stored.tables_at(spark, str(tmp_path / "out"))
    assert tables.read("invoices").count() == 1
    real, calls = __import__("duebook.tables", fromlist=["Run"]).Run.create, []

    def create(self, name, df, *args):
        calls.append(name)
        if name == "invoice_lines":
            raise RuntimeError("lost")
        return real(self, name, df, *args)

    with monkeypatch.context() as m:
        m.setattr("duebook.tables.Run.create", create)
        with pytest.raises(RuntimeError, match="lost"):
            load(spark, tmp_path, [GOOD, GOOD.replace("100", "105")])
    assert "invoices" in calls
    assert tables.read("invoices").count() == tables.read("customers").count() == 1
    load(spark, tmp_path, [GOOD, GOOD.replace("100", "105")])
    assert tables.read("invoices").count() == tables.read("invoice_lines").count() == 2


def test_counts_of_a_load_need_no_reading(spark, tmp_path):
    out = load(spark, tmp_path, [GOOD, *BAD])
    tables = stored.tables_at(spark, str(tmp_path / "out"))
    counts = stored.load_counts(tables)
    assert "FileScan" not in plan(counts) and "Scan parquet" not in plan(counts)
    got = {r.table_name: (r.row_count, r.total_amount) for r in counts.collect()}
    assert got["invoices"] == (1, out["invoices"].agg(F.sum("invoice_amount")).first()[0])
    assert got["rejects"] == (4, None) and got["customers"] == (1, None) and got["payments"] == (0, None)

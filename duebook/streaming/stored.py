"""Streams that keep their results in stored tables, touching only the buckets of a batch.

Every batch is one published run of the tables, which also notes the batch, so a batch that is
repeated after a failure changes nothing.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duebook.functions.expr import MONEY
from duebook.operators.payments import paid_per_invoice, settle
from duebook.storage import materialize
from duebook.streaming.run import ROCKSDB, STATE_STORE, settings
from duebook.tables import Run, Tables

TOTALS, SEEN, STATUS, LATE = "payment_totals", "seen_requests", "retry_status", "late_rows"
FINAL = ("SENT", "DEAD")


def each_batch(
    stream: DataFrame, tables: Tables, name: str, step: Callable[[Run, DataFrame, int], None], state: str,
    mode="append", **confs,
):
    """Run `stream` over what is there; `step` changes the tables once per batch.

    `state` is the checkpoint folder.  Returns the finished query, with its progress.
    """

    def once(batch: DataFrame, number: int) -> None:
        run = tables.run()
        if run.before["notes"].get(name, -1) >= number:
            return
        step(run, batch, number)
        run.note(name, number)
        run.publish()

    with settings(stream.sparkSession, {STATE_STORE: ROCKSDB, **confs}):
        query = (
            stream.writeStream.outputMode(mode).foreachBatch(once)
            .option("checkpointLocation", state).trigger(availableNow=True).start()
        )
        query.awaitTermination()
    return query


def _keys(tables: Tables, **more) -> None:
    tables.keys.update(more)


def _known(run: Run, name: str, keys: DataFrame, schema) -> DataFrame:
    """Stored rows in the buckets of the keys; none before the first batch."""
    if name in run.before["tables"]:
        return run.read(name, keys)
    return keys.sparkSession.createDataFrame([], schema)


# ---- payments ---------------------------------------------------------------------------------
def settle_batch(run: Run, payments: DataFrame, number: int) -> None:
    """Add a batch's payments to the totals of their invoices and settle these invoices.

    A total carries the last batch that changed it and takes no batch twice.
    """
    sums = materialize(paid_per_invoice(payments), "batch-sums")
    keys = sums.select("invoice_id")
    old = _known(run, TOTALS, keys, "invoice_id bigint, total_paid decimal(18,2), batch bigint")
    due = F.col("added").isNotNull() & (F.coalesce("batch", F.lit(-1)) < number)
    paid = F.coalesce("total_paid", F.lit(0).cast(MONEY)) + F.col("added")
    totals = old.join(sums.withColumnRenamed("total_paid", "added"), "invoice_id", "full_outer").select(
        "invoice_id", F.when(due, paid).otherwise(F.col("total_paid")).cast(MONEY).alias("total_paid"),
        F.when(due, number).otherwise(F.col("batch")).cast("bigint").alias("batch"),
    )
    after = run.replace(TOTALS, totals, keys) if TOTALS in run.before["tables"] else run.create(TOTALS, totals)
    run.replace("invoices", settle(run.read("invoices", keys), after.select("invoice_id", "total_paid")), keys)


def settle_payments(tables: Tables, payments: DataFrame, state: str):
    """Keep the stored `invoices` settled with a stream of payments."""
    _keys(tables, **{TOTALS: "invoice_id", "invoices": "invoice_id"})
    return each_batch(payments, tables, "settled_batch", settle_batch, state)


# ---- duplicate guard ----------------------------------------------------------------------------
def _unseen(run: Run, requests: DataFrame, number: int) -> None:
    first = materialize(
        requests.groupBy("approval_id").agg(F.min("requested_at").alias("requested_at")), "batch-requests"
    )
    keys = first.select("approval_id")
    known = _known(run, SEEN, keys, "approval_id bigint, requested_at timestamp")
    run.append(SEEN, first.join(known.select("approval_id"), "approval_id", "left_anti"))


def dedup_requests(tables: Tables, requests: DataFrame, state: str, window="1 hour"):
    """Every approval's first request, for good, with state for a window only.

    Repeats within `window` are dropped by the stream's state, which forgets ids behind the
    watermark; repeats far beyond it by the stored ids, of which a batch reads the buckets that
    its own ids fall into.  Rows without an id or a time are dropped.
    """
    _keys(tables, **{SEEN: "approval_id"})
    near = (
        requests.select("approval_id", "requested_at").where("approval_id IS NOT NULL AND requested_at IS NOT NULL")
        .withWatermark("requested_at", window).dropDuplicatesWithinWatermark(["approval_id"])
    )
    return each_batch(near, tables, "request_batch", _unseen, state)


# ---- retries --------------------------------------------------------------------------------------
def _latest_status(run: Run, changes: DataFrame, number: int) -> None:
    values = ["notification_status", "retry_count", "changed_at", "next_retry_at", "is_final"]
    # Of several rows of a notification in one batch the one with the most attempts is last.
    place = F.struct("is_final", "changed_at", "retry_count", F.col("notification_status") == "RETRY_DUE")
    last = materialize(
        changes.groupBy("notification_id").agg(F.max_by(F.struct(*values), place).alias("_r"))
        .select("notification_id", *[F.col(f"_r.{v}").alias(v) for v in values]), "batch-status",
    )
    keys = last.select("notification_id")
    old = _known(run, STATUS, keys, last.schema)
    closed = old.where("is_final")
    fresh = last.join(closed.select("notification_id"), "notification_id", "left_anti")
    after = old.join(fresh.select("notification_id"), "notification_id", "left_anti").unionByName(fresh)
    if STATUS in run.before["tables"]:
        run.replace(STATUS, after, keys)
    else:
        run.create(STATUS, after)


def retry_status(tables: Tables, changes: DataFrame, state: str):
    """Status per notification from `stream_retry_machine`.

    Once a notification is final, in the stored table or in its outbox, later rows of it are
    turned away, so the stream need not remember it.
    """
    _keys(tables, **{STATUS: "notification_id"})
    return each_batch(changes, tables, "retry_batch", _latest_status, state, mode="update")


def open_and_closed(outbox: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What a retry stream starts from: open notifications for its state, and closed ones.

    Open are notifications that are neither sent nor dead, with their failures so far; closed
    rows have the shape of the stored status table.
    """
    closed = F.col("notification_status").isin(*FINAL)
    at = F.coalesce("updated_at", "created_at")
    return (
        outbox.where(~closed & (F.col("retry_count") > 0)).select(
            "notification_id", F.col("retry_count").cast("int").alias("failures"), at.alias("last_failure_at")
        ),
        outbox.where(closed).select(
            "notification_id", "notification_status", F.col("retry_count").cast("int").alias("retry_count"),
            at.alias("changed_at"), F.lit(None).cast("timestamp").alias("next_retry_at"), F.lit(True).alias("is_final"),
        ),
    )


# ---- late rows ------------------------------------------------------------------------------------
def split_late(tables: Tables, stream: DataFrame, time: str, lateness: str, folder: str, state: str):
    """Rows in time go to Parquet files below `folder`, late ones to the stored table `late_rows`.

    A row is late when its time lies more than `lateness` behind the newest time of the batches
    before its own, which is the watermark of an operator that reads the same batches; rows
    without a time are late.  So every row is in one of the two places, and an operator with the
    same lateness that reads `folder` drops none.
    """

    def step(run: Run, batch: DataFrame, number: int) -> None:
        newest = run.before["notes"].get("newest")
        mark = F.lit(newest).cast("timestamp") - F.expr(f"INTERVAL {lateness}")
        late = F.lit(False) if newest is None else F.coalesce(F.col(time) < mark, F.lit(True))
        late = late | F.col(time).isNull()
        rows = materialize(batch.withColumn("_late", late), "batch-rows")
        rows.where("NOT _late").drop("_late").write.mode("overwrite").parquet(f"{folder}/batch={number:09d}")
        run.append(LATE, rows.where("_late").drop("_late"))
        top = rows.agg(F.max(time).cast("string").alias("t"), F.count("*").alias("n"), F.count_if("_late").alias("late")).first()
        run.note("newest", max(filter(None, [newest, top.t]), default=None))
        run.note("rows_read", run.before["notes"].get("rows_read", 0) + top.n)
        run.note("rows_late", run.before["notes"].get("rows_late", 0) + top.late)

    return each_batch(stream, tables, "split_batch", step, state)


def dropped_behind_watermark(query) -> int:
    """Rows that the stateful operators of a finished query dropped as late, from its progress."""
    return sum(
        op.numRowsDroppedByWatermark for progress in query.recentProgress for op in progress.stateOperators
    )


def state_rows(query) -> int:
    """Rows that the stateful operators of a finished query still hold."""
    done = [p for p in query.recentProgress if p.stateOperators]
    return sum(op.numRowsTotal for op in done[-1].stateOperators) if done else 0

"""Receivables and workflow inputs derived from the driver's tables (rules: FIXTURES.md)."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from duebook import constants as K
from duebook.functions.expr import fill, first_match, money
from duebook.operators.blocks import dense_key
from duebook.schemas import conform

# Instants used in place of the wall clock.
LOAD_DATE = "2001-08-02 00:00:00"
NOW = "2024-01-15 12:00:00"
LAST_DAY = "2001-08-01"
SPAN_DAYS = 150


def load_date() -> Column:
    return F.lit(LOAD_DATE).cast("timestamp")


def now() -> Column:
    return F.lit(NOW).cast("timestamp")


def read_table(spark: SparkSession, folder: str, name: str, place=False) -> DataFrame:
    """A driver table with zone-less timestamps read as UTC instants.

    `place` adds each row's file and position, which tell exact copies of a row apart.
    """
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    zoneless = {f.name for f in df.schema if f.dataType.typeName() == "timestamp_ntz"}
    where = [
        F.xxhash64("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"),
    ]
    return df.select(
        *[F.col(c).cast("timestamp").alias(c) if c in zoneless else F.col(c) for c in df.columns],
        *(where if place else []),
    )


SALES_ORDER = [
    "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
    "l_shipdate", "l_returnflag", "l_linestatus", "_file", "_row",
]


SOLD = ["l_partkey", "l_quantity", "l_extendedprice", "_cancelled"]


def _cents() -> Column:
    return F.round(F.col("l_extendedprice") * 100)


def _signed(count: Column) -> Column:
    return F.when(F.col("_cancelled"), -1).otherwise(1) * count


def _unit_price(cents: str, count: str, cast=Column.cast) -> Column:
    each = F.expr(f"{cents} div (CAST({count} AS BIGINT) * 20)")
    return cast(each * F.lit("0.01").cast("decimal(3,2)"), "decimal(10,2)")


def _sold_on(last: Column) -> Column:
    """Day of the sale: the order's day, moved into the last `SPAN_DAYS` days."""
    age = (F.datediff(last, F.to_date("o_orderdate")) % SPAN_DAYS).cast("int")
    return F.date_sub(last, age)


def sales(spark: SparkSession, folder: str, numbered=True, judged=False) -> DataFrame:
    """Order lines in the shape of staged transactions; without ids where `numbered` is False.

    Without ids the lines, by far the most rows, are moved once, for their orders: parts, of which no
    column may be wanted, are met before that, and customers are met by the orders.  Rows then lie by
    `_order`, which is theirs in addition.  With `judged` lines without a quantity above 0 or a price
    stay behind; 1 and 0 stand for the values of the others, which then are not moved.
    """

    def table(name):
        return read_table(spark, folder, name)

    last = F.lit(LAST_DAY).cast("date")
    cancelled = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F")
    lines = read_table(spark, folder, "lineitem", place=numbered).withColumn("_cancelled", cancelled)
    if numbered:
        # Ids are given to the order lines themselves, before any join.
        lines = dense_key(
            lines.select("l_orderkey", *SALES_ORDER, "_cancelled"),
            "transaction_id", ["l_orderkey", *SALES_ORDER], keep=["l_orderkey", *SOLD],
        )
        cents = _cents().cast("bigint")
    elif judged:
        # What cannot be read is moved as it is, and is an error only where the line has an order.
        count, whole = F.col("l_quantity").try_cast("int"), _cents().try_cast("bigint")
        price = _unit_price("_whole", "nullif(_count, 0)", Column.try_cast)
        read = F.col("_price").isNotNull()
        lines = lines.withColumns({"_count": count, "_whole": whole}).withColumn("_price", price).select(
            F.lit(None).cast("bigint").alias("transaction_id"), "l_orderkey", "l_partkey", "_cancelled",
            F.when(read, (_signed(F.col("_count")) > 0) & (F.col("_price") >= 0)).alias("_fine"),
            *[F.when(~read, F.col(c)).alias(c) for c in ("l_quantity", "l_extendedprice")],
        ).where("coalesce(_fine, true)")
        cents = _cents().cast("bigint")
    else:
        # Whole cents take less room than a double.  What they cannot hold stays one, and is an
        # error only where the line has an order.
        whole = _cents().try_cast("bigint")
        lines = lines.select(
            F.lit(None).cast("bigint").alias("transaction_id"), "l_orderkey", "l_partkey", "l_quantity", "_cancelled",
            whole.alias("_whole"), F.when(whole.isNull(), F.col("l_extendedprice")).alias("l_extendedprice"),
        )
        cents = F.coalesce(F.col("_whole"), _cents().cast("bigint"))
    orders = table("orders").select("o_orderkey", "o_custkey", _sold_on(last).alias("_sold_on"))
    of_order = F.col("l_orderkey") == F.col("o_orderkey")
    parts, of_part = table("part").select("p_partkey", "p_name"), F.col("p_partkey") == F.col("l_partkey")
    buyers, of_buyer = table("customer").select("c_custkey", "c_nationkey"), F.col("c_custkey") == F.col("o_custkey")
    nations, of_nation = table("nation").select("n_nationkey", "n_name"), F.col("n_nationkey") == F.col("c_nationkey")
    if numbered:
        joined = lines.join(orders, of_order).join(parts, of_part).join(buyers, of_buyer).join(nations, of_nation)
    else:
        joined = lines.join(parts, of_part).join(orders.join(buyers, of_buyer).join(nations, of_nation), of_order)
    cancelled = F.col("_cancelled")
    quantity, unit_price = _signed(F.col("l_quantity").cast("int")), _unit_price("_cents", "l_quantity")
    if judged:
        # The buyer, whom every row has, keeps Spark from reading lines before they have met their orders.
        fine, bought = F.col("_fine"), F.col("o_custkey").isNotNull()
        quantity, unit_price = (F.when(fine, known).when(bought, c) for known, c in ((1, quantity), (0, unit_price)))
    return joined.withColumn("_cents", cents).select(
        "transaction_id",
        F.concat(F.when(cancelled, "C").otherwise(""), F.col("o_orderkey").cast("string")).alias(
            "invoice_no"
        ),
        F.col("l_partkey").cast("string").alias("stock_code"),
        F.col("p_name").alias("description"),
        quantity.alias("quantity"),
        F.col("_sold_on").cast("timestamp").alias("invoice_date"),
        unit_price.alias("unit_price"),
        F.when(F.col("o_orderkey") % 5 != 0, F.col("o_custkey")).alias("customer_id"),
        F.col("n_name").alias("country"),
        *([] if numbered else [F.col("o_orderkey").alias("_order")]),
    )


def staging(spark: SparkSession, folder: str, numbered=True) -> DataFrame:
    """Staged transactions; ids are the places of the lines in the order of their values."""
    return conform(
        sales(spark, folder, numbered).withColumns(
            {
                "load_date": load_date(),
                "source_file": F.lit("lineitem.parquet"),
            }
        ),
        "stg_retail_transactions",
    )


def raw_transactions(staging: DataFrame) -> DataFrame:
    """Staged rows back in the raw file's columns, all text, with some unreadable values."""
    tid = F.col("transaction_id")
    text = {
        "Invoice": F.col("invoice_no"),
        "StockCode": F.col("stock_code"),
        "Description": F.when(tid % 101 == 0, F.repeat("description", 60)).otherwise(
            F.col("description")
        ),
        "Quantity": F.when(tid % 97 == 0, "n/a").otherwise(F.col("quantity").cast("int").cast("string")),
        "InvoiceDate": F.when(tid % 89 == 0, "not a date").otherwise(
            F.date_format("invoice_date", "yyyy-MM-dd HH:mm:ss")
        ),
        "Price": F.when(tid % 83 == 0, "free").otherwise(F.col("unit_price").cast("string")),
        "Customer ID": F.concat(F.col("customer_id").cast("string"), F.lit(".0")),
        "Country": F.col("country"),
    }
    return staging.select("transaction_id", *[c.alias(n) for n, c in text.items()])


def raw_lines(staging: DataFrame) -> DataFrame:
    """Staged rows as lines of a raw file, in a column named as its header, some of them malformed."""
    tid = F.col("transaction_id")
    quoted = F.concat(F.lit('"'), F.col("description"), F.lit('"'))
    description = (
        F.when(tid % 40 == 3, F.concat(F.lit('"'), F.col("description"))).when(tid % 40 == 4, F.concat(quoted, F.lit("x")))
        .otherwise(quoted)
    )
    first = [F.col("invoice_no"), F.col("stock_code"), description]
    rest = [
        F.col("quantity").cast("int").cast("string"), F.date_format("invoice_date", "yyyy-MM-dd HH:mm:ss"),
        F.col("unit_price").cast("string"), F.coalesce(F.col("customer_id").cast("string"), F.lit("")), F.col("country"),
    ]
    line = (
        F.when(tid % 40 == 1, F.concat_ws(",", *first, *rest, F.lit("one too many"))).when(tid % 40 == 2, F.concat_ws(",", *first))
        .otherwise(F.concat_ws(",", *first, *rest))
    )
    return staging.select(line.alias(",".join(K.RAW_HEADER)))


def derive_payments(invoices: DataFrame, created: Column) -> DataFrame:
    """Payment fixture: ids divisible by 5 paid in full, the next id half, others unpaid."""
    turn, amount = F.col("invoice_id") % 5, F.col("invoice_amount")
    methods = F.array(*[F.lit(m) for m in K.PAYMENT_METHODS])
    rows = invoices.where(turn.isin(0, 1) & (amount > 0)).select(
        "invoice_id",
        F.timestamp_add("DAY", (F.col("invoice_id") % 45 + 1).cast("int"), F.col("invoice_date")).alias(
            "payment_date"
        ),
        F.when(turn == 0, amount).otherwise(money(amount * F.lit("0.50").cast("decimal(3,2)"))).alias(
            "payment_amount"
        ),
        F.get(methods, (F.col("invoice_id") % 4).cast("int")).alias("payment_method"),
        F.concat(
            F.lit(K.PAYMENT_REFERENCE_PREFIX), F.lpad(F.col("invoice_id").cast("string"), 10, "0")
        ).alias("reference_number"),
        created.alias("created_date"),
    )
    return conform(dense_key(rows, "payment_id", ["invoice_id"]), "payments")


def with_contacts(customers: DataFrame) -> DataFrame:
    """Customers with missing, blank and real addresses and all three statuses, by rule."""
    cid = F.col("customer_id")
    email = first_match(
        [(cid % 4 == 0, F.lit(None).cast("string")), (cid % 4 == 1, F.lit("   "))],
        F.concat(F.lit("c"), cid.cast("string"), F.lit("@example.com")),
    )
    status = F.when(cid % 10 == 3, "INACTIVE").when(cid % 10 == 7, "BLOCKED").otherwise("ACTIVE")
    return customers.withColumns({"email": email, "status": status})


def order_count(spark: SparkSession, folder: str) -> Column:
    return read_table(spark, folder, "orders").agg(F.count("*")).scalar()


def _events(spark: SparkSession, folder: str) -> DataFrame:
    return events_of(read_table(spark, folder, "events"), order_count(spark, folder))


def events_of(events: DataFrame, orders: Column) -> DataFrame:
    """Events, stored or streamed, with the ids that the workflow rules use."""
    eid = F.col("event_id")
    return events.select(
        "event_id",
        "ts",
        "user_id",
        "event_type",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        F.concat(F.lit("conv-"), F.col("user_id").cast("string")).alias("conversation_id"),
        ((eid * 3 + 1) % orders).cast("string").alias("invoice_number"),
    )


def _plus(amount: int, unit: str, c: str = "ts") -> Column:
    return F.timestamp_add(unit, F.lit(amount), F.col(c))


def _twice(events: DataFrame) -> DataFrame:
    """Two approvals per event: one in any state, and one, with a negative id, that was executed."""
    second = F.explode(F.array(F.lit(False), F.lit(True))).alias("_second")
    return events.select("*", second).withColumn(
        "_approval", F.when(F.col("_second"), -F.col("event_id") - 1).otherwise(F.col("event_id"))
    ).withColumn(
        "_notification", F.when(F.col("_second"), F.col("_approval")).otherwise(F.col("event_id") + 1)
    )


def approvals(spark: SparkSession, folder: str) -> DataFrame:
    eid = F.col("event_id")
    status = F.when(F.col("_second"), "EXECUTED").otherwise(
        F.get(F.array(*[F.lit(s) for s in K.APPROVAL_STATUSES]), (eid % 5).cast("int"))
    )
    executed = F.col("approval_status") == "EXECUTED"
    reviewed = F.col("approval_status") != "PENDING"
    rows = (
        _twice(_events(spark, folder))
        .withColumn("approval_status", status)
        .select(
            F.col("_approval").alias("approval_id"),
            "conversation_id",
            F.col("ts").alias("requested_at"),
            F.concat(F.lit("user-"), F.col("user_id").cast("string")).alias("requested_by"),
            F.when(eid % 11 == 0, "OTHER_ACTION").otherwise(K.REMINDER_ACTION).alias("action_type"),
            fill(K.TEXT_REQUEST, F.col("invoice_number")).alias("action_description"),
            F.to_json(
                F.struct("invoice_number", F.lit(K.REMINDER_CHANNEL).alias("channel"))
            ).alias("action_payload"),
            "approval_status",
            F.when(reviewed, _plus(1, "HOUR")).alias("reviewed_at"),
            F.when(reviewed, K.REVIEWER).alias("reviewed_by"),
            F.when(executed, _plus(2, "HOUR")).alias("executed_at"),
            F.when(executed, "SUCCESS").alias("execution_status"),
            F.when(executed, fill(K.TEXT_EXECUTED_RUN, F.col("_notification"))).alias("execution_message"),
        )
    )
    return conform(rows, "agent_approval_requests")


def outbox(spark: SparkSession, folder: str) -> DataFrame:
    return outbox_of(read_table(spark, folder, "events"), order_count(spark, folder))


def outbox_of(events: DataFrame, orders: Column) -> DataFrame:
    """Notifications of executed approvals, which every event has, and of every fifth approved
    one (a duplicate guard case)."""
    eid, k = F.col("event_id"), F.col("k")
    status = first_match(
        [
            (F.col("event_type") == "click", F.lit("PENDING")),
            (F.col("event_type") == "signup", F.lit("PROCESSING")),
            (F.col("event_type") == "purchase", F.lit("SENT")),
            (F.col("event_type") == "view", F.lit("RETRY")),
            (k % 2 == 0, F.lit("DEAD")),
        ],
        F.lit("FAILED"),
    )
    st = F.col("notification_status")
    updated = F.timestamp_add("MINUTE", k, F.col("ts"))
    failed = st.isin("RETRY", "DEAD", "FAILED")
    rows = (
        _twice(events_of(events, orders))
        .where(F.col("_second") | (eid % 5 == 4) | (eid % 25 == 1))
        .withColumn("notification_status", status)
        .select(
            F.col("_notification").alias("notification_id"),
            F.col("_approval").alias("approval_id"),
            "conversation_id",
            F.lit(K.REMINDER_TYPE).alias("notification_type"),
            F.when(
                k % 7 != 0, F.concat(F.lit("u"), F.col("user_id").cast("string"), F.lit("@example.com"))
            ).alias("recipient_address"),
            fill(K.TEXT_SUBJECT, F.col("invoice_number")).alias("subject_text"),
            fill(K.TEXT_BODY_PLAIN, F.col("invoice_number")).alias("message_body"),
            "notification_status",
            F.when(st == "DEAD", 3).otherwise(k % 3).alias("retry_count"),
            F.lit(K.MAX_RETRY_COUNT).alias("max_retry_count"),
            F.when(st == "RETRY", _plus(1, "MINUTE")).alias("next_retry_at"),
            F.col("ts").alias("created_at"),
            F.when(st.isin("SENT", "DEAD", "FAILED"), updated).alias("processed_at"),
            updated.alias("updated_at"),
            F.when(failed, K.TEXT_NO_RECIPIENT).alias("error_message"),
            F.when(st == "DEAD", K.TEXT_DEAD).when(st == "RETRY", K.TEXT_RETRY).alias("failure_reason"),
            F.when(st == "DEAD", updated).alias("dead_at"),
            k.alias("_k"),
        )
    )
    return rows


def outbox_table(spark: SparkSession, folder: str) -> DataFrame:
    return conform(outbox(spark, folder), "agent_notification_outbox")


def recovery_log(spark: SparkSession, folder: str) -> DataFrame:
    rows = outbox(spark, folder).where(F.col("notification_status").isin(*K.RECOVERABLE_STATUSES))
    return conform(
        rows.select(
            F.col("notification_id").alias("recovery_id"),
            "notification_id",
            F.col("notification_status").alias("previous_status"),
            F.lit("PENDING").alias("new_status"),
            F.lit(K.REVIEWER).alias("recovered_by"),
            F.lit(K.TEXT_RECOVERY_REASON).alias("recovery_reason"),
            _plus(5, "MINUTE", "updated_at").alias("recovered_at"),
        ),
        "agent_notification_recovery_log",
    )


def orchestrations(spark: SparkSession, folder: str) -> DataFrame:
    eid = F.col("event_id")
    status = F.get(
        F.array(*[F.lit(s) for s in K.ORCHESTRATION_STATUSES]), (eid % 7).cast("int")
    )
    st = F.col("orchestration_status")
    rows = (
        _events(spark, folder)
        .withColumn("orchestration_status", status)
        .select(
            eid.alias("orchestration_id"),
            "invoice_number",
            eid.alias("approval_id"),
            F.when(st.isin("QUEUED", "PROCESSING", "COMPLETED"), eid + 1).alias("notification_id"),
            "orchestration_status",
            st.alias("current_step"),
            F.col("ts").alias("started_at"),
            F.when(st.isin("COMPLETED", "FAILED"), _plus(10, "MINUTE")).alias("completed_at"),
            F.when(st == "FAILED", fill(K.ERR_INVOICE, F.col("invoice_number"))).alias(
                "error_message"
            ),
        )
    )
    return conform(rows, "agent_orchestration_runs")


def activity_events(spark: SparkSession, folder: str) -> DataFrame:
    """One audit event per driver event; tool calls name a customer or an invoice in turn."""
    k, kind = F.col("k"), F.col("event_type")
    activity = first_match(
        [
            (kind == "view", F.lit("USER_MESSAGE")),
            (kind == "click", F.lit("TOOL_CALL")),
            (kind == "purchase", F.lit("AGENT_RESPONSE")),
            (kind == "error", F.lit("ERROR")),
            (k % 2 == 0, F.lit("SESSION_END")),
        ],
        F.lit("MEMORY_CLEAR"),
    )
    tool, is_tool = F.col("activity_type"), F.col("activity_type") == "TOOL_CALL"
    by_customer = is_tool & (k % 3 != 0)
    by_invoice = is_tool & (k % 3 == 0)
    return (
        _events(spark, folder)
        .withColumn("activity_type", activity)
        .select(
            F.col("event_id").alias("activity_id"),
            "conversation_id",
            F.col("ts").alias("activity_time"),
            "activity_type",
            F.when(tool == "USER_MESSAGE", F.concat(F.lit("question "), k.cast("string"))).alias(
                "user_question"
            ),
            F.when(by_invoice, "get_invoice_details")
            .when(by_customer, "get_overdue_invoices")
            .alias("tool_name"),
            F.when(by_customer, k).cast("bigint").alias("customer_id"),
            F.when(by_invoice, F.col("invoice_number")).alias("invoice_number"),
            F.when(is_tool, k).alias("records_returned"),
            F.when(tool == "AGENT_RESPONSE", F.concat(F.lit("answer "), k.cast("string"))).alias(
                "agent_response"
            ),
            F.when(tool == "ERROR", F.repeat(F.lit("error text "), 400 + k)).alias("error_message"),
        )
    )


def messages(spark: SparkSession, folder: str) -> DataFrame:
    """Conversation turns with commands and follow-up phrases added by rule."""
    turn, text = F.col("turn"), F.col("text")
    said = first_match(
        [
            (turn % 6 == 1, F.concat(F.lit("which one "), text)),
            (turn % 6 == 2, F.concat(F.lit("request reminder "), F.col("conv_id").cast("string"))),
            (turn % 6 == 3, F.lit("clear")),
            (turn % 6 == 4, F.concat(F.lit("approve "), turn.cast("string"))),
        ],
        text,
    )
    return read_table(spark, folder, "conversations").select("conv_id", "turn", "role", said.alias("text"))

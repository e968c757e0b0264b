"""Conversation audit, message classification and session memory."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from duebook import constants as K
from duebook.functions import text as T
from duebook.operators.blocks import Ordered
from duebook.schemas import conform


def activity_log(events: DataFrame) -> DataFrame:
    """Typed audit rows: tool arguments as JSON, errors marked FAILED.

    `events` may carry `customer_id` and `invoice_number` as tool arguments.  Events of other
    types are left to `activity_rejects`.
    """
    arguments = [c for c in ("customer_id", "invoice_number") if c in events.columns]
    given = F.coalesce(*[F.col(c).cast("string") for c in arguments]) if arguments else F.lit(None)
    is_error = F.col("activity_type") == "ERROR"
    rows = events.where(F.col("activity_type").isin(K.ACTIVITY_TYPES)).withColumns(
        {
            "tool_arguments": F.when(given.isNotNull(), F.to_json(F.struct(*arguments)))
            if arguments
            else F.lit(None).cast("string"),
            "execution_status": F.when(is_error, "FAILED").otherwise("SUCCESS"),
        }
    )
    return conform(rows, "agent_activity_log")


def activity_rejects(events: DataFrame) -> DataFrame:
    """Events that the activity log does not take, with the reason."""
    known = F.coalesce(F.col("activity_type").isin(K.ACTIVITY_TYPES), F.lit(False))
    return events.where(~known).withColumn("reason", F.lit("UNKNOWN_ACTIVITY_TYPE"))


def conversation_sessions(log: DataFrame, created_by: str = "SYSTEM") -> DataFrame:
    """Start, end and outcome per conversation; COMPLETED when it was ended by a command."""
    closing = F.when(F.col("activity_type") == "SESSION_END", F.col("activity_time"))
    rows = log.groupBy("conversation_id").agg(
        F.min("activity_time").alias("started_at"),
        F.coalesce(F.max(closing), F.max("activity_time")).alias("ended_at"),
        F.when(F.max(closing).isNotNull(), "COMPLETED").otherwise("ERROR").alias(
            "conversation_status"
        ),
        F.lit(created_by).alias("created_by"),
    )
    return conform(rows, "agent_conversations")


def classify_messages(messages: DataFrame) -> DataFrame:
    """User messages with audit type, command argument and follow-up mark."""
    said = messages.where(F.col("role") == "user")
    return said.select(
        "conv_id",
        "turn",
        "text",
        T.activity_type(F.col("text")).alias("activity_type"),
        T.argument(F.col("text")).alias("argument"),
        T.is_follow_up(F.col("text")).alias("is_follow_up"),
    )


def recent_context(messages: DataFrame, k=6) -> DataFrame:
    """The last `k` remembered messages per conversation, oldest first.

    Remembered are agent messages and user questions after the last `clear`; commands are not.
    Rows are cut to `k` per conversation before they are grouped, and the cut happens before
    the shuffle as well.
    """
    kind = F.when(F.col("role") == "user", T.activity_type(F.col("text")))
    typed = messages.select("conv_id", "turn", "role", "text", kind.alias("_type"))
    cleared = (
        typed.where(F.col("_type") == "MEMORY_CLEAR")
        .groupBy("conv_id")
        .agg(F.max("turn").alias("_cleared"))
    )
    history = typed.where((F.col("role") == "assistant") | (F.col("_type") == "USER_MESSAGE"))
    newest = Window.partitionBy("conv_id").orderBy(F.desc("turn"))
    latest = history.withColumn("_age", F.row_number().over(newest)).where(F.col("_age") <= k)
    kept = latest.join(cleared, "conv_id", "left").where(
        F.col("_cleared").isNull() | (F.col("turn") > F.col("_cleared"))
    )
    context = F.array_sort(F.collect_list(F.struct("turn", "role", "text")))
    return kept.groupBy("conv_id").agg(
        F.count("*").alias("message_count"), context.alias("context")
    )


def session_memory(log: DataFrame) -> DataFrame:
    """Customer, invoice and tool in memory after every audit event.

    A tool call replaces what it names; a clear forgets everything before it.
    """
    told = Ordered(
        log.select(
            "conversation_id", "activity_time", "activity_id", "activity_type", "tool_name",
            F.get_json_object("tool_arguments", "$.customer_id").cast("bigint").alias("_customer"),
            F.nullif(
                F.get_json_object("tool_arguments", "$.invoice_number"), F.lit("")
            ).alias("_invoice"),
        ),
        ["conversation_id"],
        ["activity_time", "activity_id"],
        name="memory",
    )
    clears = F.col("activity_type") == "MEMORY_CLEAR"
    is_tool = F.col("activity_type") == "TOOL_CALL"

    def remembered(c):
        # A clear is remembered too, as an empty value that hides what came before it.
        return F.when(clears | (is_tool & F.col(c).isNotNull()), F.struct(F.when(is_tool, F.col(c)).alias("v")))

    memory = {
        "memory_customer_id": "_customer",
        "memory_invoice_number": "_invoice",
        "memory_tool_name": "tool_name",
    }
    remembering = told.running(
        sums={"clears": F.when(clears, 1).otherwise(0).cast("bigint")},
        lasts={name: remembered(c) for name, c in memory.items()},
    )
    return remembering.result().select(
        "conversation_id", "activity_id", "activity_time", "activity_type", "clears",
        *[F.col(f"{name}.v").alias(name) for name in memory],
    )


def conversation_activity_summary(log: DataFrame) -> DataFrame:
    kind = F.col("activity_type")
    return log.groupBy("conversation_id").agg(
        F.count("*").alias("activity_count"),
        F.count_if(kind == "USER_MESSAGE").alias("user_messages"),
        F.count_if(kind == "TOOL_CALL").alias("tool_calls"),
        F.count_if(kind == "AGENT_RESPONSE").alias("agent_responses"),
        F.count_if(F.col("execution_status") == "FAILED").alias("errors"),
        F.coalesce(F.sum("records_returned"), F.lit(0)).alias("records_returned"),
        F.min("activity_time").alias("first_activity"),
        F.max("activity_time").alias("last_activity"),
    )

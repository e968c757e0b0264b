"""Message classification, follow-ups, context and memory."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from duebook.functions import text as T
from duebook.operators import conversations as C
from tests.frames import by

CASES = {
    " EXIT ": ("SESSION_END", None),
    "quit": ("SESSION_END", None),
    "Clear": ("MEMORY_CLEAR", None),
    "Request Reminder  Inv-9 ": ("APPROVAL_REQUEST", "Inv-9"),
    "request reminder": ("USER_MESSAGE", None),
    "approve 12": ("APPROVAL_DECISION", "12"),
    "REJECT  7": ("APPROVAL_DECISION", "7"),
    "approve twelve": (None, None),
    "approve 1 2": (None, None),
    "approve": ("USER_MESSAGE", None),
    "execute 5": ("ACTION_EXECUTION", "5"),
    "approvals": (None, None),
    "context": (None, None),
    "": (None, None),
    "who owes most?": ("USER_MESSAGE", None),
}


def test_classification(spark):
    df = spark.createDataFrame([(t,) for t in CASES], "text string")
    out = df.select("text", T.activity_type(F.col("text")).alias("a"), T.argument(F.col("text")).alias("b"))
    assert by(out, "text", "a", "b") == CASES


@pytest.mark.parametrize(
    "text, expected",
    [("And WHICH ONE is late?", True), ("what should I do now", True), ("list invoices", False),
     ("Tell me more.", True), ("the old est", False)],
)
def test_follow_up(spark, text, expected):
    assert spark.range(1).select(T.is_follow_up(F.lit(text))).first()[0] is expected


def test_context_holds_the_last_messages_after_a_clear(spark):
    rows = [(1, 0, "user", "old"), (1, 1, "user", "clear"), (1, 2, "user", "q1"), (1, 3, "assistant", "a1"),
            (1, 4, "user", "approve 3"), (1, 5, "user", "q2"), (2, 0, "system", "s"), (2, 1, "user", "clear")]
    rows += [(3, i, "assistant", f"m{i}") for i in range(9)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = {r["conv_id"]: [m["text"] for m in r["context"]] for r in C.recent_context(df).collect()}
    assert got == {1: ["q1", "a1", "q2"], 3: ["m3", "m4", "m5", "m6", "m7", "m8"]}


def log(spark, rows):
    start = dt.datetime(2026, 1, 1)
    data = [
        ("c", start + dt.timedelta(seconds=i), i, kind, tool, json.dumps(args) if args else None)
        for i, (kind, tool, args) in enumerate(rows)
    ]
    return spark.createDataFrame(
        data, "conversation_id string, activity_time timestamp, activity_id bigint, activity_type string, "
        "tool_name string, tool_arguments string"
    )


def test_memory(spark):
    rows = log(
        spark,
        [("TOOL_CALL", "a", {"customer_id": 5}), ("USER_MESSAGE", None, None),
         ("TOOL_CALL", "b", {"invoice_number": "N1"}), ("TOOL_CALL", "c", {"invoice_number": ""}),
         ("MEMORY_CLEAR", None, None), ("TOOL_CALL", "d", {"customer_id": 6})],
    )
    got = by(C.session_memory(rows), "activity_id", "memory_customer_id", "memory_invoice_number", "memory_tool_name")
    assert got == {
        0: (5, None, "a"), 1: (5, None, "a"), 2: (5, "N1", "b"), 3: (5, "N1", "c"), 4: (None, None, None),
        5: (6, None, "d"),
    }


def test_sessions_end_by_command_or_in_error(spark):
    rows = log(spark, [("USER_MESSAGE", None, None), ("SESSION_END", None, None)])
    other = log(spark, [("USER_MESSAGE", None, None)]).withColumn("conversation_id", F.lit("d"))
    got = by(C.conversation_sessions(rows.unionByName(other)), "conversation_id", "conversation_status")
    assert got == {"c": "COMPLETED", "d": "ERROR"}

"""Column expressions over console messages."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from duebook import constants as K
from duebook.functions.expr import first_match

REQUEST_PREFIX = "request reminder "
# A command word, one blank, and a whole number.
NUMBERED = r"^(approve|reject|execute) \s*([+-]?[0-9]+)$"
# Commands that are answered from memory and leave no audit event.
SILENT = ["context", "approvals", "outbox"]


def stripped(text: Column) -> Column:
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def command(text: Column) -> Column:
    return F.lower(stripped(text))


def activity_type(text: Column) -> Column:
    """Audit event type of a console line; NULL when it leaves no event."""
    line = command(text)
    word = F.regexp_extract(line, NUMBERED, 1)
    return first_match(
        [
            (line == "", F.lit(None).cast("string")),
            (line.isin("exit", "quit"), F.lit("SESSION_END")),
            (line == "clear", F.lit("MEMORY_CLEAR")),
            (line.isin(SILENT), F.lit(None).cast("string")),
            (line.startswith(REQUEST_PREFIX), F.lit("APPROVAL_REQUEST")),
            (word.isin("approve", "reject"), F.lit("APPROVAL_DECISION")),
            (word == "execute", F.lit("ACTION_EXECUTION")),
            (line.rlike("^(approve|reject|execute) "), F.lit(None).cast("string")),
        ],
        F.lit("USER_MESSAGE"),
    )


def argument(text: Column) -> Column:
    """Invoice number or approval id that a command names."""
    line = command(text)
    number = F.regexp_extract(line, NUMBERED, 2)
    invoice = stripped(F.substr(stripped(text), F.lit(len(REQUEST_PREFIX) + 1)))
    return F.when(line.startswith(REQUEST_PREFIX), invoice).when(
        number != "", number.try_cast("bigint").cast("string")
    )


def is_follow_up(text: Column) -> Column:
    """Whether the text contains one of the follow-up phrases, in any case."""
    return F.lower(text).rlike("|".join(K.FOLLOW_UP_PHRASES))

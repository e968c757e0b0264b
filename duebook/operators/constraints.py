"""Declared table rules, reported as violation counts instead of being enforced."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duebook import constants as K

# --- fixed values: rules per table -------------------------------------------------
NOT_NULL = {
    "customers": ["customer_id", "customer_name"],
    "payment_terms": ["payment_term_id", "term_name", "due_days"],
    "invoices": [
        "invoice_id", "invoice_number", "customer_id", "payment_term_id", "invoice_date",
        "due_date", "invoice_amount",
    ],
    "invoice_lines": ["invoice_line_id", "invoice_id", "quantity", "unit_price", "line_amount"],
    "payments": ["payment_id", "invoice_id", "payment_date", "payment_amount"],
    "agent_conversations": ["conversation_id", "started_at", "conversation_status", "created_by"],
    "agent_activity_log": [
        "activity_id", "conversation_id", "activity_time", "activity_type", "execution_status",
    ],
    "agent_approval_requests": [
        "approval_id", "conversation_id", "requested_at", "requested_by", "action_type",
        "action_description", "approval_status",
    ],
    "agent_notification_outbox": [
        "notification_id", "approval_id", "conversation_id", "notification_type",
        "notification_status", "retry_count", "max_retry_count", "created_at",
    ],
    "agent_notification_recovery_log": [
        "recovery_id", "notification_id", "previous_status", "new_status", "recovered_by",
        "recovered_at",
    ],
    "agent_orchestration_runs": [
        "orchestration_id", "invoice_number", "orchestration_status", "started_at",
    ],
}
ALLOWED = {
    "customers": {"status": K.CUSTOMER_STATUSES, "risk_category": K.RISK_CATEGORIES},
    "invoices": {"invoice_status": K.INVOICE_STATUSES, "dispute_flag": K.DISPUTE_FLAGS},
    "agent_conversations": {"conversation_status": K.CONVERSATION_STATUSES},
    "agent_activity_log": {
        "activity_type": K.ACTIVITY_TYPES, "execution_status": K.EXECUTION_STATUSES,
    },
    "agent_approval_requests": {
        "approval_status": K.APPROVAL_STATUSES, "execution_status": K.EXECUTION_STATUSES,
    },
    "agent_notification_outbox": {"notification_status": K.NOTIFICATION_STATUSES},
    "agent_notification_recovery_log": {
        "previous_status": K.RECOVERABLE_STATUSES, "new_status": ["PENDING"],
    },
    "agent_orchestration_runs": {"orchestration_status": K.ORCHESTRATION_STATUSES},
}
MINIMUM = {  # column -> (smallest value, whether that value itself is allowed)
    "payment_terms": {"due_days": (0, False)},
    "invoice_lines": {"quantity": (0, False), "unit_price": (0, True), "line_amount": (0, True)},
    "payments": {"payment_amount": (0, False)},
}
LENGTH = {
    "customers": {"customer_name": 150, "email": 150},
    "invoices": {"invoice_number": 50},
    "invoice_lines": {"product_code": 50, "description": 200},
    "payments": {"payment_method": 30, "reference_number": 100},
    "agent_conversations": {"conversation_id": 36},
    "agent_activity_log": {"user_question": 4000, "error_message": 4000},
    "agent_approval_requests": {"action_description": 1000, "review_comments": 1000},
    "agent_notification_outbox": {"recipient_address": 320, "subject_text": 500},
    "agent_notification_recovery_log": {"recovery_reason": 1000},
    "agent_orchestration_runs": {"invoice_number": 100, "error_message": 4000},
}
AMOUNTS = {  # columns of at most 12 digits, two of them decimal
    "customers": ["credit_limit", "current_balance"],
    "invoices": ["invoice_amount", "amount_paid", "outstanding_amount"],
    "invoice_lines": ["unit_price", "line_amount"],
    "payments": ["payment_amount"],
}
AMOUNT_BOUND = 10**10
UNIQUE = {
    "customers": ["customer_id"],
    "payment_terms": ["payment_term_id", "term_name"],
    "invoices": ["invoice_id", "invoice_number"],
    "invoice_lines": ["invoice_line_id"],
    "payments": ["payment_id"],
    "agent_conversations": ["conversation_id"],
    "agent_activity_log": ["activity_id"],
    "agent_approval_requests": ["approval_id"],
    "agent_notification_outbox": ["notification_id", "approval_id"],
    "agent_notification_recovery_log": ["recovery_id"],
    "agent_orchestration_runs": ["orchestration_id"],
}
REFERENCES = {  # table -> {column: parent table}; the parent's column has the same name
    "invoices": {"customer_id": "customers", "payment_term_id": "payment_terms"},
    "invoice_lines": {"invoice_id": "invoices"},
    "payments": {"invoice_id": "invoices"},
    "agent_activity_log": {"conversation_id": "agent_conversations"},
    "agent_approval_requests": {"conversation_id": "agent_conversations"},
    "agent_notification_outbox": {
        "approval_id": "agent_approval_requests", "conversation_id": "agent_conversations",
    },
    "agent_notification_recovery_log": {"notification_id": "agent_notification_outbox"},
    "agent_orchestration_runs": {
        "approval_id": "agent_approval_requests", "notification_id": "agent_notification_outbox",
    },
}


def row_rules(table: str) -> dict[str, Column]:
    """Rules that one row can break alone; a NULL passes every check but NOT NULL."""
    rules = {f"{c} NOT NULL": F.col(c).isNull() for c in NOT_NULL.get(table, [])}
    for c, words in ALLOWED.get(table, {}).items():
        rules[f"{c} allowed values"] = ~F.col(c).isin(words)
    for c, (low, inclusive) in MINIMUM.get(table, {}).items():
        rules[f"{c} minimum"] = (F.col(c) < low) if inclusive else (F.col(c) <= low)
    for c in AMOUNTS.get(table, []):
        rules[f"{c} precision"] = F.abs(c) >= AMOUNT_BOUND
    for c, n in LENGTH.get(table, {}).items():
        rules[f"{c} length"] = F.length(c) > n
    return rules


def _spaces(tables) -> dict[tuple[str, str], list[tuple[str, str]]]:
    """Value spaces: the (table, column) that owns the values -> all key columns that take them, the owner first."""
    out = {(t, c): [(t, c)] for t in tables for c in UNIQUE.get(t, [])
           if REFERENCES.get(t, {}).get(c) not in tables}
    for t in tables:
        for c, parent in REFERENCES.get(t, {}).items():
            if parent in tables:
                out.setdefault((parent, c), [(parent, c)]).append((t, c))
    return out


def _entry(space: int, role: int, key: Column | None, is_long: bool, when: Column) -> Column:
    """A struct (space, role, long_key, text_key); null where there is nothing to note."""
    key = F.lit(None) if key is None else key
    noted = F.struct(
        F.lit(space).alias("space"), F.lit(role).alias("role"),
        (key if is_long else F.lit(None)).cast("bigint").alias("long_key"),
        (F.lit(None) if is_long else key).cast("string").alias("text_key"),
    )
    return F.when(when, noted)


def _entries(table: str, df: DataFrame, spaces, broken) -> DataFrame:
    """Broken row rules and key values of one table, all from one reading of it.

    A key value is noted once, however many rules it takes part in.
    """
    found = [_entry(broken[table, rule], 0, None, False, bad) for rule, bad in row_rules(table).items()]
    for number, users in enumerate(spaces.values()):
        for role, (t, c) in enumerate(users):
            if t == table:
                is_long = df.schema[c].dataType.typeName() in ("long", "integer")
                found.append(_entry(number, role, F.col(c), is_long, F.col(c).isNotNull()))
    return df.select(F.inline(F.filter(F.array(*found), lambda e: e.isNotNull())))


def orphan_count(df: DataFrame, column: str, parent: DataFrame, name: str) -> DataFrame:
    """Number of rows whose `column` is not in `parent`; rows are counted per value first."""
    sizes = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("_n"))
    return sizes.join(parent.select(column), column, "left_anti").agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias(name)
    )


def constraint_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """Violations per table and rule: every table is read once, and one shuffle counts all keys.

    A value goes to the shuffle once per key column that has it, counted beforehand; all rules
    about it are judged there from how often each column has it.  A unique rule counts the rows
    beyond the first of a value, a foreign key the rows whose value the parent lacks; it is
    checked where the parent table is supplied as well.
    """
    spaces = _spaces(tables)
    rows = [(t, rule) for t in tables for rule in row_rules(t)]
    broken = {r: -1 - i for i, r in enumerate(rows)}  # row rules are spaces without keys
    entries = reduce(DataFrame.unionByName, [_entries(t, df, spaces, broken) for t, df in tables.items()])
    roles = range(max(len(u) for u in spaces.values()))
    n = [F.col(f"_n{r}") for r in roles]
    counted = entries.groupBy("space", "long_key", "text_key").agg(
        *[F.count_if(F.col("role") == r).alias(f"_n{r}") for r in roles]
    )
    figures = [F.sum(n[0]).alias("rows")]
    for r in roles:
        figures.append(F.sum(F.greatest(n[r] - 1, F.lit(0))).alias(f"unique_{r}"))
        figures.append(F.sum(F.when(n[0] == 0, n[r]).otherwise(0)).alias(f"reference_{r}"))
    sums = counted.groupBy("space").agg(*figures).unpivot(
        "space", [f"{kind}_{r}" for r in roles for kind in ("unique", "reference")] + ["rows"], "measure", "_violations"
    )
    rules = [(broken[r], "rows", *r) for r in rows]
    for number, users in enumerate(spaces.values()):
        for role, (t, c) in enumerate(users):
            rules += [(number, f"unique_{role}", t, f"{c} UNIQUE")] * (c in UNIQUE.get(t, []))
            rules += [(number, f"reference_{role}", t, f"{c} REFERENCES")] * (role > 0)
    named = entries.sparkSession.createDataFrame(rules, "space int, measure string, table_name string, rule string")
    return named.join(sums, ["space", "measure"], "left").select(
        "table_name", "rule", F.coalesce("_violations", F.lit(0)).cast("bigint").alias("violations")
    )

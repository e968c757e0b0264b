"""Oracles for conversation audit and text operators."""

SQL = {}

SQL["activity_log"] = "SELECT * EXCLUDE (customer_id, invoice_number) FROM log"
SQL["activity_log_rejects"] = """
SELECT activity_id, conversation_id, CASE WHEN activity_id % 17 = 0 THEN 'NOTE' END AS activity_type,
  'UNKNOWN_ACTIVITY_TYPE' AS reason FROM act WHERE activity_id % 17 IN (0, 1)"""
SQL["conversation_sessions"] = "SELECT * FROM conv"
SQL["classify_message"] = "SELECT conv_id, turn, text, activity_type, argument FROM typed_msg"

PHRASES = """which one|which invoice|the oldest|the newest|the highest|the largest|the lowest|what action
what should we do|what should i do|tell me more|explain that|why is it|why is that|those invoices|that customer
that invoice|this customer|this invoice|summarize them|summarize it"""
SQL["is_follow_up"] = "SELECT conv_id, turn, " + " OR ".join(
    f"contains(line, '{p}')" for p in PHRASES.replace("\n", "|").split("|")
) + " AS is_follow_up FROM said"

SQL["recent_context"] = """
WITH kinds AS (SELECT m.conv_id, m.turn, m.role, m.text, t.activity_type AS kind
    FROM msg m LEFT JOIN typed_msg t ON t.conv_id = m.conv_id AND t.turn = m.turn),
remembered AS (SELECT k.* FROM kinds k WHERE (role = 'assistant' OR kind = 'USER_MESSAGE')
    AND k.turn > coalesce((SELECT max(c.turn) FROM kinds c WHERE c.conv_id = k.conv_id AND c.kind = 'MEMORY_CLEAR'), -1)),
lastk AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS age FROM remembered)
SELECT conv_id, count(*) AS message_count,
  string_agg(role || ': ' || text, chr(10) ORDER BY turn) AS context FROM lastk WHERE age <= 6 GROUP BY conv_id"""

SQL["session_memory"] = """
WITH spans AS (SELECT *, CAST(count(CASE WHEN activity_type = 'MEMORY_CLEAR' THEN 1 END) OVER (
    PARTITION BY conversation_id ORDER BY activity_time, activity_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS clears FROM log)
SELECT conversation_id, activity_id, activity_time, activity_type, clears,
  last_value(customer_id IGNORE NULLS) OVER w AS memory_customer_id,
  last_value(invoice_number IGNORE NULLS) OVER w AS memory_invoice_number,
  last_value(tool_name IGNORE NULLS) OVER w AS memory_tool_name
FROM spans WINDOW w AS (PARTITION BY conversation_id, clears ORDER BY activity_time, activity_id ROWS UNBOUNDED PRECEDING)"""

SQL["conversation_activity_summary"] = """
SELECT conversation_id, count(*) AS activity_count,
  count(CASE WHEN activity_type = 'USER_MESSAGE' THEN 1 END) AS user_messages,
  count(CASE WHEN activity_type = 'TOOL_CALL' THEN 1 END) AS tool_calls,
  count(CASE WHEN activity_type = 'AGENT_RESPONSE' THEN 1 END) AS agent_responses,
  count(CASE WHEN execution_status = 'FAILED' THEN 1 END) AS errors,
  CAST(coalesce(sum(records_returned), 0) AS BIGINT) AS records_returned,
  min(activity_time) AS first_activity, max(activity_time) AS last_activity
FROM log GROUP BY conversation_id"""

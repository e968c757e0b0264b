"""Oracles for the streaming operators and their batch forms."""

from oracles.receivables import INVOICE

SQL = {}
MARK = "(SELECT max(ts) - INTERVAL 1 HOUR FROM events)"

SQL["stream_payments_to_balances"] = f"SELECT {INVOICE} FROM inv"

SQL["stream_notification_metrics"] = """
SELECT date_trunc('day', created_at) AS window_start, date_trunc('day', created_at) + INTERVAL 1 DAY AS window_end,
  notification_status, count(*) AS notification_count FROM box GROUP BY 1, 2, 3"""
SQL["stream_notification_metrics_sliding"] = """
SELECT s AS window_start, s + INTERVAL 1 DAY AS window_end, notification_status, count(*) AS notification_count
FROM (SELECT notification_status, unnest([0, 6, 12, 18]) AS back,
    time_bucket(INTERVAL 6 HOUR, created_at, timestamp '2000-01-01') - to_hours(back) AS s FROM box)
GROUP BY 1, 2, 3"""

ATTEMPTS = """
att AS (SELECT event_id * 2 // 5 AS nid, event_id AS aid, ts AS moment, k % 4 = 0 AS ok FROM ev),
firsts AS (SELECT nid, min(CASE WHEN ok THEN (moment, aid) END) AS win FROM att GROUP BY nid),
fails AS (SELECT a.nid, a.moment, row_number() OVER (PARTITION BY a.nid ORDER BY a.moment, a.aid) AS n
  FROM att a JOIN firsts f ON f.nid = a.nid WHERE NOT a.ok AND (f.win IS NULL OR (a.moment, a.aid) < f.win)),
counted AS (SELECT f.nid, least(count(x.n), 3) AS c, max(CASE WHEN x.n <= 3 THEN x.moment END) AS last_fail,
    any_value(f.win) AS win FROM firsts f LEFT JOIN fails x ON x.nid = f.nid GROUP BY f.nid),
outcome AS (SELECT nid AS notification_id, CASE WHEN c = 3 THEN 'DEAD' WHEN win IS NOT NULL THEN 'SENT' ELSE 'RETRY' END
    AS notification_status, CAST(c AS INTEGER) AS retry_count,
    CASE WHEN c < 3 AND win IS NOT NULL THEN win[1] ELSE last_fail END AS changed_at,
    CASE WHEN c < 3 AND win IS NULL THEN last_fail + INTERVAL 1 MINUTE END AS next_retry_at FROM counted)"""
SQL["retry_outcomes"] = f"WITH {ATTEMPTS} SELECT * FROM outcome"
SQL["stream_retry_machine"] = f"""
WITH {ATTEMPTS}
SELECT * REPLACE (CASE WHEN next_retry_at <= {MARK} THEN 'RETRY_DUE' ELSE notification_status END AS notification_status)
FROM outcome"""

CHANGES = """
ch AS (SELECT user_id AS entity_id, ts AS moment, event_type = 'signup' AS busy,
    lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nxt FROM ev)"""
STUCK = "entity_id, moment AS stuck_since, moment + INTERVAL 30 MINUTE AS detected_at"
SQL["stuck_intervals"] = f"""
WITH {CHANGES} SELECT {STUCK} FROM ch WHERE busy AND coalesce(nxt, {MARK}) > moment + INTERVAL 30 MINUTE"""
SQL["stream_stuck_detector"] = f"""
WITH {CHANGES} SELECT {STUCK} FROM ch WHERE busy AND (nxt IS NULL OR nxt > moment + INTERVAL 30 MINUTE)
  AND time_bucket(INTERVAL 30 MINUTE, moment) + INTERVAL 60 MINUTE <= {MARK}"""

SESSIONS = """
marked AS (SELECT user_id, ts, event_id, CASE WHEN lag(ts) OVER w IS NULL OR ts > lag(ts) OVER w + INTERVAL 30 MINUTE
    THEN 1 ELSE 0 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
numbered AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS s FROM marked),
ses AS (SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end, count(*) AS event_count
  FROM numbered GROUP BY user_id, s)"""
SQL["sessions"] = f"WITH {SESSIONS} SELECT * FROM ses"
SQL["stream_sessions"] = f"WITH {SESSIONS} SELECT * FROM ses WHERE session_end <= {MARK}"
SQL["stream_dedup_requests"] = "SELECT DISTINCT event_id // 13 AS approval_id FROM events"

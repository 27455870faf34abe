"""ANSI SQL (DuckDB dialect) for each query of ``table_queries``, over the same tables."""

from __future__ import annotations

_USER = (
    "'User_' || CASE WHEN {n} < 10000 THEN lpad(CAST({n} AS VARCHAR), 4, '0') "
    "ELSE CAST({n} AS VARCHAR) END"
)

_TX = f"""
tx AS (
  SELECT 'TXN_' || event_id AS Transaction_ID,
         {_USER.format(n="user_id")} AS User_ID,
         value AS Amount,
         CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS Class,
         ts AS event_time,
         CASE WHEN value > 100 THEN 'Macro' WHEN value < 20 THEN 'Micro'
              ELSE 'Normal' END AS Category,
         event_type
  FROM events)"""

_BLACKLIST = f"""
listed AS (
  SELECT {_USER.format(n="c_custkey")} AS User_ID,
         CASE WHEN c_mktsegment <> 'BUILDING' THEN 'Arrears ' || c_mktsegment END AS Block_Reason,
         strftime(DATE '2024-01-01' + CAST(c_custkey % 365 AS INTEGER), '%Y-%m-%d') AS Block_Date
  FROM customer WHERE c_acctbal < 0
  UNION ALL
  SELECT {_USER.format(n="s_suppkey")}, 'Supplier arrears',
         strftime(DATE '2024-01-01' + CAST(s_nationkey % 365 AS INTEGER), '%Y-%m-%d')
  FROM supplier WHERE s_acctbal < 0),
blacklist AS (
  SELECT User_ID, Block_Reason, Block_Date FROM (
    SELECT *, row_number() OVER (
      PARTITION BY User_ID
      ORDER BY Block_Reason IS NULL, Block_Date, Block_Reason) AS choice
    FROM listed) WHERE choice = 1)"""

_ENRICHED = f"""
WITH {_TX}, {_BLACKLIST},
enriched AS (
  SELECT tx.User_ID, Transaction_ID, Amount, Class, event_time, Category,
         Block_Reason, Block_Date,
         CASE WHEN Block_Reason IS NOT NULL THEN 'BLOCKED' ELSE 'ACTIVE' END AS User_Status
  FROM tx LEFT JOIN blacklist ON tx.User_ID = blacklist.User_ID)"""

_IS_ALERT = "(User_Status = 'BLOCKED' OR Class = 1)"
_IS_NORMAL = "(User_Status = 'ACTIVE' AND Class = 0 AND User_ID <> 'User_0007')"
_ROUTE = f"CASE WHEN {_IS_ALERT} THEN 'alert' WHEN {_IS_NORMAL} THEN 'normal' ELSE 'unrouted' END"


def _windows(source: str, size_hours: int, slide_hours: int, columns: str) -> str:
    starts = ", ".join(str(k * slide_hours) for k in range(size_hours // slide_hours))
    return f"""
windowed AS (
  SELECT {columns},
         time_bucket(INTERVAL '{slide_hours} hours', event_time, TIMESTAMP '2024-01-01')
           - to_hours(back) AS window_start
  FROM {source}, UNNEST([{starts}]) AS shifts(back))"""


_BOT_SOURCE = _windows(
    "tx", 24, 12, "User_ID, Amount, Category, event_time, Transaction_ID, event_type"
)
_BOT = """
  SELECT window_start, window_start + INTERVAL '24 hours' AS window_end, User_ID,
         count(*) AS transaction_count, round(sum(Amount), 2) AS total_amount,
         'BOT_DETECTED' AS Alert_Status
  FROM windowed {where} GROUP BY window_start, User_ID HAVING count(*) > 4"""

_BOT_DETECTION = f"WITH {_TX}, {_BOT_SOURCE} {_BOT.format(where='')}"

_SUMMARY_SOURCE = _windows("enriched", 24, 8, "Amount, Category, User_Status, Class")
_SUMMARY = f"""{_ENRICHED}, {_SUMMARY_SOURCE}
  SELECT window_start, window_start + INTERVAL '24 hours' AS window_end,
         count(*) AS total_transactions,
         count(*) FILTER (WHERE Category = 'Macro') AS macro_count,
         count(*) FILTER (WHERE Category = 'Micro') AS micro_count,
         count(*) FILTER (WHERE Category = 'Normal') AS normal_count,
         count(*) FILTER (WHERE User_Status = 'BLOCKED') AS blocked_count,
         count(*) FILTER (WHERE Class = 1) AS fraud_count,
         round(avg(Amount), 2) AS avg_amount, round(sum(Amount), 2) AS total_amount
  FROM windowed GROUP BY window_start"""

_NORMAL = f"""{_ENRICHED}
  SELECT Transaction_ID, User_ID, Amount, Category, User_Status, event_time
  FROM enriched WHERE {_IS_NORMAL}"""

_ALERTS = f"""{_ENRICHED}
  SELECT Transaction_ID, User_ID, Amount, Category, User_Status, Block_Reason, Class, event_time,
         CASE WHEN User_Status = 'BLOCKED' THEN 'BLOCKED_USER' ELSE 'FRAUD_DETECTED' END
           AS Alert_Type
  FROM enriched WHERE {_IS_ALERT}"""

_JOINED = f"{_ENRICHED} SELECT * FROM enriched"

_ISO = "strftime({t}, '%Y-%m-%dT%H:%M:%S.%f')"

_DECODED = f"""
  WITH {_TX}
  SELECT Transaction_ID, User_ID, {_ISO.format(t="event_time")} AS Timestamp, Amount, Class,
         event_time
  FROM tx"""

_ROUTES = f"""{_ENRICHED}
  SELECT {_ROUTE} AS Route, count(*) AS transactions, round(sum(Amount), 2) AS total_amount
  FROM enriched GROUP BY 1"""

# Hash buckets: 32-bit words of the hex digest, as in the feed operators.
_WORD = "CAST('0x' || substr(md5(CAST(event_id AS VARCHAR)), {first}, 8) AS BIGINT)"
_DRAWN = f"""
labelled AS (
  SELECT event_id, ts, value AS Amount,
         CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS Class FROM events),
drawn AS (
  SELECT *, CASE WHEN Class = 1 THEN 'fraud'
                 WHEN {_WORD.format(first=1)} % 10000 < 200 THEN 'burst'
                 ELSE 'normal' END AS scenario FROM labelled),
assigned AS (
  SELECT *, CASE scenario WHEN 'fraud' THEN 'User_Hacker' WHEN 'burst' THEN 'User_Bot'
            ELSE 'User_' || lpad(CAST({_WORD.format(first=9)} % 1000 + 1 AS VARCHAR), 4, '0')
            END AS User_ID FROM drawn)"""

_FED = f"""{_DRAWN},
repeated AS (
  SELECT *, ts AS sent FROM (SELECT *, CAST(NULL AS INTEGER) AS Bot_Sequence
                             FROM assigned WHERE scenario <> 'burst')
  UNION ALL
  SELECT *, ts + to_milliseconds(10 * (Bot_Sequence - 1)) AS sent
  FROM (SELECT assigned.*, CAST(n AS INTEGER) AS Bot_Sequence
        FROM assigned, range(1, 6) AS numbers(n) WHERE scenario = 'burst')),
fed AS (
  SELECT 'TXN_' || (epoch_us(sent) // 1000) || '_' || event_id AS Transaction_ID, User_ID,
         {_ISO.format(t="sent")} AS Timestamp, Amount, Class, Bot_Sequence, scenario
  FROM repeated)"""

_MESSAGES = f"""WITH {_FED}
  SELECT User_ID AS message_key, Transaction_ID, User_ID, Timestamp, Amount, Class,
         Bot_Sequence IS NOT NULL AS in_burst FROM fed"""

_FIELDS = f"""WITH {_TX}, numbered AS (
    SELECT *, CAST(split_part(Transaction_ID, '_', 2) AS BIGINT) AS number FROM tx)
  SELECT Transaction_ID, User_ID, {_ISO.format(t="event_time")} AS Timestamp,
         CASE WHEN number % 5 <> 1 THEN CAST(number AS DOUBLE) END AS Time, Amount, Class,
         CASE WHEN number % 5 = 2 THEN 2 END AS Bot_Sequence,
         {", ".join(
             f"CASE WHEN number % 5 <> {k % 5} THEN CAST(number * {k} AS DOUBLE) / 4 END AS V{k}"
             for k in range(1, 29)
         )}
  FROM numbered"""

# The list as of an event: customers only up to the middle of the time span, then suppliers too.
_CHANGED = f"""
WITH {_TX}, {_BLACKLIST},
middle AS (SELECT make_timestamp((epoch_us(min(ts)) + epoch_us(max(ts))) // 2) AS cut FROM events),
versions AS (
  SELECT TRUE AS later, * FROM blacklist
  UNION ALL
  SELECT FALSE, User_ID, Block_Reason, Block_Date FROM (
    SELECT *, row_number() OVER (
      PARTITION BY User_ID
      ORDER BY Block_Reason IS NULL, Block_Date, Block_Reason) AS choice
    FROM listed WHERE Block_Reason IS DISTINCT FROM 'Supplier arrears') WHERE choice = 1),
enriched AS (
  SELECT tx.User_ID, Transaction_ID, Class, Block_Reason,
         CASE WHEN Block_Reason IS NOT NULL THEN 'BLOCKED' ELSE 'ACTIVE' END AS User_Status
  FROM tx CROSS JOIN middle
  LEFT JOIN versions ON tx.User_ID = versions.User_ID AND later = (event_time >= cut))
SELECT Transaction_ID, User_ID, User_Status, Block_Reason,
       CASE WHEN {_ROUTE} <> 'alert' THEN NULL WHEN User_Status = 'BLOCKED' THEN 'BLOCKED_USER'
            ELSE 'FRAUD_DETECTED' END AS Alert_Type,
       {_ROUTE} AS Route
FROM enriched WHERE {_ROUTE} <> 'unrouted'"""

ORACLES: dict[str, str] = {
    "categorize": f"WITH {_TX} SELECT Transaction_ID, Amount, Category FROM tx",
    "blacklist_scan": f"WITH {_BLACKLIST} SELECT * FROM blacklist",
    "blacklist_join": _JOINED,
    "blacklist_join_salted": _JOINED,
    "blacklist_join_filtered": _JOINED,
    "normal_transactions": _NORMAL,
    "fraud_alerts": _ALERTS,
    "unrouted": f"""{_ENRICHED}
      SELECT Transaction_ID, User_ID, Class, User_Status FROM enriched
      WHERE NOT {_IS_ALERT} AND NOT {_IS_NORMAL}""",
    "route_totals": _ROUTES,
    "bot_detection": _BOT_DETECTION,
    "bot_sample_category": f"""WITH {_TX}, {_BOT_SOURCE}
      SELECT window_start, window_start + INTERVAL '24 hours' AS window_end, User_ID,
             first(Category ORDER BY event_time, Category) AS sample_category
      FROM windowed GROUP BY window_start, User_ID HAVING count(*) > 4""",
    "summary_statistics": _SUMMARY,
    "json_decode": "SELECT CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events",
    "message_decode": _DECODED,
    "message_fields": _FIELDS,
    "event_time": f"""
      SELECT event_id,
             CASE event_type WHEN 'view' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
                  WHEN 'signup' THEN 'garbage ' || event_id WHEN 'purchase' THEN ''
                  ELSE {_ISO.format(t="ts")} END AS Timestamp,
             CASE WHEN event_type = 'view' THEN date_trunc('second', ts)
                  WHEN event_type IN ('signup', 'purchase') THEN NULL ELSE ts END AS event_time
      FROM events""",
    "csv_normalize": """
      SELECT event_id,
             CASE event_type WHEN 'view' THEN 0.0 ELSE CAST(event_id AS DOUBLE) END AS Time,
             CASE WHEN event_type = 'view' THEN 1000.0
                  WHEN event_type IN ('click', 'signup') THEN 0.0 ELSE value END AS V1,
             value AS Amount,
             CASE event_type WHEN 'error' THEN 1 WHEN 'click' THEN NULL ELSE 0 END AS Class,
             CASE event_type WHEN 'signup' THEN '' ELSE 'noted' END AS Remark,
             event_type = 'click' AS bad_label
      FROM events""",
    "csv_scan": """
      SELECT CAST(event_id AS DOUBLE) AS Time,
             CASE WHEN event_type IN ('purchase', 'error') THEN 0.0 ELSE value END AS V1,
             CASE WHEN event_type = 'click' THEN 0.0 ELSE value END AS Amount,
             CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS Class
      FROM events WHERE event_type <> 'signup'""",
    "csv_layouts": """
      SELECT CAST(event_id AS DOUBLE) AS Time,
             CASE WHEN event_type <> 'purchase' THEN CAST(event_id AS DOUBLE) END AS V1,
             CAST(CAST(round(value * 100) AS BIGINT) AS DOUBLE) AS Amount,
             CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS Class
      FROM events""",
    "csv_quarantine": """
      SELECT CASE event_type WHEN 'signup' THEN event_id || ',' || cents
                  WHEN 'view' THEN event_id || ',"' || cents || ',0'
                  ELSE event_id || ',' || cents || ',x1' END AS raw_line,
             CASE event_type WHEN 'signup' THEN 'too few fields' WHEN 'view' THEN 'unclosed quote'
                  ELSE 'unreadable label' END AS reason,
             (SELECT count(*) FROM events) AS n_lines,
             (SELECT count(*) FROM events
              WHERE event_type NOT IN ('signup', 'view', 'click')) AS n_kept
      FROM (SELECT *, CAST(round(value * 100) AS BIGINT) AS cents FROM events)
      WHERE event_type IN ('signup', 'view', 'click')""",
    "scenario_assign": f"WITH {_DRAWN} SELECT event_id, Class, scenario, User_ID FROM assigned",
    "burst_explode": f"""WITH {_FED}
      SELECT Transaction_ID, User_ID, Timestamp, Amount, Class, Bot_Sequence FROM fed""",
    "scenario_totals": f"""WITH {_FED}
      SELECT count(*) AS total_sent,
             count(*) FILTER (WHERE scenario = 'normal') AS normal_count,
             count(*) FILTER (WHERE scenario = 'fraud') AS fraud_count,
             count(*) FILTER (WHERE Bot_Sequence = 1) AS bot_attacks,
             count(*) FILTER (WHERE scenario = 'burst') AS bot_transactions
      FROM fed""",
    "envelope_json": _MESSAGES,
    "stream_decode": _DECODED,
    "stream_enrich": _JOINED,
    "stream_normal": _NORMAL,
    "stream_fraud": _ALERTS,
    "stream_routes": _ROUTES,
    "stream_feed": _MESSAGES,
    "stream_bots": _BOT_DETECTION,
    "stream_summary": _SUMMARY,
    "stream_bots_compacted": _BOT_DETECTION,
    "stream_blacklist_change": _CHANGED,
    "stream_restart": _SUMMARY,
    "stream_late_rows": f"""WITH {_TX}, {_BOT_SOURCE},
      closed AS (SELECT max(ts) - INTERVAL '24 hours' AS watermark
                 FROM events WHERE event_type <> 'signup')
      SELECT window_start, window_start + INTERVAL '24 hours' AS window_end, Transaction_ID,
             User_ID, event_time
      FROM windowed, closed
      WHERE event_type = 'signup' AND window_start + INTERVAL '24 hours' <= watermark""",
    "stream_summary_append": f"""SELECT * FROM ({_SUMMARY}) WHERE window_end <=
      (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL '1 hour' FROM events)""",
    "stream_state": f"""WITH {_TX}, {_BOT_SOURCE}
      SELECT window_start, window_start + INTERVAL '24 hours' AS window_end, User_ID,
             count(*) AS transaction_count, round(sum(Amount), 2) AS total_amount
      FROM windowed GROUP BY window_start, User_ID
      HAVING window_start + INTERVAL '24 hours' >
        (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL '1 hour' FROM events)""",
    "stream_deduplicated": _DECODED,
    "stream_late_drop": f"""WITH {_TX}, {_BOT_SOURCE},
      closed AS (SELECT max(ts) - INTERVAL '24 hours' AS watermark
                 FROM events WHERE event_type <> 'signup')
      {_BOT.format(where='''WHERE event_type <> 'signup'
        OR window_start + INTERVAL '24 hours' > (SELECT watermark FROM closed)''')}""",
}

"""The same queries in SQL, for comparison in another engine."""

from __future__ import annotations

# Transactions as the mapping of `tables.py` defines them.
TX = """
src AS (
  SELECT event_id, ts, user_id, event_type AS kind, value,
         CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k
  FROM events
),
ops AS (
  SELECT *, CASE WHEN k < 5 THEN 'd' WHEN k < 10 THEN 'u' WHEN k < 15 THEN 'r'
                 WHEN k < 20 THEN 'x' WHEN k < 25 THEN NULL ELSE 'c' END AS op
  FROM src
),
tx AS (
  SELECT event_id AS tx_id, TRY_CAST(user_id AS INTEGER) AS account_id,
         CASE WHEN op = 'd' THEN NULL ELSE value END AS amount,
         'VND' AS currency, upper(kind) AS tx_type, 'M' || k AS merchant,
         'D' || user_id AS device_id, CAST(NULL AS VARCHAR) AS ip_address,
         CASE WHEN k >= 95 THEN '' WHEN k <> 50 THEN 'LOC_' || (k // 20) END AS location,
         CASE WHEN kind = 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS status,
         CASE op WHEN 'c' THEN 'INSERT' WHEN 'u' THEN 'UPDATE' WHEN 'd' THEN 'DELETE'
                 WHEN 'r' THEN 'SNAPSHOT' ELSE 'UNKNOWN' END AS event_type,
         ts AS event_time, CAST(ts AS DATE) AS event_date,
         COALESCE(op = 'd', FALSE) AS is_deleted,
         'debezium' AS cdc_source, 'transactions' AS "table", event_id AS lsn,
         CASE WHEN kind <> 'error' AND COALESCE(op <> 'd', TRUE)
              THEN CAST(value AS DECIMAL(18,2)) ELSE 0 END AS spent
  FROM ops
)"""

DIMS = """
acc AS (
  SELECT CASE WHEN c_acctbal >= 0 THEN 1 ELSE -1 END * TRY_CAST(c_custkey AS INTEGER) AS account_id,
         c_nationkey AS customer_id,
         c_mktsegment AS account_type,
         CASE WHEN c_acctbal > 9900 THEN 'DELETED' WHEN c_acctbal < 1000 THEN 'FROZEN'
              ELSE 'ACTIVE' END AS status,
         c_acctbal > 9900 AS is_deleted,
         make_timestamp((1700000000 + c_custkey) * 1000000) AS updated_at
  FROM customer
),
cus AS (
  SELECT n_nationkey AS customer_id,
         CASE WHEN n_regionkey = 0 THEN 'HIGH' WHEN n_regionkey = 1 THEN 'MEDIUM'
              WHEN n_regionkey > 2 THEN 'LOW' END AS risk_level,
         make_timestamp((1690000000 + CAST(n_nationkey AS BIGINT)) * 1000000) AS updated_at
  FROM nation
)"""


def _trailing(count: str, spend: str) -> str:
    return f"""
bhv AS (
  SELECT *,
         CAST(count(*) OVER c AS BIGINT) AS tx_count_1m,
         CAST(sum(spent) OVER s AS DOUBLE) AS amount_sum_5m,
         CAST(sum(CASE WHEN status = 'FAILED' THEN 1 ELSE 0 END) OVER s AS BIGINT)
           AS failed_tx_5m,
         lag(location) OVER (PARTITION BY account_id ORDER BY event_time, tx_id)
           AS last_location
  FROM tx
  WINDOW c AS (PARTITION BY account_id ORDER BY event_time
               RANGE BETWEEN INTERVAL {count} PRECEDING AND CURRENT ROW),
         s AS (PARTITION BY account_id ORDER BY event_time
               RANGE BETWEEN INTERVAL {spend} PRECEDING AND CURRENT ROW)
)"""


MINUTES = _trailing("1 MINUTE", "5 MINUTE")
DAYS = _trailing("1 DAY", "5 DAY")

ENRICHED = """
enr AS (
  SELECT b.tx_id, b.account_id, b.amount, b.currency, b.tx_type, b.merchant, b.device_id,
         b.ip_address, b.location, b.status AS tx_status, b.event_type, b.event_time,
         b.event_date, b.is_deleted AS tx_is_deleted,
         a.customer_id, a.account_type, a.status AS account_status,
         a.is_deleted AS account_is_deleted, a.updated_at AS account_updated_at,
         COALESCE(c.risk_level, 'UNKNOWN') AS customer_risk,
         c.updated_at AS customer_updated_at,
         b.tx_count_1m, b.amount_sum_5m, b.failed_tx_5m, b.last_location
  FROM bhv b
  LEFT JOIN acc a ON a.account_id = b.account_id
  LEFT JOIN cus c ON c.customer_id = NULLIF(a.customer_id, 0)
)"""


def _money(column: str) -> str:
    return f"regexp_replace(CAST(CAST({column} AS DECIMAL(20,2)) AS VARCHAR), '0$', '')"


def _fired(amount: int, count: int, spend: int, failures: int) -> str:
    return f"""
fired AS (
  SELECT tx_id, account_id, 1 AS rule, 'HIGH_RISK_AMOUNT' AS code,
         '⚠️  High Risk Customer: ' || customer_risk || ' | Amount: ' || {_money("amount")}
           AS message
  FROM enr WHERE customer_risk = 'HIGH' AND COALESCE(amount, 0) > {amount}
  UNION ALL
  SELECT tx_id, account_id, 2, 'VELOCITY',
         '🚨 High Velocity detected: ' || tx_count_1m || ' tx/min'
  FROM enr WHERE COALESCE(tx_count_1m, 0) > {count}
  UNION ALL
  SELECT tx_id, account_id, 3, 'SPEND',
         '💰 Spending Threshold Exceeded: ' || {_money("amount_sum_5m")} || ' in 5 mins'
  FROM enr WHERE COALESCE(amount_sum_5m, 0) > {spend}
  UNION ALL
  SELECT tx_id, account_id, 4, 'IMPOSSIBLE_TRAVEL',
         '✈️  Impossible Travel: ' || last_location || ' -> ' || location
  FROM enr WHERE last_location <> '' AND location <> '' AND last_location <> location
  UNION ALL
  SELECT tx_id, account_id, 5, 'RECENT_FAILURES',
         '❌ Recent failed transactions in window: ' || failed_tx_5m
  FROM enr WHERE COALESCE(failed_tx_5m, 0) > {failures}
)"""


TEST_FIRED = _fired(100, 5, 500, 3)
DEFAULT_FIRED = _fired(10000, 5, 50000, 0)

VERDICTS = """
SELECT e.tx_id, e.account_id,
       CASE WHEN f.codes IS NULL THEN 'SAFE' ELSE 'ALERT' END AS verdict,
       COALESCE(f.codes, '') AS codes
FROM enr e
LEFT JOIN (SELECT tx_id, string_agg(code, ',' ORDER BY rule) AS codes
           FROM fired GROUP BY tx_id) f ON f.tx_id = e.tx_id"""

CHANGES = """
changes AS (
  SELECT *, CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL
                 WHEN o_orderstatus = 'P' THEN 'd' WHEN o_orderstatus = 'F' THEN 'c'
                 ELSE 'u' END AS op,
         NULLIF(split_part(o_orderpriority, '-', 2), 'NOT SPECIFIED') AS level
  FROM orders
),
account_changes AS (
  SELECT TRY_CAST(o_custkey AS INTEGER) AS account_id, TRY_CAST(o_orderkey AS INTEGER) AS customer_id,
         o_orderstatus AS account_type,
         CASE WHEN op = 'd' THEN 'DELETED' ELSE level END AS status,
         op = 'd' AS is_deleted, o_orderdate AS updated_at,
         CAST(epoch_ms(o_orderdate) AS BIGINT) AS ts_ms, o_orderkey AS lsn
  FROM changes
)"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n"


_LATEST = "QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY updated_at DESC, {seq} DESC) = 1"

CLEAN_COLUMNS = """tx_id, account_id, amount, currency, tx_type, merchant, device_id, ip_address,
       location, status, event_type, event_time, event_date, is_deleted, cdc_source, "table", lsn"""

_SLIDING = """
SELECT account_id, window_start, window_start + INTERVAL 5 MINUTE AS window_end,
       CAST(sum(spent) AS DOUBLE) AS sum_5m,
       CAST(count(*) FILTER (status = 'FAILED') AS BIGINT) AS fail_5m
FROM (SELECT *, date_trunc('minute', event_time) - to_minutes(i) AS window_start
      FROM tx CROSS JOIN generate_series(0, 4) g(i))
GROUP BY account_id, window_start"""


def _latest_behavior(step: str, back: str) -> str:
    return _with(TX) + f"""
SELECT account_id, latest AS updated_at,
       CAST(count(*) FILTER (pane = latest) AS BIGINT) AS tx_count_1m,
       CAST(sum(spent) AS DOUBLE) AS amount_sum_5m,
       CAST(count(*) FILTER (status = 'FAILED') AS BIGINT) AS failed_tx_5m
FROM (SELECT *, date_trunc('{step}', event_time) AS pane,
             max(date_trunc('{step}', event_time)) OVER (PARTITION BY account_id) AS latest
      FROM tx)
WHERE pane >= latest - INTERVAL {back}
GROUP BY account_id, latest"""


_PREVIOUS = """
SELECT e.tx_id, {shown}
FROM bhv e
ASOF LEFT JOIN bhv b ON e.account_id = b.account_id AND e.event_time > b.event_time"""

_FRESH = "e.event_time - b.event_time < INTERVAL 600 SECOND"

BATCH: dict[str, str] = {
    "cdc_decode_clean": _with(TX) + f"SELECT {CLEAN_COLUMNS} FROM tx",
    "cdc_decode_second_precision": _with(TX) + """
SELECT tx_id, event_type, CAST(date_trunc('second', event_time) AS TIMESTAMP) AS event_time,
       event_date FROM tx""",
    "cdc_bad_records": _with(TX) + """
SELECT CASE k WHEN 25 THEN 'UNDECODABLE' WHEN 26 THEN 'NULL_VALUE' WHEN 27 THEN 'NO_TX_ID'
              WHEN 28 THEN 'NO_AMOUNT' WHEN 29 THEN 'NO_ACCOUNT' ELSE 'VALID' END AS reason,
       count(*) AS n
FROM src GROUP BY 1""",
    "clean_key_value": _with(TX) + f"SELECT CAST(tx_id AS VARCHAR) AS key, {CLEAN_COLUMNS} FROM tx",
    "lake_partition_counts": _with(TX)
    + "SELECT event_date, count(*) AS n FROM tx GROUP BY event_date",
    "account_state_changes": _with(CHANGES) + "SELECT * FROM account_changes",
    "account_state_latest": _with(CHANGES)
    + "SELECT account_id, customer_id, account_type, status, is_deleted, updated_at "
      "FROM account_changes " + _LATEST.format(key="account_id", seq="lsn"),
    "customer_state_latest": _with(CHANGES) + """
SELECT TRY_CAST(o_custkey AS INTEGER) AS customer_id, level AS risk_level, op = 'd' AS is_deleted,
       o_orderdate AS updated_at
FROM changes """ + _LATEST.format(key="o_custkey", seq="o_orderkey"),
    "velocity_tumbling_1m": _with(TX) + """
SELECT account_id, date_trunc('minute', event_time) AS window_start,
       date_trunc('minute', event_time) + INTERVAL 1 MINUTE AS window_end, count(*) AS cnt_1m
FROM tx GROUP BY ALL""",
    "velocity_tumbling_inserts": _with(TX) + """
SELECT account_id, date_trunc('minute', event_time) AS window_start,
       date_trunc('minute', event_time) + INTERVAL 1 MINUTE AS window_end, count(*) AS cnt_1m
FROM tx WHERE event_type = 'INSERT' GROUP BY ALL""",
    "spend_fail_sliding_5m": _with(TX) + _SLIDING,
    "behavior_latest": _latest_behavior("minute", "4 MINUTE"),
    "behavior_latest_days": _latest_behavior("day", "4 DAY"),
    "behavior_trailing": _with(TX, MINUTES)
    + "SELECT tx_id, tx_count_1m, amount_sum_5m, failed_tx_5m FROM bhv",
    "behavior_trailing_days": _with(TX, DAYS)
    + "SELECT tx_id, tx_count_1m, amount_sum_5m, failed_tx_5m FROM bhv",
    "behavior_trailing_dense": _with(TX, DAYS)
    + "SELECT tx_id, last_location, tx_count_1m, amount_sum_5m, failed_tx_5m FROM bhv",
    "behavior_asof_ttl": _with(TX, MINUTES) + _PREVIOUS.format(shown=f"""
       COALESCE({_FRESH}, FALSE) AS previous_found,
       CASE WHEN {_FRESH} THEN b.tx_count_1m ELSE 0 END AS previous_tx_count_1m,
       CASE WHEN {_FRESH} THEN b.amount_sum_5m ELSE 0 END AS previous_amount_sum_5m,
       CASE WHEN {_FRESH} THEN b.failed_tx_5m ELSE 0 END AS previous_failed_tx_5m"""),
    "behavior_asof_join": _with(TX, MINUTES) + _PREVIOUS.format(shown=f"""
       CASE WHEN {_FRESH} THEN b.tx_count_1m END AS previous_tx_count_1m,
       CASE WHEN {_FRESH} THEN b.amount_sum_5m END AS previous_amount_sum_5m,
       CASE WHEN {_FRESH} THEN b.failed_tx_5m END AS previous_failed_tx_5m"""),
    "last_location": _with(TX, MINUTES)
    + "SELECT tx_id, account_id, location, last_location FROM bhv",
    "dim_enrich": _with(TX, DIMS) + """
SELECT t.tx_id, t.account_id, a.customer_id, a.account_type, a.status AS account_status,
       a.is_deleted AS account_is_deleted, a.updated_at AS account_updated_at,
       COALESCE(c.risk_level, 'UNKNOWN') AS customer_risk, c.updated_at AS customer_updated_at
FROM tx t
LEFT JOIN acc a ON a.account_id = t.account_id
LEFT JOIN cus c ON c.customer_id = NULLIF(a.customer_id, 0)""",
    "dim_asof": """
WITH versions AS (
  SELECT o_custkey, o_orderdate, max(o_orderkey) AS o_orderkey,
         arg_max(o_orderpriority, o_orderkey) AS o_orderpriority
  FROM orders GROUP BY o_custkey, o_orderdate
),
lines AS (
  SELECT l_orderkey, l_linenumber, l_partkey, o_custkey, l_shipdate
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey
)
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.o_custkey, l.l_shipdate,
       v.o_orderkey AS version_orderkey, v.o_orderdate AS version_date,
       v.o_orderpriority AS version_priority
FROM lines l
ASOF LEFT JOIN versions v ON l.o_custkey = v.o_custkey AND l.l_shipdate >= v.o_orderdate""",
    "dim_enrich_asof": _with(TX) + """
, acc AS (
  SELECT TRY_CAST(user_id AS INTEGER) AS account_id, k AS customer_id, 'CARD' AS account_type,
         CASE WHEN value > 50 THEN 'FROZEN' ELSE 'ACTIVE' END AS status, ts AS updated_at
  FROM src WHERE kind = 'signup'
),
cus AS (
  SELECT k AS customer_id, ts AS updated_at,
         CASE WHEN value > 50 THEN 'HIGH' WHEN value > 10 THEN 'LOW' END AS risk_level
  FROM src WHERE kind = 'view'
)
SELECT t.tx_id, t.account_id, a.customer_id, a.account_type, a.status AS account_status,
       CASE WHEN a.account_id IS NOT NULL THEN FALSE END AS account_is_deleted,
       a.updated_at AS account_updated_at,
       COALESCE(c.risk_level, 'UNKNOWN') AS customer_risk, c.updated_at AS customer_updated_at
FROM tx t
ASOF LEFT JOIN acc a ON a.account_id = t.account_id AND t.event_time >= a.updated_at
ASOF LEFT JOIN cus c ON c.customer_id = NULLIF(a.customer_id, 0)
                    AND t.event_time >= c.updated_at""",
    "enriched_full": _with(TX, DIMS, MINUTES, ENRICHED) + "SELECT * FROM enr",
    "wire_format_text": _with(TX, DIMS, MINUTES, ENRICHED) + """
SELECT tx_id,
       strftime(event_time, '%Y-%m-%dT%H:%M:%S')
         || CASE WHEN epoch_us(event_time) % 1000000 = 0 THEN '' ELSE strftime(event_time, '.%f') END AS event_time,
       CAST(event_date AS VARCHAR) AS event_date,
       strftime(account_updated_at, '%Y-%m-%dT%H:%M:%S.000Z') AS account_updated_at,
       strftime(customer_updated_at, '%Y-%m-%dT%H:%M:%S.000Z') AS customer_updated_at
FROM enr""",
    "redelivered_once": _with(TX) + f"SELECT {CLEAN_COLUMNS} FROM tx",
    "risk_verdicts": _with(TX, DIMS, DAYS, ENRICHED, TEST_FIRED) + VERDICTS,
    "risk_verdicts_default": _with(TX, DIMS, MINUTES, ENRICHED, DEFAULT_FIRED) + VERDICTS,
    "risk_alert_rows": _with(TX, DIMS, DAYS, ENRICHED, TEST_FIRED) + """
SELECT tx_id, account_id,
       CAST(row_number() OVER (PARTITION BY tx_id ORDER BY rule) AS INTEGER) AS position,
       code, message
FROM fired""",
}

def _slice(n: int) -> str:
    """Which of `n` stretches of time a row of `events` is delivered with."""
    edges = " ".join(
        f"WHEN epoch_us(ts) >= low + (high - low) * {i} // {n} THEN {i}" for i in range(n - 1, 0, -1))
    return f"CASE {edges} ELSE 0 END"


_RANGE = """
span AS (SELECT min(epoch_us(ts)) AS low, max(epoch_us(ts)) AS high FROM events)"""

_FRESH_ROWS = _latest_behavior("minute", "4 MINUTE")

_LATE = _with(TX, _RANGE) + f"""
, sent AS (
  SELECT e.event_id, e.ts, CASE WHEN k BETWEEN 40 AND 44 THEN 2 ELSE {_slice(3)} END AS run
  FROM src e CROSS JOIN span
),
marks AS (
  SELECT r.run, date_trunc('millisecond', max(s.ts)) - INTERVAL 600 SECOND AS watermark
  FROM (SELECT DISTINCT run FROM sent) r JOIN sent s ON s.run < r.run GROUP BY r.run
)
SELECT t.tx_id, t.account_id, t.event_time, m.watermark, 'LATE' AS reason
FROM tx t JOIN sent s ON s.event_id = t.tx_id JOIN marks m ON m.run = s.run
WHERE date_trunc('minute', t.event_time) + INTERVAL 1 MINUTE <= m.watermark"""

# What each row knows are the rows that were delivered with it or before.
_OUTLIERS = _with(TX, _RANGE) + f"""
, moved AS (
  SELECT t.tx_id, t.account_id, t.location, t.status, {_slice(4)} AS run,
         CASE s.k WHEN 30 THEN s.ts + INTERVAL 400 DAY WHEN 31 THEN s.ts + INTERVAL 14600 DAY
                  WHEN 32 THEN s.ts - INTERVAL 7300 DAY WHEN 33 THEN NULL ELSE s.ts END AS event_time,
         CASE WHEN s.k IN (34, 35) THEN 0 ELSE t.spent END AS spent
  FROM tx t JOIN src s ON s.event_id = t.tx_id CROSS JOIN span
)
SELECT e.tx_id, e.account_id, e.event_time, e.location,
       count(p.tx_id) FILTER (p.event_time >= e.event_time - INTERVAL 1 MINUTE) AS tx_count_1m,
       CAST(COALESCE(sum(p.spent) FILTER (p.event_time >= e.event_time - INTERVAL 5 MINUTE), 0) AS DOUBLE)
         AS amount_sum_5m,
       count(p.tx_id) FILTER (p.event_time >= e.event_time - INTERVAL 5 MINUTE AND p.status = 'FAILED')
         AS failed_tx_5m,
       first(p.location ORDER BY p.event_time DESC, p.tx_id DESC)
         FILTER (p.event_time < e.event_time OR p.tx_id < e.tx_id) AS last_location
FROM moved e
LEFT JOIN moved p ON p.account_id = e.account_id AND p.run <= e.run AND p.event_time <= e.event_time
GROUP BY e.tx_id, e.account_id, e.event_time, e.location"""

BATCH["dim_asof_dense"] = BATCH["dim_asof"]

STREAMS: dict[str, str] = {
    "stream_clean_lake": BATCH["cdc_decode_clean"],
    "stream_dead_letters": f"SELECT * FROM ({BATCH['cdc_bad_records']}) WHERE reason <> 'VALID'",
    "stream_account_state": BATCH["account_state_latest"],
    "stream_customer_state": BATCH["customer_state_latest"],
    "stream_velocity_1m": BATCH["velocity_tumbling_1m"],
    "stream_spend_fail_5m": BATCH["spend_fail_sliding_5m"],
    "stream_clean_counts": BATCH["cdc_bad_records"],
    "clean_topic_dead_letters": _with(TX) + """
SELECT CASE k WHEN 25 THEN 'UNDECODABLE' WHEN 26 THEN 'NULL_VALUE' WHEN 27 THEN 'NO_TX_ID'
              WHEN 28 THEN 'BAD_AMOUNT' WHEN 29 THEN 'UNDECODABLE' ELSE 'USED' END AS reason,
       count(*) AS n
FROM src GROUP BY 1""",
    "dimension_dead_letters": """
SELECT CASE o_orderkey % 10 WHEN 1 THEN 'NO_KEY' WHEN 2 THEN 'UNDECODABLE' ELSE 'NULL_VALUE' END AS reason,
       count(*) AS n
FROM orders WHERE o_orderkey % 10 IN (1, 2, 3) GROUP BY 1""",
    "stream_behavior_latest": BATCH["behavior_latest"],
    "stream_behavior_fresh": f"""
SELECT *, updated_at + INTERVAL 600 SECOND AS expires_at FROM ({_FRESH_ROWS})
WHERE updated_at + INTERVAL 600 SECOND > (SELECT max(ts) FROM events)""",
    "stream_late_rows": _LATE,
    "stream_enriched_outliers": _OUTLIERS,
    "stream_enriched": BATCH["enriched_full"],
    "stream_verdicts": BATCH["risk_verdicts"],
    "stream_judged_topic": BATCH["risk_verdicts"],
}

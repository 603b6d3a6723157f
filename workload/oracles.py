"""What each query must return, as plain SQL over the same tables."""

from __future__ import annotations

# fixed values: domains of the transaction fields
TXN = """
t AS (
  SELECT event_id AS n, user_id, ts,
         CAST(event_id AS VARCHAR) AS transaction_id,
         'AC' || CAST(user_id + 100000 AS VARCHAR) AS account_id,
         CASE WHEN event_id % 3 = 0 THEN 'CREDIT' ELSE 'DEBIT' END AS transaction_type,
         CASE WHEN event_id % 5 = 0 THEN 'FAILED' ELSE 'SUCCESS' END AS transaction_status,
         CAST(floor(value * 7300) AS BIGINT) AS cents,
         CAST(floor(value * 7300) AS DOUBLE) / 100 AS amount,
         ['UPI', 'ATM', 'CARD', 'NEFT', 'RTGS', 'IMPS'][CAST(event_id % 6 AS INT) + 1] AS channel,
         ['GROCERY', 'RESTAURANT', 'FUEL', 'TRAVEL', 'ECOMMERCE', 'ENTERTAINMENT',
          'UTILITIES'][CAST(event_id % 7 AS INT) + 1] AS merchant_category,
         'M' || json_extract_string(props, '$.k') AS merchant_name,
         lpad(CAST(event_id AS VARCHAR), 12, '0') AS reference_number
  FROM events
)"""

BALANCE = """
b AS (
  SELECT *, CAST(500000 + user_id * 791900 % 9500100
      + sum(CASE WHEN transaction_status <> 'SUCCESS' THEN 0
                 WHEN transaction_type = 'DEBIT' THEN -cents ELSE cents END)
        OVER (PARTITION BY user_id ORDER BY ts, n) AS DOUBLE) / 100 AS balance
  FROM t
)"""

MASTER = """
m AS (
  SELECT 'AC' || CAST(c_custkey + 100000 AS VARCHAR) AS account_id, c_name AS user_name,
         CAST(c_custkey AS VARCHAR) || '@example.com' AS user_email
  FROM customer WHERE c_custkey % 5 <> 4
)"""

THIRD_STATUS = """
s AS (
  SELECT * REPLACE (CASE WHEN n % 8 = 0 THEN 'PENDING'
                         WHEN n % 9 = 0 THEN lower(transaction_status)
                         ELSE transaction_status END AS transaction_status)
  FROM b
)"""

# Fields made faulty; ``amount`` and ``ts`` as they are after the cast.
MESSY = """
f AS (
  SELECT n, ts AS sound_ts, channel AS sound_channel,
         CASE WHEN n % 29 <> 0 THEN transaction_id END AS transaction_id,
         CASE WHEN n % 31 <> 0 THEN account_id END AS account_id,
         CASE WHEN n % 11 <> 0 AND n % 13 <> 0 AND n % 17 <> 0 THEN amount END AS amount,
         n % 11 <> 0 AND n % 13 = 0 AS is_nan,
         CASE WHEN n % 7 <> 0 THEN channel END AS channel,
         CASE WHEN n % 41 <> 0 THEN transaction_type END AS transaction_type,
         CASE WHEN n % 19 = 0 THEN NULL WHEN n % 37 = 0 THEN lower(transaction_status)
              ELSE transaction_status END AS transaction_status,
         CASE WHEN n % 23 <> 0 THEN ts END AS ts
  FROM t
)"""

TIME = "strftime(ts, '%Y-%m-%d %H:%M:%S.%f')"

SHOWN = f"""
  transaction_id, account_id, amount, channel, {TIME} AS transaction_timestamp,
  n AS _kafka_offset, CAST(ts AS DATE) AS transaction_date,
  CAST(hour(ts) AS INT) AS transaction_hour,
  CAST(dayofweek(ts) + 1 AS INT) AS transaction_day_of_week,
  is_nan OR coalesce(amount > 8000, false) AS is_high_value,
  coalesce(transaction_status = 'FAILED', false) AS is_failed,
  coalesce(transaction_type = 'DEBIT', false) AS is_debit,
  CASE WHEN amount < 500 THEN 'LOW' WHEN amount < 3000 THEN 'MEDIUM'
       WHEN amount < 8000 THEN 'HIGH' ELSE 'VERY_HIGH' END AS amount_bucket
"""

VALID = """transaction_id IS NOT NULL AND account_id IS NOT NULL AND amount IS NOT NULL
  AND transaction_status IS NOT NULL AND ts IS NOT NULL"""

BUCKET = """CASE WHEN amount < 500 THEN 'LOW' WHEN amount < 3000 THEN 'MEDIUM'
       WHEN amount < 8000 THEN 'HIGH' ELSE 'VERY_HIGH' END"""

SUMMARY = f"""
  SELECT CAST(ts AS DATE) AS transaction_date, channel, merchant_category, transaction_status,
         {BUCKET} AS amount_bucket, count(*) AS total_transactions,
         CAST(sum(cents) AS DOUBLE) / 100 AS total_amount,
         CAST((2 * sum(cents) + count(*)) // (2 * count(*)) AS DOUBLE) / 100 AS avg_amount,
         round(max(amount), 2) AS max_amount, round(min(amount), 2) AS min_amount,
         count(*) FILTER (amount > 8000) AS high_value_count,
         count(*) FILTER (transaction_status = 'FAILED') AS failed_count,
         count(*) FILTER (transaction_type = 'DEBIT') AS debit_count,
         count(DISTINCT account_id) AS unique_accounts,
         count(DISTINCT merchant_name) AS unique_merchants
  FROM t GROUP BY ALL"""

ACCOUNT_SUMMARY = f"""
WITH {TXN}, {BALANCE}
SELECT CAST(ts AS DATE) AS transaction_date, account_id, count(*) AS total_transactions,
       CAST(sum(cents) AS DOUBLE) / 100 AS total_amount,
       count(*) FILTER (transaction_status = 'FAILED') AS failed_count,
       count(*) FILTER (amount > 8000) AS high_value_count,
       count(*) FILTER (transaction_type = 'DEBIT') AS debit_count,
       count(*) FILTER (transaction_status = 'FAILED') AS total_failed_amount,
       CAST(coalesce(sum(cents) FILTER (transaction_status = 'FAILED'), 0) AS DOUBLE) / 100
         AS failed_amount,
       min(balance) AS min_balance, max(balance) AS max_balance,
       arg_max(balance, row(ts, n)) AS latest_balance
FROM b GROUP BY CAST(ts AS DATE), account_id"""

CURRENT_BALANCE = f"""
WITH {TXN}, {BALANCE}
SELECT account_id, arg_max(balance, row(ts, n)) AS balance FROM b GROUP BY account_id"""

ALERTS = """
a AS (
  SELECT e.*, m.user_name, m.user_email, k.alert_type
  FROM {events} e JOIN m ON m.account_id = e.account_id
  JOIN (VALUES ('HIGH_VALUE'), ('FAILED_TXN'), ('LOW_BALANCE')) k(alert_type)
    ON (k.alert_type = 'HIGH_VALUE' AND e.amount > 9000)
    OR (k.alert_type = 'FAILED_TXN' AND upper(e.transaction_status) = 'FAILED')
    OR (k.alert_type = 'LOW_BALANCE' AND e.transaction_type = 'DEBIT'
        AND upper(e.transaction_status) = 'SUCCESS' AND e.balance < 100)
)"""

ALERT_EVENTS = f"""
WITH {TXN}, {BALANCE}, {MASTER}, {ALERTS.format(events="b")}
SELECT transaction_id, account_id, user_name, user_email, alert_type, amount,
       balance AS balance_after_transaction, transaction_status
FROM a"""

UNMATCHED = f"""
WITH {TXN}, {MASTER}
SELECT transaction_id, account_id, amount, transaction_status AS status
FROM t WHERE account_id NOT IN (SELECT account_id FROM m)"""

# fixed values: message wording; every line after the first is indented
RULER = "━" * 31
DETAILS = """  Account ID          : ' || account_id || '
  Transaction ID      : ' || transaction_id || '
  Reference Number    : ' || reference_number || '
  Type                : ' || transaction_type || '
  Amount              : ' || amount_text || '
  Channel             : ' || channel || '
  Merchant            : ' || merchant_name || '
  Category            : ' || merchant_category || '
"""
BALANCE_AND_TIME = """  Balance After Txn   : ' || balance_text || '
  Timestamp           : ' || time_text || ' UTC
"""
HIGH_VALUE_BODY = f"""Dear ' || user_name || ',

A high-value transaction has been detected on your Example Bank account.

{RULER}
  TRANSACTION DETAILS
{RULER}
{DETAILS}  Status              : ' || transaction_status || '
{BALANCE_AND_TIME}{RULER}

If you did not authorize this transaction, please contact Example Bank \

support immediately at support@example.com or call 1800-XXX-XXXX.

Regards,
Example Bank Fraud & Alerts Team"""
FAILED_BODY = f"""Dear ' || user_name || ',

Your recent transaction has FAILED. Here are the details:

{RULER}
  FAILED TRANSACTION DETAILS
{RULER}
{DETAILS}  Status              : ❌ FAILED
{BALANCE_AND_TIME}{RULER}

Your account balance remains unchanged for this transaction.
If you continue to face issues, please retry or contact support.

Regards,
Example Bank Transaction Support Team"""
LOW_BALANCE_BODY = f"""Dear ' || user_name || ',

Your Example Bank account balance has dropped below ₹100.00.

{RULER}
  BALANCE ALERT
{RULER}
  Account ID          : ' || account_id || '
  Current Balance     : ' || balance_text || '
  Last Transaction    : ' || amount_text || ' (' || transaction_type || ' via ' || channel || ')
  Merchant            : ' || merchant_name || '
  Timestamp           : ' || time_text || ' UTC
{RULER}

Please add funds to avoid transaction failures.

Regards,
Example Bank Account Services Team"""


def indented(body: str, blanks: int) -> str:
    return "'" + body.replace("\n", "\n" + " " * blanks) + "'"


MESSAGE_TEXTS = f"""
x AS (
  SELECT *, '₹' || format('{{:,.2f}}', amount) AS amount_text,
         '₹' || format('{{:,.2f}}', balance) AS balance_text,
         CASE WHEN microsecond(ts) % 1000000 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
              ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END AS time_text
  FROM a
),
y AS (
SELECT *,
       CASE alert_type
         WHEN 'HIGH_VALUE' THEN
           '🚨 Example Bank Alert: Large Transaction of ' || amount_text || ' on your account'
         WHEN 'FAILED_TXN' THEN '⚠️ Example Bank Alert: Transaction of ' || amount_text || ' FAILED'
         ELSE '⚠️ Example Bank Alert: Low Balance Warning — ' || balance_text || ' remaining'
       END AS subject,
       CASE alert_type
         WHEN 'HIGH_VALUE' THEN {indented(HIGH_VALUE_BODY, 16)}
         WHEN 'FAILED_TXN' THEN {indented(FAILED_BODY, 8)}
         ELSE {indented(LOW_BALANCE_BODY, 16)}
       END AS body
FROM x)"""

ALERT_MESSAGES = f"""
WITH {TXN}, {BALANCE}, {THIRD_STATUS}, {MASTER}, {ALERTS.format(events="s")}, {MESSAGE_TEXTS}
SELECT transaction_id, alert_type, subject, body FROM y"""

STREAM_ALERTS = f"""
WITH {TXN}, {BALANCE}, {MASTER}, {ALERTS.format(events="b")}, {MESSAGE_TEXTS}
SELECT transaction_id, account_id, user_name, user_email, alert_type, amount,
       balance AS balance_after_transaction, transaction_status, subject, body
FROM y"""

MALFORMED = """CASE WHEN {n} % 17 = 0 THEN {t} || {t} WHEN {n} % 19 = 0 THEN {t} || ' x'
     WHEN {n} % 23 = 0 THEN '[' || {t} || ']' WHEN {n} % 29 = 0 THEN {t} || '],[' || {t}
     WHEN {n} % 31 = 0 THEN {t} || ',' || {t} END"""
IS_MALFORMED = "(n % 17 = 0 OR n % 19 = 0 OR n % 23 = 0 OR n % 29 = 0 OR n % 31 = 0)"
SHORT = """'{"transaction_id":"' || CAST(n AS VARCHAR) || '"}'"""

ORACLES: dict[str, str] = {
    "txn_processed": f"WITH {TXN}, {MESSY} SELECT {SHOWN} FROM f WHERE {VALID}",
    "txn_typed": f"WITH {TXN}, {MESSY} SELECT {SHOWN} FROM f",
    "txn_valid_only": f"""
WITH {TXN}
SELECT transaction_id, amount, CASE WHEN n % 7 <> 0 THEN channel END AS channel
FROM t WHERE n % 11 <> 0 AND n % 13 <> 0""",
    "dedupe_lineitem": """
SELECT * FROM (SELECT * REPLACE (CAST(l_shipdate AS DATE) AS l_shipdate) FROM lineitem)
QUALIFY row_number() OVER (
  PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
           l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) = 1""",
    "txn_dedupe": f"""
WITH {TXN}
SELECT transaction_id, account_id, amount, 0 AS _kafka_partition, n AS _kafka_offset FROM t""",
    "txn_new_only": f"WITH {TXN} SELECT transaction_id, amount FROM t WHERE n % 3 = 0",
    "json_roundtrip": f"""
WITH {TXN}
SELECT account_id AS key, transaction_id, account_id, transaction_type, amount,
       {TIME} AS transaction_timestamp, merchant_name, transaction_status,
       '{{"risk":' || CAST(n % 10 AS VARCHAR) || '}}' AS _extra
FROM t""",
    "json_quarantine": f"""
WITH e AS (SELECT event_id AS n FROM events),
q AS (
  SELECT n AS message,
         CASE WHEN n % 7 = 0 THEN '{{bad ' || CAST(n AS VARCHAR)
              WHEN n % 11 = 0 THEN CAST(n AS VARCHAR) WHEN n % 13 = 0 THEN ''
              ELSE {MALFORMED.format(n="n", t=SHORT)} END AS bad_value
  FROM e
)
SELECT * FROM q WHERE bad_value IS NOT NULL""",
    "channel_category_summary": f"WITH {TXN} {SUMMARY}",
    "account_summary": ACCOUNT_SUMMARY,
    "account_running_balance": f"""
WITH {TXN}, {BALANCE}
SELECT transaction_id, account_id, balance AS balance_after_transaction FROM b""",
    "account_current_balance": CURRENT_BALANCE,
    "alert_events": ALERT_EVENTS,
    "alert_events_large_master": ALERT_EVENTS,
    "alert_events_bucketed_master": ALERT_EVENTS,
    "alert_messages": ALERT_MESSAGES,
    "alert_unmatched": UNMATCHED,
    "alert_unmatched_large_master": UNMATCHED,
    "alert_ok_events": f"""
WITH {TXN}, {BALANCE}, {THIRD_STATUS}, {MASTER}
SELECT transaction_id, s.account_id, amount, upper(transaction_status) AS status,
       balance AS balance_after_transaction
FROM s JOIN m ON m.account_id = s.account_id
WHERE amount <= 9000 AND upper(transaction_status) <> 'FAILED'
  AND NOT (transaction_type = 'DEBIT' AND balance < 100)""",
    "alert_run_metrics": f"""
WITH {TXN}, {BALANCE}, {MASTER}, {ALERTS.format(events="b")}
SELECT (SELECT count(*) FROM events) AS events_total, count(*) AS alerts_sent,
       count(*) FILTER (alert_type = 'HIGH_VALUE') AS high_value_alerts,
       count(*) FILTER (alert_type = 'FAILED_TXN') AS failed_txn_alerts,
       count(*) FILTER (alert_type = 'LOW_BALANCE') AS low_balance_alerts
FROM a""",
    "curated_day": f"WITH {TXN} {SUMMARY}",
    "late_day_rebuild": f"WITH {TXN} {SUMMARY}",
    "curate_run_metrics": f"""
WITH {TXN}, s AS ({SUMMARY}), a AS (SELECT DISTINCT CAST(ts AS DATE), account_id FROM t)
SELECT (SELECT count(*) FROM t) AS records, (SELECT count(*) FROM s) AS channel_category_rows,
       (SELECT count(*) FROM a) AS account_rows""",
    "compacted_day": f"""
WITH {TXN},
x AS (SELECT *, CASE WHEN n % 10 = 0 THEN 'late' ELSE CAST(n % 3 AS VARCHAR) END AS load_id FROM t),
d AS (SELECT CAST(ts AS DATE) AS day FROM x WHERE load_id = '2' GROUP BY 1),
r AS (SELECT day, row_number() OVER (ORDER BY day) AS k FROM d)
SELECT transaction_id, amount, CAST(ts AS DATE) AS transaction_date, load_id,
       coalesce(k % 3 = 1 OR k % 2 = 1 AND load_id IN ('0', '2'), false) AS merged
FROM x LEFT JOIN r ON r.day = CAST(ts AS DATE) WHERE load_id <> '1' OR n % 2 = 0""",
    "replayed_load": f"""
WITH {TXN}
SELECT transaction_id, '0' AS load_id, CAST(ts AS DATE) AS transaction_date FROM t WHERE n % 2 = 0
UNION ALL
SELECT transaction_id, '1', CAST(ts AS DATE) FROM t WHERE n % 2 = 1 AND day(ts) % 2 = 1""",
    "incremental_load_unique_table": f"""
WITH {TXN}
SELECT transaction_id, amount, CAST(ts AS DATE) AS transaction_date,
       CASE WHEN n % 2 = 0 THEN 'm0' ELSE 'm1' END AS load_id
FROM t""",
    "incremental_load_late_files": f"""
WITH {TXN}
SELECT transaction_id, amount, CASE WHEN n % 2 = 0 THEN 'm0' ELSE 'm1' END AS load_id FROM t""",
    "stream_ingest_layout": f"""
WITH {TXN}
SELECT transaction_id, true AS in_run, true AS in_its_hour, true AS in_small_file FROM t""",
    "two_streams_one_table": f"WITH {TXN} SELECT transaction_id, account_id, amount FROM t",
    "alert_quarantine": f"""
WITH {TXN}, {BALANCE}, {MASTER}, g AS (SELECT * FROM b WHERE NOT {IS_MALFORMED}),
{ALERTS.format(events="g")}
SELECT (SELECT count(*) FROM g) AS events_total, count(*) AS alerts_sent,
       count(*) FILTER (alert_type = 'HIGH_VALUE') AS high_value_alerts,
       count(*) FILTER (alert_type = 'FAILED_TXN') AS failed_txn_alerts,
       count(*) FILTER (alert_type = 'LOW_BALANCE') AS low_balance_alerts,
       (SELECT count(*) FROM b WHERE {IS_MALFORMED}) AS bad_messages,
       count(*) FILTER (alert_type <> 'LOW_BALANCE') AS alerts_delivered,
       (SELECT count(*) FROM b WHERE {IS_MALFORMED}) AS quarantined
FROM a""",
    "incremental_load": f"""
WITH {TXN}
SELECT transaction_id, account_id, amount, {TIME} AS transaction_timestamp,
       CAST(ts AS DATE) AS transaction_date, {BUCKET} AS amount_bucket
FROM t""",
    "load_run_metrics": f"""
WITH {TXN}, {MESSY}
SELECT count(*) AS raw_rows, count(*) FILTER ({IS_MALFORMED}) AS bad_rows,
       count(*) FILTER ({VALID} AND NOT {IS_MALFORMED}) AS written_rows,
       count(*) - count(*) FILTER ({VALID} AND NOT {IS_MALFORMED}) AS dropped_rows,
       true AS all_files
FROM f""",
    "raw_files_read": "SELECT count(*) AS raw_rows, true AS all_files FROM events",
    "raw_quarantine": f"""
WITH {TXN},
q AS (
  SELECT CASE WHEN channel = 'ATM'
              THEN '{{"transaction_id":"' || transaction_id || '","account_id":"' || account_id
                   || '","transaction_type":"' || transaction_type || '"'
              ELSE {MALFORMED.format(n="n", t=SHORT)} END AS bad_value
  FROM t
)
SELECT * FROM q WHERE bad_value IS NOT NULL""",
    "stream_ingest": f"""
WITH {TXN}
SELECT transaction_id, account_id, amount, {TIME} AS transaction_timestamp, merchant_name,
       n AS _kafka_offset, 0 AS _kafka_partition
FROM t""",
    "stream_ingest_metrics": f"""
WITH {TXN}
SELECT CAST(2 AS BIGINT) AS batches, count(*) AS input_rows, count(*) AS rows,
       count(*) FILTER ({IS_MALFORMED}) AS bad_rows
FROM t""",
    "stream_load": ACCOUNT_SUMMARY,
    "stream_alerts": STREAM_ALERTS,
    "stream_balance": CURRENT_BALANCE,
    "stream_balance_state": CURRENT_BALANCE,
    "stream_idle_stop": f"""
WITH {TXN} SELECT transaction_id, (SELECT count(*) FROM t) AS rows FROM t""",
    "alert_redelivery": f"""
WITH {TXN}, {BALANCE}, {MASTER}, {ALERTS.format(events="b")}
SELECT transaction_id, alert_type,
       CAST(CASE WHEN alert_type <> 'LOW_BALANCE' THEN 1 WHEN n % 2 = 1 THEN 2 ELSE 3 END AS BIGINT) AS tried,
       CAST(1 AS BIGINT) AS sent
FROM a""",
    "sql_over_curated": f"""
WITH {TXN},
c AS (SELECT CAST(ts AS DATE) AS transaction_date, channel, count(*) AS transactions,
             count(*) FILTER (transaction_status = 'FAILED') AS failed
      FROM t GROUP BY ALL),
a AS (SELECT CAST(ts AS DATE) AS transaction_date, count(DISTINCT account_id) AS accounts
      FROM t GROUP BY ALL)
SELECT c.transaction_date, channel, transactions, failed, accounts
FROM c JOIN a ON a.transaction_date = c.transaction_date""",
}
ORACLES["stream_event_balances"] = ORACLES["account_running_balance"]
ORACLES["account_running_balance_split"] = ORACLES["account_running_balance"]

LATEST_MASTER = """
SELECT 'AC' || CAST(c_custkey + 100000 AS VARCHAR) AS account_id,
       CASE WHEN c_custkey % 3 = 0 THEN c_name || ' (new)' ELSE c_name END AS user_name,
       CAST(c_custkey AS VARCHAR) || '@example.com' AS user_email
FROM customer"""
ORACLES["master_latest"] = LATEST_MASTER
ORACLES["master_csv"] = f"""
SELECT account_id, user_name || CASE WHEN CAST(substr(account_id, 3) AS BIGINT) % 4 = 0
       THEN chr(10) || 'Jr' ELSE '' END AS user_name, user_email
FROM ({LATEST_MASTER})"""

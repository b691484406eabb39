"""SQL twins of the registered queries, for DuckDB over the same tables.

They are written independently of the library: merges are spelled as joins and
unions, windows as text comparisons of ``yyyyMM``.
"""

from __future__ import annotations


def _visits(factor: int = 1) -> str:
    return f"""
SELECT event_id * {factor} AS visit_id, user_id AS customer_id, user_id AS atm_id,
       CASE event_type WHEN 'purchase' THEN 'withdrawl' WHEN 'signup' THEN 'deposit' ELSE 'inquiry' END
         AS withdrawl_or_deposit,
       CAST(ROUND(value * 100) AS BIGINT) AS amount,
       CASE WHEN event_type = 'error' THEN 'Y' ELSE 'N' END AS fraud_report,
       ts AS transaction_ts, CAST(ts AS DATE) AS date
FROM events"""


_VISITS_LONG = """
SELECT o_orderkey AS visit_id, o_custkey AS customer_id, o_custkey AS atm_id,
       CASE o_orderstatus WHEN 'F' THEN 'withdrawl' WHEN 'O' THEN 'deposit' ELSE 'inquiry' END
         AS withdrawl_or_deposit,
       CAST(ROUND(o_totalprice * 100) AS BIGINT) AS amount,
       CASE WHEN o_orderpriority = '1-URGENT' THEN 'Y' ELSE 'N' END AS fraud_report,
       o_orderdate AS transaction_ts, CAST(o_orderdate AS DATE) AS date
FROM orders"""


def _dated(source: str) -> str:
    return f"SELECT * EXCLUDE (date), date AS transaction_dt FROM ({source})"


def _locations(factor: int = 1, load: str = "2024-02-01") -> str:
    return f"""
SELECT s_suppkey * {factor} AS atm_id, s_name AS city, n_name AS state, CAST(s_nationkey AS VARCHAR) AS zip,
       CASE WHEN s_acctbal > 0 THEN 'yes' ELSE 'no' END AS pos_capability,
       CASE WHEN s_nationkey < 13 THEN 'onsite' ELSE 'offsite' END AS offsite_or_onsite,
       n_name AS bank, DATE '{load}' AS load_ts
FROM supplier JOIN nation ON s_nationkey = n_nationkey"""


def _customers(factor: int, stamp: str) -> str:
    return f"""
SELECT c_custkey * {factor} AS customer_id, c_custkey * {factor} * 7 + 1000 AS card_number,
       CASE WHEN c_acctbal < 5000 THEN 'checking' ELSE 'savings' END AS checking_savings,
       c_mktsegment AS first_name, 'Customer ' || CAST(c_custkey * {factor} AS VARCHAR) AS last_name,
       DATE '2020-01-01' + c_nationkey AS customer_since_date,
       CASE WHEN c_acctbal >= 0 THEN CASE WHEN c_nationkey < 13 THEN 1 ELSE 0 END END AS preferred,
       TIMESTAMP '{stamp}' AS load_ts, TIMESTAMP '{stamp}' AS update_ts
FROM customer"""


_TOTALS = """
       CAST(SUM(CASE WHEN withdrawl_or_deposit = 'withdrawl' THEN amount END) AS BIGINT) AS total_withdrawls,
       CAST(SUM(CASE WHEN withdrawl_or_deposit = '{deposit}' THEN amount END) AS BIGINT) AS total_deposits"""


def _daily_by_atm(first: str, last: str, visits: str, literal: bool = False) -> str:
    totals = _TOTALS.format(deposit="withdrawl" if literal else "deposit")
    return f"""
SELECT transaction_dt, atm_id, {totals}
FROM ({visits}) WHERE transaction_dt BETWEEN DATE '{first}' AND DATE '{last}'
GROUP BY transaction_dt, atm_id"""


def _daily_by_bank(first: str, last: str, visits: str | None = None, literal: bool = False) -> str:
    visits = visits or _dated(_visits())
    return f"""
SELECT transaction_dt, COALESCE(bank, 'UNKNOWN') AS bank,
       CAST(SUM(total_withdrawls) AS BIGINT) AS total_withdrawls,
       CAST(SUM(total_deposits) AS BIGINT) AS total_deposits
FROM ({_daily_by_atm(first, last, visits, literal)}) d
LEFT JOIN (SELECT DISTINCT atm_id, bank FROM ({_locations()})) l ON d.atm_id = l.atm_id
GROUP BY transaction_dt, COALESCE(bank, 'UNKNOWN')"""


def _monthly(first: str, last: str, visits: str | None = None, literal: bool = False) -> str:
    visits = visits or _dated(_VISITS_LONG)
    totals = _TOTALS.format(deposit="withdrawl" if literal else "deposit")
    key = "CAST(month(transaction_dt) AS INTEGER)" if literal else "CAST(strftime(transaction_dt, '%Y%m') AS INTEGER)"
    return f"""
SELECT {key} AS transaction_month, customer_id, {totals}
FROM ({visits}) WHERE strftime(transaction_dt, '%Y%m') BETWEEN '{first}' AND '{last}'
GROUP BY {key}, customer_id"""


_VISIT_COLUMNS = "visit_id, customer_id, atm_id, withdrawl_or_deposit, amount, fraud_report, transaction_ts"

# --- merges -------------------------------------------------------------------

_CUSTOMER = "customer_id, card_number, checking_savings, first_name, last_name, customer_since_date, preferred"
_TRACKED = ("card_number", "preferred", "first_name", "last_name")


def _differs(columns, null_safe: bool = True) -> str:
    test = "IS DISTINCT FROM" if null_safe else "<>"
    return "COALESCE(" + " OR ".join(f"t.{c} {test} u.{c}" for c in columns) + ", FALSE)"


def _customer_tables(with_history: bool) -> str:
    opened = f"""SELECT *, TRUE AS "current", DATE '2024-01-01' AS effective_date, CAST(NULL AS DATE) AS end_date
      FROM ({_customers(2, '2024-01-01 08:00:00')})"""
    closed = f"""UNION ALL SELECT * REPLACE ('EARLIER' AS first_name), FALSE, DATE '2022-06-30', DATE '2024-01-01'
      FROM ({_customers(2, '2024-01-01 08:00:00')})"""
    return f"""
WITH u AS ({_customers(3, '2024-02-01 12:00:00')}),
t AS ({opened} {closed if with_history else ''})"""


def _type2(null_safe: bool = True, since_date: bool = False, with_history: bool = True) -> str:
    changed = f't."current" AND u.customer_id IS NOT NULL AND {_differs(_TRACKED, null_safe)}'
    known = "EXISTS (SELECT 1 FROM t WHERE t.customer_id = u.customer_id)"
    effective = "DATE '2024-02-01'"
    if since_date:
        effective = f"CASE WHEN {known} THEN {effective} ELSE customer_since_date END"
    target = ", ".join(f"t.{c.strip()}" for c in _CUSTOMER.split(","))
    return f"""{_customer_tables(with_history)}
SELECT {target},
       CASE WHEN {changed} THEN FALSE ELSE t."current" END AS "current", t.effective_date,
       CASE WHEN {changed} THEN DATE '2024-02-01' ELSE t.end_date END AS end_date,
       t.load_ts, CASE WHEN {changed} THEN u.update_ts ELSE t.update_ts END AS update_ts
FROM t LEFT JOIN u ON t.customer_id = u.customer_id
UNION ALL
SELECT {_CUSTOMER}, TRUE, {effective}, CAST(NULL AS DATE), load_ts, update_ts
FROM u
WHERE NOT {known}
   OR EXISTS (SELECT 1 FROM t WHERE t.customer_id = u.customer_id AND {changed})"""



def _changed(null_safe: bool = True) -> str:
    return f"""
SELECT u.* FROM u JOIN t ON u.customer_id = t.customer_id
WHERE t."current" AND {_differs(_TRACKED, null_safe)}"""


def _first_visit(direction: str) -> str:
    return f"""
SELECT {_VISIT_COLUMNS}, date FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY transaction_ts {direction}, visit_id {direction}) AS r
  FROM ({_visits()})) WHERE r = 1"""


_INSERT_ONLY = f"""
WITH t AS ({_dated(_visits(2))}), u AS ({_dated(_visits(3))})
SELECT * FROM t UNION ALL SELECT * FROM u WHERE visit_id NOT IN (SELECT visit_id FROM t)"""

_TYPE1 = f"""
WITH t AS ({_locations(2, '2024-02-01')}), u AS ({_locations(3, '2024-02-02')})
SELECT * FROM u UNION ALL SELECT * FROM t WHERE atm_id NOT IN (SELECT atm_id FROM u)"""


def _early(source: str, cutoff: str) -> str:
    return f"SELECT * FROM ({_dated(source)}) WHERE transaction_ts < TIMESTAMP '{cutoff}'"


def _upsert(stored: str, staged: str, keys: tuple[str, ...], stored_ts: str, staged_ts: str, literal: bool) -> str:
    differs = _differs(("total_withdrawls", "total_deposits"), null_safe=not literal)
    same_key = " AND ".join(f"t.{k} {'=' if literal else 'IS NOT DISTINCT FROM'} u.{k}" for k in keys)
    blocked = f"{same_key} AND {differs}" if literal else same_key
    names = ", ".join(f"t.{k}" for k in keys)
    update = f"u.{keys[0]} IS NOT NULL AND {differs}"
    return f"""
WITH t AS (SELECT *, TIMESTAMP '{stored_ts}' AS create_ts, TIMESTAMP '{stored_ts}' AS update_ts FROM ({stored})),
u AS (SELECT *, TIMESTAMP '{staged_ts}' AS create_ts, TIMESTAMP '{staged_ts}' AS update_ts FROM ({staged}))
SELECT {names},
       CASE WHEN {update} THEN u.total_withdrawls ELSE t.total_withdrawls END AS total_withdrawls,
       CASE WHEN {update} THEN u.total_deposits ELSE t.total_deposits END AS total_deposits,
       t.create_ts, CASE WHEN {update} THEN u.update_ts ELSE t.update_ts END AS update_ts
FROM t LEFT JOIN u ON {same_key}
UNION ALL
SELECT {', '.join(keys)}, total_withdrawls, total_deposits, create_ts, update_ts
FROM u WHERE NOT EXISTS (SELECT 1 FROM t WHERE {blocked})"""


def _daily_upsert(literal: bool) -> str:
    stored = _daily_by_bank("2024-01-01", "2024-01-25", _early(_visits(), "2024-01-25 12:00:00"))
    staged = _daily_by_bank("2024-01-16", "2024-01-30")
    keys = ("transaction_dt", "bank")
    return _upsert(stored, staged, keys, "2024-01-25 12:00:00", "2024-01-31 06:00:00", literal)


def _monthly_upsert(literal: bool) -> str:
    stored = _monthly("199501", "200006", _early(_VISITS_LONG, "2000-06-15 00:00:00"))
    staged = _monthly("199909", "200108")
    keys = ("transaction_month", "customer_id")
    return _upsert(stored, staged, keys, "2000-06-15 00:00:00", "2001-09-01 06:00:00", literal)


# Rows of each merge, told apart by what the merge must have stamped them with.
_ACTION_COUNTS = f"""
SELECT 'insert_if_absent' AS operation, 'insert' AS action, COUNT(*) AS row_count
FROM ({_visits(3)}) WHERE visit_id NOT IN (SELECT visit_id FROM ({_visits(2)}))
UNION ALL
SELECT 'upsert_latest', action, COUNT(*) FROM (
  SELECT CASE WHEN u.atm_id IS NULL THEN 'keep' WHEN t.atm_id IS NULL THEN 'insert' ELSE 'update' END AS action
  FROM ({_locations(2)}) t FULL JOIN ({_locations(3)}) u ON t.atm_id = u.atm_id) GROUP BY action
UNION ALL
SELECT 'scd2_apply', action, COUNT(*) FROM (
  SELECT CASE WHEN load_ts = TIMESTAMP '2024-02-01 12:00:00' THEN 'insert'
              WHEN update_ts = TIMESTAMP '2024-02-01 12:00:00' THEN 'close' ELSE 'keep' END AS action
  FROM ({_type2()})) GROUP BY action
UNION ALL
SELECT 'upsert_if_changed', action, COUNT(*) FROM (
  SELECT CASE WHEN create_ts = TIMESTAMP '2024-01-31 06:00:00' THEN 'insert'
              WHEN update_ts = TIMESTAMP '2024-01-31 06:00:00' THEN 'update' ELSE 'keep' END AS action
  FROM ({_daily_upsert(literal=False)})) GROUP BY action"""

_RUN_LOG = f"""
SELECT 'atm_customers' AS table_name, 'scd2_apply' AS operation,
       CAST(2 * (SELECT COUNT(*) FROM customer) AS BIGINT) AS input_rows,
       CAST(COUNT(*) FILTER (WHERE "current" OR end_date IS NOT NULL) AS BIGINT) AS inserted,
       CAST(0 AS BIGINT) AS updated,
       CAST(COUNT(*) FILTER (WHERE NOT "current") AS BIGINT) AS closed
FROM ({_type2(with_history=False)})"""

_DELIVERIES = f"""
SELECT * FROM (
  SELECT {_CUSTOMER}, 0 AS delivery FROM ({_customers(1, '2024-01-01 08:00:00')})
  UNION ALL SELECT {_CUSTOMER}, 1 FROM (SELECT * REPLACE (CASE WHEN customer_id % 3 = 0 THEN first_name ELSE 'MOVED' END AS first_name)
    FROM ({_customers(1, '2024-01-01 08:00:00')}))
  UNION ALL SELECT {_CUSTOMER}, 2 FROM (SELECT * REPLACE (CASE WHEN customer_id % 3 = 1 THEN 'MOVED' ELSE first_name END AS first_name)
    FROM ({_customers(1, '2024-01-01 08:00:00')})))"""

# Within a customer only the first name differs between deliveries.
_CHAIN = f"""
SELECT * EXCLUDE (before), before IS NULL AS chain_first,
       LEAD(delivery) OVER (PARTITION BY customer_id ORDER BY delivery) IS NULL AS chain_last
FROM (SELECT *, LAG(first_name) OVER (PARTITION BY customer_id ORDER BY delivery) AS before FROM ({_DELIVERIES}))
WHERE before IS NULL OR before <> first_name"""

# In the order 1, 3, 2: what the third delivery had changed keeps its date, also where the second one turns out to have been first.
_LATE = f"""
WITH c AS ({_DELIVERIES}), base AS (SELECT customer_id, first_name FROM c WHERE delivery = 0),
v AS (
  SELECT customer_id, first_name, 0 AS nth, DATE '2024-01-01' AS effective_date FROM base
  UNION ALL SELECT customer_id, 'MOVED', 1, DATE '2024-02-01' FROM base WHERE customer_id % 3 = 1
  UNION ALL SELECT customer_id, 'MOVED', 1, DATE '2024-02-02' FROM base WHERE customer_id % 3 = 2
  UNION ALL SELECT customer_id, first_name, 2, DATE '2024-02-02' FROM base WHERE customer_id % 3 = 2)
SELECT customer_id, first_name, LEAD(nth) OVER w IS NULL AS "current", effective_date, LEAD(effective_date) OVER w AS end_date
FROM v WINDOW w AS (PARTITION BY customer_id ORDER BY nth)"""


def _moved_bank(literal: bool) -> str:
    stored = _daily_by_bank("2024-01-01", "2024-01-30")
    moved = "CASE WHEN s_nationkey < 5 THEN 'MERGED' ELSE n_name END AS bank"
    staged = stored.replace("n_name AS bank", moved)
    merged = _upsert(stored, staged, ("transaction_dt", "bank"), "2024-01-31 06:00:00", "2024-02-01 06:00:00", literal)
    if literal:
        return merged
    return f"SELECT * FROM ({merged}) WHERE (transaction_dt, bank) IN (SELECT (transaction_dt, bank) FROM ({staged}))"


ORACLES: dict[str, str] = {
    "silver_visits_prepare": f"SELECT {_VISIT_COLUMNS}, date AS transaction_dt FROM ({_visits()})",
    "silver_locations_flatten": _locations(),
    "silver_visits_insert_only": _INSERT_ONLY,
    "silver_locations_type1": _TYPE1,
    "silver_customers_type2": _type2(),
    "silver_customers_type2_literal": _type2(null_safe=False),
    "silver_customers_type2_since_date": _type2(since_date=True),
    "silver_customers_staged_updates": f"""{_customer_tables(True)}
SELECT customer_id AS merge_key, * FROM u UNION ALL SELECT CAST(NULL AS BIGINT), * FROM ({_changed()})""",
    "changed_current_customers": _customer_tables(True) + _changed(),
    "changed_current_customers_literal": _customer_tables(True) + _changed(null_safe=False),
    "scd2_multi_version_batch": _CHAIN,
    "dedupe_earliest_visits": _first_visit("ASC"),
    "dedupe_latest_visits": _first_visit("DESC"),
    "visits_in_day_window": f"""
SELECT * FROM ({_dated(_visits())}) WHERE transaction_dt BETWEEN DATE '2024-01-17' AND DATE '2024-01-20'""",
    "visits_in_month_window": f"""
SELECT * FROM ({_dated(_VISITS_LONG)}) WHERE strftime(transaction_dt, '%Y%m') BETWEEN '199501' AND '199506'""",
    "visit_amount_split": f"""
SELECT visit_id, CASE WHEN withdrawl_or_deposit = 'withdrawl' THEN amount END AS withdrawl_amt,
       CASE WHEN withdrawl_or_deposit = 'deposit' THEN amount END AS deposit_amt FROM ({_visits()})""",
    "distinct_atm_bank": f"SELECT DISTINCT atm_id, bank FROM ({_locations()})",
    "visits_with_bank": f"""
SELECT v.visit_id, v.atm_id, v.amount, COALESCE(l.bank, 'UNKNOWN') AS bank
FROM ({_visits()}) v LEFT JOIN (SELECT DISTINCT atm_id, bank FROM ({_locations()})) l ON v.atm_id = l.atm_id""",
    "gold_daily_by_atm": _daily_by_atm("2024-01-01", "2024-01-30", _dated(_visits())),
    "gold_daily_by_bank": _daily_by_bank("2024-01-01", "2024-01-30"),
    "gold_daily_by_bank_literal": _daily_by_bank("2024-01-01", "2024-01-30", literal=True),
    "gold_daily_by_bank_default_window": _daily_by_bank("2024-01-17", "2024-01-20"),
    "gold_daily_by_bank_current_date": _daily_by_bank("1990-01-01", "2024-12-31"),
    "gold_daily_by_two_banks": f"""
SELECT transaction_dt, COALESCE(bank, 'UNKNOWN') AS bank, {_TOTALS.format(deposit="deposit")}
FROM ({_dated(_visits())}) v LEFT JOIN (
  SELECT atm_id, bank FROM ({_locations()})
  UNION SELECT s_suppkey, CASE WHEN s_nationkey < 5 THEN 'MERGED' ELSE n_name END
  FROM supplier JOIN nation ON s_nationkey = n_nationkey) l ON v.atm_id = l.atm_id
GROUP BY transaction_dt, COALESCE(bank, 'UNKNOWN')""",
    "gold_monthly_by_customer_last_month": _monthly("199001", "202412"),
    "gold_daily_upsert": _daily_upsert(literal=False),
    "gold_daily_upsert_literal": _daily_upsert(literal=True),
    "gold_daily_upsert_moved_bank": _moved_bank(literal=False),
    "gold_daily_upsert_moved_bank_literal": _moved_bank(literal=True),
    "gold_monthly_by_customer": _monthly("199501", "200108"),
    "gold_monthly_by_customer_literal": _monthly("199501", "200108", literal=True),
    "gold_monthly_upsert": _monthly_upsert(literal=False),
    "gold_monthly_upsert_literal": _monthly_upsert(literal=True),
    "merge_action_counts": _ACTION_COUNTS,
    "stream_stage_to_bronze": _visits(),
    "stream_silver_visits": _INSERT_ONLY,
    "stream_silver_locations": _TYPE1.replace("2024-02-01", "2024-01-01").replace("2024-02-02", "2024-02-01"),
    "stream_silver_customers": f'SELECT * EXCLUDE (load_ts, update_ts) FROM ({_type2(with_history=False)})',
    "stream_silver_customers_versions": f"""
SELECT customer_id, first_name, chain_last AS "current", DATE '2024-02-01' AS effective_date,
       CASE WHEN NOT chain_last THEN DATE '2024-02-01' END AS end_date FROM ({_CHAIN})""",
    "late_customer_delivery": _LATE,
    "stream_visits_delivered_again": f"""
SELECT visit_id, customer_id, amount, CAST(2 AS BIGINT) AS received, (SELECT COUNT(*) FROM events) AS merged FROM ({_visits()})""",
    "customer_changes_replayed": f'SELECT * EXCLUDE (load_ts, update_ts) FROM ({_type2(with_history=False)})',
    "stream_incremental_daily": _daily_by_bank("2024-01-01", "2024-01-30", _INSERT_ONLY).replace(
        "n_name AS bank", "CASE WHEN s_nationkey < 5 THEN 'MERGED' ELSE n_name END AS bank"
    ),
    "recovered_publish": _TYPE1.replace("2024-02-01", "2024-01-01").replace("2024-02-02", "2024-02-01"),
    "visits_held_by_key_filter": f"""
SELECT visit_id, date AS transaction_dt FROM ({_visits(2)}) WHERE visit_id IN (SELECT visit_id FROM ({_visits(3)}))""",
    "stream_quarantine": f"""
SELECT atm_id, CAST(NULL AS VARCHAR) AS line FROM ({_locations()})
UNION ALL SELECT NULL, '{{"atm_id": broken ' || CAST(atm_id AS VARCHAR) FROM ({_locations()})""",
    "stream_rescued_fields": f"""
SELECT visit_id, CASE WHEN fraud_report = 'N' THEN amount END AS amount, date, customer_id % 3 AS terminal,
       CASE WHEN fraud_report = 'Y' THEN CAST(amount AS VARCHAR) || ' cents' END AS told
FROM ({_visits()})""",
    "stream_measured": f"""
SELECT 'atm_visits' AS table_name,
       COUNT(*) + COUNT(*) FILTER (withdrawl_or_deposit = 'deposit') AS input_rows,
       COUNT(*) FILTER (fraud_report = 'Y') AS null_keys, COUNT(*) FILTER (date < DATE '2024-01-10') AS late_rows,
       COUNT(*) FILTER (withdrawl_or_deposit = 'deposit') AS rejected_rows
FROM ({_visits()})""",
    "stream_supervised": _INSERT_ONLY,
    "stream_customers_in_growing_buckets": f'SELECT * EXCLUDE (load_ts, update_ts) FROM ({_type2(with_history=False)})',
    "replayed_visits_batch": f"""
SELECT visit_id, amount, date AS transaction_dt, DATE '2024-02-01' AS loaded, CAST(0 AS BIGINT) AS changed_again FROM ({_visits()})""",
    "catalog_daily_by_bank": f"""
SELECT *, (SELECT COUNT(*) FROM events) AS visits, (SELECT COUNT(*) FROM supplier) AS atms
FROM ({_daily_by_bank('2024-01-01', '2024-01-30')})""",
    "stream_run_log": _RUN_LOG,
    "stream_end_to_end_daily": _daily_by_bank("2024-01-01", "2024-01-30"),
    "stream_end_to_end_monthly": _monthly("202401", "202401", _dated(_visits())),
}

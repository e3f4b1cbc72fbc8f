"""The catalogue once more, as ANSI SQL over the same Parquet tables.

Written from the definitions, not from the Spark plans: distinct counts, full
outer joins and unions where the library uses bitmasks, roll-ups and splits.
"""

from __future__ import annotations

import math

# --- the three extracts ------------------------------------------------------

EXTRACTS = """
users_raw AS (
  SELECT CASE WHEN c_custkey % 12 = 11 THEN 'MLBX' WHEN c_custkey % 10 = 9 THEN 'MLA' ELSE 'MLB' END
           || CAST(c_custkey AS VARCHAR) AS user_id,
         CASE WHEN c_custkey % 7 = 0 THEN 'abc' WHEN c_custkey % 7 = 1 THEN '' WHEN c_custkey % 7 = 2 THEN ' '
              ELSE CAST(c_custkey % 7 AS VARCHAR) || '.0' END AS type,
         CASE WHEN c_mktsegment = 'MACHINERY' THEN CAST(c_nationkey AS VARCHAR)
              WHEN c_mktsegment = 'BUILDING' THEN '' ELSE NULL END AS rubro,
         c_name || CHR(10) || c_mktsegment || '  /  X' AS address
  FROM customer
),
transactions_raw AS (
  SELECT event_id,
         CASE WHEN user_id % 10 = 9 THEN 'MLA' ELSE 'MLB' END || CAST(user_id AS VARCHAR) AS user_id,
         CASE WHEN event_id % 97 = 0 THEN NULL ELSE ts END AS transaction_dt,
         CAST(event_id % 11 AS INTEGER) AS type, CAST(event_id % 4 AS INTEGER) AS segment
  FROM events
),
tx AS (
  SELECT event_id, 'MLB' || CAST(user_id AS VARCHAR) AS user_id, ts AS transaction_dt,
         CAST(CASE WHEN user_id % 5 = 0 AND event_id % 4 = 0 THEN 8
                   WHEN user_id % 5 = 0 AND event_id % 4 = 2 THEN 9
                   ELSE 1 + event_id % 7 END AS INTEGER) AS type
  FROM events
),
registrations AS (
  SELECT 'MLB' || CAST(c_custkey AS VARCHAR) AS user_id,
         TIMESTAMP '2023-12-20 06:00:00' + (c_custkey % 35) * INTERVAL '1' DAY AS first_login_dt,
         CAST(1 + c_custkey % 7 AS VARCHAR) AS week_year,
         CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 8 = 0 THEN CAST(1 AS DOUBLE)
              ELSE CAST(0 AS DOUBLE) END AS habito,
         CAST(c_custkey % 2 AS INTEGER) AS activacion,
         CAST(CASE WHEN c_custkey % 5 < 2 THEN 1 WHEN c_custkey % 5 = 3 THEN 2 ELSE 0 END AS INTEGER) AS setup,
         CAST(CASE WHEN c_custkey % 13 = 0 THEN NULL WHEN c_custkey % 4 <> 0 THEN 1 ELSE 0 END AS INTEGER) AS "return",
         CAST(0 AS INTEGER) AS seq
  FROM customer
  UNION ALL
  SELECT 'MLB' || CAST(c_custkey AS VARCHAR),
         TIMESTAMP '2023-12-20 06:00:00' + (c_custkey % 35 + 1) * INTERVAL '1' DAY,
         CAST(1 + c_custkey % 7 AS VARCHAR), CAST(0 AS DOUBLE), 0, 0, 0, 1
  FROM customer WHERE c_custkey % 26 = 0
),
onboarding_raw AS (
  SELECT *,
         CASE WHEN habito = 1 THEN first_login_dt + 10 * INTERVAL '1' DAY END AS habito_dt,
         CASE WHEN activacion = 1 THEN first_login_dt + 1 * INTERVAL '1' DAY END AS activacion_dt,
         CASE WHEN setup = 1 THEN first_login_dt + 2 * INTERVAL '1' DAY END AS setup_dt,
         CASE WHEN "return" = 1 THEN first_login_dt + 1 * INTERVAL '1' DAY END AS return_dt
  FROM registrations
),
onboarding_typed AS (
  SELECT user_id, first_login_dt, week_year,
         COALESCE(CAST(habito AS INTEGER), 0) AS habito, COALESCE(activacion, 0) AS activacion,
         CAST(CASE WHEN setup = 1 THEN 1 ELSE 0 END AS INTEGER) AS setup, COALESCE("return", 0) AS return_flag, seq,
         habito_dt, activacion_dt, setup_dt, return_dt
  FROM onboarding_raw
),
"""

# --- cleaning steps, one CTE per rule ----------------------------------------

CLEANING = """
u1 AS (SELECT * FROM users_raw WHERE user_id LIKE 'MLB%'),
u2 AS (SELECT * FROM u1 WHERE user_id IS NOT NULL AND user_id <> ''),
u3 AS (SELECT * FROM u2 WHERE regexp_matches(user_id, '^MLB[0-9]+$')),
users_clean AS (
  SELECT user_id, TRY_CAST(NULLIF(TRIM(type), '') AS DOUBLE) AS type,
         TRY_CAST(NULLIF(TRIM(rubro), '') AS DOUBLE) AS rubro,
         regexp_replace(address, '[ \\t\\n\\x0B\\f\\r]+', ' ', 'g') AS address
  FROM u3
),
t1 AS (SELECT * FROM transactions_raw WHERE user_id LIKE 'MLB%'),
t2 AS (SELECT * FROM t1 WHERE type BETWEEN 1 AND 9),
t3 AS (SELECT * FROM t2 WHERE segment IN (1, 2)),
t4 AS (SELECT * FROM t3 WHERE transaction_dt IS NOT NULL),
t5 AS (SELECT * FROM t4 WHERE transaction_dt >= TIMESTAMP '2024-01-01 00:00:00'
                          AND transaction_dt <= TIMESTAMP '2024-01-28 00:00:00'),
o1 AS (SELECT * FROM onboarding_typed WHERE user_id LIKE 'MLB%'),
o2 AS (SELECT * FROM o1 WHERE first_login_dt IS NOT NULL),
o3 AS (SELECT * FROM o2 WHERE first_login_dt >= TIMESTAMP '2024-01-01 00:00:00'
                          AND first_login_dt <= TIMESTAMP '2024-01-28 00:00:00'),
"""

# --- metrics -----------------------------------------------------------------

METRICS = """
onb AS (
  SELECT user_id, first_login_dt, week_year, habito, activacion, setup, return_flag, seq,
         habito_dt, activacion_dt, setup_dt, return_dt
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY first_login_dt, seq) AS rn
        FROM onboarding_typed
        WHERE user_id LIKE 'MLB%' AND first_login_dt >= TIMESTAMP '2023-12-01 00:00:00'
          AND first_login_dt <= TIMESTAMP '2024-12-31 00:00:00') ranked
  WHERE rn = 1
),
families AS (
  SELECT COALESCE(p.user_id, c.user_id) AS user_id,
         CASE WHEN p.user_id IS NULL THEN 0 ELSE 1 END AS has_payments,
         CASE WHEN c.user_id IS NULL THEN 0 ELSE 1 END AS has_collections
  FROM (SELECT DISTINCT user_id FROM tx WHERE type BETWEEN 1 AND 7) p
  FULL OUTER JOIN (SELECT DISTINCT user_id FROM tx WHERE type IN (8, 9)) c ON p.user_id = c.user_id
),
segments AS (
  SELECT user_id, CASE WHEN has_collections = 1 THEN 'SELLERS' ELSE 'INDIVIDUALS' END AS user_segment
  FROM families
),
summary AS (
  SELECT user_id, COUNT(*) AS total_transactions,
         CAST(COUNT(DISTINCT type) AS INTEGER) AS unique_transaction_types,
         COUNT(DISTINCT CAST(transaction_dt AS DATE)) AS transaction_days,
         MIN(transaction_dt) AS first_transaction_dt, MAX(transaction_dt) AS last_transaction_dt
  FROM tx GROUP BY user_id
),
onb_segment AS (
  SELECT o.*, COALESCE(s.user_segment, 'UNKNOWN') AS user_segment
  FROM onb o LEFT JOIN segments s ON o.user_id = s.user_id
),
inside AS (
  SELECT t.*, o.first_login_dt, o.user_segment
  FROM onb_segment o JOIN tx t ON t.user_id = o.user_id
  WHERE t.transaction_dt >= o.first_login_dt
    AND t.transaction_dt <= CAST(CAST(o.first_login_dt AS DATE) + 30 AS TIMESTAMP)
),
individual_part AS (
  SELECT user_id, user_segment, COUNT(*) AS total_transactions_period,
         COUNT(DISTINCT CAST(transaction_dt AS DATE)) AS unique_transaction_days,
         CAST(NULL AS BIGINT) AS total_collection_transactions
  FROM inside WHERE user_segment <> 'SELLERS' GROUP BY user_id, user_segment
),
seller_part AS (
  SELECT user_id, user_segment, COUNT(*) AS total_transactions_period,
         CAST(NULL AS BIGINT) AS unique_transaction_days, COUNT(*) AS total_collection_transactions
  FROM inside WHERE user_segment = 'SELLERS' AND type IN (8, 9) GROUP BY user_id, user_segment
),
habit_parts AS (SELECT * FROM individual_part UNION ALL SELECT * FROM seller_part),
habit AS (
  SELECT o.user_id, o.user_segment, o.first_login_dt, o.habito,
         COALESCE(h.total_transactions_period, 0) AS total_transactions_period,
         h.unique_transaction_days,
         CAST(CASE WHEN o.user_segment = 'SELLERS' AND h.total_transactions_period >= 30 THEN 1
                   WHEN o.user_segment <> 'SELLERS' AND h.total_transactions_period >= 60
                        AND h.unique_transaction_days >= 25 THEN 1
                   ELSE 0 END AS INTEGER) AS habit_achieved_calculated
  FROM onb_segment o LEFT JOIN habit_parts h ON o.user_id = h.user_id
),
activation AS (
  SELECT o.user_id, o.first_login_dt, o.activacion, o.activacion_dt,
         CAST(CASE WHEN x.user_id IS NULL THEN 0 ELSE 1 END AS INTEGER) AS has_transactions
  FROM onb o LEFT JOIN (SELECT DISTINCT user_id FROM tx) x ON o.user_id = x.user_id
),
um AS (
  SELECT o.user_id, o.first_login_dt, o.week_year, o.user_segment,
         COALESCE(s.total_transactions, 0) AS total_transactions,
         COALESCE(s.transaction_days, 0) AS transaction_days,
         CAST(CASE WHEN o.return_flag = 1 THEN 0 ELSE 1 END AS INTEGER) AS drop_flag,
         o.return_flag, o.return_dt, o.activacion AS activation_validated, o.activacion_dt,
         h.habito AS habit_validated, h.total_transactions_period, h.unique_transaction_days,
         o.setup AS setup_achieved, o.setup_dt,
         CAST(o.first_login_dt AS DATE) + 30 AS onboarding_end_dt,
         CAST(EXTRACT(MONTH FROM o.first_login_dt) AS INTEGER) AS first_login_month,
         CAST(EXTRACT(WEEK FROM o.first_login_dt) AS INTEGER) AS first_login_week,
         a.has_transactions, h.habit_achieved_calculated,
         CAST(CASE WHEN o.activacion = a.has_transactions THEN 1 ELSE 0 END AS INTEGER) AS activation_agrees,
         CAST(CASE WHEN o.habito = h.habit_achieved_calculated THEN 1 ELSE 0 END AS INTEGER) AS habit_agrees
  FROM onb_segment o
  LEFT JOIN summary s ON o.user_id = s.user_id
  JOIN habit h ON o.user_id = h.user_id
  JOIN activation a ON o.user_id = a.user_id
),
"""

_FUNNEL_COUNTS = """
  COUNT(*) AS total_users, COUNT(*) AS stage_1_registered,
  CAST(SUM(1 - drop_flag) AS BIGINT) AS stage_2_returned,
  CAST(SUM(activation_validated) AS BIGINT) AS stage_3_activated,
  CAST(SUM(setup_achieved) AS BIGINT) AS stage_4_setup,
  CAST(SUM(habit_validated) AS BIGINT) AS stage_5_habit
"""
_BUCKET_COUNTS = """
  COUNT(*) AS total_users,
  CAST(SUM(1 - drop_flag) AS BIGINT) AS returned_users,
  CAST(SUM(activation_validated) AS BIGINT) AS activated_users,
  CAST(SUM(setup_achieved) AS BIGINT) AS setup_completed_users,
  CAST(SUM(habit_validated) AS BIGINT) AS habit_achieved_users
"""
_RATES = """
  ROUND((CAST(1 AS DOUBLE) - CAST(returned_users AS DOUBLE) / CAST(total_users AS DOUBLE)) * 100, 2) AS drop_rate,
  ROUND(CAST(activated_users AS DOUBLE) / CAST(total_users AS DOUBLE) * 100, 2) AS activation_rate,
  ROUND(CAST(setup_completed_users AS DOUBLE) / CAST(total_users AS DOUBLE) * 100, 2) AS setup_rate,
  ROUND(CAST(habit_achieved_users AS DOUBLE) / CAST(total_users AS DOUBLE) * 100, 2) AS habit_rate
"""
_WEEK = (
    "CAST(EXTRACT(ISOYEAR FROM first_login_dt) AS VARCHAR) || '-W' ||"
    " LPAD(CAST(EXTRACT(WEEK FROM first_login_dt) AS VARCHAR), 2, '0')"
)
_MONTH = "strftime(first_login_dt, '%Y-%m')"


def _funnel(*dimensions: tuple[str, str], source: str = "um") -> str:
    parts = [
        f"SELECT 'overall' AS dimension_type, 'all' AS dimension_value, {_FUNNEL_COUNTS} FROM {source}"
    ]
    for name, value in dimensions:
        parts.append(
            f"SELECT '{name}' AS dimension_type, {value} AS dimension_value, {_FUNNEL_COUNTS}"
            f" FROM {source} GROUP BY 2"
        )
    return " UNION ALL ".join(parts)


_BY_SEGMENT = ("user_segment", "user_segment")
_BY_MONTH = ("month", "CAST(first_login_month AS VARCHAR)")
_BY_WEEK = ("week", _WEEK)
_SERVED_FUNNEL = _funnel(_BY_SEGMENT, _BY_MONTH)


def _bucket(name: str, label: str) -> str:
    return (
        f"SELECT *, {_RATES} FROM (SELECT {label} AS {name}, user_segment, {_BUCKET_COUNTS}"
        f" FROM um GROUP BY 1, 2) counted"
    )


_BUCKET = "TRY_CAST(RIGHT(regexp_extract(user_id, '^MLB([0-9]+)$', 1), 2) AS INTEGER)"
_AB = f"CASE WHEN {_BUCKET} < 5 THEN 'control' WHEN {_BUCKET} IS NULL THEN 'unassigned' ELSE 'treatment' END"


def _with(ctes: str, body: str) -> str:
    return f"WITH {ctes.strip().rstrip(',')}\n{body.strip()}"


def _raw(body: str) -> str:
    return _with(EXTRACTS, body)


def _cleaned(body: str) -> str:
    return _with(EXTRACTS + CLEANING, body)


def _measured(body: str) -> str:
    return _with(EXTRACTS + METRICS, body)


def _ledger(steps: list[tuple[str, str, str]]) -> str:
    """Steps as (rule, CTE before, CTE after)."""
    parts = []
    for i, (rule, before, after) in enumerate(steps, start=1):
        n_before = f"(SELECT COUNT(*) FROM {before})"
        n_after = f"(SELECT COUNT(*) FROM {after})"
        parts.append(
            f"SELECT CAST({i} AS INTEGER) AS step, '{rule}' AS rule, {n_before} AS rows_before,"
            f" {n_before} - {n_after} AS rows_removed, {n_after} AS rows_after"
        )
    return _cleaned(" UNION ALL ".join(parts))


def _profile(table: str, columns: list[str], floats: list[str] = []) -> str:
    parts = []
    for name in columns:
        c = f'"{name}"'
        gone = f"{c} IS NULL" + (f" OR isnan({c})" if name in floats else "")
        n = f"COUNT(*) FILTER (WHERE {gone})"
        parts.append(
            f"SELECT '{name}' AS column_name, COUNT(*) AS total_rows, {n} AS null_count,"
            f" COUNT(*) - {n} AS non_null_count,"
            f" ROUND(CAST({n} AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) * 100, 2) AS missing_percentage"
            f" FROM {table}"
        )
    return " UNION ALL ".join(parts)


_ONBOARDING_COLUMNS = [
    "user_id", "first_login_dt", "week_year", "habito", "activacion", "setup", "return", "seq",
    "habito_dt", "activacion_dt", "setup_dt", "return_dt",
]

_CONVERSION_STAGES = [
    "stage_1_registered",
    "stage_2_returned",
    "stage_3_activated",
    "stage_4_setup",
    "stage_5_habit",
]


def _conversion() -> str:
    parts = []
    for i, stage in enumerate(_CONVERSION_STAGES, start=1):
        before = _CONVERSION_STAGES[max(i - 2, 0)]
        parts.append(
            f"SELECT dimension_type, dimension_value, CAST({i} AS INTEGER) AS stage_number,"
            f" '{stage}' AS stage, {stage} AS users,"
            f" ROUND(CAST({stage} AS DOUBLE) / CAST(NULLIF(stage_1_registered, 0) AS DOUBLE) * 100, 2)"
            f" AS percent_of_registered,"
            f" ROUND(CAST({stage} AS DOUBLE) / CAST(NULLIF({before}, 0) AS DOUBLE) * 100, 2)"
            f" AS percent_of_previous,"
            f" {before} - {stage} AS lost_from_previous FROM f"
        )
    return f"SELECT * FROM (WITH f AS ({_SERVED_FUNNEL}) {' UNION ALL '.join(parts)}) stages"


def _overlaps(u: str, t: str, o: str) -> str:
    def ids(name: str) -> str:
        return f"SELECT user_id FROM {name}"

    def size(sql: str) -> str:
        return f"(SELECT COUNT(*) FROM ({sql}) s)"

    return (
        f"SELECT {size('SELECT DISTINCT user_id FROM ' + u)} AS users_count,"
        f" {size('SELECT DISTINCT user_id FROM ' + t)} AS transactions_users_count,"
        f" {size('SELECT DISTINCT user_id FROM ' + o)} AS onboarding_users_count,"
        f" {size(ids(u) + ' INTERSECT ' + ids(t))} AS users_transactions_overlap,"
        f" {size(ids(u) + ' INTERSECT ' + ids(o))} AS users_onboarding_overlap,"
        f" {size(ids(t) + ' INTERSECT ' + ids(o))} AS transactions_onboarding_overlap,"
        f" {size(ids(u) + ' INTERSECT ' + ids(t) + ' INTERSECT ' + ids(o))} AS all_three_overlap"
    )


def _duplicates(name: str, table: str, columns: str) -> str:
    return (
        f"SELECT '{name}' AS dataset, (SELECT COUNT(*) FROM {table}) AS total_rows,"
        f" (SELECT COUNT(*) FROM (SELECT DISTINCT {columns} FROM {table}) d) AS distinct_rows,"
        f" (SELECT COUNT(*) FROM {table}) -"
        f" (SELECT COUNT(*) FROM (SELECT DISTINCT {columns} FROM {table}) d) AS duplicate_rows"
    )


def _prefixed(name: str, table: str) -> str:
    return (
        f"SELECT '{name}' AS dataset, COUNT(*) AS distinct_ids,"
        f" COUNT(*) FILTER (WHERE user_id LIKE 'MLB%') AS with_prefix,"
        f" CAST(COUNT(*) FILTER (WHERE user_id LIKE 'MLB%') AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) * 100"
        f" AS share FROM (SELECT DISTINCT user_id FROM {table}) d"
    )


def _flag_total(name: str) -> str:
    return (
        f"SELECT '{name}' AS flag, COUNT(*) AS total_rows, CAST(SUM({name}) AS BIGINT) AS flag_count,"
        f" ROUND(CAST(SUM({name}) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) * 100, 2) AS share"
        f" FROM onboarding_typed"
    )


def _rate(name: str, column: str) -> str:
    return (
        f"SELECT '{name}' AS metric, CAST(SUM({column}) AS BIGINT) AS hits, COUNT(*) AS total_users,"
        f" CAST(SUM({column}) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) * 100 AS rate FROM um"
    )


_USER_METRICS_CONTRACT = """
SELECT user_id, first_login_dt, week_year, user_segment,
       CAST(total_transactions AS INTEGER) AS total_transactions,
       CAST(transaction_days AS INTEGER) AS transaction_days,
       drop_flag, return_flag, return_dt, activation_validated, activacion_dt, habit_validated,
       CAST(total_transactions_period AS INTEGER) AS total_transactions_period,
       CAST(unique_transaction_days AS INTEGER) AS unique_transaction_days,
       setup_achieved, setup_dt, CAST(onboarding_end_dt AS TIMESTAMP) AS onboarding_end_dt,
       first_login_month, first_login_week
FROM um
"""


def _wrong_width(body: str) -> str:
    return _raw(
        f"""SELECT * FROM (WITH k AS (
              SELECT *, CAST(regexp_extract(user_id, '([0-9]+)$', 1) AS BIGINT) AS n FROM users_raw),
            w AS (SELECT user_id, n % 17 <> 0 AND n % 19 <> 0 AS width,
                         user_id || ',' || COALESCE(type, '') || ',' || COALESCE(rubro, '')
                         || CASE WHEN n % 17 = 0 THEN '' ELSE ',"' || address || '"' END
                         || CASE WHEN n % 17 <> 0 AND n % 19 = 0 THEN ',more' ELSE '' END AS record FROM k)
            {body}) q"""
    )


_ANY = "user_id LIKE 'MLB%'"
_WIDTH_STEPS = (
    ("row_width", "TRUE", "width"),
    ("id_prefix", "width", _ANY),
    ("id_present", f"width AND {_ANY}", "user_id <> ''"),
    ("id_format", f"width AND {_ANY}", "regexp_matches(user_id, '^MLB[0-9]+$')"),
)
_REJECTED = (
    f"SELECT 'users' AS dataset, CASE WHEN NOT ({_ANY}) THEN 'id_prefix' ELSE 'id_format' END AS rule, user_id"
    f" FROM users_raw WHERE NOT regexp_matches(user_id, '^MLB[0-9]+$')",
    f"SELECT 'transactions', CASE WHEN NOT ({_ANY}) THEN 'id_prefix' WHEN type NOT BETWEEN 1 AND 9 THEN 'type_domain'"
    " WHEN segment NOT IN (1, 2) THEN 'segment_domain' WHEN transaction_dt IS NULL THEN 'time_present' ELSE 'date_range' END, user_id"
    " FROM transactions_raw WHERE event_id NOT IN (SELECT event_id FROM t5)",
    "SELECT 'onboarding', 'date_range', user_id FROM onboarding_typed"
    " WHERE NOT (first_login_dt >= TIMESTAMP '2024-01-01 00:00:00' AND first_login_dt <= TIMESTAMP '2024-01-28 00:00:00')",
)
_DAILY = (
    "SELECT user_id, CAST(transaction_dt AS DATE) AS transaction_date,"
    " CAST(COUNT(*) AS INTEGER) AS transaction_count,"
    " CAST(COUNT(*) FILTER (WHERE type BETWEEN 1 AND 7) AS INTEGER) AS payment_transactions,"
    " CAST(COUNT(*) FILTER (WHERE type IN (8, 9)) AS INTEGER) AS collection_transactions,"
    " CAST(COUNT(DISTINCT type) AS INTEGER) AS unique_transaction_types"
    " FROM tx GROUP BY 1, 2"
)


def _next_stage(name: str, moment: str, before: str) -> str:
    return f"SELECT *, CASE WHEN {moment} >= {before} AND {moment} <= closing THEN {moment} END AS {name} FROM"


_ORDERED = f"""
  SELECT user_id, user_segment, registered, returned, activated, set_up, habitual FROM (
    {_next_stage("habitual", "habito_dt", "set_up")} ({_next_stage("set_up", "setup_dt", "activated")} (
      SELECT s.*, (SELECT MIN(t.transaction_dt) FROM tx t WHERE t.user_id = s.user_id
                   AND t.transaction_dt >= s.returned AND t.transaction_dt <= s.closing) AS activated
      FROM ({_next_stage("returned", "return_dt", "registered")} (
        SELECT *, first_login_dt AS registered, CAST(CAST(first_login_dt AS DATE) + 30 AS TIMESTAMP) AS closing
        FROM onb_segment) a) s) b) c) d
"""
_ORDERED_STAGES = ("registered", "returned", "activated", "set_up", "habitual")


def _ordered_funnel() -> str:
    parts = []
    for i, name in enumerate(_ORDERED_STAGES):
        before = _ORDERED_STAGES[max(i - 1, 0)]
        wait = f"ROUND(SUM(date_sub('second', {before}, {name})) / (COUNT({name}) * 3600.0::DOUBLE), 2)" if i else "CAST(NULL AS DOUBLE)"
        parts.append(
            f"SELECT user_segment, {i + 1} AS stage_number, '{name}' AS stage, COUNT({name}) AS users,"
            f" COUNT({before}) - COUNT({name}) AS lost_from_previous,"
            f" ROUND(COUNT({name})::DOUBLE / NULLIF(COUNT(registered), 0)::DOUBLE * 100, 2) AS percent_of_first,"
            f" ROUND(COUNT({name})::DOUBLE / NULLIF(COUNT({before}), 0)::DOUBLE * 100, 2) AS percent_of_previous,"
            f" {wait} AS mean_hours_from_previous FROM r GROUP BY user_segment"
        )
    return f"SELECT * FROM (WITH r AS ({_ORDERED}) " + " UNION ALL ".join(parts) + ") f"


_HITS = {
    "return": "drop_flag = 0",
    "activation": "activation_validated = 1",
    "setup": "setup_achieved = 1",
    "habit": "habit_validated = 1",
}


def _ab_lift() -> str:
    counts = " UNION ALL ".join(
        f"SELECT '{m}' AS metric, COUNT(*) FILTER (WHERE g = 'control') AS control_users,"
        f" COUNT(*) FILTER (WHERE g = 'control' AND {c}) AS control_hits,"
        f" COUNT(*) FILTER (WHERE g = 'treatment') AS treatment_users,"
        f" COUNT(*) FILTER (WHERE g = 'treatment' AND {c}) AS treatment_hits FROM (SELECT *, {_AB} AS g FROM um) u"
        for m, c in _HITS.items()
    )
    return f"""
SELECT metric, control_users, control_hits, treatment_users, treatment_hits,
       ROUND((q - p) * 100, 6) AS lift,
       ROUND(((q - p) - 1.959963984540054::DOUBLE * s) * 100, 6) AS lift_low,
       ROUND(((q - p) + 1.959963984540054::DOUBLE * s) * 100, 6) AS lift_high,
       ROUND(CASE WHEN e > 0 THEN (q - p) / e END, 6) AS z,
       COALESCE(CASE WHEN e > 0 THEN ABS((q - p) / e) > 1.959963984540054::DOUBLE END, FALSE) AS differs
FROM (SELECT *, SQRT(p * (1 - p) / n + q * (1 - q) / m) AS s, SQRT(b * (1 - b) * (1 / n + 1 / m)) AS e
      FROM (SELECT *, control_hits::DOUBLE / NULLIF(control_users, 0) AS p, treatment_hits::DOUBLE / NULLIF(treatment_users, 0) AS q,
                   NULLIF(control_users, 0)::DOUBLE AS n, NULLIF(treatment_users, 0)::DOUBLE AS m,
                   (control_hits + treatment_hits)::DOUBLE / NULLIF(control_users + treatment_users, 0) AS b
            FROM ({counts}) c) r) x"""


def _ab_bootstrap() -> str:
    steps, total = [], 0.0
    for k in range(12):
        total += math.exp(-1) / math.factorial(k)
        steps.append(f"CAST(u >= CAST('{total!r}' AS DOUBLE) AS INTEGER)")
    rates = " UNION ALL ".join(
        f"SELECT '{m}' AS metric, r, COALESCE(SUM(w) FILTER (WHERE g = 'treatment' AND {c}), 0)::DOUBLE / NULLIF(SUM(w) FILTER (WHERE g = 'treatment'), 0)"
        f" - COALESCE(SUM(w) FILTER (WHERE g = 'control' AND {c}), 0)::DOUBLE / NULLIF(SUM(w) FILTER (WHERE g = 'control'), 0) AS lift FROM drawn GROUP BY r"
        for m, c in {m: f"({c})" for m, c in _HITS.items()}.items()
    )
    return f"""
SELECT metric, COUNT(lift) AS replicates, ROUND(quantile_cont(lift, 0.025) * 100, 6) AS lift_low, ROUND(quantile_cont(lift, 0.975) * 100, 6) AS lift_high
FROM (WITH drawn AS (
        SELECT *, {" + ".join(steps)} AS w
        FROM (SELECT um.*, {_AB} AS g, r, ('0x' || substr(md5(user_id || ':' || CAST(r AS VARCHAR)), 1, 8))::BIGINT::DOUBLE / 4294967296 AS u
              FROM um, (SELECT unnest(range(1, 201)) AS r) n) x)
      {rates}) y GROUP BY metric"""


def oracles() -> dict[str, str]:
    segments_joined = (
        "SELECT s.user_id, g.user_segment, s.total_transactions, s.unique_transaction_types,"
        " s.transaction_days, s.first_transaction_dt, s.last_transaction_dt"
        " FROM segments g JOIN summary s ON g.user_id = s.user_id"
    )
    onboarding_profile = _profile("onboarding_raw", _ONBOARDING_COLUMNS, ["habito"])
    habit_agrees = "CAST(CASE WHEN habito = habit_achieved_calculated THEN 1 ELSE 0 END AS INTEGER)"
    activation_agrees = "CAST(CASE WHEN activacion = has_transactions THEN 1 ELSE 0 END AS INTEGER)"
    found = {
        # cleaning
        "filter_prefix": _cleaned("SELECT * FROM t1"),
        "filter_key_format": _raw(
            "SELECT * FROM users_raw WHERE user_id <> '' AND regexp_matches(user_id, '^MLB[0-9]+$')"
        ),
        "filter_type_domain": _raw("SELECT * FROM transactions_raw WHERE type BETWEEN 1 AND 9"),
        "filter_segment_domain": _raw("SELECT * FROM transactions_raw WHERE segment IN (1, 2)"),
        "filter_date_range": _raw(
            "SELECT * FROM transactions_raw WHERE transaction_dt BETWEEN"
            " TIMESTAMP '2024-01-01 00:00:00' AND TIMESTAMP '2024-01-28 00:00:00'"
        ),
        "clean_users": _cleaned("SELECT * FROM users_clean"),
        "clean_transactions": _cleaned("SELECT * FROM t5"),
        "clean_onboarding": _cleaned("SELECT * FROM o3"),
        "normalize_text": (
            "SELECT doc_id, replace(text, chr(10), ' ') AS single_line,"
            " regexp_replace(text, '[ \\t\\n\\x0B\\f\\r]+', ' ', 'g') AS normalized FROM documents"
        ),
        "cleaning_ledger_users": _ledger(
            [("id_prefix", "users_raw", "u1"), ("id_present", "u1", "u2"), ("id_format", "u2", "u3")]
        ),
        "cleaning_ledger_transactions": _ledger(
            [
                ("id_prefix", "transactions_raw", "t1"),
                ("type_domain", "t1", "t2"),
                ("segment_domain", "t2", "t3"),
                ("time_present", "t3", "t4"),
                ("date_range", "t4", "t5"),
            ]
        ),
        "cleaning_ledger_onboarding": _ledger(
            [
                ("id_prefix", "onboarding_typed", "o1"),
                ("time_present", "o1", "o2"),
                ("date_range", "o2", "o3"),
            ]
        ),
        # quality
        "quality_profile_events": _profile(
            "events", ["event_id", "ts", "user_id", "event_type", "value", "props"], ["value"]
        ),
        "quality_profile_onboarding": _raw(onboarding_profile),
        "quality_gate": _raw(
            "SELECT column_name, missing_percentage,"
            " CAST(CASE WHEN missing_percentage <= 10 THEN 1 ELSE 0 END AS INTEGER) AS passes"
            f" FROM ({onboarding_profile}) p"
        ),
        "invalid_counts": _raw(
            "SELECT 'users' AS dataset, 'id_prefix' AS rule, COUNT(*) AS invalid_rows"
            " FROM users_raw WHERE NOT user_id LIKE 'MLB%'"
            " UNION ALL SELECT 'transactions', 'type_domain', COUNT(*)"
            " FROM transactions_raw WHERE type NOT BETWEEN 1 AND 9"
            " UNION ALL SELECT 'transactions', 'segment_domain', COUNT(*)"
            " FROM transactions_raw WHERE segment NOT IN (1, 2)"
        ),
        "unreadable_counts": _raw(
            " UNION ALL ".join(
                f"SELECT '{table}' AS dataset, '{column}' AS column_name, COUNT(*) AS unreadable_rows"
                f" FROM {table}_raw WHERE {bad}"
                for table, column, bad in (
                    ("users", "type", "type IS NOT NULL AND TRY_CAST(NULLIF(TRIM(type), '') AS DOUBLE) IS NULL"),
                    ("users", "rubro", "rubro IS NOT NULL AND TRY_CAST(NULLIF(TRIM(rubro), '') AS DOUBLE) IS NULL"),
                    ("transactions", "transaction_dt", "FALSE"),
                    ("transactions", "type", "FALSE"),
                    ("transactions", "segment", "FALSE"),
                    ("onboarding", "first_login_dt", "FALSE"),
                    ("onboarding", "habito", "habito NOT IN (0, 1)"),
                    ("onboarding", "activacion", "activacion NOT IN (0, 1)"),
                    ("onboarding", "setup", "setup NOT IN (0, 1)"),
                    ("onboarding", "return", '"return" NOT IN (0, 1)'),
                )
            )
        ),
        "row_counts": _raw(
            "SELECT 'users' AS dataset, COUNT(*) AS row_count FROM users_raw"
            " UNION ALL SELECT 'transactions', COUNT(*) FROM transactions_raw"
            " UNION ALL SELECT 'onboarding', COUNT(*) FROM onboarding_raw"
        ),
        "duplicate_rows": _raw(
            " UNION ALL ".join(
                [
                    _duplicates("users", "users_raw", "*"),
                    _duplicates(
                        "transactions", "transactions_raw", "user_id, transaction_dt, type, segment"
                    ),
                    _duplicates("onboarding", "onboarding_raw", "*"),
                ]
            )
        ),
        "prefix_share": _raw(
            " UNION ALL ".join(
                [
                    _prefixed("users", "users_raw"),
                    _prefixed("transactions", "transactions_raw"),
                    _prefixed("onboarding", "onboarding_raw"),
                ]
            )
        ),
        "overlap_counts": _cleaned(_overlaps("users_clean", "t5", "o3")),
        "coverage_ratios": _cleaned(
            "SELECT users_count,"
            " CAST(users_onboarding_overlap AS DOUBLE) / CAST(users_count AS DOUBLE) * 100 AS onboarding_coverage,"
            " CAST(users_transactions_overlap AS DOUBLE) / CAST(users_count AS DOUBLE) * 100 AS transaction_coverage"
            f" FROM ({_overlaps('users_clean', 't5', 'o3')}) c"
        ),
        "membership_regions": _raw(
            "SELECT in_users, in_transactions, in_onboarding, COUNT(*) AS user_count FROM ("
            "SELECT user_id, MAX(u) AS in_users, MAX(t) AS in_transactions, MAX(o) AS in_onboarding FROM ("
            "SELECT user_id, 1 AS u, 0 AS t, 0 AS o FROM users_raw"
            " UNION ALL SELECT user_id, 0, 1, 0 FROM transactions_raw"
            " UNION ALL SELECT user_id, 0, 0, 1 FROM onboarding_raw) a GROUP BY user_id) b"
            " GROUP BY 1, 2, 3"
        ),
        "flag_totals": _raw(
            " UNION ALL ".join(_flag_total(f) for f in ("habito", "activacion", "setup", "return_flag"))
        ),
        "date_ranges": _raw(
            "SELECT 'transactions' AS dataset, MIN(transaction_dt) AS min_dt, MAX(transaction_dt) AS max_dt"
            " FROM transactions_raw"
            " UNION ALL SELECT 'onboarding', MIN(first_login_dt), MAX(first_login_dt) FROM onboarding_raw"
        ),
        "dist_type": _raw(
            "SELECT type, COUNT(*) AS row_count FROM transactions_raw GROUP BY type ORDER BY type"
        ),
        "dist_segment": _raw(
            "SELECT segment, COUNT(*) AS row_count FROM transactions_raw GROUP BY segment ORDER BY segment"
        ),
        "dist_segment_type": _raw(
            "SELECT segment, type, COUNT(*) AS row_count FROM transactions_raw"
            " GROUP BY segment, type ORDER BY segment, type"
        ),
        "preview_transactions": _raw("SELECT * FROM tx ORDER BY transaction_dt, event_id LIMIT 10"),
        # sets and joins
        "distinct_user_types": _raw("SELECT DISTINCT user_id, type FROM tx"),
        "only_payment_users": _raw(
            "SELECT user_id FROM tx WHERE type BETWEEN 1 AND 7"
            " EXCEPT SELECT user_id FROM tx WHERE type IN (8, 9)"
        ),
        "users_without_transactions": _raw(
            "SELECT user_id FROM onboarding_raw EXCEPT SELECT user_id FROM tx"
        ),
        "outer_join_families": _measured("SELECT * FROM families"),
        "tx_by_family": _raw(
            "SELECT user_id, COUNT(*) FILTER (WHERE type BETWEEN 1 AND 7) AS payments,"
            " COUNT(*) FILTER (WHERE type IN (8, 9)) AS collections FROM tx GROUP BY user_id"
        ),
        "union_habit_parts": _measured("SELECT * FROM habit_parts"),
        "dedupe_onboarding": _measured("SELECT * FROM onb"),
        "window_transactions": _measured(
            "SELECT event_id, user_id, transaction_dt, type, first_login_dt FROM inside"
        ),
        "users_with_segment": _measured(
            "SELECT user_id, first_login_dt, user_segment FROM onb_segment"
        ),
        # metrics
        "transaction_summary_user": _measured("SELECT * FROM summary"),
        "user_segments": _measured(segments_joined),
        "segment_counts": _measured(
            "SELECT user_segment, COUNT(*) AS user_count FROM segments GROUP BY user_segment"
        ),
        "segmentation_profile": _measured(
            "SELECT (SELECT COUNT(*) FROM families WHERE has_collections = 0) AS only_payment_users,"
            " (SELECT COUNT(DISTINCT user_id) FROM tx WHERE type IN (8, 9)) AS seller_users,"
            " (SELECT COUNT(DISTINCT user_id) FROM tx) AS transacting_users,"
            " (SELECT COUNT(*) FROM (SELECT user_id FROM onboarding_raw EXCEPT SELECT user_id FROM tx) e)"
            " AS users_without_transactions"
        ),
        "onboarding_period": _measured(
            "SELECT user_id, first_login_dt AS period_start,"
            " first_login_dt + INTERVAL '30' DAY AS period_end,"
            " CAST(first_login_dt AS DATE) + 30 AS onboarding_end_dt FROM onb"
        ),
        "drop_metric": _measured(
            "SELECT user_id, first_login_dt, return_flag, return_dt,"
            " CAST(CASE WHEN return_flag = 1 THEN 0 ELSE 1 END AS INTEGER) AS drop_flag FROM onb"
        ),
        "activation_metric": _measured(
            "SELECT *, CAST(CASE WHEN activacion = 1 AND has_transactions = 1 THEN 1"
            " WHEN activacion = 0 AND has_transactions = 0 THEN 0 ELSE activacion END AS INTEGER)"
            f" AS activation_validated, {activation_agrees} AS activation_agrees FROM activation"
        ),
        "activation_agreement": _measured(
            "SELECT activacion, has_transactions, COUNT(*) AS users,"
            f" MAX({activation_agrees}) AS agrees FROM activation GROUP BY 1, 2"
        ),
        "habit_metric": _measured(
            "SELECT *, CAST(CASE WHEN habito = 1 AND habit_achieved_calculated = 1 THEN 1"
            " WHEN habito = 0 AND habit_achieved_calculated = 0 THEN 0 ELSE habito END AS INTEGER)"
            f" AS habit_validated, {habit_agrees} AS habit_agrees FROM habit"
        ),
        "habit_agreement": _measured(
            "SELECT user_segment, habito, habit_achieved_calculated, COUNT(*) AS users,"
            f" MAX({habit_agrees}) AS agrees FROM habit GROUP BY 1, 2, 3"
        ),
        "habit_by_segment": _measured(
            "SELECT user_segment, COUNT(*) AS total_users, CAST(SUM(habito) AS BIGINT) AS habit_achieved,"
            " CAST(SUM(habit_achieved_calculated) AS BIGINT) AS habit_computed,"
            " ROUND(CAST(SUM(habito) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) * 100, 2) AS habit_rate"
            " FROM habit GROUP BY user_segment"
        ),
        "setup_metric": _measured(
            "SELECT user_id, first_login_dt, setup, setup_dt, setup AS setup_achieved FROM onb"
        ),
        "user_metrics": _measured("SELECT * FROM um"),
        "metric_rates": _measured(
            " UNION ALL ".join(
                [
                    _rate("drop", "drop_flag"),
                    _rate("activation", "activation_validated"),
                    _rate("habit", "habit_validated"),
                    _rate("setup", "setup_achieved"),
                ]
            )
        ),
        # aggregates
        "funnel_stages": _measured(
            "SELECT user_id, user_segment, CAST(1 AS INTEGER) AS stage_1_registered,"
            " CAST(1 - drop_flag AS INTEGER) AS stage_2_returned,"
            " activation_validated AS stage_3_activated, setup_achieved AS stage_4_setup,"
            " habit_validated AS stage_5_habit FROM um"
        ),
        "funnel_overall": _measured(
            "SELECT COUNT(*) AS total_users, COUNT(*) AS registered,"
            " CAST(SUM(1 - drop_flag) AS BIGINT) AS returned,"
            " CAST(SUM(activation_validated) AS BIGINT) AS activated,"
            " CAST(SUM(setup_achieved) AS BIGINT) AS setup_completed,"
            " CAST(SUM(habit_validated) AS BIGINT) AS habit_achieved FROM um"
        ),
        "funnel_by_dimension": _measured(_SERVED_FUNNEL),
        "funnel_by_week": _measured(_funnel(_BY_SEGMENT, _BY_MONTH, _BY_WEEK)),
        "funnel_conversion": _measured(_conversion()),
        "monthly_metrics": _measured(_bucket("year_month", _MONTH)),
        "weekly_metrics": _measured(_bucket("year_week", _WEEK)),
        # published tables
        "contract_user_segments": _measured(
            "SELECT user_id, user_segment, CAST(total_transactions AS INTEGER) AS total_transactions,"
            " unique_transaction_types, CAST(transaction_days AS INTEGER) AS transaction_days,"
            f" first_transaction_dt, last_transaction_dt FROM ({segments_joined}) s"
        ),
        "contract_user_metrics": _measured(_USER_METRICS_CONTRACT),
        "contract_funnel_analysis": _measured(_SERVED_FUNNEL),
        "contract_monthly_metrics": _measured(_bucket("year_month", _MONTH)),
        "contract_weekly_metrics": _measured(_bucket("year_week", _WEEK)),
        "transaction_summary_daily": _raw(_DAILY),
        # specified extras
        "ab_groups": _measured(f"SELECT user_id, {_AB} AS ab_group FROM onb"),
        "ab_metrics": _measured(
            f"SELECT *, {_RATES} FROM (SELECT {_AB} AS ab_group, {_BUCKET_COUNTS} FROM um GROUP BY 1) c"
        ),
        "treatment_funnel": _measured(
            _funnel(
                _BY_SEGMENT, _BY_MONTH, source=f"(SELECT * FROM um WHERE {_AB} <> 'control') treated"
            )
        ),
        "drop_from_activity": _measured(
            "SELECT o.user_id, o.return_flag,"
            " CAST(CASE WHEN o.return_flag = 1 THEN 0 ELSE 1 END AS INTEGER) AS drop_flag,"
            " CAST(CASE WHEN EXISTS (SELECT 1 FROM tx t WHERE t.user_id = o.user_id"
            " AND CAST(t.transaction_dt AS DATE) > CAST(o.first_login_dt AS DATE)) THEN 0 ELSE 1 END AS INTEGER)"
            " AS drop_from_activity FROM onb o"
        ),
        "activation_in_window": _measured(
            "SELECT o.user_id, o.activacion, COUNT(i.event_id) AS window_transactions,"
            " CAST(CASE WHEN COUNT(i.event_id) > 0 THEN 1 ELSE 0 END AS INTEGER) AS activated_in_window"
            " FROM onb o LEFT JOIN inside i ON o.user_id = i.user_id GROUP BY o.user_id, o.activacion"
        ),
        # records of another width, removed rows
        "wrong_width_ledger": _wrong_width(
            " UNION ALL ".join(
                f"SELECT CAST({i} AS INTEGER) AS step, '{rule}' AS rule, COUNT(*) FILTER ({before}) AS rows_before,"
                f" COUNT(*) FILTER (({before}) AND NOT ({keep})) AS rows_removed, COUNT(*) FILTER (({before}) AND ({keep})) AS rows_after FROM w"
                for i, (rule, before, keep) in enumerate(_WIDTH_STEPS, start=1)
            )
        ),
        "wrong_width_records": _wrong_width("SELECT user_id, record FROM w WHERE NOT width"),
        "rejected_rows": _cleaned(" UNION ALL ".join(_REJECTED)),
        # stages in order, the experiment's answer, distinct users of any period
        "funnel_ordered_users": _measured(f"SELECT * FROM ({_ORDERED}) r"),
        "funnel_ordered": _measured(_ordered_funnel()),
        "ab_lift": _measured(_ab_lift()),
        "ab_bootstrap": _measured(_ab_bootstrap()),
        "active_users_monthly": _measured(
            "SELECT CAST(date_trunc('month', t.transaction_dt) AS DATE) AS month, s.user_segment,"
            " COUNT(*) AS transactions, COUNT(DISTINCT t.user_id) AS users, TRUE AS estimate_within_bound"
            " FROM tx t JOIN segments s ON t.user_id = s.user_id GROUP BY 1, 2"
        ),
        # files, sinks and the whole batch
        # A CSV field without text is NULL, quoted or not.
        "csv_users": _raw("SELECT user_id, NULLIF(type, '') AS type, NULLIF(rubro, '') AS rubro, address FROM users_raw"),
        "parsing_impact": _raw(
            "SELECT line_rows, record_rows,"
            " ROUND(CAST(line_rows - record_rows AS DOUBLE) / CAST(line_rows AS DOUBLE) * 100, 2) AS reduction_percent"
            " FROM (SELECT COUNT(*) AS record_rows,"
            " CAST(SUM(1 + LENGTH(address) - LENGTH(REPLACE(address, CHR(10), ''))) AS BIGINT) AS line_rows FROM users_raw) c"
        ),
        "content_check": _measured(
            "SELECT 'user_segments' AS table_name, COUNT(*) AS rows, CAST(0 AS BIGINT) AS problems FROM segments"
            f" UNION ALL SELECT 'transaction_summary', COUNT(*), CAST(0 AS BIGINT) FROM ({_DAILY}) d"
        ),
        # versioned tables
        "versioned_daily": _raw(_DAILY),
        "upserted_daily": _raw(_DAILY),
        "lookup_user_month": _raw(
            f"SELECT * FROM ({_DAILY}) d WHERE user_id = 'MLB5'"
            " AND transaction_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-31'"
        ),
    }
    found["fallback_segments"] = found["contract_user_segments"]
    found["batch_monthly_metrics"] = found["contract_monthly_metrics"]
    return found

"""The same results as SQL for DuckDB, written from the rules, not from the code."""

from __future__ import annotations

from salestrata.catalog.events_feed import (
    CHANNELS,
    DEVICES,
    FILE_FORMS,
    INGESTION_TS,
    MESSY_LINES,
    NUMBER_FORMS,
    PAYMENT_METHODS,
    SOURCE_FILENAME,
    TIME_FORMS,
    pick_form,
)

_SHAPE = "^[0-9]{4}-[0-9]{2}-[0-9]{2}([T ].*)?$"


def _list(values: tuple[str, ...]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


_FEED = f"""
feed AS (
  SELECT *, 1 + k % 5 AS qty, CAST(value AS DECIMAL(10,2)) AS price,
         CASE WHEN event_id % 20 = 0 THEN (event_id // 20) % 8 ELSE -1 END AS fault
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events)
),
lines AS (
  SELECT '{{'
    || CASE fault WHEN 0 THEN '"event_id": null, ' WHEN 7 THEN ''
       ELSE '"event_id": "E' || event_id || '", ' END
    || '"event_ts": "' || CASE WHEN fault = 1 THEN 'not-a-timestamp'
       ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' END || '"'
    || ', "order_id": "O' || event_id || '", "customer_id": ' || user_id
    || ', "session_id": "S' || user_id || '", "product_id": ' || k
    || ', "category": "' || event_type || '", "quantity": '
    || CASE fault WHEN 2 THEN '"two"' WHEN 3 THEN '0' ELSE CAST(qty AS VARCHAR) END
    || ', "unit_price": ' || price || ', "total_amount": '
    || CASE fault WHEN 4 THEN '"NaN"' WHEN 5 THEN 'null' WHEN 6 THEN '-1.0'
       ELSE CAST(CAST(price * qty AS DECIMAL(10,2)) AS VARCHAR) END
    || ', "currency": "USD", "payment_method": "'
    || {_list(PAYMENT_METHODS)}[CAST((event_id // 7) % {len(PAYMENT_METHODS)} AS INT) + 1]
    || '", "country": "C' || user_id % 13 || '", "device": "'
    || {_list(DEVICES)}[CAST((event_id // 7) % {len(DEVICES)} AS INT) + 1]
    || '", "marketing_channel": "'
    || {_list(CHANNELS)}[CAST((event_id // 3) % {len(CHANNELS)} AS INT) + 1] || '"}}' AS line
  FROM feed
),
raw_sales AS (SELECT CAST(line AS JSON) AS raw FROM lines)"""

_TEXT_KEYS = ("event_id", "order_id", "session_id", "category", "currency", "payment_method",
              "country", "device", "marketing_channel")


def _text(key: str) -> str:
    return f"json_extract_string(raw, '$.{key}')"


def _layers(literal: bool) -> str:
    """WITH clause up to ``classified`` and ``fact``."""
    scale = 0 if literal else 2
    no_id = "json_extract(raw, '$.event_id')" if literal else _text("event_id")
    texts = ", ".join(f"{_text(key)} AS {key}" for key in _TEXT_KEYS)
    ids = ", ".join(f"TRY_CAST({_text(key)} AS DECIMAL(38,0)) AS {key}"
                    for key in ("customer_id", "product_id", "quantity"))
    money = ", ".join(f"TRY_CAST({_text(key)} AS DECIMAL(38,{scale})) AS {key}"
                      for key in ("unit_price", "total_amount"))
    return f"""WITH {_FEED},
typed AS (
  SELECT raw, {texts}, {ids}, {money}, {no_id} IS NULL AS no_id,
    CASE WHEN regexp_matches(trim({_text('event_ts')}), '{_SHAPE}')
         THEN TRY_CAST(replace({_text('event_ts')}, '+00:00', '') AS TIMESTAMP) END AS event_ts
  FROM raw_sales
),
classified AS (
  SELECT *, CASE
    WHEN no_id THEN 'Missing event_id'
    WHEN event_ts IS NULL THEN 'Invalid event_ts'
    WHEN quantity IS NULL THEN 'Invalid quantity'
    WHEN quantity <= 0 THEN 'Non-positive quantity'
    WHEN total_amount IS NULL THEN 'Invalid total_amount'
    WHEN total_amount < 0 THEN 'Negative total_amount' END AS reason
  FROM typed
),
fact AS (
  SELECT event_id, event_ts, order_id, customer_id, session_id, product_id, category, quantity,
    CAST(unit_price AS DECIMAL(10,2)) AS unit_price,
    CAST(total_amount AS DECIMAL(10,2)) AS total_amount,
    currency, payment_method, country, device, marketing_channel,
    '{SOURCE_FILENAME}' AS source_filename, TIMESTAMP '{INGESTION_TS}' AS ingestion_ts
  FROM classified WHERE reason IS NULL
)
"""


_SALES = "count(*) AS total_sales"
_UNITS = "CAST(sum(quantity) AS BIGINT) AS total_units"
_REVENUE = "CAST(sum(total_amount) AS DECIMAL(20,2)) AS total_revenue"

_KEYS = ("event_id", "event_ts", "order_id", "customer_id", "session_id", "product_id", "category",
         "quantity", "currency", "payment_method", "country", "device", "marketing_channel")


def _per_profile() -> dict[str, str]:
    payload = ", ".join(f"{_text(key)} AS {key}" for key in _KEYS)
    payload_money = ", ".join(f"TRY_CAST({_text(key)} AS DECIMAL(38,2)) AS {key}"
                              for key in ("unit_price", "total_amount"))
    book = " UNION ALL ".join(
        f"SELECT '{report}' AS report, {key} AS key, {_SALES}, {_UNITS}, {_REVENUE} "
        f"FROM fact GROUP BY 2"
        for report, key in (("daily", "CAST(CAST(event_ts AS DATE) AS VARCHAR)"),
                            ("category", "category"), ("payment_method", "payment_method"),
                            ("country", "country"), ("marketing_channel", "marketing_channel")))
    flags = " UNION ALL ".join(
        f"SELECT '{reason}' AS reason, count(*) FILTER (WHERE {broken}) AS n_broken FROM typed"
        for reason, broken in (("Missing event_id", "no_id"),
                               ("Invalid event_ts", "event_ts IS NULL"),
                               ("Invalid quantity", "quantity IS NULL"),
                               ("Non-positive quantity", "quantity <= 0"),
                               ("Invalid total_amount", "total_amount IS NULL"),
                               ("Negative total_amount", "total_amount < 0")))
    layer_counts = ("SELECT {n} * count(*) AS raw_rows, {n} * count(*) FILTER (WHERE reason IS NULL) "
                    "AS clean_rows, {n} * count(*) FILTER (WHERE reason IS NOT NULL) AS reject_rows, "
                    "{n} * count(*) FILTER (WHERE reason IS NULL) AS fact_rows FROM classified")
    layer_counts = (f"SELECT *, raw_rows = clean_rows + reject_rows AND fact_rows = clean_rows AS balanced "
                    f"FROM ({layer_counts})")
    return {
        "clean_count": "SELECT count(*) AS clean_rows FROM fact",
        "reject_count": "SELECT count(*) AS reject_rows FROM classified WHERE reason IS NOT NULL",
        "fact_count": "SELECT count(*) AS fact_rows FROM fact",
        "reject_reasons": "SELECT reason, count(*) AS n FROM classified WHERE reason IS NOT NULL "
                          "GROUP BY reason ORDER BY n DESC, reason",
        "daily_summary": "SELECT date_trunc('day', event_ts)::TIMESTAMP AS day, count(*) AS events, "
                         "CAST(sum(quantity) AS BIGINT) AS units, "
                         "CAST(sum(total_amount) AS DECIMAL(20,2)) AS revenue "
                         "FROM fact GROUP BY 1 ORDER BY 1",
        "q1_daily_revenue": f"SELECT date_trunc('day', event_ts)::TIMESTAMP AS day, {_SALES}, "
                            f"{_REVENUE} FROM fact GROUP BY 1 ORDER BY 1",
        "q2_category_revenue": f"SELECT category, {_SALES}, {_UNITS}, {_REVENUE} FROM fact "
                               "GROUP BY category ORDER BY total_revenue DESC, category",
        "q3_payment_methods": f"SELECT payment_method, {_SALES}, {_REVENUE} FROM fact "
                              "GROUP BY payment_method ORDER BY total_sales DESC, payment_method",
        "q4_top_countries": f"SELECT country, {_SALES}, {_REVENUE} FROM fact GROUP BY country "
                            "ORDER BY total_revenue DESC, country ASC NULLS LAST LIMIT 10",
        "q5_marketing_channels": f"SELECT marketing_channel, {_SALES}, {_REVENUE} FROM fact "
                                 "GROUP BY marketing_channel "
                                 "ORDER BY total_revenue DESC, marketing_channel",
        "reconciliation": layer_counts.format(n=1),
        "stg_sales_clean": "SELECT * FROM fact",
        "stg_sales_rejects": f"SELECT reason, {payload}, {payload_money}, "
                             f"'{SOURCE_FILENAME}' AS source_filename, "
                             f"TIMESTAMP '{INGESTION_TS}' AS ingestion_ts "
                             "FROM (SELECT raw, reason FROM classified WHERE reason IS NOT NULL)",
        "fact_sales": "SELECT * FROM fact",
        "report_book": book,
        "rule_flags": flags,
        "layer_tables": layer_counts.format(n=2),
        "layer_reports": "SELECT category, 2 * count(*) AS total_sales, "
                         "CAST(2 * sum(quantity) AS BIGINT) AS total_units, "
                         "CAST(2 * sum(total_amount) AS DECIMAL(20,2)) AS total_revenue "
                         "FROM fact GROUP BY category",
    }


# kind of line: records of one, whether it is blank, whether it is bad
_KINDS = """
WITH kinds AS (
  SELECT ['object', 'broken', 'blank', 'array', 'repeated key', 'number', 'null', 'non-ascii',
     'empty array', 'two objects', 'trailing text', 'trailing comma', 'two numbers',
     'single quotes', 'not a number'][CAST(event_id % 15 AS INT) + 1] AS kind
  FROM events),
files AS (
  SELECT kind AS source_filename, count(*) AS n_lines,
    count(*) * CASE WHEN kind = 'array' THEN 3 WHEN kind IN ('object', 'number', 'null', 'non-ascii') THEN 1 ELSE 0 END AS n_records,
    count(*) FILTER (WHERE kind = 'blank') AS n_blank,
    count(*) FILTER (WHERE kind IN ('broken', 'repeated key', 'two objects', 'trailing text', 'trailing comma',
                                    'two numbers', 'single quotes', 'not a number')) AS n_bad
  FROM kinds GROUP BY kind)
SELECT '20260101' AS load_day, '20260101-messy' AS load_id, * FROM files
UNION ALL
SELECT '20260101', '20260101-messy', NULL, CAST(sum(n_lines) AS BIGINT), CAST(sum(n_records) AS BIGINT),
  CAST(sum(n_blank) AS BIGINT), CAST(sum(n_bad) AS BIGINT) FROM files"""

def _messy(part: int) -> str:
    """The kind or the text of the line that an event makes."""
    whens = " ".join(f"WHEN {i} THEN " + (f"'{line[0]}'" if part == 0 else line[1].replace("cast(event_id % 3 as int)", "event_id % 3"))
                     for i, line in enumerate(MESSY_LINES))
    return f"CASE event_id % {len(MESSY_LINES)} {whens} END"


_MESSY_KIND, _MESSY_TEXT = _messy(0), _messy(1)

_ISO = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')"
# A time keeps its wall clock: the offset is cut off before the cast.
_SAFE_TIME = (f"CASE WHEN regexp_matches(trim(text), '{_SHAPE}') THEN TRY_CAST("
              "regexp_replace(trim(text), '(T.*)[+-][0-9]{2}:[0-9]{2}$', '\\1') AS TIMESTAMP) END")

_SINGLE = {
    "json_access": """
SELECT row_id, json_extract(va, '$.a') IS NULL AS a_is_absent,
  json_extract_string(va, '$.a') AS a_text, json_extract_string(vb, '$.n') AS n_text,
  json_extract_string(vb, '$.flag') AS flag_text, json_extract(vb, '$.a') IS NULL AS other_case_is_absent,
  CAST(json(json_extract(vb, '$.o')) AS VARCHAR) AS object_text
FROM (
  SELECT event_id AS row_id,
    CAST(CASE event_id % 3 WHEN 0 THEN '{}' WHEN 1 THEN '{"a": null}'
      ELSE '{"a": "E' || event_id || '"}' END AS JSON) AS va,
    CAST('{"n": ' || event_id || ', "flag": ' || (event_id % 2 = 0) || ', "A": 1, "o": ' || props || '}'
      AS JSON) AS vb
  FROM events)""",
    "strip_outer_array": """
SELECT event_id AS row_id, json_extract_string(props, '$.k') AS k, CAST(NULL AS VARCHAR) AS scalar
FROM (SELECT *, unnest(range(CASE event_id % 4 WHEN 3 THEN 1 ELSE event_id % 4 END)) FROM events)
UNION ALL
SELECT event_id, NULL, CAST(event_id AS VARCHAR) FROM events WHERE event_id % 4 <> 3""",
    "tolerant_load": """
WITH kinds AS (
  SELECT event_id,
    ['object', 'broken', 'blank', 'array', 'repeated key', 'number', 'null', 'non-ascii',
     'empty array', 'two objects', 'trailing text', 'trailing comma', 'two numbers',
     'single quotes', 'not a number'][CAST(event_id % 15 AS INT) + 1] AS line_kind
  FROM events)
SELECT line_kind,
  count(*) * CASE line_kind WHEN 'array' THEN 3 ELSE 1 END AS n_records,
  count(*) FILTER (WHERE line_kind IN ('object', 'array', 'non-ascii')) AS n_with_id,
  max(CASE WHEN line_kind IN ('object', 'array') THEN 'E' || event_id
           WHEN line_kind = 'non-ascii' THEN 'é-日本-' || event_id END) AS last_id
FROM kinds
WHERE line_kind IN ('object', 'array', 'number', 'null', 'non-ascii')
GROUP BY line_kind""",
    "safe_timestamps": f"""
SELECT row_id, text, event_ts, date_trunc('day', event_ts)::TIMESTAMP AS day
FROM (SELECT *, {_SAFE_TIME} AS event_ts
      FROM (SELECT event_id AS row_id, {pick_form(TIME_FORMS, iso=_ISO)} AS text FROM events))""",
    "safe_numbers": f"""
SELECT row_id, text, TRY_CAST(text AS DECIMAL(38,0)) AS whole,
  CAST(TRY_CAST(text AS DECIMAL(38,2)) AS DECIMAL(10,2)) AS money
FROM (SELECT event_id AS row_id, {pick_form(
        NUMBER_FORMS, price="CAST(CAST(value AS DECIMAL(10,2)) AS VARCHAR)",
        k="json_extract_string(props, '$.k')")} AS text FROM events)""",
    "store_paths": f"""
SELECT event_id AS row_id, {pick_form(FILE_FORMS)} AS uri,
  CASE event_id % 4
    WHEN 0 THEN 'raw/sales/dt=20260101/' || event_id || '.jsonl'
    WHEN 1 THEN 'raw/sales/dt=20260101/a b+' || event_id || '.jsonl'
    WHEN 2 THEN 'raw/sales/é%' || event_id
    WHEN 3 THEN 'raw//sales/' || event_id || ':1' END AS source_filename
FROM events""",
    "ingest_time": "SELECT count(*) AS n_records, count(*) AS n_recent, TRUE AS one_time FROM events",
    "money_overflow": f"""
WITH {_FEED},
totals AS (SELECT CAST(price * qty AS DECIMAL(10,2)) * 1000000 AS total FROM feed)
SELECT CASE WHEN total > 99999999.99 THEN 'Unknown validation error'
            WHEN total < 0 THEN 'Negative total_amount' END AS reason,
  count(*) AS n,
  CAST(max(CASE WHEN total BETWEEN 0 AND 99999999.99 THEN total END) AS DECIMAL(10,2)) AS largest_kept
FROM totals GROUP BY 1""",
    "jsonl_sink": f"""
WITH {_FEED}
SELECT 'raw/sales/dt=20260101' AS folder, TIMESTAMP '{INGESTION_TS}' AS ingestion_ts,
  count(*) AS n_records, count(*) FILTER (WHERE fault = 0) AS n_null_ids, CAST(0 AS BIGINT) AS n_absent_ids,
  min(ts) AS first_ts, max(ts) AS last_ts, CAST(sum(qty) AS BIGINT) AS units,
  CAST(sum(CAST(price * qty AS DECIMAL(10,2))) AS DECIMAL(20,2)) AS revenue
FROM feed""",
    "incremental_load": """
SELECT folder, count(*) AS n_records, CAST(1 AS BIGINT) AS n_loads
FROM events, (VALUES ('raw/sales/dt=20260101'), ('raw/sales/dt=20260102')) AS days(folder)
GROUP BY folder""",
    "load_counts": _KINDS,
    "bad_lines": f"""
SELECT '20260101-messy' AS load_id, source_filename, count(*) AS n_lines, min(value) AS first_line,
  CAST(sum(length(value)) AS BIGINT) AS n_chars
FROM (SELECT {_MESSY_TEXT} AS value, {_MESSY_KIND} AS source_filename FROM events)
WHERE source_filename IN ('broken', 'repeated key', 'two objects', 'trailing text', 'trailing comma',
                          'two numbers', 'single quotes', 'not a number')
GROUP BY source_filename""",
    "reconciliation_by_load": _layers(literal=False) + f"""
, sizes AS (
  SELECT count(*) AS n, count(*) FILTER (WHERE reason IS NULL) AS clean,
    (SELECT CAST(sum(n_records) AS BIGINT) FROM ({_KINDS}) WHERE source_filename IS NULL) AS messy
  FROM classified)
SELECT unnest(['20260101', '20260101', '20260102', '20260103']) AS load_day,
  unnest(['20260101-a', '20260101-b', '20260102-c', '20260103-d']) AS load_id,
  unnest([n, n, messy, n]) AS raw_rows, unnest([clean, clean, 0, clean]) AS clean_rows,
  unnest([n - clean, n - clean, messy, n - clean]) AS reject_rows, unnest([0, 2 * clean, 0, clean]) AS fact_rows,
  unnest([n, n, messy, NULL]) AS log_rows, unnest([FALSE, FALSE, TRUE, TRUE]) AS balanced
FROM sizes""",
    "rebuild_after_failure": _layers(literal=False) + """
SELECT TRUE AS failed, count(*) FILTER (WHERE reason IS NULL) AS clean_rows,
  count(*) FILTER (WHERE reason IS NOT NULL) AS reject_rows, count(*) FILTER (WHERE reason IS NULL) AS fact_rows
FROM classified""",
    "incremental_fact": _layers(literal=False) + """
SELECT category, 2 * count(*) AS total_sales, CAST(2 * sum(quantity) AS BIGINT) AS total_units,
  CAST(2 * sum(total_amount) AS DECIMAL(20,2)) AS total_revenue, TRUE AS first_load_kept
FROM fact GROUP BY category""",
    "catalog_tables": _layers(literal=False) + """
SELECT unnest(['raw.raw_sales', 'staging.stg_sales_clean', 'staging.stg_sales_rejects', 'analytics.fact_sales']) AS table_name,
  unnest([count(*), count(*) FILTER (WHERE reason IS NULL), count(*) FILTER (WHERE reason IS NOT NULL),
          count(*) FILTER (WHERE reason IS NULL)]) AS n_rows
FROM classified""",
    "incremental_split": _layers(literal=False) + """
SELECT coalesce(reason, 'clean') AS outcome, 2 * count(*) AS n,
  CAST(2 * sum(CASE WHEN reason IS NULL THEN total_amount END) AS DECIMAL(20,2)) AS revenue
FROM classified GROUP BY 1""",
}


def oracle_sql() -> dict[str, str]:
    named = {"raw_count": f"WITH {_FEED} SELECT count(*) AS total_raw_rows FROM raw_sales"}
    for suffix, literal in (("", False), ("__literal", True)):
        for name, select in _per_profile().items():
            named[name + suffix] = _layers(literal) + select
    return named | _SINGLE

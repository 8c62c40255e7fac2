"""The registered queries as SQL over the same tables, for checking results."""

from __future__ import annotations

from tidemark.plans.device_view import DEVICE_CONTRACT, DEVICE_CTE, EDGE_CTE, RENAME_MAP

_COLUMNS = DEVICE_CONTRACT.columns
_EPOCHS = DEVICE_CONTRACT.epoch_columns
_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def _q(name: str) -> str:
    return f'"{name}"'


def _local(column: str) -> str:
    return f"(make_timestamp({_q(column)}*1000) + INTERVAL 330 MINUTE)"


def _alarm(field: str) -> str:
    return f"json_extract_string(alarms, '$.{field}')"


_ALARMS = ", ".join(f"{_alarm(f)} AS {_q(o)}" for f, o in RENAME_MAP.items())
_LATENCIES = (
    'round(("pushedAt"-ts)/60000.0::DOUBLE,2) AS "timeLatency", '
    'round(("consumedAt"-"pushedAt")/60000.0::DOUBLE,2) AS "consumedLatency"'
)
_PARTS = (
    f"year({_local('ts')})::INTEGER AS year, month({_local('ts')})::INTEGER AS month, "
    f"day({_local('ts')})::INTEGER AS day, CAST({_local('ts')} AS DATE) AS insert_date"
)
_SILVER = ", ".join(f"{_local(c)} AS {_q(c)}" if c in _EPOCHS else _q(c) for c in _COLUMNS)
_SILVER_CTE = DEVICE_CTE + f", s AS (SELECT event_id, {_SILVER} FROM dev)"

_PLAIN = ", ".join(_q(c) for c in _COLUMNS if c not in ("ts", "alarms"))
_BRONZE_BODY = f"SELECT {_PLAIN}, {_local('ts')} AS ts, {_ALARMS}, {_LATENCIES}, {_PARTS}"
_BRONZE = DEVICE_CTE + f"{_BRONZE_BODY} FROM dev"

_BATCH = (
    "((event_id - (SELECT min(event_id) FROM events)) // "
    "(((SELECT max(event_id) - min(event_id) FROM events) + 5) // 5))"
)

_BMS = {
    "ts": "bmsLastTs", "lat": "bmsLastLat", "lon": "bmsLastLon", "voltage": "voltage", "soc": "soc",
    "current": "current", "temperature": "temperature", "cellVolt": "cellVolt",
    "cellTemp": "cellTemp", "alarms": "alarms",
}
_IOT = {"ts": "iotLastTs", "lat": "lat", "lon": "lon"}


def _newest(columns: dict[str, str], test: str) -> str:
    chosen = ", ".join(f"arg_max({_q(c)}, ts) AS {_q(o)}" for c, o in columns.items())
    return f'SELECT "deviceID", {chosen} FROM s WHERE {test} GROUP BY "deviceID"'


_BMS_LATEST = _newest(_BMS, "voltage > 0 AND voltage < 70")
_IOT_LATEST = _newest(_IOT, "lon > 0")
_LATEST = _SILVER_CTE + _newest({c: c for c in _COLUMNS if c != "deviceID"}, "true")

_COMBINED_CTE = _SILVER_CTE + (
    ', k AS (SELECT "deviceID", max(ts) AS ts FROM s GROUP BY "deviceID"), '
    f"b AS ({_BMS_LATEST}), i AS ({_IOT_LATEST})"
)
_BMS_OUT = ", ".join(f"b.{_q(o)}" for o in _BMS.values())
_COMBINED_FROM = 'FROM k LEFT JOIN b USING ("deviceID") LEFT JOIN i USING ("deviceID")'
_COMBINED = _COMBINED_CTE + (
    f'SELECT k."deviceID", k.ts, {_BMS_OUT}, i."iotLastTs", i.lat, i.lon {_COMBINED_FROM}'
)
_BMS_FLAT = ", ".join(f"b.{_q(o)}" for o in _BMS.values() if o != "alarms")
_COMBINED_FLAT = _COMBINED_CTE + (
    f'SELECT k."deviceID", k.ts, {_BMS_FLAT}, '
    + ", ".join(f"json_extract_string(b.alarms, '$.{f}') AS {_q(o)}" for f, o in RENAME_MAP.items())
    + f', i."iotLastTs", i.lat, i.lon {_COMBINED_FROM}'
)

# clocks beyond the calendar have no local time; NULLs come last in the order of newness
_FAR = "BETWEEN -62135596800000 AND 253402300799999"
_EDGE_SILVER = ", ".join(
    f"CASE WHEN {_q(c)} {_FAR} THEN {_local(c)} END AS {_q(c)}" if c in _EPOCHS else _q(c) for c in _COLUMNS)
_EDGE_BATCH = _BATCH
_EDGE_CTE = EDGE_CTE + f', es AS (SELECT {_EDGE_BATCH} AS batch, {_EDGE_SILVER} FROM edge WHERE "deviceID" IS NOT NULL)'


def _first(columns: list[str], test: str, by: str) -> str:
    """Newest row per key, ties going to the larger columns in order."""
    order = ", ".join(f"{_q(c)} DESC NULLS LAST" for c in columns)
    return (f"SELECT * FROM es WHERE {test} QUALIFY row_number() OVER (PARTITION BY {by} ORDER BY {order}) = 1")


_GROUPS = {
    "k": ({"ts": "ts"}, "true"),
    "b": (_BMS, "voltage > 0 AND voltage < 70"),
    "i": (_IOT, "lon > 0"),
}
_EDGE_OUT = ", ".join(f"{n}.{_q(c)} AS {_q(o)}" for n, (columns, _) in _GROUPS.items() for c, o in columns.items())
_EDGE_LATEST = _EDGE_CTE + (
    f"SELECT {', '.join(map(_q, _COLUMNS))} FROM ("
    + _first(["ts", *[c for c in _COLUMNS if c not in ("deviceID", "ts")]], "true", _q("deviceID")) + ")")
_EDGE_COMBINED = _EDGE_CTE + "".join(
    f", {n} AS ({_first(list(columns), test, _q('deviceID'))})" for n, (columns, test) in _GROUPS.items()) + (
    f' SELECT k."deviceID", {_EDGE_OUT} FROM k LEFT JOIN b USING ("deviceID") LEFT JOIN i USING ("deviceID")')
_EDGE_MERGED = _EDGE_CTE + ', d AS (SELECT DISTINCT "deviceID", batch FROM es)' + "".join(
    f", {n}w AS ({_first(list(columns), test, _q('deviceID') + ', batch')})"
    f', {n} AS (SELECT "deviceID", batch, {n}w.* EXCLUDE ("deviceID", batch) FROM d LEFT JOIN {n}w USING ("deviceID", batch) '
    f'QUALIFY row_number() OVER (PARTITION BY "deviceID" ORDER BY {n}w.ts DESC NULLS LAST, '
    f"CASE WHEN {n}w.ts IS NULL THEN -batch ELSE batch END) = 1)"
    for n, (columns, test) in _GROUPS.items()) + (
    f' SELECT k."deviceID", {_EDGE_OUT} FROM k LEFT JOIN b USING ("deviceID") LEFT JOIN i USING ("deviceID")')
_OUTCOMES = """
SELECT CASE WHEN event_type = 'error' THEN 'corrupt' ELSE 'good' END AS outcome, count(*) AS n_rows FROM events GROUP BY 1
"""
_LATE = _COMBINED.replace("FROM dev)", 'FROM dev WHERE event_id % 13 <> 0)')
_WARNINGS = """
WITH w AS (SELECT date_trunc('second', ts) AS logged_at, event_type,
  30000 + event_id % 9973 AS took, 1000 + event_id % 4001 AS kib FROM events WHERE event_type IN ('error', 'purchase')),
p AS (SELECT logged_at, CASE event_type WHEN 'error' THEN 'behind' ELSE 'task size' END AS kind,
  CASE event_type WHEN 'error' THEN 30000::BIGINT END AS trigger_ms, CASE event_type WHEN 'error' THEN took END AS took_ms,
  CASE event_type WHEN 'purchase' THEN kib END AS task_kib FROM w)
"""

_LINES = """
WITH lines AS (SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') || ',' ||
  lpad(((epoch_us(ts)//1000)%1000)::VARCHAR, 3, '0') || ' - ' || CASE event_type
  WHEN 'click' THEN 'INFO - [Bronze] Batch ' || event_id || ': written (4 files)'
  WHEN 'view' THEN 'INFO - [Silver] Batch ' || event_id || ': skipped (cadence 1-in-10)'
  WHEN 'signup' THEN 'INFO - [Silver] Batch ' || event_id || ' upserted'
  WHEN 'purchase' THEN 'INFO - Batch ' || event_id || ': empty, skipping.'
  ELSE 'ERROR - [Silver] Batch ' || event_id || ' FAILED (bronze succeeded): java.lang.IllegalStateException: stopped'
  END AS text FROM events)
"""

_GAPS = (
    DEVICE_CTE
    + ', gaps AS (SELECT "deviceID", ts, event_id, '
    'ts - lag(ts) OVER (PARTITION BY "deviceID" ORDER BY ts, event_id) AS gap_ms FROM dev)'
)

_ORDER_COPY = """
WITH l AS (SELECT * FROM orders),
r AS (SELECT o_orderkey,
  CASE WHEN o_orderpriority='1-URGENT' AND o_totalprice < 50000 THEN NULL ELSE o_custkey END AS o_custkey,
  CASE WHEN o_orderpriority='1-URGENT' AND o_orderstatus='P' THEN 'F' ELSE o_orderstatus END AS o_orderstatus,
  o_totalprice, o_orderdate, o_orderpriority FROM orders WHERE o_totalprice <= 450000)
"""
_LIFETIMES = """
WITH n AS (SELECT event_type AS "table", event_id AS snapshot_id, ts AS committed_at,
  lead(ts, 20) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS pushed_out FROM events),
life AS (SELECT "table", snapshot_id, committed_at,
  CASE WHEN pushed_out IS NOT NULL THEN greatest(committed_at + INTERVAL 6 HOUR, pushed_out) END AS expires_at,
  CASE WHEN pushed_out IS NULL THEN 'newest' WHEN pushed_out > committed_at + INTERVAL 6 HOUR THEN 'number' ELSE 'age' END AS kept_by
  FROM n)
"""
_ORDER_COLUMNS = ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]

_PARITY_COLUMNS = (
    _ORDER_COPY
    + "SELECT '(left only)' AS column_name, count(*) AS n_keys FROM l ANTI JOIN r USING (o_orderkey) "
    "UNION ALL SELECT '(right only)', count(*) FROM r ANTI JOIN l USING (o_orderkey) "
    "UNION ALL SELECT '(repeated key)', count(*) FROM "
    "(SELECT o_orderkey FROM l GROUP BY 1 HAVING count(*) > 1) "
    + " ".join(
        f"UNION ALL SELECT '{c}', count(*) FROM l JOIN r USING (o_orderkey) "
        f"WHERE l.{c} IS DISTINCT FROM r.{c}"
        for c in _ORDER_COLUMNS
    )
)


def oracle_sql() -> dict[str, str]:
    flags = (
        'SELECT event_id, CASE WHEN voltage > 0 AND voltage < 70 THEN 1 ELSE 0 END AS "isBMSValid", '
        'CASE WHEN lon > 0 THEN 1 ELSE 0 END AS "isIoTValid" FROM dev'
    )
    whole = ", ".join(
        f"CASE WHEN event_type = 'error' THEN NULL ELSE {_q(c)} END AS {_q(c)}" for c in _COLUMNS
    )
    return {
        "decode_permissive": """
            SELECT event_id, CASE WHEN json_valid(p) THEN
              try_cast(json_extract_string(p, '$.k') AS INTEGER) END AS k
            FROM (SELECT event_id, CASE WHEN event_type = 'error' THEN substr(props, 1, 3)
              ELSE props END AS p FROM events)""",
        "decode_device_rows": DEVICE_CTE
        + f"SELECT event_id, {whole}, CASE WHEN event_type = 'error' THEN 'corrupt' END AS reason FROM dev",
        "decode_outcomes": _OUTCOMES,
        "stream_progress": _OUTCOMES,
        "bronze_latency": DEVICE_CTE + f"SELECT event_id, {_LATENCIES} FROM dev",
        "bronze_time_parts": DEVICE_CTE + f"SELECT event_id, {_local('ts')} AS ts, {_PARTS} FROM dev",
        "silver_times": _SILVER_CTE + "SELECT event_id, " + ", ".join(map(_q, _EPOCHS)) + " FROM s",
        "alarms_json": DEVICE_CTE + f"SELECT event_id, {_ALARMS} FROM dev",
        "alarms_by_path": DEVICE_CTE + f"SELECT event_id, {_ALARMS} FROM dev",
        "alarms_struct": DEVICE_CTE
        + 'SELECT event_id, (event_id % 97)::VARCHAR AS "alarmK", (voltage > 70)::VARCHAR AS "overVoltage", '
        'NULL::VARCHAR AS "underTemp" FROM dev',
        "bronze_full": _BRONZE,
        "bronze_table": DEVICE_CTE + f"{_BRONZE_BODY}, {_BATCH}::BIGINT AS batch_id FROM dev",
        "bronze_compacted": DEVICE_CTE + f"{_BRONZE_BODY}, {_BATCH}::BIGINT AS batch_id FROM dev",
        "bronze_evolved": f"SELECT * REPLACE (CASE WHEN soc % 2 = 0 THEN temperature END AS temperature, "
        f'CASE WHEN soc % 2 = 0 THEN "overVoltage" END AS "overVoltage", CASE WHEN soc % 2 = 0 THEN "underTemp" END AS "underTemp"), '
        f'CASE WHEN soc % 2 <> 0 THEN "deviceID"::VARCHAR END AS firmware FROM ({_BRONZE})',
        "validity_flags": DEVICE_CTE + flags,
        "latest_per_device": _LATEST,
        "latest_row_number": _SILVER_CTE
        + f"SELECT {', '.join(map(_q, _COLUMNS))} FROM s "
        'QUALIFY row_number() OVER (PARTITION BY "deviceID" ORDER BY ts DESC) = 1',
        "bms_valid_latest": _SILVER_CTE + _BMS_LATEST,
        "iot_valid_latest": _SILVER_CTE + _IOT_LATEST,
        "silver_combined": _COMBINED,
        "silver_combined_onepass": _COMBINED,
        "silver_merge_valid": _COMBINED,
        "silver_merge_latest": _LATEST,
        "silver_merge_join": _COMBINED,
        "cadence_catchup": _COMBINED,
        "silver_table": _COMBINED,
        "silver_rebuild": _COMBINED_FLAT,
        "stream_bronze": _BRONZE,
        "stream_silver_valid": _COMBINED,
        "stream_silver_latest": _LATEST,
        "stream_chain_valid": _COMBINED,
        "stream_bronze_valid": _COMBINED_FLAT,
        "stream_stateful_valid": _COMBINED,
        "state_readback_valid": _COMBINED,
        "stream_seeded_valid": _COMBINED,
        "snapshot_expire_select": """
            SELECT "table", snapshot_id, committed_at FROM (
              SELECT event_type AS "table", event_id AS snapshot_id, ts AS committed_at,
                row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS n
              FROM events)
            WHERE n > 20 AND committed_at < TIMESTAMP '2024-01-30 00:00:00' - INTERVAL 6 HOUR""",
        "maintenance_schedule": """
            SELECT event_id AS batch_id, event_id % 10 = 0 AS runs_silver,
              CASE WHEN event_id % 10 = 0 THEN event_id // 10 END AS silver_run,
              event_id % 10 = 0 AND event_id // 10 > 0 AND (event_id // 10) % 6 = 0 AS runs_expiry
            FROM events""",
        "snapshot_growth": """
            SELECT "table", day, commits, CAST(sum(commits) OVER (PARTITION BY "table" ORDER BY day
              RANGE BETWEEN INTERVAL 4 DAY PRECEDING AND CURRENT ROW) AS BIGINT) AS retained
            FROM (SELECT event_type AS "table", CAST(ts AS DATE) AS day, count(*) AS commits
              FROM events GROUP BY 1, 2)""",
        "batch_log_parse": _LINES + """
            SELECT strptime(replace(substr(text, 1, 23), ',', '.'), '%Y-%m-%d %H:%M:%S.%g') AS logged_at,
              regexp_extract(text, ' - (INFO|WARNING|ERROR) - ', 1) AS level,
              nullif(regexp_extract(text, '\\[(Bronze|Silver|Expire)\\] Batch', 1), '') AS stage,
              regexp_extract(text, 'Batch ([0-9]+)', 1)::BIGINT AS batch_id,
              CASE WHEN contains(text, 'written') THEN 'written' WHEN contains(text, 'upserted') THEN 'upserted'
                WHEN contains(text, 'FAILED') THEN 'failed' WHEN contains(text, ': empty') THEN 'empty'
                ELSE 'skipped' END AS outcome,
              regexp_extract(text, 'Batch [0-9]+:? (.*)$', 1) AS detail
            FROM lines""",
        "batch_gaps": _GAPS + 'SELECT "deviceID", ts, event_id, gap_ms FROM gaps',
        "batch_lag_trend": _GAPS + """, p AS (
              SELECT "deviceID", ts // 86400000 AS period, count(*) AS n_batches,
                count(*) FILTER (gap_ms > 30000) AS n_behind, max(gap_ms) AS max_gap_ms,
                sum(gap_ms)::BIGINT AS gap_sum
              FROM gaps WHERE gap_ms IS NOT NULL GROUP BY 1, 2)
            SELECT "deviceID", period, n_batches, n_behind, max_gap_ms,
              gap_sum::DOUBLE / n_batches AS avg_gap_ms,
              (sum(gap_sum) OVER recent)::DOUBLE / (sum(n_batches) OVER recent)::DOUBLE AS trailing_gap_ms,
              coalesce(gap_sum::DOUBLE / n_batches > lag(gap_sum::DOUBLE / n_batches) OVER ordered, false) AS creeping
            FROM p WINDOW ordered AS (PARTITION BY "deviceID" ORDER BY period),
              recent AS (PARTITION BY "deviceID" ORDER BY period ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""",
        "error_scan": _LINES + """
            SELECT regexp_extract(text, '([A-Za-z0-9_.$]*(?:Error|Exception|Fail)[A-Za-z]*)', 1) AS error_class,
              count(*) AS n_lines
            FROM lines WHERE regexp_matches(text, '(Error|Exception|Fail)') GROUP BY 1""",
        "exit_codes": """
            SELECT code, reason, meaning, n_exits FROM (
              SELECT CASE event_type WHEN 'click' THEN 0 WHEN 'view' THEN 137 WHEN 'signup' THEN 143
                WHEN 'purchase' THEN 11 ELSE 1 END AS code, count(*) AS n_exits FROM events GROUP BY 1)
            LEFT JOIN (VALUES (0, 'Completed', 'clean shutdown'),
              (137, 'OOMKilled', 'container exceeded its memory limit'),
              (143, 'Error', 'container received SIGTERM'),
              (11, 'Error', 'driver application exit')) AS d(code, reason, meaning) USING (code)""",
        "parity_rows": _ORDER_COPY + """
            SELECT *, 1::BIGINT AS n_left_only, 0::BIGINT AS n_right_only FROM
              (SELECT * FROM l EXCEPT ALL SELECT * FROM r)
            UNION ALL
            SELECT *, 0::BIGINT AS n_left_only, 1::BIGINT AS n_right_only FROM
              (SELECT * FROM r EXCEPT ALL SELECT * FROM l)""",
        "parity_columns": _PARITY_COLUMNS,
        "parity_digest": _PARITY_COLUMNS,
        "snapshot_lifetimes": _LIFETIMES + "SELECT * FROM life",
        "snapshot_retained_curve": _LIFETIMES + """
            SELECT "table", "at", CAST(sum(sum(step)) OVER (PARTITION BY "table" ORDER BY "at") AS BIGINT) AS retained FROM (
              SELECT "table", committed_at AS "at", 1 AS step FROM life
              UNION ALL SELECT "table", expires_at, -1 FROM life WHERE expires_at IS NOT NULL)
            GROUP BY "table", "at" """,
        "behind_verdict": _WARNINGS + """,
            h AS (SELECT kind, epoch_ms(date_trunc('hour', logged_at))::HUGEINT // 1000 AS x,
              floor(sum(coalesce(took_ms, task_kib)) / count(*)::DOUBLE)::HUGEINT AS y FROM p GROUP BY ALL),
            s AS (SELECT a.kind, sum(sign(b.y - a.y))::BIGINT AS s FROM h a JOIN h b ON a.kind = b.kind AND a.x < b.x GROUP BY 1),
            t AS (SELECT kind, sum(c * (c - 1) * (2 * c + 5)) AS tied FROM (SELECT kind, y, count(*) AS c FROM h GROUP BY 1, 2) GROUP BY 1),
            m AS (SELECT kind, count(*) AS n, (count(*) * sum(x * y) - sum(x) * sum(y))::DOUBLE AS over,
              (count(*) * sum(x * x) - sum(x) * sum(x))::DOUBLE AS under FROM h GROUP BY 1),
            z AS (SELECT kind, n, coalesce(s, 0) AS s, over, under, (n * (n - 1) * (2 * n + 5) - tied)::DOUBLE / 18.0::DOUBLE AS variance
              FROM m JOIN t USING (kind) LEFT JOIN s USING (kind)),
            v AS (SELECT kind, n AS n_points, s, CASE WHEN variance > 0 THEN (s - sign(s)) / sqrt(variance) ELSE 0.0::DOUBLE END AS z,
              CASE WHEN under <> 0 THEN over / under * 3600 END AS slope FROM z)
            SELECT kind, n_points, s::BIGINT AS s, round(z, 6) AS z, round(slope, 6) AS slope_per_hour,
              CASE WHEN z > 1.959964 THEN 'creeping' WHEN z < -1.959964 THEN 'falling' ELSE 'flat' END AS verdict FROM v""",
        "error_traces": """
            SELECT date_trunc('millisecond', ts) AS logged_at, CASE event_type WHEN 'signup' THEN 'WARNING' ELSE 'ERROR' END AS level,
              CASE event_type WHEN 'click' THEN 'org.apache.spark.SparkException' WHEN 'error' THEN 'ValueError'
                ELSE 'java.net.SocketTimeoutException' END AS error_class,
              CASE event_type WHEN 'click' THEN 'java.io.IOException < java.lang.IllegalStateException' ELSE '' END AS causes,
              CASE event_type WHEN 'click' THEN 'java.lang.IllegalStateException' WHEN 'error' THEN 'ValueError'
                ELSE 'java.net.SocketTimeoutException' END AS root_class,
              CASE event_type WHEN 'click' THEN 6 + event_id % 4 WHEN 'error' THEN 5 + event_id % 4 ELSE 1 END AS n_lines,
              CASE event_type WHEN 'click' THEN 1 + event_id % 4 WHEN 'error' THEN 1 + event_id % 4 ELSE 0 END AS n_frames
            FROM events WHERE event_type IN ('click', 'error', 'signup')""",
        "run_summary": """
            WITH l AS (SELECT event_id % 3 AS job, date_trunc('millisecond', ts) AS logged_at, epoch_us(ts) // 1000 AS ms,
                CASE WHEN event_id % 97 <> 0 THEN event_id END AS batch_id,
                CASE WHEN event_id % 97 = 0 THEN [0, 137, 143, 11, 1][(event_id // 97) % 5 + 1] END AS code FROM events),
            g AS (SELECT *, coalesce(ms - lag(ms) OVER o > 1800000, false)::INTEGER AS silent,
                coalesce((lag(code) OVER o IS NOT NULL), false)::INTEGER AS after_exit
              FROM l WINDOW o AS (PARTITION BY job ORDER BY ms, code IS NOT NULL, batch_id, code)),
            r AS (SELECT *, sum(silent + after_exit) OVER (PARTITION BY job ORDER BY ms, code IS NOT NULL, batch_id, code
                ROWS UNBOUNDED PRECEDING) AS run FROM g),
            s AS (SELECT job, min(logged_at) AS started_at, max(logged_at) AS ended_at, count(batch_id) AS n_lines,
                arg_min(batch_id, (ms, batch_id)) FILTER (batch_id IS NOT NULL) AS first_batch,
                arg_max(batch_id, (ms, batch_id)) FILTER (batch_id IS NOT NULL) AS last_batch, max(code)::INTEGER AS code,
                (max(ms) - min(ms))::DOUBLE / 1000 AS length_s FROM r GROUP BY job, run)
            SELECT * FROM s LEFT JOIN (VALUES (0, 'Completed', 'clean shutdown'),
              (137, 'OOMKilled', 'container exceeded its memory limit'),
              (143, 'Error', 'container received SIGTERM'),
              (11, 'Error', 'driver application exit')) AS d(code, reason, meaning) USING (code)""",
        "decode_clock_edges": EDGE_CTE + f"""
            SELECT event_id, "deviceID", CASE WHEN ts {_FAR} THEN {_local('ts')} END AS ts, "pushedAt", "consumedAt",
              round((CASE WHEN event_id % 19 = 0 THEN "pushedAt"::HUGEINT - ts ELSE "pushedAt" - ts END)::DOUBLE / 60000.0::DOUBLE, 2) AS "timeLatency",
              round(CASE WHEN event_id % 19 = 0 AND event_id % 23 = 0 THEN NULL
                ELSE ("consumedAt"::HUGEINT - "pushedAt"::HUGEINT)::DOUBLE / 60000.0::DOUBLE END, 2) AS "consumedLatency",
              CASE WHEN "pushedAt" {_FAR} THEN {_local('pushedAt')} END AS pushed_local, NULL::VARCHAR AS reason
            FROM edge""",
        "latest_edges": _EDGE_LATEST,
        "latest_tiebreak": _EDGE_CTE.replace("AS batch, ", "AS batch, event_id, ", 1) + f"""
            SELECT {', '.join(map(_q, _COLUMNS))}, event_id FROM es
            QUALIFY row_number() OVER (PARTITION BY "deviceID" ORDER BY ts DESC NULLS LAST, event_id DESC) = 1""",
        "silver_combined_edges": _EDGE_COMBINED,
        "silver_merge_edges": _EDGE_MERGED,
        "silver_table_edges": _EDGE_MERGED,
        "stream_silver_late": _LATE,
        "alarms_full": EDGE_CTE + f"SELECT event_id, {_ALARMS} FROM edge",
        "batch_gaps_nulls": DEVICE_CTE + """
            SELECT "deviceID", ts, event_id, ts - lag(ts) OVER (PARTITION BY "deviceID" ORDER BY ts, event_id) AS gap_ms
            FROM (SELECT CASE WHEN event_id % 3 <> 0 THEN "deviceID" % 7 END AS "deviceID", ts, event_id FROM dev)""",
        "error_scan_classes": """
            SELECT CASE event_type WHEN 'click' THEN 'java.io.IOException' WHEN 'signup' THEN 'ValueError'
              WHEN 'purchase' THEN 'Failed' ELSE 'org.apache.spark.SparkException' END AS error_class, count(*) AS n_lines
            FROM events WHERE event_type <> 'view' GROUP BY 1""",
        "behind_lines": _WARNINGS + "SELECT logged_at, kind, trigger_ms, took_ms, task_kib FROM p",
        "behind_trend": _WARNINGS + """
            SELECT hour, n_behind, took / nullif(n_behind, 0)::DOUBLE AS avg_took_ms, max_took_ms, max_task_kib,
              coalesce(took / nullif(n_behind, 0)::DOUBLE > lag(took / nullif(n_behind, 0)::DOUBLE)
                OVER (PARTITION BY hour::DATE ORDER BY hour), false) AS rising
            FROM (SELECT date_trunc('hour', logged_at) AS hour, count(took_ms) AS n_behind, sum(took_ms)::DOUBLE AS took,
              max(took_ms) AS max_took_ms, max(task_kib) AS max_task_kib FROM p GROUP BY 1)""",
        "table_inventory": " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, (SELECT count(*) FROM {t}) AS n_rows, "
            f"(SELECT count(*) FROM (DESCRIBE {t}))::INTEGER AS n_columns"
            for t in _TABLES
        ),
    }

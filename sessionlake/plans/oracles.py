"""Reference SQL for each query of the catalogue, written for DuckDB over the same tables."""

from __future__ import annotations

# Session events of the `events` table, one row per event, payload as columns.
_M1 = """
m1 AS (
  SELECT event_id, ts,
    CASE event_type WHEN 'view' THEN 'start' WHEN 'purchase' THEN 'stop'
                    ELSE event_type END AS event_type,
    CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y%m%d') AS session_id,
    CAST(user_id AS VARCHAR) AS station_id,
    CAST(user_id AS VARCHAR) AS vehicle_id,
    strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS event_time,
    CASE WHEN event_type = 'purchase'
         THEN CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) END AS energy_delivered,
    CASE WHEN event_type = 'purchase'
         THEN regexp_extract(props, '"k": *([0-9]+)', 1) END AS duration_minutes
  FROM events
),
numbers AS (
  SELECT session_id, first_ts,
    row_number() OVER (ORDER BY first_ts, session_id) AS session_number
  FROM (SELECT session_id, min(ts) AS first_ts FROM m1 GROUP BY session_id)
),
m1n AS (
  SELECT m1.*, CAST(n.session_number AS INTEGER) AS session_number,
    CAST(greatest(ceil(n.session_number / 1000.0), 1) * 1000 AS BIGINT) AS session_number_range
  FROM m1 JOIN numbers n ON m1.session_id = n.session_id
)"""

_M2 = """
m2 AS (
  SELECT 'start' AS event_type, CAST(o_orderkey AS VARCHAR) AS session_id,
    CAST(o_custkey AS VARCHAR) AS station_id, CAST(o_custkey AS VARCHAR) AS vehicle_id,
    o_orderdate AS ts, CAST(NULL AS DOUBLE) AS energy, CAST(NULL AS DOUBLE) AS duration
  FROM orders
  UNION ALL
  SELECT 'stop', CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR),
    CAST(o_custkey AS VARCHAR), l_shipdate,
    CAST(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS DOUBLE),
    CAST(CAST(CAST(l_quantity AS DECIMAL(18,2)) AS VARCHAR) AS DOUBLE)
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)"""


def _sessions(events: str, energy: str, duration: str, start: str = "ts") -> str:
    """Session aggregate; the arguments are the (typed or text) values maximised."""
    return f"""
  SELECT session_id, station_id, vehicle_id,
    count(*) AS sessions_count,
    max(CASE WHEN event_type = 'start' THEN {start} END) AS start_time,
    max(CASE WHEN event_type = 'stop' THEN {start} END) AS stop_time,
    max({energy}) AS energy_delivered,
    max({duration}) AS duration_minutes,
    count(*) FILTER (event_type = 'start') AS start_events,
    count(*) FILTER (event_type = 'stop') AS completion_events
  FROM {events} GROUP BY session_id, station_id, vehicle_id"""


_M1_SESSIONS = _sessions(
    "m1", "TRY_CAST(energy_delivered AS DOUBLE)", "TRY_CAST(duration_minutes AS DOUBLE)"
)
_M2_SESSIONS = _sessions("m2", "energy", "duration")
_VALID = "start_events = 1 AND completion_events >= 1"
_SESSION_COLUMNS = (
    "session_id, station_id, vehicle_id, start_time, stop_time, energy_delivered, duration_minutes"
)


def _hour_key(value: str) -> str:
    return f"CAST(strftime({value}, '%Y%m%d%H') AS INTEGER)"


def _facts(sessions: str) -> str:
    return f"""
  SELECT session_id, station_id, vehicle_id,
    {_hour_key('start_time')} AS start_time_id,
    {_hour_key('stop_time')} AS end_time_id,
    CAST(CAST(energy_delivered AS FLOAT) AS DOUBLE) AS energy_delivered,
    CAST(CAST(duration_minutes AS FLOAT) AS DOUBLE) AS duration_minutes
  FROM ({sessions}) WHERE {_VALID}"""


_BATCH = "CASE WHEN ts >= TIMESTAMP '2024-01-16 12:00:00' THEN 1 ELSE 0 END"

_DECILES = ", ".join(f"0.{k}" for k in range(1, 10))


def _station_path(path: str, kind: str, n_values: str = "n", found: str | None = None, status: str = "ok") -> str:
    found = f"'{kind}'" if found is None else found
    return f"SELECT '$.{path}' AS path, {found} AS found, '{kind}' AS expected, {n_values} AS n_values, '{status}' AS status FROM s"


# What the paths of station documents have, by the counts in `s`.
_STATION_PATHS = " UNION ALL ".join(
    [
        "SELECT '$' AS path, 'object' AS found, 'object' AS expected, n AS n_values, 'ok' AS status FROM s",
        *[_station_path(p, "text") for p in ("_id", "availability", "chargerType", "maintenanceFrequency", "operator")],
        _station_path("stationId", "text", "stations"),
        _station_path("address", "text", "named"),
        _station_path("costPerKwh", "number", "costs"),
        _station_path("distanceToCity", "number"),
        *[_station_path(p, "integer") for p in ("chargingCapacity", "installationYear")],
        _station_path("renewableEnergySource", "boolean"),
        _station_path("location", "object"),
        _station_path("location.type", "text"),
        _station_path("location.coordinates", "array"),
        _station_path("location.coordinates[]", "number", "2 * n"),
        _station_path("connectorTypes", "array"),
        _station_path("connectorTypes[]", "text", "n + even"),
        _station_path("parkingSpots", "integer", "even"),
        _station_path("usageStats", "integer", "0", "NULL", "absent"),
        _station_path("rating", "number", "n", "'number|text'", "conflict"),
        "SELECT '$.note', 'text', NULL, notes, 'unknown' FROM s",
    ]
)

# The sessions and facts of the first of two batches.
_FIRST_SESSIONS = _sessions(
    f"(SELECT * FROM m1 WHERE {_BATCH} = 0)",
    "TRY_CAST(energy_delivered AS DOUBLE)",
    "TRY_CAST(duration_minutes AS DOUBLE)",
)
_FIRST_FACT = f"WITH {_M1}, fact AS ({_facts(_FIRST_SESSIONS)})"
_M1_FACT = f"WITH {_M1}, fact AS ({_facts(_M1_SESSIONS)})"
_M2_FACT = f"WITH {_M2}, fact AS ({_facts(_M2_SESSIONS)})"

_HOURS = """
  SELECT DISTINCT time_id FROM (
    SELECT start_time_id AS time_id FROM fact UNION ALL SELECT end_time_id FROM fact)"""


def _time_dim(ids: str, holiday: str = "0") -> str:
    return f"""
  SELECT time_id,
    CAST(date_part('hour', h) AS INTEGER) AS hour,
    CAST(date_part('day', h) AS INTEGER) AS day,
    CAST(date_part('month', h) AS INTEGER) AS month,
    CAST(date_part('year', h) AS INTEGER) AS year,
    CAST(date_part('isodow', h) - 1 AS INTEGER) AS day_of_week,
    CAST(CASE WHEN date_part('isodow', h) >= 6 THEN 1 ELSE 0 END AS INTEGER) AS is_weekend,
    CAST({holiday} AS INTEGER) AS is_holiday
  FROM (SELECT time_id, strptime(CAST(time_id AS VARCHAR), '%Y%m%d%H') AS h FROM ({ids}))"""


_DIM_STATION = """
  SELECT CAST(s_suppkey AS VARCHAR) AS id,
    s_name AS station_name,
    CAST(CAST(-90 + (s_suppkey * 17) % 180 AS FLOAT) AS DOUBLE) AS latitude,
    CAST(CAST(-180 + (s_suppkey * 37) % 360 AS FLOAT) AS DOUBLE) AS longitude,
    n_name AS address,
    'TYPE_' || CAST(s_suppkey % 3 AS VARCHAR) AS charger_type,
    CAST(CAST(s_acctbal AS DECIMAL(10,2)) AS DOUBLE) AS "costPerKwh",
    CAST(CAST(CAST(s_suppkey AS DOUBLE) / 2 AS FLOAT) AS DOUBLE) AS distance_to_city,
    'OP_' || CAST(s_suppkey % 5 AS VARCHAR) AS operator,
    CAST(50 + s_suppkey % 300 AS INTEGER) AS charging_capacity,
    CASE WHEN s_suppkey % 2 = 0 THEN 'CCS,Type 2' ELSE 'CHAdeMO' END AS connector_type,
    CAST(2010 + s_suppkey % 14 AS INTEGER) AS installation_year,
    s_suppkey % 2 = 0 AS renewable_energy_source,
    CAST(CAST(CAST(s_suppkey % 50 AS DOUBLE) / 10 AS FLOAT) AS DOUBLE) AS rating,
    CASE s_suppkey % 3 WHEN 0 THEN 'Annually' WHEN 1 THEN 'Quarterly'
                       ELSE 'Monthly' END AS maintenance_frequency,
    CAST(1 + s_suppkey % 10 AS INTEGER) AS parking_spot
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey"""

_DIM_VEHICLE = """
  SELECT CAST(p_partkey AS VARCHAR) AS id,
    p_name AS model,
    CAST(100 + p_partkey % 200 AS INTEGER) AS efficiency,
    CAST(p_partkey % 1000 AS INTEGER) AS fast_charge,
    CAST(100 + p_size * 10 AS INTEGER) AS range,
    CAST(120 + p_size AS INTEGER) AS top_speed,
    CAST(trunc(2 + CAST(p_partkey % 80 AS DOUBLE) / 10) AS INTEGER) AS acceleration_0_100,
    CAST(CAST(p_retailprice AS FLOAT) AS DOUBLE) AS battery_capacity
  FROM part"""


def _tagged(value: str) -> str:
    return (
        f"coalesce(CAST(length(CAST({value} AS VARCHAR)) AS VARCHAR) || ':' || "
        f"CAST({value} AS VARCHAR), '-')"
    )


def _surrogate(*parts: str) -> str:
    digest = "sha256(" + " || '|' || ".join(_tagged(p) for p in parts) + ")"
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return " || '-' || ".join(f"substr({digest}, {start}, {size})" for start, size in cuts)


_STATION_ATTRIBUTES = (
    ("station_name", "station_name", "''"),
    ("latitude", "station_latitude", "0"),
    ("longitude", "station_longitude", "0"),
    ("address", "station_address", "''"),
    ("charger_type", "charger_type", "''"),
    ('"costPerKwh"', "charging_cost", "0"),
    ("distance_to_city", "distance_to_city", "0"),
    ("operator", "station_operator", "''"),
    ("charging_capacity", "charging_capacity", "0"),
    ("connector_type", "connector_type", "''"),
    ("installation_year", "installation_year", "0"),
    ("renewable_energy_source", "renewable_energy_source", "false"),
    ("rating", "station_rating", "0"),
    ("maintenance_frequency", "maintenance_frequency", "''"),
)
_VEHICLE_ATTRIBUTES = (
    ("model", "vehicle_model", "''"),
    ("efficiency", "vehicle_efficiency", "0"),
    ("fast_charge", "vehicle_fast_charge", "0"),
    ("range", "vehicle_range", "0"),
    ("top_speed", "top_speed", "0"),
    ("acceleration_0_100", "acceleration_0_100", "0"),
)
_TIME_ATTRIBUTES = ("hour", "day", "month", "year", "day_of_week", "is_weekend", "is_holiday")


def _star(fact: str, defaults: bool = False) -> str:
    plain = {
        "charging_capacity": "DOUBLE",
        "installation_year": "DOUBLE",
        "renewable_energy_source": "VARCHAR",
    }

    def shown(alias: str, column: str, name: str, default: str) -> str:
        value = f"{alias}.{column}"
        if defaults:
            value = f"coalesce({value}, {default})"
        if name in plain:
            value = f"CAST({value} AS {plain[name]})"
        return f"{value} AS {name}"

    columns = [
        "f.session_id", "f.start_time_id", "f.end_time_id", "f.energy_delivered",
        "f.duration_minutes", "f.station_id", "f.vehicle_id",
        *[shown("s", *a) for a in _STATION_ATTRIBUTES],
        *[shown("v", *a) for a in _VEHICLE_ATTRIBUTES],
        *[shown("t1", a, f"start_{a}", "0") for a in _TIME_ATTRIBUTES],
        *[shown("t2", a, f"end_{a}", "0") for a in _TIME_ATTRIBUTES],
    ]
    return f"""{fact}, station AS ({_DIM_STATION}), vehicle AS ({_DIM_VEHICLE}),
dim_time AS ({_time_dim(_HOURS)})
SELECT {', '.join(columns)}
FROM fact f LEFT JOIN station s ON f.station_id = s.id
LEFT JOIN vehicle v ON f.vehicle_id = v.id
LEFT JOIN dim_time t1 ON f.start_time_id = t1.time_id
LEFT JOIN dim_time t2 ON f.end_time_id = t2.time_id"""


_CLOG = """
clog AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS commit_id, o_orderkey AS seq, 'main' AS branch,
    o_orderpriority AS message,
    o_orderstatus = 'F' AND o_orderkey >= 2 AS is_merge,
    CAST(o_orderkey - 1 AS VARCHAR) AS base, CAST(o_orderkey - 2 AS VARCHAR) AS tip
  FROM orders
),
cfiles AS (
  SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS commit_id,
    'charging-events/session_number_range=' || CAST(l_linenumber * 1000 AS VARCHAR) || '/part-'
      || CAST(l_linenumber AS VARCHAR)
      || CASE WHEN l_returnflag = 'N' THEN '.crc' ELSE '.parquet' END AS path
  FROM lineitem
)"""

_EVENT_FIELDS = (
    "event_type, session_id, session_number, station_id, vehicle_id, "
    "event_time, energy_delivered, duration_minutes"
)
_BRANCH_COMMITS = f"""
commits AS (
  SELECT batch_id, session_number_range,
    sha256('batch|' || CAST(batch_id AS VARCHAR) || '|' || CAST(session_number_range AS VARCHAR))
      AS commit_id
  FROM (SELECT DISTINCT CAST({_BATCH} AS BIGINT) AS batch_id, session_number_range FROM m1n)
)"""

# Messages with faults, as decoded: by event id modulo 50, cut short, no session, no number, twice.
_MESSAGES = """
messages AS (
  SELECT CASE fault WHEN 0 THEN 'malformed' WHEN 1 THEN 'null_key' WHEN 2 THEN 'null_key' END
      AS reason,
    CASE WHEN fault <> 0 THEN event_type END AS event_type,
    CASE WHEN fault NOT IN (0, 1) THEN session_id END AS session_id,
    CASE WHEN fault NOT IN (0, 2) THEN session_number END AS session_number,
    CASE WHEN fault <> 0 THEN station_id END AS station_id,
    event_time, session_number_range,
    CAST(CASE WHEN fault = 0 THEN 20 ELSE length(
      '{'
      || CASE WHEN fault <> 1 THEN '"session_id":"' || session_id || '",' ELSE '' END
      || CASE WHEN fault <> 2 THEN '"session_number":' || session_number || ',' ELSE '' END
      || '"station_id":"' || station_id || '","ev_id":"' || vehicle_id
      || '","event_type":"' || event_type || '","payload":{"timestamp":"' || event_time || '"'
      || CASE WHEN event_type = 'stop' THEN ',"energy_delivered":"' || energy_delivered
         || '","duration_minutes":"' || duration_minutes || '"' ELSE '' END
      || '}}') END AS BIGINT) AS raw_length
  FROM (SELECT *, event_id % 50 AS fault FROM m1n), range(2) copies(copy)
  WHERE copy = 0 OR fault = 3
)"""

_AUDIT_METRICS = """
    CAST(coalesce(sum(n), 0) AS BIGINT) AS n_rows,
    CAST(0 AS BIGINT) AS malformed_rows,
    CAST(coalesce(sum(CASE WHEN session_id IS NULL THEN n ELSE 0 END), 0) AS BIGINT) AS null_keys,
    CAST(coalesce(sum(CASE WHEN event_type = 'start' THEN n ELSE 0 END), 0) AS BIGINT)
      AS start_events,
    CAST(coalesce(sum(CASE WHEN event_type = 'stop' THEN n ELSE 0 END), 0) AS BIGINT)
      AS stop_events,
    CAST(coalesce(sum(CASE WHEN event_type NOT IN ('start', 'stop') THEN n ELSE 0 END), 0)
      AS BIGINT) AS other_events,
    CAST(coalesce(sum(CASE WHEN event_type IS NULL THEN n ELSE 0 END), 0) AS BIGINT)
      AS untyped_events,
    CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS repeated_events"""

_STATION_FROM_FILE = f"""
SELECT {_surrogate('s_name')} AS id, * EXCLUDE (id, address, s_name),
  address || ', ' || s_name AS address
FROM (SELECT *, station_name AS s_name FROM ({_DIM_STATION}))"""

_PART_TEXT = {
    "battery": "CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS VARCHAR)",
    "name": "p_name || ', ' || CAST(p_partkey AS VARCHAR)",
    "unused": "'-'",
    "efficiency": "CAST(100 + p_partkey % 200 AS VARCHAR)",
    "fast_charge": "CAST(p_partkey % 1000 AS VARCHAR)",
    "price": "CAST(p_partkey * 10 AS VARCHAR)",
    "range": "CAST(100 + p_size * 10 AS VARCHAR) || ' km'",
    "top_speed": "CAST(120 + p_size AS VARCHAR)",
    "acceleration":
        "CAST(CAST(2 + CAST(p_partkey % 80 AS DOUBLE) / 10 AS DECIMAL(18,2)) AS VARCHAR)",
}
_VEHICLE_FROM_FILE = f"""
SELECT {_surrogate(*[f'({v})' for v in _PART_TEXT.values()])} AS id,
  p_name || ', ' || CAST(p_partkey AS VARCHAR) AS model,
  CAST(100 + p_partkey % 200 AS INTEGER) AS efficiency,
  CAST(p_partkey % 1000 AS INTEGER) AS fast_charge,
  CAST(100 + p_size * 10 AS INTEGER) AS range,
  CAST(120 + p_size AS INTEGER) AS top_speed,
  CAST(trunc(2 + CAST(p_partkey % 80 AS DOUBLE) / 10) AS INTEGER) AS acceleration_0_100,
  CAST(CAST(p_retailprice AS FLOAT) AS DOUBLE) AS battery_capacity
FROM part"""


ORACLES: dict[str, str] = {
    "encode_decode_events": f"WITH {_M1} SELECT {_EVENT_FIELDS} FROM m1n",
    "session_numbers": f"WITH {_M1} SELECT session_id, first_ts, session_number FROM numbers",
    "session_numbers_in_two": f"""WITH {_M1},
        seen AS (
          SELECT session_id, min(CASE WHEN event_id % 3 = 0 THEN ts END) AS first_0,
            min(CASE WHEN event_id % 3 <> 0 THEN ts END) AS first_1
          FROM m1 GROUP BY session_id)
        SELECT session_id, CAST(first_0 IS NULL AS BIGINT) AS batch_id,
          row_number() OVER (ORDER BY first_0 IS NULL, coalesce(first_0, first_1), session_id)
            AS session_number
        FROM seen""",
    "range_bucket": """SELECT o_orderkey,
        CAST(greatest(ceil((o_orderkey - 5) / 1000.0), 1) * 1000 AS BIGINT) AS bucket
        FROM orders""",
    "batch_buckets": f"WITH {_M1} SELECT DISTINCT session_number_range FROM m1n",
    "batch_bucket_counts": f"""WITH {_M1}
        SELECT sha256('batch|0|' || CAST(session_number_range AS VARCHAR)) AS commit_id,
          session_number_range,
          'batch_' || CAST(session_number_range AS VARCHAR) AS branch,
          'Events of micro-batch 0, bucket ' || CAST(session_number_range AS VARCHAR) AS message,
          count(*) AS n_rows, CAST(0 AS BIGINT) AS batch_id
        FROM m1n GROUP BY session_number_range""",
    "stage_batch_roundtrip": f"""WITH {_M1}
        SELECT {_EVENT_FIELDS}, session_number_range, CAST({_BATCH} AS BIGINT) AS batch_id
        FROM m1n""",
    "decode_malformed": f"""WITH {_M1}, {_MESSAGES}
        SELECT reason, count(*) AS n_rows, count(*) FILTER (reason IS DISTINCT FROM 'malformed')
          AS n_payloads, min(raw_length) AS shortest
        FROM messages GROUP BY reason""",
    "staged_quarantine": f"""WITH {_M1}, {_MESSAGES}
        SELECT reason, event_type, session_id, CAST(session_number AS DOUBLE) AS session_number,
          station_id, raw_length, CAST(0 AS BIGINT) AS batch_id
        FROM messages WHERE reason IS NOT NULL""",
    "publish_with_bad_rows": f"""WITH {_M1}, {_MESSAGES}, groups AS (
          SELECT session_number_range, session_id, event_type, event_time, count(*) AS n
          FROM messages WHERE reason IS NULL GROUP BY ALL)
        SELECT session_number_range, CAST(sum(n) AS BIGINT) AS n_events,
          CAST(sum(CASE WHEN event_type = 'start' THEN n ELSE 0 END) AS BIGINT) AS start_events,
          CAST(sum(CASE WHEN event_type = 'stop' THEN n ELSE 0 END) AS BIGINT) AS stop_events,
          CAST(sum(CASE WHEN event_type NOT IN ('start', 'stop') THEN n ELSE 0 END) AS BIGINT)
            AS other_events,
          CAST(sum(n - 1) AS BIGINT) AS repeated_events
        FROM groups GROUP BY session_number_range""",
    "stream_ingest": f"""WITH {_M1}
        SELECT session_number_range, event_type, count(*) AS n_events, count(*) AS n_timed
        FROM m1n GROUP BY session_number_range, event_type""",
    "new_commits": f"""WITH {_CLOG}
        SELECT commit_id, seq, branch, message FROM clog
        WHERE commit_id NOT IN (SELECT CAST(o_orderkey AS VARCHAR) FROM orders
                                WHERE o_orderstatus = 'O')""",
    "merge_commits": f"WITH {_CLOG} SELECT commit_id, seq, base, tip FROM clog WHERE is_merge",
    "files_at": f"""WITH {_CLOG}
        SELECT c.commit_id, c.tip, f.path FROM clog c JOIN cfiles f ON f.commit_id = c.tip
        WHERE c.is_merge AND f.path LIKE '%.parquet'""",
    "files_added": f"""WITH {_CLOG}
        SELECT c.commit_id, c.tip, f.path, 'lake/' || c.tip || '/' || f.path AS address
        FROM clog c JOIN cfiles f ON f.commit_id = c.tip
        WHERE c.is_merge AND f.path LIKE '%.parquet'
          AND NOT EXISTS (SELECT 1 FROM cfiles b WHERE b.commit_id = c.base AND b.path = f.path)""",
    "as_of": """SELECT CAST(l_orderkey AS VARCHAR) AS commit_id, l_partkey, l_suppkey,
          l_linenumber, l_quantity
        FROM lineitem
        WHERE l_orderkey IN (SELECT o_orderkey FROM orders
                             WHERE o_orderkey <= (SELECT max(o_orderkey) // 2 FROM orders))""",
    "read_at_commit": f"""WITH {_M1}
        SELECT {_EVENT_FIELDS}, session_number_range FROM m1n WHERE {_BATCH} = 1""",
    "publish": f"""WITH {_M1}, {_BRANCH_COMMITS},
        tips AS (
          SELECT session_number_range, arg_max(commit_id, batch_id) AS tip
          FROM commits GROUP BY session_number_range)
        SELECT e.session_number_range, event_type, count(*) AS n_events,
          sha256('merge||' || any_value(tip)) AS commit_id
        FROM m1n e JOIN tips t ON e.session_number_range = t.session_number_range
        GROUP BY e.session_number_range, event_type""",
    "publish_in_two": f"""WITH {_M1}, {_BRANCH_COMMITS},
        first AS (SELECT max(sha256('merge||' || commit_id)) AS head FROM commits WHERE batch_id = 0)
        SELECT e.session_number_range, count(*) AS n_events,
          sha256('merge|' || CASE WHEN c.batch_id = 0 THEN '' ELSE head END || '|' || c.commit_id)
            AS commit_id
        FROM (SELECT *, {_BATCH} AS batch_id FROM m1n) e
        JOIN commits c ON c.batch_id = e.batch_id
          AND c.session_number_range = e.session_number_range, first
        GROUP BY e.session_number_range, c.batch_id, c.commit_id, head""",
    "compact_published": f"WITH {_M1} SELECT {_EVENT_FIELDS}, session_number_range FROM m1n",
    "scan_sample": "SELECT CAST(5 AS BIGINT) AS n_rows, CAST(5 AS BIGINT) AS n_known",
    "scan_audit": """SELECT event_type, count(*) AS n_events,
          (SELECT count(*) FROM events) AS rows_scanned
        FROM events GROUP BY event_type""",
    "audit_batch": f"""WITH {_M1}, groups AS (
          SELECT session_id, event_type, event_time, count(*) AS n FROM m1n GROUP BY ALL)
        SELECT {_AUDIT_METRICS}, count(*) > 0 AND count(session_id) = count(*) AS ok
        FROM groups""",
    "audit_by_bucket": f"""WITH {_M1}, groups AS (
          SELECT session_number_range, session_id, event_type, event_time, count(*) AS n
          FROM m1n GROUP BY ALL)
        SELECT session_number_range, {_AUDIT_METRICS},
          count(*) > 0 AND count(session_id) = count(*) AS ok
        FROM groups GROUP BY session_number_range""",
    "duplicate_keys": """SELECT l_orderkey, l_linenumber, count(*) AS n_rows
        FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "unique_orders": "SELECT o_orderkey, o_custkey FROM orders",
    "project_session_events": f"""WITH {_M1}
        SELECT event_id, session_id, event_type,
          CASE WHEN event_type = 'start' THEN event_time END AS start_time,
          CASE WHEN event_type = 'stop' THEN event_time END AS stop_time,
          energy_delivered, duration_minutes
        FROM m1""",
    "assemble_sessions": f"WITH {_M1} {_M1_SESSIONS}",
    "assemble_sessions_string_max": f"""WITH {_M1} {
        _sessions('m1', 'energy_delivered', 'duration_minutes', start='event_time')}""",
    "assemble_sessions_bulk": f"WITH {_M2} {_M2_SESSIONS}",
    "valid_sessions": f"""WITH {_M1}
        SELECT {_SESSION_COLUMNS} FROM ({_M1_SESSIONS}) WHERE {_VALID}""",
    "invalid_sessions": f"""WITH {_M1}
        SELECT {_SESSION_COLUMNS},
          concat_ws(',', CASE WHEN start_events = 0 THEN 'no_start' END,
            CASE WHEN start_events > 1 THEN 'multiple_starts' END,
            CASE WHEN completion_events = 0 THEN 'no_stop' END) AS reason
        FROM ({_M1_SESSIONS}) WHERE NOT ({_VALID})""",
    "session_quality": f"""WITH {_M1}
        SELECT count(*) AS total_sessions, count(*) FILTER ({_VALID}) AS valid_sessions,
          count(*) FILTER (NOT ({_VALID})) AS invalid_sessions
        FROM ({_M1_SESSIONS})""",
    "session_quality_bulk": f"""WITH {_M2}
        SELECT count(*) AS total_sessions, count(*) FILTER ({_VALID}) AS valid_sessions,
          count(*) FILTER (NOT ({_VALID})) AS invalid_sessions
        FROM ({_M2_SESSIONS})""",
    "time_id": f"""SELECT event_id, {_hour_key('ts')} AS time_id,
          {_hour_key('ts')} AS text_time_id FROM events""",
    "time_id_to_ts": "SELECT event_id, date_trunc('hour', ts) AS hour_start FROM events",
    "session_time_ids": f"{_M1_FACT} {_HOURS}",
    "time_dim": f"{_M1_FACT} {_time_dim(_HOURS)}",
    "time_dim_holidays": f"""{_M2_FACT}, calendar AS (
          SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders
          WHERE o_orderpriority = '1-URGENT')
        {_time_dim(
            _HOURS,
            'CASE WHEN CAST(h AS DATE) IN (SELECT day FROM calendar) THEN 1 ELSE 0 END',
        )}""",
    "merge_time_dim": f"""{_M1_FACT}, hours AS ({_HOURS})
        {_time_dim(f'''SELECT DISTINCT {_hour_key('ts')} AS time_id FROM events
            WHERE {_hour_key('ts')} NOT IN (SELECT time_id FROM hours)''')}""",
    "fact_sessions": f"{_M1_FACT} SELECT * FROM fact",
    "rejected_facts": f"""WITH {_M1}
        SELECT session_id, station_id, vehicle_id, 'bad_time' AS reason
        FROM ({_M1_SESSIONS}) WHERE {_VALID} AND date_part('day', stop_time) % 2 <> 0""",
    "fact_load_idempotent": f"{_M1_FACT} SELECT * FROM fact",
    "session_load_counts": f"""{_M1_FACT}, counts AS (
          SELECT count(*) AS total_sessions, count(*) FILTER ({_VALID}) AS valid_sessions,
            count(*) FILTER (NOT ({_VALID})) AS invalid_sessions
          FROM ({_M1_SESSIONS}))
        SELECT load, total_sessions, valid_sessions, invalid_sessions,
          CAST(0 AS BIGINT) AS rejected_facts,
          CASE WHEN load = 0 THEN (SELECT count(*) FROM fact) ELSE 0 END AS new_facts,
          CAST(0 AS BIGINT) AS removed_facts,
          CASE WHEN load = 0 THEN (SELECT count(*) FROM ({_HOURS})) ELSE 0 END AS new_hours
        FROM counts, range(2) loads(load)""",
    "load_in_two": f"{_M1_FACT} SELECT * FROM fact",
    "repeats_across_batches": f"""WITH {_M1},
        main AS (SELECT *, session_id || '|' || event_type || '|' || event_time AS event
                 FROM m1n WHERE {_BATCH} = 0),
        staged AS (
          SELECT session_number_range, session_id || '|' || event_type || '|' || event_time AS event
          FROM m1n WHERE {_BATCH} = 1 OR event_id % 5 = 0),
        found AS (
          SELECT session_number_range,
            CAST(count(*) FILTER (event IN (SELECT event FROM main)) AS BIGINT) AS published_repeats,
            count(*) AS n_staged
          FROM staged GROUP BY session_number_range)
        SELECT session_number_range, published_repeats,
          CASE WHEN n_first IS NULL AND published_repeats > 0 THEN NULL
            ELSE coalesce(n_first, 0) + CASE WHEN published_repeats = 0 THEN n_staged ELSE 0 END
            END AS n_main
        FROM found LEFT JOIN (SELECT session_number_range, count(*) AS n_first FROM main
                              GROUP BY session_number_range) USING (session_number_range)""",
    "batch_drift": f"""WITH {_M1},
        measured AS (
          SELECT {_BATCH} AS batch, session_number_range // 1000 % 2 = 1 AS enlarged,
            TRY_CAST(energy_delivered AS DOUBLE)
              * CASE WHEN {_BATCH} = 1 AND session_number_range // 1000 % 2 = 1 THEN 10 ELSE 1 END
              AS energy,
            TRY_CAST(duration_minutes AS DOUBLE) AS duration
          FROM m1n),
        deciles AS (
          SELECT enlarged, unnest([{_DECILES}]) AS p,
            unnest(quantile_disc(energy, [{_DECILES}])) AS energy,
            unnest(quantile_disc(duration, [{_DECILES}])) AS duration
          FROM measured WHERE batch = 1 GROUP BY enlarged),
        ranks AS (
          SELECT d.enlarged, d.p, avg((m.energy <= d.energy)::INT) AS e, avg((m.energy < d.energy)::INT) AS e_below,
            avg((m.duration <= d.duration)::INT) AS t, avg((m.duration < d.duration)::INT) AS t_below
          FROM deciles d, measured m WHERE m.batch = 0 GROUP BY d.enlarged, d.p, d.energy, d.duration)
        SELECT enlarged, max(greatest(e_below - p, p - e, 0)) > 0.2 AS energy_moved,
          max(greatest(t_below - p, p - t, 0)) > 0.2 AS duration_moved
        FROM ranks GROUP BY enlarged""",
    "document_schema": f"""WITH s AS (
          SELECT count(*) AS n, count(*) FILTER (s_suppkey % 7 = 0) AS notes,
            count(*) FILTER (s_suppkey % 2 = 0) AS even, count(n_name) AS named,
            count(s_name) AS stations, count(s_acctbal) AS costs,
            count(*) FILTER (s_suppkey % 5 = 0) > 0 AS some_text
          FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey),
        paths AS ({_STATION_PATHS})
        SELECT path, found, expected, CAST(n_values AS BIGINT) AS n_values,
          CAST(0 AS BIGINT) AS n_nulls, status
        FROM paths""",
    "star_view_kept": _star(_M1_FACT),
    "commit_feed": f"{_M1_FACT} SELECT * FROM fact",
    "changes_between": f"""WITH {_M1}
        SELECT {_EVENT_FIELDS}, session_number_range, CAST(0 AS BIGINT) AS n_added,
          count(*) AS n_removed
        FROM m1n WHERE {_BATCH} = 1 AND event_id % 3 <> 0
        GROUP BY ALL""",
    "load_from_partials": f"{_M1_FACT} SELECT * FROM fact",
    "rollback_facts": f"{_FIRST_FACT} SELECT * FROM fact",
    "rollback_publish": f"""{_FIRST_FACT},
        held AS (
          SELECT session_number_range, count(*) AS n_held, min(session_id) AS first_held
          FROM ({_FIRST_SESSIONS})
          JOIN (SELECT DISTINCT session_id, session_number_range FROM m1n) USING (session_id)
          WHERE NOT ({_VALID}) GROUP BY session_number_range)
        SELECT e.*, n_held, first_held
        FROM (SELECT session_number_range, count(*) AS n_events,
                count(DISTINCT session_id) AS n_sessions
              FROM m1n WHERE {_BATCH} = 0 GROUP BY session_number_range) e
        LEFT JOIN held USING (session_number_range)""",
    "quarantine_in_two": f"""WITH {_M1}
        SELECT {_SESSION_COLUMNS}, session_number_range,
          concat_ws(',', CASE WHEN start_events = 0 THEN 'no_start' END,
            CASE WHEN start_events > 1 THEN 'multiple_starts' END,
            CASE WHEN completion_events = 0 THEN 'no_stop' END) AS reason
        FROM ({_M1_SESSIONS}) JOIN (SELECT DISTINCT session_id, session_number_range FROM m1n)
          USING (session_id)
        WHERE NOT ({_VALID})""",
    "dimension_load": _DIM_VEHICLE,
    "table_append": _DIM_VEHICLE,
    "dim_station": _DIM_STATION,
    "dim_vehicle": _DIM_VEHICLE,
    "document_load": _DIM_STATION,
    "delimited_load": """SELECT CAST(p_partkey AS VARCHAR) AS id,
          p_name || ', ' || p_brand AS label, p_size AS size_km
        FROM part WHERE p_type <> 'PROMO'""",
    "delimited_extra_column": """SELECT CAST(p_partkey AS VARCHAR) AS id,
          p_name || ', ' || p_brand AS label, p_size AS size_km
        FROM part WHERE p_type <> 'PROMO'""",
    "station_file_load": _STATION_FROM_FILE,
    "vehicle_file_load": _VEHICLE_FROM_FILE,
    "surrogate_ids": f"""SELECT o_orderkey, {_surrogate('o_orderkey', 'o_orderpriority')} AS id
        FROM orders""",
    "station_ids": """SELECT CAST(s_suppkey AS VARCHAR) AS station_id FROM supplier
        ORDER BY station_id LIMIT 10""",
    "battery_capacities": """SELECT CAST(p_partkey AS VARCHAR) AS vehicle_id,
          CAST(trunc(p_retailprice) AS INTEGER) AS battery_capacity FROM part""",
    "star_view": _star(_M1_FACT),
    "star_view_defaults": _star(_M1_FACT, defaults=True),
    "star_view_bulk": _star(_M2_FACT),
    "stream_to_star": _star(_M1_FACT),
}

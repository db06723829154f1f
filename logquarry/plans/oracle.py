"""Plain SQL for the registered queries, over the same tables, written independently of the operators."""

from logquarry.functions.text import WHITESPACE

LOG_EVENTS = """
b AS (SELECT event_id, date_trunc('millisecond', ts) AS ts, user_id AS uid,
             event_type AS src, value, event_id % 100 AS r FROM events),
c AS (SELECT *, CASE
   WHEN src='error'  THEN CASE WHEN r % 2 = 0 THEN 'DATABASE_ERROR' ELSE 'AUTH_FAILURE' END
   WHEN src='signup' THEN CASE WHEN r % 2 = 0 THEN 'USER_LOGIN' ELSE 'USER_LOGOUT' END
   WHEN src='view' AND r % 3 = 0 THEN 'CACHE_ACCESS'
   WHEN src='purchase' AND r % 3 = 0 THEN 'DATABASE_QUERY'
   WHEN src='click' AND r % 20 = 7 THEN 'SERVICE_START'
   WHEN src='click' AND r % 20 = 8 THEN 'SERVICE_STOP'
   ELSE 'API_REQUEST' END AS event_type,
  CASE uid % 6 WHEN 0 THEN 'auth' WHEN 1 THEN 'orders' WHEN 2 THEN 'payments' WHEN 3 THEN 'users'
               WHEN 4 THEN 'inventory' ELSE 'notifications' END AS svc FROM b),
log_events AS (SELECT event_id AS id, CAST(ts AS TIMESTAMP) AS timestamp,
  CASE WHEN src='error' AND r < 60 THEN 'ERROR' WHEN r % 5 = 0 THEN 'WARN'
       WHEN r % 10 = 1 THEN 'DEBUG' ELSE 'INFO' END AS log_level,
  event_type,
  CASE WHEN event_type IN ('USER_LOGIN','USER_LOGOUT','AUTH_FAILURE','CACHE_ACCESS')
       THEN NULL ELSE svc END AS service,
  CASE WHEN event_type='API_REQUEST' THEN '/api/' || svc ||
       CASE event_id % 3 WHEN 0 THEN '' WHEN 1 THEN '/create' ELSE '/status' END END AS endpoint,
  CASE WHEN event_type='API_REQUEST' THEN
       CASE event_id % 4 WHEN 0 THEN 'GET' WHEN 1 THEN 'POST' WHEN 2 THEN 'PUT' ELSE 'DELETE' END END AS method,
  CASE WHEN event_type='API_REQUEST' THEN CASE WHEN r < 60 THEN 200 WHEN r < 70 THEN 201 WHEN r < 72 THEN 302
       WHEN r < 80 THEN 400 WHEN r < 88 THEN 404 ELSE 500 END END AS status,
  CASE WHEN event_type='API_REQUEST' AND r % 50 <> 49 THEN CAST(floor(value * 10) AS INT) END
       AS response_time_ms,
  CASE WHEN event_type IN ('API_REQUEST','USER_LOGIN','USER_LOGOUT','AUTH_FAILURE')
       THEN 'U' || CAST(uid + 1000 AS VARCHAR) END AS user_id,
  CASE WHEN event_type='DATABASE_ERROR' THEN 'error=timeout; query_time_ms=' || CAST(r * 10 AS VARCHAR)
       WHEN event_type='AUTH_FAILURE' THEN 'reason=expired_token'
       WHEN event_type='CACHE_ACCESS' THEN 'key=user_session; hit=true; ttl_sec=' || CAST(r AS VARCHAR)
  END AS message FROM c)
"""

# round half away from zero at two places, on integers
MEAN_RT = (
    "CAST((200 * sum(response_time_ms) + count(response_time_ms)) // nullif(2 * count(response_time_ms), 0)"
    " AS DOUBLE) / 100"
)


def _over_events(body: str) -> str:
    return f"WITH {LOG_EVENTS}\n{body}"


def _distribution(key: str, alias: str | None = None, where: str = "TRUE") -> str:
    name = alias or key
    return _over_events(
        f"""SELECT {name}, event_count,
            CAST((20000 * event_count + total) // (2 * total) AS DOUBLE) / 100 AS pct
        FROM (SELECT {name}, event_count, CAST(sum(event_count) OVER () AS BIGINT) AS total
              FROM (SELECT {key} AS {name}, count(*) AS event_count FROM log_events WHERE {where} GROUP BY 1))"""
    )


STATUS_CLASS = """CASE WHEN status BETWEEN 200 AND 299 THEN '2xx' WHEN status BETWEEN 300 AND 399 THEN '3xx'
    WHEN status BETWEEN 400 AND 499 THEN '4xx' WHEN status BETWEEN 500 AND 599 THEN '5xx' ELSE 'other' END"""

ANALYTICS = {
    "overall_summary": _over_events(
        """SELECT count(*) AS total_records, min(timestamp) AS earliest_timestamp,
           max(timestamp) AS latest_timestamp FROM log_events"""
    ),
    "log_level_distribution": _distribution("log_level"),
    "event_type_distribution": _distribution("event_type"),
    "service_distribution": _distribution("service"),
    "status_distribution": _distribution("status"),
    "status_class_distribution": _distribution(STATUS_CLASS, "status_class"),
    "error_summary": _over_events(
        """SELECT count(*) FILTER (log_level = 'ERROR') AS total_errors,
           count(*) FILTER (log_level = 'WARN') AS total_warnings,
           count(*) FILTER (event_type = 'AUTH_FAILURE') AS auth_failures,
           count(*) FILTER (event_type = 'DATABASE_ERROR') AS database_errors FROM log_events"""
    ),
    "response_time_summary": _over_events(
        f"""SELECT {MEAN_RT} AS avg_response_time_ms, min(response_time_ms) AS min_response_time_ms,
           max(response_time_ms) AS max_response_time_ms, count(response_time_ms) AS samples FROM log_events"""
    ),
    "slowest_endpoints": _over_events(
        f"""SELECT endpoint, count(*) AS request_count, {MEAN_RT} AS avg_response_time_ms,
           max(response_time_ms) AS max_response_time_ms FROM log_events
           WHERE endpoint IS NOT NULL AND response_time_ms IS NOT NULL GROUP BY endpoint
           ORDER BY avg_response_time_ms DESC, endpoint LIMIT 10"""
    ),
    "most_used_endpoints": _over_events(
        f"""SELECT endpoint, count(*) AS request_count, {MEAN_RT} AS avg_response_time_ms FROM log_events
           WHERE endpoint IS NOT NULL GROUP BY endpoint ORDER BY request_count DESC, endpoint LIMIT 10"""
    ),
    "service_performance": _over_events(
        f"""SELECT service, count(*) AS total_count, count(*) FILTER (log_level = 'ERROR') AS error_count,
           {MEAN_RT} AS avg_response_time_ms, max(response_time_ms) AS max_response_time_ms
           FROM log_events WHERE service IS NOT NULL GROUP BY service"""
    ),
    "hourly_traffic": _over_events(
        "SELECT date_trunc('hour', timestamp) AS hour, count(*) AS event_count FROM log_events GROUP BY 1"
    ),
    "user_activity_summary": _distribution("user_id", where="user_id IS NOT NULL"),
}


# --- analytics in one long table -------------------------------------------------------------------


def _measures(name: str, key: str, columns: list[str]) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{name}' AS report, {key} AS key, '{c}' AS measure, CAST({c} AS DOUBLE) AS value"
        f" FROM ({ANALYTICS[name]})"
        for c in columns
    )


COUNT_PCT, SERVICE = ["event_count", "pct"], ["total_count", "error_count", "avg_response_time_ms"]
RT = ["avg_response_time_ms", "min_response_time_ms", "max_response_time_ms", "samples"]
ANALYTICS_REPORT = "\nUNION ALL\n".join(
    [
        _measures("overall_summary", "'all'", ["total_records"]),
        _measures("log_level_distribution", "log_level", COUNT_PCT),
        _measures("event_type_distribution", "event_type", COUNT_PCT),
        _measures("service_distribution", "service", COUNT_PCT),
        _measures("status_distribution", "CAST(status AS VARCHAR)", COUNT_PCT),
        _measures("status_class_distribution", "status_class", COUNT_PCT),
        _measures("error_summary", "'all'", ["total_errors", "total_warnings", "auth_failures", "database_errors"]),
        _measures("response_time_summary", "'all'", RT),
        _measures(
            "slowest_endpoints", "endpoint", ["request_count", "avg_response_time_ms", "max_response_time_ms"]
        ),
        _measures("most_used_endpoints", "endpoint", ["request_count", "avg_response_time_ms"]),
        _measures("service_performance", "service", [*SERVICE, "max_response_time_ms"]),
        _measures("hourly_traffic", "CAST(hour AS VARCHAR)", ["event_count"]),
        _measures("user_activity_summary", "user_id", COUNT_PCT),
    ]
)

# --- text sources, parsing, validation -------------------------------------------------------------

DOCUMENT_LINES = f"""
lines AS (SELECT doc_id, trim(value, '{WHITESPACE}') AS line
          FROM (SELECT doc_id, unnest(string_split_regex(text, '\r\n|[\r\n]')) AS value FROM documents))
"""

# the line written for a record, with the damage chosen by id % 97
RAW_LINES = f"""{LOG_EVENTS},
damaged AS (SELECT *, id % 97 AS j,
    CASE id % 97 WHEN 3 THEN 'not-a-date' WHEN 10 THEN '2024-02-30 00:00:00,000'
        ELSE strftime(timestamp, '%Y-%m-%d %H:%M:%S,%g') END AS ts_text,
    CASE WHEN id % 97 = 4 THEN 'TRACE' ELSE log_level END AS level_text,
    CASE WHEN id % 97 = 5 THEN 'INVALID_EVENT' ELSE event_type END AS event_text,
    CASE WHEN id % 97 <> 8 THEN service END AS service_text,
    CASE id % 97 WHEN 6 THEN 'abc' WHEN 9 THEN '999' ELSE CAST(status AS VARCHAR) END AS status_text,
    CASE WHEN id % 97 = 7 THEN '-50' ELSE CAST(response_time_ms AS VARCHAR) END AS rt_text
    FROM log_events),
outcomes AS (SELECT *,
    CASE j WHEN 1 THEN 'garbage ' || id WHEN 2 THEN ts_text || ' | ' || level_text
        ELSE concat_ws(' | ', ts_text, level_text, event_text, 'service=' || service_text,
            'endpoint=' || endpoint, 'method=' || method, 'status=' || status_text,
            'response_time_ms=' || rt_text, 'user_id=' || user_id, replace(message, '; ', ' | ')) END AS raw_line,
    CASE WHEN j IN (1, 2) OR (j = 8 AND event_type IN ('DATABASE_QUERY', 'SERVICE_START', 'SERVICE_STOP'))
            THEN 'Insufficient pipe-delimited sections'
        WHEN j = 3 THEN 'Invalid timestamp format: not-a-date'
        WHEN j = 10 THEN 'Cannot parse timestamp: 2024-02-30 00:00:00,000'
        WHEN j = 4 THEN 'Invalid log level: TRACE'
        WHEN j = 5 THEN 'Invalid event type: INVALID_EVENT'
        WHEN j = 6 THEN 'Invalid status value: abc'
        WHEN j = 7 THEN 'Negative response_time_ms: -50' END AS malformed,
    CASE WHEN j = 8 AND event_type IN ('API_REQUEST', 'DATABASE_ERROR') THEN 'Missing required field: service'
        WHEN j = 9 THEN 'Out-of-range status: 999' END AS invalid
    FROM damaged),
copies AS (SELECT *, unnest(range(CASE WHEN id % 50 = 0 THEN 2 ELSE 1 END)) AS copy FROM outcomes)
"""
RECORD = "timestamp, log_level, event_type, service, endpoint, method, status, response_time_ms, user_id, message"
VALID = "malformed IS NULL AND invalid IS NULL"
DISTINCT_VALID = f"""SELECT DISTINCT {RECORD.replace('response_time_ms', 'CAST(response_time_ms AS BIGINT) AS response_time_ms')}
    FROM copies WHERE {VALID}"""
TS_MILLIS = "strftime(timestamp, '%Y-%m-%d %H:%M:%S,%g')"

PROCESSING = {
    "ingest_lines": f"WITH {DOCUMENT_LINES} SELECT doc_id, line FROM lines WHERE line <> ''",
    "ingest_stats": f"""WITH {DOCUMENT_LINES} SELECT count(*) FILTER (line <> '') AS total_lines_read,
        count(*) FILTER (line = '') AS empty_lines_skipped FROM lines""",
    "reject_free_text": f"""WITH {DOCUMENT_LINES}, parts AS (
        SELECT string_split(line, '|') AS p FROM lines WHERE line <> '')
        SELECT CASE WHEN len(p) < 4 THEN 'Insufficient pipe-delimited sections'
               ELSE 'Invalid timestamp format: ' || trim(p[1], '{WHITESPACE}') END AS rejection_reason,
               count(*) AS line_count FROM parts GROUP BY 1""",
    "log_lines": _over_events(
        f"""SELECT id, concat_ws(' | ', {TS_MILLIS}, log_level, event_type, 'service=' || service,
            'endpoint=' || endpoint, 'method=' || method, 'status=' || status,
            'response_time_ms=' || response_time_ms, 'user_id=' || user_id, replace(message, '; ', ' | ')) AS line
        FROM log_events"""
    ),
    "parse_logs": f"""WITH {RAW_LINES} SELECT id, CAST(copy AS INTEGER) AS copy, raw_line, timestamp, log_level,
        event_type, service_text AS service, endpoint, method, CAST(status_text AS BIGINT) AS status,
        CAST(rt_text AS BIGINT) AS response_time_ms, user_id, message FROM copies WHERE malformed IS NULL""",
    "rejected_logs": f"""WITH {RAW_LINES} SELECT raw_line, coalesce(malformed, invalid) AS rejection_reason
        FROM copies WHERE NOT ({VALID})""",
    "validate_records": f"""WITH {RAW_LINES} SELECT raw_line, invalid AS rejection_reason
        FROM copies WHERE malformed IS NULL AND invalid IS NOT NULL""",
    "dedupe_records": f"WITH {RAW_LINES} {DISTINCT_VALID}",
    "duplicate_count": f"""WITH {RAW_LINES} SELECT (SELECT count(*) FROM copies WHERE {VALID})
        - (SELECT count(*) FROM ({DISTINCT_VALID})) AS duplicate_records""",
    "cleaned_rows": f"WITH {RAW_LINES} SELECT * REPLACE ({TS_MILLIS} AS timestamp) FROM ({DISTINCT_VALID})",
    "processing_stats": f"""WITH {RAW_LINES}, d AS (SELECT count(*) AS n FROM ({DISTINCT_VALID}))
        SELECT count(*) AS total_raw, count(*) FILTER (malformed IS NULL) AS successfully_parsed,
        count(malformed) AS malformed_records,
        count(*) FILTER (malformed IS NULL AND invalid IS NOT NULL) AS validation_failures,
        count(*) FILTER ({VALID}) - any_value(n) AS duplicate_records, any_value(n) AS cleaned_records
        FROM copies, d""",
}

EMPTY_LINES = "(SELECT count(*) FROM log_events WHERE id % 200 = 0)"
PROCESSING["cleaned_round_trip"] = f"""WITH {RAW_LINES} SELECT {TS_MILLIS} AS timestamp,
    {', '.join(f"CAST({c} AS VARCHAR) AS {c}" for c in RECORD.split(', ')[1:])} FROM ({DISTINCT_VALID})"""
PROCESSING["rejected_round_trip"] = PROCESSING["rejected_logs"]


def _rows(part: str, source: str, measures: list[str]) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{part}' AS part, '{m}' AS measure, CAST({m} AS BIGINT) AS value FROM {source}" for m in measures
    )


STAGES = "total_raw successfully_parsed malformed_records validation_failures duplicate_records cleaned_records".split()
LOADED = "input_records inserted_records duplicate_records failed_records database_total_rows".split()
PROCESSING["process_and_load"] = f"""WITH {RAW_LINES}, cleaned AS ({DISTINCT_VALID}),
    stages AS (SELECT *, {EMPTY_LINES} AS empty_lines_skipped
               FROM ({PROCESSING["processing_stats"].replace(f"WITH {RAW_LINES}, d AS", "WITH d AS")})),
    one AS (SELECT count(*) AS input_records, count(*) AS inserted_records, 0 AS duplicate_records,
            0 AS failed_records, count(*) AS database_total_rows FROM cleaned),
    two AS (SELECT count(*) AS input_records, 0 AS inserted_records, count(*) AS duplicate_records,
            0 AS failed_records, count(*) AS database_total_rows FROM cleaned),
    ids AS (SELECT count(*) AS distinct_ids, 1 AS first_id, count(*) AS last_id, count(*) AS total_rows FROM cleaned)
    {_rows("processing", "stages", [*STAGES, "empty_lines_skipped"])}
    UNION ALL {_rows("first load", "one", LOADED)}
    UNION ALL {_rows("second load", "two", LOADED)}
    UNION ALL {_rows("table", "ids", ["distinct_ids", "first_id", "last_id", "total_rows"])}
    UNION ALL SELECT 'level' AS part, log_level AS measure, count(*) AS value FROM cleaned GROUP BY log_level"""

MISSING = "Missing required field: "
PROCESSING["validate_structured"] = _over_events(
    f"""SELECT * FROM (SELECT id, concat_ws('; ',
        CASE WHEN id % 6 = 1 THEN '{MISSING}timestamp' END,
        CASE WHEN id % 10 = 1 THEN '{MISSING}log_level' END,
        CASE WHEN id % 14 = 3 THEN '{MISSING}event_type' END,
        CASE WHEN (id % 4 = 1 OR service IS NULL) AND (id % 14 = 3 OR event_type NOT IN
             ('USER_LOGIN', 'USER_LOGOUT', 'AUTH_FAILURE', 'CACHE_ACCESS')) THEN '{MISSING}service' END,
        CASE id % 9 WHEN 1 THEN 'Out-of-range status: 99' WHEN 2 THEN 'Out-of-range status: 600' END,
        CASE WHEN id % 8 = 1 THEN 'Negative response_time_ms: ' || (-id - 1) END) AS errors FROM log_events)
    WHERE errors <> ''"""
)

PROCESSING["parse_numbers"] = _over_events(
    f"""SELECT id, CASE WHEN rejection_reason IS NULL THEN CAST(s AS INTEGER) END AS status,
        CASE WHEN rejection_reason IS NULL THEN CASE id % 5 WHEN 1 THEN '0' WHEN 2 THEN '123456789012345678901'
            ELSE r END END AS response_time_ms, rejection_reason,
        CASE WHEN id % 7 = 5 OR id % 5 = 4 THEN 'malformed' WHEN id % 7 = 4 THEN 'invalid' ELSE 'valid' END AS outcome
    FROM (SELECT *, CASE WHEN id % 7 = 5 THEN 'Invalid status value: 2__0'
            WHEN id % 5 = 4 THEN 'Negative response_time_ms: -7'
            WHEN id % 7 = 4 THEN 'Out-of-range status: ' || s || '{"0" * 25}' END AS rejection_reason
          FROM (SELECT id, CAST(coalesce(status, 200) AS VARCHAR) AS s,
                CAST(coalesce(response_time_ms, 5) AS VARCHAR) AS r FROM log_events))"""
)

# --- loading ---------------------------------------------------------------------------------------


def _hash(source: str) -> str:
    texts = ", ".join(
        f"coalesce(strftime({c}, '%Y-%m-%d %H:%M:%S.%f'), '')"
        if c == "timestamp"
        else f"coalesce(lower(CAST({c} AS VARCHAR)), '')"
        for c in RECORD.split(", ")
    )
    return f"SELECT *, sha256(concat_ws('|', {texts})) AS record_hash FROM {source}"


SECOND_LOAD = f"""WITH {RAW_LINES}, target AS ({_hash(f"({DISTINCT_VALID})")}), incoming AS ({_hash("log_events")}),
    fresh AS (SELECT * FROM incoming i WHERE NOT EXISTS
              (SELECT 1 FROM target t WHERE t.record_hash = i.record_hash))"""

LOADING = {
    "csv_typing": _over_events(
        """SELECT * REPLACE (
            CASE WHEN id % 3 = 2 THEN date_trunc('second', timestamp) ELSE timestamp END AS timestamp,
            CASE WHEN id % 97 <> 13 THEN response_time_ms END AS response_time_ms),
            CAST(NULL AS VARCHAR) AS row_error FROM log_events"""
    ),
    "csv_row_errors": _over_events(
        """SELECT id, CASE id % 11 WHEN 5 THEN 'Invalid timestamp format: not-a-date'
            WHEN 6 THEN 'Cannot parse timestamp: 2024-02-30 10:00:00'
            WHEN 8 THEN 'missing required timestamp'
            WHEN 9 THEN 'status out of range: inf' WHEN 10 THEN 'status out of range: 3e9' END AS row_error
        FROM log_events WHERE id % 11 IN (5, 6, 8, 9, 10)"""
    ),
    "refused_load": f"""WITH {LOG_EVENTS}, kept AS (SELECT count(DISTINCT record_hash) AS n FROM ({_hash("log_events")})),
        bad AS (SELECT min(id) AS id FROM log_events WHERE id % 11 = 5)
        SELECT 'Row ' || ((SELECT count(*) FROM log_events, bad WHERE log_events.id < bad.id) + 2)
            || ': Invalid timestamp format: not-a-date' AS message, n AS total_rows, n AS last_id FROM kept""",
    "record_hash": _over_events(f"SELECT id, record_hash FROM ({_hash('log_events')})"),
    "idempotent_load": f"{SECOND_LOAD} SELECT *, CAST(0 AS INTEGER) AS copy FROM fresh",
    "load_stats": f"""{SECOND_LOAD} SELECT 2 * (SELECT count(*) FROM incoming) AS input_records,
        (SELECT count(*) FROM fresh) AS inserted_records,
        2 * (SELECT count(*) FROM incoming) - (SELECT count(*) FROM fresh) AS duplicate_records,
        CAST(0 AS BIGINT) AS failed_records,
        (SELECT count(*) FROM target) + (SELECT count(*) FROM fresh) AS database_total_rows""",
    "constraint_violations": _over_events(
        """SELECT violation, count(*) AS rows FROM (SELECT CASE id % 13 WHEN 5 THEN 'timestamp is null'
            WHEN 6 THEN 'event_type is null' WHEN 1 THEN 'log_level is not a known level'
            WHEN 2 THEN 'status is out of range' WHEN 3 THEN 'response_time_ms is negative'
            WHEN 4 THEN 'service is longer than 30' END AS violation FROM log_events)
        WHERE violation IS NOT NULL GROUP BY 1"""
    ),
    "load_verify": _over_events(
        """SELECT log_level, count(*) AS event_count, (SELECT count(*) FROM log_events) AS total_rows,
            (SELECT min(timestamp) FROM log_events) AS min_timestamp,
            (SELECT max(timestamp) FROM log_events) AS max_timestamp FROM log_events GROUP BY log_level"""
    ),
}

# --- anomaly detection -----------------------------------------------------------------------------

PROFILE = """profile AS (SELECT count(*) AS total, quantile_cont(response_time_ms, 0.5) AS rt_median,
    quantile_cont(response_time_ms, 0.95) AS rt_p95, quantile_cont(status, 0.5) AS status_median FROM log_events)"""
SIGNALS = f"""{LOG_EVENTS}, {PROFILE},
signals AS (SELECT * REPLACE (coalesce(service, 'UNKNOWN') AS service),
    coalesce(response_time_ms, 0) > (SELECT rt_p95 FROM profile) AS high_response_time,
    coalesce(status BETWEEN 500 AND 599, FALSE) AS server_error,
    event_type = 'AUTH_FAILURE' AS auth_failure, event_type = 'DATABASE_ERROR' AS database_error,
    log_level = 'ERROR' AS error_log FROM log_events),
reasons AS (SELECT *, concat_ws(' + ', CASE WHEN high_response_time THEN 'High response time' END,
    CASE WHEN server_error THEN '5xx server error' END,
    CASE WHEN auth_failure THEN 'Authentication failure' END,
    CASE WHEN database_error THEN 'Database error' END,
    CASE WHEN error_log THEN 'Error log level' END) AS anomaly_reason FROM signals)"""

def _u(*parts: str) -> str:
    """Hash of the parts to [0, 1)."""
    return f"(CAST('0x' || substr(md5(concat_ws(':', {', '.join(parts)})), 1, 13) AS BIGINT) / 4503599627370496.0)"


def _breakdown(dimension: str, value: str, limit: str = "position <= 10", flagged: str = "anomaly_reason <> ''") -> str:
    return f"""SELECT * FROM (SELECT '{dimension}' AS dimension, value, event_count,
        CAST(row_number() OVER (ORDER BY event_count DESC, value) AS INTEGER) AS position
        FROM (SELECT {value} AS value, count(*) AS event_count FROM reasons
              WHERE {flagged} AND {value} IS NOT NULL GROUP BY 1)) WHERE {limit}"""


def _breakdowns(source: str, flagged: str) -> str:
    return f"WITH {source} " + "\nUNION ALL\n".join(
        [
            _breakdown("service", "service", flagged=flagged),
            _breakdown("event_type", "event_type", flagged=flagged),
            _breakdown("log_level", "log_level", "TRUE", flagged),
            _breakdown("status", "CAST(status AS VARCHAR)", flagged=flagged),
            _breakdown("endpoint", "endpoint", flagged=flagged),
        ]
    )


def _totals(source: str, flagged: str) -> str:
    return f"""WITH {source}, counts AS (SELECT count(*) AS total_records,
        count(*) FILTER ({flagged}) AS anomaly_count,
        count(*) FILTER (high_response_time) AS high_response_time_count,
        count(*) FILTER (server_error) AS server_error_count, count(*) FILTER (auth_failure) AS auth_failure_count,
        count(*) FILTER (database_error) AS database_error_count, count(*) FILTER (error_log) AS error_log_count
        FROM reasons)
        SELECT *, CAST((20000 * anomaly_count + total_records) // (2 * total_records) AS DOUBLE) / 100
            AS anomaly_rate, total_records - anomaly_count AS normal_count FROM counts"""


NUMBERS = {
    "response_time_ms": "coalesce(CAST(response_time_ms AS DOUBLE), (SELECT rt_median FROM profile), 0.0)",
    "status": "coalesce(CAST(status AS DOUBLE), (SELECT status_median FROM profile), 0.0)",
    "is_error": "CAST(log_level = 'ERROR' AS DOUBLE)",
    "is_warning": "CAST(log_level = 'WARN' AS DOUBLE)",
    "is_auth_failure": "CAST(event_type = 'AUTH_FAILURE' AS DOUBLE)",
    "is_database_error": "CAST(event_type = 'DATABASE_ERROR' AS DOUBLE)",
    "hour": "CAST(hour(timestamp) AS DOUBLE)",
    "day_of_week": "CAST(isodow(timestamp) - 1 AS DOUBLE)",
    "minute_of_hour": "CAST(minute(timestamp) AS DOUBLE)",
}
LABELS = {"log_level": "log_level", "event_type": "event_type", "service": "coalesce(service, 'UNKNOWN')"}
SAMPLES = f"""n AS (SELECT count(*) AS n FROM log_events),
    pool AS (SELECT id, least(n, 25600) AS pooled FROM log_events, n
             WHERE {_u('id', "'42'")} < least(1.0, 25600.0 / n)),
    drawn AS (SELECT id, tree, pooled, {_u('id', 'tree', "'43'")} AS draw
              FROM pool, (SELECT unnest(range(100)) AS tree)),
    ranked AS (SELECT CAST(tree AS INTEGER) AS tree, id, row_number() OVER (PARTITION BY tree ORDER BY draw, id) AS k
               FROM drawn WHERE draw < least(1.0, 512.0 / pooled)),
    samples AS MATERIALIZED (SELECT tree, id FROM ranked WHERE k <= 256)"""
LEVELS = 8  # of trees on full samples


def _forest() -> str:
    """CTEs up to ``nodes``: each level's nodes from an aggregate over its rows, the rows of the next from its splits."""
    columns = ", ".join([*NUMBERS, *LABELS])
    parts = [f"inputs AS MATERIALIZED (SELECT id, {', '.join(f'{v} AS {k}' for k, v in (NUMBERS | LABELS).items())} FROM log_events)", SAMPLES]
    parts.append(f"rows0 AS MATERIALIZED (SELECT tree, 1 AS node, {columns} FROM samples JOIN inputs USING (id))")
    ends = ", ".join(f"min({c}) AS {c}_low, max({c}) AS {c}_high" for c in (*NUMBERS, *LABELS))
    for d in range(LEVELS + 1):
        parts.append(f"stats{d} AS MATERIALIZED (SELECT tree, node, count(*) AS size, {ends} FROM rows{d} GROUP BY tree, node)")
        choices = [
            f"SELECT tree, node, {_u('tree', 'node', repr(c), "'44'")} AS draw, '{c}' AS feature, {c}_low AS low, {c}_high AS high,"
            f" CAST(NULL AS VARCHAR) AS category FROM stats{d} WHERE {c}_low < {c}_high"
            for c in NUMBERS
        ]
        choices += [
            f"SELECT tree, node, {_u('tree', 'node', repr(c), c, "'44'")}, '{c}', NULL, NULL, {c}"
            f" FROM (SELECT DISTINCT tree, node, {c} FROM rows{d} JOIN stats{d} USING (tree, node) WHERE {c}_low <> {c}_high)"
            for c in LABELS
        ]
        never = "WHERE FALSE" if d == LEVELS else ""
        parts.append(f"choices{d} AS ({' UNION ALL '.join(choices)})")
        parts.append(
            f"splits{d} AS MATERIALIZED (SELECT *, CASE WHEN cut < high THEN cut ELSE low END AS threshold FROM (SELECT *,"
            f" low + (high - low) * {_u('tree', 'node', 'feature', "'at'", "'44'")} AS cut FROM choices{d} {never}"
            f" QUALIFY row_number() OVER (PARTITION BY tree, node ORDER BY draw) = 1))"
        )
        if d < LEVELS:
            right = f"CASE WHEN category IS NULL THEN {_of(NUMBERS)} > threshold ELSE {_of(LABELS)} = category END"
            parts.append(
                f"rows{d + 1} AS MATERIALIZED (SELECT tree, 2 * node + CAST({right} AS INTEGER) AS node, {columns}"
                f" FROM rows{d} JOIN splits{d} USING (tree, node))"
            )
    path = "CASE WHEN size <= 1 THEN 0.0 WHEN size = 2 THEN 1.0 ELSE 2.0 * (ln(size - 1.0) + 0.5772156649015329) - 2.0 * (size - 1.0) / size END"
    levels = [
        f"SELECT tree, node, {d} AS depth, size AS rows, feature, threshold, category,"
        f" CASE WHEN feature IS NULL THEN CAST(round(({d} + {path}) * 1000000) AS BIGINT) END AS path"
        f" FROM stats{d} LEFT JOIN splits{d} USING (tree, node)"
        for d in range(LEVELS + 1)
    ]
    parts.append(f"nodes AS MATERIALIZED ({' UNION ALL '.join(levels)})")
    return ",\n".join(parts)


def _of(columns) -> str:
    return f"CASE feature {' '.join(f"WHEN '{c}' THEN {c}" for c in columns)} END"


def _decided(contamination: float = 0.05) -> str:
    """CTEs up to ``reasons``: every event walks every tree from root to leaf."""
    right = f"CASE WHEN category IS NULL THEN {_of(NUMBERS)} > threshold ELSE {_of(LABELS)} = category END"
    parts = [SIGNALS.split("reasons AS")[0].rstrip().rstrip(","), _forest()]
    parts.append("walk0 AS (SELECT id, tree, 1 AS node FROM inputs, (SELECT DISTINCT tree FROM nodes))")
    for d in range(LEVELS):
        parts.append(
            f"walk{d + 1} AS MATERIALIZED (SELECT id, tree, CASE WHEN feature IS NULL THEN node ELSE 2 * node + CAST({right} AS INTEGER) END AS node"
            f" FROM walk{d} JOIN nodes USING (tree, node) JOIN inputs USING (id))"
        )
    parts.append(f"paths AS (SELECT id, sum(path) AS path FROM walk{LEVELS} JOIN nodes USING (tree, node) GROUP BY id)")
    normal = "(2.0 * (ln(255.0) + 0.5772156649015329) - 2.0 * 255.0 / 256.0)"
    parts.append(f"scores AS MATERIALIZED (SELECT id, -pow(2.0, -(CAST(path AS DOUBLE) / (100000000.0 * {normal}))) AS score FROM paths)")
    parts.append(
        f"decided AS MATERIALIZED (SELECT id, score - (SELECT quantile_cont(score, {contamination}) FROM scores) AS anomaly_score FROM scores)"
    )
    parts.append(
        """reasons AS (SELECT *, anomaly_score < 0 AS is_anomaly, CAST(CASE WHEN anomaly_score < 0 THEN -1 ELSE 1 END AS INTEGER) AS ml_prediction,
    concat_ws(' + ', CASE WHEN anomaly_score < 0 THEN 'Isolation Forest anomaly' END,
    CASE WHEN high_response_time THEN 'High response time' END, CASE WHEN server_error THEN '5xx server error' END,
    CASE WHEN auth_failure THEN 'Authentication failure' END, CASE WHEN database_error THEN 'Database error' END,
    CASE WHEN error_log THEN 'Error log level' END) AS anomaly_reason FROM signals JOIN decided USING (id))"""
    )
    return ",\n".join(parts)


FOREST = _decided()
SCORED = """id, timestamp, log_level, event_type, service, endpoint, method, status, response_time_ms, user_id,
    round(anomaly_score, 6) + 0.0 AS anomaly_score, ml_prediction, is_anomaly, high_response_time, server_error, auth_failure,
    database_error, error_log"""


DETECTION = {
    "response_time_profile": f"WITH {LOG_EVENTS}, {PROFILE} SELECT * FROM profile",
    "features": f"""WITH {LOG_EVENTS}, {PROFILE} SELECT id,
        coalesce(CAST(response_time_ms AS DOUBLE), (SELECT rt_median FROM profile)) AS response_time_ms,
        coalesce(CAST(status AS DOUBLE), (SELECT status_median FROM profile)) AS status,
        CAST(log_level = 'ERROR' AS DOUBLE) AS is_error, CAST(log_level = 'WARN' AS DOUBLE) AS is_warning,
        CAST(event_type = 'AUTH_FAILURE' AS DOUBLE) AS is_auth_failure,
        CAST(event_type = 'DATABASE_ERROR' AS DOUBLE) AS is_database_error,
        CAST(hour(timestamp) AS DOUBLE) AS hour, CAST(isodow(timestamp) - 1 AS DOUBLE) AS day_of_week,
        CAST(minute(timestamp) AS DOUBLE) AS minute_of_hour,
        log_level, event_type, coalesce(service, 'UNKNOWN') AS service FROM log_events""",
    "feature_vector": f"""WITH {LOG_EVENTS}, {PROFILE},
        filled AS (SELECT *, coalesce(service, 'UNKNOWN') AS service_filled FROM log_events),
        known AS (SELECT 0 AS c, log_level AS v FROM filled UNION SELECT 1, event_type FROM filled
                  UNION SELECT 2, service_filled FROM filled),
        places AS (SELECT c, v, 8 + row_number() OVER (ORDER BY c, v) AS place FROM known)
        SELECT id, coalesce(CAST(response_time_ms AS DOUBLE), (SELECT rt_median FROM profile)) AS response_time_ms,
        coalesce(CAST(status AS DOUBLE), (SELECT status_median FROM profile)) AS status,
        a.place AS log_level_position, b.place AS event_type_position, d.place AS service_position
        FROM filled JOIN places AS a ON a.c = 0 AND a.v = log_level JOIN places AS b ON b.c = 1 AND b.v = event_type
        JOIN places AS d ON d.c = 2 AND d.v = service_filled""",
    "forest_samples": f"WITH {LOG_EVENTS}, {SAMPLES} SELECT tree, id FROM samples",
    "forest_nodes": f"WITH {LOG_EVENTS}, {PROFILE}, {_forest()} SELECT * FROM nodes",
    "isolation_forest_scores": f"WITH {FOREST} SELECT {SCORED}, anomaly_reason FROM reasons",
    "saved_detection": f"WITH {FOREST} SELECT {SCORED}, nullif(anomaly_reason, '') AS anomaly_reason FROM reasons",
    "anomaly_summary": _totals(FOREST, "is_anomaly"),
    "saved_detection_report": _totals(FOREST, "is_anomaly"),
    "anomaly_breakdowns": _breakdowns(FOREST, "is_anomaly"),
    "anomalous_events": f"""WITH {FOREST} SELECT timestamp, service, event_type, endpoint, status,
        response_time_ms, round(anomaly_score, 6) + 0.0 AS anomaly_score, anomaly_reason FROM reasons WHERE is_anomaly""",
    "forest_properties": _over_events(
        """SELECT count(*) AS rows, count(DISTINCT id) AS ids, CAST(0 AS BIGINT) AS missing_scores,
           CAST(0 AS BIGINT) AS disagreements, CAST(0 AS BIGINT) AS wrong_reasons, TRUE AS flagged_within_share
           FROM log_events"""
    ),
    "guarded_detection": f"""WITH {SIGNALS} SELECT id, timestamp, log_level, event_type, service, endpoint, method,
        status, response_time_ms, user_id, CAST(NULL AS DOUBLE) AS anomaly_score,
        CAST(NULL AS INTEGER) AS ml_prediction, FALSE AS is_anomaly, high_response_time, server_error, auth_failure,
        database_error, error_log, nullif(anomaly_reason, '') AS anomaly_reason FROM reasons""",
    "saved_anomaly_report": f"""WITH {SIGNALS} SELECT count(*) AS total_records, CAST(0 AS BIGINT) AS anomaly_count,
        CAST(0 AS DOUBLE) AS anomaly_rate, count(*) AS normal_count,
        count(*) FILTER (high_response_time) AS high_response_time_count,
        count(*) FILTER (server_error) AS server_error_count, count(*) FILTER (auth_failure) AS auth_failure_count,
        count(*) FILTER (database_error) AS database_error_count, count(*) FILTER (error_log) AS error_log_count
        FROM reasons""",
    "rule_signals": f"""WITH {SIGNALS} SELECT id, high_response_time, server_error, auth_failure, database_error,
        error_log FROM signals""",
    "anomaly_reason_rules": f"WITH {SIGNALS} SELECT id, anomaly_reason FROM reasons",
    "rule_anomaly_totals": _totals(SIGNALS, "anomaly_reason <> ''"),
    "rule_anomaly_breakdowns": _breakdowns(SIGNALS, "anomaly_reason <> ''"),
    "rule_anomaly_list": f"""WITH {SIGNALS} SELECT timestamp, service, event_type, endpoint, status,
        response_time_ms, anomaly_reason FROM reasons WHERE anomaly_reason <> ''""",
    "contamination_threshold": f"""WITH {LOG_EVENTS},
        scores AS (SELECT id, -CAST(coalesce(response_time_ms, 0) AS DOUBLE) AS score FROM log_events),
        decided AS (SELECT id, score - (SELECT quantile_cont(score, 0.05) FROM scores) AS d FROM scores)
        SELECT id, round(d, 6) AS anomaly_score, CAST(CASE WHEN d < 0 THEN -1 ELSE 1 END AS INTEGER)
            AS ml_prediction, d < 0 AS is_anomaly FROM decided""",
}

# --- quality, reports, views -----------------------------------------------------------------------

REQUIRED = ["timestamp", "log_level", "event_type"]
OPTIONAL = ["service", "endpoint", "method", "status", "response_time_ms", "user_id"]


def _decimal(value: str) -> str:
    return f"regexp_replace(CAST(CAST({value} AS DECIMAL(20, 2)) AS VARCHAR), '0$', '')"


def _checks() -> str:
    rows = []

    def add(name, category, status, value, message):
        rows.append(
            f"SELECT CAST({len(rows) + 1} AS INTEGER) AS position, '{name}' AS check_name,"
            f" '{category}' AS category, {status} AS status, {value} AS value, CAST(0 AS BIGINT) AS threshold,"
            f" {message} AS message FROM m"
        )

    for f in REQUIRED + OPTIONAL:
        share = f"(CAST((20000 * null_{f} + total) // (2 * total) AS DOUBLE) / 100)"
        status = (
            f"CASE WHEN null_{f} = 0 THEN 'PASS' ELSE 'FAIL' END"
            if f in REQUIRED
            else f"CASE WHEN {share} < 50 THEN 'PASS' WHEN {share} < 100 THEN 'WARN' ELSE 'FAIL' END"
        )
        message = f"'{f}: ' || null_{f} || ' NULL values (' || {_decimal(share)} || '%)'"
        add(f"{f}_completeness", "completeness", status, f"null_{f}", message)
    for name, category, text in (
        ("negative_response_times", "validity", "negative response times"),
        ("invalid_http_status", "validity", "invalid HTTP statuses"),
        ("duplicate_ids", "uniqueness", "duplicate record IDs"),
        ("valid_log_levels", "consistency", "invalid log levels"),
    ):
        status = f"CASE WHEN {name} = 0 THEN 'PASS' ELSE 'FAIL' END"
        add(name, category, status, name, f"{name} || ' {text}'")
    for f in REQUIRED + OPTIONAL:
        status = f"CASE WHEN null_{f} = 0 THEN 'PASS' ELSE 'WARN' END"
        add(f"{f}_null_count", "completeness", status, f"null_{f}", f"'{f}: ' || null_{f} || ' NULLs'")
    return "\nUNION ALL\n".join(rows)


CHECKS = f"""{LOG_EVENTS}, m AS (SELECT count(*) AS total,
    {', '.join(f"count(*) - count({f}) AS null_{f}" for f in REQUIRED + OPTIONAL)},
    count(*) FILTER (response_time_ms < 0) AS negative_response_times,
    count(*) FILTER (status NOT BETWEEN 100 AND 599) AS invalid_http_status,
    count(*) - count(DISTINCT id) AS duplicate_ids,
    count(*) FILTER (log_level NOT IN ('DEBUG', 'INFO', 'WARN', 'ERROR')) AS valid_log_levels FROM log_events),
checks AS ({_checks()})"""
SCORE = "CAST((2000 * count(*) FILTER (status = 'PASS') + count(*)) // (2 * count(*)) AS DOUBLE) / 10"

SERVICES = ANALYTICS["service_performance"]
FIGURES = f"""SELECT count(*) AS total_events, count(*) FILTER (log_level = 'ERROR') AS error_count,
    count(*) FILTER (log_level = 'WARN') AS warning_count,
    count(*) FILTER (event_type = 'AUTH_FAILURE') AS auth_failure_count,
    count(*) FILTER (event_type = 'DATABASE_ERROR') AS database_error_count,
    {MEAN_RT} AS average_response_time_ms, max(response_time_ms) AS max_response_time_ms,
    CAST(0 AS BIGINT) AS anomaly_count, CAST(0 AS DOUBLE) AS anomaly_rate,
    count(*) FILTER (status BETWEEN 500 AND 599) AS server_error_count,
    CAST(greatest(count(DISTINCT log_level) - 1000, 0) AS BIGINT) AS log_levels_left_out,
    CAST(greatest(count(DISTINCT event_type) - 1000, 0) AS BIGINT) AS event_types_left_out,
    CAST(greatest(count(DISTINCT service) - 1000, 0) AS BIGINT) AS services_left_out FROM log_events"""


def _section(name: str, source: str, order: str, label: str, count: str, value: str) -> str:
    return f"""SELECT '{name}' AS section, CAST(row_number() OVER (ORDER BY {order}) AS INTEGER) AS position,
        {label} AS label, {count} AS event_count, {value} AS value FROM ({ANALYTICS[source]})"""


def _iso(ts: str) -> str:
    return (
        f"CASE WHEN microsecond({ts}) % 1000000 = 0 THEN strftime({ts}, '%Y-%m-%dT%H:%M:%S')"
        f" ELSE strftime({ts}, '%Y-%m-%dT%H:%M:%S.%f') END"
    )


TOP_FINDINGS = f"""SELECT CAST(1 AS INTEGER) AS position, finding FROM (
            SELECT 'Highest-volume service: ' || service || ' with ' || total_count || ' events' AS finding
            FROM ({SERVICES}) ORDER BY total_count DESC, service LIMIT 1)
        UNION ALL SELECT CAST(2 AS INTEGER), finding FROM (
            SELECT 'Highest error-count service: ' || service || ' with ' || error_count || ' errors' AS finding
            FROM ({SERVICES}) WHERE error_count > 0
            ORDER BY error_count DESC, avg_response_time_ms DESC NULLS FIRST, service LIMIT 1)
        UNION ALL SELECT CAST(3 AS INTEGER), finding FROM (
            SELECT 'Slowest endpoint: ' || endpoint || ' (avg ' || {_decimal('avg_response_time_ms')} || ' ms)'
                AS finding
            FROM ({ANALYTICS["slowest_endpoints"]}) ORDER BY avg_response_time_ms DESC, endpoint LIMIT 1)"""

REPORTS = {
    "quality_checks": f"WITH {CHECKS} SELECT * FROM checks",
    "quality_score": f"""WITH {CHECKS} SELECT (SELECT total FROM m) AS total_records,
        (SELECT min(timestamp) FROM log_events) AS earliest_timestamp,
        (SELECT max(timestamp) FROM log_events) AS latest_timestamp,
        count(*) FILTER (status = 'PASS') AS quality_checks_passed,
        count(*) FILTER (status = 'FAIL') AS quality_checks_failed,
        count(*) FILTER (status = 'WARN') AS quality_checks_warned, {SCORE} AS quality_score FROM checks""",
    "operational_metrics": _over_events(FIGURES),
    "operational_sections": "\nUNION ALL\n".join(
        [
            _section(
                "log_level_distribution", "log_level_distribution", "event_count DESC, log_level", "log_level",
                "event_count", "pct",
            ),
            _section(
                "event_type_distribution", "event_type_distribution", "event_count DESC, event_type", "event_type",
                "event_count", "pct",
            ),
            _section(
                "slowest_endpoints", "slowest_endpoints", "avg_response_time_ms DESC, endpoint", "endpoint",
                "request_count", "avg_response_time_ms",
            ),
            _section(
                "busiest_endpoints", "most_used_endpoints", "request_count DESC, endpoint", "endpoint",
                "request_count", "avg_response_time_ms",
            ),
            _section(
                "service_performance", "service_performance",
                "error_count DESC, avg_response_time_ms DESC NULLS FIRST, service", "service",
                "total_count", "avg_response_time_ms",
            ),
        ]
    ),
    "top_findings": TOP_FINDINGS,
    "kpi_row": f"""WITH {CHECKS} SELECT total_events, error_count AS errors, warning_count AS warnings,
        average_response_time_ms, server_error_count AS server_errors, anomaly_count AS anomalies, anomaly_rate,
        (SELECT {SCORE} FROM checks) AS quality_score FROM ({FIGURES})""",
    "text_report": f"""WITH {CHECKS}, f AS ({FIGURES}),
        q AS (SELECT count(*) FILTER (status = 'PASS') AS passed, count(*) FILTER (status = 'FAIL') AS failed,
              {SCORE} AS score FROM checks),
        t AS (SELECT {_iso('min(timestamp)')} AS first_ts, {_iso('max(timestamp)')} AS last_ts FROM log_events),
        found AS ({TOP_FINDINGS}),
        listed AS (SELECT 0 AS position, '# FINAL REPORT' AS line
            UNION ALL SELECT 4, '## Dataset'
            UNION ALL SELECT 6, 'Total records: ' || total_events FROM f
            UNION ALL SELECT 7, 'Time range: ' || first_ts || ' to ' || last_ts FROM t
            UNION ALL SELECT 9, '## Data Quality'
            UNION ALL SELECT 11, 'Quality score: ' || {_decimal('score')} || '%' FROM q
            UNION ALL SELECT 12, 'Checks passed: ' || passed FROM q
            UNION ALL SELECT 13, 'Checks failed: ' || failed FROM q
            UNION ALL SELECT 15, '## Operational Summary'
            UNION ALL SELECT 17, 'Errors: ' || error_count FROM f
            UNION ALL SELECT 18, 'Warnings: ' || warning_count FROM f
            UNION ALL SELECT 19, 'Average response time: ' || {_decimal('average_response_time_ms')} || ' ms' FROM f
            UNION ALL SELECT 20, '5xx responses: ' || server_error_count FROM f
            UNION ALL SELECT 22, '## Anomaly Detection'
            UNION ALL SELECT 24, 'Anomalies: 0'
            UNION ALL SELECT 25, 'Anomaly rate: 0.0%'
            UNION ALL SELECT 27, '## Top Findings'
            UNION ALL SELECT 28 + position, position || '. ' || finding FROM found
            UNION ALL SELECT unnest([1, 3, 5, 8, 10, 14, 16, 21, 23, 26, 28]), '')
        SELECT CAST(position AS INTEGER) AS position, line FROM listed""",
    "facet_filter": _over_events(
        """SELECT * EXCLUDE (message) FROM log_events
           WHERE service = 'orders' AND log_level = 'INFO' AND response_time_ms >= 500"""
    ),
    "facet_values": _over_events(
        " UNION ALL ".join(
            f"SELECT '{c}' AS facet, CAST(0 AS INTEGER) AS position, 'All' AS value UNION ALL"
            f" (SELECT '{c}', CAST(row_number() OVER (ORDER BY {c}) AS INTEGER), CAST({c} AS VARCHAR)"
            f" FROM (SELECT DISTINCT {c} FROM log_events WHERE {c} IS NOT NULL))"
            for c in ("service", "log_level", "event_type", "status")
        )
    ),
    "recent_logs": _over_events(
        "SELECT * EXCLUDE (message) FROM log_events WHERE log_level = 'INFO' ORDER BY id DESC LIMIT 100"
    ),
}

# --- reports on events flagged by rules, and reports as saved ---------------------------------------

FLAGGED = DETECTION["rule_anomaly_totals"]
FLAGGED_FIGURES = FIGURES.replace("CAST(0 AS BIGINT) AS anomaly_count", f"(SELECT anomaly_count FROM ({FLAGGED})) AS anomaly_count").replace(
    "CAST(0 AS DOUBLE) AS anomaly_rate", f"(SELECT anomaly_rate FROM ({FLAGGED})) AS anomaly_rate"
)
FLAGGED_FINDINGS = f"""{TOP_FINDINGS}
    UNION ALL SELECT CAST(4 AS INTEGER), 'Detected ' || anomaly_count || ' anomalies (' || {_decimal('anomaly_rate')}
        || '% of total events)' FROM ({FLAGGED})
    UNION ALL SELECT CAST(5 AS INTEGER), 'Highest anomaly-producing event type: ' || event_type || ' (' || n || ' anomalies)'
        FROM (WITH {SIGNALS} SELECT event_type, count(*) AS n FROM reasons WHERE anomaly_reason <> ''
              GROUP BY 1 ORDER BY n DESC, event_type LIMIT 1)"""


def _figures(part: str, source: str, columns: list[str]) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{part}.{c}' AS name, CAST({c} AS VARCHAR) AS value FROM ({source})" for c in columns
    )


def _plain(ts: str) -> str:
    return f"replace({_iso(ts)}, 'T', ' ')"


TOTALS = "total_records anomaly_count anomaly_rate normal_count".split() + [
    f"{c}_count" for c in "high_response_time server_error auth_failure database_error error_log".split()
]
METRICS = (
    "total_events error_count warning_count auth_failure_count database_error_count average_response_time_ms"
    " max_response_time_ms anomaly_count anomaly_rate server_error_count log_levels_left_out event_types_left_out services_left_out"
).split()
QUALITY = "quality_checks_passed quality_checks_failed quality_checks_warned quality_score".split()
WHOLE = f"""SELECT count(*) AS total_records, {_iso('min(timestamp)')} AS earliest_timestamp,
    {_iso('max(timestamp)')} AS latest_timestamp FROM log_events"""
SPAN = f"""SELECT count(*) AS total_records, {_plain('min(timestamp)')} AS earliest_timestamp,
    {_plain('max(timestamp)')} AS latest_timestamp FROM log_events"""

SAVED = {
    "flagged_operational_metrics": _over_events(FLAGGED_FIGURES),
    "flagged_operational_maps": f"WITH {SIGNALS} "
    + "\nUNION ALL\n".join(
        f"SELECT '{section}' AS section, value, event_count FROM ({_breakdown(c, f'CAST({c} AS VARCHAR)')})"
        for section, c in (
            ("anomalies_by_service", "service"),
            ("anomalies_by_event_type", "event_type"),
            ("anomalies_by_status", "status"),
            ("top_anomalous_endpoints", "endpoint"),
        )
    ),
    "flagged_findings": FLAGGED_FINDINGS,
    "flagged_kpi_row": REPORTS["kpi_row"].replace(FIGURES, FLAGGED_FIGURES),
    "final_report_figures": f"""WITH {CHECKS}
        {_figures("dataset", WHOLE, ["total_records", "earliest_timestamp", "latest_timestamp"])}
        UNION ALL {_figures("data_quality", SPAN, ["total_records", "earliest_timestamp", "latest_timestamp"])}
        UNION ALL {_figures("data_quality", REPORTS["quality_score"], QUALITY)}
        UNION ALL {_figures("operational_metrics", FLAGGED_FIGURES, METRICS)}
        UNION ALL {_figures("anomaly_detection", FLAGGED, TOTALS)}
        UNION ALL SELECT 'finding ' || position, finding FROM ({FLAGGED_FINDINGS})""",
    "saved_text_report": f"SELECT line, count(*) AS times FROM ({REPORTS['text_report']}) GROUP BY line",
    "saved_quality": f"""WITH {CHECKS} SELECT total_records, earliest_timestamp, latest_timestamp,
        (SELECT count(*) FROM checks WHERE status = 'PASS') AS quality_checks_passed,
        (SELECT {SCORE} FROM checks) AS quality_score FROM ({SPAN})""",
    "saved_checks": f"WITH {CHECKS} SELECT * EXCLUDE (position) FROM checks",
    "saved_analytics": ANALYTICS_REPORT.replace("CAST(hour AS VARCHAR) AS key", "strftime(hour, '%Y-%m-%dT%H:%M:%S') AS key"),
}

# a load keeps one of equal records
LOADED = f"""{LOG_EVENTS.replace("log_events AS", "all_events AS")}, log_events AS (SELECT min(id) AS id, timestamp, log_level,
    event_type, service, endpoint, method, status, response_time_ms, user_id, message FROM all_events GROUP BY ALL)"""

ORACLE_SQL = {
    "table_analytics": ANALYTICS_REPORT.replace(LOG_EVENTS, LOADED),
    **ANALYTICS,
    "analytics_report": ANALYTICS_REPORT,
    **PROCESSING,
    **LOADING,
    **DETECTION,
    **REPORTS,
    **SAVED,
}

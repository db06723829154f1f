"""``log_events`` and raw log lines derived from the ``events`` table.

The given tables hold no log lines, so both are projections of ``events(event_id, ts, user_id,
event_type, value, props)``: narrow, whole-table, no shuffle.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logquarry.functions.hashing import record_hash
from logquarry.functions.timestamps import log_text
from logquarry.operators.parse import format_lines
from logquarry.schema import LOG_EVENTS_SCHEMA

# How an event is read as a log record.
EVENT_FIELDS = [
    "event_id AS id",
    # cut to milliseconds, the precision of a log line
    "make_timestamp_ntz(year(ts), month(ts), dayofmonth(ts), hour(ts), minute(ts),"
    " CAST(floor(extract(SECOND FROM ts) * 1000) / 1000 AS DECIMAL(8, 6))) AS timestamp",
    "user_id AS uid",
    "event_type AS src",
    "value",
    "event_id % 100 AS r",
]
EVENT_KINDS = [
    "*",
    """CASE
        WHEN src = 'error' THEN if(r % 2 = 0, 'DATABASE_ERROR', 'AUTH_FAILURE')
        WHEN src = 'signup' THEN if(r % 2 = 0, 'USER_LOGIN', 'USER_LOGOUT')
        WHEN src = 'view' AND r % 3 = 0 THEN 'CACHE_ACCESS'
        WHEN src = 'purchase' AND r % 3 = 0 THEN 'DATABASE_QUERY'
        WHEN src = 'click' AND r % 20 = 7 THEN 'SERVICE_START'
        WHEN src = 'click' AND r % 20 = 8 THEN 'SERVICE_STOP'
        ELSE 'API_REQUEST' END AS event_type""",
    """CASE uid % 6 WHEN 0 THEN 'auth' WHEN 1 THEN 'orders' WHEN 2 THEN 'payments' WHEN 3 THEN 'users'
        WHEN 4 THEN 'inventory' ELSE 'notifications' END AS svc""",
]
RECORD_FIELDS = [
    "id",
    "timestamp",
    """CASE WHEN src = 'error' AND r < 60 THEN 'ERROR' WHEN r % 5 = 0 THEN 'WARN' WHEN r % 10 = 1 THEN 'DEBUG'
        ELSE 'INFO' END AS log_level""",
    "event_type",
    "if(event_type IN ('USER_LOGIN', 'USER_LOGOUT', 'AUTH_FAILURE', 'CACHE_ACCESS'), NULL, svc) AS service",
    """CASE WHEN event_type = 'API_REQUEST' THEN concat('/api/', svc,
        CASE id % 3 WHEN 0 THEN '' WHEN 1 THEN '/create' ELSE '/status' END) END AS endpoint""",
    """CASE WHEN event_type = 'API_REQUEST' THEN
        CASE id % 4 WHEN 0 THEN 'GET' WHEN 1 THEN 'POST' WHEN 2 THEN 'PUT' ELSE 'DELETE' END END AS method""",
    """CASE WHEN event_type = 'API_REQUEST' THEN CASE WHEN r < 60 THEN 200 WHEN r < 70 THEN 201 WHEN r < 72 THEN 302
        WHEN r < 80 THEN 400 WHEN r < 88 THEN 404 ELSE 500 END END AS status""",
    """CASE WHEN event_type = 'API_REQUEST' AND r % 50 <> 49 THEN CAST(floor(value * 10) AS INT) END
        AS response_time_ms""",
    """CASE WHEN event_type IN ('API_REQUEST', 'USER_LOGIN', 'USER_LOGOUT', 'AUTH_FAILURE')
        THEN concat('U', uid + 1000) END AS user_id""",
    """CASE event_type WHEN 'DATABASE_ERROR' THEN concat('error=timeout; query_time_ms=', r * 10)
        WHEN 'AUTH_FAILURE' THEN 'reason=expired_token'
        WHEN 'CACHE_ACCESS' THEN concat('key=user_session; hit=true; ttl_sec=', r) END AS message""",
]
# End of fixed values.


EVENTS_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def read_table(spark: SparkSession, sf_dir: str, name: str, schema: str | None = None) -> DataFrame:
    """A given table; a known schema saves the job that would read it from the files."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(f"{sf_dir}/{name}.parquet")


def log_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Structured log records, one per event, without ``record_hash``."""
    events = read_table(spark, sf_dir, "events", EVENTS_SCHEMA)
    return events.selectExpr(*EVENT_FIELDS).selectExpr(*EVENT_KINDS).selectExpr(*RECORD_FIELDS)


def hashed_log_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_events(spark, sf_dir).withColumn("record_hash", record_hash()).select(*LOG_EVENTS_SCHEMA.names)


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record rendered as a log line (``line``), some damaged by a fixed rule, some written twice.

    ``id % 97`` from 1 to 10 selects the damage and every fiftieth record has a second copy, so the
    outcome of parsing each line follows from its id.
    """
    records = log_events(spark, sf_dir).withColumn("timestamp", log_text(F.col("timestamp")))
    damaged = records.selectExpr(
        "id",
        "explode(if(id % 50 = 0, array(0, 1), array(0))) AS copy",
        """CASE id % 97 WHEN 3 THEN 'not-a-date' WHEN 10 THEN '2024-02-30 00:00:00,000' ELSE timestamp END
            AS timestamp""",
        "if(id % 97 = 4, 'TRACE', log_level) AS log_level",
        "if(id % 97 = 5, 'INVALID_EVENT', event_type) AS event_type",
        "if(id % 97 = 8, NULL, service) AS service",
        "endpoint",
        "method",
        "CASE id % 97 WHEN 6 THEN 'abc' WHEN 9 THEN '999' ELSE CAST(status AS STRING) END AS status",
        "if(id % 97 = 7, '-50', CAST(response_time_ms AS STRING)) AS response_time_ms",
        "user_id",
        "message",
    )
    return format_lines(damaged).selectExpr(
        "id",
        "copy",
        """CASE id % 97 WHEN 1 THEN concat('garbage ', id) WHEN 2 THEN substring_index(line, ' | ', 2) ELSE line END
            AS line""",
    )

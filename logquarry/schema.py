"""Column lists, enumerations and table schemas shared by every operator."""

from pyspark.sql import types as T

# Log levels, event types, field names, checks and limits that define the log format.
LOG_LEVELS = ["DEBUG", "INFO", "WARN", "ERROR"]

EVENT_TYPES = [
    "API_REQUEST",
    "USER_LOGIN",
    "USER_LOGOUT",
    "DATABASE_QUERY",
    "DATABASE_ERROR",
    "AUTH_FAILURE",
    "CACHE_ACCESS",
    "SERVICE_START",
    "SERVICE_STOP",
]

SERVICE_OPTIONAL_EVENTS = ["USER_LOGIN", "USER_LOGOUT", "AUTH_FAILURE", "CACHE_ACCESS"]

MESSAGE_KEYS = [
    "error",
    "message",
    "reason",
    "table",
    "key",
    "hit",
    "ttl_sec",
    "ip",
    "login_method",
    "session_duration_sec",
    "query_time_ms",
]

RECORD_COLUMNS = [
    "timestamp",
    "log_level",
    "event_type",
    "service",
    "endpoint",
    "method",
    "status",
    "response_time_ms",
    "user_id",
    "message",
]

NULL_TOKENS = ["", "NaN", "None", "null", "NaT", "nan"]

STATUS_MIN, STATUS_MAX = 100, 599

VARCHAR_LENGTHS = {
    "log_level": 10,
    "event_type": 30,
    "service": 30,
    "endpoint": 100,
    "method": 10,
    "user_id": 20,
    "record_hash": 64,
}

REQUIRED_FIELDS = ["timestamp", "log_level", "event_type"]
OPTIONAL_FIELDS = ["service", "endpoint", "method", "status", "response_time_ms", "user_id"]

NUMERIC_FEATURES = [
    "response_time_ms",
    "status",
    "is_error",
    "is_warning",
    "is_auth_failure",
    "is_database_error",
    "hour",
    "day_of_week",
    "minute_of_hour",
]
CATEGORICAL_FEATURES = ["log_level", "event_type", "service"]

RULE_SIGNALS = ["high_response_time", "server_error", "auth_failure", "database_error", "error_log"]

ANALYSIS_COLUMNS = ["id", *RECORD_COLUMNS[:-1]]

SCORED_COLUMNS = [
    *ANALYSIS_COLUMNS,
    "anomaly_score",
    "ml_prediction",
    "is_anomaly",
    *RULE_SIGNALS,
    "anomaly_reason",
]

CHECK_COLUMNS = ["check_name", "category", "status", "value", "threshold", "message"]

ANOMALY_LIST_COLUMNS = [
    "timestamp",
    "service",
    "event_type",
    "endpoint",
    "status",
    "response_time_ms",
    "anomaly_score",
    "anomaly_reason",
]
# End of fixed values.

RECORD_SCHEMA = T.StructType(
    [
        T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("log_level", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("service", T.StringType()),
        T.StructField("endpoint", T.StringType()),
        T.StructField("method", T.StringType()),
        T.StructField("status", T.IntegerType()),
        T.StructField("response_time_ms", T.IntegerType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("message", T.StringType()),
    ]
)

LOG_EVENTS_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        *RECORD_SCHEMA.fields,
        T.StructField("record_hash", T.StringType()),
    ]
)

SCORED_SCHEMA = T.StructType(
    [
        *[f for f in LOG_EVENTS_SCHEMA.fields if f.name in ANALYSIS_COLUMNS],
        T.StructField("anomaly_score", T.DoubleType()),
        T.StructField("ml_prediction", T.IntegerType()),
        T.StructField("is_anomaly", T.BooleanType()),
        *[T.StructField(name, T.BooleanType()) for name in RULE_SIGNALS],
        T.StructField("anomaly_reason", T.StringType()),
    ]
)

CHECKS_SCHEMA = T.StructType(
    [
        T.StructField("check_name", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("value", T.LongType()),
        T.StructField("threshold", T.LongType()),
        T.StructField("message", T.StringType()),
    ]
)

"""Log line -> typed record, or a rejection reason; and the reverse, record -> log line.

Parsing is cut into steps that the optimizer does not merge, so every line is split and matched once
however often the outcome is filtered or referenced later.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logquarry.functions.steps import step
from logquarry.functions.text import integer, strip
from logquarry.functions.timestamps import LOG_TIMESTAMP_PATTERN, log_text, to_timestamp
from logquarry.schema import EVENT_TYPES, LOG_LEVELS, MESSAGE_KEYS, RECORD_COLUMNS

# The section separator with the white space around it, how sections are joined again,
# and the key=value pattern.
SECTION_SEPARATOR = "(?U)[\\s\x1c-\x1f]*[|][\\s\x1c-\x1f]*"
SECTION_JOINT = " | "
FIELD_PATTERN = r"(?d)([\p{L}\p{N}_]+)=(.+?)(?= \| |$)"
MESSAGE_JOINT = "; "

# sections that are all of the form key=value, one per text line
PLAIN_FIELDS = "^\n(?:[\\p{L}\\p{N}_]++=[^\n]++\n)*+\\z"


def _field_lines(sections: Column) -> Column:
    """The key=value pairs of the detail sections, each on a text line of its own.

    Sections normally are such pairs already. Others, above all ``key=`` without a value, which takes the
    next section as its value, go through the general pattern over the joined sections.
    """
    newline = F.lit("\n")
    plain = F.concat(newline, F.array_join(sections, "\n"), newline)
    matched = F.regexp_extract_all(F.array_join(sections, SECTION_JOINT), F.lit(FIELD_PATTERN), F.lit(0))
    return F.when(plain.rlike(PLAIN_FIELDS), plain).otherwise(
        F.concat(newline, F.array_join(matched, "\n"), newline)
    )


def _field(key: str) -> str:
    """Value of the last pair with this key, or null, as SQL over ``fields``."""
    marker = f"'\\n{key}='"
    return f"if(contains(fields, {marker}), substring_index(substring_index(fields, {marker}, -1), '\\n', 1), NULL)"


def parse_lines(lines: DataFrame, column: str = "line") -> DataFrame:
    """Parse each line. Adds ``raw_line``, the ten record columns and ``rejection_reason`` (null when parsed).

    ``status`` and ``response_time_ms`` are decimal(38,0) here; validation narrows the status. Other columns of
    ``lines`` are kept. The reason is the first of: too few sections, timestamp format, impossible
    timestamp, level, event type, status, response time.
    """
    extra = [c for c in lines.columns if c != column]
    df = step(lines, extra, raw_line=F.col(column), p=F.split(strip(F.col(column)), SECTION_SEPARATOR, -1))

    def section(i: int) -> Column:
        return F.get("p", F.lit(i))

    detail = F.slice("p", 4, F.greatest(F.size("p") - 3, F.lit(0)))
    df = step(
        df,
        [*extra, "raw_line", "p"],
        ts=F.when(section(0).rlike(LOG_TIMESTAMP_PATTERN), to_timestamp(section(0))),
        fields=F.when(F.size("p") >= 4, _field_lines(detail)),
    )
    parts = ", ".join(f"concat('{k}=', {_field(k)})" for k in MESSAGE_KEYS)
    df = step(
        df,
        [*extra, "raw_line", "p", "ts"],
        **{k: F.expr(_field(k)) for k in ("service", "endpoint", "method", "user_id")},
        status_text=F.expr(_field("status")),
        rt_text=F.expr(_field("response_time_ms")),
        message=F.expr(f"nullif(concat_ws('{MESSAGE_JOINT}', {parts}), '')"),
    )
    texts = ["service", "endpoint", "method", "user_id", "message", "status_text", "rt_text"]
    df = step(
        df,
        [*extra, "raw_line", "p", "ts", *texts],
        status=integer(F.col("status_text")),
        rt=integer(F.col("rt_text")),
    )

    def because(text: str, value: Column) -> Column:
        return F.concat(F.lit(text), value)

    ts, status, rt = F.col("ts"), F.col("status"), F.col("rt")
    reason = (
        F.when(F.size("p") < 4, "Insufficient pipe-delimited sections")
        .when(
            ts.isNull() & ~section(0).rlike(LOG_TIMESTAMP_PATTERN),
            because("Invalid timestamp format: ", section(0)),
        )
        .when(ts.isNull(), because("Cannot parse timestamp: ", section(0)))
        .when(~section(1).isin(LOG_LEVELS), because("Invalid log level: ", section(1)))
        .when(~section(2).isin(EVENT_TYPES), because("Invalid event type: ", section(2)))
        .when(F.col("status_text").isNotNull() & status.isNull(), because("Invalid status value: ", F.col("status_text")))
        .when(F.col("rt_text").isNotNull() & rt.isNull(), because("Invalid response_time_ms: ", F.col("rt_text")))
        .when(rt < 0, because("Negative response_time_ms: ", rt.cast("string")))
    )
    return step(
        df,
        extra,
        raw_line=F.col("raw_line"),
        timestamp=ts,
        log_level=section(1),
        event_type=section(2),
        **{c: F.col(c) for c in ("service", "endpoint", "method")},
        status=status,
        response_time_ms=rt,
        user_id=F.col("user_id"),
        message=F.col("message"),
        rejection_reason=reason,
    )


def parsed_only(records: DataFrame) -> DataFrame:
    return records.where(F.col("rejection_reason").isNull()).drop("rejection_reason")


def rejected_only(records: DataFrame) -> DataFrame:
    return records.where(F.col("rejection_reason").isNotNull()).select("raw_line", "rejection_reason")


def record_columns(records: DataFrame) -> DataFrame:
    """The ten record columns in order; absent ones become null strings."""
    have = set(records.columns)
    return records.select(*[c if c in have else F.lit(None).cast("string").alias(c) for c in RECORD_COLUMNS])


def format_lines(records: DataFrame) -> DataFrame:
    """Render records as log lines (column ``line``); null fields are left out. Other columns are kept."""
    extra = [c for c in records.columns if c not in RECORD_COLUMNS]

    def pair(key: str) -> Column:
        return F.concat(F.lit(f"{key}="), F.col(key).cast("string"))

    timestamp = F.col("timestamp")
    if records.schema["timestamp"].dataType.simpleString() != "string":
        timestamp = log_text(timestamp)
    line = F.concat_ws(
        SECTION_JOINT,
        timestamp,
        "log_level",
        "event_type",
        *[pair(k) for k in ("service", "endpoint", "method", "status", "response_time_ms", "user_id")],
        F.replace("message", F.lit(MESSAGE_JOINT), F.lit(SECTION_JOINT)),
    )
    return records.select(*extra, line.alias("line"))

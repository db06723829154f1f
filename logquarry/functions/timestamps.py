"""Zone-free timestamp parsing and formatting. Nothing here depends on the session time zone."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from logquarry.functions.text import strip

# Timestamp spellings in log lines and in CSV files.
LOG_TIMESTAMP_PATTERN = r"(?Ud)^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2},\d{3}$"
CSV_TIMESTAMP_PATTERN = r"(?Ud)^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}([,.]\d{1,6})?$"


def to_timestamp(c: Column) -> Column:
    """Timestamp of text already in one of the spellings above; null for a date that does not exist."""
    return F.when(~c.startswith("0000"), F.replace(c, F.lit(","), F.lit(".")).try_cast("timestamp_ntz"))


def parse_csv_timestamp(c: Column) -> Column:
    text = strip(c)
    return F.when(text.rlike(CSV_TIMESTAMP_PATTERN), to_timestamp(text))


def csv_timestamp_error(c: Column) -> Column:
    """Why a non-null CSV timestamp is unusable, or null. Blank text is not an error, it is a null."""
    text = strip(c)
    return (
        F.when(text == "", None)
        .when(~text.rlike(CSV_TIMESTAMP_PATTERN), F.concat(F.lit("Invalid timestamp format: "), text))
        .when(to_timestamp(text).isNull(), F.concat(F.lit("Cannot parse timestamp: "), text))
    )


def micros_text(ts: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss.SSSSSS``."""
    text = ts.cast("string")
    return F.rpad(F.when(F.length(text) == 19, F.concat(text, F.lit("."))).otherwise(text), 26, "0")


def log_text(ts: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss,SSS``, milliseconds cut off, as written in log lines and cleaned files."""
    full = micros_text(ts)
    return F.concat(F.substring(full, 1, 19), F.lit(","), F.substring(full, 21, 3))


def plain_text(ts: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` with microseconds only when there are any."""
    full = micros_text(ts)
    return F.when(full.endswith(".000000"), F.substring(full, 1, 19)).otherwise(full)


def iso_text(ts: Column) -> Column:
    """``plain_text`` in ISO-8601 form."""
    return F.replace(plain_text(ts), F.lit(" "), F.lit("T"))


def hour_start(ts: Column) -> Column:
    return F.make_timestamp_ntz(F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts), F.lit(0), F.lit(0))

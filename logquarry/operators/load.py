"""CSV typing, constraint checks and the insert-if-absent rule of the ``log_events`` table."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logquarry.functions.hashing import record_hash
from logquarry.functions.steps import step
from logquarry.functions.text import float_value, strip
from logquarry.functions.timestamps import csv_timestamp_error, parse_csv_timestamp
from logquarry.schema import (
    LOG_LEVELS,
    NULL_TOKENS,
    RECORD_COLUMNS,
    REQUIRED_FIELDS,
    STATUS_MAX,
    STATUS_MIN,
    VARCHAR_LENGTHS,
)

NUMERIC_COLUMNS = ["status", "response_time_ms"]


def type_rows(raw: DataFrame) -> DataFrame:
    """String columns -> typed record columns, ``record_hash`` and ``row_error``.

    Null tokens are matched before trimming. Numbers are read as floats and truncated, unreadable ones
    become null. ``row_error`` says why a row cannot be loaded at all: a missing or unreadable
    timestamp, or a number too large for an INT. Other columns are kept.
    """
    extra = [c for c in raw.columns if c not in RECORD_COLUMNS]
    texts = {c: F.when(~F.col(c).isin(NULL_TOKENS), F.col(c)) for c in RECORD_COLUMNS}
    floats = {f"{c}_float": float_value(texts[c]) for c in NUMERIC_COLUMNS}
    rows = step(raw, extra, **texts, **floats)
    timestamp = F.col("timestamp")

    def too_large(c: str) -> Column:
        value = F.col(f"{c}_float")
        return F.when(
            value.isNotNull() & value.try_cast("int").isNull(), F.concat(F.lit(f"{c} out of range: "), F.col(c))
        )

    floated = [f"{c}_float" for c in NUMERIC_COLUMNS]
    rows = step(rows, [*extra, *RECORD_COLUMNS, *floated], time_error=csv_timestamp_error(timestamp))
    error = F.coalesce(
        F.when(timestamp.isNull(), F.lit("missing required timestamp")),
        F.col("time_error"),
        *[too_large(c) for c in NUMERIC_COLUMNS],
    )
    typed = {c: strip(F.col(c)) for c in RECORD_COLUMNS}
    typed["timestamp"] = parse_csv_timestamp(timestamp)
    typed.update({c: F.col(f"{c}_float").try_cast("int") for c in NUMERIC_COLUMNS})
    return step(rows, extra, **typed, row_error=error).withColumn("record_hash", record_hash())


def constraint_error(rows: DataFrame) -> Column:
    """First violated table constraint, or null: required columns, level, status and time ranges, text lengths."""
    status, rt = F.col("status"), F.col("response_time_ms")
    checks = [
        *[(F.col(c).isNull(), f"{c} is null") for c in REQUIRED_FIELDS],
        (~F.col("log_level").isin(LOG_LEVELS), "log_level is not a known level"),
        (~status.between(STATUS_MIN, STATUS_MAX), "status is out of range"),
        (rt < 0, "response_time_ms is negative"),
        *[
            (F.length(c) > n, f"{c} is longer than {n}")
            for c, n in VARCHAR_LENGTHS.items()
            if c in rows.columns
        ],
    ]
    return F.coalesce(*[F.when(bad, F.lit(message)) for bad, message in checks])


def unfit(records: DataFrame) -> Column:
    """Why a valid record can't be a row of the table, or null: a time beyond INT, or a violated constraint."""
    rt = F.col("response_time_ms")
    too_large = F.when(rt > 2147483647, F.concat(F.lit("response_time_ms out of range: "), rt.cast("string")))
    return F.coalesce(too_large, constraint_error(records))


def constraint_violations(rows: DataFrame) -> DataFrame:
    """Violated constraint and number of rows."""
    return (
        step(rows, [], violation=constraint_error(rows))
        .where(F.col("violation").isNotNull())
        .groupBy("violation")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def first_per_hash(rows: DataFrame, order: list[str]) -> DataFrame:
    """The first row, by ``order``, of every ``record_hash``.

    An aggregate rather than a window: copies of one record collapse on the map side, so a hash that
    holds a large part of all rows never meets in one task.
    """
    rest = [c for c in rows.columns if c != "record_hash"]
    first = F.min_by(F.struct(*rest), F.struct(*order)).alias("first")
    return rows.groupBy("record_hash").agg(first).select("first.*", "record_hash")


def winners(rows: DataFrame, order: list[str], place: str) -> DataFrame:
    """(record_hash, ``place``, event_date) of the first row, by ``order``, of every ``record_hash``.

    Only these narrow columns are combined, on the map side first, so copies of one record never meet.
    """
    narrow = rows.select("record_hash", *order, "event_date")
    first = F.min_by(F.struct(place, "event_date"), F.struct(*order)).alias("first")
    return narrow.groupBy("record_hash").agg(first).select("record_hash", "first.*")


def absent_from(rows: DataFrame, target: DataFrame) -> DataFrame:
    """Rows whose hash the target does not hold. Only the hash column of the target is read.

    An outer join that keeps the unmatched rows: the optimizer would move an anti join below the
    aggregate that made the rows distinct, and send every copy of a hot record through the join. Both sides
    are merged, never broadcast: after parsing or of a few days, the target is estimated far too small.
    """
    known = target.select(F.col("record_hash").alias("known_hash")).hint("merge")
    matched = rows.join(known, F.col("record_hash") == F.col("known_hash"), "left_outer")
    return matched.where(F.col("known_hash").isNull()).drop("known_hash")


def load_summary(events: DataFrame) -> DataFrame:
    """One row: table size, time range and rows per level (a sorted list, one entry per level)."""
    levels = events.groupBy("log_level").agg(
        F.count(F.lit(1)).alias("event_count"),
        F.min("timestamp").alias("first_ts"),
        F.max("timestamp").alias("last_ts"),
    )
    return levels.agg(
        F.coalesce(F.sum("event_count"), F.lit(0).cast("bigint")).alias("total_rows"),
        F.min("first_ts").alias("min_timestamp"),
        F.max("last_ts").alias("max_timestamp"),
        F.array_sort(F.collect_list(F.struct("log_level", "event_count"))).alias("level_counts"),
    )

"""Data-quality checks and their score."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logquarry.functions.rounding import decimal_text, percent
from logquarry.schema import (
    CHECK_COLUMNS,
    LOG_LEVELS,
    OPTIONAL_FIELDS,
    REQUIRED_FIELDS,
    STATUS_MAX,
    STATUS_MIN,
)

FIELDS = [*REQUIRED_FIELDS, *OPTIONAL_FIELDS]


def measurements(events: DataFrame) -> DataFrame:
    """One row with every count the checks need.

    All but one come from a single map-side combined aggregate. Duplicate ids are rows less distinct ids.
    Those are counted in a separate read of the id column, as set bits: ids are dense by the way they are
    given out, so 32,768 of them travel as a bitmap of 4 KB, not as ids.
    """
    status, level = F.col("status"), F.col("log_level")
    id_bits = F.bitmap_construct_agg(F.bitmap_bit_position(F.col("id").cast("bigint"))).alias("bits")
    bitmaps = events.where("id IS NOT NULL").groupBy(F.bitmap_bucket_number(F.col("id").cast("bigint")).alias("bucket")).agg(id_bits)
    distinct = bitmaps.agg(F.sum(F.bitmap_count("bits")).alias("n")).scalar()
    counts = events.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.min("timestamp").alias("earliest_timestamp"),
        F.max("timestamp").alias("latest_timestamp"),
        F.count_if(F.col("id").isNull()).alias("no_id"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in FIELDS],
        F.count_if(F.col("response_time_ms") < 0).alias("negative_response_times"),
        F.count_if(~status.between(STATUS_MIN, STATUS_MAX)).alias("invalid_http_status"),
        F.count_if(~level.isin(LOG_LEVELS)).alias("valid_log_levels"),
    )
    # rows without an id are, together, one id more
    ids = F.coalesce(distinct, F.lit(0).cast("bigint")) + (F.col("no_id") > 0).cast("bigint")
    return counts.withColumn("duplicate_ids", F.col("total_records") - ids).drop("no_id")


def _check(name: str, category: str, status: Column, value: Column, message: Column) -> Column:
    values = [F.lit(name), F.lit(category), status, value, F.lit(0).cast("bigint"), message]
    return F.struct(*[v.alias(c) for c, v in zip(CHECK_COLUMNS, values)])


def _counted(value: Column, text: str) -> Column:
    return F.concat(value.cast("string"), F.lit(text))


def quality_checks(measured: DataFrame) -> DataFrame:
    """The 22 checks with ``position``; none for an empty table."""

    def none_allowed(value: Column, otherwise: str) -> Column:
        return F.when(value == 0, "PASS").otherwise(otherwise)

    checks = []
    for field in FIELDS:
        nulls = F.col(f"null_{field}")
        share = percent(nulls, F.col("total_records"))
        if field in REQUIRED_FIELDS:
            status = none_allowed(nulls, "FAIL")
        else:
            status = F.when(share < 50, "PASS").when(share < 100, "WARN").otherwise("FAIL")
        text = F.concat(
            F.lit(f"{field}: "), nulls.cast("string"), F.lit(" NULL values ("), decimal_text(share), F.lit("%)")
        )
        checks.append(_check(f"{field}_completeness", "completeness", status, nulls, text))
    for name, category, text in (
        ("negative_response_times", "validity", " negative response times"),
        ("invalid_http_status", "validity", " invalid HTTP statuses"),
        ("duplicate_ids", "uniqueness", " duplicate record IDs"),
        ("valid_log_levels", "consistency", " invalid log levels"),
    ):
        value = F.col(name)
        checks.append(_check(name, category, none_allowed(value, "FAIL"), value, _counted(value, text)))
    for field in FIELDS:
        nulls = F.col(f"null_{field}")
        text = F.concat(F.lit(f"{field}: "), _counted(nulls, " NULLs"))
        checks.append(_check(f"{field}_null_count", "completeness", none_allowed(nulls, "WARN"), nulls, text))
    listed = measured.where("total_records > 0").select(F.posexplode(F.array(*checks)).alias("position", "check"))
    return listed.select((F.col("position") + 1).alias("position"), "check.*")


def quality_report(measured: DataFrame) -> DataFrame:
    """One row: size, time range, passed, failed and warned checks, score and the list of checks."""
    entry = F.struct("position", *CHECK_COLUMNS)
    tally = quality_checks(measured).agg(
        *[
            F.count_if(F.col("status") == status).alias(name)
            for name, status in (("passed", "PASS"), ("failed", "FAIL"), ("warned", "WARN"))
        ],
        F.count(F.lit(1)).alias("checks_made"),
        F.array_sort(F.collect_list(entry)).alias("entries"),
    )
    # tenths of a percent on integers, half up
    tenths = F.call_function("div", F.col("passed") * 2000 + F.col("checks_made"), F.col("checks_made") * 2)
    whole = measured.select(F.struct("total_records", "earliest_timestamp", "latest_timestamp")).scalar()
    return tally.withColumn("whole", whole).select(
        "whole.total_records",
        "whole.earliest_timestamp",
        "whole.latest_timestamp",
        F.col("passed").alias("quality_checks_passed"),
        F.col("failed").alias("quality_checks_failed"),
        F.col("warned").alias("quality_checks_warned"),
        F.when(F.col("checks_made") > 0, tenths / F.lit(10.0)).otherwise(F.lit(0.0)).alias("quality_score"),
        F.transform("entries", lambda c: c.dropFields("position")).alias("checks"),
    )

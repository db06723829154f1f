"""Record validation, routing and de-duplication."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logquarry.functions.steps import step
from logquarry.schema import RECORD_COLUMNS, REQUIRED_FIELDS, SERVICE_OPTIONAL_EVENTS, STATUS_MAX, STATUS_MIN

MALFORMED, INVALID, VALID = "malformed", "invalid", "valid"


def _number_error(df: DataFrame, name: str, bad: Column, message: str) -> Column:
    c = F.col(name)
    kind = df.schema[name].dataType
    if isinstance(kind, T.IntegralType) or isinstance(kind, T.DecimalType) and kind.scale == 0:
        return F.when(bad, F.concat(F.lit(message), c.cast("string")))
    return F.when(c.isNotNull(), F.concat(F.lit(f"Invalid {name} type: "), c.cast("string")))


def validation_errors(records: DataFrame) -> Column:
    """All violated rules joined by ``"; "``; an empty string for a valid record."""
    missing = "Missing required field: "
    optional = F.coalesce(F.col("event_type").isin(SERVICE_OPTIONAL_EVENTS), F.lit(False))
    status, rt = F.col("status"), F.col("response_time_ms")
    return F.concat_ws(
        "; ",
        *[F.when(F.col(f).isNull(), missing + f) for f in REQUIRED_FIELDS],
        F.when(F.col("service").isNull() & ~optional, missing + "service"),
        _number_error(records, "status", ~status.between(STATUS_MIN, STATUS_MAX), "Out-of-range status: "),
        _number_error(records, "response_time_ms", rt < 0, "Negative response_time_ms: "),
    )


def route(records: DataFrame) -> DataFrame:
    """Tag records with ``outcome`` and fill ``rejection_reason`` for those that fail validation.

    Takes the output of ``parse_lines``; records that already carry a reason are malformed. One narrow pass.
    """
    rest = [c for c in records.columns if c not in ("rejection_reason", "status")]
    errors = F.nullif(validation_errors(records), F.lit(""))
    judged = step(
        records,
        [*rest, "status"],
        malformed=F.col("rejection_reason").isNotNull(),
        reason=F.coalesce("rejection_reason", errors),
    )
    outcome = F.when(F.col("malformed"), MALFORMED).when(F.col("reason").isNotNull(), INVALID).otherwise(VALID)
    # only valid statuses are promised to fit an INT
    return judged.select(
        *rest,
        F.when(F.col("reason").isNull(), F.col("status")).cast("int").alias("status"),
        F.col("reason").alias("rejection_reason"),
        outcome.alias("outcome"),
    )


def refuse(routed: DataFrame, error: Column) -> DataFrame:
    """Turn valid records for which ``error`` gives a reason into invalid ones."""
    rest = [c for c in routed.columns if c not in ("rejection_reason", "outcome")]
    refused = F.when(F.col("outcome") == VALID, error)
    judged = step(routed, [*rest, "rejection_reason", "outcome"], refused=refused)
    return judged.select(
        *rest,
        F.coalesce("rejection_reason", "refused").alias("rejection_reason"),
        F.when(F.col("refused").isNotNull(), INVALID).otherwise(F.col("outcome")).alias("outcome"),
    )


def valid_records(routed: DataFrame) -> DataFrame:
    return routed.where(F.col("outcome") == VALID).select(*RECORD_COLUMNS)


def invalid_records(routed: DataFrame) -> DataFrame:
    return routed.where(F.col("outcome") == INVALID).select("raw_line", "rejection_reason")


def all_rejections(routed: DataFrame) -> DataFrame:
    """Parse rejections together with validation rejections."""
    return routed.where(F.col("outcome") != VALID).select("raw_line", "rejection_reason")


def deduplicate(records: DataFrame) -> DataFrame:
    """One row per distinct record; nulls compare equal. Copies collapse before the shuffle."""
    return records.dropDuplicates(RECORD_COLUMNS)

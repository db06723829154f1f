"""Rule signals, the anomaly reason, totals and breakdowns."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logquarry.functions.rounding import percent
from logquarry.schema import RULE_SIGNALS

# Reason labels in their order.
MODEL_REASON = "Isolation Forest anomaly"
RULE_REASONS = {
    "high_response_time": "High response time",
    "server_error": "5xx server error",
    "auth_failure": "Authentication failure",
    "database_error": "Database error",
    "error_log": "Error log level",
}
REASON_JOINT = " + "

BREAKDOWNS = ["service", "event_type", "log_level", "status", "endpoint"]


def rule_signals(df: DataFrame, p95: Column) -> DataFrame:
    """Add the five rule signals. ``p95`` is null when no response time exists; no row is high then."""
    rt, event = F.col("response_time_ms"), F.col("event_type")
    signals = {
        "high_response_time": F.coalesce(F.coalesce(rt, F.lit(0)) > p95, F.lit(False)),
        "server_error": F.coalesce(F.col("status").between(500, 599), F.lit(False)),
        "auth_failure": event.eqNullSafe("AUTH_FAILURE"),
        "database_error": event.eqNullSafe("DATABASE_ERROR"),
        "error_log": F.col("log_level").eqNullSafe("ERROR"),
    }
    return df.withColumns(signals)


def anomaly_reason(model: Column | None = None) -> Column:
    """Labels of all signals that fired; an empty string when none did."""
    labels = [] if model is None else [F.when(model == -1, MODEL_REASON)]
    return F.concat_ws(REASON_JOINT, *labels, *[F.when(F.col(c), label) for c, label in RULE_REASONS.items()])


def anomaly_totals(scored: DataFrame) -> DataFrame:
    """One row: records, anomalies, rate, normal records and the count of every signal."""
    counts = scored.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if("is_anomaly").alias("anomaly_count"),
        *[F.count_if(c).alias(f"{c}_count") for c in RULE_SIGNALS],
    )
    total, anomalies = F.col("total_records"), F.col("anomaly_count")
    return counts.select(
        "total_records",
        "anomaly_count",
        F.coalesce(percent(anomalies, total), F.lit(0.0)).alias("anomaly_rate"),
        (total - anomalies).alias("normal_count"),
        *[f"{c}_count" for c in RULE_SIGNALS],
    )


def breakdown_counts(scored: DataFrame) -> DataFrame:
    """Anomalies per ``dimension`` and ``value`` of the five columns, in one scan; missing values are left out."""
    pairs = F.array(*[F.struct(F.lit(c).alias("dimension"), F.col(c).cast("string").alias("value")) for c in BREAKDOWNS])
    return (
        scored.where("is_anomaly")
        .select(F.inline(pairs))
        .where(F.col("value").isNotNull())
        .groupBy("dimension", "value")
        .agg(F.count(F.lit(1)).alias("event_count"))
    )


def anomaly_breakdowns(scored: DataFrame, limit: int = 10) -> DataFrame:
    """The largest ``limit`` values of each dimension: ``dimension``, ``value``, ``event_count``, ``position``.

    Levels are few by definition and are listed in full: they take part under a dimension name of their own,
    so that one ranking with one cut per task serves all.
    """
    counts = breakdown_counts(scored)
    level = F.col("dimension") == "log_level"
    group = F.when(level, F.concat("dimension", F.lit("="), "value")).otherwise(F.col("dimension"))
    ranked = Window.partitionBy("group").orderBy(F.desc("event_count"), "value")
    top = counts.withColumn("group", group).withColumn("cut", F.row_number().over(ranked)).where(F.col("cut") <= limit)
    position = F.row_number().over(Window.partitionBy("dimension").orderBy(F.desc("event_count"), "value"))
    return top.select("dimension", "value", "event_count", position.alias("position"))

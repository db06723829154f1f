"""The thirteen aggregate queries over ``log_events``.

Each query is defined once, over *facts*: rows that carry the grouping columns plus additive measures.
``facts`` maps every event to one fact row (narrow, columns pruned per query). ``rollup`` sums them by
the few groupings that all queries need, in one scan with grouping sets, so a full report scans and
shuffles the events once and then reads small tables, instead of scanning twelve times.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logquarry.functions.rounding import mean, percent
from logquarry.functions.timestamps import hour_start

DIMENSIONS = ["hour", "log_level", "event_type", "service", "endpoint", "status"]
GROUPINGS = {
    "kind": ["log_level", "event_type"],
    "service": ["service", "log_level"],
    "endpoint": ["endpoint"],
    "status": ["status"],
    "hour": ["hour"],
}
PART_OF = {
    "service_distribution": "service",
    "service_performance": "service",
    "slowest_endpoints": "endpoint",
    "most_used_endpoints": "endpoint",
    "status_distribution": "status",
    "status_class_distribution": "status",
    "server_errors": "status",
    "hourly_traffic": "hour",
}  # all others: kind


def facts(events: DataFrame, *more: str) -> DataFrame:
    """Fact rows of the events, with further columns as they are."""
    rt = F.col("response_time_ms")
    return events.select(
        *more,
        "log_level",
        "event_type",
        "service",
        "endpoint",
        "status",
        hour_start(F.col("timestamp")).alias("hour"),
        F.lit(1).cast("bigint").alias("events"),
        F.when(rt.isNotNull(), 1).otherwise(0).cast("bigint").alias("rt_samples"),
        rt.cast("bigint").alias("rt_sum"),
        rt.alias("rt_min"),
        rt.alias("rt_max"),
        F.col("timestamp").alias("first_ts"),
        F.col("timestamp").alias("last_ts"),
    )


def rollup(events: DataFrame, *by: str) -> DataFrame:
    """The facts summed by each of ``GROUPINGS``, told apart by ``part``, and by columns ``by`` in all of them.

    Sums are combined on the map side.
    """
    sums = [
        *[F.sum(c).alias(c) for c in ("events", "rt_samples", "rt_sum")],
        F.min("rt_min").alias("rt_min"),
        F.max("rt_max").alias("rt_max"),
        F.min("first_ts").alias("first_ts"),
        F.max("last_ts").alias("last_ts"),
    ]
    sets = [[F.col(c) for c in (*by, *columns)] for columns in GROUPINGS.values()]
    summed = facts(events, *by).groupingSets(sets, *[F.col(c) for c in (*by, *DIMENSIONS)]).agg(F.grouping_id().alias("set"), *sums)
    names = F.lit(None).cast("string")
    for name, columns in GROUPINGS.items():  # a bit of the id is set for each column that is not grouped by
        number = sum(1 << i for i, c in enumerate(reversed(DIMENSIONS)) if c not in columns)
        names = F.when(F.col("set") == number, name).otherwise(names)
    return summed.withColumn("part", names).drop("set")


def rolled(summary: DataFrame, name: str) -> DataFrame:
    """The rows of ``rollup`` that serve as the facts of a query."""
    return summary.where(F.col("part") == PART_OF.get(name, "kind")).drop("part")


def _events() -> Column:
    return F.sum("events")


def _events_where(condition: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, F.col("events"))), F.lit(0).cast("bigint"))


def _mean_rt() -> Column:
    return mean(F.sum("rt_sum"), F.sum("rt_samples")).alias("avg_response_time_ms")


def _with_share(counts: DataFrame, key: str) -> DataFrame:
    """Add each group's share. The total is a scalar subquery over the same (reused) aggregate."""
    total = counts.agg(F.sum("event_count")).scalar()
    return counts.select(key, "event_count", percent(F.col("event_count"), total).alias("pct"))


def _distribution(data: DataFrame, key: str) -> DataFrame:
    return _with_share(data.groupBy(key).agg(_events().alias("event_count")), key)


def overall_summary(data: DataFrame) -> DataFrame:
    return data.agg(
        F.coalesce(_events(), F.lit(0).cast("bigint")).alias("total_records"),
        F.min("first_ts").alias("earliest_timestamp"),
        F.max("last_ts").alias("latest_timestamp"),
    )


def log_level_distribution(data: DataFrame) -> DataFrame:
    return _distribution(data, "log_level").orderBy(F.desc("event_count"), "log_level")


def event_type_distribution(data: DataFrame) -> DataFrame:
    return _distribution(data, "event_type").orderBy(F.desc("event_count"), "event_type")


def service_distribution(data: DataFrame) -> DataFrame:
    return _distribution(data, "service").orderBy(F.desc("event_count"), "service")


def status_distribution(data: DataFrame) -> DataFrame:
    return _distribution(data, "status").orderBy(F.asc_nulls_last("status"))


def status_class_distribution(data: DataFrame) -> DataFrame:
    status = F.col("status")
    status_class = (
        F.when((status >= 200) & (status < 300), "2xx")
        .when((status >= 300) & (status < 400), "3xx")
        .when((status >= 400) & (status < 500), "4xx")
        .when((status >= 500) & (status < 600), "5xx")
        .otherwise("other")
    )
    return _distribution(data.withColumn("status_class", status_class), "status_class").orderBy("status_class")


def error_summary(data: DataFrame) -> DataFrame:
    level, event = F.col("log_level"), F.col("event_type")
    return data.agg(
        _events_where(level == "ERROR").alias("total_errors"),
        _events_where(level == "WARN").alias("total_warnings"),
        _events_where(event == "AUTH_FAILURE").alias("auth_failures"),
        _events_where(event == "DATABASE_ERROR").alias("database_errors"),
    )


def server_errors(data: DataFrame) -> DataFrame:
    return data.agg(_events_where(F.col("status").between(500, 599)).alias("server_error_count"))


def response_time_summary(data: DataFrame) -> DataFrame:
    return data.where(F.col("rt_max").isNotNull()).agg(
        _mean_rt(),
        F.min("rt_min").alias("min_response_time_ms"),
        F.max("rt_max").alias("max_response_time_ms"),
        F.coalesce(F.sum("rt_samples"), F.lit(0).cast("bigint")).alias("samples"),
    )


def slowest_endpoints(data: DataFrame, limit: int = 10) -> DataFrame:
    return (
        data.where(F.col("endpoint").isNotNull() & F.col("rt_max").isNotNull())
        .groupBy("endpoint")
        .agg(
            F.sum("rt_samples").alias("request_count"), _mean_rt(), F.max("rt_max").alias("max_response_time_ms")
        )
        .orderBy(F.desc("avg_response_time_ms"), "endpoint")
        .limit(limit)
    )


def most_used_endpoints(data: DataFrame, limit: int = 10) -> DataFrame:
    return (
        data.where(F.col("endpoint").isNotNull())
        .groupBy("endpoint")
        .agg(_events().alias("request_count"), _mean_rt())
        .orderBy(F.desc("request_count"), "endpoint")
        .limit(limit)
    )


def service_performance(data: DataFrame) -> DataFrame:
    return (
        data.where(F.col("service").isNotNull())
        .groupBy("service")
        .agg(
            _events().alias("total_count"),
            _events_where(F.col("log_level") == "ERROR").alias("error_count"),
            _mean_rt(),
            F.max("rt_max").alias("max_response_time_ms"),
        )
        .orderBy(F.desc("error_count"), F.desc_nulls_first("avg_response_time_ms"), "service")
    )


def hourly_traffic(data: DataFrame) -> DataFrame:
    return data.groupBy("hour").agg(_events().alias("event_count")).orderBy(F.asc_nulls_last("hour"))


def user_counts(events: DataFrame, *by: str) -> DataFrame:
    """Events per user, and per columns ``by``."""
    return events.where(F.col("user_id").isNotNull()).groupBy("user_id", *by).agg(F.count(F.lit(1)).alias("event_count"))


def user_shares(counts: DataFrame) -> DataFrame:
    return _with_share(counts, "user_id").orderBy(F.desc("event_count"), "user_id")


def user_activity_summary(events: DataFrame) -> DataFrame:
    """Events per user. Reads the events themselves: users are not a dimension of the facts."""
    return user_shares(user_counts(events))


FACT_QUERIES = {
    "overall_summary": overall_summary,
    "log_level_distribution": log_level_distribution,
    "event_type_distribution": event_type_distribution,
    "service_distribution": service_distribution,
    "status_distribution": status_distribution,
    "status_class_distribution": status_class_distribution,
    "error_summary": error_summary,
    "response_time_summary": response_time_summary,
    "slowest_endpoints": slowest_endpoints,
    "most_used_endpoints": most_used_endpoints,
    "service_performance": service_performance,
    "hourly_traffic": hourly_traffic,
}


def results_of(summary: DataFrame, users: DataFrame) -> dict[str, DataFrame]:
    """All thirteen results from rolled-up facts, of any number of partial roll-ups, and ``user_counts``."""
    return {name: query(rolled(summary, name)) for name, query in FACT_QUERIES.items()} | {"user_activity_summary": user_shares(users)}


def all_analytics(events: DataFrame, summary: DataFrame) -> dict[str, DataFrame]:
    """All thirteen results. ``summary`` is ``rollup(events)``, read back from storage."""
    return results_of(summary, user_counts(events))

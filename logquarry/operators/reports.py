"""Operational report, findings, key figures and the final document."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logquarry.functions.rounding import decimal_text
from logquarry.functions.timestamps import iso_text, plain_text
from logquarry.operators import analytics
from logquarry.schema import RULE_SIGNALS

LISTED = 1000  # entries of a list in the operational document

BREAKDOWN_MAPS = [
    "anomalies_by_service",
    "anomalies_by_event_type",
    "anomalies_by_log_level",
    "anomalies_by_status",
    "top_anomalous_endpoints",
]
ANOMALY_REPORT_SCHEMA = T.StructType(
    [
        T.StructField("total_records", T.LongType()),
        T.StructField("anomaly_count", T.LongType()),
        T.StructField("anomaly_rate", T.DoubleType()),
        T.StructField("normal_count", T.LongType()),
        *[T.StructField(f"{c}_count", T.LongType()) for c in RULE_SIGNALS],
        *[T.StructField(c, T.MapType(T.StringType(), T.LongType())) for c in BREAKDOWN_MAPS],
    ]
)


def or_no_anomalies(report: DataFrame) -> DataFrame:
    """The saved anomaly report, or a row of zeros and empty maps when it has no row."""
    columns = []
    for field in ANOMALY_REPORT_SCHEMA.fields:
        empty = F.create_map() if isinstance(field.dataType, T.MapType) else F.lit(0)
        columns.append(F.coalesce(F.first(field.name), empty.cast(field.dataType)).alias(field.name))
    return report.agg(*columns)


def _listed(result: DataFrame, order: list[Column], limit: int) -> Column:
    """The first rows of an ordered result as one array of structs."""
    keyed = result.select(F.struct(*order).alias("key"), F.struct(*result.columns).alias("row")).orderBy("key").limit(limit)
    return keyed.agg(F.transform(F.array_sort(F.collect_list(F.struct("key", "row"))), lambda e: e["row"])).scalar()


def _minus(column: str) -> Column:
    """Sort key for descending order; a missing value comes first."""
    return -F.coalesce(F.col(column).cast("double"), F.lit(float("inf")))


def operational_report(summary: DataFrame, anomalies: DataFrame, limit: int = LISTED) -> DataFrame:
    """One row composed from the analytics over ``summary`` (``analytics.rollup``) and the anomaly report.

    Levels, event types and services list their first ``limit`` entries: names come from the logs, and a
    document must not grow with them. How many more there are stands beside them; the analytics results hold
    all of them.
    """
    first = or_no_anomalies(anomalies)

    def of(name: str) -> DataFrame:
        return getattr(analytics, name)(analytics.rolled(summary, name))

    def only_row(result: DataFrame) -> Column:
        return result.select(F.struct(*result.columns)).scalar()

    def left_out(result: DataFrame) -> Column:
        return result.agg(F.greatest(F.count(F.lit(1)) - limit, F.lit(0).cast("bigint"))).scalar()

    by_count = [_minus("event_count")]
    services = of("service_performance")
    busiest = services.select("service", "total_count").orderBy(F.desc("total_count"), "service").limit(1)
    figures = of("overall_summary").select(
        "total_records",
        only_row(of("error_summary")).alias("e"),
        only_row(of("response_time_summary")).alias("r"),
        only_row(first).alias("a"),
        only_row(of("server_errors")).alias("s"),
    )
    return figures.select(
        F.col("total_records").alias("total_events"),
        _listed(of("log_level_distribution"), [*by_count, F.col("log_level")], limit).alias("log_level_distribution"),
        _listed(of("event_type_distribution"), [*by_count, F.col("event_type")], limit).alias("event_type_distribution"),
        F.col("e.total_errors").alias("error_count"),
        F.col("e.total_warnings").alias("warning_count"),
        F.col("e.auth_failures").alias("auth_failure_count"),
        F.col("e.database_errors").alias("database_error_count"),
        F.col("r.avg_response_time_ms").alias("average_response_time_ms"),
        F.col("r.max_response_time_ms").alias("max_response_time_ms"),
        _listed(of("slowest_endpoints"), [_minus("avg_response_time_ms"), F.col("endpoint")], limit).alias("slowest_endpoints"),
        _listed(of("most_used_endpoints"), [_minus("request_count"), F.col("endpoint")], limit).alias("busiest_endpoints"),
        _listed(services, [_minus("error_count"), _minus("avg_response_time_ms"), F.col("service")], limit).alias("service_performance"),
        "a.anomaly_count",
        "a.anomaly_rate",
        "a.anomalies_by_service",
        "a.anomalies_by_event_type",
        "a.anomalies_by_status",
        "a.top_anomalous_endpoints",
        "s.server_error_count",
        left_out(of("log_level_distribution")).alias("log_levels_left_out"),
        left_out(of("event_type_distribution")).alias("event_types_left_out"),
        left_out(services).alias("services_left_out"),
        only_row(busiest).alias("busiest_service"),
    )


def top_findings(operational: DataFrame) -> DataFrame:
    """Findings as ``position`` and ``finding``; a single fallback sentence when there are none."""
    services = F.col("service_performance")

    def by_size(entries: Column, name: str, count: str) -> Column:
        """The largest entry, the first by name among equals."""
        keyed = F.transform(
            entries, lambda e: F.struct((-e[count]).alias("order"), e[name].alias("name"), e[count].alias("n"))
        )
        return F.get(F.array_sort(keyed), F.lit(0))

    busiest = F.col("busiest_service")
    worst = F.get(F.filter(services, lambda s: s["error_count"] > 0), F.lit(0))
    slowest = F.get("slowest_endpoints", F.lit(0))
    kind = by_size(F.map_entries("anomalies_by_event_type"), "key", "value")

    def sentence(*parts: str | Column) -> Column:
        return F.concat(*[p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts])

    # Wording of the findings.
    found = F.array(
        sentence("Highest-volume service: ", busiest["service"], " with ", busiest["total_count"], " events"),
        sentence("Highest error-count service: ", worst["service"], " with ", worst["error_count"], " errors"),
        sentence(
            "Slowest endpoint: ", slowest["endpoint"], " (avg ", decimal_text(slowest["avg_response_time_ms"]), " ms)"
        ),
        F.when(
            F.col("anomaly_count") > 0,
            sentence(
                "Detected ", F.col("anomaly_count"), " anomalies (", decimal_text(F.col("anomaly_rate")),
                "% of total events)",
            ),
        ),
        sentence("Highest anomaly-producing event type: ", kind["name"], " (", kind["n"], " anomalies)"),
    )
    listed = F.array_compact(found)
    fallback = F.array(F.lit("No significant anomalies detected in current dataset"))
    return operational.select(
        F.posexplode(F.when(F.size(listed) > 0, listed).otherwise(fallback)).alias("position", "finding")
    ).select((F.col("position") + 1).alias("position"), "finding")


def kpi_row(operational: DataFrame, quality: DataFrame) -> DataFrame:
    """The eight key figures."""
    return operational.select(
        "total_events",
        F.col("error_count").alias("errors"),
        F.col("warning_count").alias("warnings"),
        "average_response_time_ms",
        F.col("server_error_count").alias("server_errors"),
        F.col("anomaly_count").alias("anomalies"),
        "anomaly_rate",
        quality.select("quality_score").scalar().alias("quality_score"),
    )


def quality_document(quality: DataFrame) -> DataFrame:
    """The quality report as it is saved: its times as text with a blank between date and time."""
    return quality.withColumns({c: plain_text(F.col(c)) for c in ("earliest_timestamp", "latest_timestamp")})


def final_report(
    summary: DataFrame, operational: DataFrame, quality: DataFrame, anomalies: DataFrame
) -> DataFrame:
    """The whole document as one nested row."""

    def nested(df: DataFrame) -> Column:
        return df.select(F.struct(*df.columns)).scalar()

    whole = analytics.overall_summary(analytics.rolled(summary, "overall_summary"))
    dataset = F.struct(
        F.col("total_records"),
        iso_text(F.col("earliest_timestamp")).alias("earliest_timestamp"),
        iso_text(F.col("latest_timestamp")).alias("latest_timestamp"),
    )
    in_order = F.transform(F.array_sort(F.collect_list(F.struct("position", "finding"))), lambda f: f["finding"])
    return whole.select(
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("generated_at"),
        dataset.alias("dataset"),
        nested(quality_document(quality)).alias("data_quality"),
        nested(operational.drop("busiest_service")).alias("operational_metrics"),
        nested(or_no_anomalies(anomalies)).alias("anomaly_detection"),
        top_findings(operational).agg(in_order).scalar().alias("top_findings"),
    )


def text_report(final: DataFrame) -> DataFrame:
    """The document as text: ``position`` and ``line``."""
    quality, figures = "data_quality", "operational_metrics"

    def text(column: str) -> Column:
        return F.coalesce(F.col(column).cast("string"), F.lit("None"))

    def rounded(column: str) -> Column:
        return F.coalesce(decimal_text(F.col(column)), F.lit("None"))

    # Headings and labels of the text report.
    lines = [
        ["# FINAL REPORT"],
        [],
        ["Generated: ", text("generated_at")],
        [],
        ["## Dataset"],
        [],
        ["Total records: ", text("dataset.total_records")],
        ["Time range: ", text("dataset.earliest_timestamp"), " to ", text("dataset.latest_timestamp")],
        [],
        ["## Data Quality"],
        [],
        ["Quality score: ", rounded(f"{quality}.quality_score"), "%"],
        ["Checks passed: ", text(f"{quality}.quality_checks_passed")],
        ["Checks failed: ", text(f"{quality}.quality_checks_failed")],
        [],
        ["## Operational Summary"],
        [],
        ["Errors: ", text(f"{figures}.error_count")],
        ["Warnings: ", text(f"{figures}.warning_count")],
        ["Average response time: ", rounded(f"{figures}.average_response_time_ms"), " ms"],
        ["5xx responses: ", text(f"{figures}.server_error_count")],
        [],
        ["## Anomaly Detection"],
        [],
        ["Anomalies: ", text(f"{figures}.anomaly_count")],
        ["Anomaly rate: ", rounded(f"{figures}.anomaly_rate"), "%"],
        [],
        ["## Top Findings"],
        [],
    ]
    parts = [F.concat(F.lit(""), *[p if isinstance(p, Column) else F.lit(p) for p in line]) for line in lines]
    numbered = F.transform("top_findings", lambda f, i: F.concat((i + 1).cast("string"), F.lit(". "), f))
    return final.select(F.posexplode(F.concat(F.array(*parts), numbered)).alias("position", "line"))

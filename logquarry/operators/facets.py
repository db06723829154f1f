"""Filterable views of events and scored events."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logquarry.functions.numbering import numbered, place
from logquarry.schema import ANALYSIS_COLUMNS, ANOMALY_LIST_COLUMNS
from logquarry.session import stored_in_place

# The choice that means no filter, and the size of the recent-events view.
ALL = "All"
RECENT_ROWS = 100
# End of fixed values.

FIRST_RANGE, WIDER = 10, 4  # ids looked at first for each wanted row, and how much wider the next range is


def facet_filter(
    df: DataFrame,
    service: str | None = None,
    log_level: str | None = None,
    event_type: str | None = None,
    anomaly_only: bool = False,
    min_response_time: float | None = None,
) -> DataFrame:
    """Rows matching every chosen facet; ``All``, empty or None leaves a facet open.

    The anomaly and response-time filters are skipped when the frame has no such column.
    """
    for column, choice in (("service", service), ("log_level", log_level), ("event_type", event_type)):
        if choice and choice != ALL:
            df = df.where(F.col(column) == choice)
    if anomaly_only and "is_anomaly" in df.columns:
        df = df.where("is_anomaly")
    if min_response_time is not None and "response_time_ms" in df.columns:
        df = df.where(F.col("response_time_ms") >= min_response_time)
    return df


def facet_values(df: DataFrame, column: str) -> DataFrame:
    """Choices of one facet in display order (``position``, ``value``): All, then the values in their own order."""
    spark = df.sparkSession
    if column not in df.columns:
        return spark.range(1).select(F.lit(0).alias("position"), F.lit(ALL).alias("value"))
    values = df.select(F.col(column).alias("key")).where(F.col("key").isNotNull()).distinct()
    # sorted by range and numbered from counts per partition: names from the logs have no bound that fits a task
    placed = stored_in_place(values.repartitionByRange("key").sortWithinPartitions("key").withColumn("place", place()))
    listed = numbered(placed, "position", 1).select(F.col("position").cast("int").alias("position"), F.col("key").cast("string").alias("value"))
    head = spark.range(1).select(F.lit(0).alias("position"), F.lit(ALL).alias("value"))
    return head.unionByName(listed).orderBy("position")


def anomalous_events(scored: DataFrame) -> DataFrame:
    """Anomalies with the display columns that exist."""
    return scored.where("is_anomaly").select(*[c for c in ANOMALY_LIST_COLUMNS if c in scored.columns])


def recent_events(events: DataFrame, rows: int = RECENT_ROWS, newest: int | None = None, **facets) -> DataFrame:
    """The newest ``rows`` facet matches by id, in id order.

    They are looked for among the highest ids, in ranges that grow until one holds enough matches: files and
    row groups below the range are skipped by their bounds. ``newest`` is the highest id, where it is known;
    else the id column is read for it. Rows without an id are the oldest.
    """
    matches = facet_filter(events.select(*ANALYSIS_COLUMNS), **facets)
    if newest is None:
        newest = events.agg(F.max("id")).first()[0]
    span = FIRST_RANGE * max(1, rows)
    while newest is not None and span <= newest:
        inside = matches.where(F.col("id") > newest - span)
        if inside.select(F.lit(1)).limit(rows).count() == rows:
            matches = inside
            break
        span *= WIDER
    return matches.orderBy(F.desc("id")).limit(rows).orderBy("id")

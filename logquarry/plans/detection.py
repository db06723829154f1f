"""End-to-end anomaly detection."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logquarry.operators import features, forest, rules
from logquarry.schema import ANALYSIS_COLUMNS, CATEGORICAL_FEATURES, SCORED_COLUMNS
from logquarry.session import Scratch
from logquarry.sources import files


def score_events(
    events: DataFrame, area: Scratch, contamination: float = forest.CONTAMINATION, seed: int = forest.SEED
) -> DataFrame:
    """Events with model score, decision, rule signals and reason: the nineteen scored columns.

    Jobs: the passes of the profile, one sampled pass to grow the trees, one pass that scores and stores
    the events in ``area``, then the quantile over the stored scores. The returned frame reads the stored
    result.
    """
    events = events.select(*ANALYSIS_COLUMNS)
    found = features.profile(events)
    known = found.literals()
    if found.total < forest.minimum_rows(contamination):
        filled = events.withColumns({c: F.coalesce(c, F.lit(features.UNKNOWN)) for c in CATEGORICAL_FEATURES})
        decided = forest.without_model(filled)
    else:
        if not 0 < contamination <= 0.5:
            raise ValueError("contamination must be in (0, 0.5]")
        model = forest.fit(features.model_inputs(events, known), found.total, seed)
        decided = forest.decide(area.store(forest.with_scores(events, known, model), "scored"), contamination)
    signals = rules.rule_signals(decided, known["rt_p95"])
    return signals.withColumn("anomaly_reason", rules.anomaly_reason(F.col("ml_prediction"))).select(*SCORED_COLUMNS)


def run_detection(events: DataFrame, output_dir: str, contamination: float = forest.CONTAMINATION) -> DataFrame:
    """Score the events, save ``anomalies`` (CSV) and ``anomaly_report`` (JSON), return the saved rows."""
    with Scratch(events.sparkSession) as area:
        scored = score_events(events, area, contamination)
        files.write_scored(scored, f"{output_dir}/anomalies")
        files.write_json(anomaly_report(scored), f"{output_dir}/anomaly_report")
    return files.read_scored(events.sparkSession, f"{output_dir}/anomalies")


def anomaly_report(scored: DataFrame) -> DataFrame:
    """Totals and the five breakdowns (value -> count maps, largest first) as one row."""
    entries = F.array_sort(F.collect_list(F.struct("position", "value", "event_count")))
    counts = F.map_from_entries(F.transform(entries, lambda e: F.struct(e["value"], e["event_count"])))
    parts = rules.anomaly_breakdowns(scored).groupBy("dimension").agg(counts.alias("counts"))
    by_dimension = parts.agg(F.map_from_entries(F.collect_list(F.struct("dimension", "counts")))).scalar()

    def breakdown(dimension: str, name: str):
        found = F.try_element_at(by_dimension, F.lit(dimension))
        return F.coalesce(found, F.create_map().cast("map<string,bigint>")).alias(name)

    return rules.anomaly_totals(scored).select(
        "*",
        breakdown("service", "anomalies_by_service"),
        breakdown("event_type", "anomalies_by_event_type"),
        breakdown("log_level", "anomalies_by_log_level"),
        breakdown("status", "anomalies_by_status"),
        breakdown("endpoint", "top_anomalous_endpoints"),
    )

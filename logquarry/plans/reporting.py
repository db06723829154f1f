"""Analytics files and the combined reports."""

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logquarry.operators import analytics, quality, reports
from logquarry.session import Scratch, gathered
from logquarry.sources import files


def stored_summary(events: DataFrame, area: Scratch) -> DataFrame:
    """The rolled-up facts, written once: the only scan of the events that the fact queries need."""
    return area.store(analytics.rollup(events), "rollup", partition_by=["part"])


def run_analytics(events: DataFrame, output_dir: str) -> dict[str, str]:
    """Save each of the thirteen results as JSON under ``analytics/<name>`` and return the paths.

    One folder per result, written in parallel: hours and users have no bound that fits one document.
    """
    paths = {}
    with Scratch(events.sparkSession) as area:
        for name, result in analytics.all_analytics(events, stored_summary(events, area)).items():
            paths[name] = f"{output_dir}/analytics/{name}"
            files.write_json(result, paths[name])
    return paths


def measures(results: dict[str, DataFrame]) -> DataFrame:
    """All results in one long table: ``report``, ``key``, ``measure``, ``value``."""
    parts = []
    for name, result in results.items():
        numbers = [f.name for f in result.schema.fields if f.dataType.typeName() in ("long", "integer", "double")]
        key = result.columns[0]
        if key in numbers and name != "status_distribution":  # a single row without a key
            key, keyed = "all", result.select(F.lit("all").alias("key"), *[F.col(c).cast("double") for c in numbers])
        else:
            numbers = [c for c in numbers if c != key]
            keyed = result.select(F.col(key).cast("string").alias("key"), *[F.col(c).cast("double") for c in numbers])
        long = keyed.unpivot("key", numbers, "measure", "value")
        parts.append(long.select(F.lit(name).alias("report"), "key", "measure", "value"))
    return reduce(DataFrame.unionByName, parts)


def combined_reports(events: DataFrame, anomalies: DataFrame, area: Scratch) -> dict[str, DataFrame]:
    """Quality checks and report, operational report and final document.

    The events are read twice: rolled up for all figures and lists, and for the quality counts. The
    reports themselves are a row each, of bounded size, and are computed once.
    """
    anomalies = gathered(anomalies)
    summary = stored_summary(events, area)
    measured = gathered(quality.measurements(events))
    checked = quality.quality_report(measured)
    operational = gathered(reports.operational_report(summary, anomalies))
    final = gathered(reports.final_report(summary, operational, checked, anomalies))
    return {"checks": quality.quality_checks(measured), "quality": checked, "operational": operational, "final": final}


def run_reporting(spark: SparkSession, events: DataFrame, output_dir: str) -> dict[str, str]:
    """Save the quality, operational and final reports; reads ``anomaly_report`` where detection left it."""
    anomalies = files.read_report(spark, f"{output_dir}/anomaly_report", reports.ANOMALY_REPORT_SCHEMA)
    with Scratch(spark) as area:
        built = combined_reports(events, anomalies, area)
    names = (
        "data_quality_report", "data_quality_summary", "operational_report", "final_report", "final_report_txt",
    )
    paths = {name: f"{output_dir}/{name}" for name in names}
    files.write_json(reports.quality_document(built["quality"]), paths["data_quality_report"])
    files.write_checks(built["checks"].orderBy("position"), paths["data_quality_summary"])
    files.write_json(built["operational"].drop("busiest_service"), paths["operational_report"])
    files.write_json(built["final"], paths["final_report"])
    files.write_text(reports.text_report(built["final"]), paths["final_report_txt"])
    return paths

import json

import pytest
from pyspark.sql import functions as F

from logquarry.functions.hashing import record_hash
from logquarry.operators import facets, quality, reports
from logquarry.plans import detection, reporting
from logquarry.sources import files
from logquarry.sources import table as tables

ANOMALY = {
    "total_records": 10, "anomaly_count": 4, "anomaly_rate": 40.0, "normal_count": 6, "server_error_count": 2,
    "anomalies_by_event_type": {"CACHE_ACCESS": 2, "API_REQUEST": 2},
}


@pytest.fixture(scope="module")
def no_report(spark):
    return spark.createDataFrame([], reports.ANOMALY_REPORT_SCHEMA)


@pytest.fixture(scope="module")
def operational(sample, no_report, kept):
    return reports.operational_report(reporting.stored_summary(sample, kept), no_report)


def checks_of(events):
    return {r["check_name"]: r for r in quality.quality_checks(quality.measurements(events)).collect()}


def test_quality_checks(sample, gaps):
    checks = checks_of(sample)
    assert len(checks) == 22
    assert checks["log_level_completeness"]["message"] == "log_level: 0 NULL values (0.0%)"
    assert (checks["status_completeness"]["value"], checks["status_completeness"]["status"]) == (3, "PASS")
    assert checks["status_null_count"]["status"] == "WARN"
    checks = checks_of(gaps)
    assert (checks["service_completeness"]["status"], checks["service_null_count"]["value"]) == ("WARN", 3)
    assert checks["endpoint_completeness"]["message"] == "endpoint: 3 NULL values (60.0%)"


def test_failing_checks(make_events, spark):
    at = "2026-09-20 10:00:00"
    events = make_events(
        [(at, "TRACE", None, "a", None, "GET", 99, -1, None, None), (None, "INFO", "X", "a", None, "GET", 600, 5, None, None),
         (at, "info", "X", "a", None, "GET", 200, 5, "U", None)]
    ).withColumn("id", F.when(F.col("id") < 3, 1).otherwise(F.lit(None)))
    checks = checks_of(events.unionByName(events.where("id is null")))
    failed = {n for n, r in checks.items() if r["status"] == "FAIL"}
    assert failed == {
        "timestamp_completeness", "event_type_completeness", "endpoint_completeness", "negative_response_times",
        "invalid_http_status", "duplicate_ids", "valid_log_levels",
    }
    assert [checks[n]["value"] for n in ("duplicate_ids", "valid_log_levels", "invalid_http_status")] == [2, 3, 2]
    assert checks["timestamp_completeness"]["message"] == "timestamp: 1 NULL values (25.0%)"


def test_score(sample, no_events):
    row = quality.quality_report(quality.measurements(sample)).first()
    # all six optional columns have gaps, each warned once
    assert (row["quality_checks_passed"], row["quality_checks_failed"], row["quality_checks_warned"]) == (16, 0, 6)
    assert row["quality_score"] == 72.7 and len(row["checks"]) == 22
    assert [c["check_name"] for c in row["checks"]][:2] == ["timestamp_completeness", "log_level_completeness"]
    empty = quality.quality_report(quality.measurements(no_events)).first()
    assert tuple(empty) == (0, None, None, 0, 0, 0, 0.0, [])


def test_score_with_twelve_passing_checks(make_events):
    """22 checks of which twelve pass: 54.5."""
    at, full = "2026-09-20 10:00:00", ("INFO", "API_REQUEST", "a", "/e", "GET", 200, 5)
    rows = [(at, *full, "U1", None)] * 4 + [(at, "INFO", "USER_LOGIN", None, None, None, None, None, "U1", None)] * 5
    rows += [(at, "INFO", "API_REQUEST", "a", None, None, None, None, None, None)] * 2
    row = quality.quality_report(quality.measurements(make_events(rows))).first()
    assert (row["quality_checks_passed"], row["quality_checks_warned"], row["quality_score"]) == (12, 10, 54.5)


def test_operational(operational):
    row = operational.first()
    assert (row["total_events"], row["error_count"], row["warning_count"]) == (10, 3, 2)
    assert (row["average_response_time_ms"], row["max_response_time_ms"], row["server_error_count"]) == (290.38, 900, 2)
    assert [r["log_level"] for r in row["log_level_distribution"]] == ["INFO", "ERROR", "WARN", "DEBUG"]
    assert [r["service"] for r in row["service_performance"]] == ["shipping", "catalog", "search"]
    assert [r["endpoint"] for r in row["slowest_endpoints"]] == ["/labels", "/find", "/items"]
    assert (row["anomaly_count"], row["anomaly_rate"], row["anomalies_by_service"]) == (0, 0.0, {})


def test_lists_of_the_document_are_bounded(make_events, no_report, area):
    at = "2025-03-04 00:00:00"
    rows = [(at, "ERROR", "API_REQUEST", f"s{i:02d}", f"/{i}", "GET", 200, i, None, None) for i in range(20)]
    rows += [(at, "INFO", "API_REQUEST", "zz", "/z", "GET", 200, 1, None, None)] * 3
    summary = reporting.stored_summary(make_events(rows), area)
    report = reports.operational_report(summary, no_report, limit=5)
    assert [r["service"] for r in report.first()["service_performance"]] == [f"s{i}" for i in range(19, 14, -1)]
    assert reports.top_findings(report).orderBy("position").first()["finding"] == "Highest-volume service: zz with 3 events"


def test_findings(spark, sample, operational, no_report, no_events, area):
    assert [r["finding"] for r in reports.top_findings(operational).orderBy("position").collect()] == [
        "Highest-volume service: catalog with 3 events",
        "Highest error-count service: shipping with 2 errors",
        "Slowest endpoint: /labels (avg 800.0 ms)",
    ]
    report = spark.createDataFrame(
        [tuple(ANOMALY.get(f.name) for f in reports.ANOMALY_REPORT_SCHEMA)], reports.ANOMALY_REPORT_SCHEMA
    )
    with_anomalies = reports.operational_report(reporting.stored_summary(sample, area), report)
    assert [r["finding"] for r in reports.top_findings(with_anomalies).orderBy("position").collect()][3:] == [
        "Detected 4 anomalies (40.0% of total events)",
        "Highest anomaly-producing event type: API_REQUEST (2 anomalies)",
    ]
    nothing = reports.operational_report(reporting.stored_summary(no_events, area), no_report)
    assert [tuple(r) for r in reports.top_findings(nothing).collect()] == [
        (1, "No significant anomalies detected in current dataset")
    ]
    kpi = reports.kpi_row(with_anomalies, quality.quality_report(quality.measurements(sample))).first()
    assert tuple(kpi) == (10, 3, 2, 290.38, 2, 4, 40.0, 72.7)


def test_saved_reports(spark, make_events, tmp_path):
    rows = [("2025-06-02 07:00:00", "INFO", "API_REQUEST", "search", "/e", "GET", 200, 5 + i, "U", None) for i in range(39)]
    events = make_events(rows + [("2025-06-02 08:00:00.25", "ERROR", "DATABASE_ERROR", "db", None, None, 503, 9000, None, None)])
    out = str(tmp_path)
    detection.run_detection(events, out)
    paths = reporting.run_reporting(spark, events, out)

    def document(name):
        (line,) = [r["value"] for r in spark.read.text(paths[name]).collect()]
        return json.loads(line)

    dq, final = document("data_quality_report"), document("final_report")
    assert dq["total_records"] == 40 and len(dq["checks"]) == 22
    summary = spark.read.csv(paths["data_quality_summary"], header=True)
    assert summary.columns == ["check_name", "category", "status", "value", "threshold", "message"]
    assert summary.count() == 22
    assert final["dataset"] == {
        "total_records": 40, "earliest_timestamp": "2025-06-02T07:00:00", "latest_timestamp": "2025-06-02T08:00:00.250000",
    }
    for times in (final["data_quality"], dq):  # the two documents of a run agree
        assert times["earliest_timestamp"] == "2025-06-02 07:00:00"
        assert times["latest_timestamp"] == "2025-06-02 08:00:00.250000"
    anomalies = final["anomaly_detection"]["anomaly_count"]
    assert anomalies == final["operational_metrics"]["anomaly_count"] > 0
    assert document("operational_report")["anomalies_by_event_type"] == final["anomaly_detection"]["anomalies_by_event_type"]
    assert final["top_findings"][0] == "Highest-volume service: search with 39 events"
    text = [r["value"] for r in spark.read.text(paths["final_report_txt"]).collect()]
    assert text[0] == "# FINAL REPORT" and "5xx responses: 1" in text and f"Anomalies: {anomalies}" in text
    assert "Time range: 2025-06-02T07:00:00 to 2025-06-02T08:00:00.250000" in text
    assert text[-1] == f"{len(final['top_findings'])}. {final['top_findings'][-1]}"


def test_reports_without_events(spark, no_events, tmp_path):
    paths = reporting.run_reporting(spark, no_events, str(tmp_path))
    text = [r["value"] for r in spark.read.text(paths["final_report_txt"]).collect()]
    assert "Total records: 0" in text and "Quality score: 0.0%" in text and "Time range: None to None" in text
    assert text[-1] == "1. No significant anomalies detected in current dataset"
    assert spark.read.csv(paths["data_quality_summary"], header=True).count() == 0
    assert files.read_report(spark, str(tmp_path / "none"), reports.ANOMALY_REPORT_SCHEMA).count() == 0


@pytest.fixture(scope="module")
def listed(make_events):
    at = "2025-05-01 12:0%d:00"
    rows = [
        (at % 0, "DEBUG", "API_REQUEST", "search", "/find", "GET", 200, 75, "kim", None),
        (at % 1, "WARN", "DATABASE_QUERY", "search", None, None, None, 310, None, None),
        (at % 2, "ERROR", "API_REQUEST", "billing", "/bills", "POST", 503, 1200, "lee", None),
        (at % 3, "DEBUG", "SERVICE_STOP", "billing", None, None, None, None, None, None),
        (at % 4, "WARN", "API_REQUEST", "search", "/find", "GET", 404, 90, "kim", None),
    ]
    return make_events(rows).withColumn("is_anomaly", F.col("id").isin(2, 3))


@pytest.mark.parametrize(
    "choice, ids",
    [
        ({"service": "search"}, [1, 2, 5]),
        ({"log_level": "WARN"}, [2, 5]),
        ({"event_type": "SERVICE_STOP"}, [4]),
        ({"anomaly_only": True}, [2, 3]),
        ({"min_response_time": 90}, [2, 3, 5]),
        ({"service": "Search"}, []),
        ({"service": "billing", "log_level": "DEBUG"}, [4]),
        ({"service": None, "log_level": "All", "event_type": ""}, [1, 2, 3, 4, 5]),
        ({"service": "search", "min_response_time": 80, "anomaly_only": True}, [2]),
    ],
)
def test_facet_filter(listed, choice, ids):
    assert [r["id"] for r in facets.facet_filter(listed, **choice).orderBy("id").collect()] == ids


def test_filters_on_absent_columns_are_skipped(listed):
    plain = listed.drop("is_anomaly", "response_time_ms")
    assert facets.facet_filter(plain, anomaly_only=True, min_response_time=1).count() == 5


def test_facet_values(listed, no_events):
    def values(df, column):
        rows = facets.facet_values(df, column).collect()
        assert [r["position"] for r in rows] == list(range(len(rows)))
        return [r["value"] for r in rows]

    assert values(listed, "service") == ["All", "billing", "search"]
    assert values(listed, "user_id") == ["All", "kim", "lee"]
    assert values(listed, "response_time_ms") == ["All", "75", "90", "310", "1200"]  # numbers in their own order
    assert values(listed, "no_such_column") == values(no_events, "service") == ["All"]


def test_lists(listed, make_events):
    shown = facets.anomalous_events(listed)
    assert shown.columns == ["timestamp", "service", "event_type", "endpoint", "status", "response_time_ms"]
    assert shown.count() == 2
    many = make_events([("2025-05-01 12:00:00", "INFO" if i % 2 else "WARN", "USER_LOGIN", *[None] * 7) for i in range(700)])
    assert [r["id"] for r in facets.recent_events(many).collect()] == list(range(601, 701))
    assert [r["id"] for r in facets.recent_events(many, rows=3, log_level="INFO").collect()] == [696, 698, 700]
    old = many.withColumn("log_level", F.when(F.col("id") < 9, "ERROR").otherwise("INFO"))
    assert [r["id"] for r in facets.recent_events(old, log_level="ERROR").collect()] == list(range(1, 9))


@pytest.mark.parametrize("parts", [1, 5])
def test_duplicate_ids_are_counted_in_bitmaps(spark, make_events, parts):
    ids = [None, None, None, 0, 0, -1, -1, -32768, -32769, 1, 32768, 32769, 32769, 2**62, 2**62, -(2**62), *range(100, 40_000)]
    rows = spark.createDataFrame([(i,) for i in ids], "id bigint").repartition(parts)
    one = make_events([("2025-08-12 14:00:00", "INFO", "USER_LOGIN", *[None] * 7)]).drop("id")
    measured = quality.measurements(one.crossJoin(rows))
    expected = len(ids) - len(set(ids))
    assert measured.first()["duplicate_ids"] == expected and "no_id" not in measured.columns
    plan = measured._jdf.queryExecution().toString()
    assert "bitmap_construct_agg" in plan and "hashpartitioning(id" not in plan


def test_duplicate_ids_of_nothing(no_events):
    assert quality.measurements(no_events).first()["duplicate_ids"] == 0


def test_left_out_entries_are_counted(make_events, no_report, area):
    rows = [("2025-05-01 12:00:00", "INFO", f"E{i}", f"s{i % 8}", *[None] * 6) for i in range(12)]
    report = reports.operational_report(reporting.stored_summary(make_events(rows), area), no_report, limit=5).first()
    assert (report["log_levels_left_out"], report["event_types_left_out"], report["services_left_out"]) == (0, 7, 3)
    assert len(report["event_type_distribution"]) == 5 and len(report["service_performance"]) == 5


def test_facet_values_are_numbered_by_partition(make_events):
    rows = [("2025-05-01 12:00:00", "INFO", "USER_LOGIN", f"s{i % 500:03d}", *[None] * 6) for i in range(1500)]
    found = facets.facet_values(make_events(rows).repartition(6), "service")
    assert [(r["position"], r["value"]) for r in found.collect()] == [(0, "All")] + [(i + 1, f"s{i:03d}") for i in range(500)]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "row_number" not in plan


def test_recent_events_are_looked_for_at_the_top(spark, make_events, monkeypatch):
    many = make_events([("2025-05-01 12:00:00", "ERROR" if i < 30 else "INFO", "USER_LOGIN", *[None] * 7) for i in range(3000)])
    for level, rows in (("INFO", 7), ("ERROR", 7), ("ERROR", 40), ("WARN", 3)):
        want = [r["id"] for r in many.where(F.col("log_level") == level).orderBy(F.desc("id")).limit(rows).collect()][::-1]
        assert [r["id"] for r in facets.recent_events(many, rows=rows, log_level=level).collect()] == want
    plan = facets.recent_events(many, rows=2, log_level="INFO")._jdf.queryExecution().optimizedPlan().toString()
    assert "2980" in plan  # the last range looked at: twenty ids


def test_recent_logs_of_a_table_skip_older_files(spark, make_events, table, tmp_path):
    tables.create_table(spark, table, 1, str(tmp_path / "t"))
    order = {"file": F.lit(""), "block": F.lit(0), "row": F.monotonically_increasing_id()}
    for load in range(6):
        rows = [(f"2025-05-{load + 1:02d} 12:00:00", "INFO", "USER_LOGIN", None, None, None, None, None, f"U{load}_{i}", None) for i in range(500)]
        loaded = make_events(rows).drop("id").withColumns({"record_hash": record_hash(), **order})
        tables.load_rows(spark, loaded, table)
    recent = tables.recent_logs(spark, table, rows=5)
    assert [r["id"] for r in recent.collect()] == list(range(2996, 3001))
    leaves = recent._jdf.queryExecution().executedPlan().executedPlan().collectLeaves()
    read = 0
    for i in range(leaves.size()):
        stage = leaves.apply(i)
        scans = stage.plan().collectLeaves() if stage.getClass().getSimpleName().endswith("QueryStageExec") else None
        for scan in [stage] if scans is None else [scans.apply(k) for k in range(scans.size())]:
            read += scan.metrics().apply("numOutputRows").value()
    assert read <= 500  # the row groups of one load out of six
    assert tables.recent_logs(spark, "no_such_table").count() == 0

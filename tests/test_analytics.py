from datetime import datetime

import pytest

from logquarry.operators import analytics
from logquarry.plans import reporting
from logquarry.sources.table import log_events

DICT_RESULTS = {"overall_summary", "error_summary", "response_time_summary"}


def rows(df):
    return [tuple(r) for r in df.collect()]


def direct(events):
    """Every result from the events themselves."""
    facts = analytics.facts(events)
    results = {name: query(facts) for name, query in analytics.FACT_QUERIES.items()}
    return results | {"user_activity_summary": analytics.user_activity_summary(events)}


@pytest.fixture(scope="module", params=["events", "rollup"])
def results(request, sample, kept):
    """Every result twice: from the events, and from the stored roll-up."""
    if request.param == "rollup":
        return analytics.all_analytics(sample, reporting.stored_summary(sample, kept))
    return direct(sample)


def test_sample(results):
    midnight = datetime(2025, 3, 4)
    expected = {
        "overall_summary": [(10, datetime(2025, 3, 3, 23, 40, 5), datetime(2025, 3, 4, 1, 45))],
        "log_level_distribution": [("INFO", 4, 40.0), ("ERROR", 3, 30.0), ("WARN", 2, 20.0), ("DEBUG", 1, 10.0)],
        "event_type_distribution": [
            ("API_REQUEST", 6, 60.0), ("AUTH_FAILURE", 1, 10.0), ("CACHE_ACCESS", 1, 10.0),
            ("DATABASE_ERROR", 1, 10.0), ("SERVICE_START", 1, 10.0),
        ],
        "service_distribution": [("catalog", 3, 30.0), ("search", 3, 30.0), (None, 2, 20.0), ("shipping", 2, 20.0)],
        "status_distribution": [
            (200, 2, 20.0), (304, 1, 10.0), (403, 1, 10.0), (404, 1, 10.0), (502, 1, 10.0), (503, 1, 10.0), (None, 3, 30.0),
        ],
        "status_class_distribution": [("2xx", 2, 20.0), ("3xx", 1, 10.0), ("4xx", 2, 20.0), ("5xx", 2, 20.0), ("other", 3, 30.0)],
        "error_summary": [(3, 2, 1, 1)],
        "response_time_summary": [(290.38, 3, 900, 8)],
        "slowest_endpoints": [("/labels", 2, 800.0, 900), ("/find", 2, 300.0, 500), ("/items", 2, 30.0, 40)],
        "most_used_endpoints": [("/find", 2, 300.0), ("/items", 2, 30.0), ("/labels", 2, 800.0)],
        "service_performance": [
            ("shipping", 2, 2, 800.0, 900), ("catalog", 3, 1, 30.0, 40), ("search", 3, 0, 300.0, 500),
        ],
        "hourly_traffic": [(datetime(2025, 3, 3, 23), 2), (midnight, 4), (midnight.replace(hour=1), 4)],
        "user_activity_summary": [("kim", 3, 50.0), ("lee", 2, 33.33), ("mia", 1, 16.67)],
    }
    assert {name: rows(df) for name, df in results.items()} == expected


def test_gaps(gaps):
    results = direct(gaps)
    assert rows(results["service_distribution"]) == [(None, 3, 60.0), ("mail", 2, 40.0)]
    assert rows(results["status_distribution"]) == [(202, 1, 20.0), (None, 4, 80.0)]
    assert rows(results["status_class_distribution"]) == [("2xx", 1, 20.0), ("other", 4, 80.0)]
    assert rows(results["user_activity_summary"]) == [("ann", 2, 100.0)]
    assert rows(results["response_time_summary"]) == [(12.5, 10, 15, 2)]
    assert rows(results["service_performance"]) == [("mail", 2, 1, 10.0, 10)]
    assert rows(results["slowest_endpoints"]) == [("/send", 1, 10.0, 10)]


@pytest.mark.parametrize("stored", [False, True])
def test_empty_and_missing_table(spark, stored, area):
    events = log_events(spark, "no_such_table")
    results = analytics.all_analytics(events, reporting.stored_summary(events, area)) if stored else direct(events)
    for name, df in results.items():
        found = rows(df)
        if name in DICT_RESULTS:
            assert len(found) == 1 and all(v in (0, None) for v in found[0])
        else:
            assert found == []


def test_null_sorting_and_limits(make_events):
    at = "2026-09-20 10:00:00"
    events = make_events(
        [(at, "ERROR", "DATABASE_ERROR", "quiet", None, None, None, None, None, None)]
        + [(at, "ERROR", "API_REQUEST", "slow", f"/e{i:02d}", "GET", 200, i, None, None) for i in range(1)]
        + [(at, "INFO", "API_REQUEST", "wide", f"/e{i:02d}", "GET", 200, 5, None, None) for i in range(20)]
        + [("2026-09-20 23:59:59.999", "INFO", "API_REQUEST", "wide", "/z", "GET", 150, None, None, None)]
    )
    facts = analytics.facts(events)
    performance = rows(analytics.service_performance(facts))
    assert [r[0] for r in performance] == ["quiet", "slow", "wide"]  # equal errors: no average comes first
    assert len(rows(analytics.slowest_endpoints(facts))) == 10
    assert [r[0] for r in rows(analytics.slowest_endpoints(facts, limit=2))] == ["/e01", "/e02"]
    assert rows(analytics.most_used_endpoints(facts, limit=1)) == [("/e00", 2, 2.5)]
    assert ("/z", 1, None) in rows(analytics.most_used_endpoints(facts, limit=50))
    assert rows(analytics.hourly_traffic(facts)) == [(datetime(2026, 9, 20, 10), 22), (datetime(2026, 9, 20, 23), 1)]
    assert ("other", 2, 8.7) in rows(analytics.status_class_distribution(facts))


def test_saved_results(spark, sample, tmp_path):
    assert len(reporting.run_analytics(sample, str(tmp_path))) == 13
    (saved,) = spark.read.json(str(tmp_path / "analytics" / "overall_summary")).collect()
    assert saved["earliest_timestamp"] == "2025-03-03T23:40:05"
    assert spark.read.json(str(tmp_path / "analytics" / "status_distribution")).where("status is null").count() == 1


def test_rollup_scans_the_events_once(sample):
    plan = analytics.rollup(sample)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") + plan.count("LocalTableScan") == 1 and plan.count("Exchange") == 1


def test_hot_group_is_combined_before_the_shuffle(spark, sample):
    plan = analytics.service_distribution(analytics.facts(sample))._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum(1)" in plan or "partial_sum" in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan

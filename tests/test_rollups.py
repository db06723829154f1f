"""Daily roll-ups of a growing table: only days that loads have touched are scanned again."""

import pytest
from pyspark.sql import functions as F

from logquarry.functions.hashing import record_hash
from logquarry.operators import analytics
from logquarry.plans import reporting
from logquarry.sources import rollups
from logquarry.sources import table as tables
from logquarry.sources.ledger import Files, location


def batch(make_events, days, tag, n=40):
    rows = [
        (f"2025-06-{d:02d} {i % 24:02d}:10:00", "ERROR" if i % 9 == 0 else "INFO", "API_REQUEST", f"s{i % 3}", f"/e{i % 5}", "GET",
         500 if i % 7 == 0 else 200, i * d, f"U{i % 6}", f"{tag}{i}")
        for d in days for i in range(n)
    ]
    order = {"file": F.lit(""), "block": F.lit(0), "row": F.monotonically_increasing_id()}
    return make_events(rows).drop("id").withColumns({"record_hash": record_hash(), **order})


def same_as_from_the_rows(spark, table):
    events = tables.load_log_data(spark, table)
    want = reporting.measures(analytics.all_analytics(events, analytics.rollup(events)))
    got = reporting.measures(rollups.table_analytics(spark, table))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def days_of(rows):
    return sorted(r["event_date"].day for r in rows.select("event_date").distinct().collect())


def test_only_touched_days_are_scanned_again(spark, make_events, table, tmp_path):
    tables.create_table(spark, table, 2, str(tmp_path / "t"))
    tables.load_rows(spark, batch(make_events, [1, 2, 3, 4], "a"), table)
    assert days_of(rollups.stale_rows(spark, table)[0]) == [1, 2, 3, 4]
    same_as_from_the_rows(spark, table)
    assert rollups.stale_rows(spark, table)[0] is None
    tables.load_rows(spark, batch(make_events, [3, 9], "b"), table)
    tables.load_rows(spark, batch(make_events, [1, 2, 3], "a"), table)  # nothing new
    stale, _ = rollups.stale_rows(spark, table)
    assert days_of(stale) == [3, 9]
    files = stale.select(F.input_file_name().alias("f")).distinct().collect()
    assert files and all("event_date=2025-06-03" in r["f"] or "event_date=2025-06-09" in r["f"] for r in files)
    plan = stale._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [event_date" in plan and "2025-06-03" in plan or "cast(event_date" not in plan
    same_as_from_the_rows(spark, table)
    assert rollups.stale_rows(spark, table)[0] is None


def test_a_refresh_that_stops_is_repeated(spark, make_events, table, tmp_path, monkeypatch):
    tables.create_table(spark, table, 2, str(tmp_path / "t"))
    tables.load_rows(spark, batch(make_events, [1, 2], "a"), table)
    with monkeypatch.context() as m:
        m.setattr(Files, "write", lambda *a, **b: (_ for _ in ()).throw(OSError("stopped")))
        with pytest.raises(OSError, match="stopped"):
            rollups.refresh(spark, table)
    assert days_of(rollups.stale_rows(spark, table)[0]) == [1, 2]
    same_as_from_the_rows(spark, table)
    files = Files(spark, f"{location(spark, table)}/{rollups.FOLDER}")
    stream = files.fs.create(files.path(f"{files.folder}/{9:020d}.manifest"), True)  # cut off while it was written
    stream.close()
    same_as_from_the_rows(spark, table)


def test_an_empty_table(spark, table, tmp_path):
    tables.create_table(spark, table, 2, str(tmp_path / "t"))
    same_as_from_the_rows(spark, table)

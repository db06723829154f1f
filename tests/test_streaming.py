from logquarry.sources import table as tables
from logquarry.streaming import ingest

AT = "2025-07-14 06:05:04,030"


def test_new_files_are_loaded_once_and_no_line_stops_the_stream(spark, tmp_path, table):
    inbox, rejected, checkpoint = (str(tmp_path / n) for n in ("inbox", "rejected", "checkpoint"))
    (tmp_path / "inbox").mkdir()

    def run():
        query = ingest.start_ingest(spark, inbox, rejected, checkpoint, table, buckets=2)
        query.awaitTermination(120)
        assert query.exception() is None
        return sorted(r["user_id"] for r in tables.log_events(spark, table).collect())

    login = f"{AT} | INFO | USER_LOGIN | user_id="
    request = f"{AT} | INFO | API_REQUEST | service=search"
    (tmp_path / "inbox" / "a.log").write_text(f"{login}kim\n{login}lee\n{login}kim\njunk\n\n")
    assert run() == ["kim", "lee"]
    long = "/" + "x" * 101
    (tmp_path / "inbox" / "b.log").write_text(
        f"{request} | response_time_ms=3000000000\n{request} | endpoint={long}\n{request} | status=1\n{login}lee\n{login}mia\n"
    )
    assert run() == ["kim", "lee", "mia"]
    (tmp_path / "inbox" / "c.log").write_text(f"{login}ann\n")
    assert run() == ["ann", "kim", "lee", "mia"]
    assert run() == ["ann", "kim", "lee", "mia"]
    lost = spark.read.csv(rejected, header=True)
    assert sorted(r["rejection_reason"] for r in lost.collect()) == [
        "Insufficient pipe-delimited sections",
        "Out-of-range status: 1",
        "endpoint is longer than 100",
        "response_time_ms out of range: 3000000000",
    ]
    assert {r["raw_line"] for r in lost.where("rejection_reason like '%longer%'").collect()} == {f"{request} | endpoint={long}"}
    assert sorted(r["id"] for r in tables.log_events(spark, table).collect()) == [1, 2, 3, 4]
    tables.compact(spark, table, "2025-07-14")
    assert sorted(r["id"] for r in tables.log_events(spark, table).collect()) == [1, 2, 3, 4]
    assert spark.table(table).select("_metadata.file_path").distinct().count() <= 2

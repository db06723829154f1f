import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from logquarry.operators import parse, validate
from logquarry.plans.processing import routed_records, stage_counts
from logquarry.schema import RECORD_COLUMNS

AT = "2025-07-14 06:05:04,030"


@pytest.fixture(scope="module")
def parse_all(spark):
    def run(lines):
        df = spark.createDataFrame(list(enumerate(lines)), "n int, line string")
        rows = parse.parse_lines(df).orderBy("n").collect()
        assert [r["raw_line"] for r in rows] == list(lines)
        return rows

    return run


def test_request_fields(parse_all):
    (r,) = parse_all(
        [f"{AT} | WARN | API_REQUEST | service=billing | endpoint=/bills | method=PUT | status=404 |"
         " response_time_ms=37 | user_id=kim7"]
    )
    assert r["rejection_reason"] is None
    assert r["timestamp"] == datetime(2025, 7, 14, 6, 5, 4, 30000)
    assert [r[c] for c in RECORD_COLUMNS[1:]] == [
        "WARN", "API_REQUEST", "billing", "/bills", "PUT", 404, 37, "kim7", None,
    ]


@pytest.mark.parametrize(
    "event, detail, service, user, message",
    [
        ("USER_LOGIN", "user_id=U1 | ip=10.0.0.1 | login_method=sso", None, "U1", "ip=10.0.0.1; login_method=sso"),
        ("USER_LOGOUT", "user_id=U1 | session_duration_sec=60", None, "U1", "session_duration_sec=60"),
        ("DATABASE_QUERY", "service=orders | table=t | query_time_ms=4", "orders", None, "table=t; query_time_ms=4"),
        ("DATABASE_ERROR", "service=orders | query_time_ms=9 | error=no route", "orders", None,
         "error=no route; query_time_ms=9"),
        ("AUTH_FAILURE", "user_id=U1 | reason=locked", None, "U1", "reason=locked"),
        ("CACHE_ACCESS", "key=cart | hit=false | ttl_sec=3", None, None, "key=cart; hit=false; ttl_sec=3"),
        ("SERVICE_START", "service=auth | message=Service started", "auth", None, "message=Service started"),
        ("SERVICE_STOP", "service=auth | message=bye", "auth", None, "message=bye"),
    ],
)
def test_event_types(parse_all, event, detail, service, user, message):
    (r,) = parse_all([f"{AT} | WARN | {event} | {detail}"])
    assert (r["rejection_reason"], r["event_type"], r["service"], r["user_id"], r["message"]) == (
        None, event, service, user, message,
    )


REJECTED = {
    "nothing like a log line": "Insufficient pipe-delimited sections",
    "": "Insufficient pipe-delimited sections",
    "|": "Insufficient pipe-delimited sections",
    "|||": "Invalid timestamp format: ",
    f"{AT} | INFO": "Insufficient pipe-delimited sections",
    "not-a-date | INFO | API_REQUEST | service=a": "Invalid timestamp format: not-a-date",
    "2025-07-14 10:15:32 | INFO | API_REQUEST | service=a": "Invalid timestamp format: 2025-07-14 10:15:32",
    "2025-02-30 10:15:32,000 | INFO | API_REQUEST | a=b": "Cannot parse timestamp: 2025-02-30 10:15:32,000",
    "0000-01-01 10:15:32,000 | INFO | API_REQUEST | a=b": "Cannot parse timestamp: 0000-01-01 10:15:32,000",
    "2025-07-14 10:15:61,000 | INFO | API_REQUEST | a=b": "Cannot parse timestamp: 2025-07-14 10:15:61,000",
    f"{AT} | TRACE | API_REQUEST | service=a": "Invalid log level: TRACE",
    f"{AT} | info | API_REQUEST | service=a": "Invalid log level: info",
    f"{AT} | INFO | LOGIN | service=a": "Invalid event type: LOGIN",
    f"{AT} | INFO | API_REQUEST | status=abc": "Invalid status value: abc",
    f"{AT} | INFO | API_REQUEST | status=20.5": "Invalid status value: 20.5",
    f"{AT} | INFO | API_REQUEST | status= | method=GET": "Invalid status value:  | method=GET",
    f"{AT} | INFO | API_REQUEST | response_time_ms=fast": "Invalid response_time_ms: fast",
    f"{AT} | INFO | API_REQUEST | response_time_ms=-050": "Negative response_time_ms: -50",
    f"{AT} | INFO | API_REQUEST | status=x | response_time_ms=-5": "Invalid status value: x",
    f"{AT} | INFO | API_REQUEST | status=1__0": "Invalid status value: 1__0",
}


def test_rejections(parse_all):
    for line, row in zip(REJECTED, parse_all(list(REJECTED))):
        assert row["rejection_reason"] == REJECTED[line], line


def test_values(parse_all):
    cases = {
        "token=a=b=c | service=x=y": {"service": "x=y"},
        "service=first | service=last": {"service": "last"},
        "user_id= U7": {"user_id": " U7"},
        "status= 200 | response_time_ms=+1_0": {"status": 200, "response_time_ms": 10},
        "status=007": {"status": 7},
        "status=٣٠٠ | response_time_ms=-०": {"status": 300, "response_time_ms": 0},
        "response_time_ms=12345678901234567890": {"response_time_ms": 12345678901234567890},
        "response_time_ms=" + "7" * 60: {"response_time_ms": 10**38 - 1},
        "response_time_ms=-0": {"response_time_ms": 0},
        "note | service=auth": {"service": "auth"},
        "see service=auth": {"service": "auth"},
        "service=": {"service": None},
        "method= | service=auth | user_id=U1": {"method": " | service=auth", "service": None, "user_id": "U1"},
        "é=1 | service=größe": {"service": "größe"},
        "xservice=no | my_service=no": {"service": None},
        "reason=a; b | error=c": {"message": "error=c; reason=a; b"},
        "": {"service": None, "message": None},
    }
    rows = parse_all([f"{AT} | INFO | CACHE_ACCESS | {detail}" for detail in cases])
    for (detail, expected), row in zip(cases.items(), rows):
        assert row["rejection_reason"] is None
        assert {k: row[k] for k in expected} == expected, detail


def test_unicode_blanks_around_sections(parse_all):
    (r,) = parse_all([f"　{AT} |\x1c INFO | API_REQUEST | service=auth\x1f| method=GET\x85"])
    assert (r["log_level"], r["service"], r["method"]) == ("INFO", "auth", "GET")


def test_plain_fields_agree_with_the_general_pattern(spark):
    """The short cut for well-formed sections must give what matching over the joined sections gives."""
    rng = random.Random(7)
    pieces = ["a=b", "a=", "=b", "k=v=w", "x y=z", "plain", "", "é=1", "a=b c=d", "s= t", "k==", "a=-", "_=1 ="]
    lines = [" | ".join(rng.choice(pieces) for _ in range(rng.randint(1, 5))) for _ in range(3000)]
    df = spark.createDataFrame([(x,) for x in lines], "detail string").select(
        F.split("detail", parse.SECTION_SEPARATOR, -1).alias("sections")
    )
    matched = F.regexp_extract_all(
        F.array_join("sections", parse.SECTION_JOINT), F.lit(parse.FIELD_PATTERN), F.lit(0)
    )
    general = F.concat(F.lit("\n"), F.array_join(matched, "\n"), F.lit("\n"))
    assert df.where(~parse._field_lines(F.col("sections")).eqNullSafe(general)).collect() == []
    plain = F.concat(F.lit("\n"), F.array_join("sections", "\n"), F.lit("\n")).rlike(parse.PLAIN_FIELDS)
    assert 0 < df.where(plain).count() < len(set(lines))


def test_split_into_parsed_and_rejected(spark):
    df = spark.createDataFrame([(f"{AT} | INFO | API_REQUEST | service=a",), ("junk",)], "line string")
    records = parse.parse_lines(df)
    assert parse.parsed_only(records).count() == 1
    assert parse.rejected_only(records).collect()[0].asDict() == {
        "raw_line": "junk", "rejection_reason": "Insufficient pipe-delimited sections",
    }
    empty = parse.parse_lines(df.where("false"))
    assert parse.parsed_only(empty).count() == parse.rejected_only(empty).count() == 0


def test_format_then_parse_gives_the_same_records(spark, sample):
    records = sample.withColumn("message", F.lit("error=x; query_time_ms=5"))
    back = parse.parsed_only(parse.parse_lines(parse.format_lines(records)))
    same = [c for c in RECORD_COLUMNS]
    assert back.select("id", *same).exceptAll(records.select("id", *same)).count() == 0
    assert back.count() == records.count()


def test_missing_record_columns_become_null(spark):
    df = parse.record_columns(spark.createDataFrame([("INFO",)], "log_level string"))
    assert df.columns == RECORD_COLUMNS
    assert df.first()["service"] is None


def route(spark, lines):
    return routed_records(spark.createDataFrame([(x,) for x in lines], "line string"))


SAMPLES = {
    "all kinds": (
        [f"{AT} | INFO | API_REQUEST | service=auth | status=200", f"{AT} | INFO | USER_LOGIN | user_id=U1",
         f"{AT} | ERROR | DATABASE_ERROR | service=orders | error=e", f"{AT} | INFO | SERVICE_STOP | service=a"],
        (4, 4, 0, 0, 0, 4),
    ),
    "malformed": (
        [f"{AT} | INFO | API_REQUEST | service=auth", "junk", f"{AT} | INFO", "x | INFO | API_REQUEST | a=b",
         f"{AT} | TRACE | API_REQUEST | a=b", f"{AT} | INFO | API_REQUEST | service=a | status=abc"],
        (6, 1, 5, 0, 0, 1),
    ),
    "duplicates": (
        [f"{AT} | INFO | USER_LOGIN | user_id=U1", f"{AT} | INFO | USER_LOGIN | user_id=U2"] * 2
        + [f"{AT} | WARN | USER_LOGIN | user_id=U1"],
        (5, 5, 0, 0, 2, 3),
    ),
    "invalid": (
        [f"{AT} | INFO | API_REQUEST | service=a | status=99", f"{AT} | INFO | API_REQUEST | status=700",
         f"{AT} | INFO | USER_LOGIN | status=599"],
        (3, 3, 0, 2, 0, 1),
    ),
    "empty": ([], (0, 0, 0, 0, 0, 0)),
}


@pytest.mark.parametrize("name", SAMPLES)
def test_processing_stats(spark, name):
    lines, expected = SAMPLES[name]
    routed = route(spark, lines)
    cleaned = validate.deduplicate(validate.valid_records(routed)).count()
    assert tuple(stage_counts(routed, cleaned).values()) == expected
    assert validate.all_rejections(routed).count() == expected[2] + expected[3]


def test_all_validation_errors_are_joined(spark):
    routed = route(spark, [f"{AT} | INFO | API_REQUEST | status=99999999999999999999"])
    assert validate.invalid_records(routed).first()["rejection_reason"] == (
        "Missing required field: service; Out-of-range status: 99999999999999999999"
    )


def test_structured_records(spark):
    schema = "timestamp timestamp_ntz, log_level string, event_type string, service string, status %s, response_time_ms %s"
    at = datetime(2026, 9, 20)
    numbers = spark.createDataFrame(
        [(None, None, None, None, 100, 0), (at, "INFO", "API_REQUEST", "a", 599, -1), (at, "INFO", "CACHE_ACCESS", None, 99, None)],
        schema % ("int", "int"),
    )
    missing = "; ".join(f"Missing required field: {f}" for f in ("timestamp", "log_level", "event_type", "service"))
    assert [r[0] for r in numbers.select(validate.validation_errors(numbers)).collect()] == [
        missing, "Negative response_time_ms: -1", "Out-of-range status: 99",
    ]
    texts = spark.createDataFrame([(at, "INFO", "API_REQUEST", "a", "200", "5")], schema % ("string", "string"))
    assert texts.select(validate.validation_errors(texts)).first()[0] == (
        "Invalid status type: 200; Invalid response_time_ms type: 5"
    )

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pyspark.sql import SparkSession  # noqa: E402

from logquarry.schema import LOG_EVENTS_SCHEMA, RECORD_SCHEMA  # noqa: E402
from logquarry.session import Scratch  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("scratch")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def table(spark, request):
    """A table name of its own for every test."""
    name = "t_" + "".join(c if c.isalnum() else "_" for c in request.node.name).lower()
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


@pytest.fixture(scope="session")
def make_events(spark):
    """Rows of the ten record columns (timestamp as text) -> frame with ids from 1 and no hash."""

    def build(rows, spread=1):
        from datetime import datetime

        data = [
            (i, datetime.fromisoformat(r[0]) if r[0] else None, *r[1:], None) for i, r in enumerate(rows, start=1)
        ]
        return spark.createDataFrame(data, LOG_EVENTS_SCHEMA).drop("record_hash")

    return build


@pytest.fixture(scope="session")
def make_records(spark):
    def build(rows):
        return spark.createDataFrame(rows, RECORD_SCHEMA)

    return build


# a shop around midnight: a printer that fails twice, a deadlock, an expired login, a slow search
SAMPLE = [
    ("2025-03-03 23:40:05", "WARN", "API_REQUEST", "catalog", "/items", "GET", 200, 40, "kim", None),
    ("2025-03-03 23:58:30", "INFO", "API_REQUEST", "catalog", "/items", "GET", 304, 20, "lee", None),
    ("2025-03-04 00:00:00", "ERROR", "API_REQUEST", "shipping", "/labels", "PUT", 503, 700, "kim", "reason=printer"),
    ("2025-03-04 00:00:00.500", "ERROR", "API_REQUEST", "shipping", "/labels", "PUT", 502, 900, None, None),
    ("2025-03-04 00:12:00", "INFO", "CACHE_ACCESS", None, None, None, None, 3, None, "key=basket"),
    ("2025-03-04 00:30:00", "ERROR", "DATABASE_ERROR", "catalog", None, None, None, None, None, "error=deadlock"),
    ("2025-03-04 01:00:01", "DEBUG", "SERVICE_START", "search", None, None, None, None, None, None),
    ("2025-03-04 01:15:00", "INFO", "AUTH_FAILURE", None, None, None, 403, 60, "mia", "reason=expired"),
    ("2025-03-04 01:20:00", "INFO", "API_REQUEST", "search", "/find", "GET", 200, 500, "kim", None),
    ("2025-03-04 01:45:00", "WARN", "API_REQUEST", "search", "/find", "GET", 404, 100, "lee", None),
]

GAPS = [
    ("2025-03-05 08:00:00", "INFO", "USER_LOGOUT", None, None, None, None, None, "ann", None),
    ("2025-03-05 08:30:00", "WARN", "API_REQUEST", "mail", "/send", "POST", 202, 10, None, None),
    ("2025-03-05 08:45:00", "ERROR", "API_REQUEST", "mail", "/send", "POST", None, None, None, None),
    ("2025-03-05 09:00:00", "INFO", "CACHE_ACCESS", None, None, None, None, 15, None, None),
    ("2025-03-05 09:30:00", "INFO", "USER_LOGIN", None, None, None, None, None, "ann", None),
]


@pytest.fixture(scope="session")
def sample(make_events):
    return make_events(SAMPLE)


@pytest.fixture(scope="session")
def gaps(make_events):
    return make_events(GAPS)


@pytest.fixture(scope="session")
def no_events(make_events):
    return make_events([])


@pytest.fixture
def area(spark):
    """Scratch tables of one test."""
    with Scratch(spark) as scratch:
        yield scratch


@pytest.fixture(scope="module")
def kept(spark):
    """Scratch tables of a module's shared fixtures."""
    with Scratch(spark) as scratch:
        yield scratch

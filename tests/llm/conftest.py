import pytest


@pytest.fixture(scope="session")
def make(spark):
    """Frames from rows, with a schema."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)

"""Record fingerprint: case- and blank-insensitive SHA-256 over the ten record columns."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from logquarry.functions.text import strip
from logquarry.functions.timestamps import micros_text
from logquarry.schema import RECORD_COLUMNS


def record_hash() -> Column:
    def part(name: str) -> Column:
        if name == "timestamp":
            return micros_text(F.col(name))
        if name in ("status", "response_time_ms"):
            return F.col(name).cast("string")
        return F.lower(strip(F.col(name)))

    parts = [part(c) for c in RECORD_COLUMNS]
    return F.sha2(F.concat_ws("|", *[F.coalesce(p, F.lit("")) for p in parts]), 256)

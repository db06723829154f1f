"""Analytics of a growing table from roll-ups that are kept for each day.

The facts of the thirteen queries add up, so those of a day need no second scan while no load touches the day.
They are written below ``_rollups`` in the table's folder; a manifest, one file for each refresh, says where each
day's are and up to which load they count. The table's own record of loads (``ledger``) tells which days
later loads have touched: these are scanned again, and only these.
"""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logquarry.operators import analytics
from logquarry.schema import ANALYSIS_COLUMNS
from logquarry.sources.ledger import Files, Ledger, location

FOLDER = "_rollups"
DAY = "event_date"


def _manifest(files: Files) -> tuple[int, dict]:
    """The number and content of the newest manifest that was written to its end."""
    for name in reversed([n for n in files.names() if n.endswith(".manifest")]):
        content = files.read(name)
        if content is not None:
            return int(name.removesuffix(".manifest")), content
    return 0, {"upto": 0, "days": {}}


def stale_rows(spark: SparkSession, table: str) -> tuple[DataFrame | None, int]:
    """The events of the days that loads have touched since the last refresh, None if there are none, and the next free id."""
    _, known = _manifest(Files(spark, f"{location(spark, table)}/{FOLDER}"))
    seals = Ledger(spark, table).seals()
    later = [s for s in seals if s.next_id > known["upto"]]
    events = spark.table(table).select(*ANALYSIS_COLUMNS, DAY)
    if any(s.days is None and s.total for s in later):  # rows from before there was a record of loads
        return events, seals[-1].next_id
    days = sorted({d for s in later for d in s.days or ()})
    return (events.where(F.col(DAY).isin([F.lit(d).cast("date") for d in days])) if days else None), seals[-1].next_id


def refresh(spark: SparkSession, table: str) -> None:
    """Roll up the days that have changed. Stopping in between leaves the previous state in force."""
    files = Files(spark, f"{location(spark, table)}/{FOLDER}")
    number, known = _manifest(files)
    events, upto = stale_rows(spark, table)
    if events is None:
        return
    name = uuid.uuid4().hex
    analytics.rollup(events, DAY).write.partitionBy("part", DAY).parquet(f"{files.folder}/facts-{name}")
    users = analytics.user_counts(events, DAY)
    users.write.partitionBy(DAY).parquet(f"{files.folder}/users-{name}")
    days = {str(r[DAY]): name for r in spark.read.parquet(f"{files.folder}/facts-{name}").select(DAY).distinct().collect()}
    files.write(f"{number + 1:020d}.manifest", {"upto": upto, "days": known["days"] | days})


def _kept(spark: SparkSession, files: Files, kind: str, schema: str, days: dict[str, str]) -> DataFrame:
    """The kept rows of every day from the refresh that the manifest names for it: days of one refresh in one read."""
    out = spark.createDataFrame([], f"{schema}, {DAY} date")
    for name in sorted(set(days.values())):
        own = [F.lit(d).cast("date") for d, n in days.items() if n == name]
        out = out.unionByName(spark.read.schema(out.schema).parquet(f"{files.folder}/{kind}-{name}").where(F.col(DAY).isin(own)))
    return out.drop(DAY)


def table_analytics(spark: SparkSession, table: str) -> dict[str, DataFrame]:
    """All thirteen results over the table, equal to those over its rows; scans only days that have changed."""
    refresh(spark, table)
    files = Files(spark, f"{location(spark, table)}/{FOLDER}")
    _, known = _manifest(files)
    events = spark.table(table).select(*ANALYSIS_COLUMNS)
    # the shapes follow from the operators; nothing is read for them
    facts = _kept(spark, files, "facts", _ddl(analytics.rollup(events)), known["days"])
    users = _kept(spark, files, "users", _ddl(analytics.user_counts(events)), known["days"])
    return analytics.results_of(facts, users.groupBy("user_id").agg(F.sum("event_count").alias("event_count")))


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)

"""The ``log_events`` table: Parquet in the session catalog, partitioned by day, bucketed by record hash.

A record's hash covers its timestamp, so a copy of a row can only sit in the row's own day: a load
reads just the hash column of the days it touches, and the buckets keep that side of the join unshuffled.
"""

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logquarry.functions.numbering import numbered, place
from logquarry.operators.facets import RECENT_ROWS, recent_events
from logquarry.operators.load import absent_from, constraint_error, load_summary, type_rows, winners
from logquarry.schema import ANALYSIS_COLUMNS, LOG_EVENTS_SCHEMA, RECORD_COLUMNS, REQUIRED_FIELDS, VARCHAR_LENGTHS
from logquarry.session import Scratch, stored_in_place
from logquarry.sources.files import read_cleaned
from logquarry.sources.ledger import Ledger

DAY_GROUPS = 32  # of a load's days at most; each group is a join with as many tasks as the table has buckets
ROWS_PER_TASK = 1_000_000  # incoming rows that one task of such a join shall take, about


def create_table(spark: SparkSession, table: str, buckets: int, location: str | None = None) -> None:
    """Create the table unless it exists. Choose ``buckets`` so that one bucket of a load fits a task."""
    columns = []
    for field in LOG_EVENTS_SCHEMA.fields:
        length = VARCHAR_LENGTHS.get(field.name)
        kind = f"VARCHAR({length})" if length else field.dataType.simpleString()
        required = field.name in ("id", "record_hash", *REQUIRED_FIELDS)
        columns.append(f"`{field.name}` {kind}{' NOT NULL' if required else ''}")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({', '.join(columns)}, event_date DATE) USING parquet "
        f"PARTITIONED BY (event_date) CLUSTERED BY (record_hash) INTO {int(buckets)} BUCKETS"
        + (f" LOCATION '{location}'" if location else "")
    )


def log_events(spark: SparkSession, table: str = "log_events") -> DataFrame:
    """The table, or an empty frame with its columns when there is none."""
    if not spark.catalog.tableExists(table):
        return spark.createDataFrame([], LOG_EVENTS_SCHEMA)
    spark.catalog.refreshTable(table)  # another session, such as a stream's, may have appended files
    return spark.table(table).select(*LOG_EVENTS_SCHEMA.names)


def load_log_data(spark: SparkSession, table: str = "log_events") -> DataFrame:
    """The ten columns that anomaly detection and the reports read."""
    return log_events(spark, table).select(*ANALYSIS_COLUMNS)


def read_jdbc(spark: SparkSession, url: str, table: str = "log_events", **options: str) -> DataFrame:
    """The same table kept in a relational database; pass partitioning options to read it in parallel."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()


def compact(spark: SparkSession, table: str, day: str) -> None:
    """Rewrite one day so that each bucket is one file again, after many small loads such as a stream's."""
    with Scratch(spark) as area:
        rows = area.store(spark.table(table).where(F.col("event_date") == F.lit(day).cast("date")), "day")
        whole = rows.repartition(_buckets(spark, table), "record_hash")
        before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
        try:
            whole.select(*spark.table(table).columns).write.insertInto(table, overwrite=True)
        finally:
            spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)
    spark.catalog.refreshTable(table)


def write_jdbc(rows: DataFrame, url: str, table: str = "log_events", **options: str) -> None:
    rows.write.format("jdbc").mode("append").options(url=url, dbtable=table, **options).save()


def _buckets(spark: SparkSession, table: str) -> int:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Num Buckets'").first()
    return int(described["data_type"])


def _row_number(staged: DataFrame, bad) -> int:
    """Position of a row in its file, counting the header as row 1. Only runs when a load is refused."""
    before = (F.col("block") < bad["block"]) | ((F.col("block") == bad["block"]) & (F.col("row") < bad["row"]))
    return staged.where((F.col("file") == bad["file"]) & before).count() + 2


def _day_groups(checked, buckets: int, rows_per_task: int) -> list[tuple]:
    """Ranges of days with about equal numbers of incoming rows: more of them the more rows there are for a bucket."""
    count = min(DAY_GROUPS, -(-checked["rows"] // (buckets * rows_per_task)))
    step = DAY_GROUPS // count
    last_days = sorted({*checked["day_quantiles"][step - 1 :: step], checked["last_day_number"]})
    firsts = [checked["first_day_number"], *[d + 1 for d in last_days[:-1]]]
    return [(a, b) for a, b in zip(firsts, last_days) if a <= b]


def _absent(rows: DataFrame, table: str, buckets: int, order: list[str], groups: list[tuple], area: Scratch) -> DataFrame:
    """(row, event_date) of the first row of each hash that the table does not hold.

    Only hashes, places and days travel. For each group of days the incoming side is laid out like the
    table's buckets, so the table's side is not shuffled, and the groups' joins are tasks of their own: a load
    of many days is not bound to one task for each bucket.
    """
    spark, chosen = rows.sparkSession, winners(rows, order, "row")
    number = F.unix_date("event_date")
    if len(groups) > 1:
        part = F.lit(len(groups) - 1)
        for i, (_, last) in reversed(list(enumerate(groups[:-1]))):
            part = F.when(number <= last, i).otherwise(part)
        chosen = area.store(chosen.withColumn("part", part), "winners", ["part"])
    found = []
    for i, (first, last) in enumerate(groups):
        incoming = chosen.where(F.col("part") == i).drop("part") if len(groups) > 1 else chosen
        days = F.col("event_date").between(*[F.date_from_unix_date(F.lit(d)) for d in (first, last)])
        found.append(absent_from(incoming.repartition(buckets, "record_hash"), spark.table(table).where(days)))
    return reduce(DataFrame.unionByName, found).select("row", "event_date")


def _append(rows: DataFrame, table: str) -> None:
    rows.write.insertInto(table)


def load_rows(
    spark: SparkSession,
    rows: DataFrame,
    table: str = "log_events",
    buckets: int | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> dict[str, int]:
    """Append records that the table does not hold yet, all or nothing.

    ``rows`` are the record columns with ``record_hash``, the order ``file``, ``block``, ``row`` (``row``
    unique) and, for typed CSV, ``row_error``. They are stored once; one pass over them checks every row
    and refuses the whole load at the first bad one, then a single append job writes. Among rows with equal
    hash the first in order wins. New rows get the next free ids without gaps, in no particular order. A
    missing table is created when ``buckets`` is given, and is an error otherwise.

    The ids are reserved before the append and the load is sealed after it (``ledger``). A load that failed
    in between may be repeated: rows it wrote are recognised by their hash, and the next load's total counts
    them. Only ids of a failed append are lost.
    """
    names = ("input_records", "inserted_records", "duplicate_records", "failed_records", "database_total_rows")
    order = ["file", "block", "row"]
    day = F.to_date("timestamp")
    number = F.unix_date(day)
    with Scratch(spark) as area:
        rows = area.store(rows, "typed")
        unreadable = F.col("row_error") if "row_error" in rows.columns else F.lit(None).cast("string")
        checked = rows.agg(
            F.count(F.lit(1)).alias("rows"),
            F.min(F.when(unreadable.isNotNull(), F.struct(*order, unreadable.alias("message")))).alias("row_error"),
            F.min(constraint_error(rows)).alias("violation"),
            F.min(number).alias("first_day_number"),
            F.max(number).alias("last_day_number"),
            F.percentile_approx(number, [(i + 1) / DAY_GROUPS for i in range(DAY_GROUPS)], 1000).alias("day_quantiles"),
        ).first()
        if checked["rows"] == 0:
            return dict.fromkeys(names, 0)
        if checked["row_error"] is not None:
            bad = checked["row_error"]
            raise ValueError(f"Row {_row_number(rows, bad)}: {bad['message']}")
        if checked["violation"] is not None:
            raise ValueError(f"constraint violated: {checked['violation']}")
        if buckets is not None:
            create_table(spark, table, buckets)
        elif not spark.catalog.tableExists(table):
            raise ValueError(f"table {table} does not exist: create it, or say how many buckets it shall have")
        spark.catalog.refreshTable(table)
        ledger = Ledger(spark, table)
        before = ledger.seals()[-1]
        rows = rows.withColumn("event_date", day)
        # the hash covers the timestamp, so a copy can only sit on the same day
        buckets = _buckets(spark, table)
        groups = _day_groups(checked, buckets, rows_per_task)
        fresh = area.store(_absent(rows, table, buckets, order, groups, area), "fresh")
        per_day = {str(r["event_date"]): r["n"] for r in fresh.groupBy("event_date").agg(F.count(F.lit(1)).alias("n")).collect()}
        new = sum(per_day.values())
        total = before.total + new
        if new:
            whole = rows.join(fresh.select("row"), "row", "left_semi").select(*RECORD_COLUMNS, "record_hash", "event_date")
            # by day and bucket: as many tasks as there are such pairs, and one file for each
            bucket = F.pmod(F.hash("record_hash"), F.lit(buckets))
            whole = stored_in_place(whole.repartition("event_date", bucket).withColumn("place", place()))
            ledger.begin(before.next_id, new, list(per_day))
            _append(numbered(whole, "id", before.next_id).select("id", *RECORD_COLUMNS, "record_hash", "event_date"), table)
            ledger.end(before.next_id, new, total, list(per_day))
    return dict(zip(names, (checked["rows"], new, checked["rows"] - new, 0, total)))


def load_csv(
    spark: SparkSession, path: str, table: str = "log_events", multi_line: bool = False, buckets: int | None = None
) -> dict[str, int]:
    """Load cleaned CSV files into the table, skipping records it already holds; see ``load_rows``."""
    raw = read_cleaned(spark, path, multi_line).select(
        *RECORD_COLUMNS,
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    return load_rows(spark, type_rows(raw), table, buckets)


def verify_table(spark: SparkSession, table: str = "log_events") -> DataFrame:
    """One row: whether the table exists, its size, time range and rows per level."""
    exists = F.lit(spark.catalog.tableExists(table)).alias("table_exists")
    return load_summary(log_events(spark, table)).select(exists, "*")


def recent_logs(spark: SparkSession, table: str = "log_events", rows: int = RECENT_ROWS, **facets) -> DataFrame:
    """The newest facet matches of the table; its record of loads says what the newest id is."""
    if not spark.catalog.tableExists(table):
        return recent_events(log_events(spark, table), rows, 0, **facets)
    return recent_events(log_events(spark, table), rows, Ledger(spark, table).seals()[-1].next_id - 1, **facets)

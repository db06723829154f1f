"""The file pipeline run continuously: new log files are parsed, validated and loaded as they arrive."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from logquarry.functions.hashing import record_hash
from logquarry.operators import validate
from logquarry.operators.load import unfit
from logquarry.plans.processing import routed_records, store_routed
from logquarry.session import Scratch
from logquarry.sources import files
from logquarry.sources.table import load_rows


def stream_records(spark: SparkSession, input_path: str, max_files: int = 1000) -> DataFrame:
    """Parsed and routed records of a growing folder; stateless, the same expressions as the batch run."""
    lines = spark.readStream.option("maxFilesPerTrigger", max_files).text(input_path)
    return routed_records(files.log_lines(lines))


def start_ingest(
    spark: SparkSession, input_path: str, rejected_path: str, checkpoint: str, table: str = "log_events", buckets: int | None = None
) -> StreamingQuery:
    """Load valid records into ``table`` and keep rejections under ``rejected_path``, for all files now present.

    A line whose record the table can't hold is rejected with the reason like any other bad line, so no
    line stops the stream; the batch load refuses such input as a whole. A batch that is repeated after a
    failure changes nothing: loaded records are recognised by their hash, and rejections overwrite the
    folder of the same batch. ``buckets`` is needed when the table does not exist yet. Each batch adds a file
    per day and bucket it touches; ``table.compact`` joins those of a day.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        with Scratch(spark) as area:
            routed = store_routed(validate.refuse(batch, unfit(batch)), area)
            valid = validate.valid_records(routed).withColumns(
                {
                    "response_time_ms": F.col("response_time_ms").cast("int"),
                    "record_hash": record_hash(),
                    "file": F.lit(""),
                    "block": F.lit(0),
                    "row": F.monotonically_increasing_id(),
                }
            )
            load_rows(batch.sparkSession, valid, table, buckets)
            files.write_rejected(validate.all_rejections(routed), f"{rejected_path}/batch={batch_id}")

    return (
        stream_records(spark, input_path)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )

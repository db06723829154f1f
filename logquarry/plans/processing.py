"""Raw log files to cleaned and rejected files."""

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from logquarry.operators import parse, validate
from logquarry.session import Scratch
from logquarry.sources import files


def routed_records(lines: DataFrame) -> DataFrame:
    """Parse and validate trimmed lines (column ``line``); one narrow pass."""
    return validate.route(parse.parse_lines(lines))


def store_routed(routed: DataFrame, area: Scratch) -> DataFrame:
    """Write routed records partitioned by outcome; the text of valid lines is not kept a second time."""
    rejected = F.col("outcome") != validate.VALID
    lean = routed.withColumn("raw_line", F.when(rejected, F.col("raw_line")))
    return area.store(lean, "routed", partition_by=["outcome"])


def stage_counts(routed: DataFrame, cleaned: int) -> dict[str, int]:
    """Counts of every stage from stored routed records and the number of distinct valid ones."""
    rows = {r["outcome"]: r["count"] for r in routed.groupBy("outcome").count().collect()}
    malformed, invalid, valid = (rows.get(k, 0) for k in (validate.MALFORMED, validate.INVALID, validate.VALID))
    return {
        "total_raw": malformed + invalid + valid,
        "successfully_parsed": invalid + valid,
        "malformed_records": malformed,
        "validation_failures": invalid,
        "duplicate_records": valid - cleaned,
        "cleaned_records": cleaned,
    }


def process_logs(spark: SparkSession, input_path: str, output_dir: str) -> dict[str, int]:
    """Write ``cleaned_logs`` and ``rejected_logs`` (CSV) and return the counts of every stage.

    Lines are parsed once into stored records, partitioned by outcome; each output then reads only its
    own partitions. The counts come from the partitions and from the passes themselves. Besides those of
    ``stage_counts`` there are the blank lines that were skipped.
    """
    read, written = Observation("read"), Observation("cleaned")
    lines = files.read_lines(spark, input_path).observe(read, F.count_if(files.is_blank(F.col("value"))).alias("blank"))
    with Scratch(spark) as area:
        routed = store_routed(routed_records(files.log_lines(lines)), area)
        cleaned = validate.deduplicate(validate.valid_records(routed)).observe(written, F.count(F.lit(1)).alias("rows"))
        files.write_cleaned(cleaned, f"{output_dir}/cleaned_logs")
        files.write_rejected(validate.all_rejections(routed), f"{output_dir}/rejected_logs")
        return stage_counts(routed, written.get["rows"]) | {"empty_lines_skipped": read.get["blank"]}

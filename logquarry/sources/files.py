"""Text, CSV and JSON sources and sinks."""

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logquarry.functions.text import strip
from logquarry.functions.timestamps import iso_text, log_text, plain_text
from logquarry.operators.parse import record_columns
from logquarry.schema import CHECK_COLUMNS, CHECKS_SCHEMA, RECORD_COLUMNS, SCORED_COLUMNS, SCORED_SCHEMA

CSV_OPTIONS = {"header": True, "quote": '"', "escape": '"', "emptyValue": ""}


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Every line of the text files under ``path`` as ``value``. A missing path is an error."""
    return spark.read.text(path)


def is_blank(line: Column) -> Column:
    return strip(line) == ""


def log_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Trimmed non-blank lines as ``line``; other columns are kept."""
    extra = [c for c in lines.columns if c != column]
    return lines.select(*extra, strip(F.col(column)).alias("line")).where(F.col("line") != "")


def ingest_stats(lines: DataFrame, column: str = "value") -> DataFrame:
    """One row: lines kept and blank lines skipped."""
    blank = is_blank(F.col(column))
    return lines.agg(
        F.count_if(~blank).alias("total_lines_read"), F.count_if(blank).alias("empty_lines_skipped")
    )


def write_csv(df: DataFrame, path: str) -> None:
    """Header always written, also for an empty result; doubled quotes survive a round trip."""
    df.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def cleaned_rows(records: DataFrame) -> DataFrame:
    """The ten columns as written to the cleaned file: timestamp text with comma milliseconds."""
    return record_columns(records.withColumn("timestamp", log_text(F.col("timestamp"))))


def write_cleaned(records: DataFrame, path: str) -> None:
    write_csv(cleaned_rows(records), path)


def write_rejected(rejections: DataFrame, path: str) -> None:
    write_csv(rejections.select("raw_line", "rejection_reason"), path)


def write_scored(scored: DataFrame, path: str) -> None:
    write_csv(scored.withColumn("timestamp", plain_text(F.col("timestamp"))).select(*SCORED_COLUMNS), path)


def write_checks(checks: DataFrame, path: str) -> None:
    write_csv(checks.select(*CHECK_COLUMNS), path)


def read_cleaned(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """CSV with a header as strings. Header names are trimmed; every record column must be present.

    Extra columns are allowed. ``multi_line`` admits quoted line breaks, at the price of unsplittable files.
    """
    raw = spark.read.options(header=True, quote='"', escape='"', multiLine=multi_line).csv(path)
    if not raw.columns:
        raise ValueError("CSV file is empty")
    missing = [c for c in RECORD_COLUMNS if c not in [name.strip() for name in raw.columns]]
    if missing:
        raise ValueError(f"Missing required columns: {missing}")
    return raw.withColumnsRenamed({c: c.strip() for c in raw.columns})


def read_rejected(spark: SparkSession, path: str) -> DataFrame:
    """A saved rejected file; a line that begins or ends with white space keeps it."""
    return spark.read.schema("raw_line string, rejection_reason string").options(header=True, quote='"', escape='"').csv(path)


def read_checks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CHECKS_SCHEMA).options(header=True, quote='"', escape='"').csv(path)


def _json_ready(field: T.StructField) -> Column:
    c = F.col(field.name)
    if isinstance(field.dataType, T.TimestampNTZType):
        return iso_text(c).alias(field.name)
    if isinstance(field.dataType, T.DecimalType):
        return c.cast("double").alias(field.name)
    return c


def write_json(df: DataFrame, path: str) -> None:
    """Report rows as JSON; dates as ISO text, decimals as floats, nulls kept."""
    df.select(*[_json_ready(f) for f in df.schema.fields]).write.mode("overwrite").option(
        "ignoreNullFields", False
    ).json(path)


def write_text(lines: DataFrame, path: str) -> None:
    """A short ordered report (``position``, ``line``) as one text file."""
    lines.orderBy("position").select("line").coalesce(1).write.mode("overwrite").text(path)


def _or_empty(spark: SparkSession, schema: T.StructType, read) -> DataFrame:
    try:
        return read()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_scored(spark: SparkSession, path: str) -> DataFrame:
    """A saved scored CSV, or an empty frame with the same columns when there is none."""
    return _or_empty(
        spark,
        SCORED_SCHEMA,
        lambda: spark.read.schema(SCORED_SCHEMA).options(header=True, quote='"', escape='"').csv(path),
    )


def read_report(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A saved JSON report, or an empty frame when there is none."""
    return _or_empty(spark, schema, lambda: spark.read.schema(schema).json(path))

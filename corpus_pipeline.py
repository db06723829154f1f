"""From raw documents to training sequences: five stages, each an operator of ``logquarry.llm``.

Every stage takes the documents its predecessor kept, and its result is written as Parquet before the next
one reads it. The first four return the columns of ``documents``; the last returns packed sequences.
"""

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logquarry.llm import decontaminate, neardup, pack, quality, toxicity
from logquarry.llm.common import checkpoint_folder, stored
from logquarry.session import delete, session_area, ship_package

ORACLE_SQL = None  # learned models and signatures have no SQL; tests compare the stages with plain Python

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]"  # a character of a word, as in logquarry.llm.common
BROADCAST_ROWS = 500_000  # of ids to drop; more are joined by shuffling


KEY = ("no_id", "id", "text")


def _keyed(docs: DataFrame) -> DataFrame:
    """``row``, all columns of ``docs`` whatever their names, and what a row is known by: its id and a hash of its text.

    So rows that share an id but not the text are told apart.
    """
    text = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    return docs.select(row, F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), text.alias("text"))


def _texts(docs: DataFrame) -> DataFrame:
    """(_key, text) for operators that take an id column."""
    return _keyed(docs).select(F.struct(*KEY).alias("_key"), F.col("row.text").alias("text"))


def _those(keyed: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """Rows of ``_keyed`` that are (``left_semi``) or are not (``left_anti``) among stored ``keys``, structs named ``_key``."""
    same = [F.col(f"_key.{c}").alias(f"key_{c}") for c in KEY]
    side = keys.select(*same).distinct()
    side = F.broadcast(side) if keys.count() <= BROADCAST_ROWS else side
    match = (F.col("text") == F.col("key_text")) & (F.col("no_id") == F.col("key_no_id")) & F.col("id").eqNullSafe(F.col("key_id"))
    return keyed.join(side, match, how)


def _rows(keyed: DataFrame) -> DataFrame:
    return keyed.select("row.*")


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic. The model is learned from the labelled ones among ``docs``."""
    model = toxicity.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.where(toxicity.scorer(model)(F.col("text").cast("string")) < toxicity.THRESHOLD)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are predicted to be good. The model is learned from the labelled ones among ``docs``."""
    model = quality.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.where(quality.scorer(model)(F.col("text").cast("string")) >= quality.THRESHOLD)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class: the one with the smallest id. Wordless texts all stay.

    A row is known by its id and a hash of its text, so rows that share an id but not the text are told
    apart; of rows with words that share both, the first by n_chars stays.
    """
    classes = neardup.near_duplicates(_texts(docs), "_key")
    counted = classes.groupBy(F.col("doc_id").alias("_key")).agg(F.count_if("kept").alias("kept"), F.count(F.lit(1)).alias("n"))
    counted = stored(counted.where("kept < n"))
    keyed = _keyed(docs)
    again = counted.where("kept > 0")
    parts = [_rows(_those(keyed, counted, "left_anti"))]
    if not again.isEmpty():
        repeated = _those(keyed, again, "left_semi")
        worded = F.coalesce(F.col("row.text").cast("string").rlike(WORD), F.lit(False))
        # an aggregate, combined in the tasks that read the rows: equal rows, however many, never meet
        order = F.struct(F.col("row.n_chars").isNull(), F.col("row.n_chars"))
        parts.append(repeated.where(worded).groupBy("no_id", "id", "text").agg(F.min_by("row", order).alias("row")).select("row.*"))
        parts.append(_rows(repeated.where(~worded)))
    return reduce(DataFrame.unionByName, parts)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the benchmark does not contaminate. Clean rows stay, also those that share a contaminated row's id."""
    found = decontaminate.contamination(_texts(docs), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), "_key")
    gone = stored(found.where("contaminated").select(F.col("doc_id").alias("_key")))
    return _rows(_those(_keyed(docs), gone, "left_anti"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The remaining documents as sequences of at most 1024 tokens."""
    return pack.pack(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("quality", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written below the checkpoint folder and removed once the next one is.

    The last one's rows, which are returned, are removed when the program ends.
    """
    ship_package(spark)
    checkpoint_folder(spark)
    area, before = session_area(spark), None
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = area.path(name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            delete(spark, before)
        before = path
    return docs

"""Held-out splits and bounded samples of labelled rows."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logquarry.llm.common import stored

_PARTS = 1 << 20
FEW = 10_000  # labels whose shares are broadcast; more are joined by shuffling


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    """Whether crc32 of the id as text leaves ``part`` modulo ``parts``; a null id is not held out."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(parts)) == part, F.lit(False))


def one_label(labels: DataFrame, label_column: str) -> DataFrame:
    """(doc_id, label): one row per labelled id, the largest label of repeated ones; no nulls."""
    rows = labels.select("doc_id", F.col(label_column).alias("label")).where("doc_id IS NOT NULL AND label IS NOT NULL")
    return rows.groupBy("doc_id").agg(F.max("label").alias("label"))


def label_sample(rows: DataFrame, per_label: int, seed: int = 1) -> DataFrame:
    """Rows of (doc_id, label, ...) with about ``per_label`` of each label, and ``weight``, the rows each stands for.

    Rows are chosen by a hash of their id, so the sample does not depend on partitions or retries. Rows
    with a null id or label are left out.
    """
    rows = rows.where("doc_id IS NOT NULL AND label IS NOT NULL")
    counts = rows.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    shares = stored(counts.select("label", F.least(F.lit(1.0), per_label / F.col("n")).alias("share")))
    if shares.count() <= FEW:
        shares = F.broadcast(shares)
    spot = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(_PARTS))
    chosen = rows.join(shares, "label").where(spot < F.col("share") * _PARTS)
    return chosen.select(*rows.columns, (1 / F.col("share")).alias("weight"))


def one_row(rows: DataFrame) -> DataFrame:
    """One row for each ``doc_id``: of several the one with the smallest hash of its columns.

    A bound on ids is so a bound on rows: an id that a third of all rows repeat is one row of a sample. Rows
    of an id are reduced in their tasks before they are shuffled.
    """
    others = [c for c in rows.columns if c != "doc_id"]
    first = F.min_by(F.struct(*others), F.xxhash64(*others)).alias("row")
    return rows.groupBy("doc_id").agg(first).select("doc_id", "row.*").select(*rows.columns)

"""Sharding by longest-processing-time scheduling (operator 4).

Groups that must stay together are taken by falling size, each to the least-loaded shard of a heap. Only
groups above a small share of the whole are taken one by one; there can be no more than ``shards * units``
of them. All others are united by hash into as many bundles of about equal size, which the heap takes like
groups. So the schedule is made over a bounded number of units, however many groups there are, and loads
differ by at most one unit beyond what a single huge group forces.
"""

import heapq

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logquarry.llm.common import stored

SHARDS = 24
UNITS = 400  # units for each shard: a unit is about 1/400 of a shard
ROW_BYTES = 8


def schedule(sizes: list[int], shards: int) -> list[int]:
    """The shard of each unit: by falling size (ties by position), each to the least-loaded shard (ties by number)."""
    heap, out = [(0, s) for s in range(shards)], [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        load, s = heap[0]
        out[i] = s
        heapq.heapreplace(heap, (load + sizes[i], s))
    return out


def shard_by_size(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    group_column: str | None = None,
    shards: int = SHARDS,
    units: int = UNITS,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    Size is the text's UTF-8 bytes plus 8. Rows of equal ``group_column`` stay together; without one, rows
    of equal text do. The law is ``bytes``: shards are near equal in size, so ``grown_shard`` is null. Slots
    number a shard's rows from 0 without gaps. A null text counts as empty (checksum 0) and shares its
    group, as does a null group value. Repeated rows and null ids each get a slot; no rows, no result.
    """
    text = F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit("")).cast("binary")
    group = text if group_column is None else F.coalesce(F.concat(F.lit("="), F.col(f"`{group_column}`").cast("string")), F.lit("")).cast("binary")
    rows = stored(
        docs.select(
            F.col(f"`{id_column}`").alias("doc_id"),
            (F.octet_length(text) + F.lit(ROW_BYTES)).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.unhex(F.md5(group)).alias("grp"),
            F.monotonically_increasing_id().alias("place"),
            F.spark_partition_id().alias("part"),
        )
    )
    groups = rows.groupBy("grp").agg(F.sum("size").alias("bytes"))
    total = rows.agg(F.sum("size")).first()[0] or 0
    bundles = shards * units
    least = total // bundles + 1
    bundle = F.pmod(F.xxhash64("grp"), F.lit(bundles))
    sized = groups.select("grp", "bytes", (F.col("bytes") >= least).alias("alone"), bundle.alias("bundle"))
    units_of = stored(
        sized.groupBy(F.when(F.col("alone"), F.col("grp")).alias("grp"), F.when(~F.col("alone"), F.col("bundle")).alias("bundle"))
        .agg(F.sum("bytes").alias("bytes"))
    )
    # at most 2 * shards * units rows: that many groups of that size, and that many bundles
    order = units_of.orderBy(F.desc("bytes"), "grp", "bundle").toArrow()
    placed = order.drop_columns("bytes").append_column("shard", pa.array(schedule(order["bytes"].to_pylist(), shards), pa.int32()))
    plan = docs.sparkSession.createDataFrame(placed)
    alone = plan.where("grp IS NOT NULL").select("grp", F.col("shard").alias("own"))
    bundled = plan.where("bundle IS NOT NULL").select("bundle", F.col("shard").alias("shared"))
    dealt = (
        rows.withColumn("bundle", bundle)
        .join(F.broadcast(alone), "grp", "left")
        .join(F.broadcast(bundled), "bundle", "left")
        .withColumn("shard", F.coalesce("own", "shared"))
        .select("doc_id", "size", "text_crc32", "place", "part", "shard")
    )
    counts = dealt.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    number = F.row_number().over(Window.partitionBy("shard", "part").orderBy("place"))
    return (
        dealt.withColumn("number", number)
        .join(first, ["shard", "part"])
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("bytes").alias("law"),
            "shard",
            (F.col("first") + F.col("number") - 1).alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )


def op4_shard(spark, sf_dir) -> DataFrame:
    return shard_by_size(spark.read.parquet(f"{sf_dir}/documents.parquet"))

"""Exact top-k search over binary codes by incremental multi-index hashing (operator 6).

A code is cut into segments of about log2 n - 6 bits for n codes, and the index is a table of (segment, value,
code). A query looks up all values within a radius of its own segments; what it finds is verified by the full
Hamming distance. Once radius s has been searched in all m segments, every code within m * (s + 1) - 1 has been
found: a code farther off in each of them would differ in m * (s + 1) bits or more. A query whose k-th verified
distance is covered by that bound leaves; the others go on with the next radius.

Every radius is a join of the queries' probes with the index, dealt by segment and value: rows are never
copied to queries, and no query is compared with codes that share no near segment with it. Equal codes are
one entry of the index with their k smallest ids, found before any shuffle; equal queries are searched once.
"""

from collections.abc import Iterator
from functools import reduce
from itertools import combinations, islice
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logquarry.llm.common import stored

K = 10
BITS = 64
MOST_SEGMENT_BITS = 30
PER_VALUE = 64  # codes that share a segment's value, about: a probe costs a shuffled row, a comparison some nanoseconds
QUERY_EVERY = 50
PROBES = 1 << 16  # probes that are sent on at once


def sign_code(vectors: DataFrame, id_column: str, vector_column: str, bits: int = BITS) -> DataFrame:
    """(id, code): bit i of the binary code is set when component i is above zero.

    Rows with a null id, a null vector or another number of components have no code and are left out; a
    null or NaN component counts as not above zero.
    """
    vector = F.col(f"`{vector_column}`").cast("array<double>")
    source = vectors.select(F.col(f"`{id_column}`").alias("id"), vector.alias("v")).where(f"id IS NOT NULL AND size(v) = {bits}")
    kind = source.schema["id"].dataType.simpleString()

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, bits)
            with np.errstate(invalid="ignore"):
                packed = np.packbits(values > 0, axis=1)
            codes = pa.array([row.tobytes() for row in packed], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), codes], names=["id", "code"])

    return source.mapInArrow(coded, f"id {kind}, code binary")


def segment_bounds(bits: int, count: int) -> np.ndarray:
    """First bit of each segment and the end: segments of equal width, so that about ``PER_VALUE`` codes share a value."""
    width = min(MOST_SEGMENT_BITS, max(2, (int(count) // PER_VALUE).bit_length() - 1))
    segments = max(1, -(-bits // MOST_SEGMENT_BITS), round(bits / width))
    return np.linspace(0, bits, segments + 1).round().astype(int)


def segments_of(codes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The value of each segment of each code (n x bytes), as n x segments longs."""
    bits = np.unpackbits(codes, axis=1).astype(np.int64)
    columns = [bits[:, a:b] @ (1 << np.arange(b - a, dtype=np.int64)) for a, b in zip(bounds[:-1], bounds[1:])]
    return np.stack(columns, axis=1)


def _words(codes: np.ndarray) -> np.ndarray:
    padded = np.zeros((len(codes), -(-codes.shape[1] // 8) * 8), np.uint8)
    padded[:, : codes.shape[1]] = codes
    return padded.view(np.int64)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, width)


def _lists(values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(0, values.size + 1, values.shape[1]), pa.int32()), pa.array(values.reshape(-1)))


def _cut(batches: Iterator[pa.RecordBatch], width: int, bounds: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(entry, code) to (entry, words, segments)."""
    for batch in batches:
        if batch.num_rows:
            codes = _matrix(batch.column(1), width)
            columns = [batch.column(0), _lists(_words(codes)), _lists(segments_of(codes, bounds))]
            yield pa.RecordBatch.from_arrays(columns, names=["entry", "words", "segments"])


def masks(width: int, radius: int, size: int = PROBES) -> Iterator[np.ndarray]:
    """All values of ``width`` bits with ``radius`` of them set, ``size`` at a time."""
    every = combinations(range(width), radius)
    while some := list(islice(every, size)):
        yield (1 << np.array(some, np.int64).reshape(len(some), radius)).sum(axis=1)


def _probe(batches: Iterator[pa.RecordBatch], widths: np.ndarray, radii: range) -> Iterator[pa.RecordBatch]:
    """(entry, words, segments, reach) of queries to (query, wanted, reach, segment, value): all values at one of ``radii``."""
    for batch in batches:
        if not batch.num_rows:
            continue
        own = batch.column(2).flatten().to_numpy().reshape(batch.num_rows, -1)
        for j, width in enumerate(widths.tolist()):
            for some in (part for radius in radii for part in masks(width, radius)):
                step = max(1, PROBES // len(some))
                for lo in range(0, batch.num_rows, step):
                    part = own[lo : lo + step, j]
                    take = pa.array(np.repeat(np.arange(lo, lo + len(part)), len(some)))
                    values = pa.array((part[:, None] ^ some[None, :]).reshape(-1))
                    columns = [batch.column(i).take(take) for i in (0, 1, 3)]
                    yield pa.RecordBatch.from_arrays([*columns, pa.array(np.full(len(values), j, np.int32)), values], names=["query", "wanted", "reach", "segment", "value"])


def top_k(rows: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """(query_id, rank, neighbour_id, distance): the k nearest of ``rows`` (id, code) to each of ``queries`` (id, code).

    Distances are exact Hamming distances; ties go to the smaller id. Ids are longs, and a query that is
    also a row finds itself. Every row takes a rank of its own, also one that repeats another; queries equal in
    id and code are one. Fewer than k rows give as many results. Codes must be of one length.
    """
    first_ids = F.row_number().over(Window.partitionBy("code").orderBy("id")) <= k
    groups = rows.withColumn("first", first_ids).where("first").groupBy("code").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    coded = stored(groups.withColumn("entry", F.monotonically_increasing_id()))
    asked = stored(queries.select("id", "code").distinct())
    distinct = stored(asked.select("code").distinct().withColumn("entry", F.monotonically_increasing_id()))
    size = F.octet_length("code")
    sizes = coded.select(size.alias("n")).union(distinct.select(size.alias("n"))).agg(F.min("n"), F.max("n")).first()
    count = coded.count()
    nothing = "query_id long, rank long, neighbour_id long, distance long"
    if not count or asked.isEmpty():
        return rows.sparkSession.createDataFrame([], nothing)
    if sizes[0] != sizes[1]:
        raise ValueError("codes must be of one length")
    width, bounds = sizes[1], segment_bounds(8 * sizes[1], count)
    widths, m = np.diff(bounds), len(bounds) - 1

    def cut(batches):
        return _cut(batches, width, bounds)

    parts = "entry bigint, words array<bigint>, segments array<bigint>"
    held = coded.select("entry", F.element_at("ids", 1).alias("first"), F.size("ids").alias("n"))
    index = coded.select("entry", "code").mapInArrow(cut, parts).join(held, "entry")
    index = stored(index.select("entry", "words", "first", "n", F.posexplode("segments").alias("segment", "value")))
    waiting = stored(distinct.select("entry", "code").mapInArrow(cut, parts).withColumn("reach", F.lit(8 * width)))
    needed, tasks = min(k, rows.count()), int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    apart = reduce(add, [F.bit_count(F.get("wanted", F.lit(i)).bitwiseXOR(F.get("words", F.lit(i)))) for i in range(-(-width // 8))])
    by_query = Window.partitionBy("query").orderBy("distance", "first")
    best, done = None, []
    for radius in range(1, int(widths.max()) + 1):
        radii = range(2) if radius == 1 else range(radius, radius + 1)  # the first two in one go
        # queries are few bytes but many probes, so small tables too are spread over all tasks
        probes = waiting.repartition(tasks, "entry").mapInArrow(
            lambda batches, radii=radii: _probe(batches, widths, radii), "query bigint, wanted array<bigint>, reach int, segment int, value bigint"
        )
        # sorted and merged: probes are few bytes when shuffled, and far more as a hash table that a task or the driver holds
        met = probes.join(index.hint("merge"), ["segment", "value"]).select("query", "entry", "first", "n", "reach", apart.alias("distance"))
        found = met.where("distance <= reach").select("query", "entry", "first", "n", "distance")
        if best is not None:
            found = found.unionByName(best.join(waiting.select(F.col("entry").alias("query")), "query", "left_semi"))
        # the k nearest rows lie in the k first entries, as each entry has a row at its smallest id
        best = found.distinct().withColumn("place", F.row_number().over(by_query)).where(F.col("place") <= k).drop("place")
        best = stored(best)
        upto = F.sum("n").over(by_query.rowsBetween(Window.unboundedPreceding, 0))
        kth = best.withColumn("upto", upto).where(F.col("upto") >= needed).groupBy("query").agg(F.min("distance").alias("kth"))
        judged = waiting.join(kth, waiting["entry"] == kth["query"], "left").drop("query")
        covered = m * (radius + 1) - 1
        more = (F.col("kth").isNull() | (F.col("kth") > covered)) if radius < widths.max() else F.lit(False)
        reach = F.coalesce("kth", F.lit(8 * width)).cast("int")
        after = stored(judged.where(more).select("entry", "words", "segments", reach.alias("reach")))
        done.append(best.join(after.select(F.col("entry").alias("query")), "query", "left_anti"))
        waiting = after
        if waiting.isEmpty():
            break
    nearest = done[0]
    for part in done[1:]:
        nearest = nearest.unionByName(part)
    listed = nearest.select("query", "entry", "distance").join(coded.select("entry", F.explode("ids").alias("neighbour_id")), "entry")
    rank = F.row_number().over(Window.partitionBy("query").orderBy("distance", "neighbour_id"))
    ranked = listed.withColumn("rank", rank).where(F.col("rank") <= k)
    names = distinct.select(F.col("entry").alias("query"), "code").join(asked, "code")
    return ranked.join(names, "query").select(
        F.col("id").alias("query_id"), F.col("rank").cast("long").alias("rank"), "neighbour_id", F.col("distance").cast("long").alias("distance")
    )


def op6_hamming_search(spark, sf_dir) -> DataFrame:
    codes = stored(sign_code(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "vec_id", "embedding"))
    return top_k(codes, codes.where(F.col("id") % QUERY_EVERY == 0))


OP6_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: coalesce(x > 0 AND NOT isnan(x), FALSE)) AS code
       FROM embeddings WHERE vec_id IS NOT NULL AND len(embedding) = 64),
 q AS (SELECT DISTINCT vec_id, code FROM v WHERE vec_id % 50 = 0),
 d AS (SELECT q.vec_id AS query_id, q.code, r.vec_id AS neighbour_id,
       CAST(list_sum(list_transform(range(1, 65), lambda i: CASE WHEN q.code[i] <> r.code[i] THEN 1 ELSE 0 END)) AS BIGINT) AS distance
       FROM q, v AS r),
 n AS (SELECT query_id, row_number() OVER (PARTITION BY query_id, code ORDER BY distance, neighbour_id) AS rank, neighbour_id, distance FROM d)
SELECT query_id, rank, neighbour_id, distance FROM n WHERE rank <= 10
"""

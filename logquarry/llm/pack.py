"""Packing by power-of-two decomposition (operator 5).

A document of n tokens is cut into pieces whose lengths are powers of two: as many of the largest as fit,
then the binary digits of the rest. Every piece is a sequence of its own, so none crosses documents and
none is padded, and sequences of equal length stand next to each other in their bucket.
"""

import base64
import re
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logquarry.llm.common import stored

MAX_LENGTH = 1024
END_ID = 0
VOCABULARY = "byte_bpe_50k.tiktoken"  # the vocabulary of byte_bpe_50k.json as ranks: the same ids, several times faster
SPECIAL = {"<|endoftext|>": 50256}  # recognised inside texts by that tokenizer
PART_CHARS = 1 << 19  # a longer text is tokenized part by part
_CUT = re.compile(r"\S(?= \S)")


@cache
def encoder(name: str = VOCABULARY) -> tiktoken.Encoding:
    with open(public_tokenizers.path(name), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines)}
    return tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL)


def piece_lengths(n: int, most: int = MAX_LENGTH) -> list[int]:
    """Powers of two up to ``most`` (itself one) that add up to ``n``, the largest first."""
    rest = n % most
    return [most] * (n // most) + [1 << i for i in range(most.bit_length() - 2, -1, -1) if rest >> i & 1]


def _parts(text: str, size: int = PART_CHARS) -> Iterator[str]:
    """A long text cut where no token can lie across: before a blank between two characters that are none."""
    at = 0
    while len(text) - at > size:
        cut = _CUT.search(text, at + size)
        if cut is None:
            break
        yield text[at : cut.start() + 1]
        at = cut.start() + 1
    yield text[at:]


def _blocks(encode: tiktoken.Encoding, text: str, most: int, end_id: int) -> Iterator[np.ndarray]:
    """A document's ids, ``end_id`` last, in arrays of ``most`` and a shorter rest; one part of the text at a time."""
    held = np.zeros(0, "<u4")
    for part in _parts(text):
        held = np.concatenate([held, np.asarray(encode.encode(part, allowed_special="all"), "<u4")])
        whole = len(held) // most * most
        for at in range(0, whole, most):
            yield held[at : at + most]
        held = held[whole:]
    held = np.append(held, np.array([end_id], "<u4"))
    yield held


def _pieces(
    batches: Iterator[pa.RecordBatch], most: int, end_id: int, vocabulary: str, with_ids: bool
) -> Iterator[pa.RecordBatch]:
    encode = encoder(vocabulary)
    for batch in batches:
        row, start, length, crc, total, ids = [], [], [], [], [], []
        for i, text in enumerate(batch.column(1)):
            at, first = 0, len(row)
            for block in _blocks(encode, text.as_py() or "", most, end_id):
                for n in piece_lengths(len(block), most):
                    part, block = block[:n], block[n:]
                    row.append(i), start.append(at), length.append(n)
                    crc.append(zlib.crc32(part.tobytes()))
                    if with_ids:
                        ids.append(part)
                    at += n
            total += [at] * (len(row) - first)
        out = [batch.column(0).take(pa.array(row, pa.int64()))] + [pa.array(x, pa.int64()) for x in (start, length, crc, total)]
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
        if with_ids:
            out.append(pa.array(ids, pa.list_(pa.uint32())).cast(pa.list_(pa.int64())))
            names.append("ids")
        yield pa.RecordBatch.from_arrays(out, names=names)


def pack(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    most: int = MAX_LENGTH,
    end_id: int = END_ID,
    vocabulary: str = VOCABULARY,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and ``ids`` on request.

    Each piece is the sequence ``sequence_id``; these are numbered without gaps, the longest bucket first,
    and ``offset`` is 0 as a sequence holds one piece. A null text counts as empty: the end token alone.
    Repeated rows and null ids are packed like any others; other columns are ignored. No rows, no pieces.
    """
    source = docs.select(F.col(f"`{id_column}`").alias("doc_id"), F.col(f"`{text_column}`").cast("string").alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    columns = f"doc_id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
    columns += ", ids array<bigint>" * with_ids

    def pieces(batches):
        return _pieces(batches, most, end_id, vocabulary, with_ids)

    place = F.monotonically_increasing_id()
    cut = stored(source.mapInArrow(pieces, columns).select("*", place.alias("place"), F.spark_partition_id().alias("part")))
    # sequences are numbered from counts per bucket and part, so no bucket is numbered by one task
    counts = cut.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    lengths = counts.groupBy("length").agg(F.sum("n").alias("n"))
    upto = Window.orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, -1)
    base = lengths.select("length", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("base"))  # a row per power of two
    within = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = (
        counts.withColumn("before", F.coalesce(F.sum("n").over(within), F.lit(0)))
        .join(F.broadcast(base), "length")
        .select("length", "part", (F.col("base") + F.col("before")).alias("first"))
    )
    number = F.row_number().over(Window.partitionBy("length", "part").orderBy("place"))
    return (
        cut.withColumn("number", number)
        .join(first, ["length", "part"])
        .withColumn("sequence_id", F.col("first") + F.col("number") - 1)
        .withColumn("offset", F.lit(0).cast("long"))
        .drop("place", "part", "number", "first")
        .select("doc_id", "start", "length", *cut.columns[3:-2], "sequence_id", "offset")
    )


def op5_pack(spark, sf_dir) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))

"""Shared pieces: stored intermediate tables, words and shingles of Arrow text columns as 64-bit hashes."""

import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

SLAB_BYTES = 2 << 20  # text handled at once by the vectorised helpers; one longer row is cut further
CHUNK_BYTES = 1 << 18

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_POLY = 0x5851F42D4C957F2D  # odd, so it has an inverse modulo 2^64
_GRAM = np.uint64(0xD1342543DE82EF95)


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; a private one only for plain local sessions without it."""
    sc = spark.sparkContext
    folder = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if sc.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        folder = tempfile.mkdtemp(prefix="logquarry-checkpoint-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(folder)
    return folder


def stored(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the checkpoint folder: lost executors cost no recomputation."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint()


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _byte_tables() -> tuple[np.ndarray, np.ndarray]:
    """Word bytes (digits, letters, all of non-ASCII) and a value per byte, A-Z as a-z."""
    word = np.zeros(256, bool)
    word[0x30:0x3A] = word[0x41:0x5B] = word[0x61:0x7B] = word[0x80:] = True
    values = mixed(np.arange(1, 257, dtype=np.uint64) * _GOLDEN)
    values[0x41:0x5B] = values[0x61:0x7B]
    return word, values


WORD_BYTE, BYTE_VALUE = _byte_tables()


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POWER = _powers(_POLY, CHUNK_BYTES)
_INVERSE = _powers(pow(_POLY, -1, 1 << 64), CHUNK_BYTES)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the n + 1 row offsets into them; null is as empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets


def slabs(offsets: np.ndarray, size: int = SLAB_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``size`` bytes; a longer row stands alone."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1)
        yield first, min(last, rows)
        first = last


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of consecutive rows and the n + 1 offsets of each row's words.

    A word is a run of digits, ASCII letters (A-Z as a-z) and non-ASCII characters. Its hash is a
    polynomial over scrambled bytes, scrambled again with the length. Bytes are taken in chunks; a word
    that crosses a chunk is carried over, so memory does not grow with the length of a word.
    """
    begin, end = int(offsets[0]), int(offsets[-1])
    hashes, places = [], []
    carried, length, at = 0, 0, 0
    for lo in range(begin, end, CHUNK_BYTES):
        hi = min(lo + CHUNK_BYTES, end)
        part = data[lo:hi]
        inside = WORD_BYTE[part]
        cut = np.zeros(hi - lo + 1, bool)
        rows = offsets[np.searchsorted(offsets, lo) : np.searchsorted(offsets, hi, "right")]
        cut[rows - lo] = True
        before = np.empty_like(inside)
        before[0], before[1:] = False, inside[:-1]
        starts = np.flatnonzero(inside & (~before | cut[:-1]))
        after = np.empty_like(inside)
        after[-1], after[:-1] = False, inside[1:]
        ends = np.flatnonzero(inside & (~after | cut[1:])) + 1
        total = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum(BYTE_VALUE[part] * _POWER[: hi - lo], out=total[1:])
        sums = (total[ends] - total[starts]) * _INVERSE[starts]
        sizes, starts = ends - starts, starts + lo
        if length:
            if len(starts) and starts[0] == lo and not cut[0]:
                sums[0] = np.uint64((carried + int(sums[0]) * pow(_POLY, length, 1 << 64)) % (1 << 64))
                sizes[0] += length
                starts[0] = at
            else:
                sums = np.concatenate([[np.uint64(carried)], sums])
                sizes, starts = np.concatenate([[length], sizes]), np.concatenate([[at], starts])
            length = 0
        if len(ends) and ends[-1] == hi - lo and hi < end and not cut[-1]:
            carried, length, at = int(sums[-1]), int(sizes[-1]), int(starts[-1])
            sums, sizes, starts = sums[:-1], sizes[:-1], starts[:-1]
        hashes.append(mixed(sums + sizes.astype(np.uint64) * _GOLDEN))
        places.append(starts)
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(places), offsets).astype(np.int64)


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of each ``n`` consecutive words; ``len(hashes) - n + 1`` of them."""
    size = max(0, len(hashes) - n + 1)
    out = np.zeros(size, np.uint64)
    for i in range(n):
        out = out * _GRAM + hashes[i : i + size]
    return mixed(out + np.uint64(n))


def row_keys(hashes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each row's word sequence; rows of equal words get equal keys."""
    place = (np.arange(len(hashes)) - np.repeat(offsets[:-1], np.diff(offsets))).astype(np.uint64)
    keys = []
    for seed in (1, 2):
        parts = np.zeros(len(hashes) + 1, np.uint64)
        np.cumsum(mixed(hashes + mixed(place * np.uint64(2) + np.uint64(seed))), out=parts[1:])
        keys.append(mixed(parts[offsets[1:]] - parts[offsets[:-1]] + np.diff(offsets).astype(np.uint64)).view(np.int64))
    return keys[0], keys[1]


def filter_bits(count: int, spare: int, most: int = 28) -> int:
    """Bits for ``bitmap`` so that about 1 in 2^``spare`` other values pass; at most 2^28 bits, which are 32 MB.

    Beyond that more values pass, which costs work but changes no result.
    """
    return min(most, max(20, count.bit_length() + spare))


def bitmap(df: DataFrame, column: str, bits: int) -> np.ndarray:
    """A table of 2^``bits`` bits, set at the low bits of every value of a long column.

    It is combined on the executors; what reaches the driver is at most 2^(bits-6) rows, whatever the
    number of values. Use ``maybe_in`` to test values: it may say yes wrongly, never no wrongly.
    """
    slot = f"`{column}` & {(1 << bits) - 1}L"
    rows = (
        df.where(f"`{column}` IS NOT NULL")
        .selectExpr(f"shiftright({slot}, 6) AS place", f"shiftleft(1L, cast({slot} & 63 AS int)) AS bit")
        .groupBy("place")
        .agg({"bit": "bit_or"})
        .toArrow()
    )
    table = np.zeros(1 << (bits - 6), np.uint64)
    table[rows.column(0).to_numpy()] = rows.column(1).to_numpy().view(np.uint64)
    return table


def maybe_in(table: np.ndarray, values: np.ndarray) -> np.ndarray:
    slot = values & np.uint64(len(table) * 64 - 1)
    return (table[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) == 1

"""Benchmark decontamination by winnowing (operator 1).

Winnowing keeps the smallest k-gram hash of every window of w consecutive k-grams. Two texts that share
k + w - 1 words share a whole window, so they keep the same k-gram there: with k = 5 and w = 9 no shared
span of 13 words is missed. An item shorter than that is its own single fingerprint (k = its length, w = 1).

Documents send on only fingerprints that a bit table of bounded size may know; these meet the items'
fingerprints in an ordinary join. Each meeting carries the words around both places, and the hit is
extended word by word; it counts when the run reaches the window's length. Words are compared by 64-bit
hashes: a wrong hit would need thirteen collisions in a row.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logquarry.llm.common import bitmap, filter_bits, grams, maybe_in, row_keys, slabs, stored, utf8, words

SPAN = 13  # words of a window
GRAM = 5
WINDOW = SPAN - GRAM + 1
REACH = SPAN - GRAM  # words looked at on each side of a fingerprint
CONTEXT = REACH + SPAN

_DOC_PAD, _ITEM_PAD = np.uint64(1), np.uint64(2)

_PRINTS = pa.struct(
    [("size", pa.int32()), ("fp", pa.int64()), ("pos", pa.int64()), ("around", pa.binary())]
)
_PRINTS_DDL = "array<struct<size: int, fp: bigint, pos: bigint, around: binary>>"


def winnow(prints: np.ndarray, usable: np.ndarray, window: int) -> np.ndarray:
    """Positions of the rightmost smallest print of each window of ``window`` prints that starts at a usable place."""
    n = len(prints) - window + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    value, place, width = prints, np.arange(len(prints)), 1
    while width < window:  # windows of doubling width, the last step overlaps
        step = min(width, window - width)
        size = len(prints) - width - step + 1
        a, b = value[:size], value[step : step + size]
        right = b <= a
        value, place = np.where(right, b, a), np.where(right, place[step : step + size], place[:size])
        width += step
    chosen = place[usable[:n]]
    return chosen[np.flatnonzero(np.diff(chosen, prepend=-1))]


def _fingerprints(hashes: np.ndarray, offsets: np.ndarray, short: list[int], table: np.ndarray | None):
    """(size, position, print) of a slab's fingerprints; ``table`` filters, ``short`` are lengths of short items."""
    left = np.repeat(offsets[1:], np.diff(offsets)) - np.arange(len(hashes))  # words from here to the row's end
    for kind in [0, *short]:
        size = kind or GRAM
        found = grams(hashes, size)
        room = left[: len(found)]
        if kind:
            places = np.flatnonzero(room >= size)
        else:
            places = winnow(np.where(room >= size, found, np.uint64(2**64 - 1)), room >= SPAN, WINDOW)
        prints = found[places]
        if table is not None:
            known = maybe_in(table, prints)
            places, prints = places[known], prints[known]
        yield kind, places, prints


def _around(hashes: np.ndarray, offsets: np.ndarray, rows: np.ndarray, places: np.ndarray, pad: np.uint64):
    at = places[:, None] + np.arange(-REACH, SPAN)[None, :]
    inside = (at >= offsets[rows][:, None]) & (at < offsets[rows + 1][:, None])
    return np.where(inside, hashes[np.clip(at, 0, max(0, len(hashes) - 1))], pad) if len(hashes) else at.astype(np.uint64)


def _as_lists(rows: np.ndarray, n: int, parts: list) -> pa.ListArray:
    order = np.argsort(rows, kind="stable")
    kind, prints, places, around = (np.concatenate(x)[order] for x in zip(*parts))
    blobs = pa.FixedSizeBinaryArray.from_buffers(
        pa.binary(8 * CONTEXT), len(order), [None, pa.py_buffer(np.ascontiguousarray(around).tobytes())]
    ).cast(pa.binary())
    values = pa.StructArray.from_arrays(
        [pa.array(kind, pa.int32()), pa.array(prints.view(np.int64)), pa.array(places, pa.int64()), blobs],
        fields=list(_PRINTS),
    )
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(rows[order], np.arange(n + 1)), pa.int32()), values)


def _scan(batches: Iterator[pa.RecordBatch], short: list[int], table, own_short: bool, pad) -> Iterator[pa.RecordBatch]:
    """(id, text) batches to (id, k1, k2, n_words, prints). With ``own_short`` a short row is its own fingerprint."""
    for batch in batches:
        data, bounds = utf8(batch.column(1))
        for first, last in slabs(bounds):
            hashes, offsets = words(data, bounds[first : last + 1])
            n_words = np.diff(offsets)
            parts, rows = [], []
            for kind, places, prints in _fingerprints(hashes, offsets, short, table):
                row = np.searchsorted(offsets, places, "right") - 1
                if kind and own_short:
                    whole = n_words[row] == kind
                    row, places, prints = row[whole], places[whole], prints[whole]
                parts.append((np.full(len(row), kind), prints, places - offsets[row], _around(hashes, offsets, row, places, pad)))
                rows.append(row)
            k1, k2 = row_keys(hashes, offsets)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(first, last - first),
                    pa.array(k1),
                    pa.array(k2),
                    pa.array(n_words, pa.int64()),
                    _as_lists(np.concatenate(rows), last - first, parts),
                ],
                names=["id", "k1", "k2", "n_words", "prints"],
            )


def _scanned(
    df: DataFrame, id_column: str, text_column: str, short: list[int], table, own_short: bool, pad
) -> DataFrame:
    source = df.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").cast("string").alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    shared = None if table is None else df.sparkSession.sparkContext.broadcast(table)

    def scan(batches):
        return _scan(batches, short, None if shared is None else shared.value, own_short, pad)

    return source.mapInArrow(scan, f"id {kind}, k1 bigint, k2 bigint, n_words bigint, prints {_PRINTS_DDL}")


def _extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Grow each meeting left and right while the words agree; keep runs that hold a whole window."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size, pos = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("size", "pos"))
        doc, item = (
            np.frombuffer(b"".join(batch.column(batch.schema.get_field_index(c)).to_pylist()), np.uint64).reshape(-1, CONTEXT)
            for c in ("around", "item_around")
        )
        same = doc == item
        core = np.where(size == 0, GRAM, size)
        middle = (same[:, REACH:] | (np.arange(SPAN)[None, :] >= core[:, None])).all(axis=1)
        left = np.logical_and.accumulate(same[:, REACH - 1 :: -1], axis=1).sum(axis=1)
        right = np.logical_and.accumulate(same[:, REACH + GRAM :], axis=1).sum(axis=1)
        long = size == 0
        keep = middle & (~long | (left + GRAM + right >= SPAN))
        start = np.where(long, pos - left, pos)[keep]
        end = np.where(long, pos + GRAM + right, pos + size)[keep]
        kept = batch.filter(pa.array(keep))
        yield pa.RecordBatch.from_arrays(
            [kept.column(kept.schema.get_field_index(c)) for c in ("k1", "k2", "item_id")]
            + [pa.array(start, pa.int64()), pa.array(end, pa.int64())],
            names=["k1", "k2", "item_id", "start", "end"],
        )


def item_prints(
    items: DataFrame, item_column: str = "item_id", text_column: str = "text"
) -> tuple[DataFrame, list[int]]:
    """(size, fp, item_id, item_around) of all items, and the lengths of the items shorter than a window."""
    every = list(range(1, SPAN))
    scanned = stored(_scanned(items, item_column, text_column, every, None, True, _ITEM_PAD))
    lengths = scanned.where(F.col("n_words").between(1, SPAN - 1)).select("n_words").distinct().collect()
    prints = scanned.select(F.col("id").alias("item_id"), F.inline("prints")).select(
        "item_id", "size", "fp", F.col("around").alias("item_around")
    )
    return prints.distinct(), sorted(r["n_words"] for r in lengths)  # at most twelve lengths


def hit_spans(
    docs: DataFrame,
    items: DataFrame,
    id_column="doc_id",
    text_column="text",
    item_column="item_id",
    item_text="text",
    bits: int | None = None,
):
    """(documents, spans): documents as (id, k1, k2, n_words); spans as (k1, k2, item_id, start, end) in words.

    ``k1, k2`` stand for the word sequence, so copies of a text share their spans and are matched once.
    """
    prints, short = item_prints(items, item_column, item_text)
    table = bitmap(prints, "fp", bits or filter_bits(prints.count(), 10))
    scanned = stored(_scanned(docs, id_column, text_column, short, table, False, _DOC_PAD))
    found = scanned.where(F.size("prints") > 0).select("k1", "k2", F.inline("prints")).distinct()
    met = found.join(prints, ["size", "fp"]).select("k1", "k2", "size", "pos", "around", "item_id", "item_around")
    kind = prints.schema["item_id"].dataType.simpleString()
    spans = met.mapInArrow(_extend, f"k1 bigint, k2 bigint, item_id {kind}, start bigint, end bigint").distinct()
    return scanned.drop("prints"), spans


def contamination(
    docs: DataFrame,
    items: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text: str = "text",
    share: int = 20,
    bits: int | None = None,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    A document word is hit when it lies in an occurrence of a window of an item: 13 consecutive item
    words, or the whole of a shorter item. ``contaminated``: something is hit, and at least one word in
    ``share``. Null or wordless text has no words and no hits; a wordless item has no window. An item
    without id marks words but is not listed. Repeated rows each get their own result; without items
    nothing is hit. Ids may be of any type and other columns are ignored.
    """
    rows, spans = hit_spans(docs, items, id_column, text_column, item_column, item_text, bits)
    spans = stored(spans)
    key = ["k1", "k2"]
    upto = F.max("end").over(Window.partitionBy(*key).orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1))
    covered = (
        spans.select(*key, "start", "end")
        .distinct()
        .withColumn("new", F.greatest(F.lit(0), F.col("end") - F.greatest("start", F.coalesce(upto, F.lit(0)))))
        .groupBy(*key)
        .agg(F.sum("new").alias("n_hit"))
    )
    listed = (
        spans.select(*key, F.col("item_id").cast("string").alias("item"))
        .distinct()
        .groupBy(*key)
        .agg(F.sort_array(F.collect_list("item")).alias("items"))
    )
    found = stored(covered.join(listed, key))  # a plain side, so that a text with very many copies can be split in the join
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    items_of = F.coalesce("items", F.array().cast("array<string>"))
    return rows.join(found, key, "left").select(
        F.col("id").alias("doc_id"),
        "n_words",
        n_hit.alias("n_hit"),
        F.size(items_of).cast("long").alias("n_items"),
        F.sha2(F.array_join(items_of, ","), 256).alias("items_sha256"),
        ((n_hit > 0) & (n_hit * share >= F.col("n_words"))).alias("contaminated"),
    )


def op1_decontaminate(spark, sf_dir) -> DataFrame:
    return contamination(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


OP1_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
 b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
 bw AS (SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(list_slice(w, i, i + least(13, len(w)) - 1), ' ') AS g
        FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
 sizes AS (SELECT DISTINCT n FROM bw),
 dw AS (SELECT r, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS g
        FROM (SELECT r, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
 m AS (SELECT r, dw.n AS n, i, item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.g = bw.g),
 h AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT r, n, i FROM m)) GROUP BY r),
 t AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
       FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM m) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN h ON d.r = h.r LEFT JOIN t ON d.r = t.r
"""

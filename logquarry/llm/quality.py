"""Quality by a generalised additive model with pairwise interactions (operator 8).

Every text becomes a few numbers (lengths, repetition, character classes). Each number is binned, and the
model is a lookup table per number and per chosen pair of numbers. The tables are learned by cyclic
boosting: in turn, each feature gets a shallow tree on the current gradients, which is added to its table.
Then the pairs that explain most of what is left are boosted the same way. A score is a sum of table cells.
"""

from collections.abc import Iterator
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logquarry.llm.common import slabs, stored, utf8, words
from logquarry.llm.learn import held_out, label_sample, one_label
from logquarry.llm.neardup import shingles

SAMPLE_PER_LABEL = 12_000  # labelled rows of each label that the model learns from, at most
BINS, ROUNDS, PAIR_ROUNDS, PAIRS, RATE, LEAVES = 32, 150, 50, 6, 0.15, 3
THRESHOLD = 0.3

FEATURES = [
    "words", "bytes_per_word", "distinct_words", "repeated_next", "commonest_word", "distinct_triples", "bytes_per_line",
    "upper", "lower", "digits", "other_letters", "blanks", "sentence_marks", "stress_marks", "separators", "symbols",
]
_CLASSES = 9  # 0 upper, 1 lower, 2 digit, 3 non-ASCII, 4 blank, 5 .,;:'"-()  6 !?  7 |/\_  8 other


def _byte_classes() -> np.ndarray:
    out = np.full(256, 8, np.int64)
    out[0x41:0x5B], out[0x61:0x7B], out[0x30:0x3A], out[0x80:] = 0, 1, 2, 3
    for chars, k in ((b" \t\r\n", 4), (b".,;:'\"-()", 5), (b"!?", 6), (b"|/\\_", 7)):
        out[list(chars)] = k
    return out


_CLASS = _byte_classes()


def features(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One row of ``FEATURES`` per text; all zero for a text without bytes."""
    rows, begin = len(bounds) - 1, int(bounds[0])
    size = np.diff(bounds)
    counts, lines = np.zeros((rows, _CLASSES)), np.zeros(rows)
    step = 1 << 20
    for lo in range(begin, int(bounds[-1]), step):  # bytes in chunks, so one long text needs no more memory
        part = data[lo : min(lo + step, int(bounds[-1]))]
        row = np.searchsorted(bounds, np.arange(lo, lo + len(part)), "right") - 1 if rows > 1 else np.zeros(len(part), np.int64)
        counts += np.bincount(row * _CLASSES + _CLASS[part], minlength=rows * _CLASSES).reshape(rows, _CLASSES)
        lines += np.bincount(row[part == 10], minlength=rows)
    hashes, offsets = words(data, bounds)
    n = np.diff(offsets)
    some = np.maximum(n, 1)
    _, often, parts = shingles(hashes, offsets, 1)
    _, _, triples = shingles(hashes, offsets, 3)
    same = np.zeros(len(hashes) + 1, np.int64)
    if len(hashes) > 1:
        equal = np.append(hashes[1:] == hashes[:-1], False)
        equal[offsets[1:][n > 0] - 1] = False
        same[1:] = np.cumsum(equal)
    most = np.zeros(rows)
    filled = np.diff(parts) > 0
    if filled.any():
        most[filled] = np.maximum.reduceat(often, parts[:-1][filled])
    letters = size - counts[:, 4]
    share = counts / np.maximum(size, 1)[:, None]
    return np.column_stack(
        [
            np.log1p(n), letters / some, np.diff(parts) / some, (same[offsets[1:]] - same[offsets[:-1]]) / some, most / some,
            np.diff(triples) / np.maximum(n - 2, 1), np.log1p(size / (lines + 1)), share,
        ]
    )


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, bounds = utf8(batch.column(1))
        for first, last in slabs(bounds):
            values = features(data, bounds[first : last + 1]).astype(np.float32)
            flat = pa.ListArray.from_arrays(
                pa.array(np.arange(0, values.size + 1, values.shape[1]), pa.int32()), pa.array(values.reshape(-1), pa.float32())
            )
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, last - first), flat], names=["doc_id", "features"])


class Model(NamedTuple):
    """Bin edges and a table of addends per feature; tables over two features' bins; the constant addend."""

    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int, np.ndarray]]
    base: float


def _bins(values: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.column_stack([np.searchsorted(e, values[:, f], "right") for f, e in enumerate(edges)])


def _tree(gradient: np.ndarray, hessian: np.ndarray, leaves: int = LEAVES) -> np.ndarray:
    """A tree of up to ``leaves`` leaves over ordered bins: the addend of each bin (a Newton step per leaf)."""
    g, h = np.concatenate([[0.0], np.cumsum(gradient)]), np.concatenate([[0.0], np.cumsum(hessian)])
    gain_of = lambda a, b: (g[b] - g[a]) ** 2 / (h[b] - h[a] + 1.0)
    cuts = [0, len(gradient)]
    for _ in range(leaves - 1):
        best = (1e-9, None)
        for a, b in zip(cuts[:-1], cuts[1:]):
            inner = np.arange(a + 1, b)
            if len(inner):
                gains = gain_of(a, inner) + gain_of(inner, b) - gain_of(a, b)
                i = int(gains.argmax())
                if gains[i] > best[0]:
                    best = (gains[i], int(inner[i]))
        if best[1] is None:
            break
        cuts = sorted([*cuts, best[1]])
    out = np.zeros(len(gradient))
    for a, b in zip(cuts[:-1], cuts[1:]):
        out[a:b] = (g[b] - g[a]) / (h[b] - h[a] + 1.0)
    return out


def _pair_tree(gradient: np.ndarray, hessian: np.ndarray) -> tuple[np.ndarray, float]:
    """One cut of each axis of a bins x bins histogram: addends of the four cells, and the gain."""
    g, h = (np.pad(x.cumsum(0).cumsum(1), ((1, 0), (1, 0))) for x in (gradient, hessian))
    rows, cols = gradient.shape
    corner = lambda x: (x[1:rows, 1:cols], x[1:rows, -1:] - x[1:rows, 1:cols], x[-1:, 1:cols] - x[1:rows, 1:cols])
    (ga, gb, gc), (ha, hb, hc) = corner(g), corner(h)
    gd, hd = g[-1, -1] - ga - gb - gc, h[-1, -1] - ha - hb - hc
    gains = sum(x**2 / (y + 1.0) for x, y in ((ga, ha), (gb, hb), (gc, hc), (gd, hd)))
    if not gains.size:
        return np.zeros_like(gradient), 0.0
    i, j = np.unravel_index(gains.argmax(), gains.shape)
    out = np.empty_like(gradient)
    out[: i + 1, : j + 1], out[: i + 1, j + 1 :] = ga[i, j] / (ha[i, j] + 1), gb[i, j] / (hb[i, j] + 1)
    out[i + 1 :, : j + 1], out[i + 1 :, j + 1 :] = gc[i, j] / (hc[i, j] + 1), gd[i, j] / (hd[i, j] + 1)
    return out, float(gains[i, j])


def fit(
    values: np.ndarray,
    label: np.ndarray,
    weight: np.ndarray,
    bins: int = BINS,
    rounds: int = ROUNDS,
    pair_rounds: int = PAIR_ROUNDS,
    n_pairs: int = PAIRS,
    rate: float = RATE,
) -> Model:
    """The model of a bounded sample. Without rows, or with one label only, it is a constant."""
    count = values.shape[1] if values.ndim == 2 else len(FEATURES)
    if not len(label):
        return Model([np.zeros(0)] * count, [np.zeros(1)] * count, [], 0.0)
    edges = [np.unique(np.quantile(values[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(count)]
    place = _bins(values, edges)
    mean = np.clip((weight * label).sum() / weight.sum(), 1e-3, 1 - 1e-3)
    base = float(np.log(mean / (1 - mean)))
    tables = [np.zeros(len(e) + 1) for e in edges]
    z = np.full(len(label), base)
    weight = weight * len(weight) / weight.sum()

    def steps():
        p = 1 / (1 + np.exp(-z))
        return weight * (label - p), weight * p * (1 - p)

    for _ in range(rounds):
        for f in range(count):
            gradient, hessian = steps()
            at, size = place[:, f], len(tables[f])
            add = rate * _tree(np.bincount(at, gradient, size), np.bincount(at, hessian, size))
            tables[f] += add
            z += add[at]

    def grid(i, j, gradient, hessian):
        shape = (len(tables[i]), len(tables[j]))
        cell = place[:, i] * shape[1] + place[:, j]
        return cell, *(np.bincount(cell, x, shape[0] * shape[1]).reshape(shape) for x in (gradient, hessian))

    gradient, hessian = steps()
    gains = {(i, j): _pair_tree(*grid(i, j, gradient, hessian)[1:])[1] for i, j in combinations(range(count), 2)}
    chosen = sorted(gains, key=lambda p: (-gains[p], p))[:n_pairs]
    pair_tables = {p: np.zeros((len(tables[p[0]]), len(tables[p[1]]))) for p in chosen}
    for _ in range(pair_rounds):
        for i, j in chosen:
            cell, g, h = grid(i, j, *steps())
            add = rate * _pair_tree(g, h)[0]
            pair_tables[i, j] += add
            z += add.reshape(-1)[cell]
    return Model(edges, tables, [(i, j, t) for (i, j), t in pair_tables.items()], base)


def predict(model: Model, values: np.ndarray) -> np.ndarray:
    """Probabilities: one gather and addition per table."""
    place = _bins(values, model.edges)
    z = np.full(len(values), model.base)
    for f, table in enumerate(model.tables):
        z += table[place[:, f]]
    for i, j, table in model.pairs:
        z += table[place[:, i], place[:, j]]
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def featured(docs: DataFrame) -> DataFrame:
    """(doc_id, features) of every row of ``docs`` (doc_id, text)."""
    source = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(_featured, f"doc_id {kind}, features array<float>")


def learn(
    docs: DataFrame, labels: DataFrame, parts: int = 5, part: int = 0, per_label: int = SAMPLE_PER_LABEL
) -> Model:
    """The model of labelled ``docs`` (doc_id, text) that are not held out.

    At most about ``per_label`` rows of either label are used, chosen by a hash of their ids, one for each
    id; only their features reach the driver.
    """
    known = one_label(labels, "quality").where("label IN (0, 1)")
    sample = F.broadcast(stored(label_sample(known.where(~held_out(F.col("doc_id"), parts, part)), per_label)))  # bounded
    # an id that many rows repeat is one row of the sample; reduced in the tasks that read them
    rows = featured(docs.join(sample, "doc_id", "left_semi")).groupBy("doc_id").agg(F.min("features").alias("features"))
    got = rows.join(sample, "doc_id").orderBy("doc_id", "features").select("label", "weight", "features").toArrow()
    if not got.num_rows:
        return fit(np.zeros((0, len(FEATURES))), np.zeros(0), np.zeros(0))
    flat = got["features"].combine_chunks().flatten().to_numpy()
    return fit(flat.reshape(got.num_rows, -1).astype(np.float64), got["label"].to_numpy().astype(float), got["weight"].to_numpy())


def scorer(model: Model):
    """A column function from a text to its score, for filters that keep the other columns where they are."""

    def scored(texts: pa.Array) -> pa.Array:
        data, bounds = utf8(texts)
        parts = [predict(model, features(data, bounds[a : b + 1]).astype(np.float32).astype(np.float64)) for a, b in slabs(bounds)]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0))

    return F.arrow_udf(scored, "double")


def score(docs: DataFrame, model: Model, parts: int = 5, part: int = 0, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, held_out, score, predicted.

    A null, empty or wordless text has zero features and is scored like any other. Repeated rows get equal
    scores, a null id is not held out, and other columns are ignored.
    """
    text = F.col("text").cast("string")
    return docs.select("doc_id", scorer(model)(text).alias("score")).select(
        "doc_id",
        held_out(F.col("doc_id"), parts, part).alias("held_out"),
        "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"),
    )


def op8_quality(spark, sf_dir) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return score(docs, learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))

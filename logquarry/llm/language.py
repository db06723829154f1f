"""Language by sparse multinomial logistic regression on TF-IDF character n-grams (operator 10).

A text is lower-cased, its letters kept and everything else made a blank; its n-grams of one to three
characters, words marked by blanks, are hashed to 2^15 buckets. A bucket's value is its share of the text's
n-grams times its inverse document frequency, which is counted over
the documents that the model may learn from: those that have a language and are not held out. The weights are learned
by follow-the-regularised-leader with elastic-net penalties, which leave most of them exactly zero, on a
bounded sample of labelled rows. A temperature fitted on a part of the sample kept aside scales the scores.
"""

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logquarry.llm.common import slabs, utf8
from logquarry.llm.learn import held_out, label_sample, one_row

BUCKETS = 1 << 15
ORDERS = (1, 2, 3)
SAMPLE_PER_LABEL = 1_500  # labelled rows of each language that the model learns from, at most
ALPHA, BETA, L1, L2, EPOCHS = 0.5, 1.0, 1e-3, 1e-4, 6
SCALE = 25.0  # of the inputs, whose sum is near 1 otherwise, so that weights stay small
UNKNOWN = "und"
_SLAB = 1 << 19  # bytes of a slab, and characters of a long text's pieces
_BLANK = re.compile(r"\s")


class _Letters(dict):
    """Letters stay, all else becomes a blank; asked once for each character."""

    def __missing__(self, code: int) -> int:
        self[code] = code if chr(code).isalpha() else 32
        return self[code]


_LETTERS = _Letters()


def ngrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of the texts, text after text, and the n + 1 offsets; none for a text without letters.

    An n-gram holds letters of one word and may hold the blank before or after it, so a text may be cut at
    any blank without changing its n-grams.
    """
    cleaned = [f" {' '.join(t.lower().translate(_LETTERS).split())} " for t in texts]
    cleaned = [c if len(c) > 2 else "" for c in cleaned]
    sizes = np.array([len(c) for c in cleaned], np.int64)
    codes = np.frombuffer("".join(cleaned).encode("utf-32-le"), np.uint32)
    blank = codes == 32
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    table, usable = np.zeros((len(codes), len(ORDERS)), np.uint16), np.zeros((len(codes), len(ORDERS)), bool)
    value = np.zeros(len(codes), np.uint32)
    for k, n in enumerate(ORDERS):
        if len(codes) < n:
            break
        size = len(codes) - n + 1
        value = value[:size] * np.uint32(0x01000193) + codes[n - 1 :] * np.uint32(0x9E3779B1)
        table[:size, k] = ((value ^ (value >> np.uint32(15))) * np.uint32(0x85EBCA6B)) >> np.uint32(17)
        if n == 1:
            usable[:, k] = ~blank
        elif n == 2:
            usable[:size, k] = ~(blank[:-1] & blank[1:])  # two blanks: the end of one text and the start of the next
        else:
            usable[:size, k] = ~blank[1 : size + 1]
    return table[usable], np.concatenate([[0], np.cumsum(usable.sum(axis=1))])[bounds]


def _parts(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """N-grams of a slab; a long text, which is alone in its slab, piece by piece."""
    if len(texts) > 1 or len(texts[0]) <= _SLAB:
        yield ngrams(texts)
        return
    text, at = texts[0], 0
    while at < len(text):
        cut = _BLANK.search(text, at + _SLAB)
        end = cut.end() if cut else len(text)
        yield ngrams([text[at:end]])
        at = end


def _slabs(column: pa.Array, rows: int) -> Iterator[tuple[int, int, Iterator[tuple[np.ndarray, np.ndarray]]]]:
    """(first row, rows, their n-grams) in slabs of bounded bytes and rows."""
    _, bounds = utf8(column)
    for first, last in slabs(bounds, _SLAB):
        for at in range(first, last, rows):
            texts = [t or "" for t in column.slice(at, min(rows, last - at)).to_pylist()]
            yield at, len(texts), _parts(texts)


def _document_frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text) to (bucket, docs) of a task; bucket -1 counts all texts with letters."""
    counts, texts = np.zeros(BUCKETS, np.int64), 0
    for batch in batches:
        for _, rows, parts in _slabs(batch.column(0), 256):
            marked = np.zeros(rows * BUCKETS, bool)
            for buckets, offsets in parts:
                marked[np.repeat(np.arange(rows) * BUCKETS, np.diff(offsets)) + buckets] = True
            marked = marked.reshape(rows, BUCKETS)
            counts += marked.sum(axis=0)
            texts += int(marked.any(axis=1).sum())
    at = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(counts[at], texts))], names=["bucket", "docs"])


class Model(NamedTuple):
    """``weights``: languages x buckets, with the inverse document frequencies multiplied in."""

    labels: list[str]
    weights: np.ndarray
    bias: np.ndarray
    temperature: float


def _probabilities(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit_ftrl(
    rows: list[tuple[np.ndarray, np.ndarray]],
    label: np.ndarray,
    classes: int,
    epochs: int = EPOCHS,
    alpha: float = ALPHA,
    beta: float = BETA,
    l1: float = L1,
    l2: float = L2,
) -> tuple[np.ndarray, np.ndarray]:
    """FTRL-Proximal over sparse rows (buckets, values): weights (classes x buckets) and bias.

    Per weight it keeps the sum of squared gradients and the shifted sum of gradients; the weight follows
    in closed form, zero while that sum stays within the l1 penalty.
    """
    used = np.unique(np.concatenate([at for at, _ in rows])) if rows else np.zeros(0, int)  # all others stay zero
    rows = [(np.searchsorted(used, at), x) for at, x in rows]
    z, n = np.zeros((classes, len(used) + 1)), np.zeros((classes, len(used) + 1))

    def weights(at):
        zi, ni = z[:, at], n[:, at]
        return np.where(np.abs(zi) <= l1, 0.0, -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(ni)) / alpha + l2))

    order = np.random.default_rng(11)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            at, x = np.append(rows[i][0], len(used)), np.append(rows[i][1], 1.0)
            w = weights(at)
            p = _probabilities(w @ x)
            p[label[i]] -= 1
            g = p[:, None] * x[None, :]
            before = n[:, at]
            z[:, at] += g - (np.sqrt(before + g * g) - np.sqrt(before)) / alpha * w
            n[:, at] = before + g * g
    w, out = weights(np.arange(len(used) + 1)), np.zeros((classes, BUCKETS))
    out[:, used] = w[:, :-1]
    return out, w[:, -1]


def fit_temperature(logits: np.ndarray, label: np.ndarray) -> float:
    """The divisor of the logits with the least log loss, from a fine geometric grid."""
    if not len(label):
        return 1.0
    grid = np.geomspace(0.05, 20, 241)
    losses = [-np.log(np.maximum(_probabilities(logits / t)[np.arange(len(label)), label], 1e-12)).mean() for t in grid]
    return float(grid[int(np.argmin(losses))])


def _sample_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, label, text) of a bounded sample to (doc_id, label, buckets, counts)."""
    for batch in batches:
        for first, rows, parts in _slabs(batch.column(2), 16):
            counts = np.zeros((rows, BUCKETS), np.int64)
            for buckets, offsets in parts:
                cells = np.repeat(np.arange(rows) * BUCKETS, np.diff(offsets)) + buckets
                counts += np.bincount(cells, minlength=rows * BUCKETS).reshape(rows, BUCKETS)
            found = [np.flatnonzero(c) for c in counts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(first, rows),
                    batch.column(1).slice(first, rows),
                    pa.array(found, pa.list_(pa.int32())),
                    pa.array([c[at] for c, at in zip(counts, found)], pa.list_(pa.int32())),
                ],
                names=["doc_id", "label", "buckets", "counts"],
            )


def document_frequencies(texts: DataFrame) -> dict[int, int]:
    """Texts that hold each bucket, and under -1 all texts with letters."""
    counted = texts.mapInArrow(_document_frequencies, "bucket bigint, docs bigint")
    found = counted.groupBy("bucket").agg(F.sum("docs").alias("docs")).toArrow()
    return dict(zip(found["bucket"].to_pylist(), found["docs"].to_pylist()))


def learn(
    docs: DataFrame, lang_column: str = "lang", parts: int = 4, part: int = 2, per_label: int = SAMPLE_PER_LABEL
) -> Model:
    """The model of labelled ``docs`` (doc_id, text, lang) that are not held out.

    Document frequencies cover the texts of all these rows; held-out texts and those without a language
    shape nothing. The weights come from at most about ``per_label`` rows of each language, chosen by a hash
    of their ids, one row for each id; a fifth of those is kept aside for the temperature. What reaches the
    driver are 2^15 counts and the sample's n-gram counts.
    """
    text = F.col("text").cast("string").alias("text")
    rows = docs.select("doc_id", F.col(lang_column).cast("string").alias("label"), text)
    rows = rows.where(~held_out(F.col("doc_id"), parts, part) & F.col("label").isNotNull())
    frequency = document_frequencies(rows.select("text"))
    total = frequency.pop(-1, 0)
    idf = np.full(BUCKETS, np.log(1 + total))
    at = np.array(list(frequency), np.int64)
    idf[at] = np.log((1 + total) / (1 + np.array(list(frequency.values())))) if len(at) else 0
    idf = SCALE * (idf + 1)

    kind = rows.schema["doc_id"].dataType.simpleString()
    chosen = one_row(label_sample(rows, per_label).select("doc_id", "label", "text"))
    sample = chosen.mapInArrow(_sample_rows, f"doc_id {kind}, label string, buckets array<int>, counts array<int>").where(F.size("buckets") > 0)
    got = sample.withColumn("aside", F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(5)) == 0).orderBy("doc_id", "label").toArrow()
    labels = sorted(set(got["label"].to_pylist()))
    if not labels:
        return Model([], np.zeros((0, BUCKETS)), np.zeros(0), 1.0)
    label = np.array([labels.index(x) for x in got["label"].to_pylist()])
    sparse = []
    for b, c in zip(got["buckets"], got["counts"]):
        bucket, count = b.values.to_numpy(), c.values.to_numpy()
        sparse.append((bucket, count / count.sum() * idf[bucket]))
    aside = got["aside"].to_numpy(zero_copy_only=False)
    train = np.flatnonzero(~aside) if (~aside).any() else np.arange(len(label))
    weights, bias = fit_ftrl([sparse[i] for i in train], label[train], len(labels))
    logits = np.array([weights[:, sparse[i][0]] @ sparse[i][1] + bias for i in np.flatnonzero(aside)])
    return Model(labels, weights * idf[None, :], bias, fit_temperature(logits, label[aside]))


def predict(docs: DataFrame, model: Model, parts: int = 4, part: int = 2) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, held_out, lang_pred, score (the calibrated probability).

    ``und`` with score 0 for a null text or one without letters, and for all when nothing was learned. Ties
    go to the first language by name. Repeated rows get equal predictions; a null id is not held out.
    """
    source = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model._replace(weights=np.ascontiguousarray(model.weights.T.astype(np.float32))))

    def predicted(batches):
        labels, weights, bias, temperature = shared.value
        names = np.array([*labels, UNKNOWN], object)
        for batch in batches:
            for first, rows, parts in _slabs(batch.column(1), 4096):
                size, sums = np.zeros(rows, np.int64), np.zeros((rows, len(labels)))
                for buckets, offsets in parts:
                    here = np.diff(offsets)
                    some = here > 0
                    if labels and some.any():
                        sums[some] += np.add.reduceat(weights[buckets], offsets[:-1][some], axis=0, dtype=np.float64)
                    size += here
                best, sure = np.full(rows, len(labels)), np.zeros(rows)
                some = size > 0
                if labels and some.any():
                    p = _probabilities((sums[some] / size[some][:, None] + bias) / temperature)
                    best[some], sure[some] = p.argmax(axis=1), p.max(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, rows), pa.array(names[best], pa.string()), pa.array(sure)],
                    names=["doc_id", "lang_pred", "score"],
                )

    rows = source.mapInArrow(predicted, f"doc_id {kind}, lang_pred string, score double")
    return rows.select("doc_id", held_out(F.col("doc_id"), parts, part).alias("held_out"), "lang_pred", "score")


def op10_language(spark, sf_dir) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return predict(docs, learn(docs))

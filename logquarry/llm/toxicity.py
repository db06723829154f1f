"""Toxicity by a weighted lexicon matched with Aho-Corasick (operator 7).

Texts are folded first: lower case, look-alike letters of other scripts and full-width forms as Latin,
digits and signs that stand for letters as those letters, no invisible characters, and everything else
that is not a letter as a blank. The lexicon holds word beginnings and whole words with the log of how much
more often they occur in toxic documents, learned from labelled rows; of copies and near copies, which
would make any of their words look telling, one is counted. Exception phrases are learned from the same rows:
pairs of words with an entry in them that are at home in clean documents. One automaton finds the lexicon's
entries and the exception phrases; a match inside an exception phrase does not count. A word counts with its heaviest
entry, and an entry found n times counts 1 + ln n times. The sum and the sum per word, both as logarithms,
give the score through a logistic curve fitted on labelled rows that the lexicon was not learned from.
"""

import math
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logquarry.llm.common import _GOLDEN, mixed, slabs, stored, utf8, words
from logquarry.llm.learn import held_out, label_sample, one_label, one_row
from logquarry.llm.neardup import shingles

SAMPLE_PER_LABEL = 12_000  # labelled rows of each label that the model learns from, at most
BEGINNINGS = (4, 5, 6)  # letters of a word's beginning that may become an entry
LEAST_DOCS, LEAST_WEIGHT = 3, 2.5
MOST_ENTRIES = 5_000  # of the lexicon, and of the exception phrases: both are sent to every task
MINIMA, COPIED = 8, 4  # a text is a copy when this many of its minima are an earlier text's
THRESHOLD = 0.7
BLOCK_CHARS = 1 << 20  # a longer text is matched block by block
LONGEST_PHRASE = 64
_BLANK = re.compile(r"\s")

# Letters that look like a Latin one, and digits and signs used in place of a letter.
LOOK_ALIKES = {
    "а": "a", "в": "b", "е": "e", "ё": "e", "з": "e", "і": "i", "ї": "i", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p",
    "с": "c", "т": "t", "у": "y", "х": "x", "ѕ": "s", "ј": "j", "ԁ": "d", "ӏ": "l", "ո": "n", "ս": "u",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ω": "w",
    "ı": "i", "ɑ": "a", "ɡ": "g", "ⅼ": "l", "ℓ": "l",
}
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s"}
INVISIBLE = "­​‌‍⁠﻿"


class _Fold(dict):
    """Characters seen so far and what they fold to; ``str.translate`` asks for each other one once."""

    def __missing__(self, code: int) -> str:
        char = chr(code)
        if 0xFF01 <= code <= 0xFF5E:
            char = chr(code - 0xFEE0).lower()
        char = SUBSTITUTES.get(char) or LOOK_ALIKES.get(char) or ("" if char in INVISIBLE else char if char.isalpha() else " ")
        self[code] = char
        return char


_FOLD = _Fold()


def fold(text: str | None) -> str:
    """Words of folded letters, a blank before and after each run of other characters."""
    return f" {(text or '').lower().translate(_FOLD)} "


class Model(NamedTuple):
    """``lexicon``: weight by entry, which starts with a blank and, as a whole word, ends with one.

    ``learned_from``: toxic and clean rows that the lexicon was counted on, copies left out.
    """

    lexicon: dict[str, float]
    exceptions: tuple[str, ...]
    curve: tuple[float, float, float]
    learned_from: tuple[int, int] = (0, 0)


def _entries(text: str) -> set[str]:
    found = set()
    for word in set(fold(text).split()):
        found.add(f" {word} ")
        found.update(f" {word[:n]}" for n in BEGINNINGS if len(word) >= n)
    return found


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, label) of a bounded sample to (entry, toxic, clean): documents with the entry."""
    counts = (Counter(), Counter())
    for batch in batches:
        for text, label in zip(batch.column(0), batch.column(1).to_pylist()):
            counts[label].update(_entries(text.as_py()))
    clean, toxic = counts
    entries = sorted(toxic.keys() | clean.keys())
    for i in range(0, len(entries), 50_000):
        part = entries[i : i + 50_000]
        yield pa.RecordBatch.from_arrays(
            [pa.array(part, pa.string()), pa.array([toxic[e] for e in part], pa.int64()), pa.array([clean[e] for e in part], pa.int64())],
            names=["entry", "toxic", "clean"],
        )


def _word_blocks(text: str, size: int) -> Iterator[list[str]]:
    """The folded words of a text, of a long one in blocks: it is cut after white space, where no word lies across."""
    at, held = 0, []
    while at < len(text):
        cut = _BLANK.search(text, at + size) if len(text) - at > size else None
        end = cut.end() if cut else len(text)
        held += fold(text[at:end]).split()
        at = end
        if len(held) >= LONGEST_PHRASE:
            yield held
            held = []
    if held:
        yield held


class Matcher:
    """The automaton over entries and exception phrases."""

    def __init__(self, lexicon: dict[str, float], exceptions: tuple[str, ...]):
        self.automaton, self.reach = ahocorasick.Automaton(), 0
        for entry, weight in lexicon.items():
            self.automaton.add_word(entry, (len(entry), (weight, entry)))
        for phrase in exceptions:
            words_of = fold(phrase).split()
            if not 0 < len(words_of) <= LONGEST_PHRASE:
                raise ValueError(f"an exception phrase needs 1 to {LONGEST_PHRASE} words: {phrase!r}")
            key = f" {' '.join(words_of)} "
            self.automaton.add_word(key, (len(key), None))
            self.reach = max(self.reach, len(words_of) - 1)
        self.empty = not len(self.automaton)
        self.automaton.make_automaton()

    def weigh(self, text: str | None, size: int = BLOCK_CHARS) -> tuple[float, int]:
        """The sum of matched weights and the number of words. A long text is matched block by block."""
        times: Counter = Counter()
        count, before = 0, []
        blocks = _word_blocks(text or "", size)
        block = next(blocks, None)
        while block:
            after = next(blocks, None)
            count += len(block)
            times.update(self._found(before, block, after or []))
            before = (before + block)[-self.reach :] if self.reach else []
            block = after
        return math.fsum(weight * (1 + math.log(n)) for (weight, _), n in times.items()), count

    def _found(self, before: list[str], block: list[str], after: list[str]) -> list[tuple[float, str]]:
        """The heaviest entry of each matched word of a block; its neighbours matter for exception phrases only."""
        if self.empty:
            return []
        head = " ".join(["", *before]) if before else ""
        own = f" {' '.join(block)}"
        tail = " ".join(["", *after[: self.reach], ""])
        heaviest, excused = {}, []
        for end, (size, weight) in self.automaton.iter(head + own + (tail or " ")):
            start = end - size + 1
            if weight is None:
                excused.append((start, end))
            elif len(head) <= start < len(head) + len(own) and weight > heaviest.get(start, (0.0, "")):
                heaviest[start] = weight
        if excused:
            heaviest = {s: w for s, w in heaviest.items() if not any(a <= s < b for a, b in excused)}
        return list(heaviest.values())


def _weighed(batches: Iterator[pa.RecordBatch], lexicon, exceptions) -> Iterator[pa.RecordBatch]:
    """(text, rest...) to (rest..., weight, words)."""
    matcher = Matcher(lexicon, exceptions)
    for batch in batches:
        found = [matcher.weigh(text.as_py()) for text in batch.column(0)]
        rest = [batch.column(i) for i in range(1, batch.num_columns)]
        names = batch.schema.names[1:]
        yield pa.RecordBatch.from_arrays(
            [*rest, pa.array([w for w, _ in found], pa.float64()), pa.array([n for _, n in found], pa.int64())],
            names=[*names, "sum", "words"],
        )


def _inputs(total: np.ndarray, words: np.ndarray) -> np.ndarray:
    return np.stack([np.ones(len(total)), np.log1p(total), np.log1p(100 * total / np.maximum(words, 1))], axis=1)


def fit_curve(
    total: np.ndarray, words: np.ndarray, label: np.ndarray, weight: np.ndarray, penalty: float = 0.05
) -> tuple[float, float, float]:
    """Logistic regression by Newton's method with a small penalty, so that perfectly split rows stay finite."""
    x, beta = _inputs(total, words), np.zeros(3)
    scale = weight / weight.sum() if len(weight) else weight
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -35, 35)))
        gradient = x.T @ (scale * (label - p)) - penalty * 1e-2 * beta
        hessian = (x * (scale * p * (1 - p))[:, None]).T @ x + penalty * 1e-2 * np.eye(3)
        step = np.linalg.solve(hessian, gradient)
        beta = beta + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return tuple(float(b) for b in beta)


def prune(lexicon: dict[str, float]) -> dict[str, float]:
    """Without entries that a shorter entry always finds too, with hardly less weight."""
    kept: dict[str, float] = {}
    for entry in sorted(lexicon, key=len):
        shorter = max((kept.get(entry[:n], 0.0) for n in range(1, len(entry))), default=0.0)
        if lexicon[entry] > shorter + 0.25:
            kept[entry] = lexicon[entry]
    return kept


def _minima(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text, label) to (doc_id, label, i, key): the smallest of ``MINIMA`` hashes of each three consecutive words."""
    for batch in batches:
        data, bounds = utf8(batch.column(1))
        for first, last in slabs(bounds):
            hashes, offsets = words(data, bounds[first : last + 1])
            values, _, parts = shingles(hashes, offsets, 3)
            some = np.flatnonzero(np.diff(parts))
            take = pa.array(np.repeat(some + first, MINIMA))
            keys = np.zeros((len(some), MINIMA), np.uint64)
            for i in range(MINIMA):
                if len(some):
                    keys[:, i] = np.minimum.reduceat(mixed(values + np.uint64((i + 1) * int(_GOLDEN) % 2**64)), parts[:-1][some])
            place = pa.array(np.tile(np.arange(MINIMA, dtype=np.int32), len(some)))
            columns = [batch.column(0).take(take), batch.column(2).take(take), place, pa.array(keys.reshape(-1).view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "label", "i", "key"])


def without_copies(rows: DataFrame) -> DataFrame:
    """(text, label) of a bounded sample (doc_id, text, label), ids distinct, without copies of earlier texts of a label.

    A text is a copy when ``COPIED`` of its ``MINIMA`` minima over three consecutive words are also those of
    texts with smaller ids. Texts that share a stock line only, and texts without words, all stay.
    """
    kind = rows.schema["doc_id"].dataType.simpleString()
    minima = rows.mapInArrow(_minima, f"doc_id {kind}, label int, i int, key bigint")
    first = F.min("doc_id").over(Window.partitionBy("label", "i", "key"))
    held = minima.withColumn("before", (first < F.col("doc_id")).cast("int")).groupBy("doc_id").agg(F.sum("before").alias("before"))
    copies = held.where(F.col("before") >= COPIED).select("doc_id")
    return stored(rows.join(copies, "doc_id", "left_anti").select("text", "label"))


def _has_entry(word: str, lexicon: dict[str, float]) -> bool:
    return f" {word} " in lexicon or any(f" {word[:n]}" in lexicon for n in BEGINNINGS if len(word) >= n)


def _pairs(batches: Iterator[pa.RecordBatch], lexicon: dict[str, float]) -> Iterator[pa.RecordBatch]:
    """(text, label) of a bounded sample to (entry, toxic, clean): documents with each pair of words that holds an entry."""
    counts = (Counter(), Counter())
    for batch in batches:
        for text, label in zip(batch.column(0), batch.column(1).to_pylist()):
            found = fold(text.as_py()).split()
            held = [_has_entry(w, lexicon) for w in found]
            counts[label].update({f"{a} {b}" for a, b, x, y in zip(found, found[1:], held, held[1:]) if x or y})
    clean, toxic = counts
    pairs = sorted(clean.keys() | toxic.keys())
    yield pa.RecordBatch.from_arrays(
        [pa.array(pairs, pa.string()), pa.array([toxic[p] for p in pairs], pa.int64()), pa.array([clean[p] for p in pairs], pa.int64())],
        names=["entry", "toxic", "clean"],
    )


def learn_exceptions(rows: DataFrame, lexicon: dict[str, float], toxic: int, clean: int, most: int = MOST_ENTRIES) -> tuple[str, ...]:
    """Pairs of words with an entry that are found at least ``e^LEAST_WEIGHT`` times as often in clean as in toxic ``rows``.

    ``rows`` are a bounded sample (text, label); at least ``LEAST_DOCS`` clean ones must hold a pair, and at
    most ``most`` pairs are kept, those in most clean rows.
    """
    counted = rows.mapInArrow(lambda batches: _pairs(batches, lexicon), "entry string, toxic bigint, clean bigint")
    counted = counted.groupBy("entry").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).where(F.col("clean") >= LEAST_DOCS)
    weight = F.log((F.col("clean") + 0.5) / (clean + 1.0)) - F.log((F.col("toxic") + 0.5) / (toxic + 1.0))
    top = counted.where(weight >= LEAST_WEIGHT).orderBy(F.desc("clean"), "entry").limit(most)
    return tuple(sorted(r["entry"] for r in top.collect()))


def learn(
    docs: DataFrame,
    labels: DataFrame,
    parts: int = 3,
    part: int = 1,
    per_label: int = SAMPLE_PER_LABEL,
    exceptions: tuple[str, ...] = (),
    most_entries: int = MOST_ENTRIES,
) -> Model:
    """Lexicon, exceptions and curve from labelled ``docs`` (doc_id, text) that are not held out.

    At most about ``per_label`` rows of either label are used, chosen by a hash of their ids, one for each
    id: three quarters for the lexicon and the exceptions, one for the curve. The lexicon keeps the
    ``most_entries`` entries of most evidence; ``exceptions`` are added to the learned ones. Only the entries'
    counts and, for the curve, two numbers a row reach the driver. Without labelled rows the lexicon is empty
    and every score is 0.
    """
    known = one_label(labels, "toxic").where("label IN (0, 1)")
    sample = label_sample(known.where(~held_out(F.col("doc_id"), parts, part)), per_label)
    # the sample is bounded, so its ids may be sent to every task
    found = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(sample), "doc_id")
    rows = stored(one_row(found.withColumn("label", F.col("label").cast("int")).withColumn("weight", F.col("weight").cast("double"))))
    for_curve = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(4)) == 0
    distinct = without_copies(rows.where(~for_curve).select("doc_id", "text", "label"))
    counted = distinct.mapInArrow(_count, "entry string, toxic bigint, clean bigint")
    n = {r["label"]: r["n"] for r in distinct.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = n.get(1, 0), n.get(0, 0)
    evidence = 4.0 + 2.5 * math.log(1 + toxic)  # more documents bring more chance entries to rule out
    weight = F.log((F.col("toxic") + 0.5) / (toxic + 1.0)) - F.log((F.col("clean") + 0.5) / (clean + 1.0))
    top = (
        counted.groupBy("entry")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .withColumn("weight", weight)
        .where((F.col("toxic") >= LEAST_DOCS) & (F.col("weight") >= LEAST_WEIGHT) & (F.col("toxic") * F.col("weight") >= evidence))
        .orderBy(F.desc(F.col("toxic") * F.col("weight")), "entry")
        .limit(most_entries)
        .collect()
    )
    lexicon = prune({r["entry"]: r["weight"] for r in top})
    exceptions = (*exceptions, *learn_exceptions(distinct, lexicon, toxic, clean, most_entries))
    got = (
        rows.where(for_curve)
        .select("text", "label", "weight")
        .mapInArrow(lambda batches: _weighed(batches, lexicon, exceptions), "label int, weight double, sum double, words bigint")
        .toArrow()
    )
    if not got.num_rows:
        return Model(lexicon, exceptions, (-36.0, 0.0, 0.0) if not lexicon else (-3.0, 2.0, 2.0), (toxic, clean))
    total, size, label, rate = (got[c].to_numpy() for c in ("sum", "words", "label", "weight"))
    return Model(lexicon, exceptions, fit_curve(total, size, label, rate), (toxic, clean))


def scorer(model: Model):
    """A column function from a text to its score, for filters that keep the other columns where they are."""
    built = []

    def scored(texts: pa.Array) -> pa.Array:
        if not built:
            built.append(Matcher(model.lexicon, model.exceptions))
        found = np.array([built[0].weigh(t.as_py()) for t in texts], float).reshape(-1, 2)
        z = _inputs(found[:, 0], found[:, 1]) @ np.array(model.curve)
        return pa.array(1 / (1 + np.exp(-np.clip(z, -35, 35))))

    return F.arrow_udf(scored, "double")


def score(docs: DataFrame, model: Model, parts: int = 3, part: int = 1, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted, and what was matched (sum, words).

    A null, empty or wordless text matches nothing and gets the lowest score. Repeated rows get equal
    scores, a null id is not held out, and columns other than doc_id and text are ignored.
    """
    source = docs.select(F.col("text").cast("string").alias("text"), "doc_id")
    kind = source.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def weighed(batches):
        return _weighed(batches, shared.value.lexicon, shared.value.exceptions)

    rows = source.mapInArrow(weighed, f"doc_id {kind}, sum double, words bigint")
    base, by_sum, by_share = model.curve
    z = base + by_sum * F.log1p("sum") + by_share * F.log1p(100 * F.col("sum") / F.greatest("words", F.lit(1)))
    value = 1 / (1 + F.exp(-F.greatest(F.least(z, F.lit(35.0)), F.lit(-35.0))))
    return rows.withColumn("score", value).select(
        "doc_id",
        held_out(F.col("doc_id"), parts, part).alias("held_out"),
        "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"),
        "sum",
        "words",
    )


def op7_toxicity(spark, sf_dir) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return score(docs, learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))

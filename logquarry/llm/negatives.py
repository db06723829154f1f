"""Hard negatives from lists that anchor clusters share (operator 12, MAXIMUS-style).

Anchors are clustered by direction. For a cluster, the candidates of a block are sorted once by an upper bound
of their inner products with any of its members: length times the cosine of the angle to the centroid, less
the widest angle between the centroid and a member. Every member walks that list from the top and stops where
the bound certifies that no later candidate can matter: first for its best candidates of the same label,
then, these known, for the best of other labels inside each positive's window of scores.

A block holds a bounded number of candidates and is kept once, in one task; anchors are streamed past it,
cluster by cluster, and the blocks' results are merged. Candidates of equal label and vector are one entry
with their smallest ids, as no later ones can be returned; they are found before the shuffle, so a vector that
a third of all rows hold is no burden. Scores are exact integers.
"""

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logquarry.functions.numbering import place
from logquarry.llm.common import stored

ANCHOR_EVERY, RELABEL_EVERY, LABELS = 100, 7, 10
POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90  # percent of the positive's score, for a negative
SCALE = 256
BLOCK = 1 << 16  # candidates in a block
STEP = 1 << 11  # candidates that are scored at once
MEMBERS = 1 << 10  # anchors that walk at once
PER_CLUSTER, CLUSTERS = 64, 256  # anchors a cluster, and clusters at most
SAMPLE = 8_192  # anchors that the centroids are fitted on, about
ROUNDS = 5


def usable(vectors: DataFrame, id_column: str, vector_column: str, label_column: str) -> DataFrame:
    """(id, label, v): distinct rows without nulls or non-finite components, each component as floor(256 x) in 32 bits."""
    source = vectors.select(
        F.col(f"`{id_column}`").cast("bigint").alias("id"),
        F.col(f"`{label_column}`").cast("bigint").alias("label"),
        F.col(f"`{vector_column}`").cast("array<double>").alias("v"),
    ).where("id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL")

    def scaled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            bounds = np.frombuffer(lists.offsets.buffers()[1], np.int32)[lists.offsets.offset : lists.offsets.offset + len(lists) + 1]
            flat = lists.values.to_numpy(zero_copy_only=False)[bounds[0] : bounds[-1]] if len(lists) else np.zeros(0)
            bounds = bounds - bounds[0] if len(lists) else bounds
            bad = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
            good = np.flatnonzero(bad[bounds[1:]] == bad[bounds[:-1]])
            with np.errstate(invalid="ignore", over="ignore"):
                whole = np.floor(np.where(np.isfinite(flat), flat, 0.0) * SCALE)
            if (np.abs(whole) >= 2**31).any():
                raise ValueError(f"a component beyond 2^31 / {SCALE} cannot be scored in 64 bits")
            packed = whole.astype(np.int32)
            out = pa.array([packed[bounds[i] : bounds[i + 1]].tobytes() for i in good], pa.binary())
            take = pa.array(good)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), out], names=["id", "label", "v"])

    return source.mapInArrow(scaled, "id bigint, label bigint, v binary").distinct()


def centroids(vectors: np.ndarray, clusters: int, rounds: int = ROUNDS) -> np.ndarray:
    """Unit vectors of spherical k-means, started from the rows farthest from each other; deterministic."""
    size = np.linalg.norm(vectors, axis=1, keepdims=True)
    unit = np.divide(vectors, size, out=np.zeros_like(vectors, dtype=float), where=size > 0)
    chosen, nearest = [0], unit @ unit[0]
    while len(chosen) < min(clusters, len(unit)):
        chosen.append(int(np.argmin(nearest)))
        nearest = np.maximum(nearest, unit @ unit[chosen[-1]])
    centre = unit[chosen]
    for _ in range(rounds):
        own = np.argmax(unit @ centre.T, axis=1)
        sums = np.zeros_like(centre)
        np.add.at(sums, own, unit)
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        centre = np.where(size > 0, sums / np.where(size > 0, size, 1), centre)
    return centre


def clustered(anchors: DataFrame, count: int) -> DataFrame:
    """``anchors`` (a, id, label, v) with ``cluster``: the nearest of the centroids, which a bounded sample gives."""
    share = min(1.0, SAMPLE / max(1, count))
    sample = anchors.where(F.pmod(F.xxhash64("a"), F.lit(1 << 20)) < share * (1 << 20)).orderBy("a").select("v").toArrow().column(0).to_pylist()
    widths = [len(v) for v in sample]
    width = max(set(widths), key=widths.count) if widths else 0  # vectors of other lengths are cluster 0
    same = [np.frombuffer(v, np.int32).astype(float) for v in sample if len(v) == width]
    clusters = min(CLUSTERS, -(-count // PER_CLUSTER))
    centre = centroids(np.array(same), clusters) if same and width else np.zeros((1, 0))

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.zeros(batch.num_rows, np.int32)
            values = batch.column(3).to_pylist()
            at = [i for i, v in enumerate(values) if len(v) == width]
            if at and width:
                out[at] = np.argmax(np.frombuffer(b"".join(values[i] for i in at), np.int32).reshape(len(at), -1) @ centre.T, axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)], names=["a", "id", "label", "v", "cluster"])

    return anchors.mapInArrow(nearest, "a bigint, id bigint, label bigint, v binary, cluster int")


class Best:
    """The k best (score, id) of each key so far: higher scores first, ties by smaller id."""

    def __init__(self, keys: int, k: int):
        self.k, self.keys = k, np.zeros(0, np.int64)
        self.scores, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.last = np.full(keys, np.iinfo(np.int64).min)  # the k-th score, once there are k

    def add(self, keys: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        keys, scores, ids = (np.concatenate(p) for p in ((self.keys, keys), (self.scores, scores), (self.ids, ids)))
        order = np.lexsort((ids, -scores, keys))
        keys = keys[order]
        first = np.searchsorted(keys, keys)
        rank = np.arange(len(keys)) - first
        keep = rank < self.k
        self.keys, self.scores, self.ids = keys[keep], scores[order][keep], ids[order][keep]
        full = rank[keep] == self.k - 1
        self.last[self.keys[full]] = self.scores[full]


class Entries(NamedTuple):
    """Candidates of one block and vector length; entry i has the ids ids[bounds[i]:bounds[i + 1]]."""

    vectors: np.ndarray
    labels: np.ndarray
    ids: np.ndarray
    bounds: np.ndarray
    lengths: np.ndarray


class Members(NamedTuple):
    """Anchors of one cluster and vector length, with the scores of their positives, if known, in rows of equal width."""

    number: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    positives: np.ndarray
    has: np.ndarray


def _products(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Exact inner products: in floating point while every sum is below 2^53."""
    most = float(np.abs(one).max(initial=0)) * float(np.abs(other).max(initial=0)) * one.shape[1]
    if most < 2**53:
        return (one.astype(np.float64) @ other.astype(np.float64).T).astype(np.int64)
    if most < 2**62:
        return one.astype(np.int64) @ other.astype(np.int64).T
    return np.array((one.astype(object) @ other.astype(object).T).tolist(), dtype=np.int64).reshape(len(one), len(other))


def shared_list(members: np.ndarray, entries: Entries) -> tuple[np.ndarray, np.ndarray]:
    """(order, bound): candidates by falling upper bound of their inner product with any member of length one."""
    size = np.linalg.norm(members.astype(float), axis=1)
    unit = members[size > 0] / size[size > 0][:, None]
    centre = unit.sum(axis=0)
    length = np.linalg.norm(centre)
    if not len(unit) or length == 0:
        bound = entries.lengths.copy()
    else:
        centre = centre / length
        widest = np.arccos(np.clip(unit @ centre, -1, 1)).max()
        cosine = np.divide(entries.vectors @ centre, entries.lengths, out=np.ones(len(entries.lengths)), where=entries.lengths > 0)
        away = np.arccos(np.clip(cosine, -1, 1)) - widest
        bound = entries.lengths * np.cos(np.maximum(away, 0))
    bound = bound + 1e-6 * entries.lengths  # more than rounding can take away
    order = np.argsort(-bound, kind="stable")
    return order, bound[order]


def walk(members: Members, entries: Entries, low: int, high: int, k: int, step: int = STEP) -> tuple[Best, int]:
    """The k best of this block for each member and slot, and how many scores were computed.

    Without positives there is one slot, for candidates of the member's label but itself. With them there is
    one for each, key ``member * slots + slot``, for candidates of other labels with scores in its window.
    """
    slots = max(1, members.positives.shape[1])
    negative = members.positives.shape[1] > 0
    best, scored = Best(len(members.ids) * slots, k), 0
    lengths = np.linalg.norm(members.vectors.astype(float), axis=1)
    order, bound = shared_list(members.vectors, entries)
    least = np.full((len(members.ids), slots), -np.inf)
    if negative:  # no score below this can matter, and none at all where the window is empty
        least = np.where(members.has & (members.positives >= 0), members.positives * (low / 100) - 1, np.inf)
    for lo in range(0, len(order), step):
        reach = lengths * bound[lo] + 1  # no score from here on is higher
        needed = np.maximum(least, best.last.reshape(-1, slots))
        active = np.flatnonzero((needed <= reach[:, None]).any(axis=1))
        if not len(active):
            break
        some = order[lo : lo + step]
        scores = _products(members.vectors[active], entries.vectors[some])
        scored += scores.size
        same = members.labels[active][:, None] == entries.labels[some][None, :]
        for slot in range(slots):
            keep = scores >= best.last.reshape(-1, slots)[active, slot][:, None]
            if negative:
                p = members.positives[active, slot][:, None]
                keep &= ~same & members.has[active, slot][:, None] & (100 * scores >= low * p) & (100 * scores <= high * p)
            else:
                keep &= same
            x, y = np.nonzero(keep)
            many = np.diff(entries.bounds)[some[y]]
            inner = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            ids = entries.ids[np.repeat(entries.bounds[some[y]], many) + inner]
            who, score = np.repeat(active[x], many), np.repeat(scores[x, y], many)
            if not negative:
                other = ids != members.ids[who]
                who, score, ids = who[other], score[other], ids[other]
            if len(who):
                best.add(who * slots + slot, score, ids)
    return best, scored


def _by_width(values: list[bytes]) -> dict[int, list[int]]:
    out: dict[int, list[int]] = {}
    for i, v in enumerate(values):
        out.setdefault(len(v) // 4, []).append(i)
    return out


def _matrix(values: list[bytes], at: list[int], width: int) -> np.ndarray:
    return np.frombuffer(b"".join(values[i] for i in at), np.int32).reshape(len(at), width)


def _entries(rows: list[dict]) -> dict[int, Entries]:
    out = {}
    values = [r["v"] for r in rows]
    for width, at in _by_width(values).items():
        vectors = _matrix(values, at, width)
        bounds = np.cumsum([0] + [len(rows[i]["ids"]) for i in at])
        ids = np.array([x for i in at for x in rows[i]["ids"]], np.int64)
        labels = np.array([rows[i]["label"] for i in at], np.int64)
        out[width] = Entries(vectors, labels, ids, bounds, np.linalg.norm(vectors.astype(float), axis=1))
    return out


def _members(rows: list[dict], slots: int) -> Iterator[Members]:
    values = [r["v"] for r in rows]
    for width, at in _by_width(values).items():
        known = np.zeros((len(at), slots), np.int64)
        has = np.zeros((len(at), slots), bool)
        for i, row in enumerate(at):
            own = (rows[row]["ids"] or []) if slots else []
            known[i, : len(own)], has[i, : len(own)] = own, True
        of = lambda name: np.array([rows[i][name] for i in at], np.int64)  # noqa: E731, B023
        yield Members(of("a"), of("id"), of("label"), _matrix(values, at, width), known, has)


def _walks(batches: Iterator[pa.RecordBatch], slots: int, low: int, high: int, k: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by block, candidates before anchors, anchors by cluster, to (a, slot, id, score): each block's best."""
    block, waiting, entries = None, [], {}
    fresh: list[dict] = []

    def results() -> Iterator[pa.RecordBatch]:
        for members in _members(waiting, slots):
            if len(members.ids) and members.vectors.shape[1] in entries:
                best, _ = walk(members, entries[members.vectors.shape[1]], low, high, k)
                per = max(1, slots)
                columns = [members.number[best.keys // per], (best.keys % per).astype(np.int32), best.ids, best.scores]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["a", "slot", "id", "score"])
        waiting.clear()

    for batch in batches:
        for row in batch.to_pylist():
            if row["block"] != block:
                yield from results()
                block, fresh, entries = row["block"], [], {}
            if not row["anchor"]:
                fresh.append(row)
                continue
            if fresh:
                entries, fresh = _entries(fresh), []
            if waiting and (len(waiting) >= MEMBERS or row["cluster"] != waiting[0]["cluster"]):
                yield from results()
            waiting.append(row)
    yield from results()


def _meet(entries: DataFrame, anchors: DataFrame, blocks: int, slots: int, low: int, high: int, k: int) -> DataFrame:
    """(a, slot, id, score): the k best for each anchor and slot over all blocks of entries."""
    block = F.pmod(F.xxhash64("label", "v"), F.lit(blocks)).cast("int").alias("block")
    none = F.lit(None).cast("bigint")
    held = entries.select(block, F.lit(False).alias("anchor"), F.lit(-1).alias("cluster"), none.alias("a"), none.alias("id"), "label", "v", "ids")
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    sent = anchors.select(every, F.lit(True).alias("anchor"), "cluster", "a", "id", "label", "v", F.col("known").alias("ids"))
    rows = held.unionByName(sent).repartition(blocks, "block").sortWithinPartitions("block", "anchor", "cluster")
    found = rows.mapInArrow(lambda batches: _walks(batches, slots, low, high, k), "a bigint, slot int, id bigint, score bigint")
    order = Window.partitionBy("a", "slot").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(
    rows: DataFrame,
    anchors: DataFrame,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    block: int = BLOCK,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows`` and ``anchors`` are (id, label, v) as ``usable`` gives them. An anchor's positives are its best
    ``positives`` rows of its label and another id, by inner product, ties by smaller id. For each, the best
    ``negatives`` rows of other labels are ranked whose score is ``low`` to ``high`` percent of the positive's.
    An anchor without positives, and a positive without negatives (always one with a score below zero), have
    no row. Vectors meet vectors of their own length only. Anchors of equal id and different label or vector
    are anchors each.
    """
    smallest = F.row_number().over(Window.partitionBy("label", "v").orderBy("id")) <= max(positives + 1, negatives)
    groups = rows.withColumn("first", smallest).where("first").groupBy("label", "v")
    entries = stored(groups.agg(F.sort_array(F.collect_list("id")).alias("ids")))
    asked = stored(anchors.select(place().alias("a"), "id", "label", "v"))
    number = entries.count()
    cores = rows.sparkSession.sparkContext.defaultParallelism
    blocks = max(1, -(-number // block), min(2 * cores, -(-number // STEP)))
    known = stored(clustered(asked, asked.count()).withColumn("known", F.lit(None).cast("array<bigint>")))
    near = stored(_meet(entries, known, blocks, 0, low, high, positives).select("a", "rank", "id", "score"))
    lists = near.groupBy("a").agg(F.sort_array(F.collect_list(F.struct("rank", "score"))).alias("found"))
    aware = stored(known.drop("known").join(lists.select("a", F.col("found.score").alias("known")), "a"))
    far = _meet(entries, aware, blocks, positives, low, high, negatives)
    chosen = near.select("a", (F.col("rank") - 1).alias("slot"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    named = far.select("a", "slot", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score")).join(chosen, ["a", "slot"])
    return named.join(known.select("a", F.col("id").alias("anchor_id")), "a").select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"
    )


def mined(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label") -> DataFrame:
    """Hard negatives of every hundredth row, labels of every seventh moved on by one.

    Rows with a null id, label or vector or a null or non-finite component take no part; rows equal in id,
    label and vector count once. A component of 2^23 or more is an error. Other columns are ignored; no
    rows, no result.
    """
    label = F.col(f"`{label_column}`").cast("bigint")
    moved = F.when(F.col(f"`{id_column}`") % RELABEL_EVERY == 0, (label + 1) % LABELS).otherwise(label)
    plain = vectors.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{vector_column}`").alias("v"), moved.alias("label"))
    rows = stored(usable(plain, "id", "v", "label"))
    return hard_negatives(rows, rows.where(F.col("id") % ANCHOR_EVERY == 0))


def op12_hard_negatives(spark, sf_dir) -> DataFrame:
    return mined(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


OP12_SQL = """
WITH v AS (SELECT DISTINCT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
       list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
       WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
       AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
 s AS (SELECT a.vec_id AS anchor_id, a.label AS own, a.v AS av, b.vec_id AS id, b.label AS label,
       CAST(coalesce(list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * b.v[i])), 0) AS BIGINT) AS score
       FROM v AS a JOIN v AS b ON len(a.v) = len(b.v) WHERE a.vec_id % 100 = 0),
 p AS (SELECT * FROM s WHERE label = own AND id <> anchor_id
       QUALIFY row_number() OVER (PARTITION BY anchor_id, own, av ORDER BY score DESC, id) <= 5),
 n AS (SELECT p.anchor_id, p.id AS positive_id, s.id AS negative_id, p.score AS positive_score, s.score AS negative_score,
       row_number() OVER (PARTITION BY p.anchor_id, p.own, p.av, p.id, p.score ORDER BY s.score DESC, s.id) AS rank
       FROM p JOIN s ON s.anchor_id = p.anchor_id AND s.own = p.own AND s.av = p.av AND s.label <> p.own
       AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""

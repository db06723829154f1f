"""Near-duplicate classes by ProbMinHash, banding and exact verification (operator 3).

A document's weighted set holds its distinct five-word shingles, however often they occur. A shingle weighs
from 1 to 2, by how many of its words differ, so that stammering and filled-up text counts less; the weight
is the shingle's own, equal in every document. The share of equal components of two ProbMinHash signatures
estimates the probability Jaccard of the weighted sets, which is their shared over their joint weight here. At a
Jaccard similarity of J, counted on shingles, it is no less than J / (2 - J): bands and the least number of
equal components follow from that. At 0.8 the signature has 128 components in 32 bands of four; a pair fails to meet
with a chance below 1 in 1,000 in the worst case, where all shared shingles are stammered and all others not,
and of 5 in 100 million where weights are alike. Two texts are linked when the exact Jaccard similarity of their
distinct shingles is at least 0.8; the links' connected components are the classes.

Nothing lists all pairs of a bucket. Texts of equal words are united first. Then every bucket is compared
with one leader, the member that meets most others in all its buckets, such as the source of many edited
copies. Only members that are not linked to their leader's component are compared with the rest, in blocks
of bounded size inside tasks, which send on at most one link for each two components. So no link between
members of a bucket is lost, and a group of copies, however large, costs one comparison a copy.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logquarry.llm.common import _GOLDEN, bitmap, filter_bits, grams, maybe_in, mixed, row_keys, slabs, stored, utf8, words
from logquarry.llm.components import components

SHINGLE = 5
THRESHOLD = 0.8
COMPONENTS, MOST_ROWS = 128, 4
MISSED = 1e-3  # chance that a pair at the threshold does not meet, at most
BLOCK = 256


def banding(threshold: float) -> tuple[int, int, int]:
    """(rows of a band, bands, least equal components) for links of ``threshold`` and more.

    As many rows as let a pair of the lowest probability Jaccard meet but for ``MISSED``; fewer than the
    least equal components have a chance below 1e-10. A threshold that no banding can hold is refused.
    """
    low = threshold / (2 - threshold)
    for rows in range(MOST_ROWS, 0, -1):
        if (1 - low**rows) ** (COMPONENTS // rows) <= MISSED:
            least = COMPONENTS * low - 6.5 * (COMPONENTS * low * (1 - low)) ** 0.5
            return rows, COMPONENTS // rows, max(0, int(least))
    raise ValueError(f"a signature of {COMPONENTS} components can't find similarities of {threshold}")


def shingle_weights(hashes: np.ndarray, offsets: np.ndarray, n: int = SHINGLE) -> np.ndarray:
    """The weight of each run of ``n`` words, at its first: 1 if all words are equal to 2 if none are; 1 for shorter rows."""
    size = max(0, len(hashes) - n + 1)
    different = np.ones(size)
    for i in range(1, n):
        new = np.ones(size, bool)
        for j in range(i):
            new &= hashes[i : i + size] != hashes[j : j + size]
        different += new
    return 1 + (different - 1) / (n - 1)


def shingles(hashes: np.ndarray, offsets: np.ndarray, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each row's distinct word shingles in order, how often each occurs, and the row offsets.

    A row of fewer words, but not none, has one shingle: all its words.
    """
    found, size = grams(hashes, n), np.diff(offsets)
    room = np.repeat(offsets[1:], size) - np.arange(len(hashes))
    values, per = found[room[: len(found)] >= n], np.maximum(size - n + 1, 0)
    few = (size > 0) & (size < n)
    if few.any():
        whole = row_keys(hashes, offsets)[0].view(np.uint64)
        values = np.insert(values, np.concatenate([[0], np.cumsum(per)])[:-1][few], whole[few])
        per[few] = 1
    bounds = np.concatenate([[0], np.cumsum(per)])
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        values[a:b].sort()
    first = np.ones(len(values), bool)
    first[1:] = values[1:] != values[:-1]
    first[bounds[:-1][per > 0]] = True
    at = np.flatnonzero(first)
    return values[at], np.diff(at, append=len(values)), np.searchsorted(at, bounds)


def weighted_shingles(hashes: np.ndarray, offsets: np.ndarray, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same with the weight of each shingle instead of its occurrences."""
    found, size = grams(hashes, n), np.diff(offsets)
    room = np.repeat(offsets[1:], size) - np.arange(len(hashes))
    whole = room[: len(found)] >= n
    values, weights, per = found[whole], shingle_weights(hashes, offsets, n)[whole], np.maximum(size - n + 1, 0)
    few = (size > 0) & (size < n)
    if few.any():
        at = np.concatenate([[0], np.cumsum(per)])[:-1][few]
        values = np.insert(values, at, row_keys(hashes, offsets)[0].view(np.uint64)[few])
        weights = np.insert(weights, at, 1.0)
        per[few] = 1
    bounds = np.concatenate([[0], np.cumsum(per)])
    order = np.arange(len(values))
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        order[a:b] = a + np.argsort(values[a:b])
    values, weights = values[order], weights[order]
    first = np.ones(len(values), bool)
    first[1:] = values[1:] != values[:-1]
    first[bounds[:-1][per > 0]] = True
    at = np.flatnonzero(first)
    return values[at], weights[at], np.searchsorted(at, bounds)


def prob_minhash(
    values: np.ndarray, weights: np.ndarray, offsets: np.ndarray, m: int = COMPONENTS, slack: float = 3.0
) -> np.ndarray:
    """ProbMinHash signatures (rows x m) of weighted sets: the share of equal components estimates J_P.

    Every element is a Poisson process of its weight as rate; each arrival falls on a random component, and
    a component keeps the element that arrives first. Arrivals beyond the time by which all components are
    filled can't win, so an element stops there: first at the time that is enough for most rows, then at
    the row's latest first arrival. A row left with an open component is done again with more time.
    """
    sig = np.zeros((len(offsets) - 1, m), np.uint64)
    sums = np.concatenate([[0.0], np.cumsum(weights)])
    todo = np.flatnonzero(np.diff(offsets))
    while len(todo):
        size = np.diff(offsets)[todo]
        limit = m * (np.log(m) + slack) / (sums[offsets[todo + 1]] - sums[offsets[todo]])
        row = np.repeat(np.arange(len(todo)), size)
        pick = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(offsets[todo], size)
        element, rate, time = values[pick], weights[pick], np.zeros(len(row))
        best, won = np.full(len(todo) * m, np.inf), np.zeros(len(todo) * m, np.uint64)
        step = 0
        while len(element):
            step += 1
            draw = mixed(element + np.uint64(step * int(_GOLDEN) % 2**64))
            time = time - np.log1p(-(draw >> np.uint64(11)).astype(np.float64) * 2.0**-53) / rate
            on = time <= limit[row]
            element, rate, time, row, draw = element[on], rate[on], time[on], row[on], draw[on]
            slot = row * m + (mixed(draw + _GOLDEN) % np.uint64(m)).astype(np.int64)
            np.minimum.at(best, slot, time)
            first = best[slot] == time
            won[slot[first]] = element[first]
            if step <= 4 or step % 16 == 0:
                limit = np.minimum(limit, best.reshape(-1, m).max(axis=1))
        sig[todo] = won.reshape(-1, m)
        todo = todo[np.isinf(best.reshape(-1, m)).any(axis=1)]
        slack = 2 * slack + np.log(m)
    return sig


def _sketch(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """(id, text) to (id, k1, k2, n, bands, sig): n distinct shingles, a hash per band of ``rows``, a byte per component."""
    many = COMPONENTS // rows
    for batch in batches:
        data, bounds = utf8(batch.column(1))
        for first, last in slabs(bounds):
            hashes, offsets = words(data, bounds[first : last + 1])
            k1, k2 = row_keys(hashes, offsets)
            values, weights, parts = weighted_shingles(hashes, offsets)
            sig = prob_minhash(values, weights, parts)
            n = np.diff(parts)
            bands = np.arange(1, many + 1, dtype=np.uint64)[None, :] * _GOLDEN
            for r in range(rows):
                bands = mixed(bands ^ sig[:, r : many * rows : rows])
            lists = np.concatenate([[0], np.cumsum(np.where(n > 0, many, 0))])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(first, last - first),
                    pa.array(k1),
                    pa.array(k2),
                    pa.array(n, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(lists, pa.int32()), pa.array(bands[n > 0].reshape(-1).view(np.int64))),
                    pa.array([x.tobytes() for x in sig.astype(np.uint8)], pa.binary()),
                ],
                names=["id", "k1", "k2", "n", "bands", "sig"],
            )


def _agree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, sig_a, sig_b) to (a, b, agree): equal components."""
    for batch in batches:
        one, other = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(-1, COMPONENTS) for i in (2, 3))
        agree = pa.array((one == other).sum(axis=1), pa.int32())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), agree], names=["a", "b", "agree"])


def _jaccard(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    """(a, b, set_a, set_b) to the pairs (a, b) whose distinct shingles are similar enough, counted exactly."""
    for batch in batches:
        keep = np.zeros(batch.num_rows, bool)
        for i, (x, y) in enumerate(zip(batch.column(2), batch.column(3))):
            one, other = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            both = np.sort(np.concatenate([one, other]))
            shared = int((both[1:] == both[:-1]).sum())
            keep[i] = shared >= threshold * (len(both) - shared)
        yield pa.RecordBatch.from_arrays([batch.column(i).filter(pa.array(keep)) for i in (0, 1)], names=["a", "b"])


def _sets(batches: Iterator[pa.RecordBatch], table: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(text) to (k1, k2, shingles) of the texts that ``table`` may hold, once in a task for each."""
    seen = set()
    for batch in batches:
        data, bounds = utf8(batch.column(0))
        for first, last in slabs(bounds):
            hashes, offsets = words(data, bounds[first : last + 1])
            k1, k2 = row_keys(hashes, offsets)
            values, _, parts = shingles(hashes, offsets)
            rows = np.flatnonzero(maybe_in(table, k1.view(np.uint64)) & (np.diff(parts) > 0)).tolist()
            fresh = []
            for i in rows:
                key = (int(k1[i]), int(k2[i]))
                if key not in seen:
                    seen.add(key)
                    fresh.append(i)
            yield pa.RecordBatch.from_arrays(
                [pa.array(k1[fresh]), pa.array(k2[fresh]), pa.array([values[parts[i] : parts[i + 1]].tobytes() for i in fresh], pa.binary())],
                names=["k1", "k2", "shingles"],
            )


def shared_counts(one: list[np.ndarray], other: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """How many values each set of ``one`` shares with each of ``other``, by products of 0/1 matrices."""
    sizes = [len(x) for x in (*one, *other)]
    row = np.repeat(np.arange(len(sizes)), sizes)
    values, column, often = np.unique(np.concatenate([*one, *other]), return_inverse=True, return_counts=True)
    useful = often[column] > 1
    row, column = row[useful], column[useful]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    out = np.zeros((len(one), len(other)), np.float32)
    for lo in range(0, len(values), width):
        a, b = np.searchsorted(column, [lo, lo + width])
        if a < b:
            cells = np.zeros((len(sizes), width), np.float32)
            cells[row[a:b], column[a:b] - lo] = 1
            out += cells[: len(one)] @ cells[len(one) :].T
    return out


def _block_links(rows: list[tuple], threshold: float) -> list[tuple[int, int]]:
    """Links between stragglers and members of other components, at most one for each two components.

    ``rows`` are (straggler?, node, comp, shingles) of one block pair.
    """
    one, other = ([r for r in rows if r[0] == side] for side in (True, False))
    if not one or not other:
        return []
    sets = [[np.frombuffer(r[3].as_buffer(), np.uint64) for r in side] for side in (one, other)]
    shared = shared_counts(*sets)
    total = np.array([len(s) for s in sets[0]])[:, None] + np.array([len(s) for s in sets[1]])[None, :]
    comps = [np.array([r[2] for r in side]) for side in (one, other)]
    x, y = np.nonzero((shared >= threshold * (total - shared) - 1e-6) & (comps[0][:, None] != comps[1][None, :]))
    _, pick = np.unique(np.stack([comps[0][x], comps[1][y]]), axis=1, return_index=True)
    return [(one[x[i]][1], other[y[i]][1]) for i in pick]


def _blocks(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    """(leader, i, j, straggler, node, comp, shingles), sorted by the first three, to links (a, b)."""

    def links(rows):
        found = _block_links(rows, threshold)
        return pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

    key, rows = None, []
    for batch in batches:
        keys = zip(*(batch.column(i).to_pylist() for i in range(3)))
        rest = zip(*(batch.column(i).to_pylist() for i in (3, 4, 5)), batch.column(6))
        for k, row in zip(keys, rest):
            if k != key:
                if rows:
                    yield links(rows)
                key, rows = k, []
            rows.append(row)
    if rows:
        yield links(rows)


def _links(texts: DataFrame, reps: DataFrame, threshold: float, least: int, block: int) -> DataFrame:
    """Links (a, b) between nodes of ``reps`` (k1, k2, n, bands, sig, node) whose components are the classes."""
    entries = reps.select("node", F.explode("bands").alias("bucket"))
    # stored before they are joined, like ``lead`` below: so the join can split a bucket that very many texts share
    counts = stored(entries.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).where("members > 1"))
    met = stored(entries.join(counts, "bucket"))
    degree = met.groupBy("node").agg(F.sum("members").alias("degree"))
    # the member that meets most others leads; equal ones are told apart by a hash
    rank = (F.col("degree") * (1 << 20) + F.pmod(F.xxhash64("node"), F.lit(1 << 20))).alias("rank")
    ranked = stored(met.join(degree, "node").select("bucket", "node", rank))
    lead = stored(ranked.groupBy("bucket").agg(F.max_by("node", "rank").alias("leader")))
    star = stored(ranked.join(lead, "bucket").select("leader", "node").distinct())

    needed = stored(degree.select("node").join(reps.select("node", "k1", "k2", "n", "sig"), "node"))
    table = texts.sparkSession.sparkContext.broadcast(bitmap(needed, "k1", filter_bits(needed.count(), 4)))

    def sets_of(batches):
        return _sets(batches, table.value)

    sets = texts.mapInArrow(sets_of, "k1 bigint, k2 bigint, shingles binary").dropDuplicates(["k1", "k2"])
    sets = stored(sets.join(needed.select("k1", "k2", "node"), ["k1", "k2"]).select("node", "shingles"))

    # every member with its leader
    sizes = needed.select("node", "n", "sig")
    sides = star.where("leader <> node").join(sizes.toDF("leader", "n_a", "sig_a"), "leader").join(sizes.toDF("node", "n_b", "sig_b"), "node")
    sides = sides.where(F.least("n_a", "n_b") >= F.lit(threshold) * F.greatest("n_a", "n_b")).select("leader", "node", "sig_a", "sig_b")
    likely = stored(sides.mapInArrow(_agree, "a bigint, b bigint, agree int").where(F.col("agree") >= least).select("a", "b"))
    both = likely.join(sets.toDF("a", "set_a"), "a").join(sets.toDF("b", "set_b"), "b").select("a", "b", "set_a", "set_b")
    links = stored(both.mapInArrow(lambda batches: _jaccard(batches, threshold), "a bigint, b bigint"))

    # members outside their leader's component with all others of the leader's buckets
    comps = components(links)
    comp_of = star.join(comps, "node", "left").select("leader", "node", F.coalesce("comp", "node").alias("comp"))
    lead_comp = comps.select(F.col("node").alias("leader"), F.col("comp").alias("lead_comp"))
    placed = stored(comp_of.join(lead_comp, "leader", "left").withColumn("out", F.col("comp") != F.coalesce("lead_comp", "leader")))
    groups = placed.groupBy("leader").agg(F.count(F.lit(1)).alias("members"), F.sum(F.col("out").cast("long")).alias("outside"))
    groups = stored(groups.where("outside > 0 AND members > 2"))  # a plain side: the join can split a hot leader
    rows = placed.where("leader <> node").join(groups, "leader")
    of = lambda n: F.ceil(F.col(n) / block).cast("int")
    spot = lambda n: F.pmod(F.xxhash64("node", F.lit(n)), of(n)).cast("int")
    columns = ["leader", "i", "j", "straggler", "node", "comp"]
    every = lambda n: F.explode(F.sequence(F.lit(0), of(n) - 1))
    stragglers = rows.where("out").select("*", spot("outside").alias("i"), every("members").alias("j")).withColumn("straggler", F.lit(True))
    others = rows.select("*", spot("members").alias("j"), every("outside").alias("i")).withColumn("straggler", F.lit(False))
    pairs = stragglers.select(columns).unionByName(others.select(columns)).join(sets, "node").select(*columns, "shingles")
    more = (
        pairs.repartition("leader", "i", "j")
        .sortWithinPartitions("leader", "i", "j")
        .mapInArrow(lambda batches: _blocks(batches, threshold), "a bigint, b bigint")
    )
    return stored(links.union(more))


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    threshold: float = THRESHOLD,
    block: int = BLOCK,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, class_id (the smallest doc_id of its class), class_rows, kept.

    Rows of equal words are always in one class; A-Z equals a-z and all but words is ignored. A null or
    wordless text is a class of its own, with its own id. ``kept`` is true for one row of each class: of the
    smallest id, or without ids an arbitrary one. Null ids are never the smallest; repeated rows share a
    class. Other columns are ignored; no rows, no result.
    """
    source = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").cast("string").alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    rows, _, least = banding(threshold)
    sketched = source.mapInArrow(lambda batches: _sketch(batches, rows), f"id {kind}, k1 bigint, k2 bigint, n bigint, bands array<bigint>, sig binary")
    base = stored(sketched.withColumn("place", F.monotonically_increasing_id()))
    texts = base.where("n > 0").select("k1", "k2", "n", "bands", "sig").distinct()
    reps = stored(texts.withColumn("node", F.monotonically_increasing_id()))
    links = _links(source.select("text"), reps, threshold, least, block)
    comps = components(links)
    group = reps.select("k1", "k2", "node").join(comps, "node", "left").select("k1", "k2", F.coalesce("comp", "node").alias("comp"))
    # classes that hold more than one row; all other rows stand alone
    rows = stored(base.select("id", "k1", "k2", "n", "place").join(group, ["k1", "k2"], "left"))
    alone = F.when(F.col("n") > 0, F.col("comp"))
    keyed = rows.select("id", "place", alone.alias("comp"))
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "place")).alias("first")
    classes = stored(keyed.where("comp IS NOT NULL").groupBy("comp").agg(first, F.count(F.lit(1)).alias("class_rows")))
    return keyed.join(classes, "comp", "left").select(
        F.col("id").alias("doc_id"),
        F.coalesce("first.id", "id").alias("class_id"),
        F.coalesce("class_rows", F.lit(1).cast("long")).alias("class_rows"),
        F.coalesce(F.col("first.place") == F.col("place"), F.lit(True)).alias("kept"),
    )


def op3_near_duplicates(spark, sf_dir) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))

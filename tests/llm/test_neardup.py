import re

import numpy as np
import pyarrow as pa
import pytest

from logquarry.llm import neardup
from logquarry.llm.common import utf8, words
from logquarry.llm.components import components
from logquarry.llm.neardup import banding, near_duplicates, op3_near_duplicates, prob_minhash, shared_counts, shingles, weighted_shingles

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute(docs):
    """The class of each row by comparing all pairs."""
    sets = [shingle_set(t) for _, t in docs]
    parent = list(range(len(docs)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if sets[i] and sets[j]:
                both = len(sets[i] & sets[j])
                if both >= 0.8 * (len(sets[i]) + len(sets[j]) - both):
                    parent[find(i)] = find(j)
    groups = {}
    for i in range(len(docs)):
        groups.setdefault(find(i), []).append(docs[i][0])
    return sorted(((docs[i][0], min((x for x in groups[find(i)] if x is not None), default=None), len(groups[find(i)])) for i in range(len(docs))), key=str)


def test_signature_estimates_probability_jaccard():
    rng = np.random.default_rng(2)
    values = rng.integers(1, 2**63, 700).astype(np.uint64)
    a, b = np.arange(0, 500), np.arange(150, 700)
    wa, wb = rng.random(500) + 0.5, rng.random(550) + 0.5
    p, q = np.zeros(700), np.zeros(700)
    p[a], q[b] = wa, wb
    common = np.flatnonzero((p > 0) & (q > 0))
    exact = sum(1 / np.maximum(p / p[d], q / q[d]).sum() for d in common)
    sig = prob_minhash(np.concatenate([values[a], values[b]]), np.concatenate([wa, wb]), np.array([0, 500, 1050]), 4096)
    assert abs((sig[0] == sig[1]).mean() - exact) < 0.03
    one = prob_minhash(values[:1], np.array([3.0]), np.array([0, 1, 1]), 64)
    assert (one[0] == values[0]).all() and not one[1].any()


def test_weights_are_the_shingles_own():
    texts = ["a a a a a a", "a b c d e f", "x a a a a a b a a", "a b", "", None, "q a b c d e"]
    hashes, offsets = words(*utf8(pa.array(texts, pa.string())))
    values, weights, parts = weighted_shingles(hashes, offsets)
    plain, _, bounds = shingles(hashes, offsets)
    assert values.tolist() == plain.tolist() and parts.tolist() == bounds.tolist()
    by_value = {}
    for v, w in zip(values.tolist(), weights.tolist()):
        assert by_value.setdefault(v, w) == w
    assert weights[: parts[1]].tolist() == [1.0] and weights[parts[1] : parts[2]].tolist() == [2.0, 2.0]
    assert set(weights.tolist()) == {1.0, 1.25, 2.0}


@pytest.mark.parametrize("threshold", [0.3, 0.5, 0.65, 0.8, 0.95])
def test_banding_follows_the_threshold(make, threshold):
    """Pairs around the threshold, with weights as unlike as they can be: the same classes as all pairs give."""
    rows, bands, least = banding(threshold)
    low = threshold / (2 - threshold)
    assert (1 - low**rows) ** bands <= neardup.MISSED and rows * bands <= neardup.COMPONENTS and least < neardup.COMPONENTS * low
    rng = np.random.default_rng(int(threshold * 100))
    docs = []
    for i in range(60):
        own = [f"s{i}"] * 4  # shingles of one word repeated weigh least
        shared = " ".join(w for k in range(30) for w in [f"c{i}_{k}"] * 5)
        extra = int(30 * 5 * (1 / threshold - 1) / 2 * rng.uniform(0.8, 1.2))
        docs += [(2 * i, f"{shared} {' '.join(own)}"), (2 * i + 1, f"{shared} {' '.join(f'x{i}_{k}' for k in range(extra))}")]
    sets = [shingle_set(t) for _, t in docs]
    want = []
    for i in range(0, len(docs), 2):
        both = len(sets[i] & sets[i + 1])
        linked = both >= threshold * (len(sets[i]) + len(sets[i + 1]) - both)
        want += [(i, i, 1 + linked), (i + 1, i if linked else i + 1, 1 + linked)]
    got = near_duplicates(make(docs, "doc_id long, text string"), threshold=threshold)
    assert sorted(tuple(r)[:3] for r in got.collect()) == sorted(want)


def test_a_threshold_that_bands_cannot_hold_is_refused():
    with pytest.raises(ValueError):
        banding(0.05)


def test_shared_counts():
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 60, 30)).astype(np.uint64) for _ in range(9)]
    want = [[len(np.intersect1d(x, y)) for y in sets[4:]] for x in sets[:4]]
    assert shared_counts(sets[:4], sets[4:], width=7).tolist() == want


def test_components(make):
    links = [(i, i + 1) for i in range(40)] + [(100, 200), (200, 150), (300, 300)] + [(500, 600 + i) for i in range(50)]
    got = {r["node"]: r["comp"] for r in components(make(links, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(41)) and got[150] == got[200] == 100 and got[300] == 300
    assert all(got[600 + i] == 500 for i in range(50))
    assert components(make([], "a long, b long")).count() == 0


def documents(seed=1):
    rng = np.random.default_rng(seed)
    w = np.array([f"w{i}" for i in range(3000)])
    edit = lambda x, n: np.where(rng.random(len(x)) < n / len(x), rng.choice(w, len(x)), x)
    texts = [" ".join(rng.choice(w, int(rng.integers(6, 300)))) for _ in range(60)]
    hub = rng.choice(w, 150)
    texts += [" ".join(edit(hub, k)) for k in rng.integers(0, 9, 120)] + [" ".join(hub)]  # a cloud around its source
    passage = rng.choice(w, 60)
    texts += [" ".join([*passage, *rng.choice(w, 40)]) for _ in range(60)]  # a shared passage, but different texts
    chain = rng.choice(w, 200)
    for _ in range(8):
        chain = edit(chain, 3)
        texts.append(" ".join(chain))
    texts += [texts[3].upper(), texts[3] + " !!", texts[5], texts[5], "a b", "a b", "A. b", "a", "...", "..", "", None, None]
    docs = [(i, t) for i, t in enumerate(texts)]
    return docs + [(7, texts[7]), (7, texts[7]), (None, texts[9]), (None, "nobody else has this"), (None, "nobody else has this")]


def test_classes_equal_brute_force_with_small_and_large_blocks(make):
    docs = documents()
    frame = make([(i, t, 1, "k") for i, t in docs], "doc_id long, text string, node int, comp string").repartition(4)
    for block in (256, 16):
        rows = near_duplicates(frame, block=block).collect()
        assert sorted((tuple(r)[:3] for r in rows), key=str) == brute(docs)
    kept = [r for r in rows if r["kept"]]
    assert all(r["doc_id"] == r["class_id"] for r in kept)
    assert abs(sum(1 / r["class_rows"] for r in rows) - len(kept)) < 1e-6


def test_copies_whose_repeats_differ(make):
    """A passage that one copy repeats hardly changes the set of shingles, so the copies are one class."""
    rng = np.random.default_rng(12)
    docs = []
    for i in range(40):
        text = [f"t{i}x{k}" for k in rng.integers(0, 900, 200)]
        docs += [(2 * i, " ".join(text)), (2 * i + 1, " ".join(text[:100] + text[50:100] * (200 + 20 * i) + text[100:]))]
    want = brute(docs)
    assert all(n == 2 for _, _, n in want)
    rows = near_duplicates(make(docs, "doc_id long, text string").repartition(4)).collect()
    assert sorted((tuple(r)[:3] for r in rows), key=str) == want


def test_empty_table(make):
    assert near_duplicates(make([], "doc_id long, text string")).count() == 0


def test_query_equals_brute_force_on_the_smallest_table(spark):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted((tuple(r)[:3] for r in op3_near_duplicates(spark, sf).collect()), key=str) == brute(docs)

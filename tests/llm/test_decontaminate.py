import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest

from logquarry.llm import common
from logquarry.llm.decontaminate import SPAN, contamination, winnow

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items):
    out = []
    for doc_id, text in docs:
        doc, hit, found = words_of(text), set(), set()
        for item_id, item in items:
            item = words_of(item)
            n = min(SPAN, len(item))
            windows = {tuple(item[i : i + n]) for i in range(len(item) - n + 1)} if n else set()
            for i in range(len(doc) - n + 1):
                if n and tuple(doc[i : i + n]) in windows:
                    hit.update(range(i, i + n))
                    found.add(item_id)
        ids = sorted(str(i) for i in found if i is not None)
        sha = hashlib.sha256(",".join(ids).encode()).hexdigest()
        out.append((doc_id, len(doc), len(hit), len(ids), sha, bool(hit) and 20 * len(hit) >= len(doc)))
    return sorted(out, key=str)


def test_word_hashes_follow_the_pattern(monkeypatch):
    texts = ["Ab c1-é_x", None, "", "..", "ÀB c", "aB" * 40 + " z", "tail"]
    for chunk in (7, 1 << 10):
        monkeypatch.setattr(common, "CHUNK_BYTES", chunk)
        data, bounds = common.utf8(pa.array(texts))
        hashes, offsets = common.words(data, bounds)
        flat = [w for t in texts for w in words_of(t)]
        assert list(np.diff(offsets)) == [len(words_of(t)) for t in texts]
        seen = dict(zip(hashes.tolist(), flat))
        assert [seen[h] for h in hashes.tolist()] == flat and len(seen) == len(set(flat))


def test_winnow_keeps_the_rightmost_smallest_of_each_window():
    rng = np.random.default_rng(1)
    prints = rng.integers(0, 9, 200).astype(np.uint64)
    want = sorted({i + max(j for j in range(9) if prints[i + j] == prints[i : i + 9].min()) for i in range(192)})
    assert winnow(prints, np.ones(200, bool), 9).tolist() == want


@pytest.mark.parametrize("bits", [6, None])
def test_contamination_equals_brute_force(make, bits):
    rng = np.random.default_rng(5)
    w = [f"w{i}" for i in range(40)]
    say = lambda n: " ".join(rng.choice(w, n))
    long, short = [say(30), say(13), say(60)], ["w1 w2 w3", "w7", "w3 w4 w5 w6 w7"]
    items = list(enumerate([*long, *short, "", None, "...", long[0]])) + [(2, say(20)), (None, say(15))]
    docs = [(i, say(int(rng.integers(0, 300)))) for i in range(30)]
    docs += [(100 + i, say(50) + " " + long[i % 3].upper() + "! " + say(20)) for i in range(6)]
    docs += [(7, long[2]), (7, long[2]), (None, None), (None, long[1]), (200, ""), (201, "x " * 5000 + long[0])]
    docs += [(202, " ".join(long[0].split()[:12])), (203, items[-1][1])]
    frame = make([(i, t, "x", 1, None) for i, t in docs], "doc_id long, text string, item_id string, k1 int, prints string")
    got = contamination(frame, make(items, "item_id long, text string"), bits=bits)
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs, items)


def test_empty_tables(make):
    docs, items = make([(1, "a b c")], "doc_id long, text string"), make([], "item_id long, text string")
    assert [tuple(r)[:4] for r in contamination(docs, items).collect()] == [(1, 3, 0, 0)]
    assert contamination(docs.limit(0), docs.withColumnRenamed("doc_id", "item_id")).count() == 0

"""Collocations against a brute-force count of all phrases."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given
from hypothesis import strategies as st

from logquarry.llm import phrases
from logquarry.llm.common import utf8

SCHEMA = "doc_id long, text string, lang string, source string, fp long, n int, words int, phrase string"


def pieces(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", low)]


def plainly(rows, words, least, covered, per_language):
    out = []
    for lang in {r[1] or "und" for r in rows}:
        f, n = Counter(), 0
        for text, own in rows:
            if (own or "und") == lang:
                for piece in pieces(text):
                    n += len(piece)
                    for size in range(1, words + 1):
                        f.update(tuple(piece[i : i + size]) for i in range(len(piece) - size + 1))
        chosen = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        ranked = []
        for p, a in chosen.items():
            score, k = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            inside = any(
                100 * b >= covered * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
                for q, b in chosen.items()
                if len(q) > len(p)
            )
            if not inside:
                ranked.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(ranked)[:per_language], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n, -score))
    return sorted(out)


def mined(spark, rows, words=5, least=3, covered=100, per_language=2000, parts=3):
    df = spark.createDataFrame([(1, t, lang, "s", 1, 1, 1, "x") for t, lang in rows], SCHEMA).repartition(parts)
    result = phrases.collocations(df, words=words, least=least, covered=covered, per_language=per_language)
    assert result.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in result.collect())


ROWS = [
    ("New York is big. new york IS old, New\tYork  is", "en"),
    ("a a a a a a; a a a", "en"),
    ("in New York is snow\nin new york is rain", None),
    ("in new york is\x0bin new york is\x0cin New York is!", None),
    ("straße über straße über straße über ÄÖ äö", "de"),
    (None, "de"),
    ("", "fr"),
    ("  \t .,;", "fr"),
    ("x" * 600_000 + " y " + "x" * 600_000 + " y " + "x" * 600_000 + " y", "long"),
] * 2


@pytest.mark.parametrize("covered", [100, 60])
def test_against_brute_force(spark, covered):
    got = mined(spark, ROWS, covered=covered)
    assert got == plainly(ROWS, 5, 3, covered, 2000) and any(r[0] == "und" for r in got)


def test_given_texts(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["text"], r["lang"]) for r in df.select("text", "lang").collect()]
    got = sorted(tuple(r) for r in phrases.collocations(df, least=20, per_language=150).collect())
    assert got == plainly(rows, 5, 20, 100, 150)


def test_colliding_hashes(spark, monkeypatch):
    """With hashes of 3 bits nearly everything collides; texts tell phrases apart."""
    mixed = phrases.mixed
    weak = lambda x: mixed(x) & np.uint64(7)
    monkeypatch.setattr(phrases, "mixed", weak)
    rows = [r for r in ROWS if r[1] != "long"]
    batch = pa.RecordBatch.from_arrays([pa.array([r[1] or "und" for r in rows]), pa.array([r[0] or "" for r in rows])], names=["lang", "text"])
    tables = [np.full(1, 2**64 - 1, np.uint64)] * 5
    got = Counter()
    for out in phrases._phrases(iter([batch]), tables):
        for r in out.to_pylist():
            got[r["lang"], r["words"], r["phrase"]] += r["n"]
    expected = Counter()
    for text, lang in rows:
        for piece in pieces(text):
            expected[lang or "und", 0, ""] += len(piece)
            for n in range(1, 6):
                expected.update((lang or "und", n, " ".join(piece[i : i + n])) for i in range(len(piece) - n + 1))
    assert +got == +expected


@given(st.lists(st.text(alphabet="aB .,\t\né", max_size=30), max_size=8))
def test_spans(texts):
    data, offsets = utf8(pa.array(texts, pa.string()))
    starts, ends, row, room = phrases.spans(data, offsets)
    got = [[] for _ in texts]
    at = 0
    while at < len(starts):
        piece = [phrases.LOWER[data[starts[i] : ends[i]]].tobytes().decode() for i in range(at, at + int(room[at]))]
        got[row[at]].append(piece)
        at += int(room[at])
    assert got == [[p for p in pieces(t) if p] for t in texts]


def test_wide_products(spark):
    """Sums and products beyond 64 bits stay exact in the score."""
    score = spark.sql(
        "SELECT (" + phrases._EXACT.format("a", "n") + " * 1000) div (" + phrases._EXACT.format("l", "r") + ") AS s "
        "FROM VALUES (90000000000000L, 99999999999999997L, 90000000000007L, 90000000000011L) AS t(a, n, l, r)"
    ).first()["s"]
    assert score == 1000 * 90000000000000 * 99999999999999997 // (90000000000007 * 90000000000011)


def test_no_rows(spark):
    assert mined(spark, []) == []

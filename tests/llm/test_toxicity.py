import zlib

import numpy as np
import pytest

from logquarry.llm import toxicity
from logquarry.llm.toxicity import Matcher, Model, fit_curve, fold, learn, op7_toxicity, prune, score

LEXICON = {" idio": 3.0, " idiot ": 3.5, " trash ": 2.0, " lost": 1.0}


@pytest.mark.parametrize(
    "text,want",
    [("An IDIOT!", " an idiot  "), ("1d1ot, tr4$h", " idiot  trash "), ("ｉｄｉоt", " idiot "), ("id​iot", " idiot "), (None, "  "), ("Ünï 日本", " ünï 日本 ")],
)
def test_fold(text, want):
    assert fold(text).split() == want.split()


def brute(text, lexicon, phrases):
    """Every word against every entry, without an automaton."""
    words = fold(text).split()
    excused = set()
    for phrase in phrases:
        p = fold(phrase).split()
        for i in range(len(words) - len(p) + 1):
            if words[i : i + len(p)] == p:
                excused.update(range(i, i + len(p)))
    found = {}
    for i, word in enumerate(words):
        fits = [(w, e) for e, w in lexicon.items() if f" {word} ".startswith(e)]
        if fits and i not in excused:
            found[max(fits)] = found.get(max(fits), 0) + 1
    return sum(w * (1 + np.log(n)) for (w, _), n in found.items()), len(words)


@pytest.mark.parametrize(
    "text",
    ["idiot idiots an idiotic trash", "the trash can is no trash", "trash can trash", "lostra losten", "", None, "...", "can trash", "idiot " * 500, "tras h"],
)
def test_matches_equal_brute_force(text):
    matcher = Matcher(LEXICON, ("Trash can!", "lostra"))
    got, want = matcher.weigh(text), brute(text, LEXICON, ("Trash can!", "lostra"))
    assert got[1] == want[1] and abs(got[0] - want[0]) < 1e-9


def test_long_texts_are_matched_in_blocks(monkeypatch):
    monkeypatch.setattr(toxicity, "LONGEST_PHRASE", 5)
    matcher = Matcher(LEXICON, ("trash can", "idiot of the year", "lost"))
    rng = np.random.default_rng(4)
    for _ in range(40):
        text = " ".join(rng.choice(["trash", "can", "idiot", "of", "the", "year", "lost", "idiotic", "losten", "--"], 120))
        assert matcher.weigh(text, 9) == matcher.weigh(text) and matcher.weigh(text)[0] == pytest.approx(
            brute(text, LEXICON, ("trash can", "idiot of the year", "lost"))[0]
        )


def test_prune_drops_what_a_shorter_entry_finds():
    assert prune({" idio": 3.0, " idiot": 3.1, " idiot ": 4.0}) == {" idio": 3.0, " idiot ": 4.0}


def test_curve_of_split_rows_is_finite():
    curve = fit_curve(np.array([0.0, 0, 0, 9, 9]), np.array([5, 6, 7, 5, 6]), np.array([0, 0, 0, 1, 1]), np.ones(5))
    assert all(np.isfinite(curve)) and curve[1] + curve[2] > 0


def test_learned_from_rows_that_are_not_held_out(make):
    rng = np.random.default_rng(3)
    plain = [f"{a}{b}{c}ord" for a in "bdfglm" for b in "aeiou" for c in "nrst"]
    docs, labels = [], []
    for i in range(900):
        toxic = i % 4 == 0
        words = list(rng.choice(plain, 40)) + (list(rng.choice(["v1lest", "dreadful", "meaner"], 3)) if toxic else [])
        docs.append((i, " ".join(rng.permutation(words)), "clash", 1.0))
        if zlib.crc32(str(i).encode()) % 3 != 1:
            labels.append((i, 1, int(toxic)))
    labels += [(3, 1, None), (None, 1, 1)]
    docs += [(None, None, "x", 0.0), (0, docs[0][1], "x", 0.0), (5000, "", None, None), (5001, "dreadful vilest meaner trash can", None, None)]
    frame = make(docs, "doc_id long, text string, score string, words double")
    known = make(labels, "doc_id long, quality int, toxic int")
    model = learn(frame, known)
    assert {" vile", " drea", " mean"} <= {e[:5] for e in model.lexicon}
    rows = score(frame, model).collect()
    assert len(rows) == len(docs)
    for r in rows:
        if r["doc_id"] is not None and r["doc_id"] < 900:
            assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
            assert r["predicted"] == int(r["doc_id"] % 4 == 0) == int(r["score"] >= 0.7)
    empty = [r for r in rows if r["words"] == 0]
    assert len(empty) == 2 and all(r["predicted"] == 0 for r in empty) and not empty[0]["held_out"]
    # labels of held-out rows change nothing
    other = make(labels + [(i, 1, 1) for i in range(900) if zlib.crc32(str(i).encode()) % 3 == 1], "doc_id long, quality int, toxic int")
    assert learn(frame, other) == model


def test_counts_and_copies(make):
    line = "all rights reserved by the owners of this site"
    rng = np.random.default_rng(8)
    letters = list("abcdefghijklmnopqrstuvwxyz")
    unlike = [" ".join("".join(rng.choice(letters, 6)) for _ in range(40)) + f" {line}" for _ in range(120)]
    copy = " ".join("".join(rng.choice(letters, 6)) for _ in range(60))
    rows = [(i, t, i % 2) for i, t in enumerate(unlike)] + [(500 + i, f"{copy} {i}", 1) for i in range(30)]
    rows += [(600, "", 0), (601, None, 0), (602, "...", 1), (603, "two words", 0), (604, "two words", 1)]
    kept = toxicity.without_copies(make(rows, "doc_id long, text string, label int")).collect()
    assert sorted((r["text"] or "", r["label"]) for r in kept) == sorted((t or "", k) for i, t, k in rows if not 500 < i < 600)
    counted = make([(r["text"], r["label"]) for r in kept], "text string, label int").mapInArrow(toxicity._count, "entry string, toxic bigint, clean bigint")
    got = {}
    for r in counted.collect():
        a, b = got.get(r["entry"], (0, 0))
        got[r["entry"]] = (a + r["toxic"], b + r["clean"])
    want = {}
    for r in kept:
        words = set(fold(r["text"]).split())
        for e in {f" {w} " for w in words} | {f" {w[:n]}" for w in words for n in (4, 5, 6) if len(w) >= n}:
            a, b = want.get(e, (0, 0))
            want[e] = (a + r["label"], b + 1 - r["label"])
    assert got == want


def test_exceptions_are_learned(make):
    rows = [(f"some text about a trash can number {i}", 0) for i in range(12)] + [(f"you are trash {i} and idiots", 1) for i in range(40)]
    rows += [(f"plain words {i}", 0) for i in range(60)]
    frame = make(rows, "text string, label int")
    found = toxicity.learn_exceptions(frame, {" trash ": 2.0, " idio": 3.0}, 40, 72)
    assert set(found) == {"a trash", "trash can"}
    assert toxicity.learn_exceptions(frame, {" trash ": 2.0, " idio": 3.0}, 40, 72, most=1) == ("a trash",)


def test_a_hot_id_is_one_row(make):
    docs = make([(7, f"text {i} vile") for i in range(300)] + [(i, "plain text") for i in range(20, 30)], "doc_id long, text string")
    model = learn(docs, make([(7, 1)] + [(i, 0) for i in range(20, 30)], "doc_id long, toxic int"))
    assert model.learned_from[0] <= 1 and model.learned_from[1] <= 10
    assert len(learn(docs, make([(7, 1), (20, 0)], "doc_id long, toxic int"), most_entries=0).lexicon) == 0


def test_no_labels_and_no_documents(make):
    docs, labels = make([(1, "some idiot")], "doc_id long, text string"), make([], "doc_id long, toxic int")
    model = learn(docs, labels)
    assert model.lexicon == {} and [r["predicted"] for r in score(docs, model).collect()] == [0]
    assert score(docs.limit(0), Model(LEXICON, (), (0.0, 1.0, 1.0))).count() == 0


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [r for r in op7_toxicity(spark, sf).collect() if r["held_out"] and r["doc_id"] in truth]
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in rows) >= 0.95 * len(rows)

import zlib
from collections import Counter

import numpy as np
import pytest

from logquarry.llm import language
from logquarry.llm.language import BUCKETS, fit_ftrl, fit_temperature, learn, ngrams, op10_language, predict


def brute_grams(text):
    words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    out = []
    for w in words:
        w = f" {w} "
        out += [w[i : i + 1] for i in range(1, len(w) - 1)] + [w[i : i + 2] for i in range(len(w) - 1)] + [w[i : i + 3] for i in range(len(w) - 2)]
    return out


def test_ngrams_are_those_of_the_words():
    texts = ["Ab c1é", "", "12 !", "日本語 x", "a", "straße zu"]
    buckets, offsets = ngrams(texts)
    table = {}
    for i, text in enumerate(texts):
        want = brute_grams(text)
        got = buckets[offsets[i] : offsets[i + 1]]
        assert len(got) == len(want) and (got < BUCKETS).all()
        single = Counter()
        for g in want:
            b, o = ngrams([text])
            table.setdefault(g, None)
            single[g] += 1
        assert sorted(Counter(got.tolist()).values()) == sorted(single.values())
        assert Counter(ngrams([text])[0].tolist()) == Counter(got.tolist())


def test_long_texts_are_taken_in_pieces(make, monkeypatch):
    text = "Einige Wörter, 12 und mehr davon.\n" * 50
    whole = Counter(ngrams([text])[0].tolist())
    monkeypatch.setattr(language, "_SLAB", 40)
    pieces = Counter()
    for buckets, _ in language._parts([text]):
        pieces.update(buckets.tolist())
    assert pieces == whole


def test_ftrl_learns_sparse_weights():
    rng = np.random.default_rng(0)
    rows, label = [], rng.integers(0, 3, 400)
    for k in label:
        at = np.unique(np.concatenate([rng.integers(100, 5000, 20), [k, k + 10]]))
        rows.append((at, np.ones(len(at))))
    weights, bias = fit_ftrl(rows[:300], label[:300], 3, epochs=5, l1=2.0)
    got = [int(np.argmax(weights[:, a] @ x + bias)) for a, x in rows[300:]]
    assert np.mean(got == label[300:]) > 0.97
    assert (weights == 0).mean() > 0.95 and fit_ftrl(rows, label, 3, l1=1e9)[0].any() == False  # noqa: E712


def test_temperature():
    rng = np.random.default_rng(1)
    logits = rng.normal(size=(4000, 3))
    p = np.exp(logits) / np.exp(logits).sum(1, keepdims=True)
    label = np.array([rng.choice(3, p=x) for x in p])
    assert abs(fit_temperature(4 * logits, label) - 4) < 0.5 and fit_temperature(np.zeros((0, 3)), np.zeros(0, int)) == 1.0


VOICES = {"aa": "bado rami lona", "bb": "xuwe qizo vyke", "cc": "straß grün öde"}


@pytest.fixture(scope="module")
def frame(make):
    rng = np.random.default_rng(2)
    langs = sorted(VOICES)
    rows = [(i, " ".join(rng.choice(VOICES[langs[i % 3]].split(), 12)), langs[i % 3], 0.5) for i in range(300)]
    rows += [(1000, None, "aa", 0.0), (1001, "", "bb", 0.0), (1002, "12 !", "cc", 0.0), (None, rows[0][1], "aa", 0.0), (1003, "bado", None, 0.0), (0, rows[0][1], "aa", 0.0)]
    return make(rows, "doc_id long, text string, lang string, score double")


def test_predictions(frame):
    rows = predict(frame, learn(frame)).collect()
    assert len(rows) == 306
    for r in rows:
        i = r["doc_id"]
        assert 0 <= r["score"] <= 1 and r["held_out"] == (i is not None and zlib.crc32(str(i).encode()) % 4 == 2)
        if i in (1000, 1001, 1002):
            assert r["lang_pred"] == "und" and r["score"] == 0
        elif i is not None and i < 300:
            assert r["lang_pred"] == sorted(VOICES)[i % 3]
    assert {r["lang_pred"] for r in rows if r["doc_id"] is None} == {"aa"}


def test_nothing_learned_and_no_rows(frame):
    model = learn(frame.limit(0))
    assert {r["lang_pred"] for r in predict(frame.limit(5), model).collect()} == {"und"}
    assert predict(frame.limit(0), learn(frame)).count() == 0


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    rows = [r for r in op10_language(spark, sf).collect() if r["held_out"]]
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in rows) >= 0.97 * len(rows)


def test_held_out_texts_change_nothing(frame, spark):
    held = frame.selectExpr("*", "crc32(cast(cast(doc_id as string) as binary)) % 4 = 2 AS out").selectExpr(
        "doc_id", "CASE WHEN out OR lang IS NULL THEN concat('zzz qqq ', text, doc_id) ELSE text END AS text", "CASE WHEN out THEN 'aa' ELSE lang END AS lang", "score"
    )
    one, other = learn(frame), learn(held)
    assert one.labels == other.labels and np.array_equal(one.weights, other.weights) and np.array_equal(one.bias, other.bias)
    assert one.temperature == other.temperature


def test_frequencies_and_predictions_by_plain_counting(frame, make):
    texts = [r["text"] for r in frame.collect()]
    want = Counter()
    for text in texts:
        found = set(ngrams([text or ""])[0].tolist())
        want.update(found)
        want[-1] += bool(found)
    assert language.document_frequencies(frame.select("text")) == dict(want)
    model = learn(frame)
    long = "qizo" * 60_000
    rows = [*[(i, t, None, 0.0) for i, t in enumerate(texts[:40])], (77, long, None, 0.0)]
    got = {r["doc_id"]: r for r in predict(make(rows, "doc_id long, text string, lang string, score double"), model).collect()}
    for i, text, *_ in rows:
        at = Counter(ngrams([text])[0].tolist())
        z = np.array([sum(model.weights[k, b] * n for b, n in at.items()) / sum(at.values()) + model.bias[k] for k in range(len(model.labels))])
        p = np.exp((z - z.max()) / model.temperature)
        assert got[i]["lang_pred"] == model.labels[int(z.argmax())] and got[i]["score"] == pytest.approx((p / p.sum()).max(), abs=1e-3)


def test_a_hot_id_and_many_languages(make, monkeypatch):
    rows = [(5, f"bado rami {i}", "aa", 0.0) for i in range(400)] + [(1000 + i, "xuwe qizo", f"l{i:04d}", 0.0) for i in range(1200)]
    seen = []
    monkeypatch.setattr(language, "fit_ftrl", lambda rows, label, classes, **_: (seen.append((len(rows), classes)), (np.zeros((classes, BUCKETS)), np.zeros(classes)))[1])
    model = learn(make(rows, "doc_id long, text string, lang string, score double"))
    assert len(model.labels) > 700 and seen[0][0] <= len(model.labels)  # the repeated id is one row at most

import zlib

import numpy as np
import pyarrow as pa

from logquarry.llm import common
from logquarry.llm.quality import FEATURES, featured, features, fit, learn, op8_quality, predict, score


def test_features():
    texts = ["Aa bb, bb!\n$$ 12", None, "", "é", "...", "x y " * 3]
    data, bounds = common.utf8(pa.array(texts))
    rows = features(data, bounds)
    one = dict(zip(FEATURES, rows[0]))
    size = len(texts[0])
    assert np.isclose(one["words"], np.log1p(4)) and one["distinct_words"] == 3 / 4 and one["repeated_next"] == 1 / 4
    assert one["commonest_word"] == 2 / 4 and one["upper"] == 1 / size and one["digits"] == 2 / size and one["stress_marks"] == 1 / size
    assert one["symbols"] == 2 / size and np.isclose(one["bytes_per_line"], np.log1p(size / 2))
    assert not rows[1].any() and not rows[2].any() and rows[3][FEATURES.index("other_letters")] == 1
    assert rows[5][FEATURES.index("repeated_next")] == 0 and rows[5][FEATURES.index("distinct_words")] == 2 / 6
    for i in range(len(texts)):  # a text's features don't depend on its neighbours
        assert np.allclose(features(*common.utf8(pa.array(texts[i : i + 1], pa.string())))[0], rows[i])


def test_model_learns_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 3))
    label = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = fit(x[:3000], label[:3000], np.ones(3000), n_pairs=2, pair_rounds=80)
    assert (0, 1) in [(i, j) for i, j, _ in model.pairs]
    assert ((predict(model, x[3000:]) >= 0.5) == label[3000:]).mean() > 0.9


def test_model_is_a_sum_of_table_cells():
    rng = np.random.default_rng(1)
    x = rng.random((500, 3))
    model = fit(x, (x[:, 2] > 0.3).astype(float), np.ones(500), rounds=20, pair_rounds=5)
    for row, p in zip(x[:20], predict(model, x[:20])):
        at = [int(np.sum(edges <= v)) for edges, v in zip(model.edges, row)]
        z = model.base + sum(t[a] for t, a in zip(model.tables, at)) + sum(t[at[i], at[j]] for i, j, t in model.pairs)
        assert np.isclose(p, 1 / (1 + np.exp(-z)))


def test_constant_without_rows_or_with_one_label():
    assert predict(fit(np.zeros((0, 2)), np.zeros(0), np.zeros(0)), np.ones((3, 2))).tolist() == [0.5] * 3
    assert (predict(fit(np.ones((9, 2)), np.ones(9), np.ones(9)), np.ones((2, 2))) > 0.9).all()


def test_odd_rows(make):
    docs = [(i, ("good words here all differ %d " % i) * 2 if i % 2 else "bad bad bad $$$ ") for i in range(200)]
    docs += [(None, None), (None, "x"), (500, ""), (7, docs[7][1]), (501, "long " * 300000)]
    frame = make([(i, t, 1, 2) for i, t in docs], "doc_id long, text string, features int, label int")
    labels = make([(i, i % 2, 0) for i in range(200)] + [(3, None, 0), (None, 1, 0), (5, 1, 0)], "doc_id long, quality int, toxic int")
    model = learn(frame, labels)
    got = score(frame, model).collect()
    assert {len(r["features"]) for r in featured(frame).collect()} == {len(FEATURES)}
    assert len(got) == len(docs) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got)
    assert all(r["predicted"] == r["doc_id"] % 2 for r in got if r["doc_id"] is not None and r["doc_id"] < 200)
    assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    none = frame.limit(0)
    assert score(none, learn(none, labels)).count() == 0


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [r for r in op8_quality(spark, sf).collect() if r["held_out"] and r["doc_id"] in truth]
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in rows) >= 0.97 * len(rows)


def test_scores_are_sums_of_cells_of_each_text(make):
    docs = [(i, ("good words here all differ %d " % i) * (1 + i % 5) if i % 2 else "bad bad $$$ " * (1 + i % 7)) for i in range(300)]
    frame = make([*docs, *[(9, f"other {i}") for i in range(100)]], "doc_id long, text string")
    model = learn(frame, make([(i, i % 2) for i in range(300)], "doc_id long, quality int"))
    got = {r["doc_id"]: r["score"] for r in score(make(docs, "doc_id long, text string"), model).collect()}
    for i, text in docs[::17]:
        row = features(*common.utf8(pa.array([text])))[0].astype(np.float32).astype(float)
        at = [sum(1 for e in edges if e <= v) for edges, v in zip(model.edges, row)]
        z = model.base + sum(t[a] for t, a in zip(model.tables, at)) + sum(t[at[a], at[b]] for a, b, t in model.pairs)
        assert np.isclose(got[i], 1 / (1 + np.exp(-z)))

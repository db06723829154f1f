import sys
from pathlib import Path

import numpy as np

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
from test_decontaminate import brute as contaminated  # noqa: E402
from test_neardup import brute as classes  # noqa: E402
from test_pack import check as check_packed  # noqa: E402

from logquarry.llm import quality, toxicity  # noqa: E402
from logquarry.session import session_area  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def frame_of(make, docs):
    return make([(i, t, "en", None, len(t or "")) for i, t in docs], SCHEMA)


def odd_documents():
    rng = np.random.default_rng(8)
    say = lambda n: " ".join(rng.choice([f"w{i}" for i in range(900)], n))
    item = say(30)
    docs = [(i, say(int(rng.integers(5, 200)))) for i in range(60)]
    docs += [(100, docs[3][1]), (101, docs[4][1] + " more"), (3, docs[3][1]), (3, say(50)), (None, docs[5][1]), (None, say(40)), (None, None)]
    docs += [(200, ""), (201, None), (202, "!!"), (300, say(100) + " " + item), (301, item)]
    return docs, item


def test_near_dedup_and_decontamination_equal_brute_force(spark, make, tmp_path):
    docs, item = odd_documents()
    make([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    kept = corpus_pipeline.near_dedup_stage(spark, frame_of(make, docs), str(tmp_path))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    got = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str)
    tagged = [((i is None, i if i is not None else -1, t or ""), t) for i, t in docs]
    rows = classes(tagged)
    want = sorted({(None if key[0] else key[1], key[2]) for key, first, _ in rows if key == first}, key=str)
    assert sorted({(i, t or "") for i, t in got}, key=str) == want
    clean = corpus_pipeline.decontamination_stage(spark, kept, str(tmp_path))
    bad = {r[0] for r in contaminated(got, [(1, item)]) if r[5]}
    assert bad == {300, 301}
    assert sorted(((r["doc_id"], r["text"]) for r in clean.collect()), key=str) == [g for g in got if g[0] not in bad]


def test_wordless_rows_all_stay(spark, make, tmp_path):
    wordless = [(None, None), (None, None), (None, ""), (5, "!!"), (5, "!!"), (6, None), (6, "")]
    worded = [(None, "é"), (None, "é"), (7, "a b"), (7, "a b"), (8, "0")]
    got = corpus_pipeline.near_dedup_stage(spark, frame_of(make, wordless + worded), str(tmp_path)).collect()
    want = wordless + [(None, "é"), (7, "a b"), (8, "0")]
    assert sorted(((r["doc_id"], r["text"]) for r in got), key=str) == sorted(want, key=str)


def test_clean_rows_of_a_null_or_repeated_id_stay(spark, make, tmp_path, monkeypatch):
    docs, item = odd_documents()
    make([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    clean = [(None, "one clean text"), (None, "another clean text"), (None, None), (400, "clean namesake"), (400, None)]
    bad = [(None, item), (None, docs[9][1][:50] + " " + item), (400, item), (400, item)]
    for _ in range(2):
        got = corpus_pipeline.decontamination_stage(spark, frame_of(make, clean + bad), str(tmp_path)).collect()
        assert sorted(((r["doc_id"], r["text"]) for r in got), key=str) == sorted(clean, key=str)
        monkeypatch.setattr(corpus_pipeline, "BROADCAST_ROWS", 0)


def test_more_ids_than_may_be_broadcast(spark, make, tmp_path, monkeypatch):
    docs, item = odd_documents()
    make([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    one, other = [], []
    for out in (one, other):
        for stage in (corpus_pipeline.near_dedup_stage, corpus_pipeline.decontamination_stage):
            out.append(sorted(map(str, stage(spark, frame_of(make, docs), str(tmp_path)).collect())))
        monkeypatch.setattr(corpus_pipeline, "BROADCAST_ROWS", 0)
    assert one == other


def test_stages_on_the_small_table(spark):
    """Each stage on its predecessor's result, against the operator's own rows or plain Python."""
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    benchmark = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        result = stage(spark, docs, sf)
        if name == "packing":
            check_packed(result.collect(), list(before.items()))
            break
        assert result.columns == docs.columns
        after = {r["doc_id"]: r["text"] for r in result.collect()}
        assert after.items() <= before.items()
        if name == "toxicity":
            want = toxicity.score(docs, toxicity.learn(docs, labels)).where("predicted = 0")
            assert after.keys() == {r["doc_id"] for r in want.collect()} and len(after) < len(before)
        elif name == "quality":
            want = quality.score(docs, quality.learn(docs, labels)).where("predicted = 1")
            assert after.keys() == {r["doc_id"] for r in want.collect()} and len(after) < len(before)
        elif name == "near_dedup":
            assert after.keys() == {i for i, first, _ in classes(list(before.items())) if i == first}
        else:
            assert after.keys() == {r[0] for r in contaminated(list(before.items()), benchmark) if not r[5]}
        docs = spark.createDataFrame(result.collect(), docs.schema)


def test_empty_documents(spark, make, tmp_path):
    make([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    make([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    make([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


CLASHING = ["_id", "_text", "_again", "_key", "kept", "id", "no_id", "row", "key_text", "class_id", "k1", "node", "bucket", "score", "label", "words", "window"]


def test_columns_of_any_name(spark, make, tmp_path):
    """Extra columns keep their values through every stage, whatever they are called; repeated rows included."""
    docs, item = odd_documents()
    make([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    make([(i, i % 2, 0) for i in range(60)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    plain = frame_of(make, docs + docs[10:13])
    rich = plain.selectExpr("*", *[f"concat('{c} ', coalesce(doc_id, 0)) AS `{c}`" for c in CLASHING])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        one, other = stage(spark, plain, str(tmp_path)), stage(spark, rich, str(tmp_path))
        assert other.columns == rich.columns, name
        rows = other.collect()
        assert sorted(map(str, one.collect())) == sorted(str(r) for r in other.select(*plain.columns).collect())
        assert all(r[c] == f"{c} {r['doc_id'] or 0}" for r in rows for c in CLASHING)
    assert corpus_pipeline.packing_stage(spark, rich, str(tmp_path)).count() == corpus_pipeline.packing_stage(spark, plain, str(tmp_path)).count()


def test_rows_equal_in_id_and_text_become_the_first_by_size(spark, make, tmp_path):
    rows = [(7, "same words here", "en", "s", n) for n in (None, 9, 4, 6)] + [(None, "other words there", "en", None, n) for n in range(300, 0, -1)]
    got = corpus_pipeline.near_dedup_stage(spark, make(rows, SCHEMA).repartition(5), str(tmp_path))
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(7, "same words here", "en", "s", 4), (None, "other words there", "en", None, 1)], key=str)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


def test_only_the_last_stage_stays_on_disk(spark, make, tmp_path):
    make([(1, 1, 0), (2, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    make([(1, "a b")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    frame_of(make, [(1, "some words"), (2, "other words")]).write.parquet(f"{tmp_path}/documents.parquet")
    folder = Path(session_area(spark).folder)
    names = lambda: {n.name.rsplit("-", 1)[0] for n in folder.iterdir()} if folder.exists() else set()
    before = names()
    corpus_pipeline.run(spark, str(tmp_path)).count()
    assert names() - before <= {"packing"} and not {name for name, _ in corpus_pipeline.STAGES[:-1]} & names()

import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from logquarry.llm import pack as packing
from logquarry.llm.pack import _parts, op5_pack, pack, piece_lengths


def test_piece_lengths():
    for n in range(0, 5000, 7):
        got = piece_lengths(n)
        assert sum(got) == n and all(x & (x - 1) == 0 and x <= 1024 for x in got) and got == sorted(got, reverse=True)
        assert len({x for x in got if x < 1024}) == sum(x < 1024 for x in got)


def test_long_texts_are_cut_where_no_token_lies_across():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rng = np.random.default_rng(6)
    pieces = ["word", " ", "  ", "\n", " \n ", "é", "12", "'s", "!?", "<|endoftext|>", "日", "\u00a0", "a"]
    cuts = 0
    for _ in range(60):
        text = "".join(rng.choice(pieces, 200))
        parts = list(_parts(text, 20))
        assert "".join(parts) == text
        cuts += len(parts) - 1
        ids = [i for p in parts for i in tokenizer.encode(p, add_special_tokens=False).ids]
        assert ids == tokenizer.encode(text, add_special_tokens=False).ids
    assert cuts > 60
    assert list(_parts("x" * 99, 10)) == ["x" * 99] and list(_parts("", 10)) == [""]


def check(rows, docs):
    """Every id in one piece, digests of the reference tokenizer's ids, sequences numbered without gaps."""
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = []
    for doc_id, text in docs:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        at = 0
        for n in piece_lengths(len(ids)):
            want.append((doc_id, at, n, zlib.crc32(ids[at : at + n].tobytes()), len(ids)))
            at += n
    assert sorted((tuple(r)[:5] for r in rows), key=str) == sorted(want, key=str)
    assert sorted(r["sequence_id"] for r in rows) == list(range(len(rows))) and all(r["offset"] == 0 for r in rows)
    in_order = [r["length"] for r in sorted(rows, key=lambda r: r["sequence_id"])]
    assert in_order == sorted(in_order, reverse=True)


def test_pack_small(make):
    texts = ["", None, "a b c", "a b c", "é\n\n  x" * 900, "<|endoftext|> x", "z" * 30000, "日本語 🙂 1234567", "word " * 4000]
    docs = [(i % 5 if i else None, t) for i, t in enumerate(texts)]
    frame = make([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, length int, place string").repartition(3)
    check(pack(frame).collect(), docs)
    ids = [r["ids"] for r in pack(frame.where("text = 'a b c'"), with_ids=True).orderBy("start").collect()]
    assert all(len(x) in (1, 2, 4) for x in ids)
    assert pack(frame.limit(0)).count() == 0


def test_blocks_of_a_long_text(monkeypatch):
    text = "some words, and more of them\n" * 3000
    whole = np.concatenate(list(packing._blocks(packing.encoder(), text, 1024, 0)))
    monkeypatch.setattr(packing._parts, "__defaults__", (1000,))
    parts = list(packing._blocks(packing.encoder(), text, 1024, 0))
    assert all(len(x) == 1024 for x in parts[:-1]) and np.array_equal(np.concatenate(parts), whole)


def test_query_on_the_smallest_table(spark):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    check(op5_pack(spark, sf).collect(), docs)

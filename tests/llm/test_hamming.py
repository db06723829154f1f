import numpy as np
import pytest

from logquarry.llm import hamming
from logquarry.llm.hamming import masks, op6_hamming_search, segment_bounds, segments_of, sign_code, top_k


def brute(rows, queries, k):
    out = []
    for qid, q in set(queries):
        ranked = sorted((sum(bin(a ^ b).count("1") for a, b in zip(q, c)), i) for i, c in rows)[:k]
        out += [(qid, n + 1, i, d) for n, (d, i) in enumerate(ranked)]
    return sorted(out)


def codes(n, width, seed, spread=4):
    rng = np.random.default_rng(seed)
    centres = rng.integers(0, 256, (spread, width), dtype=np.uint8)
    noise = np.packbits(rng.random((n, width * 8)) < 0.1, axis=1)
    return [bytes(c) for c in centres[rng.integers(0, spread, n)] ^ noise]


@pytest.mark.parametrize("width, count", [(8, 50_000), (5, 10), (1, 3), (16, 10**9)])
def test_segments(width, count):
    bounds = segment_bounds(8 * width, count)
    assert bounds[0] == 0 and bounds[-1] == 8 * width and 0 < np.diff(bounds).min() and np.diff(bounds).max() <= 31
    table = np.frombuffer(b"".join(codes(40, width, 3)), np.uint8).reshape(-1, width)
    bits = np.unpackbits(table, axis=1)
    for row, values in zip(bits, segments_of(table, bounds)):
        assert [sum(int(x) << i for i, x in enumerate(row[a:b])) for a, b in zip(bounds[:-1], bounds[1:])] == values.tolist()
    assert sorted(np.concatenate(list(masks(6, 2, 4))).tolist()) == sorted(x for x in range(64) if bin(x).count("1") == 2)
    assert [x.tolist() for x in masks(5, 0)] == [[0]]


@pytest.mark.parametrize("width, k", [(8, 10), (8, 1), (5, 7), (1, 4), (16, 500)])
def test_top_k_equals_brute_force(make, width, k):
    rows = list(enumerate(codes(300, width, 1))) + [(1000 + i, b"\x01" * width) for i in range(60)]
    rows += [rows[5]] * 3
    queries = rows[::20] + [(2000, b"\xff" * width), (2001, b"\x01" * width), (2001, b"\x02" * width), rows[0]]
    frame, asked = make(rows, "id long, code binary"), make(queries, "id long, code binary")
    got = sorted(tuple(r) for r in top_k(frame, asked, k).collect())
    assert got == brute(rows, queries, k)


def test_repeated_rows_in_query_and_sql(spark, make, tmp_path):
    import duckdb

    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=64).tolist(), 1) for i in range(120)]
    rows += [rows[0], rows[0], rows[50], rows[7], (50, rows[3][1], 1), (200, [None, float("nan"), *[1.0] * 62], 2), (201, None, 2), (None, rows[1][1], 2)]
    make(rows, "vec_id long, embedding array<float>, label int").coalesce(1).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = sorted(tuple(r) for r in op6_hamming_search(spark, str(tmp_path)).collect())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/embeddings.parquet/*.parquet')")
    assert got == sorted(con.execute(hamming.OP6_SQL).fetchall())


def test_rows_are_not_copied_to_queries(make, monkeypatch):
    """What is dealt out of the rows does not grow with the queries."""
    rows = make(list(enumerate(codes(4000, 8, 9, 500))), "id long, code binary").repartition(8)
    kept, plain = [], hamming.stored
    monkeypatch.setattr(hamming, "stored", lambda df: kept.append(plain(df)) or kept[-1])
    sizes = []
    for every in (400, 20):
        kept.clear()
        result = top_k(rows, rows.where(f"id % {every} = 0"), 5)
        index = [df for df in kept if "segment" in df.columns]
        assert len(index) == 1
        sizes.append(index[0].count())
        assert result.where("rank = 1 AND distance > 0").count() == 0
    assert sizes[0] == sizes[1]


def test_few_rows_and_empty_tables(make):
    rows = make([(1, b"\x00"), (2, b"\x03")], "id long, code binary")
    assert sorted(tuple(r) for r in top_k(rows, rows, 5).collect()) == [(1, 1, 1, 0), (1, 2, 2, 2), (2, 1, 2, 0), (2, 2, 1, 2)]
    assert top_k(rows.limit(0), rows).count() == 0 and top_k(rows, rows.limit(0)).count() == 0


def test_sign_code(make):
    rows = [(1, [0.5, -1.0, 0.0, 2.0] * 2, 9), (2, None, 9), (None, [1.0] * 8, 9), (3, [1.0], 9), (4, [None, float("nan")] + [1.0] * 6, 9)]
    frame = make(rows, "vec_id long, embedding array<double>, id int")
    got = {r["id"]: bytes(r["code"]) for r in sign_code(frame, "vec_id", "embedding", 8).collect()}
    assert got == {1: bytes([0b10011001]), 4: bytes([0b00111111])}

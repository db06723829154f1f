import zlib
from collections import defaultdict

from logquarry.llm.shard import op4_shard, schedule, shard_by_size


def test_schedule_takes_the_largest_first():
    loads = defaultdict(int)
    sizes = [7, 6, 5, 4, 3, 3, 2]
    for size, s in zip(sizes, schedule(sizes, 3)):
        loads[s] += size
    assert max(loads.values()) == 11 and schedule([], 3) == [] and schedule([5], 2) == [0]


def check(rows, docs, shards):
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in rows), key=str) == sorted(
        ((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in docs), key=str
    )
    slots, loads, homes = defaultdict(list), defaultdict(int), defaultdict(set)
    for r in rows:
        assert r["law"] == "bytes" and r["grown_shard"] is None and 0 <= r["shard"] < shards
        slots[r["shard"]].append(r["slot"])
        loads[r["shard"]] += r["size"]
        homes[(r["text_crc32"], r["size"])].add(r["shard"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(h) == 1 for h in homes.values())
    return loads


def test_groups_stay_together_and_loads_are_near_equal(make):
    docs = [(i, "é" * (i % 50) + str(i // 3)) for i in range(3000)] + [(None, None), (None, ""), (5, "x"), (5, "x"), (6, "y" * 9000)]
    frame = make([(i, t, 1, 2) for i, t in docs], "doc_id long, text string, size int, shard int").repartition(5)
    loads = check(shard_by_size(frame, shards=4).collect(), docs, 4)
    assert max(loads.values()) - min(loads.values()) < 0.02 * sum(loads.values())
    assert shard_by_size(frame.limit(0)).count() == 0


def test_a_group_of_a_third_of_the_bytes_has_a_shard_of_its_own(make):
    docs = [(i, "same" * 10) for i in range(500)] + [(i, f"other {i} " * 3) for i in range(600)]
    frame = make(docs, "doc_id long, text string").repartition(4)
    rows = shard_by_size(frame, shards=4, units=50).collect()
    loads = check(rows, docs, 4)
    assert len({r["shard"] for r in rows if r["size"] == 48}) == 1
    rest = sorted(loads.values())[:-1]
    assert rest[-1] - rest[0] < 0.05 * sum(rest)


def test_given_groups(make):
    frame = make([(i, f"text {i}", None if i % 7 == 0 else i % 7) for i in range(700)], "doc_id long, text string, source int")
    homes = defaultdict(set)
    for r in shard_by_size(frame, group_column="source", shards=3).collect():
        homes[r["doc_id"] % 7].add(r["shard"])
    assert all(len(h) == 1 for h in homes.values())


def test_query_on_the_smallest_table(spark):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    check(op4_shard(spark, sf).collect(), docs, 24)

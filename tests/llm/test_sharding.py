import heapq
import zlib
from collections import defaultdict

from hiremill.llm.sharding import lpt, op2_sharding, shard_documents
from tests.llm.helpers import EDGES, SF, documents, words


def test_largest_first_to_the_least_loaded():
    items = [(7, "a"), (5, "b"), (4, "c"), (4, "d"), (3, "e")]
    assert lpt(items, 2) == {"a": 0, "b": 1, "c": 1, "d": 0, "e": 1}
    heap, want = [(0, s) for s in range(3)], {}
    items = [(i * 37 % 101, f"k{i:03d}") for i in range(200)]
    for load, key in sorted(items, key=lambda x: (-x[0], x[1])):
        least, shard = heapq.heappop(heap)
        want[key] = shard
        heapq.heappush(heap, (least + load, shard))
    assert lpt(items, 3) == want


def check(rows, got, shards):
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in got) == sorted(
        (d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in rows
    )
    slots, of_text = defaultdict(list), defaultdict(set)
    for r in got:
        slots[r.shard].append(r.slot)
        of_text[r.size, r.text_crc32].add(r.shard)
    assert all(sorted(s) == list(range(len(s))) and 0 <= k < shards for k, s in slots.items())
    assert all(len(s) == 1 for s in of_text.values())


def test_groups_stay_together_and_loads_are_near_equal(spark):
    rows = [(i, words(40, 5 + i % 60, i % 700)) for i in range(900)] + [(2000 + i, "the same hot text " * 3) for i in range(300)]
    got = shard_documents(documents(spark, rows, extra=True), 4).collect()
    check(rows, got, 4)
    loads = defaultdict(int)
    for r in got:
        loads[r.shard] += r.size
    assert max(loads.values()) - min(loads.values()) < 0.02 * sum(loads.values())


def test_edges(spark):
    check(EDGES, shard_documents(documents(spark, EDGES), 3).collect(), 3)
    assert shard_documents(documents(spark, []), 3).count() == 0


def test_query(spark):
    df = op2_sharding(spark, SF)
    assert df.columns[:7] == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    check([tuple(r) for r in rows], df.collect(), 8)

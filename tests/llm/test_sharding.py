"""Shards and slots against what the law says."""

import zlib
from collections import defaultdict

from herdframe.llm import sharding


def test_law_and_slots(docs_of, prose):
    rows = [(i, prose(5 + i % 9, i), "s") for i in range(2000)]
    rows += [(None, None, None), (None, "", "s"), (7, rows[7][1], "s"), (5000, "ü" * 100_000, "s")]
    got = sharding.shard_documents(docs_of(rows)).collect()
    want = sorted(((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, _ in rows), key=str)
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in got), key=str) == want
    slots, by_id = defaultdict(list), defaultdict(set)
    for r in got:
        assert 0 <= r.shard < 40 and r.law == "key" and r.grown_shard in (r.shard, 40)
        slots[r.shard].append(r.slot)
        by_id[r.doc_id].add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in by_id.values())
    moved = sum(r.grown_shard == 40 for r in got)
    assert 20 < moved < 90
    assert max(map(len, slots.values())) < 90


def test_many_bins_number_without_gaps(spark):
    df = spark.range(3000).selectExpr("id % 7 as g", "id % 100 as v", "id % 3 as w")
    got = defaultdict(list)
    for r in sharding.number_rows(df, "g", ["v", "w"], rows_per_bin=20).collect():
        got[r.g].append(r.slot)
    assert len(got) == 7 and all(sorted(s) == list(range(len(s))) for s in got.values())


def test_a_weight_moves_rows_of_its_own_path_only(spark):
    df = spark.range(4000).toDF("id")
    before = sharding.tree(16)
    after = sharding.tree(16)
    after[1][2][9] = 3.0
    rows = sharding.assign(sharding.assign(df, "id", before, "a"), "id", after, "b").filter("a <> b").collect()
    assert rows and all(r.b // 8 == 1 for r in rows)  # only into the region of the heavier shard
    assert all(r.b == 9 for r in rows if r.a // 4 == 2)  # inside its rack only to that shard
    counts = defaultdict(int)
    for r in sharding.assign(df, "id", after, "b").collect():
        counts[r.b] += 1
    assert counts[9] > 2 * max(v for k, v in counts.items() if k != 9) * 0.8


def test_empty_table(docs_of):
    assert sharding.shard_documents(docs_of([])).count() == 0

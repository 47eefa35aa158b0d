import random
import zlib
from collections import defaultdict

from odometrix.llm.shards import best_fit_decreasing, shard_documents
from tests.llm.helpers import documents, hard_rows


def test_best_fit_decreasing_takes_the_tightest_bin():
    room = [10.0, 7.0, 4.0]
    assert best_fit_decreasing([4, 6, 3, 7], room) == [0, 0, 2, 1]
    assert sorted(room) == [0.0, 0.0, 1.0]
    assert best_fit_decreasing([9], [5.0, 8.0]) == [1]  # too large for any: the emptiest


def check(got, rows, shards, tolerance):
    assert sorted((str(r.id), r.size, r.text_crc32) for r in got) == sorted(
        (str(i), len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, _ in rows
    )
    by_shard, by_text = defaultdict(list), defaultdict(set)
    for r in got:
        by_shard[r.shard].append(r)
        by_text[(r.text_crc32, r.size)].add(r.shard)
    for s, members in by_shard.items():
        assert 0 <= s < shards and sorted(r.slot for r in members) == list(range(len(members)))
    total = sum(r.size for r in got)
    sizes = [sum(r.size for r in by_shard[s]) for s in range(shards)]
    assert max(sizes) - min(sizes) <= tolerance
    group = defaultdict(int)
    for r in got:
        group[(r.text_crc32, r.size)] += r.size
    for key, spread in by_text.items():
        assert len(spread) == 1 or group[key] > total / shards


def test_sizes_near_equal_and_groups_whole(spark):
    r = random.Random(2)
    rows = [(i, "w" * r.randint(0, 3000) + str(i // 2), "s") for i in range(1500)]
    check(shard_documents(documents(spark, rows), shards=8).collect(), rows, 8, 64)


def test_hot_group_is_split_only_when_it_must(spark):
    rows = [(i, "the same text in a third of all rows " * 3, "s") for i in range(500)]
    rows += [(1000 + i, f"another text {i} " * (i % 9), "s") for i in range(900)]
    check(shard_documents(documents(spark, rows), shards=10).collect(), rows, 10, 300)


def test_hard_rows_and_empty_table(spark):
    rows = hard_rows()
    got = shard_documents(documents(spark, rows)).collect()
    assert len(got) == len(rows)
    by_shard = defaultdict(list)
    for r in got:
        by_shard[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    assert shard_documents(documents(spark, rows).limit(0)).count() == 0

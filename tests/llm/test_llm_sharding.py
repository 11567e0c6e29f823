import collections
import random
import zlib

import pytest
from llm_cases import documents, frame, write_tables

from tunedata.llm.queries import llm_queries
from tunedata.llm.sharding import even_shards, propagate, quotas, sharded_documents


def split_links(rows):
    """Pairs of equal texts that lie apart, from group sizes alone."""
    groups = collections.defaultdict(collections.Counter)
    for group, shard in rows:
        groups[group][shard] += 1
    return sum((sum(c.values()) ** 2 - sum(v * v for v in c.values())) // 2 for c in groups.values())


def check_rows(found, rows, shards):
    assert len(found) == len(rows)
    slots = collections.defaultdict(list)
    for row in found:
        slots[row["shard"]].append(row["slot"])
    sizes = [len(slots[s]) for s in range(shards)]
    assert set(slots) <= set(range(shards)) and max(sizes) - min(sizes) <= 1
    assert all(sorted(slots[s]) == list(range(len(slots[s]))) for s in slots)


def test_registered_query(spark, tmp_path):
    rows = documents()
    found = llm_queries()["op12_sharding"](spark, write_tables(spark, tmp_path / "t")).collect()
    check_rows(found, rows, 8)
    key = lambda doc, text: (-1 if doc is None else doc, len((text or "").encode()) + 1, zlib.crc32((text or "").encode()))
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], r["size"], r["text_crc32"]) for r in found) == sorted(
        key(r[0], r[1]) for r in rows
    )
    assert {(r["law"], r["grown_shard"]) for r in found} == {("rows", None)}
    # Groups here are smaller than a shard, and other rows fill the gaps: no link needs to be cut.
    assert split_links((r["text_crc32"], r["shard"]) for r in found) == 0


def test_a_group_larger_than_a_shard_fills_few_shards(spark):
    rows = [(i, "hot" if i % 3 == 0 else f"text {i if i % 2 else i // 4}", "en", "s", 3, *"abcdefg") for i in range(960)]
    found = sharded_documents(frame(spark, rows)).collect()
    check_rows(found, rows, 8)
    hot = collections.Counter(r["shard"] for r in found if r["text_crc32"] == zlib.crc32(b"hot"))
    assert sum(sorted(hot.values())[-3:]) >= 280
    best = (320 * 320 - 120 * 120 * 2 - 80 * 80) // 2
    first = split_links((r[1], n % 8) for n, r in enumerate(random.Random(1).sample(rows, len(rows))))
    assert best <= split_links((r["text_crc32"], r["shard"]) for r in found) < min(first, 1.35 * best)


def test_without_rows_to_fill_the_gaps(spark):
    """Every row is linked and all shards are full: only swaps are left, and they must keep sizes."""
    rows = [(i, f"pair {i // 2}", "en", "s", 3, *"abcdefg") for i in range(800)]
    found = sharded_documents(frame(spark, rows)).collect()
    check_rows(found, rows, 8)
    assert split_links((r["text_crc32"], r["shard"]) for r in found) < 400 * 7 / 8 / 2


def test_other_shards_links_and_columns(spark):
    rows = [(i, None if i % 4 == 0 else f"k{i % 50}", i * 2) for i in range(101)]
    given = spark.createDataFrame(rows, "row long, link_size string, mix long").repartition(3)
    found = even_shards(given, "link_size", ["row"], shards=5)
    assert found.columns == ["row", "link_size", "mix", "shard", "slot"]
    got = found.collect()
    check_rows(got, rows, 5)
    assert sorted((r["row"], r["link_size"], r["mix"]) for r in got) == sorted(rows)
    again = even_shards(given.repartition(7), "link_size", ["row"], shards=5).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, again), key=str)
    alone = even_shards(given, "link_size", ["row"], shards=1).collect()
    check_rows(alone, rows, 1)


def test_empty_and_tiny_tables(spark):
    assert sharded_documents(frame(spark, [])).collect() == []
    for n in (1, 3, 9):
        rows = [(7, "same", None, None, 0, *"abcdefg")] * n
        check_rows(sharded_documents(frame(spark, rows)).collect(), rows, 8)


def test_propagation_keeps_capacity_and_only_removes_cut_links(spark):
    draw = random.Random(3)
    state = [(i, draw.randrange(40) if i % 3 else 0, i % 4) for i in range(1, 401)]
    shards = collections.Counter(s for _, _, s in state)
    frame_ = spark.createDataFrame(state, "row long, link long, shard int")
    last, link = split_links((g, s) for _, g, s in state), {r: g for r, g, _ in state}
    for rounds in (1, 2, 8):
        labels, held = propagate(frame_, [shards[s] + 5 for s in range(4)], rounds)
        got = {r["row"]: r["shard"] for r in labels.collect()}
        assert set(got) == set(link)
        assert [collections.Counter(got.values())[s] for s in range(4)] == held
        assert all(h <= shards[s] + 5 for s, h in enumerate(held))
        cut = split_links((link[r], s) for r, s in got.items())
        assert cut <= last
        last = cut


@pytest.mark.parametrize("seed", range(40))
def test_quotas(seed):
    draw = random.Random(seed)
    n = draw.choice([1, 2, 5, 8])
    capacity = [draw.randrange(30) for _ in range(n)]
    held = [draw.randint(0, c) for c in capacity]
    wishes = [[draw.choice([0, draw.randrange(20)]) for _ in range(n)] for _ in range(n)]
    for a in range(n):  # no more wishes than rows
        while sum(wishes[a]) > held[a]:
            wishes[a] = [w // 2 for w in wishes[a]]
    moves = quotas(wishes, held, capacity)
    for a in range(n):
        assert moves[a][a] == 0 and all(0 <= m <= w for m, w in zip(moves[a], wishes[a]))
        assert held[a] + sum(m[a] for m in moves) - sum(moves[a]) <= capacity[a]
    assert quotas([[0, 5], [3, 0]], [5, 5], [5, 5]) == [[0, 3], [3, 0]]

import collections
import hashlib
import random
import zlib

import numpy as np
import pytest
from llm_cases import FOLDER
from pyspark.sql import functions as F

from tunedata.llm.ordered import numbered
from tunedata.llm.parentheses import Parentheses
from tunedata.llm.prefix_trie import end_hashes, rebuilt_prefixes
from tunedata.llm.queries import llm_queries

SCHEMA = "conv_id bigint, turn bigint, role string, text string, conv string, id string, place string, root string"


def expected(rows):
    own = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()
            own[conv].append(((turn is not None, turn or 0), tie, role, text))
    turns = {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in own.items()}
    members, ends, kids = (collections.defaultdict(f) for f in (list, list, set))
    for c, mine in turns.items():
        head = zlib.crc32(str(c).encode()) % 9
        whole = tuple(turns.get(c - c % 5, [])[:head] + mine[head:])
        ends[whole].append(c)
        for d in range(len(whole) + 1):
            members[whole[:d]].append(c)
            if d:
                kids[whole[: d - 1]].add(whole[:d])
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        size = len(node[-1][1].encode()) if node else 0
        leaves[node] = sum(leaves[k] for k in kids[node]) or 1
        saved[node] = (len(members[node]) - 1) * size + sum(saved[k] for k in kids[node])
    return sorted(
        (
            min(members[n]),
            len(n),
            min(members[n[:-1]]) if n else -1,
            len(members[n]),
            len(kids[n]),
            leaves[n],
            saved[n],
            hashlib.sha256(",".join(map(str, sorted(ends[n]))).encode()).hexdigest(),
        )
        for n in members
    )


def found(frame):
    rows = map(tuple, frame.collect())
    return sorted((r[0], r[1], -1 if r[2] is None else r[2], *r[3:]) for r in rows)


def frame(spark, rows, parts=5):
    return spark.createDataFrame([(*r, "a", "b", "c", "d") for r in rows], SCHEMA).repartition(parts)


def odd_rows():
    """Ties and nulls in every column, repeated rows, long and turnless conversations."""
    draw = random.Random(5)
    rows = []
    for c in range(120):
        length = draw.choice([1, 2, 9, 12]) if c % 40 else draw.choice([64, 65, 128, 200])
        for t in range(length):
            turn = draw.choice([t, None, 3]) if c % 9 == 0 else t
            text = f"x{t if c % 40 == 0 else draw.randrange(2)}" if draw.random() > 0.03 else None
            rows.append((c if c % 7 else c + 1000, turn, draw.choice(["u", None]), text))
    rows += [(3, 0, "u", "x0")] * 3 + [(None, 0, "u", "x"), (7000, 0, "ü", "é" * 50_000), (7001, None, None, None)]
    # One text chain shared up to different depths, so that later segments branch as well.
    rows += [(9000 + c, t, "u", f"t{t if t < 70 + 60 * (c % 3) else t * c}") for c in range(12) for t in range(210)]
    return rows


@pytest.mark.parametrize("elements", [40, 1 << 16])
def test_trie_matches_brute_force(spark, elements):
    rows = odd_rows()
    assert found(rebuilt_prefixes(frame(spark, rows), elements)) == expected(rows)


def test_registered_query_matches_brute_force(spark):
    rows = spark.read.parquet(f"{FOLDER}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    assert found(llm_queries()["op11_prefix_trie"](spark, FOLDER)) == expected([tuple(r) for r in rows])


def test_hot_conversations(spark):
    """Copies and one long conversation that hold most of the rows."""
    rows = [(c * 5, t, "u", f"s{t}") for c in range(300) for t in range(3)]
    rows += [(c * 5 + 2000, 0, "u", f"own {c}") for c in range(100)] + [(90_000, t, "u", "again") for t in range(900)]
    assert found(rebuilt_prefixes(frame(spark, rows))) == expected(rows)


def test_without_conversations(spark):
    assert rebuilt_prefixes(frame(spark, [])).collect() == []
    assert rebuilt_prefixes(frame(spark, [(None, 1, "u", "x")])).collect() == []
    lone = [(4, 0, "u", "x")]  # its first turns come from conversation 0, which is absent
    assert zlib.crc32(b"4") % 9 and found(rebuilt_prefixes(frame(spark, lone))) == expected(lone)


def test_end_hashes_of_a_hot_end(spark):
    numbers = list(range(20_000))
    ends = spark.createDataFrame([(b"hot", n) for n in numbers] + [(b"one", 7)], "end binary, conv long").repartition(6)
    got = {bytes(r["end"]): r["ends_sha256"] for r in end_hashes(ends).collect()}
    whole = ",".join(map(str, numbers)).encode()
    assert got == {b"hot": hashlib.sha256(whole).hexdigest(), b"one": hashlib.sha256(b"7").hexdigest()}


@pytest.mark.parametrize("nodes", [1, 2, 64, 65, 3000])
@pytest.mark.parametrize("deep", [0.1, 0.5, 0.99])
def test_parentheses(nodes, deep):
    draw, bits, depth = random.Random(nodes), [], 0
    left = nodes
    while left or depth:
        if left and (not depth or draw.random() < deep):
            bits.append(True)
            depth, left = depth + 1, left - 1
        else:
            bits.append(False)
            depth -= 1
    stack, close, children = [], {}, collections.Counter()
    for at, bit in enumerate(bits):
        if bit:
            children[stack[-1] if stack else None] += 1
            stack.append(at)
        else:
            close[stack.pop()] = at
    tree = Parentheses(np.array(bits))
    opens = tree.opens.tolist()
    assert tree.find_close(tree.opens).tolist() == [close[o] for o in opens]
    assert tree.subtree_sizes().tolist() == [(close[o] - o + 1) // 2 for o in opens]
    assert tree.leaves().tolist() == [not children[o] for o in opens]
    with pytest.raises(ValueError):
        Parentheses(np.array([True, True, False])).find_close(np.array([0]))


def test_numbering_of_a_key_that_spans_partitions(spark):
    rows = [(1 if i % 3 else i % 5, i) for i in range(1000)]
    got = numbered(spark.createDataFrame(rows, "k long, v long").repartition(7), "k", ["v"], "numbers", sums=["v"])
    assert got.select(F.spark_partition_id()).distinct().count() > 1
    seen = {(r["k"], r["v"]): (r["place"], r["run_v"]) for r in got.collect()}
    for key in range(5):
        own = sorted(v for k, v in rows if k == key)
        assert [seen[key, v] for v in own] == [(i + 1, sum(own[: i + 1])) for i in range(len(own))]

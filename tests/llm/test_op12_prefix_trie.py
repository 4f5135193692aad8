import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from telemetry_lake.llm import prefix_trie as op

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def brute(conversations):
    """{(conv_id, depth): rest of the node's row} from {conv_id: [(role, text)]}."""
    members = defaultdict(list)
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    kids = defaultdict(list)
    for node in members:
        if node:
            kids[node[:-1]].append(node)
    out = {}

    def walk(node):
        below = [walk(k) for k in kids[node]]
        words = len(re.findall(r"[^\x20\x09-\x0d]+", node[-1][1])) if node else 0
        leaves = sum(b[0] for b in below) or 1
        saved = sum(b[1] for b in below) + (len(members[node]) - 1) * words
        ends = ",".join(map(str, sorted(c for c in members[node] if len(conversations[c]) == len(node))))
        out[min(members[node]), len(node)] = (
            min(members[node[:-1]]) if node else None, len(members[node]), len(kids[node]), leaves, saved,
            hashlib.sha256(ends.encode()).hexdigest(),
        )
        return leaves, saved

    if members:
        walk(())
    return out


def of(df):
    rows = df.collect()
    got = {(r.conv_id, r.depth): tuple(r)[2:] for r in rows}
    assert len(got) == len(rows)
    return got


def plain_rebuilt(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(turns, key=lambda x: (*x[:3], hashlib.sha256(f"{len(x[2].encode())}:{x[2]}{x[3]}".encode()).digest()))] for c, turns in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = own.get(c - c % 20, [])[:h] + turns[h:]
    return out


@pytest.fixture(scope="module")
def rows():
    dice = random.Random(4)
    out = []
    for c in [*range(1, 300), *range(400, 460, 20), 10**12]:
        for turn in range(dice.choice([0, 1, 2, 5, 9])):
            out.append((c, dice.choice([None, turn]), dice.choice(["user", "assistant", None]), dice.choice(["a b", "a  b\n", "", None, "é x y"])))
    return out


def test_rebuilt_and_whole_result(spark, rows):
    df = spark.createDataFrame([*rows, (None, 1, "user", "lost")], SCHEMA).withColumns({"turns": F.lit(1), "key": F.lit("x")})
    expected = plain_rebuilt(rows)
    assert of(op.trie(op.rebuilt(op.turn_lists(df)))) == brute(expected)


def lists(spark, conversations):
    rows = [(c, i, r, t) for c, turns in conversations.items() for i, (r, t) in enumerate(turns)]
    bare = [(c,) for c, turns in conversations.items() if not turns]
    made = op.turn_lists(spark.createDataFrame(rows, SCHEMA))
    none = F.array().cast(made.schema["turns"].dataType)
    return made.unionByName(spark.createDataFrame(bare, "conv_id bigint").withColumn("turns", none))


def some(dice, n, letters, longest):
    return {c * 7: [("user", dice.choice(letters)) for _ in range(dice.randint(0, longest))] for c in range(n)}


@pytest.mark.parametrize("ranges", [1, 2, 7, 40])
def test_ranges_of_any_number(spark, ranges):
    dice = random.Random(ranges)
    found = some(dice, 120, ["x", "x y", "z"], 6)
    # A hot first turn, and many copies of one conversation.
    found |= {1001 + 7 * i: [("system", "hot one")] + t for i, t in enumerate(some(dice, 60, "abcdefgh", 3).values())}
    found |= {5000 + i: [("system", "hot one"), ("user", "copied words here")] for i in range(50)}
    assert of(op.trie(lists(spark, found), ranges)) == brute(found)


def test_one_long_prefix_over_all_ranges(spark):
    long = [("user", f"turn {i}") for i in range(3000)]
    found = {i: [*long[: 3000 - 100 * (i % 7)], ("user", str(i))] for i in range(40)} | {99: long, 98: []}
    assert of(op.trie(lists(spark, found), 5)) == brute_long(found)


def brute_long(conversations):
    """As ``brute`` without recursion, for few conversations."""
    ids = {c: [0] for c in conversations}
    seen = {}
    for c, turns in conversations.items():
        for t in turns:
            ids[c].append(seen.setdefault((ids[c][-1], t), len(seen) + 1))
    members, parent, words, kids = defaultdict(list), {}, {0: 0}, defaultdict(list)
    for c, path in ids.items():
        for d, node in enumerate(path):
            members[node].append(c)
            if d and node not in parent:
                parent[node], words[node] = path[d - 1], len(conversations[c][d - 1][1].split())
                kids[path[d - 1]].append(node)
    depth = {node: d for path in ids.values() for d, node in enumerate(path)}
    leaves, saved = {}, {}
    for node in sorted(depth, key=lambda x: -depth[x]):
        leaves[node] = sum(leaves[k] for k in kids[node]) or 1
        saved[node] = sum(saved[k] for k in kids[node]) + (len(members[node]) - 1) * words[node]
    ends = defaultdict(list)
    for c, path in ids.items():
        ends[path[-1]].append(c)
    return {
        (min(members[n]), depth[n]): (
            min(members[parent[n]]) if n in parent else None, len(members[n]), len(kids[n]), leaves[n], saved[n],
            hashlib.sha256(",".join(map(str, sorted(ends[n]))).encode()).hexdigest(),
        )
        for n in depth
    }


def test_forest_needs_no_order_of_merges():
    dice = random.Random(9)
    for _ in range(50):
        seqs = sorted({tuple(dice.choices("abc", k=dice.randint(0, 5))) for _ in range(dice.randint(1, 20))})
        lcp = [-1] + [next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b))) for a, b in zip(seqs, seqs[1:], strict=False)]
        size = np.array([len(s) for s in seqs])
        part = op.Part(size, np.array(lcp), np.ones(len(seqs), dtype=int), np.arange(len(seqs)), np.ones(size.sum(), dtype=int), [b""] * len(seqs))
        got = op.forest(part, -1, -1)
        nodes = {seqs[r][:d] for r, a, b in zip(got.row, got.above, got.depth, strict=True) for d in range(a + 1, b + 1)}
        assert nodes == {s[:d] for s in seqs for d in range(len(s) + 1)}
        assert sum(b - a for a, b in zip(got.above, got.depth, strict=True)) == len(nodes)


def test_digest_of_many_members(spark):
    members = spark.range(30_000).selectExpr("id * 3 as conv_id", "cast(if(id % 50 = 0, 'b', 'a') as binary) as key")
    got = {bytes(r.key): r.ends_sha256 for r in op.member_digests(members).collect()}
    for key, ids in ((b"b", [i * 3 for i in range(0, 30_000, 50)]), (b"a", [i * 3 for i in range(30_000) if i % 50])):
        assert got[key] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert op.trie(op.rebuilt(op.turn_lists(empty))).collect() == []

import random

import pytest
import xxhash
from pyspark.sql import functions as F

from telemetry_lake.llm import simhash_dedup as op
from telemetry_lake.llm.components import connected_components


def plain_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in "".join(" " if c in " \t\n\r\x0b\x0c" else c for c in low).split(" ") if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps):
    """{doc: smallest doc reachable}, by all pairs."""
    root = {d: d for d, _ in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, fa in fps:
        for b, fb in fps:
            if (fa ^ fb).bit_count() <= 2:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: find(d) for d, _ in fps}


@pytest.fixture(scope="module")
def texts():
    dice = random.Random(5)
    words = [f"w{i}" for i in range(300)] + ["É", "Ünder", "THE"]
    found = [" ".join(dice.choices(words, k=dice.choice([1, 2, 3, 40, 300]))) for _ in range(60)]
    near = [t.split(" ") for t in found if len(t.split(" ")) == 300]
    for t in near * 3:
        found.append(" ".join(t[:-1] + [dice.choice(words)]))
        found.append("\t ".join(t) + "\n")
    return found + [None, "", " \n", "\x85x", "\x1fa b", found[0], found[0]]


def test_equals_all_pairs(spark, documents, texts):
    got = op.near_duplicates(documents(enumerate(texts))).collect()
    fps = [(i, plain_fingerprint(t)) for i, t in enumerate(texts)]
    expected = plain_components(fps)
    assert len(got) == len(texts)
    for row in got:
        assert row.fp & (1 << 64) - 1 == fps[row.doc_id][1]
        assert row.component_id == expected[row.doc_id]
        assert row.kept == (row.component_id == row.doc_id)
    assert len(set(expected.values())) < len(set(texts))


def test_blocks_give_the_same_fingerprint(texts):
    for text in texts:
        data = (text or "").encode()
        assert op.simhash(data) == op.simhash(data, block=7)


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_links_of_planted_chains(spark, radius):
    dice = random.Random(1)
    values = [dice.getrandbits(64) for _ in range(30)]
    for v in values[:10]:
        for _ in range(5):
            v ^= sum(1 << b for b in dice.sample(range(64), dice.choice([1, 2, 3, 4])))
            values.append(v)
    rows = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    got = {frozenset(r) for r in op.links(spark.createDataFrame(rows, "fp bigint").distinct(), radius).collect()}
    near = {
        frozenset((a, b)) for (a,) in rows for (b,) in rows if a != b and ((a ^ b) & (1 << 64) - 1).bit_count() <= radius
    }
    assert got <= near

    def groups(edges):
        left = {x: x for e in edges for x in e}
        for _ in left:
            for a, b in map(tuple, edges):
                left[a] = left[b] = min(left[a], left[b])
        return left

    assert groups(got) == groups(near)


def test_components_of_long_chains(spark):
    edges = [(i, i + 1) for i in range(200)] + [(500, 500), (None, 4), (700, 600), (600, 700)]
    got = dict(connected_components(spark.createDataFrame(edges, "u bigint, v bigint")).collect())
    assert got == {i: 0 for i in range(201)} | {500: 500, 600: 600, 700: 600}


def test_null_ids_repeats_and_empty_table(spark, documents):
    assert op.near_duplicates(documents([])).collect() == []
    df = documents([(None, "a b c"), (4, "a b c"), (4, "a b c"), (None, "z"), (None, "z"), (4, None)])
    got = sorted((str(r.doc_id), str(r.component_id), r.kept) for r in op.near_duplicates(df).collect())
    assert got == [
        ("4", "4", True), ("4", "4", True), ("4", "4", True),
        ("None", "4", False), ("None", "None", True), ("None", "None", True),
    ]
    kept = op.keep_one_per_group(df.withColumn("text_key", F.lit("mine")))
    assert kept.columns == [*df.columns, "text_key"]
    assert sorted((str(r.doc_id), str(r.text), r.text_key) for r in kept.collect()) == [
        ("4", "None", "mine"), ("4", "a b c", "mine"), ("None", "z", "mine"),
    ]


def test_ties_do_not_depend_on_the_order_of_rows(spark):
    rows = [(1, "a b c", "de", "s2", 5), (1, "a b c", None, "s1", 5), (1, "a b c", "de", "s1", 5), (2, "z", "en", None, 1)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    for order in (rows, rows[::-1], rows[1:] + rows[:1]):
        df = spark.createDataFrame(order, schema).withColumn("text.key", F.create_map(F.lit("k"), F.col("lang")))
        kept = op.keep_one_per_group(df)
        assert kept.columns == df.columns
        assert sorted(tuple(r)[:5] for r in kept.collect()) == [rows[1], rows[3]]

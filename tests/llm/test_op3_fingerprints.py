import hashlib
import random
import re

import pytest
import xxhash

from telemetry_lake.llm import fingerprints as op


def plain_print(text):
    """The fingerprint from its definition, one term and one bit at a time."""
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words = [w for w in re.split("[ \t\n\r\x0b\x0c]", low) if w]
    terms = [" ".join(p).encode() for p in zip(words, words[1:], strict=False)] or [w.encode() for w in words]
    votes = [0] * 64
    for term in terms:
        value = xxhash.xxh64(term, seed=0).intdigest()
        for bit in range(64):
            votes[bit] += min(len(term), 24) * (1 if value >> bit & 1 else -1)
    value = sum(1 << bit for bit in range(64) if votes[bit] > 0)
    return value - (1 << 64) if value >> 63 else value


def plain_likeness(a, b):
    return sum((a >> bit & 1) == (b >> bit & 1) for bit in range(64)) / 64


def plain(rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    out = {}
    for n, (doc, text) in enumerate(order):
        after, text = order[(n + 1) % len(order)][1] or "", text or ""
        k = len(text) // 4
        edited = text[: len(text) - k] + after[:k]
        a, b, c = map(plain_print, (text, edited, after))
        out[doc] = (len(text), hashlib.sha256(edited.encode()).hexdigest(), a, b, plain_likeness(a, b), plain_likeness(a, c))
    return out


@pytest.mark.parametrize("width", ["1", "9"])
def test_equals_plain(spark, documents, width):
    dice = random.Random(3)
    words = [f"{c}{i}" for c in "aéÜ" for i in range(80)]
    rows = [(i * 2, " ".join(dice.choices(words, k=dice.randint(1, 200)))) for i in range(50)]
    rows += [(None, "no id here"), (101, None), (103, ""), (105, "one"), (107, "x y " * 40_000), (109, rows[0][1])]
    spark.conf.set("spark.sql.shuffle.partitions", width)
    try:
        got = op.with_next(documents(rows)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "2")
    assert {r.doc_id: tuple(r)[1:] for r in got} == plain(rows)
    prints = {r.doc_id: r for r in got}
    assert prints[0].fp == prints[109].fp
    long = [r for r in got if r.n_chars > 300 and r.doc_id and r.doc_id < 100]
    assert sum(r.near_edited for r in long) / len(long) > sum(r.near_next for r in long) / len(long) + 0.15


def test_repeats_one_row_and_none(documents):
    assert op.with_next(documents([])).collect() == []
    (row,) = op.with_next(documents([(5, "abcd efgh")])).collect()
    assert row.edited_sha256 == hashlib.sha256(b"abcd efab").hexdigest() and row.near_next == 1
    assert len(op.with_next(documents([(1, "a b"), (1, "a b"), (None, None), (None, None)])).collect()) == 4


def test_blocks_do_not_matter():
    text = " ".join(f"w{i * i % 97}" for i in range(2000))
    assert op.fingerprint(text, 11) == op.fingerprint(text, 100) == op.fingerprint(text)


@pytest.mark.parametrize("radius,blocks", [(1, 3), (2, 5), (3, 6)])
def test_radius_search_is_whole(spark, radius, blocks):
    dice = random.Random(radius)
    values = [dice.getrandbits(64) for _ in range(60)]
    values += [v ^ sum(1 << b for b in dice.sample(range(64), dice.randint(1, 5))) for v in values for _ in range(3)]
    signed = [v - (1 << 64) if v >> 63 else v for v in values] + [0, -1]
    df = spark.createDataFrame([(v,) for v in signed], "fp bigint")
    got = {(r.query, r.fp, r.distance) for r in op.within_radius(df, df, radius, blocks).collect()}
    distance = lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count()
    assert got == {(a, b, distance(a, b)) for a in signed for b in signed if distance(a, b) <= radius}


def test_query_counts_near_documents(spark, documents, tmp_path):
    documents([(0, "a b c d"), (1, "a b c d"), (50, None), (100, "")]).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in op.op3_fingerprints(spark, str(tmp_path)).collect()}
    assert [got[i].n_near for i in (0, 1, 50, 100)] == [2, None, 2, 2]
    assert got[50].fingerprint == "0" * 16

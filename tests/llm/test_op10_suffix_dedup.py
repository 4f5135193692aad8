import hashlib
import os
import random

import numpy as np
import pytest

from telemetry_lake.llm import suffix_dedup as op

SF = "/root/testdata/sf0.001/documents.parquet"


def brute(rows):
    """{row number: (n_bytes, n_removed, n_spans, kept digest)} by a dictionary of all windows."""
    seen, out = {}, {}
    order = sorted(range(len(rows)), key=lambda r: (rows[r][0] is not None, rows[r][0] or 0))
    for r in order:
        doc, data = rows[r][0], (rows[r][1] or "").encode()
        for at in range(len(data) - 99):
            key = data[at : at + 100]
            seen[key] = min(seen.get(key, (True, 1 << 70, 0)), (doc is not None, doc or 0, at))
    for r in order:
        doc, data = rows[r][0], (rows[r][1] or "").encode()
        gone = bytearray(len(data))
        for at in range(len(data) - 99):
            if seen[data[at : at + 100]] < (doc is not None, doc or 0, at):
                gone[at : at + 100] = b"\1" * 100
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out[r] = (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def check(documents, rows):
    expected = brute(rows)
    got = op.remove_repeats(documents(rows)).drop("kept").collect()
    left = sorted((str(rows[r][0]), *v) for r, v in expected.items())
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == left


@pytest.fixture(scope="module")
def shared():
    dice = random.Random(11)
    word = lambda: "".join(dice.choices("abcdeé 1", k=dice.randint(2, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passages = [prose(40) for _ in range(6)]
    rows = []
    for i in range(120):
        parts = [prose(dice.randint(0, 30))]
        for _ in range(dice.randint(0, 3)):
            p = dice.choice(passages)
            a = dice.randint(0, 60)
            parts += [p[a : a + dice.randint(60, 200)], prose(dice.randint(0, 12))]
        rows.append((i * 3, " ".join(parts)))
    return rows


def test_shared_passages(documents, shared):
    check(documents, shared)


def test_hot_windows_over_many_buckets(spark, documents, shared):
    hot = [(1000 + i, f"{i:04d}" + shared[0][1][:150] + f"{i * 7:05d}") for i in range(400)]
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        check(documents, shared + hot)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "2")


def test_edge_rows(documents):
    long = "xyz é" * 40_000
    run = "a" * 1000
    rows = [
        (None, "n" * 130), (1, None), (2, ""), (3, "short"), (4, "q" * 99), (5, "q" * 100), (6, "q" * 100),
        (7, run), (8, run), (8, run), (9, "b" + run + "c"), (10, "n" * 101), (11, long), (12, long[7:]),
        (13, "x" * 50 + "y" * 49 + "z"), (14, "x" * 50 + "y" * 49 + "w"), (15, "".join(map(chr, range(1, 300))) * 2),
    ]
    check(documents, rows)
    assert op.remove_repeats(documents([])).collect() == []


@pytest.mark.skipif(not os.path.exists(SF), reason="no test tables")
def test_test_table(spark, documents):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(SF).collect()]
    check(documents, rows)


@pytest.mark.parametrize("doc", [None, 5])
def test_thousands_of_texts_of_one_id(documents, shared, doc):
    dice = random.Random(7)
    passages = [t[:130] for _, t in shared[:4] if len(t) > 130]
    texts = [f"{i} " + "".join(dice.choices("abcdef ", k=60)) + dice.choice(["", *passages]) for i in range(4000)]
    # Texts of one id are one document: what starts at the same place in them is equally early.
    check(documents, [(doc, t) for t in texts] + [(9, texts[0]), (9, "x" + texts[1])])


def test_clashing_columns(documents, shared):
    rows = shared[:20] + [(None, shared[0][1])]
    df = documents(rows)
    for name in ("doc", "tag", "at", "data", "places", "of_doc", "of_tag", "gram", "bucket"):
        df = df.withColumn(name, op.F.lit("mine"))
    expected = sorted(map(tuple, op.remove_repeats(documents(rows)).collect()), key=str)
    assert sorted(map(tuple, op.remove_repeats(df).collect()), key=str) == expected


def test_blocks_have_every_window_once(monkeypatch):
    data = np.frombuffer(bytes(random.Random(2).choices(b"ab", k=3000)), dtype=np.uint8)

    def all_windows():
        return [(int(f) + k, int(g)) for gram, _, first, count in op.anchors(data) for g, f, c in zip(gram, first, count, strict=True) for k in range(c)]

    whole = all_windows()
    assert [w for w, _ in whole] == list(range(2901))
    monkeypatch.setattr(op, "BLOCK", 257)
    assert all_windows() == whole


def test_multikey_order():
    dice = np.random.default_rng(1)
    columns = [dice.integers(0, 5, 50_000), dice.integers(-3, 3, 50_000), dice.integers(0, 1 << 40, 50_000)]
    order = op.multikey_order(columns)
    expected = np.lexsort(columns[::-1])
    assert all((c[order] == c[expected]).all() for c in columns)

import random
import re

import pytest
from pyspark.sql import functions as F

from telemetry_lake.llm import decontaminate as op


def tokens(text):
    return [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]


def plain(docs, items):
    """{(doc, item): most equal tokens in a window}, by laying every item on every place."""
    found = {}
    for d, text in docs:
        a = tokens(text)
        for i, item in items:
            b = tokens(item)
            for shift in range(-len(b) + 1, len(a)):
                equal = [0 <= k + shift < len(a) and a[k + shift] == w for k, w in enumerate(b)]
                best = max((sum(equal[k : k + 13]) for k in range(len(b) - 12)), default=0)
                if best >= 11:
                    found[d, i] = max(found.get((d, i), 0), best)
    return found


@pytest.fixture(scope="module")
def tables():
    dice = random.Random(6)
    words = [f"{c}{i}" for c in "pqé" for i in range(40)]
    items = [(i, " ".join(dice.choices(words, k=dice.choice([5, 12, 13, 20, 40])))) for i in range(25)]
    items += [(90, None), (91, ""), (92, items[0][1]), (93, items[4][1]), (None, items[5][1]), (4, items[4][1])]
    docs = []
    for d in range(150):
        text = dice.choices(words, k=dice.randint(0, 60))
        item = (items[dice.randrange(25)][1]).split(" ")
        a = dice.randrange(max(1, len(item) - 12))
        part = item[a : a + dice.randint(8, 25)]
        for _ in range(dice.randint(0, 4)):
            part[dice.randrange(len(part))] = "other"
        docs.append((d, " ".join(text) + ". " + ", ".join(part).upper() + " - " + " ".join(text[:9])))
    docs += [(300, None), (301, ""), (None, docs[0][1]), (7, docs[7][1]), (302, "pq " * 40_000)]
    return docs, items


@pytest.mark.parametrize("limit", [10**6, 0])
def test_equals_plain(spark, documents, tables, monkeypatch, limit):
    docs, items = tables
    monkeypatch.setattr(op, "BROADCAST_TOKENS", limit)
    bench = spark.createDataFrame(items, "item_id bigint, text string").withColumn("doc_id", F.lit(1))
    got = op.overlaps(documents(docs).withColumn("item_id", F.lit(5)), bench).collect()
    expected = plain(docs, items)
    assert {(r.doc_id, r.item_id): r.window_matches for r in got} == expected
    assert len(got) == len(expected) > 20
    clean = op.without_leaks(documents(docs), bench)
    leaks = {d for d, _ in expected}
    assert sorted(str(r.doc_id) for r in clean.collect()) == sorted(str(d) for d, _ in docs if d not in leaks)


def test_empty_tables(spark, documents):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert op.overlaps(documents([(1, "a b")]), none).collect() == []
    assert op.overlaps(documents([]), none).collect() == []


def test_masks_hit_every_window():
    for a in range(13):
        for b in range(13):
            assert any(
                not {a, b} & {m + off for m in mask} for mask in op.MASKS for off in range(13 - mask[-1])
            )


def test_no_python(spark, documents):
    bench = spark.createDataFrame([(1, "x " * 20)], "item_id bigint, text string")
    plan = op.overlaps(documents([(1, "x")]), bench)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan

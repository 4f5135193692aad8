import hashlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from telemetry_lake.llm import secret_scan
from . import test_op1_secret_scan as op1
from . import test_op4_decontaminate as op4
from . import test_op7_simhash_dedup as op7

ITEM = " ".join(f"question{i}" for i in range(20))
ROWS = [
    (1, "the first text of some words", "en"), (2, "The first text  of some words", "en"), (3, None, "en"), (4, "12 34", "en"),
    (5, "before " + ITEM.upper() + " after", "en"), (6, f"a key token = {'ab1' * 10} here", None), (7, "", "de"),
    (8, "x " * 20_000 + "é", "de"), (None, "no id at all", "en"), (9, "the first text of some words", "en"), (10, "another text", "en"), (10, "another text", "en"),
]


@pytest.fixture
def folder(spark, documents, tmp_path):
    documents(ROWS).withColumn("extra", F.lit("x")).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, ITEM)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def test_every_stage_equals_plain(spark, folder):
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    seen = []
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, folder).cache()
        assert n == 4 or docs.columns == columns
        seen.append(docs.collect())
    rows = [[(r.doc_id, r.text) for r in s] for s in seen[:4]]
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    letters = [r[:2] for r in ROWS if r[1] and any(c.isalpha() for c in r[1])]
    assert sorted(rows[0], key=key) == sorted(letters, key=key)
    fps = [(i, op7.plain_fingerprint(t)) for i, (_, t) in enumerate(sorted(letters, key=key))]
    groups = op7.plain_components(fps)
    one_each = [r for i, r in enumerate(sorted(letters, key=key)) if groups[i] == i]
    assert sorted(rows[1], key=key) == sorted(one_each, key=key)
    leaks = {d for d, _ in op4.plain(rows[1], [(1, ITEM)])}
    assert leaks == {5} and sorted(rows[2], key=key) == sorted((r for r in one_each if r[0] not in leaks), key=key)
    for (a, before), (b, after) in zip(sorted(rows[2], key=key), sorted(rows[3], key=key), strict=True):
        assert a == b and (after == before) == (not op1.base_spans(before))
    assert "token" not in dict(rows[3])[6] and secret_scan.MASK in dict(rows[3])[6]
    texts = dict(rows[3])
    for r in seen[4]:
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
    assert len(seen[4]) == len(rows[3])


def test_run_and_empty_table(spark, documents, folder, tmp_path):
    assert corpus_pipeline.run(spark, folder).count() == 5
    empty = tmp_path / "empty"
    documents([]).write.parquet(f"{empty}/documents.parquet")
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{empty}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(empty)).count() == 0
    assert corpus_pipeline.ORACLE_SQL is None

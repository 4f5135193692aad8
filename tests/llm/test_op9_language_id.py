import os
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from telemetry_lake.llm import language_id as op

SF = "/root/testdata/sf0.01/documents.parquet"


def made(n, seed=1):
    dice = random.Random(seed)
    parts = {"xa": ["ka", "to", "mi"], "xb": ["schn", "el", "ung"], "xc": ["çã", "os", "inho"]}
    rows = []
    for i in range(n):
        lang = dice.choice(list(parts))
        rows.append((i, " ".join("".join(dice.choices(parts[lang], k=3)) for _ in range(30)), lang))
    return rows


def test_held_out_and_undetermined(documents):
    rows = made(300) + [(1000, None, "xa"), (1001, "12 .. 3", "xb"), (1002, "", None), (1003, "katomi kato", None), (None, "katomi kato mika", None), (5, "ka to mi", "xa"), (1004, "ka " * 50_000, None)]
    got = op.identify(documents(rows), op.train(documents(rows))).collect()
    assert len(got) == len(rows)
    truth = {r[0]: r[2] for r in rows}
    for r in got:
        assert r.held_out == (zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 3 == 1)
        assert 0 <= r.score <= 1
        if r.doc_id in (1000, 1001, 1002):
            assert (r.lang_pred, r.score) == ("und", 0.0)
    held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 1000]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) > 0.97


def test_lang_of_held_out_rows_is_not_used(documents):
    rows = made(200)
    lied = [(i, t, lang if zlib.crc32(str(i).encode()) % 3 != 1 else "zz") for i, t, lang in rows]
    a = {r.doc_id: tuple(r) for r in op.identify(documents(rows), op.train(documents(rows))).collect()}
    b = {r.doc_id: tuple(r) for r in op.identify(documents(lied), op.train(documents(lied))).collect()}
    assert a == b


def test_sample_is_bounded_and_drawn_evenly(documents):
    rows = [(i, f"text {i}", "xa" if i % 3 else "xb") for i in range(12_000)]
    counts = dict(op.training_sample(documents(rows)).groupBy("lang").count().collect())
    for lang, size in (("xa", 8000), ("xb", 4000)):
        trained = sum(zlib.crc32(str(i).encode()) % 3 != 1 for i, _, x in rows if x == lang)
        assert trained > size / 2 and min(op.PER_LANGUAGE, trained) <= counts[lang] <= 2 * op.PER_LANGUAGE


def test_table_of_null_ids_learns(documents):
    rows = [(None, t, lang) for _, t, lang in made(90)]
    got = op.identify(documents(rows), op.train(documents(rows))).collect()
    assert {r.lang_pred for r in got} == {"xa", "xb", "xc"} and not any(r.held_out for r in got)


def test_no_rows_to_learn_from(documents):
    assert op.train(documents([])) is None
    (row,) = op.identify(documents([(1, "text", None)]), None).collect()
    assert (row.lang_pred, row.score) == ("und", 0.0)


@pytest.mark.parametrize("n", [1, 2, 4, 7, 12, 40])
def test_codewords_differ(n):
    book = op.code_book(n)
    distance = (book.shape[1] - book @ book.T) / 2 + 99 * np.eye(n)
    assert distance.min() >= (1 if n < 8 else 5) or n == 1


def test_blocks_do_not_matter(monkeypatch):
    text = "Schnelung çãos é " * 500
    whole = op.features(text)
    monkeypatch.setattr(op, "BLOCK", 101)
    assert np.allclose(whole, op.features(text))


def test_ambiguity_is_flagged():
    book = op.code_book(2)
    model = op.Model(["a", "b"], book, np.zeros((4, 1), dtype=np.float32), np.zeros(1), np.ones(1))
    assert model.beliefs(np.ones((1, 4), dtype=np.float32)).max() < op.CLEAR


def test_pipeline_keeps_and_fills(documents):
    rows = made(100) + [(500, None, "xa"), (501, "123", "xa"), (502, "katomi mika toka", None), (503, "é", "xb")]
    df = documents(rows).withColumn("lang_pred", F.lit("mine"))
    kept = {r.doc_id: r for r in op.keep_identified(df).collect()}
    assert set(kept) == {r[0] for r in rows} - {500, 501}
    assert kept[502].lang == "xa" and kept[503].lang == "xb" and kept[0].lang_pred == "mine"


@pytest.mark.skipif(not os.path.exists(SF), reason="no test tables")
def test_accuracy_on_held_out_documents(spark):
    docs = spark.read.parquet(SF)
    got = op.identify(docs, op.train(docs)).where("held_out").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert sum(r.lang == r.lang_pred for r in got) / len(got) > 0.97


def test_pipeline_decides_by_the_prediction(documents, monkeypatch):
    """Rows with a given lang are predicted too: what the operator calls und goes."""
    plain = op.predictions

    def said(texts, model):
        names, *more = plain(texts, model)
        return [op.UNKNOWN if t == "ka to mi" else n for n, t in zip(names, texts, strict=True)], *more

    rows = made(60) + [(700, "ka to mi", "xa")]
    source = documents(rows)
    monkeypatch.setattr(op, "predictions", said)
    monkeypatch.setattr(type(source), "mapInArrow", lambda df, f, schema: df.sparkSession.createDataFrame(pa.Table.from_batches(list(f(iter(df.toArrow().to_batches()))))))
    monkeypatch.setattr(op, "train", lambda docs: op.fit(np.array([op.features(t) for _, t, _ in rows]), [lang for *_, lang in rows]))
    assert {r.doc_id for r in op.keep_identified(source).collect()} == {r[0] for r in rows} - {700}

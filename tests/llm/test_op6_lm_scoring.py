import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from telemetry_lake.llm import lm_scoring as op


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in "".join(" " if c in " \t\n\r\x0b\x0c" else c for c in low).split(" ") if w] + [""]


def held(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 == 2


def plain(rows):
    counts = Counter(w for i, t in rows if not held(i) for w in words(t))
    n, v = sum(counts.values()), len(counts)
    return {
        (i, t): (held(i), len(words(t)), sum(counts[w] > 0 for w in words(t)), n,
                 sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words(t)))
        for i, t in rows
    }


@pytest.fixture(scope="module")
def corpus():
    dice = random.Random(4)
    names = [[f"{k}{i}{e}" for i in range(60)] for k, e in (("a", "en"), ("b", "la"))]
    rows = []
    for i in range(300):
        text = " ".join(dice.choices(names[i % 2], k=dice.randint(1, 80)) + [f"rare{i}é"])
        rows.append((i, text))
    return rows


def test_counts_and_base_score(documents, corpus, monkeypatch):
    rows = corpus + [(400, None), (401, ""), (402, " \n"), (403, "É THE the\x85x \x1f"), (404, "w " * 50_000), (7, corpus[7][1]), (None, "no id")]
    expected = plain(rows)
    monkeypatch.setattr(op, "KNOWN", 200)
    got = op.score(documents(rows)).collect()
    assert len(got) == len(rows)
    texts = {i: t for i, t in rows}
    for r in got:
        out, n, k, total, base = expected[r.doc_id, texts[r.doc_id]]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (out, n, k, total)
        assert r.base_score == pytest.approx(base, rel=1e-7, abs=1e-7)
    # The model uses what comes before a word, so it does better than counts alone.
    unseen = [r for r in got if r.held_out and r.n_tokens > 5]
    assert sum(r.score for r in unseen) > sum(r.base_score for r in unseen)


def test_known_words_do_not_change_scores(documents, corpus, monkeypatch):
    whole = {r.doc_id: r for r in op.score(documents(corpus)).collect()}
    monkeypatch.setattr(op, "KNOWN", 20)
    for r in op.score(documents(corpus)).collect():
        assert r.base_score == pytest.approx(whole[r.doc_id].base_score, abs=1e-6)
        assert r.score == pytest.approx(whole[r.doc_id].score, abs=1e-6)


def test_probabilities_are_normalised():
    dice = np.random.default_rng(1)
    counts = dice.integers(0, 3, (op.UNITS**2, op.UNITS)).astype(float)
    model = op.Model(1, 1, {}, np.zeros(op.CLASSES), *op.train_vectors(counts, steps=5))
    assert np.allclose((10.0 ** model.log_probabilities()).sum(axis=2), 1, atol=1e-4)


def test_training_raises_likelihood():
    dice = np.random.default_rng(2)
    counts = np.zeros((op.UNITS**2, op.UNITS))
    for i in range(op.UNITS):
        counts[dice.integers(0, op.UNITS, 5) * op.UNITS + i, (i * 7) % 20] += 50

    def likelihood(steps):
        model = op.Model(1, 1, {}, np.zeros(op.CLASSES), *op.train_vectors(counts, steps=steps))
        return (model.log_probabilities().reshape(counts.shape) * counts).sum()

    assert likelihood(150) > 0.5 * likelihood(0)


def test_empty_and_unlearned_tables(documents):
    assert op.score(documents([])).collect() == []
    only = next(i for i in range(100) if held(i))
    (row,) = op.score(documents([(only, "a b")])).collect()
    assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens, row.base_score) == (True, 3, 0, 0, 0.0)
    assert row.score < 0

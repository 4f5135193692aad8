import hashlib
import random

import numpy as np
import pytest

from telemetry_lake.llm import byte_bpe as op

tiktoken = pytest.importorskip("tiktoken")
P = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def encoder():
    return op.Encoder(op.read_ranks(op.local_path("byte_bpe_multi_50k.tiktoken")), P.PATTERN)


@pytest.fixture(scope="module")
def library():
    ranks = op.read_ranks(op.local_path("byte_bpe_multi_50k.tiktoken"))
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts():
    dice = random.Random(8)
    yield from ["", " ", "a", "don't we'll 'éés  x\n\n y\t", "日本語" * 500, "a" * 5000, "ab" * 3000 + "x", "<|endoftext|>", "\x1c\x85　 1​2"]
    for alphabet in ("abc", "aé日 '1\n😀", "etaoin shrdlu", "\x00\x1c\x85\xa0  x"):
        for n in (5, 50, 3000):
            yield "".join(dice.choices(alphabet, k=n))


def test_equals_library(encoder, library):
    for text in texts():
        ids = encoder.encode(text)
        assert ids == library.encode_ordinary(text)
        assert encoder.decode(ids) == text.encode()


def test_groups_do_not_matter(encoder, library, monkeypatch):
    monkeypatch.setattr(op, "GROUP_CHARS", 100)
    monkeypatch.setattr(op, "GROUP_PIECES", 37)
    for text in texts():
        assert encoder.encode(text) == library.encode_ordinary(text)


def test_table(spark, documents, library):
    rows = [*enumerate(texts()), (1000, None), (None, "no id"), (3, "again"), (3, "again")]
    got = op.encode_table(documents(rows)).collect()
    assert len(got) == len(rows)
    expected = {}
    for doc_id, text in rows:
        ids = library.encode_ordinary(text or "")
        digest = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        expected.setdefault(doc_id, []).append((ids, len(ids), digest, hashlib.sha256((text or "").encode()).hexdigest()))
    for r in got:
        assert (r.ids, r.n_tokens, r.ids_sha256, r.decoded_sha256) in expected[r.doc_id]
    decoded = {r.doc_id: bytes(r.data) for r in op.decode_table(op.encode_table(documents(rows[:9]))).collect()}
    assert decoded == {i: (t or "").encode() for i, t in rows[:9]}
    assert op.encode_table(documents([])).collect() == []


def test_queue_takes_lowest_rank_first():
    dice = np.random.default_rng(4)
    queue = op.RankQueue(300_000)
    ranks = dice.integers(0, 300_000, 2000)
    queue.push_all(ranks, np.arange(2000))
    taken = []
    while (found := queue.pop()) is not None:
        assert (ranks[found[1]] == found[0]).all()
        taken.append(found[0])
        if len(taken) == 5:
            queue.push(0, np.array([7]))
            assert queue.pop()[0] == 0
    assert taken == sorted(set(ranks.tolist()))

import hashlib
import json
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from telemetry_lake.llm import token_alignment as op

P = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")


@pytest.fixture(scope="module")
def both():
    a = tokenizers.Tokenizer.from_file(P.path(op.VOCABULARY_A))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=P.path(op.VOCABULARY_B))


def printable_bytes():
    """The byte alphabet, found from the library's own encoding of each byte."""
    level = tokenizers.pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    known = {}
    for low in range(0x80):
        known[level.pre_tokenize_str(chr(low))[0][0]] = low
    for point in range(0x80, 0x800):
        for shown, byte in zip(level.pre_tokenize_str(chr(point))[0][0], chr(point).encode(), strict=True):
            known[shown] = byte
    for char in "ࠀက가￿\U00010000\U0010ffff" + "".join(chr(p) for p in range(0x1000, 0x10000, 0x800) if not 0xD800 <= p < 0xE000) + "".join(chr(p) for p in range(0x10000, 0x110000, 0x4000)):
        for shown, byte in zip(level.pre_tokenize_str(char)[0][0], char.encode(), strict=True):
            known[shown] = byte
    return known


def brute(rows, both):
    """Result rows by comparing every pair of tokens of a text."""
    a, b = both
    alphabet = printable_bytes()
    entries = {i: e for e, i in a.get_vocab().items()}
    tokens, counts = [], Counter()
    for _, text in rows:
        lists = [], []
        if text:
            for i in a.encode(" " + text, add_special_tokens=False).ids:
                lists[0].append((i, bytes(alphabet[c] for c in entries[i])))
            for i in b.encode(text):
                piece = b.id_to_piece(i)
                lists[1].append((i, bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()))
            if any(b"".join(d for _, d in x) != (" " + text).encode() for x in lists):
                lists = [], []
        spans = []
        for some in lists:
            at, out = 0, []
            for i, data in some:
                out.append((i, at, at + len(data)))
                at += len(data)
            spans.append(out)
        links = [(i, j) for i, s, e in spans[0] for j, t, f in spans[1] if s < f and t < e]
        counts.update(links)
        tokens.append((spans, links))
    top = Counter()
    for (_, j), n in counts.items():
        top[j] = max(top[j], n)
    out = []
    for (doc, _), (spans, links) in zip(rows, tokens, strict=True):
        ends = sorted({e for _, _, e in spans[0]} & {e for _, _, e in spans[1]})
        groups, low = [], 0
        for end in ends:
            groups.append("|".join(",".join(str(i) for i, s, e in x if low <= s and e <= end) for x in spans))
            low = end
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        best = sum(counts[x] == top[x[1]] for x in links)
        out.append((doc, len(spans[0]), len(spans[1]), len(groups), len(links), best, sum(counts[x] for x in links), digest))
    return out


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def texts():
    dice = random.Random(3)
    words = ["the", "naïve", "Straße", "12345", "don't", "日本語", "😀", "été", "x" * 40, "\t\n", "a  b", "<|endoftext|>", "<s>", "<0x41>"]
    found = [" ".join(dice.choices(words, k=dice.randint(1, 25))) for _ in range(50)]
    return [*found, None, "", " ", "  ", "\n", "a▁b", "\u0000", "é" * 300, "q", found[0], found[0], "end "]


def test_equals_brute_force(documents, both, texts):
    rows = [*enumerate(texts), (None, "no id"), (7, "an id again"), (7, "an id again")]
    got = rows_of(op.aligned(documents(rows).withColumn("row", F.lit("x")).withColumn("a", F.lit(1))))
    assert got == sorted(brute(rows, both), key=str)


@pytest.mark.parametrize("hot", [0, 1, 40])
def test_pairs_beyond_the_sent_table(documents, texts, hot):
    df = documents(list(enumerate(texts)))
    assert rows_of(op.aligned(df, hot_pairs=hot)) == rows_of(op.aligned(df))


def test_hot_table_is_bounded(spark):
    counts = spark.createDataFrame([(i, i % 50 + 1) for i in range(1000)], "pair bigint, n bigint")
    for most in (0, 1, 19, 20, 21, 500, 1000, 5000):
        least = op.hot_level(counts, most)
        assert counts.where(op.level("n") >= least).count() <= most
    assert op.hot_level(counts, 1000) == 0


def test_parts_encode_as_in_their_text(both, texts):
    made = op.Tokenizers(P.path(op.VOCABULARY_A), P.path(op.VOCABULARY_B))
    assert made.can_cut and made.a_bytes[50256] == b""
    long = " ".join(t for t in texts if t and "▁" not in t) * 40
    words = op.Words(made, most=100)
    for text in [*texts[:50], long]:
        a, b, _, _ = words.texts([text, ""])
        assert a[0].tolist() == both[0].encode(" " + text, add_special_tokens=False).ids
        assert b[0].tolist() == both[1].encode(text)
        assert len(a[1]) == len(b[1]) == 0
    assert len(words.split(long)) > 50 and words.split("a  b\n c d") == ["a  b\n c", "d"]


def test_parts_with_white_space_at_their_ends(both):
    made = op.Tokenizers(P.path(op.VOCABULARY_A), P.path(op.VOCABULARY_B))
    # Encoded together with the text beside it, the space of one would become part of the other.
    for texts in (["end ", "two more"], ["a b ", " c", "  ", "d"], ["\xa0", "\xa0 é", "x\n", "\ny "], ["end \n", "\x1f z"]):
        a, b, _, _ = op.Words(made).texts(texts)
        assert [x.tolist() for x in a] == [both[0].encode(" " + t, add_special_tokens=False).ids for t in texts]
        assert [x.tolist() for x in b] == both[1].encode(texts)


def test_random_white_space(documents, both):
    dice = random.Random(11)
    words = ["end", "naïve", " ", "  ", "\n", "\t", "\xa0", "\u2028", "\x1f", "日本", "don't", "é"]
    texts = ["".join(w + dice.choice(["", " "]) for w in dice.choices(words, k=dice.randint(0, 8))) for _ in range(200)]
    rows = list(enumerate(texts))
    assert rows_of(op.aligned(documents(rows))) == sorted(brute(rows, both), key=str)


def test_overlaps_are_those_of_the_alignment():
    dice = np.random.default_rng(5)
    for total in (1, 2, 30, 500):
        cuts = [np.unique([*dice.integers(1, total + 1, total // 2), total]) for _ in range(2)]
        found = op.align(*[np.diff(c, prepend=0) for c in cuts])
        first, last = op.overlaps(*cuts)
        assert first.tolist() == found.first.tolist() and last.tolist() == found.last.tolist()
    none = np.zeros(0, dtype=np.int64)
    assert [len(x) for x in op.overlaps(none, none)] == [0, 0]


def test_alphabet():
    assert printable_bytes().items() <= op.byte_alphabet().items()
    assert sorted(op.byte_alphabet().values()) == list(range(256))


def test_pointers_of_long_chains():
    # Tokens that never end together but at the end: one group of any length.
    a = np.array([2] * 50_000 + [1])
    b = np.array([1] + [2] * 50_000)
    found = op.align(a, b)
    assert set(found.group_a) == set(found.group_b) == {50_000}
    dice = random.Random(1)
    for _ in range(300):
        total = dice.randint(1, 30)
        cuts = [sorted({*dice.sample(range(1, total + 1), dice.randint(0, total)), total}) for _ in range(2)]
        sizes = [np.diff([0, *c]) for c in cuts]
        found = op.align(*sizes)
        border = sorted(set(cuts[0]) & set(cuts[1]))
        assert [sum(e > x for x in border) for e in cuts[0]] == [len({g for g in found.group_a if g < h}) for h in found.group_a]
        for side, groups in ((0, found.group_a), (1, found.group_b)):
            assert [cuts[0][g] for g in groups] == [min(x for x in border if x >= e) for e in cuts[side]]
        spans = [[(c - s, c) for c, s in zip(x, y, strict=True)] for x, y in zip(cuts, sizes, strict=True)]
        expected = [(i, j) for i, (s, e) in enumerate(spans[0]) for j, (t, f) in enumerate(spans[1]) if s < f and t < e]
        assert [tuple(map(int, x)) for x in zip(*found.links(), strict=True)] == expected


def test_group_rows(documents, texts, monkeypatch):
    monkeypatch.setattr(op, "TOKENS", 50)
    found = op.tokens(documents(list(enumerate(texts))))
    by_doc = {}
    for r in op.group_rows(found).orderBy("doc_id", "group").collect():
        by_doc.setdefault(r.doc_id, []).append(r)
    for r in found.collect():
        groups = by_doc.get(r.doc_id, [])
        assert [g.group for g in groups] == list(range(r.n_groups))
        assert [i for g in groups for i in g.a] == r.a and [i for g in groups for i in g.b] == r.b
        written = ";".join(",".join(map(str, g.a)) + "|" + ",".join(map(str, g.b)) for g in groups)
        assert r.groups_sha256 == (hashlib.sha256(written.encode()).hexdigest() if groups else "")


def test_empty_table(documents):
    assert op.aligned(documents([])).collect() == []


def test_test_vocabulary_has_no_hidden_specials():
    with open(P.path(op.VOCABULARY_A), encoding="utf-8") as file:
        assert [t["id"] for t in json.load(file)["added_tokens"]] == [50256]

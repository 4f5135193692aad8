"""Alignment of two tokenizers' tokens over the bytes of each text.

Both token lists cover the same bytes, so a place where tokens of both end is a border. The
tokens between two borders are a group. Every token points to the token of the other list
that overlaps it and reaches farthest right; one that ends at a border points to itself, or to
its partner that does. Doubling the pointers takes every token to the last one of its group,
which is the group's label. Many texts are labelled together: their bytes lie end to end, and
the end of a text is a border.

How often two ids overlap is counted over the whole corpus. Tokens are encoded once and
stored; links are never stored, they are made again from the tokens where they are needed.
The most frequent id pairs go to the tasks as a table of bounded size, links of all other
pairs are shuffled to their counts.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetry_lake.llm.byte_bpe import local_path
from telemetry_lake.llm.tables import arrow_rows, stored, table

VOCABULARY_A = "byte_bpe_50k.json"
VOCABULARY_B = "piece_bpe_32k.model"
#: Characters of text that are taken together.
CHUNK = 1 << 20
#: Characters of distinct parts of texts that a task remembers.
REMEMBERED = 1 << 21
#: Parts that are encoded as one text.
TOGETHER = 64
#: Tokens whose links are held at once, unless one text has more.
TOKENS = 1 << 19
#: Texts that a task is handed at once.
ROWS = 500
#: The most id pairs that are sent to the tasks: 16 MB of numbers.
HOT_PAIRS = 1 << 20
_SINGLE_SPACE = re.compile(r"(?<=\S) (?=\S)")


def byte_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones for
    themselves, the others in ascending order from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def piece_bytes(piece: str, is_byte: bool) -> bytes:
    return bytes([int(piece[3:-1], 16)]) if is_byte else piece.replace("▁", " ").encode()


class Tokenizers:
    """The two tokenizers, and the bytes of each of their ids."""

    def __init__(self, path_a: str, path_b: str) -> None:
        # A task is one thread of its executor.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        alphabet = byte_alphabet()
        with open(path_a, encoding="utf-8") as file:
            special = {t["id"] for t in json.load(file)["added_tokens"]}
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for entry, i in self.a.get_vocab().items():
            if i not in special:
                self.a_bytes[i] = bytes(alphabet[c] for c in entry)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [piece_bytes(p, self.b.is_byte(i)) for i, p in enumerate(pieces)]
        self.a_sizes, self.b_sizes = _lengths(self.a_bytes), _lengths(self.b_bytes)
        # Only then does a space between other characters always begin a token.
        self.can_cut = not any(re.search("[^▁]▁", p) for p in pieces)

    def encode(self, texts: list[str]) -> list[tuple[list[int], list[int]]]:
        """Ids of both tokenizers per text, none where their bytes are not those of the text."""
        spaced = [" " + t for t in texts]
        # Without the offsets, which nobody reads.
        of_a = [e.ids for e in self.a.encode_batch_fast(spaced, add_special_tokens=False)]
        of_b = self.b.encode(texts, num_threads=1)
        out: list[tuple[list[int], list[int]]] = []
        for text, a, b in zip(spaced, of_a, of_b, strict=True):
            data = text.encode()
            same = b"".join(map(self.a_bytes.__getitem__, a)) == data
            same = same and b"".join(map(self.b_bytes.__getitem__, b)) == data
            out.append((a, b) if same else ([], []))
        return out


def _joined(lists: list[list[int]]) -> np.ndarray:
    return np.fromiter(chain.from_iterable(lists), dtype=np.int64)


class Words:
    """Encoded and aligned parts of texts, each distinct one done once.

    A part is what lies between two single spaces that have other characters on both sides.
    Such a space begins a token of both tokenizers, so parts encode on their own as they do in
    their text, and borders lie between them. The parts are forgotten when there are many.
    """

    def __init__(self, both: Tokenizers, most: int = REMEMBERED) -> None:
        self.both, self.most = both, most
        self.writer = GroupText(len(both.a_bytes), len(both.b_bytes))
        self.forget()

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.held = 0
        self.ids = [array("i"), array("i")]
        self.ends = [array("q", [0]), array("q", [0])]
        self.groups = array("q")
        self.written: list[str] = []

    def split(self, text: str) -> list[str]:
        if not text:
            return []
        return _SINGLE_SPACE.split(text) if self.both.can_cut else [text]

    def learn(self, parts: list[list[str]]) -> None:
        new = [w for w in dict.fromkeys(chain.from_iterable(parts)) if w not in self.index]
        for some in _chunks(new, CHUNK // 4):
            # Many parts make one text to encode, unless one of them does not come back. White space at
            # an end of a part, as at an end of a text, would join the one beside it.
            alone = [w for w in some if w[0].isspace() or w[-1].isspace()]
            apart = set(alone)
            inner = [w for w in some if w not in apart] if alone else some
            together = [inner[i : i + TOGETHER] for i in range(0, len(inner), TOGETHER)]
            known, lists = [], ([], [])
            for words, (a, b) in zip(together, self._encoded(together), strict=True):
                if a:
                    known += words
                    lists[0].append(a)
                    lists[1].append(b)
                else:
                    alone += words
            for word, (a, b) in zip(alone, self.both.encode(alone), strict=True):
                if a:
                    known.append(word)
                    lists[0].append(a)
                    lists[1].append(b)
                else:
                    self._add([word], np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64))
            self._add(known, _joined(lists[0]), _joined(lists[1]))
            self.held += sum(len(w) for w in some)

    def _encoded(self, together: list[list[str]]) -> list[tuple[list[int], list[int]]]:
        if not self.both.can_cut:
            return [([], [])] * len(together)
        return self.both.encode([" ".join(words) for words in together])

    def _add(self, words: list[str], a: np.ndarray, b: np.ndarray) -> None:
        """Take in parts and the tokens that they have together."""
        found = align(self.both.a_sizes[a], self.both.b_sizes[b])
        # A part and the space before it end where tokens of both end; none at all has no place.
        ends = np.cumsum([len(w.encode()) + 1 for w in words] if len(a) else [0] * len(words))
        cut_a = np.searchsorted(np.cumsum(self.both.a_sizes[a]), ends, "right")
        cut_b = np.searchsorted(np.cumsum(self.both.b_sizes[b]), ends, "right")
        spelled = self.writer.sequence(a, b, found).tolist()
        spelled = list(map(self.writer.words.__getitem__, spelled))
        groups = np.cumsum(np.concatenate([[0], found.group_a == np.arange(len(a))]))[cut_a]
        self.index.update(zip(words, range(len(self.written), len(self.written) + len(words)), strict=True))
        cuts = [0, *(cut_a + cut_b).tolist()]
        # The last separator is put back where parts are joined.
        self.written += ["".join(spelled[x:y])[:-1] for x, y in zip(cuts, cuts[1:], strict=False)]
        for side, (ids, cut) in enumerate(((a, cut_a), (b, cut_b))):
            self.ends[side].extend((cut + self.ends[side][-1]).tolist())
            self.ids[side].extend(ids.tolist())
        self.groups.extend(np.diff(groups, prepend=0).tolist())

    def texts(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray], list[int], list[str]]:
        """Per text its A ids, B ids, number of groups and digest."""
        if self.held > self.most:
            self.forget()
        parts = [self.split(t) for t in texts]
        self.learn(parts)
        ids = [np.array(x, dtype=np.int32) for x in self.ids]
        ends = [np.array(x, dtype=np.int64) for x in self.ends]
        groups = np.array(self.groups, dtype=np.int64)
        out: tuple = ([], [], [], [])
        for some in parts:
            which = np.fromiter(map(self.index.__getitem__, some), dtype=np.int64, count=len(some))
            sizes = [e[which + 1] - e[which] for e in ends]
            if (sizes[0] == 0).any():
                which, sizes = which[:0], [x[:0] for x in sizes]
            for side in (0, 1):
                n = sizes[side]
                place = np.arange(n.sum()) + np.repeat(ends[side][which] - (np.cumsum(n) - n), n)
                out[side].append(ids[side][place])
            out[2].append(int(groups[which].sum()))
            written = ";".join(map(self.written.__getitem__, which.tolist()))
            out[3].append(hashlib.sha256(written.encode()).hexdigest() if written else "")
        return out


def _chunks(texts: list[str], size: int) -> Iterator[list[str]]:
    held, total = [], 0
    for text in texts:
        if held and total + len(text) > size:
            yield held
            held, total = [], 0
        held.append(text)
        total += len(text)
    if held:
        yield held


@lru_cache(maxsize=2)
def _tokenizers(path_a: str, path_b: str) -> Tokenizers:
    return Tokenizers(path_a, path_b)


def _lengths(data: list[bytes]) -> np.ndarray:
    return np.array([len(x) for x in data], dtype=np.int64)


@dataclass(frozen=True)
class Alignment:
    """``group_a`` and ``group_b``: per token the index of the last A token of its group.
    ``first`` and ``last``: per A token the B tokens that overlap it."""

    group_a: np.ndarray
    group_b: np.ndarray
    first: np.ndarray
    last: np.ndarray

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """(A token, B token) of every overlapping pair, in order."""
        return links(self.first, self.last)


def links(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = last - first + 1
    a = np.repeat(np.arange(len(n)), n)
    return a, np.arange(len(a)) + np.repeat(first - (np.cumsum(n) - n), n)


def overlaps(a_end: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per A token the first and the last B token that overlap it."""
    if not len(a_end):
        return a_end, a_end
    # For every byte, how many B tokens end up to it: cheaper than a search for every A token.
    up_to = np.cumsum(np.bincount(b_end, minlength=a_end[-1] + 1))
    return up_to[np.concatenate([[0], a_end[:-1]])], up_to[a_end - 1]


def align(a_sizes: np.ndarray, b_sizes: np.ndarray) -> Alignment:
    """Align two lists of tokens, each of one byte or more, that cover the same bytes."""
    a_end, b_end = np.cumsum(a_sizes), np.cumsum(b_sizes)
    a_start, b_start = a_end - a_sizes, b_end - b_sizes
    reach_a = np.searchsorted(b_start, a_end, "left") - 1
    reach_b = np.searchsorted(a_start, b_end, "left") - 1
    n = len(a_end)
    closed = b_end[reach_a] == a_end if n else np.zeros(0, dtype=bool)
    # The token pointed to never ends earlier, and at a border the A token stands still.
    successor = np.concatenate([np.where(closed, np.arange(n), n + reach_a), reach_b])
    while True:
        doubled = successor[successor]
        if np.array_equal(doubled, successor):
            break
        successor = doubled
    return Alignment(successor[:n], successor[n:], np.searchsorted(b_end, a_start, "right"), reach_a)


class GroupText:
    """Writes groups as ``a1,a2|b1;a3|b2,b3``."""

    def __init__(self, ids_a: int, ids_b: int) -> None:
        a, b = ([str(i) for i in range(n)] for n in (ids_a, ids_b))
        self.shift = np.cumsum([0, ids_a, ids_a, ids_b])
        self.words = [x + s for ids, s in ((a, ","), (a, "|"), (b, ","), (b, ";")) for x in ids]

    def sequence(self, a: np.ndarray, b: np.ndarray, found: Alignment) -> np.ndarray:
        """Indexes of the words to join, over all texts of a chunk."""
        last_a = found.group_a == np.arange(len(a))
        last_b = np.diff(found.group_b, append=-1) != 0
        out = np.empty(len(a) + len(b), dtype=np.int64)
        # The tokens of earlier groups, and the A tokens of its own, come before a token.
        at_a = np.arange(len(a)) + np.searchsorted(found.group_b, found.group_a, "left")
        out[at_a] = a + np.where(last_a, self.shift[1], self.shift[0])
        out[np.arange(len(b)) + found.group_b + 1] = b + np.where(last_b, self.shift[3], self.shift[2])
        return out


@lru_cache(maxsize=2)
def _words(path_a: str, path_b: str) -> Words:
    return Words(_tokenizers(path_a, path_b))


def _listed(lists: list[np.ndarray]) -> pa.ListArray:
    offsets = np.cumsum([0, *(len(x) for x in lists)])
    flat = np.concatenate(lists) if lists else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat.astype(np.int32)))


def tokens(docs: DataFrame, vocabulary_a: str = VOCABULARY_A, vocabulary_b: str = VOCABULARY_B) -> DataFrame:
    """(row, doc_id, a, b, n_groups, groups_sha256): ids of both tokenizers per row of ``docs``.

    A null or empty text, and one whose bytes a tokenizer does not give back, has no tokens.
    ``row`` numbers the rows, as ids may repeat; store the table to keep it.
    """
    source = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    id_type = source.schema["doc_id"].dataType.simpleString()

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _words(local_path(vocabulary_a), local_path(vocabulary_b))
        for batch in batches:
            begin = 0
            for texts in _chunks(batch.column("text").to_pylist(), CHUNK):
                a, b, groups, digests = words.texts(texts)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(begin, len(texts)),
                        _listed(a),
                        _listed(b),
                        pa.array(groups, pa.int64()),
                        pa.array(digests, pa.string()),
                    ],
                    ["doc_id", "a", "b", "n_groups", "groups_sha256"],
                )
                begin += len(texts)

    ddl = f"doc_id {id_type}, a array<int>, b array<int>, n_groups bigint, groups_sha256 string"
    return source.mapInArrow(of, ddl).withColumn("row", F.monotonically_increasing_id())


def _token_slices(batch: pa.RecordBatch, most: int = 0) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray], list[np.ndarray]]]:
    """Slices of a batch with a bounded number of tokens (one text is never cut): the slice,
    and per list column its offsets and values."""
    most = most or TOKENS
    sizes = np.diff(batch.column("a").offsets.to_numpy())
    begin = 0
    while begin < len(sizes):
        total = np.cumsum(sizes[begin:])
        n = max(1, int(np.searchsorted(total, most, "right")))
        part = batch.slice(begin, n)
        columns = []
        for name in ("a", "b"):
            offsets = part.column(name).offsets.to_numpy()
            values = part.column(name).values.to_numpy(zero_copy_only=False)
            columns.append((offsets - offsets[0], values[offsets[0] : offsets[-1]].astype(np.int64)))
        yield part, [columns[0][0], columns[1][0]], [columns[0][1], columns[1][1]]
        begin += n


def _pairs(ids: list[np.ndarray], both: Tokenizers) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A token and packed id pair of every link of a slice, and the number of links per A token."""
    first, last = overlaps(np.cumsum(both.a_sizes[ids[0]]), np.cumsum(both.b_sizes[ids[1]]))
    a, b = links(first, last)
    return a, ids[0][a] << 32 | ids[1][b], last - first + 1


def group_rows(
    found: DataFrame, vocabulary_a: str = VOCABULARY_A, vocabulary_b: str = VOCABULARY_B
) -> DataFrame:
    """(doc_id, group, a, b): one row per group of ``tokens``, in order from 0, with its ids."""
    id_type = found.schema["doc_id"].dataType.simpleString()

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = _tokenizers(local_path(vocabulary_a), local_path(vocabulary_b))
        for batch in batches:
            for part, (at_a, _), ids in _token_slices(batch):
                aligned = align(both.a_sizes[ids[0]], both.b_sizes[ids[1]])
                last = np.flatnonzero(aligned.group_a == np.arange(len(ids[0])))
                doc = np.searchsorted(at_a, last, "right") - 1
                first = np.searchsorted(doc, doc, "left")
                cut_a = np.concatenate([[0], last + 1])
                cut_b = np.concatenate([[0], np.searchsorted(aligned.group_b, last, "right")])
                lists = [
                    pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(x.astype(np.int32)))
                    for cut, x in ((cut_a, ids[0]), (cut_b, ids[1]))
                ]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(doc)), pa.array(np.arange(len(doc)) - first), *lists],
                    ["doc_id", "group", "a", "b"],
                )

    return found.select("doc_id", "a", "b").mapInArrow(
        of, f"doc_id {id_type}, group bigint, a array<int>, b array<int>"
    )


def pair_counts(
    found: DataFrame, vocabulary_a: str = VOCABULARY_A, vocabulary_b: str = VOCABULARY_B
) -> DataFrame:
    """(pair, n): links of every id pair over all ``tokens``; ``pair`` is the A id times 2^32
    plus the B id. Links are added up in the tasks before they are shuffled."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = _tokenizers(local_path(vocabulary_a), local_path(vocabulary_b))
        for batch in batches:
            for _, _, ids in _token_slices(batch):
                pairs, n = np.unique(_pairs(ids, both)[1], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(n)], ["pair", "n"])

    counted = found.select("a", "b").mapInArrow(of, "pair bigint, n bigint")
    return counted.groupBy("pair").agg(F.sum("n").alias("n"))


def with_best(counts: DataFrame) -> DataFrame:
    """``best``: whether a pair's count is the highest of its B id."""
    b = F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))
    most = counts.groupBy(b.alias("b")).agg(F.max("n").alias("most"))
    return counts.withColumn("b", b).join(most, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def hot_level(counts: DataFrame, most: int = HOT_PAIRS) -> int:
    """The least level (log of the count) from which on there are no more than ``most`` pairs."""
    levels = counts.groupBy(level("n").alias("level")).agg(F.count("*").alias("pairs")).collect()
    total, least = 0, 1 << 20
    for row in sorted(levels, key=lambda r: -r["level"]):
        total += row["pairs"]
        if total > most:
            break
        least = row["level"]
    return least


def level(n: str) -> Column:
    """At most a thousand levels, whatever the counts."""
    return F.floor(F.log2(n) * 16).cast("int")


def aligned(
    docs: DataFrame,
    vocabulary_a: str = VOCABULARY_A,
    vocabulary_b: str = VOCABULARY_B,
    hot_pairs: int = HOT_PAIRS,
) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) per row of ``docs``.

    ``n_best`` are the links whose id pair is the most frequent of its B id over the corpus,
    ties included; ``count_sum`` adds up the counts of all links. Rows are counted as they
    are: a repeated row, or one without an id, counts like any other. Texts that are null,
    empty, or not given back by both tokenizers have no tokens: zeros and an empty digest. Very long texts
    are encoded part by part, between single spaces. An empty table gives no rows; other columns of ``docs`` play no part.
    """
    spark = docs.sparkSession
    with arrow_rows(spark, ROWS):
        found = stored(tokens(docs, vocabulary_a, vocabulary_b), "aligned-tokens")
        counts = stored(pair_counts(found, vocabulary_a, vocabulary_b), "aligned-counts")
    judged = stored(with_best(counts).withColumn("level", level("n")), "aligned-pairs")
    least = hot_level(counts, hot_pairs)
    # At most ``hot_pairs`` rows.
    hot = judged.where(F.col("level") >= least).select("pair", "n", "best").toArrow()
    order = np.argsort(hot.column("pair").to_numpy())
    numbers = [hot.column(c).to_numpy()[order] for c in ("pair", "n", "best")]
    known = spark.sparkContext.broadcast((numbers[0], np.where(numbers[2], -numbers[1], numbers[1])))
    id_type = found.schema["doc_id"].dataType.simpleString()

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = _tokenizers(local_path(vocabulary_a), local_path(vocabulary_b))
        keys, signed = known.value
        for batch in batches:
            for part, (at_a, at_b), ids in _token_slices(batch):
                a, pairs, linked = _pairs(ids, both)
                different, which = np.unique(pairs, return_inverse=True)
                place = np.minimum(np.searchsorted(keys, different), max(len(keys) - 1, 0))
                hit = keys[place] == different if len(keys) else np.zeros(len(different), dtype=bool)
                value = np.zeros(len(different), dtype=np.int64)
                value[hit] = signed[place[hit]]
                # Links of a text are neighbours, so its sums are differences of running sums.
                ends = np.concatenate([[0], np.cumsum(linked)])[at_a]
                sums = np.concatenate([[0], np.cumsum(np.abs(value)[which])])[ends]
                best = np.concatenate([[0], np.cumsum(value[which] < 0)])[ends]
                rest = np.flatnonzero(~hit[which])
                doc = np.searchsorted(at_a, a[rest], "right") - 1
                offsets = pa.array(np.searchsorted(doc, np.arange(part.num_rows + 1)), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("row"),
                        part.column("doc_id"),
                        pa.array(np.diff(at_a).astype(np.int64)),
                        pa.array(np.diff(at_b).astype(np.int64)),
                        part.column("n_groups"),
                        pa.array(np.diff(ends)),
                        pa.array(np.diff(best)),
                        pa.array(np.diff(sums)),
                        part.column("groups_sha256"),
                        pa.ListArray.from_arrays(offsets, pa.array(pairs[rest])),
                    ],
                    ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "rest"],
                )

    ddl = (
        f"row bigint, doc_id {id_type}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint,"
        " count_sum bigint, groups_sha256 string, rest array<bigint>"
    )
    columns = found.select("row", "doc_id", "a", "b", "n_groups", "groups_sha256")
    with arrow_rows(spark, ROWS):
        looked_up = stored(columns.mapInArrow(of, ddl), "aligned-known")
    rare = looked_up.select("row", F.explode("rest").alias("pair")).groupBy("row", "pair").agg(F.count("*").alias("times"))
    later = (
        rare.join(judged.where(F.col("level") < least), "pair")
        .groupBy("row")
        .agg(
            F.sum(F.col("n") * F.col("times")).alias("more_sum"),
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"),
        )
    )
    none = F.lit(0)
    return looked_up.drop("rest").join(later, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        (F.col("n_best") + F.coalesce("more_best", none)).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", none)).alias("count_sum"),
        "groups_sha256",
    )


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aligned(table(spark, sf_dir, "documents")).select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256",
    )

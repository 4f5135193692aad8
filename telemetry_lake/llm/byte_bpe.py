"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

A pre-token starts as its bytes and merges the pair of neighbours of the lowest rank, the
leftmost first, until no pair has a rank. The queue of pairs has one bucket of linked-list
positions per merge rank and a tree of bitmaps over the buckets: find-first-set from the top
word down picks the next rank. A pair that has changed since it was queued is stale and is
skipped when its bucket is taken. One queue serves many pre-tokens at once, laid end to end
with no pair across a border; a bucket's positions are merged together with numpy, so one
very long pre-token and very many short ones cost alike, near the number of merges.

Texts are taken in groups of bounded size, and each distinct pre-token of a group is encoded
once.
"""

from __future__ import annotations

import base64
import hashlib
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetry_lake.llm.tables import table

#: Characters of text whose pre-tokens are encoded together.
GROUP_CHARS = 8_000_000
#: Pre-tokens of one text that are held at once.
GROUP_PIECES = 200_000
_NONE = -1


class RankQueue:
    """Positions by rank; the lowest rank that has any comes out first."""

    def __init__(self, ranks: int) -> None:
        self.levels: list[list[int]] = []
        while not self.levels or len(self.levels[-1]) > 1:
            ranks = (ranks + 63) // 64
            self.levels.append([0] * ranks)
        self.buckets: dict[int, list[np.ndarray]] = {}

    def push(self, rank: int, positions: np.ndarray) -> None:
        bucket = self.buckets.get(rank)
        if bucket is not None:
            bucket.append(positions)
            return
        self.buckets[rank] = [positions]
        at = rank
        for words in self.levels:
            word, bit = at >> 6, 1 << (at & 63)
            empty = words[word] == 0
            words[word] |= bit
            if not empty:
                return
            at = word

    def push_all(self, ranks: np.ndarray, positions: np.ndarray) -> None:
        if len(ranks) == 0:
            return
        small = ranks.max() < 1 << 16
        order = np.argsort(ranks.astype(np.uint16) if small else ranks, kind="stable")
        ranks, positions = ranks[order], positions[order]
        cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
        starts = [0, *cuts.tolist(), len(ranks)]
        for rank, a, b in zip(ranks[starts[:-1]].tolist(), starts, starts[1:], strict=False):
            self.push(rank, positions[a:b])

    def pop(self) -> tuple[int, np.ndarray] | None:
        """The lowest rank and its positions in order; nothing if the queue is empty."""
        at = 0
        for words in reversed(self.levels):
            word = words[at]
            if word == 0:
                return None
            at = at << 6 | (word & -word).bit_length() - 1
        rank = at
        for words in self.levels:
            words[at >> 6] &= ~(1 << (at & 63))
            if words[at >> 6]:
                break
            at >>= 6
        found = self.buckets.pop(rank)
        return rank, (np.unique(np.concatenate(found)) if len(found) > 1 else np.sort(found[0]))


class Encoder:
    """Encodes pre-tokens and decodes ids by a table of ranks."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.ranks = ranks
        self.pattern = regex.compile(pattern)
        self.size = max(ranks.values()) + 1
        self.token = [b""] * self.size
        for token, rank in ranks.items():
            self.token[rank] = token
        self.decimal = [str(n) for n in range(self.size)]
        self.byte_id = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        pairs = [
            (left << 32 | right, rank)
            for token, rank in ranks.items()
            for i in range(1, len(token))
            if (left := ranks.get(token[:i])) is not None and (right := ranks.get(token[i:])) is not None
        ]
        keys = np.array(pairs, dtype=np.int64).reshape(-1, 2)
        order = np.argsort(keys[:, 0])
        self.keys, self.merged = keys[order, 0], keys[order, 1]
        #: Ranks of pairs of bytes, which every pre-token starts from.
        self.byte_pairs = self.pair_ranks(*map(np.ravel, np.meshgrid(self.byte_id, self.byte_id, indexing="ij")))

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.merged[at], _NONE) if len(self.keys) else np.full(len(key), _NONE)

    def merge(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces in order by merging from their bytes, and how many each has."""
        lengths = np.array([len(p) for p in pieces], dtype=np.int64)
        data = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        ids = self.byte_id[data]
        n = len(ids)
        ends = np.cumsum(lengths)
        after = np.arange(1, n + 1)
        before = np.arange(-1, n - 1)
        full = lengths > 0
        after[ends[full] - 1] = _NONE
        before[(ends - lengths)[full]] = _NONE
        alive, looked = np.ones(n, dtype=bool), np.zeros(n, dtype=bool)
        rank_of = np.full(n, _NONE, dtype=np.int64)
        queue = RankQueue(self.size)

        def look(at: np.ndarray) -> None:
            """Ranks and queues the pairs that start at some places."""
            paired = at[after[at] != _NONE]
            rank_of[at] = _NONE
            rank_of[paired] = self.pair_ranks(ids[paired], ids[after[paired]])
            ranked = paired[rank_of[paired] != _NONE]
            queue.push_all(rank_of[ranked], ranked)

        first = np.flatnonzero(after != _NONE)
        rank_of[first] = self.byte_pairs[data[first].astype(np.int64) << 8 | data[first + 1]]
        first = first[rank_of[first] != _NONE]
        queue.push_all(rank_of[first], first)
        while (taken := queue.pop()) is not None:
            rank, at = taken
            at = at[alive[at] & (rank_of[at] == rank)]  # the rest is stale
            if len(at) > 1:
                at = self._leftmost(at, after)
            if len(at) == 0:
                continue
            gone = after[at]
            ids[at] = rank
            alive[gone] = False
            following = after[gone]
            after[at] = following
            has = following != _NONE
            before[following[has]] = at[has]
            left = before[at]
            left = left[left != _NONE]
            looked[at] = True
            again = np.concatenate([at, left[~looked[left]]])
            looked[at] = False
            look(again)
        kept = np.flatnonzero(alive)
        return ids[kept], np.diff(np.searchsorted(kept, ends), prepend=0)

    @staticmethod
    def _leftmost(at: np.ndarray, after: np.ndarray) -> np.ndarray:
        """Of pairs that overlap in a row, every other one from the left."""
        joined = np.zeros(len(at), dtype=bool)
        joined[1:] = after[at[:-1]] == at[1:]
        if not joined.any():
            return at
        start = np.maximum.accumulate(np.where(joined, 0, np.arange(len(at))))
        return at[(np.arange(len(at)) - start) % 2 == 0]

    def distinct_ids(self, pieces: Iterable[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces one after another, and where those of each piece begin and end."""
        data = [piece.encode() for piece in pieces]
        ranks = np.fromiter((self.ranks.get(d, _NONE) for d in data), np.int64, len(data))
        whole = ranks != _NONE
        merged, counts = self.merge([data[i] for i in np.flatnonzero(~whole).tolist()])
        lengths = np.ones(len(data), dtype=np.int64)
        lengths[~whole] = counts
        ends = np.cumsum(np.concatenate([[0], lengths]))
        is_whole = np.repeat(whole, lengths)
        ids = np.empty(int(ends[-1]), dtype=np.int32)
        ids[is_whole], ids[~is_whole] = ranks[whole], merged
        return ids, ends

    def pieces(self, text: str) -> Iterator[list[str]]:
        """The pre-tokens of a text, in lists of bounded length."""
        if len(text) <= GROUP_PIECES:
            yield self.pattern.findall(text)
            return
        matches = self.pattern.finditer(text)
        while some := [m.group() for m in islice(matches, GROUP_PIECES)]:
            yield some

    def groups(self, texts: list[str]) -> Iterator[Group]:
        """Texts, or parts of a very long one, in groups of about ``GROUP_CHARS``."""
        group, size = Group(self), 0
        for number, text in enumerate(texts):
            for pieces in self.pieces(text):
                group.add(number, pieces)
                size += sum(map(len, pieces)) if len(text) > GROUP_PIECES else len(text)
                if size > GROUP_CHARS:
                    yield group
                    group, size = Group(self), 0
        yield group

    def encode(self, text: str) -> list[int]:
        return [i for group in self.groups([text]) for _, part in group.encoded() for i in part.ids.tolist()]

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


@dataclass
class Part:
    """What a text, or a part of one, is encoded to, and what its ids decode to."""

    count: int
    ids: np.ndarray | None
    decimals: str
    decoded: bytes


class Group:
    """Pre-tokens of several texts; each distinct one is encoded once."""

    def __init__(self, encoder: Encoder) -> None:
        self.encoder = encoder
        self.number: defaultdict[str, int] = defaultdict()
        self.number.default_factory = self.number.__len__
        self.texts: list[tuple[int, np.ndarray]] = []

    def add(self, text: int, pieces: list[str]) -> None:
        numbers = np.fromiter(map(self.number.__getitem__, pieces), np.int32, len(pieces))
        self.texts.append((text, numbers))

    def encoded(self, with_ids: bool = True) -> Iterator[tuple[int, Part]]:
        encoder = self.encoder
        ids, ends = encoder.distinct_ids(self.number)
        listed, cuts = ids.tolist(), ends.tolist()
        each = [listed[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
        decimals = [",".join(map(encoder.decimal.__getitem__, x)) for x in each]
        decoded = [encoder.decode(x) for x in each]
        del listed, each
        lengths = np.diff(ends)
        for text, numbers in self.texts:
            counts = lengths[numbers]
            total, picked = int(counts.sum()), numbers.tolist()
            # The place of each id: where its piece begins, and how far into the piece it is.
            if with_ids:
                begin = np.cumsum(counts) - counts
                at = np.repeat(ends[:-1][numbers] - begin, counts) + np.arange(total)
            yield text, Part(
                total,
                ids[at] if with_ids else None,
                ",".join(map(decimals.__getitem__, picked)),
                b"".join(map(decoded.__getitem__, picked)),
            )


def read_ranks(path: str) -> dict[bytes, int]:
    """A table of ranks: a line for each token, its bytes in base 64 and its rank."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


@lru_cache(maxsize=2)
def _worker_encoder(path: str, pattern: str) -> Encoder:
    return Encoder(read_ranks(path), pattern)


def local_path(name: str) -> str:
    """A vocabulary file of the installed public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path(name)


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def encode_table(
    docs: DataFrame,
    vocabulary: str = "byte_bpe_multi_50k.tiktoken",
    pattern: str | None = None,
    with_ids: bool = True,
) -> DataFrame:
    """(doc_id, ids, n_tokens, ids_sha256, decoded_sha256) per row of ``docs``.

    ``decoded_sha256`` is of the bytes that the ids decode to. Without ``with_ids`` the ids
    stay in the task and the column is left out.

    ``vocabulary``: a file name of the public tokenizers, which every worker has installed,
    or the name of a file given to the session with ``addFile``. A null text is encoded as an
    empty one: no ids. Rows are kept as they are, repeated ones and null ids included, and an
    empty table gives none. Other columns, whatever their names, are left out.
    """
    source = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    id_type = source.schema["doc_id"].dataType.simpleString()
    split = pattern or default_pattern()

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            path = local_path(vocabulary)
        except (KeyError, FileNotFoundError, ValueError):
            path = SparkFiles.get(vocabulary)
        encoder = _worker_encoder(path, split)
        for whole in batches:
            # Ids take more memory than their text, so few rows go on at a time.
            for batch in small_batches(whole, "text", 2 * GROUP_CHARS):
                rows = batch.num_rows
                ids: list[list[np.ndarray]] = [[] for _ in range(rows)]
                counts = [0] * rows
                digests, decoded = ([hashlib.sha256() for _ in range(rows)] for _ in range(2))
                for group in encoder.groups(batch.column("text").to_pylist()):
                    for row, part in group.encoded(with_ids):
                        if part.count == 0:
                            continue
                        digests[row].update(("," * bool(counts[row]) + part.decimals).encode())
                        decoded[row].update(part.decoded)
                        counts[row] += part.count
                        if with_ids:
                            ids[row].append(part.ids)
                out = {
                    "doc_id": batch.column("doc_id"),
                    "n_tokens": pa.array(counts, pa.int64()),
                    "ids_sha256": pa.array([x.hexdigest() for x in digests], pa.string()),
                    "decoded_sha256": pa.array([x.hexdigest() for x in decoded], pa.string()),
                }
                if with_ids:
                    flat = [x for parts in ids for x in parts]
                    values = pa.array(np.concatenate(flat) if flat else np.zeros(0, dtype=np.int32))
                    offsets = pa.array(np.cumsum([0, *counts]), pa.int32())
                    out["ids"] = pa.ListArray.from_arrays(offsets, values)
                yield pa.RecordBatch.from_pydict(out)

    listed = ", ids array<int>" if with_ids else ""
    return source.mapInArrow(
        of, f"doc_id {id_type}, n_tokens bigint, ids_sha256 string, decoded_sha256 string{listed}"
    )


def small_batches(batch: pa.RecordBatch, column: str, most: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``most`` bytes of a text column; a longer text is alone."""
    sizes = np.array([x.as_buffer().size if x.is_valid else 0 for x in batch.column(column)], dtype=np.int64)
    begin, total = 0, 0
    for i, size in enumerate(sizes):
        if i > begin and total + size > most:
            yield batch.slice(begin, i - begin)
            begin, total = i, 0
        total += size
    if begin < batch.num_rows:
        yield batch.slice(begin)


def decode_table(encoded: DataFrame, vocabulary: str = "byte_bpe_multi_50k.tiktoken") -> DataFrame:
    """(doc_id, data) per row of (doc_id, ids): the bytes that the ids stand for; null for null."""
    id_type = encoded.schema["doc_id"].dataType.simpleString()

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _worker_encoder(local_path(vocabulary), default_pattern())
        for batch in batches:
            data = [None if x is None else encoder.decode(x) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(data, pa.binary())], ["doc_id", "data"])

    return encoded.select("doc_id", "ids").mapInArrow(of, f"doc_id {id_type}, data binary")


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_table(table(spark, sf_dir, "documents"), with_ids=False)

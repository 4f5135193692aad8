"""Document fingerprints by SimHash, and a search for near ones by permuted block tables.

Terms are pairs of neighbouring words; each votes with the weight of its length on the 64
bits of its hash, for a set bit or against it, and the sign of the sum is the bit.

To find all fingerprints within a radius, the bits are cut into blocks. If at most ``radius``
bits differ, some choice of the other blocks is equal; there is one table for each choice,
keyed by the chosen blocks' bits, which are moved to the front.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetry_lake.llm.simhash_dedup import word_blocks
from telemetry_lake.llm.tables import shuffle_width, stored, table, text_key

TERM_WORDS = 2
MOST_WEIGHT = 24
RADIUS = 3
BLOCKS = 6
#: Every so many ids are looked up among all fingerprints.
QUERY_EVERY = 50


def _terms(words: list[bytes]) -> list[bytes]:
    return [b" ".join(pair) for pair in zip(*(words[i:] for i in range(TERM_WORDS)), strict=False)]


def fingerprint(text: str, block: int = 1 << 20) -> int:
    """Signed 64 bits; a text of one word has that word as its only term, no words give 0."""
    votes = np.zeros(64, dtype=np.int64)
    kept: list[bytes] = []
    n = 0
    for words in word_blocks(text.encode().lower(), block):
        kept += words
        terms = _terms(kept)
        for part in (terms[k : k + 65536] for k in range(0, len(terms), 65536)):
            votes += _votes(part)
            n += len(part)
        kept = kept[-(TERM_WORDS - 1) :]
    if n == 0 and kept:
        votes += _votes([b" ".join(kept)])
    return int(np.packbits(votes > 0, bitorder="little").view("<i8")[0])


def _votes(terms: list[bytes]) -> np.ndarray:
    hashes = np.array([xxhash.xxh64_intdigest(t) for t in terms], dtype=np.uint64)
    weights = np.minimum(np.fromiter(map(len, terms), np.float32, len(terms)), MOST_WEIGHT)
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    # Sums of at most 65536 * 24 are exact in float32.
    return (2 * (weights @ bits.astype(np.float32)) - weights.sum()).astype(np.int64)


def likeness(a: int, b: int) -> float:
    """The share of equal bits."""
    return 1 - ((a ^ b) & (1 << 64) - 1).bit_count() / 64


_OUT = (
    "n_chars bigint, edited_sha256 string, fp bigint, edited_fp bigint, near_edited double, near_next double,"
    " part int, edge string, text string"
)


class _Rows:
    """Finished rows and rows at the edges of a partition, as columns."""

    def __init__(self, id_type: pa.DataType) -> None:
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int32(), pa.string(), pa.string()]
        names = [c.strip().split(" ")[0] for c in _OUT.split(",")]
        self.schema = pa.schema([("doc_id", id_type), *zip(names, kinds, strict=True)])
        self.rows: list[tuple] = []

    def done(self, doc_id, text: str, fp: int, after: str, after_fp: int) -> None:
        k = len(text) // 4
        edited = text[: len(text) - k] + after[:k]
        edited_fp = fingerprint(edited) if k else fp
        digest = hashlib.sha256(edited.encode()).hexdigest()
        self.rows.append((doc_id, len(text), digest, fp, edited_fp, likeness(fp, edited_fp), likeness(fp, after_fp), None, None, None))

    def edge(self, doc_id, text: str, fp: int, part: int, edge: str) -> None:
        self.rows.append((doc_id, None, None, fp, None, None, None, part, edge, text))

    def batch(self) -> pa.RecordBatch:
        columns = zip(*self.rows, strict=True) if self.rows else [[] for _ in self.schema]
        out = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, self.schema, strict=True)], schema=self.schema)
        self.rows = []
        return out


def _within_partition(batches: Iterator[pa.RecordBatch], id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    """Finishes all rows but the last, which needs the first row of the next partition."""
    out, before = _Rows(id_type), None
    part, size = None, 0
    for batch in batches:
        for doc_id, text, number in zip(*(batch.column(n) for n in ("doc_id", "text", "part")), strict=True):
            row = (doc_id.as_py(), text.as_py(), fingerprint(text.as_py()))
            if before is None:
                part = number.as_py()
                out.edge(*row, part, "first")
            else:
                out.done(*before, row[1], row[2])
            before = row
            size += 1
            if size % 500 == 0:
                yield out.batch()
    if before is not None:
        out.edge(*before, part, "last")
        yield out.batch()


def with_next(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fp, edited_fp, near_edited, near_next) per row.

    The next document follows by ascending id; null ids come first, rows of one id go by a
    hash of their text. The last document is followed by the first. A null text is empty, and a
    long one is hashed block by block, with the same result. Repeated rows stay rows of their own, an
    empty table gives no rows, and other columns, whatever their names, are left out.
    """
    source = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), text_key("text").alias("key"))
    id_type = source.schema["doc_id"].dataType.simpleString()
    arrow_type = source.select("doc_id").limit(0).toArrow().schema.field(0).type
    cut = (
        source.repartitionByRange(shuffle_width(docs.sparkSession), "doc_id", "key")
        .sortWithinPartitions("doc_id", "key")
        .select("doc_id", "text", F.spark_partition_id().alias("part"))
        .mapInArrow(lambda batches: _within_partition(batches, arrow_type), f"doc_id {id_type}, {_OUT}")
    )
    found = stored(cut, "fingerprints")
    # Only partition numbers reach the driver; the rows at the edges are joined.
    parts = sorted(r.part for r in found.where("edge = 'first'").select("part").collect())
    follows = list(zip(parts, parts[1:] + parts[:1], strict=True))
    order = docs.sparkSession.createDataFrame(follows, "part int, next_part int")
    lasts = found.where("edge = 'last'").select("doc_id", "text", "fp", "part")
    firsts = found.where("edge = 'first'").select(
        F.col("text").alias("next_text"), F.col("fp").alias("next_fp"), F.col("part").alias("next_part")
    )

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Rows(arrow_type)
        for batch in batches:
            for row in batch.to_pylist():
                out.done(row["doc_id"], row["text"], row["fp"], row["next_text"], row["next_fp"])
                yield out.batch()

    edges = (
        lasts.join(order, "part")
        .join(firsts, "next_part")
        .select("doc_id", "text", "fp", "next_text", "next_fp")
        .mapInArrow(joined, f"doc_id {id_type}, {_OUT}")
    )
    rows = found.where("edge is null").unionByName(edges)
    return rows.drop("part", "edge", "text")


def _block(n: int, blocks: int) -> tuple[int, int]:
    return 64 * n // blocks, 64 * (n + 1) // blocks


def tables(fp: str, radius: int = RADIUS, blocks: int = BLOCKS) -> Column:
    """The (table, key) entries of a fingerprint, one per choice of blocks."""
    entries = []
    for number, chosen in enumerate(combinations(range(blocks), blocks - radius)):
        parts = []
        for n in chosen:
            low, high = _block(n, blocks)
            parts.append(F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << (high - low)) - 1)))
        key = reduce(lambda a, b: F.shiftleft(a, 64 // blocks + 1).bitwiseOR(b), parts)
        entries.append(F.struct(F.lit(number).alias("table"), key.alias("key")))
    return F.array(*entries)


def within_radius(queries: DataFrame, prints: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """(query, fp, distance): all of ``prints`` within ``radius`` bits of each query.

    Both are tables of a column ``fp``; equal fingerprints are one. The chosen blocks' keys
    must fit in 64 bits.
    """
    asked = queries.select(F.col("fp").alias("query")).distinct()
    held = prints.select("fp").distinct()
    left = asked.select("query", F.inline(tables("query", radius, blocks)))
    right = held.select("fp", F.inline(tables("fp", radius, blocks)))
    distance = F.bit_count(F.col("query").bitwiseXOR(F.col("fp"))).alias("distance")
    met = left.join(right, ["table", "key"]).select("query", "fp", distance)
    return met.where(F.col("distance") <= radius).distinct()


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Also counts, for ids divisible by QUERY_EVERY, the documents within RADIUS bits."""
    rows = with_next(table(spark, sf_dir, "documents"))
    prints = rows.groupBy("fp").agg(F.count("*").alias("copies"))
    is_asked = F.coalesce(F.col("doc_id") % QUERY_EVERY == 0, F.lit(False))
    asked = rows.where(is_asked)
    near = within_radius(asked, prints).join(prints, "fp").groupBy("query").agg(F.sum("copies").alias("n_near"))
    counted = asked.join(near, asked["fp"] == near["query"], "left").drop("query")
    others = rows.where(~is_asked).withColumn("n_near", F.lit(None).cast("bigint"))
    hexed = lambda c: F.lower(F.lpad(F.hex(c), 16, "0"))
    return counted.unionByName(others).select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        hexed("fp").alias("fingerprint"),
        hexed("edited_fp").alias("edited_fingerprint"),
        "near_edited",
        "near_next",
        "n_near",
    )

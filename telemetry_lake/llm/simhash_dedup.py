"""Near-duplicate groups by SimHash with meet-in-the-middle ball hashing.

Two fingerprints within ``radius`` bits have a value in common that is within half the
radius of both. So every distinct fingerprint emits all values of its half ball, one shuffle
brings equal values together, and whatever meets is within the radius. All that meet at one
value are linked to the smallest of them, not to each other: this keeps every group
connected, and at most 65 fingerprints of 64 bits can meet at a value for radius 2.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from telemetry_lake.llm.components import connected_components
from telemetry_lake.llm.tables import fresh_name, orderable, stored, table, text_bytes, text_key
from telemetry_lake.operators.quality import quoted

SHINGLE_WORDS = 3
RADIUS = 2
SEED = 42
#: Bytes of a text whose words are held as objects at once.
BLOCK = 1 << 22
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def word_blocks(data: bytes, block: int = BLOCK) -> Iterator[list[bytes]]:
    """The words of a text, in lists of about ``block`` bytes each."""
    at = 0
    while at < len(data):
        cut = _SPACE.search(data, at + block) if at + block < len(data) else None
        end = cut.start() if cut else len(data)
        yield data[at:end].split()
        at = end


def shingle_hashes(data: bytes, words: int = SHINGLE_WORDS, block: int = BLOCK) -> Iterator[np.ndarray]:
    """XXH64 of each shingle of a lower-cased text, repeats included."""
    kept: list[bytes] = []
    short = True
    for block_words in word_blocks(data.lower(), block):
        kept += block_words
        if len(kept) >= words:
            short = False
            shingles = zip(*(kept[i:] for i in range(words)), strict=False)
            yield np.array(
                [xxhash.xxh64_intdigest(b" ".join(s), SEED) for s in shingles], dtype=np.uint64
            )
            kept = kept[len(kept) - words + 1 :]
    if short and kept:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(kept), SEED)], dtype=np.uint64)


def simhash(data: bytes, words: int = SHINGLE_WORDS, block: int = BLOCK) -> int:
    """Signed 64 bits; a bit is set where over half of the shingle hashes have it set."""
    votes, total = np.zeros(64, dtype=np.int64), 0
    for hashes in shingle_hashes(data, words, block):
        for part in np.array_split(hashes, len(hashes) // 65536 + 1):
            bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            votes += bits.sum(axis=0, dtype=np.int64)
        total += len(hashes)
    return int(np.packbits(votes * 2 > total, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text_key, fp) per row of ``docs``. A text without words has fingerprint 0."""
    source = docs.select(
        F.col(doc_id).alias("doc_id"), text_key(text).alias("text_key"), text_bytes(text).alias("data")
    )
    id_type = source.schema["doc_id"].dataType.simpleString()

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = pa.array([simhash(x.as_py()) for x in batch.column("data")], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), fp], ["doc_id", "text_key", "fp"]
            )

    return source.mapInArrow(of, f"doc_id {id_type}, text_key bigint, fp bigint")


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def ball(fp: str, radius: int) -> Column:
    """A fingerprint and all values that differ from it in up to half the radius, rounded up."""
    masks = [0] + [
        sum(1 << b for b in bits)
        for n in range(1, (radius + 1) // 2 + 1)
        for bits in combinations(range(64), n)
    ]
    return F.array(*[F.col(fp).bitwiseXOR(F.lit(_signed(m))) for m in masks])


def links(distinct_fp: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(u, v) fingerprint links that connect all fingerprints within ``radius`` bits.

    For an even radius everything that meets at a value is within the radius of the rest, so
    a link to the smallest is enough. For an odd one, what meets may be one bit too far
    apart; its pairs are then compared one by one (a value has a bounded number of them).
    """
    met = distinct_fp.select("fp", F.explode(ball("fp", radius)).alias("value"))
    if radius % 2 == 0:
        pairs = met.withColumn("low", F.min("fp").over(Window.partitionBy("value"))).where("fp <> low")
        pairs = pairs.select(F.col("fp").alias("u"), F.col("low").alias("v"))
    else:
        other = met.select(F.col("fp").alias("v"), "value")
        pairs = met.withColumnRenamed("fp", "u").join(other, "value").where("u > v").select("u", "v")
    return pairs.distinct().where(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= radius)


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", radius: int = RADIUS
) -> DataFrame:
    """(doc_id, text_key, fp, component_id, kept) per row of ``docs``.

    ``component_id`` is the smallest id reachable over fingerprint links (null only if no
    row of the group has an id). ``kept`` marks the row of each group that stays: the one
    with the smallest id, then the smallest text key; rows equal in both are all marked.
    Null and empty texts have fingerprint 0 and are linked like any other; repeated rows get
    a row each. Equal fingerprints are aggregated before anything is linked, so a large group
    of copies is one row from then on.
    """
    prints = stored(fingerprints(docs, doc_id, text), "simhash")
    # Ids sort before a missing id.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key"))
    firsts = stored(prints.groupBy("fp").agg(first.alias("first")), "simhash-distinct")
    groups = stored(connected_components(stored(links(firsts.select("fp"), radius), "links")), "groups")
    labelled = firsts.join(groups.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("component")
    )
    winners = stored(labelled.groupBy("component").agg(F.min("first").alias("win")), "simhash-first")
    by_fp = stored(labelled.drop("first").join(winners, "component").select("fp", "win"), "simhash-labels")
    return prints.join(by_fp, "fp", "left").select(
        "doc_id",
        "text_key",
        "fp",
        F.col("win.doc_id").alias("component_id"),
        (F.col("doc_id").eqNullSafe(F.col("win.doc_id")) & (F.col("text_key") == F.col("win.text_key"))).alias(
            "kept"
        ),
    )


def rows_of(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose id and text key are in ``kept``, one of each: that which comes first by
    its other columns, null first, so that the order of the input does not matter."""
    key, rest = fresh_name(docs, "text_key"), fresh_name(docs, "rest")
    keyed = docs.withColumn(key, text_key("text"))
    match = keyed["doc_id"].eqNullSafe(kept["doc_id"]) & (keyed[key] == kept["text_key"])
    named = {f"c{i}": c for i, c in enumerate(docs.columns)}
    # A type without an order counts by its text.
    sortable = [F.col(quoted(c)) if orderable(docs.schema[c].dataType) else F.col(quoted(c)).cast("string") for c in docs.columns]
    whole = F.struct(*[F.col(quoted(c)).alias(n) for n, c in named.items()])
    first = (
        keyed.join(kept, match, "left_semi")
        .groupBy("doc_id", key)
        .agg(F.min_by(whole, F.struct(*sortable)).alias(rest))
    )
    return first.select(*[F.col(rest).getField(n).alias(c) for n, c in named.items()])


def keep_one_per_group(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` without all but one of each group of near duplicates."""
    kept = stored(
        near_duplicates(docs, radius=radius).where("kept").select("doc_id", "text_key").distinct(),
        "simhash-kept",
    )
    return rows_of(docs, kept)


def op7_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )

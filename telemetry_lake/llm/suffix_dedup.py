"""Removal of repeated byte strings by range-partitioned, locally sorted suffixes.

A byte goes if it lies in a string of ``LENGTH`` bytes that also starts earlier. Sorting the
suffix of every byte would shuffle many times the input, so suffixes are taken at anchors:
of the grams of ``GRAM`` bytes in a window of ``LENGTH`` bytes, the leftmost with the least
hash. Equal windows have the same anchor, so nothing is lost by looking at anchors only.

1. An anchor stands for the windows that chose it. Its row has the leading bytes of its
   suffix with a hash of the gram, a hash of all bytes of its windows, and its place.
   Sampled splitters range-partition the rows, each bucket sorts them by multikey
   quicksort. Rows equal to an earlier neighbour are repeats as a whole. Where a gram has
   several different surroundings, the first row of each goes on.
2. Those rows, and the first and last grams of every bucket, are taken apart into blocks of
   ``GRID`` windows, keyed by the bytes that all windows of a block have in common, and sorted
   the same way. A block whose common bytes occur once holds no repeat.
3. What is left is taken apart into the suffixes of single windows. Equal neighbours are
   repeats; ends of buckets are compared across boundaries.

Splitters cut by the whole key with the place, so a passage that very many documents share
is spread over many buckets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetry_lake.llm.tables import shuffle_width, stored, table, text_bytes, text_key

LENGTH = 100
GRAM = 32
#: Windows that are looked at together where anchors have to be taken apart.
GRID = 8
#: Bytes of a text that are hashed at once.
BLOCK = 1 << 16
#: Low bits of a place: the number of windows from there on.
SIZE_BITS = 7
#: Below this many rows a bucket's part is sorted directly.
SMALL = 4096
_BASE = 0x9E3779B97F4A7C15 | 1
_U = np.uint64


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, dtype=np.uint64)
    with np.errstate(over="ignore"):
        out[1:] = _U(base)
        return np.multiply.accumulate(out)


_POW = _powers(_BASE, BLOCK + 4 * LENGTH)
_INV = _powers(pow(_BASE, -1, 1 << 64), BLOCK + 4 * LENGTH)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class Hashes:
    """Hashes of any substring of a block of bytes."""

    def __init__(self, data: np.ndarray) -> None:
        self.data = data
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum((data.astype(np.uint64) + _U(1)) * _POW[: len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mixed((self.sums[end] - self.sums[start]) * _INV[start])

    def lead(self, at: np.ndarray) -> np.ndarray:
        """The first four bytes from each place, as a number in byte order."""
        out = np.zeros(len(at), dtype=np.uint64)
        for k in range(4):
            out = out << _U(8) | self.data[at + k].astype(np.uint64)
        return out


def _sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size * 2 <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    rest = width - size
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


def blocks(data: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Parts of a text such that every window starts in exactly one; with their offsets."""
    step = BLOCK
    for at in range(0, len(data) - LENGTH + 1, step):
        yield at, data[at : at + step + LENGTH - 1]


def _chosen(data: np.ndarray) -> Iterator[tuple[int, Hashes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(offset, hashes, gram hashes, anchors, first window, windows) of each part of a text."""
    width = LENGTH - GRAM + 1
    for offset, part in blocks(data):
        hashes = Hashes(part)
        places = np.arange(len(part) - GRAM + 1)
        grams = hashes.of(places, places + GRAM)
        order = (grams >> _U(18)) << _U(18) | places.astype(np.uint64)
        chosen = (_sliding_least(order, width) & _U((1 << 18) - 1)).astype(np.int64)
        first = np.flatnonzero(np.diff(chosen, prepend=-1))
        count = np.diff(first, append=len(chosen))
        yield offset, hashes, grams, chosen[first], first, count


def anchors(data: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(gram, surroundings, first window, windows) of the anchors of a text, part by part."""
    for offset, hashes, grams, at, first, count in _chosen(data):
        key = hashes.lead(at) << _U(32) | grams[at] >> _U(32)
        whole = hashes.of(first, first + count + LENGTH - 1)
        # How the windows lie around the anchor is part of the surroundings.
        whole = _mixed(whole + ((at - first).astype(np.uint64) << _U(8) | count.astype(np.uint64)))
        yield key.view(np.int64), whole.view(np.int64), first + offset, count


def grid_blocks(data: np.ndarray, wanted: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(common bytes, all bytes, first window, windows) of the blocks of some anchors.

    Blocks lie at fixed distances before the anchor, so equal windows are in equal blocks.
    ``wanted``: the first windows of the anchors, in order.
    """
    for offset, hashes, _, at, first, count in _chosen(data):
        picked = np.isin(first + offset, wanted)
        at, first, count = at[picked], first[picked], count[picked]
        last = first + count - 1
        low, high = (at - last) // GRID, (at - first) // GRID
        n = high - low + 1
        row = np.repeat(np.arange(len(at)), n)
        block = low[row] + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        near, far = at[row] - block * GRID, at[row] - block * GRID - GRID + 1
        begin, end = np.maximum(first[row], far), np.minimum(last[row], near)
        core = hashes.lead(near) << _U(32) | _mixed(hashes.of(near, far + LENGTH) + block.astype(np.uint64)) >> _U(32)
        whole = hashes.of(begin, end + LENGTH)
        whole = _mixed(whole + ((at[row] - begin).astype(np.uint64) << _U(8) | (end - begin).astype(np.uint64)))
        yield core.view(np.int64), whole.view(np.int64), begin + offset, end - begin + 1


def windows(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two-word keys of the windows of a text that start at the given places."""
    one, two = np.empty(len(starts), dtype=np.int64), np.empty(len(starts), dtype=np.int64)
    for offset, part in blocks(data):
        a, b = np.searchsorted(starts, [offset, offset + BLOCK])
        if a == b:
            continue
        hashes, at = Hashes(part), starts[a:b] - offset
        two[a:b] = hashes.of(at, at + LENGTH).view(np.int64)
        head = hashes.of(at, at + GRAM) >> _U(32)
        one[a:b] = (hashes.lead(at) << _U(32) | head).view(np.int64)
    return one, two


def multikey_order(columns: list[np.ndarray]) -> np.ndarray:
    """The order of rows by several columns, by quicksort with three parts per column."""
    out: list[np.ndarray] = []
    stack = [(np.arange(len(columns[0])), 0)]
    while stack:
        rows, depth = stack.pop()
        if len(rows) <= SMALL or depth == len(columns):
            rest = [c[rows] for c in columns[depth:]]
            out.append(rows[np.lexsort(rest[::-1])] if rest and len(rows) > 1 else rows)
            continue
        values = columns[depth][rows]
        pivot = np.partition(values[:: max(1, len(values) // 255)], -1 - min(127, len(values) // 2))[
            -1 - min(127, len(values) // 2)
        ]
        less, more = values < pivot, values > pivot
        stack.append((rows[more], depth))
        stack.append((rows[~less & ~more], depth + 1))
        stack.append((rows[less], depth))
    return np.concatenate(out) if out else np.arange(0)


def _gathered(batches: Iterator[pa.RecordBatch], names: list[str]) -> list[np.ndarray]:
    parts = [[b.column(n).to_numpy(zero_copy_only=False) for n in names] for b in batches]
    if not parts:
        return [np.zeros(0, dtype=np.int64) for _ in names]
    return [np.concatenate(column) for column in zip(*parts, strict=True)]


def _new_run(*columns: np.ndarray) -> np.ndarray:
    """Marks rows that differ from the row before in any of the columns."""
    fresh = np.zeros(len(columns[0]), dtype=bool)
    fresh[:1] = True
    for c in columns:
        fresh[1:] |= c[1:] != c[:-1]
    return fresh


def _record(**columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns.values()], list(columns))


_ANCHOR = "gram bigint, whole bigint, doc bigint, at bigint, tag bigint"
_WINDOW = "one bigint, two bigint, doc bigint, at bigint, tag bigint"


def _packed_rows(found: Iterator[tuple], doc: int, tag: int) -> Iterator[tuple]:
    for key, whole, first, count in found:
        at = first << SIZE_BITS | count
        yield key, whole, np.full(len(at), doc), at, np.full(len(at), tag)


def _grouped(rows: Iterator[tuple], keys: tuple[str, str] = ("gram", "whole")) -> Iterator[pa.RecordBatch]:
    """Key rows in batches of some size."""
    held, size = [], 0

    def joined() -> pa.RecordBatch:
        columns = map(np.concatenate, zip(*held, strict=True))
        return _record(**dict(zip((*keys, "doc", "at", "tag"), columns, strict=True)))

    for row in rows:
        held.append(row)
        size += len(row[0])
        if size > 100_000:
            yield joined()
            held, size = [], 0
    if held:
        yield joined()


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        docs, tags = batch.column("doc").to_pylist(), batch.column("tag").to_pylist()
        texts = (np.frombuffer(x.as_buffer(), dtype=np.uint8) for x in batch.column("data"))
        yield from _grouped(
            row for doc, tag, text in zip(docs, tags, texts, strict=True) for row in _packed_rows(anchors(text), doc, tag)
        )


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(doc, tag, bytes, first windows, windows) of rows joined with their texts."""
    unpack = zstandard.ZstdDecompressor()
    for batch in batches:
        for doc, tag, text, places in zip(*(batch.column(n) for n in ("doc", "tag", "data", "places")), strict=True):
            data = np.frombuffer(unpack.decompress(text.as_buffer()), dtype=np.uint8)
            at = np.sort(places.values.to_numpy(zero_copy_only=False))
            yield doc.as_py(), tag.as_py(), data, at >> SIZE_BITS, at & ((1 << SIZE_BITS) - 1)


def _block_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield from _grouped(
        row
        for doc, tag, data, first, _ in _unpacked(batches)
        for row in _packed_rows(grid_blocks(data, np.unique(first)), doc, tag)
    )


def _sorted_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    columns = _gathered(batches, ["gram", "whole", "doc", "at", "tag"])
    order = multikey_order(columns[:4])
    if len(order) == 0:
        return
    gram, whole, doc, at, tag = (c[order] for c in columns)
    new_gram, new_class = _new_run(gram), _new_run(gram, whole)
    # The earliest of its class; copies of a row start at the same place and are as early.
    lead = np.flatnonzero(new_class)[np.cumsum(new_class) - 1]
    start = at >> SIZE_BITS
    later = (doc != doc[lead]) | (start != start[lead])
    run = np.cumsum(new_gram) - 1
    classes = np.bincount(run, weights=new_class)
    # Grams at the ends of a bucket may go on in the next one.
    open_run = (run == 0) | (run == run[-1])
    apart = ~later & ((classes[run] > 1) | open_run)
    picked = later | apart
    yield _record(doc=doc[picked], at=at[picked], tag=tag[picked], apart=apart[picked])


def _window_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        for doc, tag, data, first, count in _unpacked(batches):
            for some in np.array_split(np.arange(len(first)), len(first) // 2000 + 1):
                n = count[some]
                begin = np.cumsum(n) - n
                starts = np.unique(np.repeat(first[some] - begin, n) + np.arange(int(n.sum())))
                places = np.full(len(starts), doc), starts << SIZE_BITS | 1, np.full(len(starts), tag)
                yield (*windows(data, starts), *places)

    yield from _grouped(rows(), ("one", "two"))


def _sorted_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    columns = _gathered(batches, ["one", "two", "doc", "at", "tag", "bucket"])
    order = multikey_order(columns[:4])
    if len(order) == 0:
        return
    one, two, doc, at, tag, bucket = (c[order] for c in columns)
    fresh = _new_run(one, two)
    lead = np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
    start = at >> SIZE_BITS
    repeat = (doc != doc[lead]) | (start != start[lead])
    # The leads of the first run, which the bucket before may have begun, and the last row.
    ends = (lead == 0) & ~repeat
    ends[-1] = True
    picked = repeat | ends
    yield _record(
        doc=doc[picked], at=at[picked], tag=tag[picked], repeat=repeat[picked], end=ends[picked], first=(lead == 0)[picked],
        one=one[picked], two=two[picked], bucket=bucket[picked].astype(np.int32),
    )


def _across(found: DataFrame) -> DataFrame:
    """Leads of a bucket's first run that an earlier bucket holds already.

    Ends are few rows per bucket and meet on the driver as one summary per bucket.
    """
    ends = found.where("end")
    lasts = ends.groupBy("bucket").agg(F.max(F.struct("one", "two", "doc", "at")).alias("last"))
    firsts = ends.where("first").groupBy("bucket").agg(F.min(F.struct("one", "two", "doc", "at")).alias("head"))
    rows = sorted(firsts.join(lasts, "bucket").collect(), key=lambda r: r["bucket"])
    # The earliest place of the window that is open at the end of each bucket.
    begun, opened = [], None
    for row in rows:
        head, last = row["head"], row["last"]
        same = opened is not None and opened[:2] == (head["one"], head["two"])
        if same:
            begun.append((row["bucket"], opened[2], opened[3] >> SIZE_BITS))
        if (last["one"], last["two"]) != (head["one"], head["two"]):
            # Where the last run begins within the bucket does not matter: it is earlier.
            opened = (last["one"], last["two"], None, 0)
        elif not same:
            opened = (head["one"], head["two"], head["doc"], head["at"])
    spark = found.sparkSession
    known = spark.createDataFrame(begun, "bucket int, lead_doc bigint, lead_start bigint")
    start = F.shiftright("at", SIZE_BITS)
    same_place = (F.col("doc") == F.col("lead_doc")) & (start == F.col("lead_start"))
    return (
        ends.where("first and not repeat")
        .join(known, "bucket")
        .where(~F.coalesce(same_place, F.lit(False)))
        .select("doc", "at", "tag")
    )


def _keyed(docs: DataFrame, packed: bool) -> DataFrame:
    """(doc, tag, data): a null id sorts before all others; the tag keeps apart the texts of one id."""
    data = text_bytes("text")
    keyed = docs.select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(1 << 63))).alias("doc"),
        text_key("text").alias("tag"),
        data.alias("data"),
        F.col("doc_id"),
    )
    if not packed:
        return keyed.drop("doc_id")
    id_type = keyed.schema["doc_id"].dataType.simpleString()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            data = pa.array([packer.compress(x.as_buffer()) for x in batch.column("data")], pa.binary())
            at = batch.schema.get_field_index("data")
            yield batch.set_column(at, "data", data)

    return keyed.mapInArrow(pack, f"doc bigint, tag bigint, data binary, doc_id {id_type}")


def _by_row(spans: DataFrame) -> DataFrame:
    return spans.groupBy(F.col("doc").alias("of_doc"), F.col("tag").alias("of_tag")).agg(
        F.collect_list("at").alias("places")
    )


_SAME = "doc = of_doc and tag = of_tag"


def _sorted_out(rows: DataFrame, width: int, label: str) -> DataFrame:
    """(doc, at, tag, apart): repeats as a whole, and rows to be taken apart."""
    return stored(
        rows.repartitionByRange(width, "gram", "whole", "doc", "at").mapInArrow(
            _sorted_anchors, "doc bigint, at bigint, tag bigint, apart boolean"
        ),
        label,
    )


def _with_texts(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The texts of the rows that have something to be taken apart."""
    apart = _by_row(found.where("apart"))
    return _keyed(docs, packed=True).join(apart, F.expr(_SAME)).select("doc", "tag", "data", "places")


def repeated(docs: DataFrame) -> DataFrame:
    """(doc, at, tag): windows that also start earlier, as runs of neighbouring windows.

    ``doc`` is the id as a long, ``at`` holds the first window and the number of windows, ``tag`` is
    a hash of the whole text, for ids that repeat. Texts shorter than a window have none.
    """
    width = shuffle_width(docs.sparkSession)
    rows = _keyed(docs, packed=False).where(F.octet_length("data") >= LENGTH)
    first = _sorted_out(rows.mapInArrow(_anchor_rows, _ANCHOR), width, "anchors")
    blocks = stored(_with_texts(docs, first).mapInArrow(_block_rows, _ANCHOR), "blocks")
    finer = _sorted_out(blocks, width, "block-repeats")
    single = stored(_with_texts(docs, finer).mapInArrow(_window_rows, _WINDOW), "windows")
    second = stored(
        single.repartitionByRange(width, "one", "two", "doc", "at")
        .withColumn("bucket", F.spark_partition_id())
        .mapInArrow(
            _sorted_windows,
            "doc bigint, at bigint, tag bigint, repeat boolean, end boolean, first boolean, one bigint, two bigint, bucket int",
        ),
        "window-repeats",
    )
    return (
        first.unionByName(finer)
        .where("not apart")
        .select("doc", "at", "tag")
        .unionByName(second.where("repeat").select("doc", "at", "tag"))
        .unionByName(_across(second))
    )


def _cut(data: bytes, places: np.ndarray) -> tuple[bytes, int]:
    """What is left of a text, and how many runs of bytes were taken out."""
    change = np.zeros(len(data) + 1, dtype=np.int32)
    first, count = places >> SIZE_BITS, places & ((1 << SIZE_BITS) - 1)
    np.add.at(change, first, 1)
    np.add.at(change, first + count + LENGTH - 1, -1)
    gone = np.cumsum(change[:-1]) > 0
    runs = int(gone[:1].sum()) + int((gone[1:] & ~gone[:-1]).sum())
    return np.frombuffer(data, dtype=np.uint8)[~gone].tobytes(), runs


def remove_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, kept, n_bytes, n_removed, n_spans, kept_sha256) per row of ``docs``.

    Which string starts earlier goes by id, then by place in the document; a null id comes
    before all others. Rows that share an id count as one document: what starts at the same
    place in them is equally early and stays in each. Null and empty texts have no bytes.
    ``kept`` is binary, as a cut may fall inside a character.
    """
    texts = _keyed(docs, packed=True)
    id_type = texts.schema["doc_id"].dataType.simpleString()
    joined = texts.join(_by_row(repeated(docs)), F.expr(_SAME), "left").select("doc_id", "data", "places")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            kept, sizes, runs = [], [], []
            for text, places in zip(batch.column("data"), batch.column("places"), strict=True):
                data, n = unpack.decompress(text.as_buffer()), 0
                sizes.append(len(data))
                if places.is_valid:
                    data, n = _cut(data, places.values.to_numpy(zero_copy_only=False))
                kept.append(data)
                runs.append(n)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(kept, pa.binary()),
                    pa.array(sizes, pa.int64()),
                    pa.array([a - len(b) for a, b in zip(sizes, kept, strict=True)], pa.int64()),
                    pa.array(runs, pa.int64()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string()),
                ],
                ["doc_id", "kept", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    return joined.mapInArrow(
        cut,
        f"doc_id {id_type}, kept binary, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string",
    )


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).drop("kept")

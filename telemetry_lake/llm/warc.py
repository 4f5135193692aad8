"""WARC archives: writing with revisit records, and reading by boundary-chain verification.

The magic of a record can also stand in a payload, so a reader that starts anywhere cannot
trust it. Spark splits the archives at every magic. Each piece whose head can be read as a
record's gives a link from its offset to the offset where its record would end. A file's
first record starts at 0; pointer jumping over the links keeps what is reachable from there
and nothing else. Pieces between a reachable record and its end belong to its payload.

Offsets come from the lengths of all pieces of a split, and of all splits before it.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from telemetry_lake.llm.tables import stored, table
from telemetry_lake.session import work_dir

MAGIC = "WARC/1.0\r\n"
RECORD_END = "\r\n\r\n"
#: Payloads of at least so many bytes are stored once.
LEAST = 0
_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
_DATE = "2024-01-01T00:00:00Z"


def _base32(hexed: Column) -> Column:
    """40 hex digits as upper-case base 32: five digits of 4 bits are four of 5 bits."""
    alphabet = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
    out = []
    for k in range(0, 40, 5):
        bits = F.conv(F.substring(hexed, k + 1, 5), 16, 10).cast("int")
        out += [F.substring(alphabet, F.shiftright(bits, s).bitwiseAND(F.lit(31)) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
    return F.concat(*out)


def records(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """(record): the WARC record of every page, without the line ends that close it.

    Of equal payloads of at least ``least`` bytes, those with the largest page_id are
    responses and the others revisit it; smaller payloads are all responses. A null page_id
    is below any other. A null html is an empty payload; a null url is left out.
    """
    html = F.coalesce("html", F.lit(""))
    source = pages.select("page_id", "url", html.alias("html"), F.sha1(html.cast("binary")).alias("sha1"), F.octet_length(html).alias("size"))
    last = source.where(F.col("size") >= least).groupBy("sha1").agg(F.max("page_id").alias("last"), F.count("*").alias("n"))
    # Only digests that occur more than once meet the pages again.
    known = source.join(last.where("n > 1").drop("n"), "sha1", "left")
    revisits = (F.col("size") >= least) & F.col("last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last"))
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("none")), F.lit(">"))
    digest = F.concat(F.lit("sha1:"), _base32(F.col("sha1")))
    uri = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    # The HTTP head of a revisit still tells the length of the payload.
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("size").cast("string"), F.lit(RECORD_END),
    )
    stored_size = F.octet_length(http) + F.when(revisits, 0).otherwise(F.col("size"))
    head = F.concat(
        F.lit(f"{MAGIC}WARC-Type: "), F.when(revisits, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: "), name("page_id"), F.lit(f"\r\nWARC-Date: {_DATE}"),
        F.coalesce(F.concat(F.lit("\r\nWARC-Target-URI: "), uri), F.lit("")),
        F.when(revisits, F.concat(F.lit("\r\nWARC-Refers-To: "), name("last"), F.lit(f"\r\nWARC-Profile: {_PROFILE}"))).otherwise(""),
        F.lit("\r\nWARC-Payload-Digest: "), digest,
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "), stored_size.cast("string"), F.lit(RECORD_END),
    )
    return known.select(F.concat(head, http, F.when(revisits, "").otherwise(F.col("html"))).alias("record"))


def write_archives(pages: DataFrame, folder: str, least: int = LEAST, compression: str = "gzip") -> None:
    """A WARC file per task; records never span files.

    ``compression="none"`` gives files that a reader can split; a compressed file is read by
    one task, and its offsets are those of what it unpacks to.
    """
    write = records(pages, least).write.option("lineSep", RECORD_END)
    write.option("compression", compression).text(folder)


def read_pieces(spark: SparkSession, folder: str) -> DataFrame:
    """(file, split, data): what stands between the magics, in order within a split."""
    raw = spark.read.option("lineSep", MAGIC).text(folder)
    return raw.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.col("value").cast("binary").alias("data"),
    )


def _fields(data: bytes) -> tuple[dict[bytes, bytes], int] | None:
    """The named fields of a record's head, and where its block begins."""
    end = data.find(b"\r\n\r\n")
    if end < 0:
        return None
    found = {}
    for line in data[:end].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        found[name.strip().lower()] = value.strip()
    if not found.get(b"content-length", b"").isdigit() or b"warc-type" not in found:
        return None
    return found, end + 4


def _payload(block: bytes) -> tuple[bytes, int | None]:
    """The payload of an HTTP response, and the length that its head tells."""
    head, _, payload = block.partition(b"\r\n\r\n")
    told = re.search(rb"(?im)^content-length:[ \t]*(\d+)", head)
    return payload, int(told[1]) if told else None


def _digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


_PIECE = (
    "file string, split bigint, place bigint, size bigint, reach bigint, kind string, id string, refers string,"
    " told_digest string, told_bytes bigint, payload_bytes bigint, payload_digest string"
)
_PIECE_SCHEMA = [
    ("file", pa.string()), ("split", pa.int64()), ("place", pa.int64()), ("size", pa.int64()), ("reach", pa.int64()),
    ("kind", pa.string()), ("id", pa.string()), ("refers", pa.string()), ("told_digest", pa.string()),
    ("told_bytes", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
]


def _described(data: bytes) -> tuple:
    """Of a piece that can begin a record: how far it reaches, and what it holds if it is whole."""
    read = _fields(data)
    if read is None:
        return (None,) * 8
    fields, begin = read
    length = int(fields[b"content-length"])
    text = lambda name: fields.get(name, b"").decode("utf-8", "replace") or None
    payload, told = _payload(data[begin : begin + length])
    whole = len(data) >= begin + length
    digest = text(b"warc-payload-digest")
    return (
        len(MAGIC) + begin + length + len(RECORD_END), text(b"warc-type"), text(b"warc-record-id"), text(b"warc-refers-to"),
        digest.rpartition(":")[2] if digest else None, told, len(payload) if whole else None, _digest(payload) if whole else None,
    )


def _described_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places are counted from the start of the split's first piece."""
    now, place = None, 0
    for batch in batches:
        rows = []
        for file, split, data in zip(*(batch.column(n).to_pylist() for n in ("file", "split", "data")), strict=True):
            if (file, split) != now:
                now, place = (file, split), 0
            size = len(data) + len(MAGIC)
            rows.append((file, split, place, size, *_described(data)))
            place += size
        if rows:
            columns = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(columns, _PIECE_SCHEMA, strict=True)], [n for n, _ in _PIECE_SCHEMA])


def _placed_data(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, place = None, 0
    for batch in batches:
        places = []
        for file, split, data in zip(batch.column("file").to_pylist(), batch.column("split").to_pylist(), batch.column("data"), strict=True):
            if (file, split) != now:
                now, place = (file, split), 0
            places.append(place)
            place += data.as_buffer().size + len(MAGIC)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(places, pa.int64())], ["file", "split", "data", "place"])


def with_offsets(pieces: DataFrame) -> DataFrame:
    """Adds ``offset``: where the magic before a piece stands in its file.

    A file's first piece stands before the first magic; it is empty, so that the second one
    is at 0. A split that begins within a piece leaves that piece to the split before.
    """
    sizes = pieces.groupBy("file", "split").agg(F.sum("size").alias("total"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("file", "split", (F.coalesce(F.sum("total").over(before), F.lit(0)) - len(MAGIC)).alias("base"))
    return pieces.join(bases, ["file", "split"]).withColumn("offset", F.col("base") + F.col("place")).drop("base")


def reachable(links: DataFrame) -> DataFrame:
    """(file, offset) of the links that a walk from offset 0 of each file comes by.

    ``links``: (file, offset, next), next > offset. In each round the known places follow a
    jump, and jumps are doubled, so rounds grow with the logarithm of a file's records.
    """
    jumps = stored(links.select("file", "offset", "next"), "jumps")
    reached = stored(jumps.where("offset = 0").select("file", "offset"), "reached")
    count = reached.count()
    while True:
        more = reached.join(jumps, ["file", "offset"]).select("file", F.col("next").alias("offset"))
        # A jump out of the known links is a dead end or the end of the file.
        more = more.join(links.select("file", "offset"), ["file", "offset"], "left_semi")
        reached = stored(reached.unionByName(more).distinct(), "reached")
        grown = reached.count()
        if grown == count:
            return reached
        count = grown
        on = jumps.select("file", F.col("offset").alias("next"), F.col("next").alias("after"))
        jumps = stored(jumps.join(on, ["file", "next"]).select("file", "offset", F.col("after").alias("next")), "jumps")


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """One row per record: (record_id, record_type, refers_to, payload_bytes, payload_digest).

    For a revisit, bytes and digest are those its head tells of the payload it refers to.
    A file whose chain of records breaks off yields the records before the break.
    """
    pieces = stored(with_offsets(read_pieces(spark, folder).mapInArrow(_described_pieces, _PIECE)), "pieces")
    links = pieces.where("reach is not null").select("file", "offset", (F.col("offset") + F.col("reach")).alias("next"))
    starts = reachable(links)
    found = stored(pieces.join(starts, ["file", "offset"]), "records")
    whole = found.where("payload_digest is not null")
    mended = _mended(spark, folder, pieces, found.where("payload_digest is null"))
    told = F.col("kind") == "revisit"
    return whole.unionByName(mended).select(
        F.col("id").alias("record_id"),
        F.col("kind").alias("record_type"),
        F.col("refers").alias("refers_to"),
        F.when(told, F.col("told_bytes")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(told, F.col("told_digest")).otherwise(F.col("payload_digest")).alias("payload_digest"),
    )


def _mended(spark: SparkSession, folder: str, pieces: DataFrame, broken: DataFrame) -> DataFrame:
    """Records whose payload holds a magic, put together from their pieces.

    Each piece belongs to the last reachable record before it, found by a running maximum
    over the light columns of the few files that have such records.
    """
    files = broken.select("file").distinct()
    starts = broken.select("file", "offset", (F.col("offset") + F.col("reach")).alias("stop"))
    light = pieces.join(files, "file", "left_semi").select("file", "split", "place", "offset").join(starts, ["file", "offset"], "left")
    open_now = Window.partitionBy("file").orderBy("offset").rowsBetween(Window.unboundedPreceding, 0)
    owned = light.select(
        "file", "split", "place", "offset",
        F.max(F.when(F.col("stop").isNotNull(), F.struct(F.col("offset").alias("owner"), "stop"))).over(open_now).alias("o"),
    ).where("offset < o.stop")
    owned = owned.select("file", "split", "place", "offset", F.col("o.owner").alias("owner"))
    data = read_pieces(spark, folder).mapInArrow(_placed_data, "file string, split bigint, data binary, place bigint")
    parts = data.join(owned, ["file", "split", "place"]).select("file", "owner", "offset", "data")
    joined = parts.groupBy("file", F.col("owner").alias("offset")).agg(
        F.array_sort(F.collect_list(F.struct(F.col("offset").alias("at"), "data"))).alias("parts")
    )

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for found in batch.column("parts").to_pylist():
                data = MAGIC.encode().join(p["data"] for p in found)
                out.append(_described(data)[-2:])
            yield pa.RecordBatch.from_arrays(
                [batch.column("file"), batch.column("offset"), pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.string())],
                ["file", "offset", "payload_bytes", "payload_digest"],
            )

    known = joined.mapInArrow(described, "file string, offset bigint, payload_bytes bigint, payload_digest string")
    return broken.drop("payload_bytes", "payload_digest").join(known.where("payload_digest is not null"), ["file", "offset"])


def op5_warc(spark: SparkSession, sf_dir: str, compression: str = "gzip") -> DataFrame:
    folder = work_dir(spark, "archives")
    write_archives(table(spark, sf_dir, "pages"), folder, compression=compression)
    number = lambda c: F.expr(f"try_cast(regexp_extract({c}, '^<urn:page:(-?[0-9]+)>$', 1) as bigint)")
    return read_archives(spark, folder).select(
        number("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        number("refers_to").alias("refers_to"),
    )


ORACLE_SQL = """with p as (select page_id, encode(coalesce(html, '')) as b from pages),
d as (select page_id, octet_length(b)::bigint as payload_bytes, sha1(b) as h from p),
m as (select h, max(page_id) as last from d group by h)
select page_id, payload_bytes,
  list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    ((('0x' || substr(h, (i // 4 * 5 + 1)::int, 5))::bigint >> (15 - 5 * (i % 4))::int) & 31)::int + 1, 1)), 'string_agg', '') as payload_digest,
  case when page_id = last then 'response' else 'revisit' end as record_type,
  case when page_id <> last then last end as refers_to
from d join m using (h)"""

import base64
import hashlib

import pytest

from telemetry_lake.llm import warc as op

SCHEMA = "page_id bigint, url string, html string, text_key string"
FAKE = "WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:999>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
PAGES = [
    (1, "http://a/", "same", "x"), (5, "http://b/é\r\nWARC-Type: evil", "same", "x"), (3, None, "same", "x"),
    (2, "u", None, "x"), (9, "u", "", "x"), (None, "u", "same", "x"), (10, "u", "é" * 70_000, "x"),
    (11, "u", f"magic {FAKE} inside {FAKE}{FAKE}", "x"), (12, "u", "WARC/1.0\r\n", "x"), (13, "u", "ends with WARC/1.0\r\n\r\n\r\n", "x"),
    (14, "u", "WARC/1.0\r\nContent-Length: 99999999\r\nWARC-Type: response\r\n\r\n", "x"), (15, "u", "a\r\n\r\nb", "x"),
]
PAGES += [(100 + i, "u", f"page {i} {FAKE if i % 7 == 0 else ''}" * 40, "x") for i in range(80)]


def plain(rows, least=0):
    out = []
    for page_id, _, html, _ in rows:
        data = (html or "").encode()
        ids = [p for p, _, h, _ in rows if (h or "").encode() == data and p is not None]
        last = max(ids, default=None)
        again = len(data) >= least and last is not None and page_id != last
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((page_id, len(data), digest, "revisit" if again else "response", last if again else None))
    return sorted(out, key=repr)


def run(spark, rows, tmp_path, least=0, split=None, compression="none"):
    spark.createDataFrame(rows, SCHEMA).coalesce(2).write.parquet(f"{tmp_path}/pages.parquet")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    if split:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        return sorted(map(tuple, op.op5_warc(spark, str(tmp_path), compression).collect()), key=repr)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


@pytest.mark.parametrize("split", [None, "1000", "4096", "77777"])
def test_round_trip(spark, tmp_path, split):
    assert run(spark, PAGES, tmp_path, split=split) == plain(PAGES)


def test_round_trip_of_compressed_files(spark, tmp_path):
    assert run(spark, PAGES, tmp_path, split="4096", compression="gzip") == plain(PAGES)


def test_empty_and_repeated(spark, tmp_path):
    assert run(spark, [], tmp_path / "a") == []
    rows = [(1, "u", "x", None), (1, "u", "x", None), (None, None, None, None), (None, "u", "z", None)]
    assert run(spark, rows, tmp_path / "b") == plain(rows)


def test_small_payloads_are_not_revisits(spark, tmp_path):
    folder = str(tmp_path / "w")
    op.write_archives(spark.createDataFrame(PAGES, SCHEMA), folder, least=4000)
    got = op.read_archives(spark, folder)
    assert got.where("record_type = 'revisit'").count() == 0
    assert got.count() == len(PAGES)


def test_broken_chain_keeps_what_is_before(spark, tmp_path):
    good = op.records(spark.createDataFrame(PAGES[:3], SCHEMA)).collect()
    data = "\r\n\r\n".join(r.record for r in good[:2]) + "\r\n\r\njunk" + good[2].record + "\r\n\r\n"
    (tmp_path / "a.warc").write_bytes(data.encode())
    assert op.read_archives(spark, str(tmp_path)).count() == 2


def test_only_reachable_links(spark):
    links = [("f", 0, 10), ("f", 10, 30), ("f", 15, 30), ("f", 30, 99), ("f", 40, 50), ("g", 5, 9), ("h", 0, 4)]
    got = {tuple(r) for r in op.reachable(spark.createDataFrame(links, "file string, offset bigint, next bigint")).collect()}
    assert got == {("f", 0), ("f", 10), ("f", 30), ("h", 0)}

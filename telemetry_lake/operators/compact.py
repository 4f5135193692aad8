"""Compaction: many small files per date become few, in a new folder; so do the logs' files."""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetry_lake.operators.sinks import balanced
from telemetry_lake.plans.lake import (
    BATCH,
    FOLDED,
    POINTER_SCHEMA,
    PUBLISHED_SCHEMA,
    UNDATED,
    VERSION,
    Fold,
    Lake,
    behind,
    up_to,
)
from telemetry_lake.session import child_folders, literal_path, remove_folder


def compact_folder(df: DataFrame, target: str, date_column: str) -> int:
    """Rewrite a table into a new folder and return its row count.

    Without the date column the copy is not partitioned. The source is left alone, and
    a copy that lost or gained rows is refused.
    """
    spark = df.sparkSession
    if date_column in df.columns:
        writer = balanced(df, date_column).write.partitionBy(date_column)
    else:
        writer = balanced(df).write
    writer.mode("errorifexists").parquet(target)
    expected = df.count()
    written = spark.read.schema(df.schema).parquet(literal_path(target)).count()
    if written != expected:
        raise RuntimeError(f"{target}: {written} rows written, {expected} expected")
    return written


def _audited(spark: SparkSession, lake: Lake) -> DataFrame:
    """The finished batches of streams, once per file."""
    number = F.substring_index(BATCH, "-", -1)
    audited = lake.audit(spark).where(number.rlike("^[0-9]{10,}$")).select(BATCH, number.alias("n"))
    return audited.withColumn("stream", F.expr(f"left({BATCH}, length({BATCH}) - length(n))"))


def _by_stream(audited: DataFrame) -> DataFrame:
    return audited.groupBy("stream").agg(F.max(BATCH).alias("mark"))


def compact_table(spark: SparkSession, lake: Lake, name: str) -> str:
    """Fold a lake table's finished batches into a new version of the dates they touch.

    Other dates keep their files. Only batches up to the last one the audit knows of each
    stream are folded, so one that is still being written stays out. Readers switch when
    the version's rows appear; older folders stay in place.
    """
    marks = [r.mark for r in _by_stream(_audited(spark, lake)).collect()]
    opened = lake.open(spark)
    current = opened.published(name)
    version = current.version + 1 if current else 1

    rows = opened.batches(name).where(up_to(marks))
    if current:
        rows = rows.where(~up_to(current.marks))
    rows = rows.drop(BATCH)
    day = F.coalesce(F.col(lake.date_column).cast("string"), F.lit(UNDATED))
    touched = [r.day for r in rows.select(day.alias("day")).distinct().collect()]
    if current:
        again = [d for d in touched if d in current.folders]
        rows = rows.unionByName(opened.snapshot(name, again))
    # A name of its own, so that a crashed attempt cannot block the next one.
    key = uuid.uuid4().hex
    folder = f"{VERSION}=v{version}-{key}"
    location = lake.path("snapshots", name, folder)
    pointer = []
    if touched:
        compact_folder(rows, location, lake.date_column)
        written = spark.read.schema(opened.columns(name)).parquet(literal_path(location))
        for r in written.groupBy(day.alias("day")).count().collect():
            place = f"{folder}/{lake.date_column}={r.day}"
            pointer.append((name, version, r.day, place, r["count"], None))
    pointer.append((name, version, None, None, None, sorted(marks)))
    lake.write_log(spark, "published", key, pointer, PUBLISHED_SCHEMA)
    return location


def compact_all(spark: SparkSession, lake: Lake) -> tuple[list[str], list[tuple[str, str]]]:
    """Compact every table and fold the logs; a table that fails is listed with its error and
    the rest go on."""
    good, bad = [], []
    for name in lake.open(spark).tables:
        try:
            compact_table(spark, lake, name)
            good.append(name)
        except Exception as error:
            bad.append((name, str(error)))
    fold_logs(spark, lake)
    return good, bad


def fold_logs(spark: SparkSession, lake: Lake) -> list[str]:
    """Fold the finished batches of the lake's logs into segments of few files, and return the
    last folded batch of every stream.

    The newest batch of a stream stays out, as a restart may do it again. Segments that hold as
    many folds as the new one are merged into it, so a log of n folds has about log n segments
    and a row is rewritten about log n times. What the fold before this one replaced is removed
    now, so a query has from one fold to the next to end. Call it from one place at a time.
    """
    audited = _audited(spark, lake)
    older = audited.join(_by_stream(audited), "stream").where(F.col(BATCH) < F.col("mark"))
    marks = sorted(r.mark for r in _by_stream(older.drop("mark")).collect())
    for kind, schema in FOLDED.items():
        _fold_log(spark, lake, kind, schema, marks)
    # A claim says nothing more about a batch that is audited.
    _remove_batches(spark, lake, "claims", marks)
    return marks


def _fold_log(spark: SparkSession, lake: Lake, kind: str, schema: str, marks: list[str]) -> None:
    before = lake.fold(spark, kind) or Fold(0, [], [])
    if marks == before.marks:
        return
    rows = lake.tail(spark, kind, schema).where(up_to(marks) & ~up_to(before.marks))
    segments = list(before.segments)
    if not rows.isEmpty():
        folds, merged = 1, []
        while segments and segments[-1][1] <= folds:
            name, size = segments.pop()
            merged.append(name)
            folds += size
        rows = rows.unionByName(lake.segments(spark, kind, schema, merged))
        key = uuid.uuid4().hex
        # Files of the audit cover a range of times each, so a page finds its files' rows by them.
        spread = rows.repartitionByRange("modified", "path") if kind == "audit" else balanced(rows)
        if kind == "audit":
            spread = spread.sortWithinPartitions("modified")
        spread.write.mode("errorifexists").parquet(lake.path("folds", kind, "segments", key))
        segments.append((key, folds))
    version = f"{before.version + 1:010d}-{uuid.uuid4().hex}"
    pointer = [(name, folds, None) for name, folds in segments] + [(None, None, marks)]
    lake.write_log(spark, f"folds/{kind}/pointers", version, pointer, POINTER_SCHEMA)

    _remove_batches(spark, lake, kind, before.marks)
    kept = {name for name, _ in [*segments, *before.segments]}
    for path in child_folders(spark, literal_path(lake.path("folds", kind, "segments"))):
        if path.rpartition("/")[2] not in kept:
            remove_folder(spark, path)
    for path in child_folders(spark, literal_path(lake.path("folds", kind, "pointers"))):
        if path.rpartition("=")[2] < f"{before.version:010d}":
            remove_folder(spark, path)


def _remove_batches(spark: SparkSession, lake: Lake, kind: str, marks: list[str]) -> None:
    for path in child_folders(spark, literal_path(lake.path(kind)), f"{BATCH}=*"):
        if behind(path.rpartition("=")[2], marks):
            remove_folder(spark, path)


def drop_superseded(spark: SparkSession, lake: Lake, name: str, at_once: int = 16) -> int:
    """Remove what the published version of a table replaced: folded batches, older versions
    of dates and crashed attempts. Call it while no compaction runs and no query reads them
    any more; returns the number of date folders removed."""
    current = lake.open(spark).published(name)
    if current is None:
        return 0
    table = literal_path(lake.table_path(name))
    old = []
    for mark in current.marks:
        stream, _, number = mark.rpartition("-")
        some = f"{lake.date_column}=*/{BATCH}={literal_path(stream)}-{'?' * len(number)}"
        old += [p for p in child_folders(spark, table, some) if p.rpartition("=")[2] <= mark]
    kept = set(current.folders.values())
    snapshots = literal_path(lake.path("snapshots", name))
    dates = child_folders(spark, snapshots, f"{VERSION}=*/{lake.date_column}=*")
    old += [path for path in dates if "/".join(path.split("/")[-2:]) not in kept]
    with ThreadPoolExecutor(at_once) as pool:
        list(pool.map(lambda path: remove_folder(spark, path), old))
    return len(old)

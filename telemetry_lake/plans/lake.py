"""Folder layout of a lake, and reading its tables.

``tables/<name>.parquet``  rows, partitioned by date and ingest batch
``registry``               columns and types, one folder per batch that added some
``claims``                 the files of a page, per batch; written first
``drift``                  type conflicts seen, per batch
``quarantine``             lines that were set aside, per batch and table
``audit``                  one row per landing file, per batch; written last
``snapshots``              compacted dates by version; ``published`` says which are current
``folds``                  finished batches of the logs in few files, with a pointer per version
"""

from __future__ import annotations

import operator
from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from telemetry_lake.operators.quality import (
    REGISTRY_SCHEMA,
    grown,
    quoted,
    struct_from_registry,
    type_from_name,
    type_text,
)
from telemetry_lake.session import child_folders, literal_path, path_missing, small_frame

BATCH = "_batch_id"
QUARANTINE_SCHEMA = "file_name string, reason string, record string, table_name string"
DRIFT_SCHEMA = "table_name string, column_name string, old_type string, new_type string"
AUDIT_SCHEMA = (
    "table_name string, file_name string, status string, bytes bigint,"
    " rows_done bigint, rows_bad bigint, process_seconds double, path string, modified bigint, cycle string"
)
CLAIM_SCHEMA = "path string, file_name string, bytes bigint, table_name string, modified bigint"
ENTRY_SCHEMA = f"{REGISTRY_SCHEMA}, entered double"
# One row per date a compaction rewrote, and one without a folder that holds the marks: the
# last folded batch of every stream.
PUBLISHED_SCHEMA = (
    "table_name string, version int, day string, folder string, rows bigint, marks array<string>"
)
VERSION = "_version"
# Fixed value: the partition folder of rows without a date.
UNDATED = "__HIVE_DEFAULT_PARTITION__"
# The logs whose finished batches are folded together.
FOLDED = {
    "audit": AUDIT_SCHEMA,
    "registry": ENTRY_SCHEMA,
    "quarantine": QUARANTINE_SCHEMA,
    "drift": DRIFT_SCHEMA,
}
# A pointer has one row per segment, and one without a segment that holds the marks.
POINTER_SCHEMA = "segment string, folds int, marks array<string>"


@dataclass(frozen=True)
class Fold:
    """The folded part of a log: its segments with the number of folds in each, and the last
    folded batch of every stream."""

    version: int
    segments: list[tuple[str, int]]
    marks: list[str]


# Pointers by path; one that is written never changes.
_READ_POINTERS: dict[str, Fold] = {}


@dataclass(frozen=True)
class Lake:
    root: str
    date_column: str = "report_date"

    def path(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    def table_path(self, name: str) -> str:
        return self.path("tables", f"{name}.parquet")

    def log(self, spark: SparkSession, kind: str, schema: str) -> DataFrame:
        """A per-batch dataset of the lake; empty before its first write. Finished batches are
        read from the folded segments, where there are any."""
        # The folders are listed first: what is folded and dropped from then on is behind the marks.
        rows = self.tail(spark, kind, schema)
        fold = self.fold(spark, kind) if kind in FOLDED else None
        if fold is None:
            return rows
        newer = rows.where(~up_to(fold.marks))
        return self.segments(spark, kind, schema, [name for name, _ in fold.segments]).unionByName(newer)

    def tail(self, spark: SparkSession, kind: str, schema: str) -> DataFrame:
        """The folders per batch of a log."""
        return self._read(spark, self.path(kind), StructType.fromDDL(f"{schema}, {BATCH} string"))

    def segments(self, spark: SparkSession, kind: str, schema: str, names: list[str]) -> DataFrame:
        full = StructType.fromDDL(f"{schema}, {BATCH} string")
        paths = [literal_path(self.path("folds", kind, "segments", name)) for name in names]
        if not paths:
            return self._read(spark, self.path("folds", kind, "none"), full)
        return spark.read.schema(full).parquet(*paths)

    def fold(self, spark: SparkSession, kind: str) -> Fold | None:
        """The current folded part of a log. A pointer counts once its file is in place."""
        folder = literal_path(self.path("folds", kind, "pointers"))
        pointers = child_folders(spark, folder, f"{BATCH}=*/part-*")
        if not pointers:
            return None
        newest = max(pointers)
        if newest not in _READ_POINTERS:
            rows = spark.read.schema(POINTER_SCHEMA).parquet(literal_path(newest)).collect()
            version = int(newest.split("/")[-2].partition("=")[2].partition("-")[0])
            _READ_POINTERS[newest] = Fold(
                version,
                [(r.segment, r.folds) for r in rows if r.segment is not None],
                [mark for r in rows if r.segment is None for mark in r.marks],
            )
        return _READ_POINTERS[newest]

    def write_log(
        self,
        spark: SparkSession,
        kind: str,
        batch: str,
        rows: list[tuple],
        schema: str,
        mode: str = "overwrite",
    ) -> None:
        """Replace a batch's rows in one of the logs, or add to them; a page's metadata at most."""
        small_frame(spark, rows, schema).coalesce(1).write.mode(mode).parquet(
            self.path(kind, f"{BATCH}={batch}")
        )

    def registry(self, spark: SparkSession, before: str | None = None) -> DataFrame:
        """Known columns. The first entry of a column sets its type; later ones add the
        nested fields it lacks. As many rows as there are columns, so they are merged here.

        ``before`` leaves out a batch's own entries.
        """
        entries = self.log(spark, "registry", ENTRY_SCHEMA)
        if before is not None:
            entries = entries.where(F.col(BATCH) != before)
        entries = entries.orderBy(
            F.col("entered").asc_nulls_first(), BATCH, F.length("data_type")
        )
        types: dict[tuple[str, str], str] = {}
        for row in entries.collect():
            key = row.table_name, row.column_name
            old = types.setdefault(key, row.data_type)
            if old != row.data_type:
                was = type_from_name(old)
                more = grown(was, type_from_name(row.data_type))
                types[key] = old if more == was else type_text(more)
        return small_frame(spark, [(*key, t) for key, t in types.items()], REGISTRY_SCHEMA)

    def quarantine(self, spark: SparkSession) -> DataFrame:
        return self.log(spark, "quarantine", QUARANTINE_SCHEMA)

    def audit(self, spark: SparkSession) -> DataFrame:
        return self.log(spark, "audit", AUDIT_SCHEMA)

    def drift(self, spark: SparkSession) -> DataFrame:
        return self.log(spark, "drift", DRIFT_SCHEMA)

    def open(self, spark: SparkSession) -> OpenLake:
        return OpenLake(spark, self)

    @staticmethod
    def _read(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
        try:
            return spark.read.schema(schema).parquet(literal_path(path))
        except AnalysisException as error:
            if path_missing(error):
                return small_frame(spark, [], "x string").select(
                    *[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
                )
            raise


@dataclass(frozen=True)
class Published:
    """The compacted part of a table: the folder of each date, below ``snapshots``."""

    version: int
    rows_by_day: dict[str, int]
    folders: dict[str, str]
    marks: list[str]

    @property
    def rows(self) -> int:
        return sum(self.rows_by_day.values())


def up_to(marks: list[str]) -> Column:
    """Whether a batch is one of those the marks stand for. Batches of a stream end in a number
    of fixed length, so each stream is a range of its partition names."""
    batch = F.col(BATCH)
    ranges = [
        batch.between(f"{mark.rpartition('-')[0]}-{'0' * len(mark.rpartition('-')[2])}", mark)
        & (F.length(batch) == len(mark))
        for mark in marks
    ]
    return reduce(operator.or_, ranges, F.lit(False))


def behind(batch: str, marks: Iterable[str]) -> bool:
    """``up_to`` for the name of one batch."""
    stream = batch.rpartition("-")[0]
    return any(
        stream == mark.rpartition("-")[0] and len(batch) == len(mark) and batch <= mark
        for mark in marks
    )


class OpenLake:
    """The tables of a lake as its registry, published versions and finished pages stood on opening."""

    def __init__(self, spark: SparkSession, lake: Lake):
        self.spark = spark
        self.lake = lake
        # The files of the audit are listed now, so pages that finish later stay out of all tables.
        self._finished = lake.audit(spark).select(BATCH).distinct()
        known = sorted(lake.registry(spark).collect())
        types: dict[str, dict[str, str]] = {}
        for row in known:
            columns = types.setdefault(row.table_name, {})
            # Entered only for a table that has nothing but dates so far.
            if row.column_name != lake.date_column:
                columns[row.column_name] = row.data_type
        self._columns = {name: struct_from_registry(t) for name, t in types.items()}
        versions = lake.log(spark, "published", PUBLISHED_SCHEMA).groupBy(
            "table_name", F.col("folder").isNull(), "day"
        )
        latest = versions.agg(F.max_by(F.struct("*"), "version").alias("v")).select("v.*").collect()
        self._published = {}
        for mark in latest:
            if mark.folder is None:
                days = [r for r in latest if r.folder and r.table_name == mark.table_name]
                self._published[mark.table_name] = Published(
                    mark.version,
                    {r.day: r.rows for r in days},
                    {r.day: r.folder for r in days},
                    list(mark.marks),
                )

    @property
    def tables(self) -> list[str]:
        return sorted(self._columns)

    def columns(self, name: str) -> StructType:
        """A table's columns by the registry, the date last."""
        date = StructField(self.lake.date_column, DateType(), True)
        return StructType([*self._columns[name].fields, date])

    def published(self, name: str) -> Published | None:
        """The compacted part of a table."""
        return self._published.get(name)

    def batches(self, name: str) -> DataFrame:
        """All ingested rows of a table with their batch. The registry gives the schema:
        no footer merge, and a column a file lacks reads as NULL."""
        batch = StructField(BATCH, StringType(), True)
        schema = StructType([*self.columns(name).fields, batch])
        return self.lake._read(self.spark, self.lake.table_path(name), schema)

    def snapshot(self, name: str, days: Iterable[str]) -> DataFrame:
        """Compacted rows of some dates, by the text of their partitions."""
        current = self.published(name)
        root = literal_path(self.lake.path("snapshots", name))
        paths = [f"{root}/{literal_path(current.folders[day])}" for day in days]
        version = StructField(VERSION, StringType(), True)
        schema = StructType([*self.columns(name).fields, version])
        if not paths:
            return self.lake._read(self.spark, root + "/none", schema).drop(VERSION)
        reader = self.spark.read.schema(schema).option("basePath", root)
        return reader.parquet(*paths).drop(VERSION)

    def newer(self, name: str) -> DataFrame:
        """Rows of the finished batches that no compaction has folded. A page that was not audited
        on opening is left out of every table as a whole."""
        # Listed first: a page that claims its files after that has no rows in the list.
        rows = self.batches(name)
        # Names only, and only of pages since the last fold of the logs.
        folders = child_folders(self.spark, literal_path(self.lake.path("claims")), f"{BATCH}=*")
        claimed = small_frame(self.spark, [(f.rpartition("=")[2],) for f in folders], f"{BATCH} string")
        # As many as there are pages under way or cut off. Their folders are pruned.
        under_way = claimed.join(self._finished, BATCH, "left_anti").collect() if folders else []
        if under_way:
            rows = rows.where(~F.col(BATCH).isin([r[BATCH] for r in under_way]))
        current = self.published(name)
        return rows if current is None else rows.where(~up_to(current.marks))

    def read(self, name: str) -> DataFrame:
        """A table: its compacted dates and the batches ingested since."""
        newer = self.newer(name).drop(BATCH)
        current = self.published(name)
        return newer if current is None else self.snapshot(name, current.folders).unionByName(newer)

    def counts_by_date(self, name: str) -> DataFrame:
        """(date, rows) of a table. Compacted dates are not read: their compaction published their
        rows. Of newer batches only the row counts in the footers are."""
        column = self.lake.date_column
        newer = self.newer(name).groupBy(column).agg(F.count(F.lit(1)).alias("rows"))
        current = self.published(name)
        if current is None:
            return newer
        days = [(None if day == UNDATED else day, rows) for day, rows in current.rows_by_day.items()]
        compacted = small_frame(self.spark, days, "day string, rows bigint")
        both = compacted.select(F.col("day").cast("date").alias(column), "rows").unionByName(newer)
        return both.groupBy(column).agg(F.sum("rows").alias("rows"))

    def register(self) -> list[str]:
        """Temp views over all tables, named after them."""
        for name in self.tables:
            self.read(name).createOrReplaceTempView(quoted(name))
        return self.tables

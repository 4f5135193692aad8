"""Distinct devices per configuration, kept per date as bitmaps.

Devices get numbers that are dense by task, so that a set of them is a few bitmaps. For each
compacted date the set of every configuration is stored once, next to the names of the compacted
folders it was built from. A report merges the stored sets and reads rows only of dates that have
newer ones, or that were compacted again since. A report row and a hardware row belong together
if their key and their date are equal, so a date's sets depend on that date alone.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from telemetry_lake.operators.sinks import balanced
from telemetry_lake.plans.lake import UNDATED, VERSION, Lake, OpenLake
from telemetry_lake.session import literal_path

KEPT_SCHEMA = (
    "sets string, version int, day string, folder string, report_folder string, info_folder string"
)
#: monotonically_increasing_id() counts the rows of a task in so many bits.
TASK_BITS = 33


@dataclass(frozen=True)
class DeviceSets:
    """The sets of one pair of tables. ``keep`` runs after compaction, from one place at a time."""

    lake: Lake
    reports: str = "report_data"
    info: str = "flat_info_data"
    key: str = "report_id"
    device: str = "mac"
    configuration: str = "configuration"

    @property
    def name(self) -> str:
        return "-".join([self.reports, self.info, self.key, self.device, self.configuration])

    def keep(self, spark: SparkSession) -> list[str]:
        """Store the sets of compacted dates that have none, or older ones; returns the dates.

        A run that is cut off leaves numbers without use and no sets, and is simply done again.
        """
        opened = self.lake.open(spark)
        kept = self._kept(spark)
        days = [d for d, sides in self._compacted(opened).items() if kept.get(d, ("",))[1:] != sides]
        if not days:
            return []
        reports = opened.snapshot(self.reports, days)
        self._number(spark, opened, reports.select(self.device))
        pairs = self._pairs(reports, opened.snapshot(self.info, days))
        sets = self._sets(pairs.join(self._numbers(spark, opened), self.device, "left"), self.lake.date_column)
        folder = f"{VERSION}={uuid.uuid4().hex}"
        location = self._path("sets", folder)
        balanced(sets, self.lake.date_column).write.partitionBy(self.lake.date_column).parquet(location)
        sides, version = self._compacted(opened), self._version(spark) + 1
        # A date without a common key has no folder of sets.
        written = {self._day_text(r[0]) for r in sets_days(spark, location, self.lake.date_column)}
        rows = [
            (
                self.name, version, day,
                f"{folder}/{self.lake.date_column}={day}" if day in written else None,
                *sides[day],
            )
            for day in days
        ]
        self.lake.write_log(spark, "kept_sets", uuid.uuid4().hex, rows, KEPT_SCHEMA)
        return sorted(days)

    def count(self, spark: SparkSession) -> DataFrame:
        """(configuration, devices) over all rows of both tables.

        Like an exact distinct count, NULL devices count for nothing, and a configuration that
        has only those is listed with 0.
        """
        opened = self.lake.open(spark)
        kept, sides = self._kept(spark), self._compacted(opened)
        newer = {t: opened.newer(t) for t in (self.reports, self.info)}
        touched = {t: self._days(rows) for t, rows in newer.items()}
        either = set().union(*touched.values())
        stored = [d for d, s in sides.items() if d not in either and kept.get(d, ("",))[1:] == s]

        def whole(table: str) -> set[str]:
            current = opened.published(table)
            return touched[table] | set(current.folders if current else ())

        def live(table: str) -> DataFrame:
            current = opened.published(table)
            rows = newer[table].select(*opened.columns(table).names)
            days = sorted(open_days & set(current.folders)) if current else []
            return rows.unionByName(opened.snapshot(table, days)) if days else rows

        open_days = (whole(self.reports) & whole(self.info)) - set(stored)
        pairs = self._pairs(live(self.reports), live(self.info))
        pairs = pairs.join(self._numbers(spark, opened), self.device, "left")
        # Devices that came after the last run of keep have no number, and are in no stored set.
        unnumbered = pairs.where(F.col("number").isNull() & F.col(self.device).isNotNull())
        unnumbered = unnumbered.groupBy(self.configuration).agg(F.count_distinct(self.device).alias("devices"))
        folders = [kept[day][0] for day in stored if kept[day][0] is not None]
        sets = self._sets(pairs).unionByName(self._read_sets(spark, opened, folders))
        merged = sets.groupBy(self.configuration, "bucket").agg(F.bitmap_or_agg("devices").alias("devices"))
        counted = merged.select(self.configuration, F.bitmap_count("devices").alias("devices"))
        return (
            counted.unionByName(unnumbered)
            .groupBy(self.configuration)
            .agg(F.sum("devices").alias("devices"))
        )

    def _path(self, *parts: str) -> str:
        return self.lake.path("device_sets", self.name, *parts)

    def _day_text(self, day) -> str:
        return UNDATED if day is None else str(day)

    def _days(self, rows: DataFrame) -> set[str]:
        """Dates of rows, as partitions are called; a few of them."""
        return {self._day_text(r[0]) for r in rows.select(self.lake.date_column).distinct().collect()}

    def _compacted(self, opened: OpenLake) -> dict[str, tuple[str, str]]:
        """The current folders of both tables for each date that both have compacted."""
        reports, info = opened.published(self.reports), opened.published(self.info)
        if reports is None or info is None:
            return {}
        return {d: (reports.folders[d], info.folders[d]) for d in reports.folders if d in info.folders}

    def _log(self, spark: SparkSession) -> DataFrame:
        return self.lake.log(spark, "kept_sets", KEPT_SCHEMA).where(F.col("sets") == self.name)

    def _version(self, spark: SparkSession) -> int:
        return self._log(spark).agg(F.max("version")).first()[0] or 0

    def _kept(self, spark: SparkSession) -> dict[str, tuple[str | None, str, str]]:
        """By date: the folder of its sets, and those they were built from. A row a date."""
        latest = self._log(spark).groupBy("day").agg(
            F.max_by(F.struct("folder", "report_folder", "info_folder"), "version").alias("v")
        )
        return {r.day: tuple(r.v) for r in latest.collect()}

    def _numbers(self, spark: SparkSession, opened: OpenLake) -> DataFrame:
        kind = opened.columns(self.reports)[self.device]
        schema = StructType([StructField(self.device, kind.dataType), StructField("number", LongType())])
        return self.lake._read(spark, self._path("numbers"), schema)

    def _number(self, spark: SparkSession, opened: OpenLake, devices: DataFrame) -> None:
        """Give numbers to devices that have none: those of a task follow each other, behind all
        that were given before."""
        known = self._numbers(spark, opened)
        new = devices.where(F.col(self.device).isNotNull()).distinct().join(known, self.device, "left_anti")
        last = known.agg(F.max("number")).first()[0]
        first = 0 if last is None else ((last >> TASK_BITS) + 1) << TASK_BITS
        numbered = new.select(self.device, (F.monotonically_increasing_id() + F.lit(first)).alias("number"))
        numbered.write.mode("append").parquet(self._path("numbers"))

    def _pairs(self, reports: DataFrame, info: DataFrame) -> DataFrame:
        """Distinct (date, configuration, device) over the join on key and date."""
        day = self.lake.date_column
        # Repeated rows cannot change a set; a key that is hot on both sides is not multiplied.
        left = reports.select(day, self.key, self.device).distinct()
        right = info.select(
            F.col(day).alias("info_day"), F.col(self.key).alias("info_key"), self.configuration
        ).distinct()
        same = (left[self.key] == right.info_key) & left[day].eqNullSafe(right.info_day)
        return left.join(right, same).select(day, self.configuration, self.device).distinct()

    def _sets(self, numbered: DataFrame, *more: str) -> DataFrame:
        """A bitmap for each configuration and range of numbers. NULL numbers set no bit."""
        return numbered.groupBy(
            *more, self.configuration, F.bitmap_bucket_number("number").alias("bucket")
        ).agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("devices"))

    def _read_sets(self, spark: SparkSession, opened: OpenLake, folders: list[str]) -> DataFrame:
        kind = opened.columns(self.info)[self.configuration]
        schema = StructType([
            StructField(self.configuration, kind.dataType),
            StructField("bucket", LongType()),
            StructField("devices", BinaryType()),
        ])
        root = literal_path(self._path("sets"))
        if not folders:
            return self.lake._read(spark, f"{root}/none", schema)
        return spark.read.schema(schema).parquet(*[f"{root}/{literal_path(f)}" for f in folders])


def sets_days(spark: SparkSession, location: str, date_column: str) -> list:
    """The dates that have sets in a folder; only partition names are read."""
    schema = StructType.fromDDL(f"bucket bigint, `{date_column}` date")
    return spark.read.schema(schema).parquet(literal_path(location)).select(date_column).distinct().collect()
